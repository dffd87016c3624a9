"""Countries, states and map sources: small tables from literals."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# States by ISO 3166-2 code.
STATES = {
    "DE": {
        "DE-BW": "Baden-Württemberg", "DE-BY": "Bayern", "DE-BE": "Berlin", "DE-BB": "Brandenburg", "DE-HB": "Bremen", "DE-HH": "Hamburg",
        "DE-HE": "Hessen", "DE-MV": "Mecklenburg-Vorpommern", "DE-NI": "Niedersachsen", "DE-NW": "Nordrhein-Westfalen",
        "DE-RP": "Rheinland-Pfalz", "DE-SL": "Saarland", "DE-SN": "Sachsen", "DE-ST": "Sachsen-Anhalt", "DE-SH": "Schleswig-Holstein",
        "DE-TH": "Thüringen",
    },
    "AT": {
        "AT-1": "Burgenland", "AT-2": "Kärnten", "AT-3": "Niederösterreich", "AT-4": "Oberösterreich", "AT-5": "Salzburg",
        "AT-6": "Steiermark", "AT-7": "Tirol", "AT-8": "Vorarlberg", "AT-9": "Wien",
    },
    "CH": {
        "CH-AG": "Aargau", "CH-AR": "Appenzell Ausserrhoden", "CH-AI": "Appenzell Innerrhoden", "CH-BL": "Basel-Landschaft",
        "CH-BS": "Basel-Stadt", "CH-BE": "Bern/Berne", "CH-FR": "Fribourg/Freiburg", "CH-GE": "Genève", "CH-GL": "Glarus",
        "CH-GR": "Graubünden/Grischun/Grigioni", "CH-JU": "Jura", "CH-LU": "Luzern", "CH-NE": "Neuchâtel", "CH-NW": "Nidwalden",
        "CH-OW": "Obwalden", "CH-SH": "Schaffhausen", "CH-SZ": "Schwyz", "CH-SO": "Solothurn", "CH-SG": "St. Gallen", "CH-TG": "Thurgau",
        "CH-TI": "Ticino", "CH-UR": "Uri", "CH-VS": "Valais/Wallis", "CH-VD": "Vaud", "CH-ZG": "Zug", "CH-ZH": "Zürich",
    },
}

# The German map extracts, each with the states it must hold; the first is its own.
GERMAN_SOURCES = {
    "baden-wuerttemberg": ("DE-BW",), "bayern": ("DE-BY",), "berlin": ("DE-BE",), "brandenburg": ("DE-BB", "DE-BE"), "bremen": ("DE-HB",),
    "hamburg": ("DE-HH",), "hessen": ("DE-HE",), "mecklenburg-vorpommern": ("DE-MV",), "niedersachsen": ("DE-NI", "DE-HB"),
    "nordrhein-westfalen": ("DE-NW",), "rheinland-pfalz": ("DE-RP",), "saarland": ("DE-SL",), "sachsen": ("DE-SN",),
    "sachsen-anhalt": ("DE-ST",), "schleswig-holstein": ("DE-SH",), "thueringen": ("DE-TH",),
}

# Gates. Losses of records and codes, and growth, that a candidate may show; least records and codes of a country.
SOURCE_LIMITS = {"records": 0.15, "codes": 0.12, "growth": 0.25}
COUNTRY_LIMITS = {"records": 0.10, "codes": 0.05, "growth": 0.20}
FLOORS = {"DE": (8_000, 7_800), "AT": (2_700, 2_000), "CH": (3_500, 3_000)}
FLOOR_MARGIN = 0.05
FALLBACK_DAYS = 21
MIN_ADDRESS_EVIDENCE = 3
MIN_OVERLAP = 0.001

# Time zone of all three countries; retries of remote reads.
TIME_ZONE = "W. Europe Standard Time"
RETRY_CODES = frozenset({408, 429, 500, 502, 503, 504})
RETRY_DELAYS = (2.0, 8.0)
RETRY_AFTER_MOST = 60.0

_HOST = "https://download.geofabrik.de/europe"


@dataclass(frozen=True)
class Source:
    """One map extract: what it must hold, and where it lies."""

    name: str
    country: str
    url: str
    required: tuple[str, ...]
    primary: str | None = None

    @property
    def md5_url(self) -> str:
        return f"{self.url}.md5"

    @property
    def file_name(self) -> str:
        return f"{self.name}-latest.osm.pbf"

    @property
    def metadata_key(self) -> str:
        """German sources go by their name, whole countries by country and name."""
        return self.name if self.country == "DE" else f"{self.country.lower()}/{self.name}"


@dataclass(frozen=True)
class Country:
    code: str
    slug: str
    name: str
    digits: int
    sources: tuple[Source, ...]
    time_zone: str = TIME_ZONE
    state_levels: tuple[str, ...] = ("4",)
    county_levels: tuple[str, ...] = ("6",)
    fallback_county_levels: tuple[str, ...] = field(default=())

    @property
    def pattern(self) -> str:
        return rf"^[0-9]{{{self.digits}}}$"

    @property
    def states(self) -> dict[str, str]:
        return STATES[self.code]


COUNTRIES = {
    c.code: c
    for c in (
        Country("DE", "de", "Germany", 5, tuple(Source(n, "DE", f"{_HOST}/germany/{n}-latest.osm.pbf", s, s[0]) for n, s in GERMAN_SOURCES.items())),
        Country("AT", "at", "Austria", 4, (Source("austria", "AT", f"{_HOST}/austria-latest.osm.pbf", tuple(STATES["AT"])),)),
        Country("CH", "ch", "Switzerland", 4, (Source("switzerland", "CH", f"{_HOST}/switzerland-latest.osm.pbf", tuple(STATES["CH"])),)),
    )
}


def country(value: str) -> Country:
    """A country by slug or code, in any case, with white space around."""
    found = COUNTRIES.get(value.strip().upper())
    if found is None:
        raise ValueError(f"unknown country {value!r}; known are {', '.join(c.slug for c in COUNTRIES.values())}")
    return found


def sources(countries: list[str] | None = None) -> list[Source]:
    """All configured sources, or those of the countries named."""
    return [s for c in ([country(x) for x in countries] if countries is not None else COUNTRIES.values()) for s in c.sources]


def selection(value: str | None, known: list[str], what: str) -> list[str]:
    """A comma-separated choice among known names; blank parts are dropped, none means all, unknown ones raise."""
    chosen = [x.strip() for x in (value or "").split(",") if x.strip()]
    unknown = [x for x in chosen if x not in known]
    if unknown:
        raise ValueError(f"unknown {what}: {', '.join(unknown)}")
    return chosen or known


def countries_of(chosen: list[Source]) -> list[Country]:
    """Countries that these sources belong to, in configured order."""
    return [c for c in COUNTRIES.values() if any(s.country == c.code for s in chosen)]


def country_table(spark: SparkSession) -> DataFrame:
    """A row for each way to name a country: alias, code, slug, time_zone, pattern."""
    rows = [(alias, c.code, c.slug, c.time_zone, c.pattern) for c in COUNTRIES.values() for alias in {c.slug, c.code.lower()}]
    return spark.createDataFrame(rows, "alias string, country string, slug string, time_zone string, pattern string")


def state_table(spark: SparkSession) -> DataFrame:
    rows = [(c, code, name, i) for c, states in STATES.items() for i, (code, name) in enumerate(states.items())]
    return spark.createDataFrame(rows, "country string, state_code string, state string, position int")


def progress(i: int, n: int, source: Source) -> str:
    return f"[{i}/{n}] {source.country.lower()}/{source.name}"
