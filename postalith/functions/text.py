"""Scalar functions on columns: text, codes, labels, numbers and times. None needs Python on the executors."""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from postalith.plans.config import COUNTRIES

#: White space as text handling outside the JVM knows it: the JVM's own class misses some.
SPACE = r"[\x09-\x0d\x1c-\x20\x85   -     　]+"
# How labels separate cities, what trails them, what a shortened name must not end in, where it may break.
CITY_SEPARATOR = r"\s*(?:,|;|\s+und\s+)\s*"
TRAILING_NOTE = r"\s*\([^)]*\)\s*$"
FILLERS = ("bei", "b.", "an", "der", "mit", "von", "zu")
BREAKS = " -/–—"
DIFFERENT = r"(?i)\s+is different from\b.*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """Null becomes '', white space collapses to one space and goes at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), SPACE, " "))


@cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """Lower-case characters of the basic plane whose folded form is another: as many single ones, and longer forms."""
    single, longer = {}, {}
    for n in range(0x80, 0x10000):
        low = chr(n).lower()
        if len(low) == 1 and low.casefold() != low:
            (single if len(low.casefold()) == 1 else longer)[low] = low.casefold()
    return "".join(single), "".join(single.values()), longer


def fold(c: Column | str) -> Column:
    """Case-folded text for keys: lower case, then the few hundred characters whose folded form is another.

    Texts without any of them, by far the most, only meet one pattern.
    """
    lower = F.lower(_c(c))
    these, those, longer = _folds()
    exact = F.translate(lower, these, those)
    for one, many in longer.items():
        exact = F.replace(exact, F.lit(one), F.lit(many))
    rare = "".join(these) + "".join(x for x in longer if x != "ß")
    common = F.replace(lower, F.lit("ß"), F.lit("ss"))
    return F.when(F.rlike(lower, F.lit(f"[{rare}]")), exact).otherwise(common)


def normalize_post_code(c: Column | str, pattern: Column | str) -> Column:
    """The code if it has the country's form, else ''."""
    text = normalize_text(c)
    return F.when(F.rlike(text, F.lit(pattern) if isinstance(pattern, str) else pattern), text).otherwise("")


def pattern_of(country: Column | str) -> Column:
    """The form of a country's codes; null for other countries."""
    return F.create_map(*[F.lit(x) for c in COUNTRIES.values() for x in (c.code, c.pattern)])[_c(country)]


def parse_bool(c: Column | str) -> Column:
    """true or false in any case; anything else raises."""
    text = F.lower(normalize_text(_c(c).cast("string")))
    bad = F.raise_error(F.concat(F.lit("not a boolean: "), F.coalesce(text, F.lit("null")))).cast("boolean")
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False)).otherwise(bad)


def format_bool(c: Column | str) -> Column:
    return F.when(_c(c), "true").otherwise("false")


def parse_count(c: Column | str) -> Column:
    """A whole number of at least 0, else null."""
    n = F.expr(f"try_cast({c} as int)") if isinstance(c, str) else c.try_cast("int")
    return F.when(n >= 0, n)


def boundary_cities(code: Column | str, *labels: Column | str) -> Column:
    """Cities of the first label of the form "<code> <cities>" that names any: an array, empty if none does.

    One note in brackets at the end goes; cities are separated by commas, semicolons or " und ".
    """
    found = None
    for label in labels:
        text = normalize_text(label)
        own = (_c(code) != "") & F.startswith(text, F.concat(_c(code), F.lit(" ")))
        rest = F.trim(F.regexp_replace(F.substr(text, F.length(_c(code)) + 2), TRAILING_NOTE, ""))
        cities = F.filter(F.transform(F.split(rest, CITY_SEPARATOR), normalize_text), lambda x: x != "")
        cities = F.when(own & (F.size(cities) > 0), cities)
        found = cities if found is None else F.coalesce(found, cities)
    return F.coalesce(found, F.array().cast("array<string>"))


def split_labels(c: Column | str, separator: str) -> Column:
    """Non-blank parts of a label."""
    return F.filter(F.transform(F.split(_c(c), separator), normalize_text), lambda x: x != "")


def strip_breaks(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{BREAKS}]+|[{BREAKS}]+$", "")


def strip_fillers(c: Column | str) -> Column:
    """Drop filler words at the end, again and again."""
    words = "|".join(map(re.escape, FILLERS))
    return F.regexp_replace(_c(c), rf"(?i)(?:(?:^|\s+)(?:{words}))+$", "")


def shorten(c: Column | str, limit: int) -> Column:
    """Cut at the last break character within the limit, '' if there is none; fillers at the end go."""
    cut = F.regexp_extract(_c(c), rf"^(.{{1,{limit}}})[{BREAKS}]", 1)
    return strip_fillers(strip_breaks(cut))


def fit(c: Column | str, limit: int) -> Column:
    """Text of at most the limit: a remark that it differs from something goes, then what is too long is shortened."""
    text = F.regexp_replace(normalize_text(c), DIFFERENT, "")
    return F.when(F.length(text) <= limit, text).otherwise(shorten(text, limit))


def require(c: Column, name: str, limit: int) -> Column:
    """The text if it has 1 to limit characters; else an error."""
    bad = F.raise_error(F.concat(F.lit(f"{name} must have 1 to {limit} characters: "), F.coalesce(c, F.lit("null")))).cast("string")
    return F.when(F.coalesce(F.length(c).between(1, limit), F.lit(False)), c).otherwise(bad)


def change_ratio(new: Column | str, old: Column | str) -> Column:
    """(new - old) / old; null if old is 0."""
    return F.try_divide((_c(new) - _c(old)).cast("double"), _c(old).cast("double"))


def iso(c: Column | str) -> Column:
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso(c: Column | str) -> Column:
    """A time with an offset, else null."""
    return F.when(F.rlike(_c(c), F.lit(r"(?:Z|[+-]\d\d:?\d\d)$")), F.try_to_timestamp(_c(c)))


def md5_of(c: Column | str) -> Column:
    """The first 32 hexadecimal digits of a checksum file, in lower case."""
    return F.lower(F.regexp_extract(_c(c), r"\b([0-9a-fA-F]{32})\b", 1))


def within_days(at: Column | str, now: Column | str, days: int) -> Column:
    """Whether a time lies at most so many days back, the last instant included."""
    return (_c(now) - _c(at)) <= F.expr(f"INTERVAL {int(days)} DAYS")
