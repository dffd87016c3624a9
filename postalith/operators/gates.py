"""Quality gates: metrics of a record set, and errors and warnings against a contract, floors and a baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalith.functions.text import change_ratio
from postalith.plans.config import COUNTRY_LIMITS, FLOOR_MARGIN, FLOORS, SOURCE_LIMITS, Country, Source

EPSILON = 1e-12


def metrics(records: DataFrame, c: Country) -> DataFrame:
    """One row: records, codes, empty_states, wrong_country, unknown_states (names), state_counts (code to number).

    One aggregate over the records; states without records count 0. A row with an empty state still counts for its
    country.
    """
    named = {name: code for code, name in c.states.items()}
    known = F.col("state").isin(*named)
    counts = F.create_map(*[x for name, code in named.items() for x in (F.lit(code), F.count_if(F.col("state") == name))])
    return records.agg(
        F.count("*").alias("records"), F.countDistinct("code").alias("codes"), F.count_if(F.col("state") == "").alias("empty_states"),
        F.count_if(F.col("country") != c.code).alias("wrong_country"),
        F.array_sort(F.collect_set(F.when((F.col("state") != "") & ~known, F.col("state")))).alias("unknown_states"),
        counts.alias("state_counts"),
    )


def messages(*checks: tuple[Column, Column | str]) -> Column:
    """The messages of those checks that hold."""
    said = [F.when(F.coalesce(test, F.lit(False)), text if isinstance(text, Column) else F.lit(text)) for test, text in checks]
    return F.array_compact(F.array(*said)) if said else F.array().cast("array<string>")


def percent(ratio: Column) -> Column:
    return F.format_string("%.1f%%", ratio * 100)


def loss(new: Column, old: Column) -> Column:
    return -change_ratio(new, old)


def delta_checks(new: Column, old: Column, most_loss: float, most_growth: float, what: str) -> tuple[list, list]:
    """Errors where the loss or growth passes its limit, warnings from half of it on."""
    ratio = change_ratio(new, old)
    errors, warnings = [], []
    for value, most, name in ((-ratio, most_loss, "loss"), (ratio, most_growth, "growth")):
        over = value > most + EPSILON
        errors.append((over, F.concat(F.lit(f"{what} {name} of "), percent(value), F.lit(f" exceeds {most:.0%}"))))
        warnings.append((~over & (value >= most / 2), F.concat(F.lit(f"{what} {name} of "), percent(value), F.lit(f" is at least half of {most:.0%}"))))
    return errors, warnings


def floor_checks(value: Column, floor: int, what: str) -> tuple[list, list]:
    low = value < floor
    close = ~low & (value <= floor * (1 + FLOOR_MARGIN))
    return (
        [(low, F.concat(F.lit(f"{what} of "), value.cast("string"), F.lit(f" is below {floor}")))],
        [(close, F.concat(F.lit(f"{what} of "), value.cast("string"), F.lit(f" is within 5% of the floor {floor}")))],
    )


def common_checks() -> list:
    return [
        (F.col("empty_states") > 0, F.concat(F.col("empty_states").cast("string"), F.lit(" records have no state"))),
        (F.size("unknown_states") > 0, F.concat(F.lit("unknown states: "), F.array_join("unknown_states", ", "))),
        (F.col("wrong_country") > 0, F.concat(F.col("wrong_country").cast("string"), F.lit(" records are of another country"))),
    ]


def _deltas(limits: dict[str, float]) -> tuple[list, list]:
    errors, warnings = [], []
    for what, most in (("records", limits["records"]), ("codes", limits["codes"])):
        e, w = delta_checks(F.col(what), F.col(f"old_{what}"), most, limits["growth"], what)
        errors += e
        warnings += w
    return errors, warnings


def _with_baseline(found: DataFrame, baseline: DataFrame | None) -> DataFrame:
    if baseline is None:
        return found.withColumn("old_records", F.lit(None).cast("long")).withColumn("old_codes", F.lit(None).cast("long"))
    return found.join(F.broadcast(baseline.select(F.col("records").alias("old_records"), F.col("codes").alias("old_codes"))))  # one row each


def _judged(found: DataFrame, errors: list, warnings: list) -> DataFrame:
    ratios = {f"{x}_change": change_ratio(x, f"old_{x}") for x in ("records", "codes")}
    return found.withColumns(ratios).withColumn("errors", messages(*errors)).withColumn("warnings", messages(*warnings)).withColumn("valid", F.size("errors") == 0)


def source_gate(found: DataFrame, c: Country, source: Source, baseline: DataFrame | None = None) -> DataFrame:
    """The metrics row with changes, errors, warnings and valid, for one source's candidate."""
    if source.country != c.code:
        raise ValueError(f"source {source.name} belongs to {source.country}, not {c.code}")
    unknown = [s for s in source.required if s not in c.states]
    if unknown:
        raise ValueError(f"{source.name} declares unknown states {', '.join(unknown)}")
    present = F.map_keys(F.map_filter("state_counts", lambda k, v: v > 0))
    stray = F.array_sort(F.array_except(present, F.array(*[F.lit(s) for s in source.required])))
    errors = [*common_checks(), (F.size(stray) > 0, F.concat(F.lit("unexpected states: "), F.array_join(stray, ", ")))]
    need = source.required[1:] if source.primary else source.required
    missing = F.array_except(F.array(*[F.lit(s) for s in need]).cast("array<string>"), present)
    errors.append((F.size(missing) > 0, F.concat(F.lit("missing required states: "), F.array_join(missing, ", "))))
    if source.primary:
        errors.append((F.coalesce(F.col("state_counts")[source.primary], F.lit(0)) == 0, f"no record of the primary state {source.primary}"))
    more, warnings = _deltas(SOURCE_LIMITS)
    return _judged(_with_baseline(found, baseline), errors + more, warnings)


def country_gate(found: DataFrame, c: Country, baseline: DataFrame | None = None) -> DataFrame:
    """The metrics row with changes, errors, warnings and valid, for a whole country."""
    missing = F.array_except(F.array(*[F.lit(s) for s in c.states]), F.map_keys(F.map_filter("state_counts", lambda k, v: v > 0)))
    errors = [*common_checks(), (F.size(missing) > 0, F.concat(F.lit("missing states: "), F.array_join(missing, ", ")))]
    warnings = []
    for what, floor in zip(("records", "codes"), FLOORS[c.code]):
        e, w = floor_checks(F.col(what), floor, what)
        errors += e
        warnings += w
    more, also = _deltas(COUNTRY_LIMITS)
    return _judged(_with_baseline(found, baseline), errors + more, warnings + also)


def observed_errors(seen: tuple[str, ...], c: Country, source: Source) -> list[str]:
    """What is wrong with the state codes seen in a source, as they are."""
    said = []
    for name, codes in (
        ("unknown state codes", sorted(set(seen) - set(c.states))),
        ("unexpected state codes", sorted((set(seen) & set(c.states)) - set(source.required))),
        ("missing embedded state codes", sorted(set(source.required) - {source.primary} - set(seen))),
    ):
        if codes:
            said.append(f"{name}: {', '.join(codes)}")
    return said
