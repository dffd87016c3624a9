"""Records: merging of duplicates, both rankings, order, and what a valid record is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postalith.functions import text
from postalith.plans.config import country_table
from postalith.plans.schema import BOUNDARY, FALLBACK, FIELDS, IDENTITY


def priority(source: Column | str = "source") -> Column:
    return F.when((F.col(source) if isinstance(source, str) else source) == BOUNDARY, 1).otherwise(0)


def merge_duplicates(df: DataFrame, keys: list[str], best: dict[str, Column]) -> DataFrame:
    """One row for each key with the greatest of each value on its own: a partial aggregate before the shuffle."""
    return df.groupBy(*keys).agg(*[F.max(value).alias(name) for name, value in best.items()])


def location_order() -> list[Column]:
    """Order of a code's locations: evidence, then source, then folded names. The names as they are break last ties."""
    folded = [text.fold(c) for c in ("city", "state", "county")]
    return [F.col("evidence_count").desc(), priority().desc(), *folded, *map(F.col, ("city", "state", "county", "time_zone"))]


def code_order() -> list[Column]:
    return [F.col("evidence_count").desc(), priority().desc(), F.col("code"), *map(F.col, ("city", "state", "county", "time_zone"))]


def place_key() -> list[Column]:
    return [F.col("country"), text.fold("state"), text.fold("county"), text.fold("city")]


def rank(df: DataFrame) -> DataFrame:
    """Number the locations of each code and the codes of each place from 1."""
    locations = F.row_number().over(Window.partitionBy("country", "code").orderBy(*location_order()))
    codes = F.row_number().over(Window.partitionBy(*place_key()).orderBy(*code_order()))
    ranked = df.withColumn("location_rank", locations).withColumn("is_primary_location", F.col("location_rank") == 1)
    return ranked.withColumn("postal_code_rank", codes)


def dedupe(records: DataFrame) -> DataFrame:
    """One row for each identity, ranked, with the published columns."""
    best = {"_priority": priority(), "evidence_count": F.col("evidence_count")}
    merged = merge_duplicates(records, list(IDENTITY), best)
    merged = merged.withColumn("source", F.when(F.col("_priority") == 1, BOUNDARY).otherwise(FALLBACK)).drop("_priority")
    return rank(merged).select(*FIELDS)


def ordered(records: DataFrame) -> DataFrame:
    """Records in order of all fields: bytes of UTF-8 sort as code points do."""
    return records.orderBy(*FIELDS)


def errors(records: DataFrame) -> Column:
    """What is wrong with a record of text columns: an array, empty for a valid one."""
    pattern = text.pattern_of("country")
    checks = [
        (pattern.isNull(), "unknown country"),
        (pattern.isNotNull() & ~F.coalesce(F.rlike(F.col("code"), pattern), F.lit(False)), "invalid code"),
        (text.normalize_text("city") == "", "empty city"),
        (F.coalesce(F.col("time_zone"), F.lit("")) != F.lit("W. Europe Standard Time"), "unexpected time zone"),
        (~F.coalesce(F.col("source").isin(BOUNDARY, FALLBACK), F.lit(False)), "unknown source"),
        (~F.lower(F.coalesce(F.col("is_primary_location").cast("string"), F.lit(""))).isin("true", "false"), "is_primary_location is not a boolean"),
    ]
    checks += [(text.parse_count(c).isNull(), f"{c} is not a count") for c in ("location_rank", "postal_code_rank", "evidence_count")]
    return F.array_compact(F.array(*[F.when(bad, F.lit(said)) for bad, said in checks]))


def normalize(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Typed records from text columns. Invalid ones raise, or if not strict stay, with errors in a column."""
    clean = raw.select(*[text.normalize_text(F.col(c).cast("string")).alias(c) if c in IDENTITY else F.col(c).cast("string").alias(c) for c in FIELDS])
    alias = F.broadcast(country_table(raw.sparkSession).select("alias", F.col("country").alias("_code")))  # six rows
    named = clean.join(alias, F.lower("country") == F.col("alias"), "left")
    clean = named.withColumn("country", F.coalesce("_code", "country")).drop("alias", "_code").withColumn("errors", errors(clean))
    if strict:
        wrong = F.raise_error(F.concat(F.lit("invalid record: "), F.array_join("errors", "; "))).cast("string")
        clean = clean.withColumn("code", F.when(F.size("errors") == 0, F.col("code")).otherwise(wrong))
    counts = {c: text.parse_count(c) for c in ("location_rank", "postal_code_rank", "evidence_count")}
    primary = {"is_primary_location": F.lower("is_primary_location") == "true"}
    return clean.withColumns(counts | primary).select(*FIELDS, *([] if strict else ["errors"]))
