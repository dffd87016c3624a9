"""Address evidence: aggregation, lookup at three grains, and the choice between spatial and evidenced names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: Column, first: dict[str, Column], count: str = "n") -> DataFrame:
    """Rows of each key counted, and of each value the first non-null one in order: partial aggregates only."""
    picks = [F.min_by(value, F.when(value.isNotNull(), order)).alias(name) for name, value in first.items()]
    return df.groupBy(*keys).agg(F.count("*").cast("long").alias(count), *picks)


def addresses(objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (seq, code, city, state_code, px, py): one row for each code and city, and the rows that were dropped.

    The first object by seq settles the state tag; objects with another one are dropped. The first point counts.
    """
    first = objects.groupBy("code", "city").agg(F.min_by("state_code", "seq").alias("_first"))  # a large city's addresses need no common task
    told = objects.join(first, ["code", "city"])
    kept = told.where(F.col("state_code") == F.col("_first"))
    point = F.when(F.col("px").isNotNull(), F.struct("px", "py"))
    found = first_by(kept, ["code", "city", "state_code"], F.col("seq"), {"point": point})
    return found.select("code", "city", "state_code", "n", "point.px", "point.py"), told.where(F.col("state_code") != F.col("_first"))


def at_least(evidence: DataFrame, least: int, column: str = "n") -> DataFrame:
    return evidence.where(F.col(column) >= least)


def without(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key the others do not have."""
    return df.join(others.select(key).distinct(), key, "left_anti")


def rollup(df: DataFrame, keys: list[str], value: Column | str = "n", name: str = "n") -> DataFrame:
    """Sums at every grain of the keys from all to none; null stands for 'any'."""
    return df.rollup(*keys).agg(F.sum(value).alias(name))


def choose(spatial: Column, evidenced: Column) -> Column:
    """Names to use, given spatial ones and those with evidence: spatial ones with evidence, else any with evidence, else
    the spatial ones. Without spatial names it is the empty name."""
    both = F.array_intersect(spatial, evidenced)
    other = F.array_sort(F.filter(evidenced, lambda x: x != ""))
    return F.when(F.size(spatial) == 0, F.array(F.lit(""))).when(F.size(both) > 0, both).when(F.size(other) > 0, other).otherwise(spatial)


def expand(boundaries: DataFrame, evidence: DataFrame) -> DataFrame:
    """A row for each city, state and county of (bkey, code, cities, states, counties, ...) with its evidence n.

    evidence is (code, city, state, county, n). The county is chosen by the evidence of the state chosen before.
    """
    city = boundaries.withColumn("city", F.explode("cities"))
    by_city = evidence.groupBy("code", "city").agg(F.collect_set("state").alias("_states"), F.sum("n").alias("_all"))
    none = F.array().cast("array<string>")
    told = city.join(by_city, ["code", "city"], "left")
    told = told.withColumn("state", F.explode(choose(F.col("states"), F.coalesce("_states", none))))
    by_state = evidence.groupBy("code", "city", "state").agg(F.collect_set("county").alias("_counties"), F.sum("n").alias("_state"))
    told = told.join(by_state, ["code", "city", "state"], "left")
    told = told.withColumn("county", F.explode(choose(F.col("counties"), F.coalesce("_counties", none))))
    exact = evidence.select("code", "city", "state", "county", F.col("n").alias("_exact"))
    told = told.join(exact, ["code", "city", "state", "county"], "left")
    n = F.when(F.col("county") != "", F.col("_exact")).when(F.col("state") != "", F.col("_state")).otherwise(F.col("_all"))
    return told.withColumn("n", F.coalesce(n, F.lit(0).cast("long"))).drop("_states", "_counties", "_all", "_state", "_exact")
