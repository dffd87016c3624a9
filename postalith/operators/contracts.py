"""Checks of published files: per-row messages, ranks, floors, and the source metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalith.functions import text
from postalith.operators.records import errors, place_key
from postalith.plans.config import Country
from postalith.store import held


def contiguous(df: DataFrame, keys: list[Column | str], rank: str, names: list[str] | None = None) -> DataFrame:
    """Each key's row count and whether its ranks are exactly 1 to n."""
    ok = (F.min(rank) == 1) & (F.max(rank) == F.count("*")) & (F.countDistinct(rank) == F.count("*"))
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.coalesce(ok, F.lit(False)).alias("ok"))


def rank_errors(records: DataFrame) -> DataFrame:
    """(message) for every code without exactly one primary location, and every code or place whose ranks have gaps."""
    codes = records.groupBy("country", "code").agg(
        F.count_if("is_primary_location").alias("primaries"), F.min_by("is_primary_location", "location_rank").alias("first"),
    )
    at = F.concat_ws(" ", "country", "code")
    wrong = codes.where("primaries <> 1 or not first").select(F.concat(at, F.lit(": one primary location of rank 1 is expected")).alias("message"))
    gaps = contiguous(records, ["country", "code"], "location_rank").where("not ok").select(F.concat(at, F.lit(": location ranks are not 1 to n")).alias("message"))
    key = [k.alias(f"k{i}") for i, k in enumerate(place_key())]
    places = contiguous(records.select(*key, "postal_code_rank"), ["k0", "k1", "k2", "k3"], "postal_code_rank").where("not ok")
    places = places.select(F.concat(F.concat_ws(" ", "k0", "k1", "k2", "k3"), F.lit(": postal code ranks are not 1 to n")).alias("message"))
    return wrong.unionByName(gaps).unionByName(places)


def numbered(raw: DataFrame, row: str = "row", first: int = 2) -> DataFrame:
    """Rows of one file with their numbers in its order, the header being row 1. Only a count for each partition comes to the driver."""
    rows = held(raw.withColumn("_at", F.monotonically_increasing_id()))
    part, offsets = F.shiftright("_at", 33), []
    for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect():
        offsets.append((r["p"], first))
        first += r["n"]
    table = F.broadcast(raw.sparkSession.createDataFrame(offsets, "_part long, _first long"))
    told = rows.withColumn("_part", part).join(table, "_part").withColumn(row, F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    return told.drop("_part", "_first", "_at")


def row_errors(raw: DataFrame, path: str, row: str = "row") -> DataFrame:
    """(message) "path:row: what" for every fault of every row of text columns; rows without numbers get theirs in file order."""
    raw = raw if row in raw.columns else numbered(raw, row)
    return raw.select(F.col(row), F.explode(errors(raw)).alias("what")).select(F.format_string(f"{path}:%d: %s", row, "what").alias("message"))


def floors(raw: DataFrame, c: Country, least: tuple[int, int], sentinel: dict[str, str] | None = None) -> DataFrame:
    """One row: rows, codes, empty_states, missing and unexpected states, has_sentinel, errors."""
    expected = F.array(*[F.lit(x) for x in c.states.values()])
    is_sentinel = F.lit(True)
    for k, v in (sentinel or {}).items():
        is_sentinel = is_sentinel & (F.col(k) == v)
    found = raw.agg(
        F.count("*").alias("rows"), F.countDistinct("code").alias("codes"), F.count_if(F.coalesce("state", F.lit("")) == "").alias("empty_states"),
        F.collect_set("state").alias("states"), F.coalesce(F.bool_or(is_sentinel), F.lit(False)).alias("has_sentinel"),
    )
    found = found.withColumn("missing", F.array_sort(F.array_except(expected, "states"))).withColumn("unexpected", F.array_sort(F.array_except(F.array_remove("states", ""), expected)))
    said = [
        (F.col("rows") < least[0], f"fewer than {least[0]} rows"), (F.col("codes") < least[1], f"fewer than {least[1]} codes"), (F.col("empty_states") > 0, "rows without a state"),
        (F.size("missing") > 0, "missing states"), (F.size("unexpected") > 0, "unexpected states"), (~F.col("has_sentinel"), "the sentinel row is missing"),
    ]
    return found.withColumn("errors", F.array_compact(F.array(*[F.when(t, F.lit(m)) for t, m in said]))).drop("states")


def metadata_errors(table: DataFrame, expected: DataFrame) -> DataFrame:
    """(metadata_key, message) for faults of source metadata against (metadata_key, url, state_codes) as configured."""
    wanted = expected.select("metadata_key", F.col("url").alias("_url"), F.array_sort("state_codes").alias("_states"))
    told = wanted.join(table, "metadata_key", "full_outer")
    time = lambda c: text.parse_iso(c)
    checks = [
        (F.col("record_count").isNull() & F.col("url").isNull(), "missing"), (F.col("_url").isNull(), "not configured"), (F.col("url") != F.col("_url"), "unexpected url"),
        (F.coalesce("content_length", F.lit(0)) <= 0, "content length is not positive"), (~F.rlike(F.coalesce("md5", F.lit("")), F.lit("^[0-9a-f]{32}$")), "invalid md5"),
        (time("accepted_at").isNull(), "invalid accepted_at"), (time("verified_at").isNull(), "invalid verified_at"), (time("accepted_at") > time("verified_at"), "accepted after verified"),
        (F.coalesce("record_count", F.lit(0)) <= 0, "record count is not positive"), (F.coalesce("unique_post_code_count", F.lit(0)) <= 0, "code count is not positive"),
        (F.col("unique_post_code_count") > F.col("record_count"), "more codes than records"), (F.array_sort("state_codes") != F.col("_states"), "unexpected state codes"),
    ]
    said = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(m)) for t, m in checks]))
    said = F.when(F.col("url").isNull() & F.col("_url").isNotNull(), F.array(F.lit("missing"))).otherwise(said)
    return told.select("metadata_key", F.explode(said).alias("message"))


def artifact_errors(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, message): manifest entries (path, bytes, sha256) against binary files (path, content), both ways."""
    real = files.select("path", F.length("content").cast("long").alias("_bytes"), F.sha2("content", 256).alias("_sha256"))
    told = manifest.join(real, "path", "full_outer")
    checks = [
        (F.col("_bytes").isNull(), "file is missing"), (F.col("bytes").isNull(), "file is not in the manifest"),
        (F.col("bytes") != F.col("_bytes"), "size differs"), (F.col("sha256") != F.col("_sha256"), "digest differs"),
    ]
    return told.select("path", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(m)) for t, m in checks]))).alias("message"))
