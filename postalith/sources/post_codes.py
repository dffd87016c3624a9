"""Published records from CSV files, and their source metadata."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postalith.operators.records import dedupe, normalize
from postalith.plans.config import Country
from postalith.plans.schema import FIELDS, RECORD

TEXT = T.StructType([T.StructField(n, T.StringType()) for n in FIELDS])
METADATA = T.StructType([
    T.StructField("metadata_key", T.StringType()), T.StructField("url", T.StringType()), T.StructField("content_length", T.LongType()),
    *(T.StructField(n, T.StringType()) for n in ("etag", "last_modified", "md5", "accepted_at", "verified_at")),
    T.StructField("record_count", T.IntegerType()), T.StructField("unique_post_code_count", T.IntegerType()), T.StructField("state_codes", T.ArrayType(T.StringType())),
])


class MetadataDocumentError(ValueError):
    """A metadata document is malformed."""


def read_text(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows as text, codes with their zeros; a wrong header raises, empty fields are ''."""
    rows = spark.read.option("header", True).option("enforceSchema", False).schema(TEXT).csv(list(paths))
    return rows.fillna("")


def read_records(spark: SparkSession, *paths: str) -> DataFrame:
    """Valid records of CSV files, merged and ranked again; an invalid row raises."""
    return dedupe(normalize(read_text(spark, *paths)))


def read_countries(spark: SparkSession, root: str, countries: list[Country]) -> DataFrame:
    """Published records of several countries in one scan; a missing file raises."""
    paths = [Path(root) / c.slug / "post_code.csv" for c in countries]
    missing = [str(p) for p in paths if not p.is_file()]
    if missing:
        raise FileNotFoundError(f"missing public files: {', '.join(missing)}")
    return normalize(read_text(spark, *map(str, paths)))


def combined(spark: SparkSession, paths: dict[str, str], overrides: dict[str, DataFrame]) -> DataFrame:
    """Union of sources, each fresh where an override has rows, else from its file."""
    found = None
    for name, path in paths.items():
        own = overrides.get(name)
        if own is None or not own.limit(1).count():
            own = normalize(read_text(spark, path))
        found = own if found is None else found.unionByName(own)
    if found is None:
        return spark.createDataFrame([], RECORD)
    return dedupe(found)


def prefer(fresh: DataFrame, rest: DataFrame, key: str) -> DataFrame:
    """Rows of the first table, and those of the second whose key the first does not have."""
    return fresh.unionByName(rest.join(fresh.select(key).distinct(), key, "left_anti"))


def load_metadata(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """(generated_at, rows by metadata_key). A missing file gives no rows; legacy names are read; what is malformed raises."""
    file = Path(path)
    if not file.exists():
        return "", spark.createDataFrame([], METADATA)
    try:
        document = json.loads(file.read_text("utf-8"))
        regions = document["regions"]
        rows = [_decode(k, v) for k, v in regions.items()]
    except (ValueError, KeyError, TypeError, AttributeError) as e:
        raise MetadataDocumentError(f"{path}: {e}") from e
    return str(document.get("generated_at") or ""), spark.createDataFrame(rows, METADATA)


def _decode(key: str, value: dict) -> tuple:
    count = value.get("record_count", value.get("records"))
    codes = value.get("unique_post_code_count", value.get("unique_post_codes"))
    text = [value.get(n) or None for n in ("etag", "last_modified", "md5", "accepted_at", "verified_at")]
    return (key, value["url"], int(value["content_length"]), *text, count, codes, list(value.get("state_codes") or []))


def encode(row) -> dict:
    """A metadata row as a document; empty optional fields are left out."""
    return {k: v for k, v in row.asDict().items() if k != "metadata_key" and v not in (None, "", [])}


def changes(previous: DataFrame, observed: DataFrame) -> DataFrame:
    """(metadata_key, status): unchanged where url, length, etag, time and md5 agree (nulls too), else fresh, new or gone."""
    keys = ("url", "content_length", "etag", "last_modified", "md5")
    old, new = (df.select("metadata_key", F.struct(*keys).alias(n)) for df, n in ((previous, "old"), (observed, "new")))
    told = old.join(new, "metadata_key", "full_outer")
    status = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "gone").when(F.col("old").eqNullSafe(F.col("new")), "unchanged").otherwise("fresh")
    return told.select("metadata_key", status.alias("status"))
