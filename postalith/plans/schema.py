"""The published record and its keys."""

from pyspark.sql import types as T

FIELDS = (
    "code", "city", "country", "state", "county", "time_zone", "is_primary_location", "location_rank", "postal_code_rank", "source", "evidence_count",
)

RECORD = T.StructType([
    *(T.StructField(n, T.StringType()) for n in FIELDS[:6]),
    T.StructField("is_primary_location", T.BooleanType()),
    T.StructField("location_rank", T.IntegerType()),
    T.StructField("postal_code_rank", T.IntegerType()),
    T.StructField("source", T.StringType()),
    T.StructField("evidence_count", T.IntegerType()),
])

IDENTITY = FIELDS[:6]
BOUNDARY, FALLBACK = "postal_boundary", "address_fallback"
