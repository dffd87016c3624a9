"""Postal-code analytics and corpus preparation on Spark DataFrames."""

from postalith.operators.records import dedupe as dedupe_records
from postalith.plans.schema import RECORD as POST_CODE_RECORD

__all__ = ["POST_CODE_RECORD", "dedupe_records"]
