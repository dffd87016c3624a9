import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postalith.functions import text
from postalith.operators import contracts, records
from postalith.plans.schema import BOUNDARY, FALLBACK, FIELDS

ZONE = "W. Europe Standard Time"


def frame(spark, rows):
    """Rows of (code, city, county, evidence, source)."""
    full = [(c, city, "DE", "Land", county, ZONE, source, n) for c, city, county, n, source in rows]
    return spark.createDataFrame(full, "code string, city string, country string, state string, county string, time_zone string, source string, evidence_count int")


def test_locations_and_codes_are_ranked_by_evidence(spark):
    rows = [("71540", "Fichtenberg", "", 4, BOUNDARY), ("74427", "Fichtenberg", "", 1149, BOUNDARY), ("71540", "Murrhardt", "", 4394, BOUNDARY)]
    got = {(r["code"], r["city"]): (r["location_rank"], r["postal_code_rank"], r["is_primary_location"]) for r in records.dedupe(frame(spark, rows)).collect()}
    assert got == {("71540", "Murrhardt"): (1, 1, True), ("71540", "Fichtenberg"): (2, 2, False), ("74427", "Fichtenberg"): (1, 1, True)}


def test_duplicates_keep_the_best_of_each_value(spark):
    rows = [("01067", "Dresden", "x", 9, FALLBACK), ("01067", "Dresden", "x", 3, BOUNDARY)]
    (got,) = records.dedupe(frame(spark, rows)).collect()
    assert (got["source"], got["evidence_count"], got["location_rank"]) == (BOUNDARY, 9, 1)


def test_ties_go_by_folded_names(spark):
    rows = [("1", "Ötz", "", 1, BOUNDARY), ("1", "ahr", "", 1, BOUNDARY), ("1", "Berg", "", 1, FALLBACK)]
    got = [r["city"] for r in records.dedupe(frame(spark, rows)).orderBy("location_rank").collect()]
    assert got == ["ahr", "Ötz", "Berg"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["10000", "20000"]), st.sampled_from(["A", "a", "B", "ß"]), st.sampled_from(["", "K"]), st.integers(0, 3), st.sampled_from([BOUNDARY, FALLBACK])), min_size=1, max_size=14))
def test_ranks_are_contiguous(spark, rows):
    found = records.dedupe(frame(spark, rows)).cache()
    assert contracts.rank_errors(found).count() == 0
    assert found.count() == len({r[:3] for r in rows})


def test_empty_input_gives_no_records(spark):
    found = records.dedupe(frame(spark, []))
    assert found.columns == list(FIELDS) and found.count() == 0


def test_normalize_tells_or_raises(spark):
    raw = spark.createDataFrame([(" 01067 ", "Dres  den", " de", "Sachsen", None, ZONE, "TRUE", "1", "1", BOUNDARY, "7"), ("1", "", "xx", "", "", "", "maybe", "-1", "1", "?", "x")], ", ".join(f"{c} string" for c in FIELDS))
    good, bad = sorted(records.normalize(raw, strict=False).collect(), key=lambda r: len(r["errors"]))
    assert (good["code"], good["city"], good["country"], good["county"], good["is_primary_location"], good["evidence_count"]) == ("01067", "Dres den", "DE", "", True, 7)
    assert len(bad["errors"]) >= 6
    with pytest.raises(Exception, match="invalid record"):
        records.normalize(raw).collect()


def test_boundary_labels(spark):
    rows = [("28195", "28195 Bremen (Central)", None), ("28195", "Bremen", "28195 A, B; C und D"), ("28195", "28195  ( x )", "28195 Y"), ("", "28195 Z", None)]
    df = spark.createDataFrame(rows, "code string, note string, name string")
    assert [r[0] for r in df.select(text.boundary_cities("code", "note", "name")).collect()] == [["Bremen"], ["A", "B", "C", "D"], ["Y"], []]


def test_fitting_and_times(spark):
    df = spark.createDataFrame([("Kirchdorf an der Krems bei Linz",), ("Short is different from Long",), ("Xyz",)], "c string")
    assert [r[0] for r in df.select(text.fit("c", 16)).collect()] == ["Kirchdorf", "Short", "Xyz"]
    one = spark.range(1)
    row = one.select(text.iso(F.expr("timestamp'2024-01-02 03:04:05'")), text.parse_iso(F.lit("2024-01-02T03:04:05")), text.md5_of(F.lit("A" * 32 + "  f")), text.change_ratio(F.lit(5), F.lit(0))).first()
    assert tuple(row) == ("2024-01-02T03:04:05Z", None, "a" * 32, None)
