import pytest
from pyspark.sql import functions as F

from postalith.operators import contracts, gates
from postalith.plans.config import COUNTRIES, STATES, country, selection, sources
from postalith.plans.schema import FIELDS, RECORD

ZONE = "W. Europe Standard Time"


def volume(spark, records, codes, states, c="DE"):
    """Records over so many codes, going round the states."""
    names = F.array(*[F.lit(s) for s in states])
    i = F.col("id")
    return spark.range(records).select(
        F.lpad((i % codes).cast("string"), 5, "0").alias("code"), F.concat(F.lit("City "), i).alias("city"), F.lit(c).alias("country"),
        F.element_at(names, (i % len(states)).cast("int") + 1).alias("state"), F.lit("").alias("county"), F.lit(ZONE).alias("time_zone"), F.lit(True).alias("is_primary_location"),
        F.lit(1).alias("location_rank"), F.lit(1).alias("postal_code_rank"), F.lit("postal_boundary").alias("source"), F.lit(1).alias("evidence_count"),
    )


def test_metrics_count_states_and_faults(spark):
    rows = volume(spark, 6, 3, ["Bremen", "", "Nowhere"])
    row = gates.metrics(rows.unionByName(volume(spark, 1, 1, ["Bremen"], "AT")), COUNTRIES["DE"]).first()
    assert (row["records"], row["codes"], row["empty_states"], row["wrong_country"], row["unknown_states"]) == (7, 3, 2, 1, ["Nowhere"])
    assert row["state_counts"]["DE-HB"] == 3 and row["state_counts"]["DE-BE"] == 0


@pytest.mark.parametrize(("now", "errors", "warnings"), [(1000, 0, 0), (920, 0, 1), (840, 1, 0), (1300, 1, 0), (1130, 0, 1)])
def test_source_changes(spark, now, errors, warnings):
    c, source = COUNTRIES["DE"], next(s for s in sources() if s.name == "bremen")
    base = gates.metrics(volume(spark, 1000, 100, ["Bremen"]), c)
    row = gates.source_gate(gates.metrics(volume(spark, now, 100, ["Bremen"]), c), c, source, base).first()
    assert (len(row["errors"]), len(row["warnings"]), row["valid"]) == (errors, warnings, not errors)


def test_source_states(spark):
    c, source = COUNTRIES["DE"], next(s for s in sources() if s.name == "brandenburg")
    judge = lambda states: gates.source_gate(gates.metrics(volume(spark, 10, 10, states), c), c, source).first()["errors"]
    assert judge(["Brandenburg", "Berlin"]) == []
    assert any("missing required" in e for e in judge(["Brandenburg"]))
    assert any("primary" in e for e in judge(["Berlin"]))
    assert any("unexpected" in e for e in judge(["Brandenburg", "Berlin", "Hessen"]))
    assert gates.observed_errors(("DE-BB", "DE-XX", "DE-HE"), c, source) == ["unknown state codes: DE-XX", "unexpected state codes: DE-HE", "missing embedded state codes: DE-BE"]


def test_country_floors(spark):
    c = COUNTRIES["DE"]
    judge = lambda n: gates.country_gate(gates.metrics(volume(spark, n, 8500, list(STATES["DE"].values())), c), c).first()
    assert judge(9000)["valid"] and judge(9000)["warnings"] == []
    assert any("within 5%" in w for w in judge(8200)["warnings"])
    assert len(judge(7900)["errors"]) == 1
    assert any("missing states" in e for e in gates.country_gate(gates.metrics(volume(spark, 9000, 8500, ["Bremen"]), c), c).first()["errors"])


def test_contracts_name_what_is_wrong(spark):
    good = volume(spark, 3, 3, ["Bremen"])
    assert contracts.rank_errors(good).count() == 0
    bad = good.withColumn("location_rank", F.lit(2)).withColumn("is_primary_location", F.lit(False))
    assert contracts.rank_errors(bad).count() == 6
    raw = good.select(*[F.col(c).cast("string") for c in FIELDS]).withColumn("row", F.lit(7)).withColumn("code", F.lit("1"))
    assert {r["message"] for r in contracts.row_errors(raw, "de.csv").collect()} == {"de.csv:7: invalid code"}
    row = contracts.floors(good, COUNTRIES["DE"], (5, 2), {"code": "00001"}).first()
    assert row["has_sentinel"] and "fewer than 5 rows" in row["errors"] and len(row["missing"]) == 15


def test_metadata_and_artifacts(spark):
    from postalith.sources.post_codes import METADATA

    row = ("bremen", "u", 1, None, None, "a" * 32, "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", 5, 4, ["DE-HB"])
    bad = ("hamburg", "v", 0, None, None, "zz", "2024-01-03T00:00:00Z", "2024-01-02T00:00:00", 5, 6, ["DE-HB"])
    want = spark.createDataFrame([("bremen", "u", ["DE-HB"]), ("hamburg", "w", ["DE-HH"]), ("berlin", "x", ["DE-BE"])], "metadata_key string, url string, state_codes array<string>")
    said = contracts.metadata_errors(spark.createDataFrame([row, bad], METADATA), want).collect()
    assert {r["metadata_key"] for r in said} == {"hamburg", "berlin"} and len([r for r in said if r["metadata_key"] == "hamburg"]) == 6
    manifest = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "path string, bytes long, sha256 string")
    files = spark.createDataFrame([("a", bytearray(b"12")), ("c", bytearray(b""))], "path string, content binary")
    assert sorted(map(tuple, contracts.artifact_errors(manifest, files).collect())) == [("a", "digest differs"), ("a", "size differs"), ("b", "file is missing"), ("c", "file is not in the manifest")]


def test_configuration():
    assert [len(STATES[c]) for c in ("DE", "AT", "CH")] == [16, 9, 26] and len(sources()) == 18
    assert country(" De ").code == "DE" and len(sources(["at"])) == 1
    assert selection(" a,,b ", ["a", "b"], "x") == ["a", "b"] and selection(None, ["a"], "x") == ["a"]
    with pytest.raises(ValueError):
        selection("q", ["a"], "x")
    with pytest.raises(ValueError):
        country("fr")
    assert RECORD.fieldNames() == list(FIELDS)


def test_rows_of_a_file_are_numbered(spark, tmp_path):
    from postalith.plans.schema import FIELDS
    from postalith.sources.post_codes import read_text

    good = "04600,Altenburg,DE,Thüringen,,W. Europe Standard Time,true,1,1,postal_boundary,0"
    lines = [",".join(FIELDS), *[good] * 500, good.replace("04600", "x"), *[good] * 500, good.replace("true", "no")]
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    found = contracts.row_errors(read_text(spark, str(tmp_path / "f.csv")), "f.csv")
    assert sorted(r["message"] for r in found.collect()) == ["f.csv:1003: is_primary_location is not a boolean", "f.csv:502: invalid code"]
