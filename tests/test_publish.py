import json
import os
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.sql import functions as F

from postalith.operators import erp, publish
from postalith.plans.config import COUNTRIES
from postalith.plans.schema import FIELDS, RECORD
from postalith.sources import post_codes as pc

ZONE = "W. Europe Standard Time"
ROWS = [("04600", "Altenburg", "DE", "Thüringen", "", ZONE, True, 1, 1, "postal_boundary", 0), ("01067", "Dresden & <co>", "DE", "Sachsen", "K", ZONE, True, 1, 1, "address_fallback", 7)]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(ROWS, RECORD)


def test_three_formats_hold_the_same(spark, records, tmp_path):
    assert publish.write_public(records, tmp_path, "Title") == 2
    text = (tmp_path / "post_code.csv").read_text("utf-8")
    assert text.splitlines()[0] == ",".join(FIELDS) and text.splitlines()[2] == f"04600,Altenburg,DE,Thüringen,,{ZONE},true,1,1,postal_boundary,0"
    found = json.loads((tmp_path / "post_code.json").read_text("utf-8"))
    assert found["title"] == "Title" and [tuple(r.values()) for r in found["records"]] == sorted(ROWS)
    root = ET.parse(tmp_path / "post_code.xml").getroot()
    assert [[x.text or "" for x in r] for r in root] == [line.split(",") for line in text.splitlines()[1:]]
    back = pc.read_records(spark, str(tmp_path / "post_code.csv"))
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)
    described = {os.path.basename(r["path"]): r["records"] for r in publish.describe(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert described == {"post_code.csv": 2, "post_code.json": 2, "post_code.xml": 2}


def test_wrong_headers_raise(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception):
        pc.read_records(spark, str(tmp_path / "x.csv")).collect()


def test_files_change_together_or_not_at_all(tmp_path):
    old, new = tmp_path / "old", tmp_path / "new"
    old.write_text("1")
    a, b = tmp_path / "a", tmp_path / "b"
    a.write_text("2"), b.write_text("3")

    def fail(origin, target):
        if target == new:
            raise OSError("disk")
        os.replace(origin, target)

    with pytest.raises(OSError):
        publish.replace_together({a: old, b: new}, fail)
    assert old.read_text() == "1" and not new.exists() and a.exists()
    with pytest.raises(OSError):
        publish.replace_together({a: old, tmp_path / "nowhere": new})
    assert old.read_text() == "1" and not new.exists()
    # a killed run: the old file is aside, the new one has not come in
    os.replace(old, tmp_path / "old.old~")
    (tmp_path / "old.new~").write_text("half")
    publish.replace_together({b: new})
    publish.replace_together({a: old})
    assert (old.read_text(), new.read_text()) == ("2", "3")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["new", "old"]
    with pytest.raises(ValueError):
        publish.replace_together({a: old, b: old})
    with pytest.raises(ValueError):
        publish.check_roots(tmp_path, tmp_path / "x")


def test_package_has_digests(records, tmp_path):
    for c in COUNTRIES.values():
        publish.write_public(records, publish.public_folder(tmp_path / "in", c), c.name)
    manifest = publish.package(tmp_path / "in", None, tmp_path / "out", "/api/v1", "2024-01-01T00:00:00Z")
    assert len(manifest["files"]) == 9 and {f["records"] for f in manifest["files"]} == {2} and manifest["data_refreshed_at"] is None
    assert (tmp_path / "out/api/v1/de/post_code.csv.gz").exists() and (tmp_path / "out/api/v1/index.json").exists()
    out = tmp_path / "out"
    assert publish.package_errors(out, "/api/v1") == []
    file = out / "api/v1/de/post_code.csv"
    file.write_bytes(file.read_bytes() + b"x\n")
    (out / "api/v1/at/post_code.xml.gz").write_bytes(b"no")
    manifest["files"] = [*manifest["files"][:-1], manifest["files"][0], {"path": "extra"}, {}]
    publish.write_json_atomically(manifest | {"version": "v2"}, out / "api/v1/index.json")
    said = publish.package_errors(out, "/api/v1")
    assert {"version is not 'v1'", "an entry has no path", "de/post_code.csv: two entries", "extra: not expected", "de/post_code.csv: sha256 differs", "de/post_code.csv: lines differs", "de/post_code.csv: the compressed file holds something else"} <= set(said)
    assert any(x.startswith("ch/post_code.xml: missing") for x in said) and any(x.startswith("at/post_code.xml: ") for x in said)
    assert publish.package_errors(tmp_path / "none", "/api/v1")[0].startswith("manifest: ")


def test_the_csv_sink_merges_and_ranks(spark, records, tmp_path):
    assert publish.write_csv(records.unionByName(records).withColumn("location_rank", F.lit(9)), tmp_path / "x.csv") == 2
    assert ",1,1,postal_boundary,0" in (tmp_path / "x.csv").read_text("utf-8")


def test_metadata_documents(spark, tmp_path):
    path = tmp_path / "m.json"
    assert pc.load_metadata(spark, str(path))[0] == ""
    path.write_text(json.dumps({"generated_at": "t", "regions": {"bremen": {"url": "u", "content_length": 5, "md5": "m", "records": 3, "unique_post_codes": 2}}}))
    at, table = pc.load_metadata(spark, str(path))
    row = table.first()
    assert (at, row["record_count"], row["unique_post_code_count"]) == ("t", 3, 2)
    assert pc.encode(row) == {"url": "u", "content_length": 5, "md5": "m", "record_count": 3, "unique_post_code_count": 2}
    path.write_text("{")
    with pytest.raises(pc.MetadataDocumentError):
        pc.load_metadata(spark, str(path))


def template(path):
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(erp.SHEET, f'<worksheet xmlns="{ns}"><sheetData><row r="9"/></sheetData></worksheet>')
        z.writestr(erp.TABLE, f'<table xmlns="{ns}" ref="A1"><autoFilter ref="A1"/></table>')
        z.writestr("other.xml", "<x/>")


def test_workbook(spark, records, tmp_path):
    more = records.withColumn("city", F.concat("city", F.lit(" is different from another"))).withColumn("code", F.lit("09999")).limit(1)
    second = records.withColumn("is_primary_location", F.lit(False))
    exported = erp.rows(records.unionByName(more).unionByName(second), ["DE"])
    assert [(r["Code"], r["Ort"], r["Suchbegriff (Ort)"]) for r in exported.collect()] == [
        ("01067", "Dresden & <co>", "DRESDEN & <CO>"), ("04600", "Altenburg", "ALTENBURG"), ("09999", "Altenburg", "ALTENBURG"),
    ]
    template(tmp_path / "t.xlsx")
    assert erp.write_workbook(exported, tmp_path / "t.xlsx", tmp_path / "o.xlsx") == 3
    with zipfile.ZipFile(tmp_path / "o.xlsx") as z:
        table, sheet = ET.fromstring(z.read(erp.TABLE)), ET.fromstring(z.read(erp.SHEET))
        assert table.get("ref") == "A3:F6" and table[0].get("ref") == "A3:F6" and z.read("other.xml") == b"<x/>"
        cells = [[(c.get("r"), "".join(c.itertext())) for c in row] for row in sheet[0]]
        assert [r[0][0] for r in cells] == ["A1", "A3", "A4", "A5", "A6"] and cells[2][1] == ("B4", "Dresden & <co>") and cells[4][0] == ("A6", "09999")
    assert erp.write_workbook(exported.limit(0), tmp_path / "t.xlsx", tmp_path / "e.xlsx") == 0
    assert sorted(p.name for p in tmp_path.iterdir()) == ["e.xlsx", "o.xlsx", "t.xlsx"]
    assert "Exported primary rows: 3" in erp.guardrails(records, exported, "o.xlsx")
    with pytest.raises(ValueError, match="duplicate"):
        erp.write_workbook(exported.union(exported), tmp_path / "t.xlsx", tmp_path / "p.xlsx")
    long = records.withColumn("city", F.lit("x" * 31))
    with pytest.raises(Exception, match="Ort"):
        erp.rows(long, ["DE"]).collect()
