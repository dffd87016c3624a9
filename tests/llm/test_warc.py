import hashlib

import pytest

from postalith.llm import warc
from postalith.llm.common import Scratch

BIG = "<p>" + "ä" * 60 + "</p>"
ROWS = [(5, "http://a/1", BIG), (3, "http://a/2", BIG), (9, None, BIG), (1, "http://b/\r\nx", "small"), (2, "u", "small"), (4, "u", None), (6, "u", ""), (7, "u", "x" * 100_000), (None, "u", BIG), (3, "http://a/2", BIG)]


@pytest.fixture(scope="module")
def archive(spark):
    return warc.write(spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, digest string"), Scratch(spark, "t"))


def test_records_come_back(archive):
    got = warc.read(warc.records(archive)).collect()
    assert len(got) == len(ROWS)
    want = sorted((str(k), len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for k, _, h in ROWS)
    assert sorted((str(r["key"]), r["payload_bytes"], r["payload_digest"]) for r in got) == want
    kinds = {(r["key"], r["record_type"], r["refers_to"]) for r in got}
    assert kinds == {(3, "response", None), (5, "revisit", 3), (9, "revisit", 3), (None, "revisit", 3)} | {(k, "response", None) for k in (1, 2, 4, 6, 7)}
    ids = {r["record_id"]: r["key"] for r in got}
    assert all(ids[r["refers_to_id"]] == 3 for r in got if r["record_type"] == "revisit")
    assert {r["url"] for r in got if r["key"] in (1, 9)} == {None, "http://b/%0D%0Ax"}


def test_each_payload_is_stored_once(archive):
    assert archive.payloads.count() == len({(h or "") for _, _, h in ROWS})


def test_damage_is_noticed(archive):
    record = max((bytes(r["record"]) for r in warc.records(archive).collect()), key=len)
    head, http, payload = warc.parse(record)
    assert head["warc-record-id"].startswith("<urn:x-row:k7:")
    assert head["warc-type"] == "response" and payload == b"x" * 100_000
    with pytest.raises(ValueError):
        warc.parse(record[:-9])


def test_keys_come_out_of_the_records(spark):
    rows = [("a b:c>%\r\né", "u", BIG), ("", "u", BIG), (None, "u", BIG), ("z", "u", "small")]
    found = warc.write(spark.createDataFrame(rows, "page_id string, url string, html string"), Scratch(spark, "t"))
    records = warc.records(found)
    assert records.columns == ["record"]
    got = {(r["key"], r["record_type"], r["refers_to"]) for r in warc.read(records, found.kind).collect()}
    assert got == {("", "response", None), ("a b:c>%\r\né", "revisit", ""), (None, "revisit", ""), ("z", "response", None)}


def test_empty_table(spark):
    found = warc.write(spark.createDataFrame([], "page_id long, url string, html string"), Scratch(spark, "t"))
    assert warc.read(warc.records(found)).count() == 0
