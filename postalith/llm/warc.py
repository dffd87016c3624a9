"""Content-addressed web archive.

An archive is two tables. ``payloads`` holds each distinct payload once, compressed, under its SHA-256 digest;
``heads`` holds the exact header bytes of every record (WARC headers, blank line, HTTP headers, blank line) with the
digest of its payload. A record's bytes are its head, its payload if it is a response, and two line ends: a join.
Record ids hold the row's key and the payload's digest, so what is read back of either comes out of the records alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalith.llm.common import Scratch, join_hot

END = b"\r\n\r\n"


@dataclass
class Archive:
    """heads (digest, revisit, head), payloads (digest, stored), and the type of the rows' keys."""

    heads: DataFrame
    payloads: DataFrame
    kind: str


def _record_id(key: Column, digest: Column) -> Column:
    """A URI of a row: its key, percent-encoded, and its payload's digest."""
    named = F.coalesce(F.concat(F.lit("k"), F.replace(F.url_encode(key.cast("string")), F.lit("+"), F.lit("%20"))), F.lit("n"))
    return F.concat(F.lit("<urn:x-row:"), named, F.lit(":"), digest, F.lit(">"))


def _key_of(record_id: Column, kind: str) -> Column:
    """The key that a record id holds."""
    held = F.regexp_extract(record_id, r"^<urn:x-row:k([^:]*):", 1)
    return F.when(F.startswith(record_id, F.lit("<urn:x-row:k")), F.url_decode(held)).cast(kind)


def _compress(pages: DataFrame) -> DataFrame:
    """digest and payload of (page, raw): the digest is checked by whoever reads the payload back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            seen: dict[str, bytes] = {}
            for x in batch.column(0):
                raw = x.as_py()
                digest = hashlib.sha256(raw).hexdigest()
                if digest not in seen:
                    seen[digest] = press.compress(raw)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.binary())], names=["digest", "stored"])

    return pages.select("raw").mapInArrow(run, "digest string, stored binary")


def write(pages: DataFrame, scratch: Scratch, key: str = "page_id", url: str = "url", html: str = "html", least: int = 100, date: str = "2024-01-01T00:00:00Z") -> Archive:
    """Archive every row: of equal payloads of at least `least` bytes the smallest key's is a response, others revisit it.

    Null html is an empty payload; a null url leaves that header out; line ends in a url are percent-encoded. Rows
    that share key and payload are alike: all response or all revisit. A row with a null key never is the one that
    others revisit, unless all are null: then all are responses. Very long payloads are payloads like any other. An
    empty table gives an empty archive. Other columns, whatever their names, play no part. Raises if payloads of one
    digest differ in length or in a second hash: a revisit always stands for bytes that are stored.
    """
    raw = F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8")
    base = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), raw.alias("raw"))
    light = scratch.keep(base.select("key", "url", F.sha2("raw", 256).alias("digest"), F.octet_length("raw").cast("long").alias("bytes"), F.xxhash64("raw").alias("second")), "light")
    one = (F.min("bytes") == F.max("bytes")) & (F.min("second") == F.max("second"))
    first = light.groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("rows"), F.min("bytes").alias("size"), one.alias("one"))
    same = F.when(F.col("one"), F.col("least")).otherwise(F.raise_error(F.concat(F.lit("payloads differ under digest "), F.col("digest"))))
    first = scratch.keep(first.select("digest", "rows", F.when(F.col("size") >= least, same).alias("first")), "first")
    told = join_hot(light, first, "digest", "rows")
    again = F.coalesce(~F.col("key").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    safe = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    told = told.withColumn("revisit", again)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("key"), F.col("digest"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", safe), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(
            line("WARC-Refers-To", _record_id(F.col("first"), F.col("digest"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes"))).cast("string")),
        F.lit("\r\n"), http,
    )
    heads = scratch.keep(told.select("digest", "revisit", F.encode(head, "UTF-8").alias("head")), "heads")
    payloads = scratch.keep(_compress(base).groupBy("digest").agg(F.first("stored").alias("stored")), "payloads")
    scratch.drop("light", "first")
    return Archive(heads, payloads, base.schema["key"].dataType.simpleString())


def records(archive: Archive) -> DataFrame:
    """record: the original bytes of every record, put together again from heads and payloads."""
    joined = archive.heads.join(archive.payloads.select(F.col("digest").alias("_digest"), "stored"), (F.col("digest") == F.col("_digest")) & ~F.col("revisit"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for head, stored in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out.append(head + (press.decompress(stored) if stored is not None else b"") + END)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return joined.select("head", "stored").mapInArrow(run, "record binary")


def parse(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers (names in lower case; "" holds the version), HTTP headers, and payload of one record."""

    def fields(block: bytes) -> dict[str, str]:
        first, *lines = block.decode("utf-8", "surrogateescape").split("\r\n")
        return {"": first} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}

    top, _, rest = record.partition(END)
    head = fields(top)
    body = rest[: int(head["content-length"])]
    if rest[len(body) :] != END:
        raise ValueError("a record's length and its content differ")
    http, _, payload = body.partition(END)
    return head, fields(http), payload


def read(bytes_of: DataFrame, kind: str = "long") -> DataFrame:
    """Parse records (record), whose keys are of that type, and check every payload against its digest.

    Returns key and refers_to (the key of the record that a revisit refers to), both out of the records' ids, then
    record_id, record_type, refers_to_id, url, payload_digest, payload_bytes (of the full payload, as the HTTP headers
    have it) and payload (null for a revisit). Raises where length or digest are wrong. No records give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "record_type", "refers_to_id", "url", "payload_digest", "payload_bytes", "payload"]
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
        for batch in batches:
            rows = []
            for x in batch.column(0):
                head, http, payload = parse(x.as_py())
                digest = head["warc-payload-digest"].removeprefix("sha256:")
                full = head["warc-type"] == "response"
                if full and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
                    raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
                rows.append((head["warc-record-id"], head["warc-type"], head.get("warc-refers-to"), head.get("warc-target-uri"), digest, int(http["content-length"]), payload if full else None))
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    found = bytes_of.select("record").mapInArrow(run, "record_id string, record_type string, refers_to_id string, url string, payload_digest string, payload_bytes long, payload binary")
    return found.select(_key_of(F.col("record_id"), kind).alias("key"), _key_of(F.col("refers_to_id"), kind).alias("refers_to"), *found.columns)
