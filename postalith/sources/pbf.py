"""Map objects from OSM PBF files, one Spark partition for each run of blobs.

The driver reads the blob headers alone; executors read, inflate and decode their blobs from the shared path.
"""

from __future__ import annotations

import glob
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from postalith.ship import ship
from postalith.sources.osm import assemble

SCHEMA = "kind string, _id bigint, _lat double, _lon double, refs array<bigint>, member array<struct<_type:string,_ref:bigint,_role:string>>, tags map<string,string>"
#: Bytes of blobs in a partition.
PART = 32 << 20
_KINDS = ("node", "way", "relation")


def varints(data: bytes) -> np.ndarray:
    """All unsigned numbers of a packed field."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64), starts)


def signed(numbers: np.ndarray) -> np.ndarray:
    return (numbers >> np.uint64(1)).astype(np.int64) ^ -(numbers & np.uint64(1)).astype(np.int64)


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message: varints as numbers, the rest as bytes."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < end:
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


def _one(n: int) -> int:
    return (n >> 1) ^ -(n & 1)


def _tags(keys: bytes, values: bytes, strings: list[str]) -> dict[str, str]:
    return {strings[k]: strings[v] for k, v in zip(varints(keys).tolist(), varints(values).tolist())}


def decode(block: bytes) -> Iterator[tuple]:
    """Rows of one primitive block."""
    strings: list[str] = []
    groups, grain, lat0, lon0 = [], 100, 0, 0
    for n, v in fields(block):
        if n == 1:
            strings = [s.decode("utf-8", "replace") for m, s in fields(v) if m == 1]
        elif n == 2:
            groups.append(v)
        elif n == 17:
            grain = v
        elif n == 19:
            lat0 = v - (1 << 64) if v >> 63 else v
        elif n == 20:
            lon0 = v - (1 << 64) if v >> 63 else v
    place = lambda v, zero: (zero + grain * v) * 1e-9
    for group in groups:
        for n, v in fields(group):
            if n == 2:
                dense = dict(fields(v))
                ids, lats, lons = (np.cumsum(signed(varints(dense.get(k, b"")))) for k in (1, 8, 9))
                pairs, at = varints(dense.get(10, b"")).tolist(), 0
                for i, lat, lon in zip(ids.tolist(), place(lats, lat0).tolist(), place(lons, lon0).tolist()):
                    tags = {}
                    while at < len(pairs) and pairs[at]:
                        tags[strings[pairs[at]]] = strings[pairs[at + 1]]
                        at += 2
                    at += 1
                    yield "node", i, lat, lon, None, None, tags
                continue
            if n not in (1, 3, 4):
                continue
            own = dict(fields(v))
            tags = _tags(own.get(2, b""), own.get(3, b""), strings)
            if n == 1:
                yield "node", _one(own[1]), place(_one(own[8]), lat0), place(_one(own[9]), lon0), None, None, tags
            elif n == 3:
                yield "way", own[1], None, None, np.cumsum(signed(varints(own.get(8, b"")))).tolist(), None, tags
            else:
                refs = np.cumsum(signed(varints(own.get(9, b"")))).tolist()
                roles, kinds = varints(own.get(8, b"")).tolist(), varints(own.get(10, b"")).tolist()
                yield "relation", own[1], None, None, None, [(_KINDS[k], r, strings[role]) for k, r, role in zip(kinds, refs, roles)], tags


def blobs(path: str) -> Iterator[tuple[int, int]]:
    """Place and size of each data blob of a file."""
    with open(path, "rb") as f:
        while head := f.read(4):
            header = dict(fields(f.read(struct.unpack(">i", head)[0])))
            at = f.tell()
            if header[1] == b"OSMData":
                yield at, header[3]
            f.seek(at + header[3])


def inflate(blob: bytes) -> bytes:
    found = dict(fields(blob))
    if 1 in found:
        return found[1]
    if 3 in found:
        return zlib.decompress(found[3])
    raise ValueError("a blob is neither plain nor zlib-compressed")


class _Part(InputPartition):
    def __init__(self, path: str, places: list[tuple[int, int]]):
        self.path, self.places = path, places


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[_Part]:
        found = []
        for path in sorted(glob.glob(self.path)) or [self.path]:
            held, size = [], 0
            for at, n in blobs(path):
                held.append((at, n))
                size += n
                if size >= PART:
                    found.append(_Part(path, held))
                    held, size = [], 0
            if held:
                found.append(_Part(path, held))
        return found or [_Part("", [])]

    def read(self, part: _Part) -> Iterator[tuple]:
        if part.places:
            with open(part.path, "rb") as f:
                for at, n in part.places:
                    f.seek(at)
                    yield from decode(inflate(f.read(n)))


class PbfSource(DataSource):
    """spark.read.format("osm_pbf").load(path): every node, way and relation; path may be a pattern."""

    @classmethod
    def name(cls) -> str:
        return "osm_pbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"].removeprefix("file://"))


def read_pbf(spark: SparkSession, path: str) -> DataFrame:
    """(seq, kind, tags, rings, px, py) of all objects with a boundary or addr:postcode key, as from XML."""
    ship(spark)
    spark.dataSource.register(PbfSource)
    rows = spark.read.format("osm_pbf").load(path)
    kind = lambda k: rows.where(F.col("kind") == k)
    return assemble(kind("node").select("_id", "_lat", "_lon", "tags"), kind("way").select("_id", "refs", "tags"), kind("relation").select("_id", "member", "tags"))
