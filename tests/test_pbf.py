import struct
import zlib

import numpy as np
from test_extract import area, basis

from postalith.operators import extract as ex
from postalith.plans.config import COUNTRIES
from postalith.sources import osm, pbf


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def zigzag(n):
    return n << 1 if n >= 0 else (-n << 1) - 1


def field(n, value):
    return varint(n << 3) + varint(value) if isinstance(value, int) else varint(n << 3 | 2) + varint(len(value)) + value


def packed(values):
    return b"".join(varint(v) for v in values)


def deltas(values):
    return packed(zigzag(b - a) for a, b in zip([0, *values], values))


def encode(doc, dense, compress):
    """A test document's parts as a PBF file."""
    strings, at = [""], {"": 0}

    def s(text):
        if text not in at:
            at[text] = len(strings)
            strings.append(text)
        return at[text]

    nodes, groups = [], []
    for head, tags, inner in doc.parts:
        tags = {k.replace("__", ":"): v for k, v in tags.items()}
        number = lambda name: float(head.split(f'{name}="')[1].split('"')[0])
        pairs = field(2, packed(map(s, tags))) + field(3, packed(map(s, tags.values())))
        if head.startswith("<node"):
            place = [round(number(n) * 1e7) for n in ("lat", "lon")]
            nodes.append((int(number("id")), *place, tags))
            if not dense:
                groups.append(field(1, field(1, zigzag(nodes[-1][0])) + pairs + field(8, zigzag(place[0])) + field(9, zigzag(place[1]))))
        else:
            refs = [int(x.split('"')[0]) for x in inner.split('ref="')[1:]]
            groups.append(field(3, field(1, int(number("id"))) + pairs + field(8, deltas(refs))))
    if dense:
        keys = packed(x for *_, tags in nodes for x in [*(v for k, t in tags.items() for v in (s(k), s(t))), 0])
        groups.insert(0, field(2, b"".join(field(n, deltas([r[i] for r in nodes])) for i, n in enumerate((1, 8, 9))) + field(10, keys)))
    groups.append(field(4, field(1, 7) + field(2, packed([s("type")])) + field(3, packed([s("multipolygon")])) + field(8, packed([s("outer")])) + field(9, deltas([5])) + field(10, packed([1]))))
    block = field(1, b"".join(field(1, x.encode()) for x in strings)) + b"".join(field(2, g) for g in groups)
    blob = field(2, len(block)) + field(3, zlib.compress(block)) if compress else field(1, block)
    out = b""
    for kind, data in ((b"OSMHeader", field(1, b"x")), (b"OSMData", blob)):
        header = field(1, kind) + field(3, len(data))
        out += struct.pack(">i", len(header)) + header + data
    return out


def test_pbf_gives_what_xml_gives(spark, tmp_path):
    d = basis()
    area(d, 4, 1, 6, 2, "28200", "28200 Town")
    for _ in range(3):
        d.node(-1.5 + 3, 1.25, addr__postcode="33333", addr__city="Gütersloh")
    want = ex.extract(osm.read_xml(spark, d.write(tmp_path / "m.osm")), COUNTRIES["DE"]).records.collect()
    for dense, compress in ((True, True), (False, False)):
        (tmp_path / "m.pbf").write_bytes(encode(d, dense, compress))
        got = ex.extract(pbf.read_pbf(spark, str(tmp_path / "m.pbf")), COUNTRIES["DE"]).records.collect()
        assert sorted(got) == sorted(want) and len(got) == 3


def test_numbers():
    values = [0, 1, 127, 128, 300, 2**40, 2**63]
    assert pbf.varints(packed(values)).tolist() == values
    assert pbf.signed(np.array([zigzag(v) for v in (0, -1, 5, -(2**40))], np.uint64)).tolist() == [0, -1, 5, -(2**40)]
