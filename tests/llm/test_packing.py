import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postalith.llm import packing
from postalith.llm.common import Scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def exact():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch_fast(texts, add_special_tokens=False)]


def test_both_libraries_split_every_character_alike(exact):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    texts = ["\n".join(f"a{c}1{c} {c}a.{c}" for c in every[at : at + 4096]) for at in range(0, len(every), 4096)]
    assert packing.Encoder(PATH).ids(texts) == exact(texts)


def test_odd_texts(exact):
    texts = ["", "  a b", " x", "a  b", "a \nb", "é  b", "x" * 5000, "<|endoftext|> a", "日本 語 😀 a😀b"]
    assert packing.Encoder(PATH).ids(texts) == exact(texts)


def test_added_tokens_are_single_ids(exact):
    end = "<|endoftext|>"
    texts = [end, f"a{end}b", f"{end}a b", f"a b {end}", f"{end}{end}", f" {end} {end}\n", f"x {end}  y", "<|endoftext|", f"<|{end}|>", f"don{end}'t"]
    got = packing.Encoder(PATH).ids(texts)
    assert got == exact(texts)
    assert np.frombuffer(got[1], "<u4").tolist() == [64, 50256, 65]


def test_padding_is_small_and_very_long_texts_are_cut(spark, exact):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, "long words of a text " * 60_000)], docs.schema))
    rows = packing.pack(packing.pieces(docs, PATH), Scratch(spark, "t")).select("doc_id", "start", "length", "doc_tokens", "sequence_id").toPandas()
    assert packing.padding(rows) < 0.01 * rows["length"].sum()
    long = rows[rows["doc_id"] == -1].sort_values("start")
    assert long["length"].sum() == long["doc_tokens"].iloc[0] == len(exact(["long words of a text " * 60_000])[0]) // 4 + 1
    assert (long["length"].iloc[:-1] == 1024).all()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=32))
def test_plan_places_every_piece_once(histogram):
    patterns = packing.plan(histogram, 32)
    placed = Counter()
    for pattern, n in patterns:
        assert sum(pattern) <= 32 and n > 0
        for size in pattern:
            placed[size] += n
    assert placed == Counter(histogram)
    for size, (first, sequence, offset) in packing.places(patterns).items():
        assert list(first) == sorted(first) and first[0] == 0 and len(first) == len(sequence) == len(offset)


def test_pack_is_an_exact_round_trip(spark, exact):
    texts = ["a b c " * 900, "", None, "x", "a b c " * 900, "Ünï " * 300, "x"]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, length string")
    rows = packing.pack(packing.pieces(docs, PATH, 256, keep_ids=True), Scratch(spark, "t"), 256).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        assert got.setdefault(r["doc_id"], b"").__len__() == 4 * r["start"]
        got[r["doc_id"]] += bytes(r["ids"])
    assert got == {i: x + b"\0\0\0\0" for i, x in enumerate(exact([t or "" for t in texts]))}
    at = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert at.get(r["sequence_id"], 0) == r["offset"]
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 256 and sorted(at) == list(range(len(at)))


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(docs, PATH), Scratch(spark, "t")).count() == 0
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a")], "doc_id long, text string")
    rows = packing.pack(packing.pieces(docs, PATH), Scratch(spark, "t")).collect()
    assert len(rows) == 3 and sorted(r["offset"] for r in rows) == [0, 2, 4]
