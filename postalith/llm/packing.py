"""Packing: shortest-pack-first over the length histogram.

Documents become token ids, are cut into pieces of at most the sequence length, and only the histogram of piece
lengths (at most one number per length) comes to the driver. There lengths are placed longest first, each into the
emptiest packs that have room, updating how many packs have each pattern. Patterns then meet the pieces by rank:
the r-th piece of a length fills the r-th place that the patterns hold for it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postalith.llm.common import Scratch, global_rank

END = 0

#: Fixed values of byte-level BPE: how texts are split before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _bytes_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """The ids that the tokenizers library gives for a byte-level BPE file as it stands, the file's added tokens included.

    The merging is done by tiktoken, about four times as fast, over the ranks of the same file. A test compares the
    two libraries on every character of Unicode and on texts that hold added tokens.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        back = _bytes_of()
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in file["added_tokens"]):
            raise ValueError("added tokens that look at the text around them are not known here")
        ranks = {bytes(back[c] for c in k): v for k, v in file["model"]["vocab"].items() if k not in special}
        self.fast = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        return [np.array(self.fast.encode(text, allowed_special="all"), dtype="<u4").tobytes() for text in texts]


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer: str, length: int = 1024, keep_ids: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut every document's ids, with id 0 at the end, into pieces of the sequence length and a rest.

    Returns doc_id, start, length, ids_crc32, doc_tokens, and ids (binary, little-endian unsigned 32-bit) if asked for.
    Null is the empty text, whose one id is 0. A repeated row gives its pieces again. Texts are cut, never shortened,
    whatever their length. An empty table gives an empty one; other columns play no part, whatever their names.
    """
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens"))])
    if keep_ids:
        schema = schema.add("ids", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        encoder = _encoders[tokenizer]
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [x or "" for x in batch.column(1).to_pylist()]
                rows, starts, sizes, crcs, totals, ids = [], [], [], [], [], []
                for i, own in enumerate(encoder.ids(texts)):
                    own += END.to_bytes(4, "little")
                    total = len(own) // 4
                    for start in range(0, total, length):
                        part = own[4 * start : 4 * (start + length)]
                        rows.append(i), starts.append(start), sizes.append(len(part) // 4)
                        crcs.append(zlib.crc32(part)), totals.append(total)
                        if keep_ids:
                            ids.append(part)
                out = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(v, pa.int64()) for v in (starts, sizes, crcs, totals))]
                yield pa.RecordBatch.from_arrays(out + ([pa.array(ids, pa.binary())] if keep_ids else []), names=schema.names)

    return docs.select(key, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def plan(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (piece lengths of a pack) and how many packs have each, from the numbers of pieces of each length.

    Lengths go longest first; each joins the packs with the most room left, and opens new ones when even those are
    too full. Work and result depend on the number of lengths, not of pieces.
    """
    open_: list[dict[tuple[int, ...], int]] = [{} for _ in range(length + 1)]  # by room left
    for size in sorted(histogram, reverse=True):
        todo = histogram[size]
        for room in range(length, size - 1, -1):
            if not todo:
                break
            # packs that take one piece move to a smaller room, which the loop reaches later
            packs = open_[room]
            while todo and packs:
                pattern, n = next(iter(packs.items()))
                k = min(n, todo)
                if k == n:
                    del packs[pattern]
                else:
                    packs[pattern] = n - k
                to = open_[room - size]
                new = (*pattern, size)
                to[new] = to.get(new, 0) + k
                todo -= k
        if todo:
            per = length // size
            full, rest = divmod(todo, per)
            for many, n in ((per, full), (rest, 1)):
                if many and n:
                    new, to = (size,) * many, open_[length - size * many]
                    to[new] = to.get(new, 0) + n
    return [(pattern, n) for packs in open_ for pattern, n in packs.items()]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: the first rank of each run of places, that run's first sequence, and the offset there."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for size in pattern:
            out.setdefault(size, []).append((used.get(size, 0), sequence, offset))
            used[size] = used.get(size, 0) + n
            offset += size
        sequence += n
    return {k: tuple(np.array(v, dtype=np.int64) for v in zip(*runs)) for k, runs in out.items()}


def pack(cut: DataFrame, scratch: Scratch, length: int = 1024, order: tuple[str, ...] = ("doc_id", "start", "ids_crc32")) -> DataFrame:
    """Add sequence_id and offset to pieces (with a column length); offsets in a sequence are gapless from 0.

    Which of equally long pieces fills which place follows the order columns; rows equal in all of them are
    interchangeable. Nothing is dropped, whatever the skew: ranks come from a range partition, not from a window.
    """
    cut = scratch.keep(cut, "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `length` rows
    runs = places(plan(histogram, length))
    before, total = {}, 0
    for size in sorted(histogram):
        before[size] = total
        total += histogram[size]
    ranked = global_rank(cut, ["length", *order], scratch, "ranked")
    schema = T.StructType([*cut.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    own_columns = cut.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                own = size == s
                first, start, off = runs[int(s)]
                r = rank[own] - before[int(s)]
                at = np.searchsorted(first, r, side="right") - 1
                sequence[own], offset[own] = start[at] + r - first[at], off[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in own_columns] + [pa.array(sequence), pa.array(offset)], names=schema.names
            )

    return ranked.mapInArrow(run, schema)


def padding(packed: pd.DataFrame, length: int = 1024) -> int:
    """Positions that hold no id: sequences are filled up to the length, but for those that end at a power of two."""
    used = packed.groupby("sequence_id")["length"].sum()
    exact = (used & (used - 1)) == 0
    return int((length - used[~exact]).sum())
