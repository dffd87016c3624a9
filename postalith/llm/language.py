"""Language of texts and of their parts.

The script ranges of a word's letters narrow the languages it may be in: those that hardly use one of them are out,
unless that leaves none. Hashed character pairs and triples score it in each; Viterbi with a penalty for each change labels spans of mixed text. A text whose best single language no
stretch of words outweighs by the penalty needs no search: one span is then the best path.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that training uses, about: as many of each language, chosen by the hash of their key; and languages it learns
#: at most, the most frequent ones.
TAUGHT, LANGUAGES = 6_000, 200
BUCKETS = 1 << 16
#: Cost of a change of language, in nats; what puts a word out of a language that hardly uses a range of its letters.
SWITCH, OUT = 12.0, 1e4
#: Share of a language's letters that a range must hold for the language to stay a candidate.
RARE = 2e-4
SMOOTH = 0.05
#: Characters scored at a time, for four languages.
CHUNK = 1_000_000
UND = "und"

#: First code points of the ranges that tell scripts apart.
RANGES = np.array([
    0x0000, 0x0080, 0x00DF, 0x00E0, 0x00E4, 0x00E5, 0x00E7, 0x00E8, 0x00F1, 0x00F2, 0x00F6, 0x00F7, 0x00FC, 0x00FD, 0x0100, 0x0180, 0x0250, 0x0370,
    0x0400, 0x0530, 0x0590, 0x0600, 0x0700, 0x0900, 0x0980, 0x0A00, 0x0B80, 0x0C00, 0x0E00, 0x0E80, 0x0F00, 0x1000, 0x10A0, 0x1100, 0x1200, 0x1400,
    0x1780, 0x1800, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x30A0, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0x10000, 0x20000,
])


@cache
def _letters() -> np.ndarray:
    """For every code point 2 if it is a letter, 1 if it is a mark that may belong to one, else 0."""
    return np.array(["ML".find(unicodedata.category(chr(c))[0]) + 1 for c in range(0x110000)], dtype=np.int8)


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


@dataclass
class Model:
    """Languages in code point order; log odds of buckets, and which ranges are hardly used, a column for each language."""

    languages: list[str]
    grams: np.ndarray
    strange: np.ndarray


def _grams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased text with a space at both ends: first and last+1 place of each word, letters, bucket of each place twice.

    A word is a run of letters and marks with a letter in it.
    """
    c = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    kind = _letters()[c]
    c = np.where(kind > 0, c, 0).astype(np.uint32)
    edge = np.diff((kind > 0).astype(np.int8))
    first, last = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    if len(first) and (kind[first] == 1).any():
        some = np.maximum.reduceat(kind, first) == 2
        first, last = first[some], last[some]
    one = np.concatenate([[0], c[:-1]]).astype(np.uint32)
    two = np.where(one == 0, 0, np.concatenate([[0, 0], c[:-2]])).astype(np.uint32)
    pair = one * np.uint32(0x9E3779B1) ^ c * np.uint32(0x85EBCA77)
    triple = pair ^ (two + np.uint32(1)) * np.uint32(0xC2B2AE3D)
    pair = (pair ^ (pair >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)
    triple = (triple ^ (triple >> np.uint32(13))) * np.uint32(0x297A2D39) >> np.uint32(16)
    return np.stack([first, last]), c, pair, triple


def _out(model: Model, words: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whether the ranges of a word's letters put it out of each language; a word that would be out of all is out of none."""
    seen = np.flatnonzero(c > 0 if model.strange[0].any() else c >= RANGES[1])
    out = np.zeros((words.shape[1], len(model.languages)), bool)
    if len(seen):
        word, range_ = np.searchsorted(words[0], seen, side="right") - 1, np.searchsorted(RANGES, c[seen], side="right") - 1
        odd = model.strange[range_]
        for i in np.flatnonzero(odd.any(axis=0)):
            out[word[odd[:, i]], i] = True
    out[out.all(axis=1)] = False
    return out


def word_scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts: text number, first place, last+1 place, and score in each language."""
    chunk = max(10_000, CHUNK * 4 // max(4, len(model.languages)))
    parts: list[tuple[int, int, str]] = []  # text, place of its first character, characters
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at > chunk:
            cut = max(text.rfind(" ", at, at + chunk), text.rfind("\n", at, at + chunk)) + 1
            cut = cut if cut > at else at + chunk
            parts.append((i, at, text[at:cut]))
            at = cut
        if len(text) > at:
            parts.append((i, at, text[at:]))
    out, held, size = [], [], 0
    for k, part in enumerate(parts):
        held.append(part)
        size += len(part[2]) + 1
        if k + 1 < len(parts) and size + len(parts[k + 1][2]) <= chunk:
            continue
        words, c, pair, triple = _grams(" " + " ".join(_lower(p[2]) for p in held) + " ")
        if words.shape[1]:
            by = model.grams[triple]
            by += model.grams[pair]
            # a word is scored from its first letter to the place after its last, which holds the ending
            bounds = np.stack([words[0], words[1] + 1]).T.ravel()
            score = np.add.reduceat(np.concatenate([by, np.zeros((1, by.shape[1]), by.dtype)]), bounds, axis=0)[::2]
            score[_out(model, words, c)] -= OUT
            starts = np.cumsum([1, *(len(p[2]) + 1 for p in held)])
            own = np.searchsorted(starts, words[0], side="right") - 1
            shift = np.array([p[1] for p in held]) - starts[:-1]
            out.append((np.array([p[0] for p in held])[own], words[0] + shift[own], words[1] + shift[own], score))
        held, size = [], 0
    if not out:
        return *(np.zeros(0, np.int64) for _ in range(3)), np.zeros((0, len(model.languages)), np.float32)
    return tuple(np.concatenate(x) for x in zip(*out))


def _search(score: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Language number of each word on each text's best path. Texts advance together, longest first."""
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    label = np.zeros(len(score), np.int16)
    if not len(first):
        return label
    own = np.arange(score.shape[1], dtype=np.int16)
    back = np.zeros(score.shape, np.int16)
    value = score[first].astype(np.float64)
    active = np.searchsorted(-count, -np.arange(1, count[0] + 1), side="right")
    for t in range(1, count[0]):
        k = active[t]
        at = first[:k] + t
        v = value[:k]
        best = v.argmax(axis=1)
        most = v[np.arange(k), best][:, None] - SWITCH
        stay = v >= most
        back[at] = np.where(stay, own, best[:, None])
        value[:k] = np.where(stay, v, most) + score[at]
    state = value.argmax(axis=1).astype(np.int16)
    for t in range(count[0] - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        label[at] = state[:k]
        state[:k] = back[at, state[:k]]
        if t == 0:
            break
    return label


def label_words(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first place, last+1 place and language number of every word."""
    text, begin, end, score = word_scores(model, texts)
    label = np.zeros(len(text), np.int16)
    first = np.flatnonzero(np.diff(text, prepend=-1))
    count = np.diff(np.append(first, len(text)))
    mixed = []
    for a, n in zip(first, count):
        s = score[a : a + n]
        best = s.sum(axis=0, dtype=np.float64).argmax()
        label[a : a + n] = best
        over = np.cumsum(s.max(axis=1) - s[:, best], dtype=np.float64)  # a word better in another language, else 0
        if over[-1] > SWITCH:
            other = np.delete(s, best, axis=1).max(axis=1) - s[:, best] if s.shape[1] > 1 else -s[:, best]
            run = np.concatenate([[0.0], np.cumsum(other, dtype=np.float64)])
            if (run - np.minimum.accumulate(run)).max() > SWITCH:
                mixed.append((a, n))
    if mixed:
        a, n = np.array(mixed).T
        rows = np.concatenate([np.arange(x, x + y) for x, y in mixed])
        label[rows] = _search(score[rows], np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    return text, begin, end, label


SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]))
_PA_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])


def train(docs: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text", most: int = TAUGHT, languages: int = LANGUAGES) -> Model:
    """Learn from the texts of about `most` rows with a language, as many of each, chosen by the hash of their key.

    Their statistics are summed on the executors; the driver gets a number per language and bucket, of the most
    frequent `languages` at most (ties: first by code point). Rows with a null key, language or text teach nothing;
    repeated rows teach as often as they stand. A language that is taught by no letter is not learned; an empty table
    teaches none.
    """
    rows = docs.where(F.col(key).isNotNull() & F.col(lang).isNotNull()).select(F.xxhash64(F.col(key)).alias("lot"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = rows.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(languages).collect()
    span = 1 << 30
    shares = [(r["lang"], min(span, most * span // (len(counts) * r["count"]) + 1)) for r in counts]
    share = docs.sparkSession.createDataFrame(shares, "lang string, share long")
    rows = rows.join(F.broadcast(share), "lang").where((F.pmod("lot", F.lit(span)) < F.col("share")) & F.col("text").isNotNull()).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sums.setdefault(name, np.zeros(BUCKETS + len(RANGES), np.int64))
                for at in range(0, len(x), CHUNK):
                    words, c, pair, triple = _grams(f" {_lower(x[at : at + CHUNK])} ")
                    inside = (c > 0) | (np.concatenate([[0], c[:-1]]) > 0)
                    own[:BUCKETS] += np.bincount(pair[inside], minlength=BUCKETS) + np.bincount(triple[inside], minlength=BUCKETS)
                    own[BUCKETS:] += np.bincount(np.searchsorted(RANGES, c[c > 0], side="right") - 1, minlength=len(RANGES))
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())], names=["lang", "at", "n"])

    found = rows.mapInArrow(count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    learned = sorted(found["lang"].unique(), key=lambda x: x.encode())
    sums = np.zeros((BUCKETS + len(RANGES), len(learned)))
    sums[found["at"], found["lang"].map({x: i for i, x in enumerate(learned)})] = found["n"]
    grams, ranges = sums[:BUCKETS], sums[BUCKETS:]
    grams = np.log((grams + SMOOTH) / (grams.sum(axis=0) + SMOOTH * BUCKETS))
    grams -= grams.mean(axis=1, keepdims=True) if learned else 0
    return Model(learned, grams.astype(np.float32), ranges < RARE * ranges.sum(axis=0))


def detect(docs: DataFrame, model: Model, key: str | list[str] | Column = "doc_id", text: str = "text") -> DataFrame:
    """key columns, lang_pred, score and spans (begin, end, lang; places in the text) of every document.

    lang_pred is the language of most letters, "und" where there is no letter, text or learned language; score is its
    share of the letters, 0 for "und". Of equal shares the language first by code point counts. A text of marks alone
    has no letter. Texts are scored whole, in chunks, whatever their length; null keys and repeated rows are rows like
    any other; an empty table gives an empty one.
    """
    keys = [key] if not isinstance(key, list) else key
    kept = docs.select(*keys, F.col(text).cast("string").alias("_text"))
    schema = T.StructType([*(x for x in kept.schema if x.name != "_text"), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in (whole.slice(a, 2048) for a in range(0, whole.num_rows, 2048)):
                texts = [x or "" for x in batch.column(batch.num_columns - 1).to_pylist()]
                preds, scores = [UND] * len(texts), np.zeros(len(texts))
                lists, spans = np.zeros(len(texts) + 1, np.int64), ([], [], np.zeros(0, np.int64))
                if model.languages:
                    at, begin, end, label = label_words(model, texts)
                    n = len(model.languages)
                    letters = np.bincount(at * n + label, end - begin, len(texts) * n).reshape(-1, n)
                    some = np.flatnonzero(letters.sum(axis=1))
                    for i in some:
                        best = letters[i].argmax()
                        preds[i], scores[i] = model.languages[best], letters[i, best] / letters[i].sum()
                    if len(at):
                        new = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
                        stop = np.append(new[1:], len(at)) - 1
                        spans = (begin[new], end[stop], label[new])
                        lists[1:] = np.cumsum(np.bincount(at[new], minlength=len(texts)))
                names = pa.array(model.languages, pa.string()).take(pa.array(spans[2], pa.int64())) if model.languages else pa.array([], pa.string())
                items = pa.StructArray.from_arrays([pa.array(spans[0], pa.int64()), pa.array(spans[1], pa.int64()), names], fields=list(_PA_SPAN))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(preds, pa.string()), pa.array(scores), pa.ListArray.from_arrays(pa.array(lists, pa.int32()), items)], names=schema.names
                )

    return kept.mapInArrow(run, schema)
