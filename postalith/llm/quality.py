"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins. Boosting goes through the features in turn, many times; each step fits a
shallow tree to one feature's gradients and adds a little of it to that feature's lookup table. Pairs of features
whose joint bins still explain the residuals get tables of their own in the same way. A score is the logistic of the
sum of table entries: a few vectorised additions by bin.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled rows that training may use at most: those with the smallest hash of their id.
LABELLED = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, RATE, LEAVES, PENALTY = 250, 0.08, 4, 2.0
THRESHOLD = 0.3

FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "lower", "digit", "space", "sentence_mark", "exclaim", "symbol", "bar",
    "non_ascii", "other_mark", "distinct_words", "top_word", "distinct_lines", "words_per_line", "distinct_triples", "longest_word",
    "bare_words", "title_words", "repeated_words",
)

_CLASSES = np.zeros((256, 10))
for _i, _of in enumerate((
    range(65, 91), range(97, 123), range(48, 58), (9, 10, 11, 12, 13, 32), map(ord, ".,;:?'\"-()"), (33,), map(ord, "#$%&*@^~<>=+"), (124,), range(128, 256),
)):
    _CLASSES[list(_of), _i] = 1
_CLASSES[_CLASSES.sum(axis=1) == 0, 9] = 1


def features(text: str | None) -> list[float]:
    """The numbers that the model sees of a whole text; null is the empty text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    words = text.split()
    if not words:
        return [float(np.log1p(len(raw)))] + [0.0] * (len(FEATURES) - 1)
    share = np.bincount(raw, minlength=256) @ _CLASSES / len(raw)
    n = len(words)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    triples = len(set(zip(words, words[1:], words[2:]))) / (n - 2) if n > 2 else 1.0
    bare = sum(map(str.isalpha, words)) / n
    title = sum(map(str.istitle, words)) / n
    return [
        float(np.log1p(len(raw))), float(np.log1p(n)), (len(text) - n + 1) / n, *map(float, share),
        len(counts) / n**0.7, max(counts.values()) / n, len(set(lines)) / len(lines), n / len(lines), triples, float(np.log1p(max(map(len, words)))),
        bare, title, sum(a == b for a, b in zip(words, words[1:])) / n,
    ]


@dataclass
class Model:
    """Lookup tables: cuts and table of each feature, and (i, j, cuts, cuts, table) of each pair."""

    start: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for i, (cut, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cut, x[:, i], side="right")]
        for i, j, a, b, table in self.pairs:
            total += table[np.searchsorted(a, x[:, i], side="right"), np.searchsorted(b, x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="higher"))


def _steps(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values per bin of a tree with so many leaves over ordered bins: always split the leaf where it gains most."""
    G, H = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain = lambda a, b: (G[b] - G[a]) ** 2 / (H[b] - H[a] + PENALTY)
    parts = [(0, len(g))]
    for _ in range(leaves - 1):
        best = (1e-6, None)
        for k, (a, b) in enumerate(parts):
            if b - a > 1:
                s = np.arange(a + 1, b)
                won = gain(a, s) + gain(s, b) - gain(a, b)
                if won.max() > best[0]:
                    best = (won.max(), (k, int(s[won.argmax()])))
        if best[1] is None:
            break
        k, s = best[1]
        a, b = parts[k]
        parts[k : k + 1] = [(a, s), (s, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (G[b] - G[a]) / (H[b] - H[a] + PENALTY)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts a pair's table once along each side."""
    sums = []
    for x in (g, h):
        c = np.zeros((x.shape[0] + 1, x.shape[1] + 1))
        c[1:, 1:] = x.cumsum(0).cumsum(1)
        sums.append(c)
    best = (-1.0, None)
    n, m = g.shape
    a, b = np.meshgrid(np.arange(1, n), np.arange(1, m), indexing="ij")
    parts = []
    for c in sums:
        whole, top, left, corner = c[n, m], c[a, m], c[n, b], c[a, b]
        parts.append((corner, top - corner, left - corner, whole - top - left + corner))
    won = sum(x**2 / (y + PENALTY) for x, y in zip(*parts))
    if won.size:
        i, j = np.unravel_index(won.argmax(), won.shape)
        v = [x[i, j] / (y[i, j] + PENALTY) for x, y in zip(*parts)]
        out = np.empty_like(g)
        out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
        best = (float(won[i, j]), out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Learn from features and labels 0 or 1. One class alone gives a constant; none gives 0.5."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(rate / (1 - rate)))
    cuts = [_cuts(x[:, i], BINS) if len(x) else np.zeros(0) for i in range(len(FEATURES))]
    model = Model(start, cuts, [np.zeros(len(c) + 1) for c in cuts])
    if len(np.unique(y)) < 2:
        return model
    at = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(cuts)]
    total = np.full(len(y), start)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, table in enumerate(model.tables):
            if len(table) > 1:
                g, h = gradients()
                step = RATE * _steps(np.bincount(at[i], g, len(table)), np.bincount(at[i], h, len(table)), LEAVES)
                table += step
                total += step[at[i]]
    coarse = [_cuts(x[:, i], PAIR_BINS) for i in range(len(cuts))]
    bins = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(coarse)]
    g, h = gradients()

    def joint(i: int, j: int, v: np.ndarray) -> np.ndarray:
        n, m = len(coarse[i]) + 1, len(coarse[j]) + 1
        return np.bincount(bins[i] * m + bins[j], v, n * m).reshape(n, m)

    ranked = sorted(((_quarters(joint(i, j, g), joint(i, j, h))[0], i, j) for i in range(len(cuts)) for j in range(i)), reverse=True)
    chosen = [(i, j, np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for won, i, j in ranked[:PAIRS] if won > 0]
    for _ in range(ROUNDS // 5):
        for i, j, table in chosen:
            g, h = gradients()
            step = RATE * _quarters(joint(i, j, g), joint(i, j, h))[1]
            table += step
            total += step[bins[i], bins[j]]
    model.pairs = [(i, j, coarse[i], coarse[j], table) for i, j, table in chosen]
    return model


def _featured(docs: DataFrame, text: str) -> DataFrame:
    """The other columns and x, the array of features; the text goes."""
    rest = [c for c in docs.columns if c not in (text, "x")]
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(x, pa.list_(pa.float64()))], names=schema.names)

    return docs.select(*rest, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", most: int = LABELLED) -> Model:
    """Fit on at most `most` labelled rows, chosen by the hash of their key; only their features come to the driver.

    Rows without key or label, and keys with contradicting labels, teach nothing; a key counts once, by the least of
    its texts' features. Empty tables teach nothing: every score is then 0.5.
    """
    told = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("_y"), F.max(label).alias("_z"))
    told = told.where("_y = _z").select(F.col(key).alias("_key"), "_y").orderBy(F.xxhash64("_key"), "_key").limit(most)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_t")).join(F.broadcast(told), "_key")
    taught = _featured(rows, "_t").groupBy("_key").agg(F.min("x").alias("x"), F.min("_y").alias("_y")).orderBy("_key").toPandas()
    return fit(np.array(taught["x"].tolist()).reshape(-1, len(FEATURES)), taught["_y"].to_numpy(dtype=float))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """All columns of the documents with score (0 to 1) and predicted (1 from the threshold on), under the names given.

    Null and empty texts have scores like any other; very long texts are scored whole; rows alike score alike. Columns
    of the input that have these names are replaced. An empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(*names)
    schema = T.StructType([*kept.schema, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            s = shared.value.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=schema.names)

    return kept.mapInArrow(run, schema)
