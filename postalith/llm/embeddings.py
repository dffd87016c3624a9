"""Embedding near-duplicates by randomised-rotation binary codes.

Vectors are dealt to cells by their nearest centroid. In its cell a vector's residual is rotated at random and stored
as a code of signs with a correction factor, the inner product of residual and code. Codes give unbiased estimates of
inner products with a known spread; pairs whose upper confidence bound reaches the threshold are computed again in
double precision. A vector also visits the other cells nearest to it, so near pairs that a border divides still meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalith.llm.common import Scratch, components

THRESHOLD = 0.95
#: Vectors that the centroids are fitted to at most (those with the smallest hash of their id), and rounds of k-means.
FITTED, ROUNDS = 20_000, 8
#: Vectors in a cell on average, and cells at most: their centroids are sent to every task. Larger tables have larger
#: cells, whose vectors meet in blocks.
CELL, CELLS = 400, 4096
#: Cells that a vector visits, its own included.
VISITS = 6
#: Rows of a cell in one task, and rows computed with at a time.
BLOCK, STEP = 4096, 1024
#: Standard deviations of the estimate that the confidence bound adds.
SPREAD = 4.0


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix: the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, count: int, seed: int = 5) -> np.ndarray:
    """Unit centroids by spherical k-means; a cell that loses all its vectors takes one at random."""
    rng = np.random.default_rng(seed)
    count = max(1, min(count, len(sample)))
    c = sample[rng.choice(len(sample), count, replace=False)].copy()
    for _ in range(ROUNDS):
        near = np.concatenate([(sample[a : a + 4096] @ c.T).argmax(axis=1) for a in range(0, len(sample), 4096)])
        order = np.argsort(near, kind="stable")
        used, first = np.unique(near[order], return_index=True)
        c[used] = np.add.reduceat(sample[order], first, axis=0)
        none = np.setdiff1d(np.arange(count), used)
        c[none] = sample[rng.choice(len(sample), len(none))]
        norm = np.linalg.norm(c, axis=1, keepdims=True)
        c = np.where(norm > 0, c / np.where(norm > 0, norm, 1), sample[rng.choice(len(sample), count)])
    return c


class Codes:
    """Sign codes of unit vectors around a centroid, with what the estimate needs of each."""

    def __init__(self, x: np.ndarray, centre: np.ndarray, turn: np.ndarray):
        rest = x - centre
        self.length = np.linalg.norm(rest, axis=1)
        self.turned = (rest / np.where(self.length > 0, self.length, 1)[:, None]) @ turn
        self.signs = np.where(self.turned >= 0, np.float32(1), np.float32(-1))
        #: Inner product of the unit residual and its code, itself a unit vector.
        self.factor = np.abs(self.turned).sum(axis=1) / np.sqrt(x.shape[1])
        self.dot = x @ centre

    def __getitem__(self, part: slice) -> Codes:
        out = object.__new__(Codes)
        for name, value in vars(self).items():
            setattr(out, name, value[part])
        return out


def bounds(asks: Codes, held: Codes, centre_norm2: float, spread: float = SPREAD) -> tuple[np.ndarray, np.ndarray]:
    """Estimate of the inner product of every asking vector with every held one, and its upper confidence bound."""
    dim = held.signs.shape[1]
    factor = np.maximum(held.factor, 1e-6)
    angle = (asks.turned.astype(np.float32) @ held.signs.T) / np.float32(np.sqrt(dim)) / factor.astype(np.float32)
    scale = asks.length[:, None].astype(np.float32) * held.length.astype(np.float32)
    rest = asks.dot[:, None] + held.dot - centre_norm2
    wide = np.sqrt(np.maximum(0, 1 - factor**2) / factor**2 / max(1, dim - 1)).astype(np.float32)
    estimate = rest + scale * angle
    return estimate, estimate + scale * (spread * wide) + 1e-5


def _valid(vector: str):
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def links(
    vectors: DataFrame, scratch: Scratch, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
    visits: int = VISITS, spread: float = SPREAD, cell: int = CELL, cells: int = CELLS, exact: bool = False,
) -> DataFrame:
    """Every vector's near-duplicates: key, n_links (other rows at the threshold or above), component_id, kept.

    component_id is the smallest key reachable by links, kept says whether it is the row's own. Vectors that are null,
    zero, or hold null or non-finite numbers, and rows with a null key, link with nothing (component_id: the key).
    Vectors of different dimensions never link. Equal vectors are compared once and counted as often as they stand.
    Which pairs are compared is approximate, what is reported is exact: no pair below the threshold is ever a link.
    With exact=True no link is lost: a vector visits every cell that can hold a near one, and the products decide in
    place of the codes. An empty table gives an empty one; other columns play no part, whatever their names.
    """
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("v"))
    good = rows.where(F.col("key").isNotNull() & _valid("v"))
    unique = scratch.keep(good.groupBy("v").agg(F.min("key").alias("id"), F.count("*").alias("copies")).withColumn("dim", F.size("v")), "unique")
    dims = {r["dim"]: r["n"] for r in unique.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row per dimension
    how = {"visits": visits, "spread": spread, "cell": cell, "cells": cells, "exact": exact}
    parts = [_links_of(unique.where(F.col("dim") == d), scratch, n, d, threshold, **how) for d, n in sorted(dims.items())]
    if not parts:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    found = scratch.keep(found, "found")
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    groups = components(found.where("b is not null").select("a", "b"), scratch, "groups")
    told = unique.join(counts, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
    told = told.select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("component"))
    told = good.join(told, "v").select("key", F.col("n").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where(F.col("key").isNull() | ~_valid("v")).select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    every = told.unionByName(alone)
    return every.select(F.col("key").alias(key), "n_links", "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, without overflow on the way."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def visited(x: np.ndarray, c: np.ndarray, threshold: float) -> list[np.ndarray]:
    """For unit vectors all cells that can hold a vector at the threshold, their own first.

    A near y is no farther than d from x, and if its cell is c then y c >= y o for x's own centroid o, so
    x (o - c) <= d |o - c|.
    """
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    dot = x @ c.T
    own = dot.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, (c**2).sum(axis=1)[own][:, None] + (c**2).sum(axis=1) - 2 * c[own] @ c.T))
    may = dot[np.arange(len(x)), own][:, None] - dot <= reach * apart + 1e-9
    may[np.arange(len(x)), own] = False
    return [np.concatenate([[o], np.flatnonzero(m)]).astype(np.int32) for o, m in zip(own, may)]


def _links_of(unique: DataFrame, scratch: Scratch, count: int, dim: int, threshold: float, visits: int, spread: float, cell: int, cells: int, exact: bool) -> DataFrame:
    """Rows (a, null, n): a has n more links; rows (a, b, 0): a and b are linked, enough of them to connect groups."""
    taken = unique.orderBy(F.xxhash64("id"), "id").limit(FITTED).select("v").toPandas()["v"]
    centre = centroids(unit(np.stack(taken.to_numpy())), min(cells, -(-count // cell)))
    shared = unique.sparkSession.sparkContext.broadcast((centre, rotation(dim)))
    visits = min(visits, len(centre))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cells that every vector visits, its own first."""
        c = shared.value[0]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = unit(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                near = visited(x, c, threshold) if exact else list(np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :visits].astype(np.int32))
                ends = np.cumsum([0, *map(len, near)])
                tell = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(near)))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(3)), tell], names=["id", "v", "copies", "near"])

    element = unique.schema["v"].dataType.simpleString()
    dealt = unique.select("id", "v", "copies").mapInArrow(deal, f"id long, v {element}, copies long, near array<int>")
    dealt = scratch.keep(dealt, f"dealt{dim}")
    # A cell is cut into blocks of held vectors and of asking ones (visitors and its own); each block meets each.
    visit = dealt.select(F.posexplode("near").alias("place", "cell"))
    sizes = visit.groupBy("cell").agg(F.ceil(F.count_if(F.col("place") == 0) / BLOCK).cast("int").alias("blocks"), F.ceil(F.count("*") / (2 * BLOCK)).cast("int").alias("turns"))
    sizes = F.broadcast(sizes.where("blocks > 0"))  # at most `cells` rows
    lot = lambda n: F.pmod(F.xxhash64(F.lit(n), "id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = dealt.withColumn("cell", F.col("near")[0]).join(sizes, "cell").withColumn("block", lot("blocks")).withColumn("turn", every("turns")).withColumn("asks", F.lit(False))
    asks = dealt.withColumn("cell", F.explode("near")).join(sizes, "cell").withColumn("turn", lot("turns")).withColumn("block", every("blocks")).withColumn("asks", F.lit(True))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": pd.array([], "int64"), "b": pd.array([], "Int64"), "n": pd.array([], "int64")})
        h, a = part[~part["asks"]], part[part["asks"]]
        if h.empty or a.empty:
            return none
        centre, turn = shared.value
        c = centre[part["cell"].iloc[0]]
        hx, ax = (unit(np.stack(p["v"].to_numpy())) for p in (h, a))
        (hid, hn), (aid, an) = ((p["id"].to_numpy(), p["copies"].to_numpy()) for p in (h, a))
        hnear, home = np.full((len(h), h["near"].map(len).max()), -1), np.array([x[0] for x in a["near"]])
        for i, x in enumerate(h["near"]):
            hnear[i, : len(x)] = x
        codes, asking = (None, None) if exact else (Codes(hx, c, turn), Codes(ax, c, turn))
        gain_a, gain_h = np.zeros(len(aid), np.int64), np.zeros(len(hid), np.int64)
        left, right = [], []
        for at in range(0, len(aid), STEP):
            high = ax[at : at + STEP] @ hx.T + 1e-9 if exact else bounds(asking[at : at + STEP], codes, float(c @ c), spread)[1]
            i, j = np.nonzero(high >= threshold)
            differ = aid[i + at] != hid[j]
            i, j = i[differ] + at, j[differ]
            product = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", ax[i[s : s + 65536]], hx[j[s : s + 65536]]) for s in range(0, len(i), 65536))])
            i, j = i[product >= threshold], j[product >= threshold]
            gain_a += np.bincount(i, hn[j], len(aid)).astype(np.int64)
            # a pair is met again the other way round only if the held vector visits the asking one's cell
            once = ~(hnear[j] == home[i][:, None]).any(axis=1)
            gain_h += np.bincount(j[once], an[i[once]], len(hid)).astype(np.int64)
            for x, y in zip((aid[i], hid[j]), (left, right)):
                y.append(x)
            left, right = ([x] for x in _forest(np.concatenate(left), np.concatenate(right)))
        ids, at = np.unique(np.concatenate([aid, hid]), return_inverse=True)
        total = np.bincount(at, np.concatenate([gain_a, gain_h]), len(ids)).astype(np.int64)
        some = total > 0
        tree = pd.DataFrame({"a": left[0], "b": pd.array(right[0], "Int64"), "n": 0})
        more = pd.DataFrame({"a": ids[some], "b": pd.array([pd.NA] * int(some.sum()), "Int64"), "n": total[some]})
        return pd.concat([none, tree, more])

    columns = ["cell", "block", "turn", "asks", "id", "copies", "v", "near"]
    met = held.select(columns).unionByName(asks.select(columns))
    return met.groupBy("cell", "block", "turn").applyInPandas(compare, "a long, b long, n long")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its group) that connect what these pairs connect."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(names))
    while True:
        low = label.copy()
        np.minimum.at(low, u, label[v])
        np.minimum.at(low, v, label[u])
        low = low[low]
        if (low == label).all():
            return names, names[label]
        label = low
