"""Mixing sources to target weights by the cube method.

Each source's target gives its documents one inclusion rate; its whole part is taken outright and its fraction is an
inclusion probability. The flight phase moves probabilities within the null space of two constraints, the totals of
words and of documents, until each is 0 or 1 but for at most two in a group. The largest open document leads: its
probability moves, all smaller ones of the group make up for it, so what stays open is small. Groups have bounded
size; what they leave open flies again in groups of the next level. When a source has one group left, the at most two
documents that its flight leaves land: the document total is dropped, then the word total, and a lot decides the last
one. Every move is a martingale, so each row is taken with exactly the probability that its source's rate gives it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postalith.llm.common import WORD, Scratch, global_rank

#: Documents of a group; a source has as many groups as it takes.
GROUP = 4096
_NEAR = 1e-9


def word_count(text: str) -> Column:
    """Number of runs of non-white-space characters; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, scratch: Scratch, weights: tuple[float, ...], budget: float, ceiling: float, source: str) -> DataFrame:
    """source, source_size, units, target: one row for each source, from (source, source_size, units).

    The n-th source by code point (null last) weighs weights[n mod len]. The budget is a share of all sizes. A target
    that passes ceiling times its source's size stops there and the excess is shared again by weight. The share for
    weight 1 is all that the driver keeps between rounds; each round reads one row of sums.
    """
    ranked = global_rank(scratch.keep(sizes, "sizes"), [F.col(source).asc_nulls_last()], scratch, "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(ceiling)))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * budget
    share = 0.0
    while True:
        over = F.col("weight") * share > F.col("most")
        row = ranked.agg(F.sum(F.when(over, F.col("most"))).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        again = (total - (row["full"] or 0.0)) / row["open"]
        if again <= share:
            break
        share = again
    return ranked.select(source, "source_size", "units", F.least(F.col("weight") * share, F.col("most")).alias("target"))


def _moved(p: np.ndarray, along: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The probabilities after the draw of one of the two ends of their line within 0 to 1: the mean stays."""
    rise, fall = along > 0, along < 0
    up = min(((1 - p[rise]) / along[rise]).min(initial=np.inf), (p[fall] / -along[fall]).min(initial=np.inf))
    down = min((p[rise] / along[rise]).min(initial=np.inf), ((1 - p[fall]) / -along[fall]).min(initial=np.inf))
    p = p + along * (up if rng.random() * (up + down) < down else -down)
    return np.where(p < _NEAR, 0.0, np.where(p > 1 - _NEAR, 1.0, p))


def flight(p: np.ndarray, words: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Probabilities of units (rows of the given numbers of words, largest first) after their flight, 0 or 1 but for two at most.

    Each move keeps the sums of p and of p * words. Units whose p is near 0 or 1 make up for less. With landing, what
    is left open moves along the word total alone, and a lot decides the last one.
    """
    p, words = p.copy(), words.astype(float)
    at = np.flatnonzero((p > 0) & (p < 1))
    stuck: list[int] = []  # all smaller ones are of one size, so only they can make up for each other
    while len(at) > 1:
        lead, rest = at[0], at[1:]
        weight = p[rest] * (1 - p[rest])
        total = weight.sum()
        mean = (weight * words[rest]).sum() / total
        apart = words[rest] - mean
        spread = (weight * apart**2).sum()
        off = words[lead] - mean
        if spread <= 1e-12 * total * (1 + mean) ** 2:
            if abs(off) > 1e-9 * (1 + mean):
                stuck.append(lead)
                at = rest
                continue
            spread = np.inf
        along = np.concatenate([[1.0], -weight / total - weight * apart * off / spread])
        p[at] = _moved(p[at], along, rng)
        at = at[(p[at] > 0) & (p[at] < 1)]
    if land:
        left = [*stuck, *at]
        if len(left) == 2 and words[left[1]] > 0:
            p[left] = _moved(p[left], np.array([1.0, -words[left[0]] / words[left[1]]]), rng)
        for i in left:
            if 0 < p[i] < 1:
                p[i] = float(rng.random() < p[i])
    return p


def _level(units: DataFrame, level: int, seed: int, group: int) -> DataFrame:
    """One flight over (unit columns..., p, groups): each source's units in that many groups, largest first."""
    bucket = F.pmod(F.xxhash64(F.lit(seed + level), "key", "size", "mark"), F.col("groups"))
    dealt = (
        units.withColumn("bucket", bucket).withColumn("lot", F.xxhash64(F.lit(seed + level), "source", "bucket"))
        .withColumn("turn", F.xxhash64(F.lit(seed - level), "size", "key", "mark")).withColumn("down", -F.col("size"))
        .repartition("source", "bucket").sortWithinPartitions("source", "bucket", "down", "turn", "key", "mark")
    )
    names = units.columns
    p, size, groups, source = (names.index(n) for n in ("p", "size", "groups", "source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, own, kinds = None, [], []

        def decided() -> pa.RecordBatch:
            first, words = (np.array([x[i] for x in own], dtype=float) for i in (p, size))
            after = flight(first, words, np.random.default_rng(mark[2] & (2**63 - 1)), own[0][groups] == 1)
            columns = list(zip(*((*x[:p], v, *x[p + 1 : len(names)]) for x, v in zip(own, after.tolist()))))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for batch in batches:
            kinds = [f.type for f in batch.schema][: len(names)]
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                at = (row[source], row[-4], row[-3])
                if at != mark and own:
                    yield decided()
                    own = []
                mark = at
                own.append(row)
        if own:
            yield decided()

    return dealt.mapInArrow(run, units.schema)


def decide(
    docs: DataFrame, scratch: Scratch, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5, ceiling: float = 2.0, seed: int = 17, group: int = GROUP,
) -> DataFrame:
    """How often the mix takes each document.

    Returns key, source, size (words), mark (hash of the text), documents (how many rows share these four),
    source_size, target, copies and more: each of the rows is taken copies times, and so many of them once more. Rows
    that share all four are alike, but each is a unit of its own: of m alike rows with probability p, floor(m p) or
    one more are taken again. A null key or source is a value like any other; a null text has size 0, and texts
    without words never change a total of words. Very long texts are units like any other. An empty table gives an
    empty one; other columns play no part. Results depend on rows and seed alone, not on partitions. A source misses
    its word total by at most its second smallest open document, or by its largest where all others are of one size.
    """
    mark = F.xxhash64(F.col(text).cast("string")).alias("mark")
    units = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(text).alias("size"), mark)
    units = scratch.keep(units.groupBy("key", "source", "size", "mark").agg(F.count("*").alias("documents")), "units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("documents")).alias("source_size"), F.count("*").alias("units"))
    goals = scratch.keep(targets(sizes, scratch, weights, budget, ceiling, "source"), "targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(ceiling)))).otherwise(0.0)
    goal = goals.withColumnRenamed("source", "of")
    ready = (
        units.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumn("copies", F.floor(rate)).withColumn("share", (rate - F.col("copies")) * F.col("documents"))
        .withColumn("more", F.floor(F.col("share") + _NEAR)).withColumn("p", F.greatest(F.col("share") - F.col("more"), F.lit(0.0))).drop("share")
        .withColumn("groups", F.ceil(F.col("units") / group))
    )
    done, level = [], 0
    while True:
        flown = scratch.keep(_level(ready, level, seed, group), f"level{level}")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(flown.where(~open_))
        left = flown.where(open_)
        counts = left.groupBy("source").agg(F.ceil(F.count("*") / group).alias("now"))
        if not left.limit(1).count():
            break
        counts = counts.withColumnRenamed("source", "of")
        ready = left.drop("groups").join(counts, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumnRenamed("now", "groups")
        level += 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "mark", "documents", "source_size", "target",
        F.col("copies").cast("long").alias("copies"), (F.col("more") + F.col("p")).cast("long").alias("more"),
    )


def each(chosen: DataFrame, columns: list[Column]) -> DataFrame:
    """A row for each document of decide's result: the columns given, and taken, how often the mix takes it."""
    block = 1 << 12
    many = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("documents") - 1) / block)))
    some = chosen.withColumn("_block", many)
    one = F.explode(F.sequence(F.col("_block") * block, F.least((F.col("_block") + 1) * block, F.col("documents")) - 1))
    return some.withColumn("_row", one).select(*columns, (F.col("copies") + (F.col("_row") < F.col("more")).cast("long")).alias("taken"))


def mix(docs: DataFrame, scratch: Scratch, key: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The documents as often as the mix takes them: rows of the input's columns, repeated or left out.

    Of rows alike in key, source and text the first few, by partition and place there, are taken once more where only
    some are. Nulls, empty texts and tables are as in decide; extra columns, whatever their names, come along.
    """
    chosen = decide(docs, scratch, key, source, text, **how).where("copies + more > 0")
    mine = {"key": key, "source": source, "size": "size", "mark": "mark"}
    chosen = chosen.select(*(F.col(c).alias(f"_{n}") for n, c in mine.items()), *(F.col(c).alias(f"_{c}") for c in ("documents", "copies", "more")))
    chosen = scratch.keep(chosen, "chosen")
    sized = docs.withColumns({"_own_words": word_count(text), "_own_mark": F.xxhash64(F.col(text).cast("string"))})
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(source).eqNullSafe(F.col("_source")) & (F.col("_own_words") == F.col("_size")) & (F.col("_own_mark") == F.col("_mark"))
    found = sized.join(chosen, same)
    mixed = F.col("_more").between(1, F.col("_documents") - 1)
    plain = found.where(~mixed).withColumn("_taken", F.col("_copies") + F.when(F.col("_more") > 0, 1).otherwise(0))
    # rows alike of which only some are taken again are numbered by partition, so a million of them need no common task
    some = scratch.keep(found.where(mixed).withColumn("_at", F.monotonically_increasing_id()), "alike")
    unit, part = [F.xxhash64(*(F.col(f"_{n}") for n in mine))], F.shiftright("_at", 33)
    some = some.withColumn("_unit", unit[0]).withColumn("_part", part)
    counts = scratch.keep(some.groupBy("_unit", "_part").agg(F.count("*").alias("_n")), "parts")
    before = F.sum("_n").over(Window.partitionBy("_unit").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_unit", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_unit", "_part").orderBy("_at")) + F.col("_before")
    some = some.join(counts, ["_unit", "_part"]).withColumn("_taken", F.col("_copies") + (place <= F.col("_more")).cast("long"))
    taken = plain.select(*docs.columns, "_taken").unionByName(some.select(*docs.columns, "_taken"))
    return taken.where("_taken > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_taken")))).select(*docs.columns)
