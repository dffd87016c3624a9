from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postalith.llm import mixing
from postalith.llm.common import Scratch


def plain_targets(sizes, weights=(3, 1, 2), budget=1.5, ceiling=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, total, open_ = {}, budget * sum(sizes.values()), set(order)
    while open_:
        share = (total - sum(left.values())) / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * share > ceiling * sizes[s]}
        if not over:
            return left | {s: w[s] * share for s in open_}
        left |= {s: ceiling * sizes[s] for s in over}
        open_ -= over
    return left


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, ("w " * (1 + i * i % 97)) + "\tend", ["a", "b", "é", None, "z"][min(4, i % 7)], "x") for i in range(3000)]
    rows += [(9000, None, "a", "x"), (9001, "", "empty", "x"), (9002, " \t\n", "b", "x"), (None, "one two", "b", "x"), (None, "one two", "b", "x"), (9003, "q " * 4000, "b", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_totals_meet_targets_and_reruns_agree(spark, docs):
    found = mixing.decide(docs.drop("size"), Scratch(spark, "t"), group=1024).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        sizes[r["source"]] += r["size"] * r["documents"]
        taken[r["source"]] += r["size"] * (r["copies"] * r["documents"] + r["more"])
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 2 and 0 <= r["more"] <= r["documents"] and (r["copies"] < 2 or not r["more"])
    assert target == pytest.approx(plain_targets(sizes))
    largest = {s: max(r["size"] for r in found if r["source"] == s) for s in target}
    for s, t in target.items():
        # a document of a twentieth of a source's words and more may be what a lot decides
        assert abs(taken[s] - t) <= max(20, 0.01 * t, largest[s] * (largest[s] > 0.05 * t))
    assert sum(abs(taken[s] - t) <= max(20, 0.01 * t) for s, t in target.items()) >= len(target) - 1
    again = mixing.decide(docs.drop("size").repartition(7), Scratch(spark, "t"), group=1024).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert sum(r["documents"] for r in found) == docs.count()


def test_every_unit_is_taken_at_its_probability():
    p, words = np.array([0.5, 0.3, 0.3, 0.3, 0.8, 0.45]), np.array([900, 300, 120, 120, 20, 0])
    taken = sum(mixing.flight(p, words, np.random.default_rng(seed), True) for seed in range(4000)) / 4000
    assert np.abs(taken - p).max() < 0.03


@pytest.mark.parametrize("words", [np.sort(np.random.default_rng(1).integers(1, 900, 3000))[::-1], np.array([20_000] + [20] * 4095), np.array([20_000] + [20] * 2000 + [19] * 2000), np.full(500, 7), np.array([5000, 3, 2, 1])])
def test_flight_keeps_both_totals_and_leaves_two_at_most(words):
    p = np.full(len(words), 0.37)
    for seed in range(3):
        open_ = mixing.flight(p, words, np.random.default_rng(seed), False)
        left = (open_ > 0) & (open_ < 1)
        assert left.sum() <= 2
        assert open_.sum() == pytest.approx(p.sum()) and (open_ * words).sum() == pytest.approx((p * words).sum())
        after = mixing.flight(p, words, np.random.default_rng(seed), True)
        assert set(after) <= {0.0, 1.0}
        assert abs(after.sum() - p.sum()) <= 2  # both of the units that land, at most
        assert abs((after * words).sum() - (p * words).sum()) <= words[left].max(initial=0) + 1e-6
    if len(set(words)) > 100:
        assert words[left].max(initial=0) < 20


def test_alike_rows_are_units_of_their_own(spark):
    docs = spark.range(300_000).selectExpr("cast(null as long) doc_id", "'same two' text", "'a' source")
    docs = docs.union(spark.createDataFrame([(1, "one", "b"), (2, "w " * 600_000, "b")], docs.schema))
    found = {(r["source"], r["size"]): r for r in mixing.decide(docs, Scratch(spark, "t")).collect()}
    alike = found["a", 2]
    assert alike["documents"] == 300_000 and abs(alike["copies"] * 300_000 + alike["more"] - alike["target"] / 2) <= 1
    rows = mixing.each(mixing.decide(docs, Scratch(spark, "t")), [F.col("source"), F.col("size")])
    assert rows.count() == 300_002 and rows.where("source = 'a'").agg(F.sum("taken")).first()[0] == alike["copies"] * 300_000 + alike["more"]
    mixed = mixing.mix(docs.repartition(5), Scratch(spark, "t"))
    assert mixed.where("source = 'a'").count() == alike["copies"] * 300_000 + alike["more"]


def test_mix_repeats_whole_rows(spark, docs):
    found = mixing.decide(docs, Scratch(spark, "t"))
    mixed = mixing.mix(docs, Scratch(spark, "t"))
    assert mixed.columns == docs.columns
    assert mixed.count() == found.selectExpr("sum(copies * documents + more)").first()[0]


def test_empty_table(spark, docs):
    assert mixing.decide(docs.limit(0), Scratch(spark, "t")).count() == 0
    assert mixing.mix(docs.limit(0), Scratch(spark, "t")).count() == 0
