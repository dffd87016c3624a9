import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from postalith.llm import lines
from postalith.llm.common import Scratch, extended, join_hot, perhaps

BASE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from old oak trees near a silent lake " * 3


def run(spark, rows):
    docs = spark.createDataFrame([(k, t, 7) for k, t in rows], "doc_id long, text string, line int")
    found = lines.dedup(docs, Scratch(spark, "t"))
    assert found.columns == ["doc_id", "text", "line", "removed_lines"]
    return {r["doc_id"]: (r["text"], r["removed_lines"]) for r in found.collect()}


def distance(a, b, most):
    """Edit distance of two lists, or more than most."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        low, high = max(1, i - most), min(len(b), i + most)
        new = [most + 1] * (len(b) + 1)
        new[0] = i
        for j in range(low, high + 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != b[j - 1]))
        row = new
        if min(row[low - 1 : high + 1]) > most:
            return most + 1
    return row[-1]


def near_pairs(norms):
    """Numbers of all pairs of distinct lines at the least similarity, by an exact filter on rare words and edit distance."""
    words = [x.split(" ") for x in norms]
    often = Counter(w for x in words for w in set(x))
    where, found = defaultdict(list), set()
    for i, x in enumerate(words):
        # of the words of both in one order, near lines share one of their first few
        for w in sorted(set(x), key=lambda w: (often[w], w))[: len(x) // 5 + 1]:
            where[w].append(i)
    counts = [Counter(x) for x in words]
    for own in where.values():
        for n, i in enumerate(own):
            for j in own[n + 1 :]:
                a, b = words[i], words[j]
                most = max(len(a), len(b)) // 5
                if (i, j) not in found and abs(len(a) - len(b)) <= most and sum((counts[i] & counts[j]).values()) >= max(len(a), len(b)) - most and distance(a, b, most) <= most:
                    found.add((i, j))
    return found


def roots(pairs, count):
    up = list(range(count))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in pairs:
        up[top(i)] = top(j)
    return [top(i) for i in range(count)]


def test_near_lines_of_the_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    scratch = Scratch(spark, "t")
    places, labels = lines.groups(docs, scratch)
    of = {r["node"]: r["component"] for r in labels.collect()}
    rows = lines.compared(docs, "doc_id", "text").select("line", "norm").distinct().collect()
    hashes, norms = [r["line"] for r in rows], [r["norm"] for r in rows]
    assert len(set(hashes)) == len(hashes) == places.select("line").distinct().count()
    pairs = near_pairs(norms)
    for name, some in (("short", [p for p in pairs if len(norms[p[0]].split()) < 25]), ("long", [p for p in pairs if len(norms[p[0]].split()) >= 25])):
        together = sum(of.get(hashes[i], 0) == of.get(hashes[j], 1) for i, j in some)
        print(name, together, "of", len(some))
        assert len(some) > 20 and together >= 0.9 * len(some)
    # no group holds lines that no chain of near pairs connects
    root, at = roots(pairs, len(norms)), {h: i for i, h in enumerate(hashes)}
    assert all(root[at[n]] == root[at[c]] for n, c in of.items())


def test_equal_and_near_lines_stay_once(spark):
    near = BASE.replace("quick brown", "brown quick", 1)
    rows = [
        (1, "Unique opening line of the first document here\n" + BASE + "\nshort line"), (2, BASE.upper().replace(" ", "  ") + "!\nShort line.\nanother line that nobody else has at all"),
        (3, near), (4, "---\n\n---"), (5, None), (6, ""), (7, "some five words in this line\nx\nSome five words, in this LINE."), (8, "two words\n\n***"),
    ]
    got = run(spark, rows)
    assert got[1] == (rows[0][1], 0)
    assert got[2] == ("another line that nobody else has at all", 2)
    assert got[3] == ("", 1)
    for k in (4, 5, 6, 8):
        assert got[k] == (rows[k - 1][1], 0)
    assert got[7] == ("some five words in this line\nx", 1)


def test_repeated_rows_null_keys_and_empty_tables(spark):
    got = run(spark, [(1, BASE), (1, BASE), (None, BASE)])
    assert got[None] == (BASE, 0) and got[1] == ("", 1)
    assert run(spark, []) == {}


def test_very_long_lines(spark):
    words = [f"word{i}" for i in range(9000)]
    moved = ["new"] + words[:4000] + words[4010:]
    got = run(spark, [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(moved)), (4, " ".join(words[:5000]))])
    assert [got[k][1] for k in (1, 2, 3, 4)] == [0, 1, 1, 0]


def test_a_cluster_of_variants_is_one_group(spark):
    draw = random.Random(3)
    base = [f"w{draw.randrange(5000)}" for _ in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):  # each near the first, many not near each other
        copy = list(base)
        for at in draw.sample(range(60), 8):
            copy[at] = f"v{draw.randrange(5000)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scratch = Scratch(spark, "t")
    _, labels = lines.groups(docs, scratch)
    assert labels.count() >= 0.95 * 400 and labels.select("component").distinct().count() == 1
    assert spark.read.parquet(scratch.path(f"edges{lines.TURNS}")).count() < 4000
    got = run(spark, rows)
    assert sum(n for _, n in got.values()) >= 0.95 * 400 and got[0][1] == 0


@pytest.mark.parametrize(("x", "y", "want"), [("a b c d e", "a b c d f", True), ("a b c d", "a b c d e", True), ("a b c d e", "a b x y e", False), ("a b c d e f g h i j", "j a b c d e f g h i", True), ("a b c d e f g h i j", "c d e f g h i j a b", False), ("a", "a", True)])
def test_edit_similarity(spark, x, y, want):
    row = spark.createDataFrame([(x.split(" "), y.split(" "))], "x array<string>, y array<string>")
    assert row.select(lines.near(F.col("x"), F.col("y"))).first()[0] == want


def test_words_that_share_a_letter_are_told_apart(spark):
    seen, alike = {}, None
    for r in spark.range(5000).selectExpr("concat('w', id) w", "xxhash64(concat('w', id)) & 1048575 h").collect():
        if r["h"] in seen:
            alike = seen[r["h"]], r["w"]
        seen[r["h"]] = r["w"]
    one, two = alike
    row = spark.createDataFrame([([one, "b", "c", "d", "e"], [two, "b", "c", "d", "x"])], "x array<string>, y array<string>")
    assert row.select(lines.near(F.col("x"), F.col("y"))).first()[0] is False


def _planted(sizes, seed):
    """Lines, and a near copy of each at just the least similarity; a line and its copy have keys 2 i and 2 i + 1."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("aeioulnrst") for _ in range(draw.randint(2, 9))) for _ in range(3000)]
    rows = []
    for n in sizes:
        line = [draw.choice(words[: 40 if draw.random() < 0.5 else 3000]) for _ in range(n)]
        copy = list(line)
        for at in draw.sample(range(n), n // 5):
            copy[at] = draw.choice(words)
        if draw.random() < 0.3:  # words left out instead
            gone = set(draw.sample(range(n), n // 5))
            copy = [w for i, w in enumerate(line) if i not in gone]
        rows += [(len(rows), " ".join(line)), (len(rows) + 1, " ".join(copy))]
    return rows


@pytest.mark.parametrize("sizes", [[40, 45, 50, 60, 80, 100, 150, 300, 700] * 20, [5, 6, 8, 10, 12, 15, 19] * 25])
def test_lines_at_just_the_least_similarity_are_mostly_found(spark, sizes):
    rows = _planted(sizes, len(sizes))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = {r["doc_id"] for r in lines.dedup(docs, Scratch(spark, "t")).where("removed_lines = 1").select("doc_id").collect()}
    assert all(k % 2 for k in removed)
    assert len(removed) >= 0.75 * len(sizes)  # at least nine of ten of all near lines are found, but these are the hardest


def test_lines_that_share_blocks_meet_once_and_new_nodes_are_told_once(spark, monkeypatch):
    rows = _planted([60] * 40, 5)
    met = []
    verified = lines._verified
    monkeypatch.setattr(lines, "_verified", lambda pairs, texts: met.append([tuple(sorted(r)) for r in pairs.collect()]) or verified(pairs, texts))
    monkeypatch.setattr(lines, "components", lambda edges, scratch, name: edges.sparkSession.createDataFrame([], "node long, component long"))
    monkeypatch.setattr(lines, "extended", lambda labels, *_: labels)
    lines.groups(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t"))  # nothing is grouped before the last round
    assert len(met[-1]) > 20 and len(set(met[-1])) == len(met[-1])
    labels = spark.createDataFrame([(1, 1), (2, 1)], "node long, component long")
    more = spark.createDataFrame([(7, 1), (7, 2), (8, 7), (0, 9)], "a long, b long")
    got = extended(labels, more, Scratch(spark, "t"), "m")
    assert sorted(map(tuple, got.collect())) == [(0, 0), (1, 1), (2, 1), (7, 1), (8, 1), (9, 0)]


def test_hot_joins_and_filters_keep_all_rows(spark):
    left = spark.range(5000).selectExpr("if(id < 3000, 0, id) k", "id v")
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("first"))
    got = join_hot(left, right, "k", "n")
    assert got.count() == 5000 and got.where("k = 0 and first = 0").count() == 3000
    some = spark.range(100).selectExpr("id * 7 k")
    assert perhaps(left, some, ["k"]).join(some, "k").count() == left.join(some, "k").count()
    assert perhaps(left, some, ["k"]).count() + perhaps(left, some, ["k"], others=True).count() == 5000
    assert perhaps(left, some.limit(0), ["k"]).count() == 0


def test_lines_of_a_common_passage_meet_by_their_rare_words(spark, monkeypatch):
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("aeioulnrst") for _ in range(7))
    passage = " ".join(word() for _ in range(30))
    rows = [" ".join([*(word() for _ in range(15)), passage, *(word() for _ in range(10))]) for _ in range(300)]
    rows += [x.replace(x.split(" ")[3], word(), 1) + " " + word() for x in rows[:40]]  # near ones of some
    ids = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    monkeypatch.setattr(lines, "CROWD", 20)
    monkeypatch.setattr(Scratch, "drop", lambda self, *names: None)
    sides = []
    met_by = lines._met_by
    monkeypatch.setattr(lines, "_met_by", lambda some: sides.append(some) or met_by(some))
    removed = {r["doc_id"] for r in lines.dedup(ids, Scratch(spark, "t")).where("removed_lines = 1").select("doc_id").collect()}
    assert removed == set(range(300, 340))
    # no more pairs of lines that share a key than lines, before any sketch tells them apart; by blocks there were 300 times as many
    made = sum(s.where("out").alias("x").join(s.alias("y"), "key").where("x.print.line < y.print.line").count() for s in sides)
    assert made < 2 * len(rows)


def test_near_lines_share_one_of_their_rarest_words(spark):
    rows = _planted([6, 9, 14, 20, 45, 60, 100] * 20, 8) + [(9000, "a a a a a b b b b b"), (9001, "a a a a b b b b b c")]
    texts = spark.createDataFrame(rows, "line long, norm string")
    got = {r["line"]: set(r["tokens"]) for r in lines.rarest(texts).collect()}
    assert all(len(got[k]) == len(x.split()) - -(-len(x.split()) * 4 // 5) + 1 for k, x in rows)
    assert all(got[k] & got[k + 1] for k in range(0, 280, 2)) and got[9000] & got[9001]


def test_blocks_of_two_lines_that_cannot_be_near_are_left_out(spark):
    rows = [(1, 5, 20, 0b1), (1, 6, 25, 0b1), (2, 5, 20, 0), (2, 6, 26, 0), (3, 5, 20, 0b11111), (3, 6, 20, 0b1111100000), (4, 5, 20, 0), (4, 6, 90, 0), (4, 7, 20, 0), (5, 5, 20, 0), (6, 5, 20, 0b11111111111), (6, 6, 20, None)]
    got = lines.leads(spark.createDataFrame(rows, "block long, line long, n int, odd long")).collect()
    assert sorted(map(tuple, got)) == [(1, 5, False), (4, 5, True), (6, 5, False)]
    norm = "seven wise owls watch from old oak trees near a silent lake"
    for copies in (1, 2, 3):
        told = lines.keyed(spark.createDataFrame([(7, norm)] * copies, "line long, norm string")).collect()
        assert [r["n"] for r in told] == [12, 12] and [r["odd"] is None for r in told] == [copies == 2] * 2
