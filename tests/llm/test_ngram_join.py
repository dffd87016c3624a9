import random
import re

import numpy as np

from postalith.llm import ngram_join as nj
from postalith.llm.common import Scratch

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain(rows):
    """key -> (size, smallest linked key), by comparing all pairs."""
    sets = {}
    for k, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    group = {k: k for k in sets}
    for a in sorted(sets):
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    return {k: (len(sets[k]), group[k]) for k in sets}


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    passage = [rng.choice(vocabulary) for _ in range(30)]
    for n in (1, 3, 4, 5, 6, 8, 9, 12, 20, 40, 41, 90, 200, 500):
        for _ in range(4):
            base = [rng.choice(vocabulary) for _ in range(n)]
            for edits in (0, 0, 1, 2, 3, n // 40, n // 25):
                words = list(base)
                for _ in range(edits):
                    at = rng.randrange(max(1, len(words)))
                    words[at : at + 1] = rng.choice([[], ["new"], [*words[at : at + 1], "more"], [w.upper() for w in words[at : at + 1]]])
                rows.append((k, " ".join(words)))
                k += 1
            rows.append((k, " ".join(passage + base)))
            k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, " \t\r\n"), (k + 3, "a\x0bb\x0cc d e"), (k + 4, "A B C D E"), (k + 5, "É è"), (k + 6, "é è"), (k + 7, "z " * 3000)]
    return rows


def test_all_links_are_found(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, cls string, size int").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nj.connect(docs, Scratch(spark, "t")).collect()}
    assert got == plain(rows)


def test_null_keys_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (7, "A b c")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in nj.connect(docs, Scratch(spark, "t")).collect())
    assert got == [("5", 5), ("5", 5), ("7", 5), ("None", None)]
    assert nj.connect(docs.limit(0), Scratch(spark, "t")).count() == 0


def test_every_admissible_pair_of_sizes_shares_a_band():
    for a in [*range(1, 400), 1000, 12345]:
        for b in range(a, a * 100 // nj.LEAST + 1):
            assert set(nj.bands_of(a)) & set(nj.bands_of(b)), (a, b)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(0)
    for n in [*range(4, 60), 80, 150, 400, 1500] * 6:
        both = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        k = rng.integers(0, n // 4 + 1)
        extra = np.unique(rng.integers(0, 2**63, k).astype(np.uint64))
        split = rng.random(len(extra)) < rng.random()
        a, b = np.union1d(both, extra[split]), np.union1d(both, extra[~split])
        if len(both) * 100 >= nj.LEAST * (len(both) + len(extra)) and len(extra):
            assert np.intersect1d(nj.signatures(a), nj.signatures(b)).size, (n, k)


def test_sketches_never_differ_in_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(0)
    for n in (1, 10, 300):
        a, b = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for _ in range(2))
        apart = sum(bin(int(x)).count("1") for x in (nj.sketch(a) ^ nj.sketch(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))
        assert np.array_equal(nj.sketch(a), np.bitwise_xor.reduce(nj.sketch(a, 64).reshape(4, -1)))
        apart = sum(bin(int(x)).count("1") for x in (nj.sketch(a, 64) ^ nj.sketch(b, 64)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b)) <= apart + n * n / 512 + 9
