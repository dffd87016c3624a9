import numpy as np

from postalith.llm import embeddings as em
from postalith.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold=0.95):
    good = {k: np.array(v, np.float32).astype(float) for k, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    near = {k: [j for j, b in good.items() if j != k and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold] for k, a in good.items()}
    group = {k: k for k, _ in rows}
    moved = True
    while moved:
        moved = False
        for k, js in near.items():
            low = min([group[k], *(group[j] for j in js)])
            moved |= low != group[k]
            group[k] = low
    return {k: (len(near.get(k, ())), group[k]) for k, _ in rows}


def test_links_are_exact_and_recall_is_high(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(60):
        centre = rng.standard_normal(48)
        for _ in range(1 + c % 9):
            rows.append((len(rows), [float(x) for x in (centre + rng.standard_normal(48) * 0.05 * (c % 6)).astype(np.float32)]))
    rows += [(len(rows) + i, [float(x) for x in rng.standard_normal(48).astype(np.float32)]) for i in range(1500)]
    rows += [(9000, rows[0][1]), (9001, rows[0][1])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in em.links(spark.createDataFrame([(k, v, 1) for k, v in rows], SCHEMA), Scratch(spark, "t")).collect()}
    want = plain(rows)
    found, true = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert all(got[k][0] <= want[k][0] for k in want) and found >= 0.98 * true
    assert np.mean([got[k][1] == want[k][1] for k in want]) > 0.99


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in em.links(spark.createDataFrame([(k, v, 1) for k, v in rows], SCHEMA), Scratch(spark, "t")).collect()}
    assert got == {k: (0, k, True) for k in (1, 2, 3, 4, 5, 6, 10)} | {7: (2, 7, True), 8: (2, 7, False), 9: (2, 7, False)}


def test_empty_table(spark):
    assert em.links(spark.createDataFrame([], SCHEMA), Scratch(spark, "t")).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = em.unit(rng.standard_normal((400, 64)))
    centre = x[:50].mean(axis=0)
    codes = em.Codes(x, centre, em.rotation(64))
    estimate, high = em.bounds(codes, codes, float(centre @ centre))
    true = x @ x.T
    off = ~np.eye(400, dtype=bool)
    assert abs((estimate - true)[off].mean()) < 0.01
    assert (high >= true - 1e-4)[off].mean() > 0.999


def test_recall_with_many_more_cells_than_visits(spark):
    rows, planted = _planted(5000, 400)
    got = {r["vec_id"]: r["n_links"] for r in em.links(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "t"), cell=20).collect()}  # 250 cells
    assert np.mean([got[i] > 0 for i in range(planted)]) >= 0.9


def test_the_exact_way_finds_every_pair_among_many_cells(spark):
    rng = np.random.default_rng(8)
    centres = em.unit(rng.standard_normal((40, 24)))
    x = em.unit(np.repeat(centres, 30, axis=0) + 0.055 * rng.standard_normal((1200, 24)))  # many pairs close to the threshold
    rows = [(i, [float(v) for v in row.astype(np.float32)], "clash", "clash") for i, row in enumerate(x)]
    want = plain([r[:2] for r in rows])
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links string, near string")
    exact = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in em.links(frame, Scratch(spark, "t"), cell=20, exact=True).collect()}  # 60 cells
    assert exact == want and sum(n for n, _ in want.values()) > 5000
    quick = {r["vec_id"]: r["n_links"] for r in em.links(frame, Scratch(spark, "t"), cell=20).collect()}
    assert all(quick[k] <= want[k][0] for k in want)
    assert sum(quick.values()) >= 0.9 * sum(n for n, _ in want.values())


def _planted(count, pairs):
    """Random vectors, the first and the last `pairs` of which are pairs at cosine 0.9501; and that number."""
    rng = np.random.default_rng(4)
    x = em.unit(rng.standard_normal((count - pairs, 64)))
    turn = rng.standard_normal((pairs, 64))
    turn = em.unit(turn - (turn * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs])
    x = np.concatenate([x, 0.9501 * x[:pairs] + (1 - 0.9501**2) ** 0.5 * turn]).astype(np.float32)
    return [(i, v, 1) for i, v in enumerate(x.tolist())], pairs
