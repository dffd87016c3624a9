import numpy as np
import pytest
from pyspark.sql import functions as F

from postalith.functions import geometry as g
from postalith.operators import spatial as sp

SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]
STAR = [(2, 0), (2.5, 1.5), (4, 2), (2.5, 2.5), (2, 4), (1.5, 2.5), (0, 2), (1.5, 1.5), (2, 0)]


def shapes(spark, items, key="key"):
    rows = [(k, i, k, [(outer, [(float(x), float(y)) for x, y in pts]) for outer, pts in rings]) for i, (k, rings) in enumerate(items)]
    return spark.createDataFrame(rows, f"{key} string, seq int, name string, rings {g.RINGS}")


def inside(rings, x, y):
    n = 0
    for _, pts in rings:
        for (x1, y1), (x2, y2) in zip(pts, pts[1:]):
            n += ((y1 > y) != (y2 > y)) & (x < x1 + (y - y1) * (x2 - x1) / np.where(y2 == y1, 1, y2 - y1))
    return n % 2 == 1


def test_first_covering_shape_counts_borders(spark):
    places = shapes(spark, [("holed", [(True, SQUARE), (False, HOLE)]), ("star", [(True, STAR)])])
    points = spark.createDataFrame([("corner", 0.0, 0.0), ("edge", 4.0, 2.5), ("hole", 2.0, 2.0), ("rim", 1.0, 2.0), ("out", 9.0, 9.0)], "p string, px double, py double")
    got = {r["p"]: r["name"] for r in sp.first_name(points, "p", places).collect()}
    assert got == {"corner": "holed", "edge": "holed", "hole": "star", "rim": "holed", "out": ""}


@pytest.mark.parametrize("right", [[(True, [(-1, -1), (2, -1), (2, 2), (-1, 2), (-1, -1)])], [(True, STAR)], [(True, [(9, 9), (10, 9), (10, 10), (9, 10), (9, 9)])]])
def test_overlap_matches_a_grid(spark, right):
    left = [(True, SQUARE), (False, HOLE)]
    a = shapes(spark, [("a", left)]).select(F.col("key").alias("akey"), "rings")
    b = shapes(spark, [("b", right)]).select(F.col("key").alias("bkey"), "rings")
    rows = sp.overlapping(a, b, 0.0).collect()
    n = 800
    x, y = np.meshgrid((np.arange(n) + 0.5) * 4 / n, (np.arange(n) + 0.5) * 4 / n)
    both = (inside(left, x, y) & inside(right, x, y)).mean() * 16
    assert (rows[0]["ratio"] if rows else 0.0) * 12 == pytest.approx(both, abs=0.02)


def test_inner_point_area_and_meeting(spark):
    strip = [(True, [(9.8, 0), (11, 0), (11, 10), (9.8, 10), (9.8, 0)])]
    df = g.with_inner_point(shapes(spark, [("strip", strip), ("holed", [(True, SQUARE), (False, HOLE)])]))
    got = {r["key"]: (r["p"]["x"], r["a"]) for r in df.select("key", "p", g.area(F.col("rings")).alias("a")).collect()}
    assert got["strip"][0] == pytest.approx(10.4) and got["holed"][1] == pytest.approx(12)
    assert got["holed"][0] in (0.5, 3.5)
    a = shapes(spark, [("a", strip)]).select(F.col("key").alias("akey"), "rings")
    b = shapes(spark, [("touch", [(True, [(11, 0), (12, 0), (12, 1), (11, 1), (11, 0)])]), ("far", [(True, [(13, 0), (14, 0), (14, 1), (13, 1), (13, 0)])])]).select(F.col("key").alias("bkey"), "rings")
    assert [r["bkey"] for r in sp.intersecting(a, b).collect()] == ["touch"]
