"""Planar geometry in SQL: edges, covering, shared area, and a point inside. Coordinates are plain degrees.

A geometry is its edges (x1, y1, x2, y2). Outer rings run counter-clockwise and holes clockwise, so that a sum over
edges of signed areas below them counts holes off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
RINGS = f"array<struct<outer:boolean,pts:array<{POINT}>>>"


def ring_area(pts: Column) -> Column:
    """Signed area of a closed ring: positive if it runs counter-clockwise."""
    pairs = F.sequence(F.lit(1), F.size(pts) - 1)
    step = lambda i: F.element_at(pts, i)["x"] * F.element_at(pts, i + 1)["y"] - F.element_at(pts, i + 1)["x"] * F.element_at(pts, i)["y"]
    return F.aggregate(F.transform(pairs, step), F.lit(0.0), lambda a, x: a + x) / 2


def normalize_rings(rings: Column) -> Column:
    """Outer rings counter-clockwise, holes clockwise."""
    turned = lambda r: F.when((ring_area(r["pts"]) > 0) == r["outer"], r["pts"]).otherwise(F.reverse(r["pts"]))
    return F.transform(rings, lambda r: F.struct(r["outer"].alias("outer"), turned(r).alias("pts")))


def area(rings: Column) -> Column:
    return F.aggregate(F.transform(rings, lambda r: F.abs(ring_area(r["pts"])) * F.when(r["outer"], 1.0).otherwise(-1.0)), F.lit(0.0), lambda a, x: a + x)


def bbox(rings: Column) -> dict[str, Column]:
    xs = F.flatten(F.transform(rings, lambda r: F.transform(r["pts"], lambda p: p["x"])))
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r["pts"], lambda p: p["y"])))
    return {"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys)}


def edge_array(rings: Column) -> Column:
    """All edges of all rings as structs (x1, y1, x2, y2)."""
    of = lambda pts: F.transform(
        F.sequence(F.lit(1), F.size(pts) - 1),
        lambda i: F.struct(
            F.element_at(pts, i)["x"].alias("x1"), F.element_at(pts, i)["y"].alias("y1"),
            F.element_at(pts, i + 1)["x"].alias("x2"), F.element_at(pts, i + 1)["y"].alias("y2"),
        ),
    )
    return F.flatten(F.transform(rings, lambda r: of(r["pts"])))


def crosses(e: Column, px: Column, py: Column) -> Column:
    """1 if a ray from the point to the right crosses the edge, else 0."""
    at = e["x1"] + F.try_divide((py - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
    return F.when(((e["y1"] > py) != (e["y2"] > py)) & (px < at), 1).otherwise(0)


def touches(e: Column, px: Column, py: Column) -> Column:
    """Whether the point lies on the edge."""
    cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
    inside = px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    return (cross == 0) & inside


def covers(edge_list: Column, px: Column, py: Column) -> Column:
    """Whether a shape, given by all its edges, covers the point; its border counts."""
    crossed = F.aggregate(edge_list, F.lit(0), lambda n, e: n + crosses(e, px, py))
    return (crossed % 2 == 1) | F.exists(edge_list, lambda e: touches(e, px, py))


def shared_area(a: Column, b: Column) -> Column:
    """Part of the common area of two shapes that one pair of edges gives: sum it over all pairs.

    Over the x-range that both edges span it is the signed integral of the lower of the two lines, which is two
    trapezoids parted where the lines cross. Vertical edges give 0.
    """
    lo = F.greatest(F.least(a["x1"], a["x2"]), F.least(b["x1"], b["x2"]))
    hi = F.least(F.greatest(a["x1"], a["x2"]), F.greatest(b["x1"], b["x2"]))
    sign = F.signum(a["x1"] - a["x2"]) * F.signum(b["x1"] - b["x2"])
    at = lambda x, e: e["y1"] + F.try_divide((x - e["x1"]) * (e["y2"] - e["y1"]), e["x2"] - e["x1"])
    al, ah, bl, bh = at(lo, a), at(hi, a), at(lo, b), at(hi, b)
    dl, dh = al - bl, ah - bh
    part = F.try_divide(dl, dl - dh)  # where the lines cross, as a share of the range
    mid = al + (ah - al) * part
    low_l, low_h = F.least(al, bl), F.least(ah, bh)
    two = part * (low_l + mid) / 2 + (1 - part) * (mid + low_h) / 2
    value = (hi - lo) * F.when(dl * dh < 0, two).otherwise((low_l + low_h) / 2)
    return F.when((hi > lo) & (a["x1"] != a["x2"]) & (b["x1"] != b["x2"]), sign * value).otherwise(0.0)


def overlap(edges_a: Column, edges_b: Column) -> Column:
    """Common area of two shapes given by their edges: holes and bent outlines included, nothing is clipped."""
    row = lambda a: F.aggregate(edges_b, F.lit(0.0), lambda n, b: n + shared_area(a, b))
    return F.aggregate(edges_a, F.lit(0.0), lambda n, a: n + row(a))


def meet(edges_a: Column, edges_b: Column) -> Column:
    """Whether two outlines share a point."""
    side = lambda e, x, y: F.signum((e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]))

    def pair(a: Column, b: Column) -> Column:
        ends = touches(a, b["x1"], b["y1"]) | touches(a, b["x2"], b["y2"]) | touches(b, a["x1"], a["y1"]) | touches(b, a["x2"], a["y2"])
        cross = (side(a, b["x1"], b["y1"]) * side(a, b["x2"], b["y2"]) < 0) & (side(b, a["x1"], a["y1"]) * side(b, a["x2"], a["y2"]) < 0)
        return ends | cross

    return F.exists(edges_a, lambda a: F.exists(edges_b, lambda b: pair(a, b)))


def with_inner_point(shapes: DataFrame, name: str = "p", rings: str = "rings") -> DataFrame:
    """Add a point inside: the middle of the widest inner section along a line at about half height.

    The line lies between the two vertex heights next to half height, so it meets no vertex. Null if there is none.
    """
    steps = shapes.withColumn("_e", edge_array(F.col(rings)))
    steps = steps.withColumn("_h", F.array_sort(F.array_distinct(F.transform("_e", lambda e: e["y1"]))))
    half = (F.array_min("_h") + F.array_max("_h")) / 2
    steps = steps.withColumn("_half", half)
    below, above = F.filter("_h", lambda y: y <= F.col("_half")), F.filter("_h", lambda y: y > F.col("_half"))
    steps = steps.withColumn("_y", (F.array_max(below) + F.array_min(above)) / 2)
    hit = F.filter("_e", lambda e: (e["y1"] > F.col("_y")) != (e["y2"] > F.col("_y")))
    steps = steps.withColumn("_x", F.array_sort(F.transform(hit, lambda e: e["x1"] + (F.col("_y") - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))))
    even = F.filter("_x", lambda x, i: i % 2 == 0)
    odd = F.filter("_x", lambda x, i: i % 2 == 1)
    steps = steps.withColumn("_s", F.zip_with(even, odd, lambda a, b: F.struct((b - a).alias("width"), ((a + b) / 2).alias("x"))))
    point = F.when(F.size("_x") >= 2, F.struct(F.array_max("_s")["x"].alias("x"), F.col("_y").alias("y")))
    return steps.withColumn(name, point).drop("_e", "_h", "_half", "_y", "_x", "_s")
