"""Spatial joins by grid cell: shapes and points, or shapes and shapes, that share a cell are tested exactly.

A shape is (key, seq, name, ..., rings). Cells make the joins equi-joins: a hot cell is one key whose join can be
split, and no side is assumed to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postalith.functions import geometry as g
from postalith.plans.config import MIN_OVERLAP

#: Side of a cell in degrees.
CELL = 0.5


def _cells(lo: Column, hi: Column, size: float) -> Column:
    return F.sequence(F.floor(lo / size).cast("int"), F.floor(hi / size).cast("int"))


def celled(shapes: DataFrame, rings: str = "rings", size: float = CELL) -> DataFrame:
    """A row for each cell that the shape's bounding box meets, with its edges."""
    box = g.bbox(F.col(rings))
    rest = [c for c in shapes.columns if c != rings]
    wide = shapes.where(F.size(rings) > 0).select(*rest, g.edge_array(g.normalize_rings(F.col(rings))).alias("edges"), *[v.alias(k) for k, v in box.items()])
    wide = wide.withColumn("cx", F.explode(_cells(F.col("xmin"), F.col("xmax"), size)))
    return wide.withColumn("cy", F.explode(_cells(F.col("ymin"), F.col("ymax"), size)))


def covering(points: DataFrame, shapes: DataFrame, rings: str = "rings", size: float = CELL) -> DataFrame:
    """Pairs of points (px, py) and the shapes that cover them, borders included: columns of both."""
    at = points.withColumn("cx", F.floor(F.col("px") / size).cast("int")).withColumn("cy", F.floor(F.col("py") / size).cast("int"))
    near = F.col("px").between(F.col("xmin"), F.col("xmax")) & F.col("py").between(F.col("ymin"), F.col("ymax"))
    met = at.join(celled(shapes, rings, size), ["cx", "cy"]).where(near & g.covers(F.col("edges"), F.col("px"), F.col("py")))
    return met.drop("cx", "cy", "edges", "xmin", "xmax", "ymin", "ymax")


def first_name(points: DataFrame, key: str, shapes: DataFrame) -> DataFrame:
    """(key, name) for every point: the name of the first covering shape by seq, '' if none covers it."""
    found = covering(points.select(key, "px", "py"), shapes.select("seq", "name", "rings")).groupBy(key).agg(F.min_by("name", "seq").alias("name"))
    return points.select(key).join(found, key, "left").select(key, F.coalesce("name", F.lit("")).alias("name"))


def any_covers(points: DataFrame, key: str, shapes: DataFrame) -> DataFrame:
    """Keys of points that some shape covers: covering a union is being covered by a part."""
    return covering(points.select(key, "px", "py"), shapes.select("rings")).select(key).distinct()


def pairs(left: DataFrame, right: DataFrame, size: float = CELL) -> DataFrame:
    """Shapes (akey, rings) and (bkey, rings) whose boxes meet, once each, with a_edges and b_edges."""
    a = celled(left, size=size).select("akey", F.col("edges").alias("a_edges"), *(F.col(c).alias(f"a_{c}") for c in ("xmin", "xmax", "ymin", "ymax")), "cx", "cy")
    b = celled(right, size=size).select("bkey", F.col("edges").alias("b_edges"), *(F.col(c).alias(f"b_{c}") for c in ("xmin", "xmax", "ymin", "ymax")), "cx", "cy")
    meet = (F.col("a_xmin") <= F.col("b_xmax")) & (F.col("b_xmin") <= F.col("a_xmax")) & (F.col("a_ymin") <= F.col("b_ymax")) & (F.col("b_ymin") <= F.col("a_ymax"))
    # of the cells that both boxes meet only the first counts, so that each pair comes once without a shuffle
    first = (F.col("cx") == F.floor(F.greatest("a_xmin", "b_xmin") / size)) & (F.col("cy") == F.floor(F.greatest("a_ymin", "b_ymin") / size))
    return a.join(b, ["cx", "cy"]).where(meet & first).select("akey", "bkey", "a_edges", "b_edges")


def overlapping(left: DataFrame, right: DataFrame, least: float = MIN_OVERLAP) -> DataFrame:
    """(akey, bkey, ratio) of pairs whose common area is at least this share of the left shape's area.

    A left shape without area counts whole (ratio 1) for the shapes that cover its first point.
    """
    own = F.abs(F.aggregate(F.col("a_edges"), F.lit(0.0), lambda n, e: n + (e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2))
    first = F.element_at("a_edges", 1)
    flat = F.when(g.covers(F.col("b_edges"), first["x1"], first["y1"]), 1.0).otherwise(0.0)
    ratio = F.when(own > 0, F.try_divide(g.overlap(F.col("a_edges"), F.col("b_edges")), own)).otherwise(flat)
    return pairs(left, right).select("akey", "bkey", ratio.alias("ratio")).where(F.col("ratio") >= least)


def intersecting(left: DataFrame, right: DataFrame) -> DataFrame:
    """(akey, bkey) of pairs that share a point."""
    inside = lambda outer, inner: g.covers(outer, F.element_at(inner, 1)["x1"], F.element_at(inner, 1)["y1"])
    a, b = F.col("a_edges"), F.col("b_edges")
    return pairs(left, right).where(g.meet(a, b) | inside(a, b) | inside(b, a)).select("akey", "bkey")
