"""Map objects from OSM XML: nodes, ways and areas with their tags and geometry.

Objects keep a sequence number (class, id): nodes before ways before areas, which is the order in which first-wins
rules see them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postalith.functions import geometry as g
from postalith.ship import ship

_TAGS = "tag array<struct<_k:string,_v:string>>"
NODE = f"_id bigint, _lat double, _lon double, {_TAGS}"
WAY = f"_id bigint, nd array<struct<_ref:bigint>>, {_TAGS}"
RELATION = f"_id bigint, member array<struct<_type:string,_ref:bigint,_role:string>>, {_TAGS}"


def tag_map(tags: Column) -> Column:
    """Key-value pairs as a map; of a repeated key the last value counts."""
    pairs = F.coalesce(tags, F.array().cast("array<struct<_k:string,_v:string>>"))
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["_k"] == x["_k"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["_k"].alias("key"), x["_v"].alias("value"))))


def _read(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    rows = spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)
    return rows.withColumn("tags", tag_map(F.col("tag"))).drop("tag")


def wanted(tags: Column) -> Column:
    """The key filter that goes with the scan."""
    return F.map_contains_key(tags, "boundary") | F.map_contains_key(tags, "addr:postcode")


def stitch(parts: list[tuple[str, list[int]]]) -> list[tuple[bool, list[int]]]:
    """Closed rings of node numbers from the parts (role, nodes) of a relation; what does not close makes it fail: []."""
    rings = []
    for outer in (True, False):
        todo = [list(p) for role, p in parts if (role != "inner") == outer and len(p) > 1]
        while todo:
            ring = todo.pop()
            while ring[0] != ring[-1]:
                for i, other in enumerate(todo):
                    if ring[-1] in (other[0], other[-1]):
                        ring += other[1:] if other[0] == ring[-1] else other[-2::-1]
                        del todo[i]
                        break
                else:
                    return []
            if len(ring) < 4:
                return []
            rings.append((outer, ring))
    return rings


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """(seq, kind, tags, rings, px, py) of all objects with a boundary or addr:postcode key.

    kind is point, line or area. Areas come from closed ways and from multipolygon and boundary relations; one whose
    outline is incomplete or does not close is dropped. A point or line without places stays, with null px and py.
    """
    ship(spark)
    ways = _read(spark, path, "way", WAY).select("_id", F.transform("nd", lambda x: x["_ref"]).alias("refs"), "tags")
    return assemble(_read(spark, path, "node", NODE), ways, _read(spark, path, "relation", RELATION))


def assemble(nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> DataFrame:
    """Objects with geometry from nodes (_id, _lat, _lon, tags), ways (_id, refs, tags) and relations (_id, member, tags)."""
    valid = F.col("_lat").between(-90, 90) & F.col("_lon").between(-180, 180)
    places = nodes.where(valid).select(F.col("_id").alias("ref"), F.col("_lon").alias("x"), F.col("_lat").alias("y"))
    points = nodes.where(wanted(F.col("tags"))).select(
        F.struct(F.lit(0).alias("class"), F.col("_id").alias("id")).alias("seq"), F.lit("point").alias("kind"), "tags", F.lit(None).cast(g.RINGS).alias("rings"),
        F.when(valid, F.col("_lon")).alias("px"), F.when(valid, F.col("_lat")).alias("py"),
    )

    refs = ways.select(F.col("_id").alias("way"), "tags", "refs")
    closed = (F.size("refs") >= 4) & (F.element_at("refs", 1) == F.element_at("refs", -1)) & (F.coalesce(F.col("tags")["area"], F.lit("")) != "no")
    kept = refs.where(wanted(F.col("tags")))
    # a closed way comes back as an area; a way that is closed but no area is no line either
    lines = _placed(kept.where(F.element_at("refs", 1) != F.element_at("refs", -1)).select("way", "tags", "refs"), places)
    middle = F.element_at("pts", (F.size("pts") / 2).cast("int") + 1)
    lines = lines.select(
        F.struct(F.lit(1).alias("class"), F.col("way").alias("id")).alias("seq"), F.lit("line").alias("kind"), "tags", F.lit(None).cast(g.RINGS).alias("rings"),
        F.when(F.col("whole"), middle["x"]).alias("px"), F.when(F.col("whole"), middle["y"]).alias("py"),
    )
    rings = _placed(kept.where(closed).select("way", "tags", "refs"), places).where("whole")
    from_ways = rings.select((F.col("way") * 2).alias("id"), "tags", F.array(F.struct(F.lit(True).alias("outer"), "pts")).alias("rings"))

    shaped = relations.where(wanted(F.col("tags")) & F.col("tags")["type"].isin("multipolygon", "boundary"))
    members = shaped.select("_id", F.posexplode("member").alias("at", "m")).where("m._type = 'way'").select("_id", "at", F.col("m._ref").alias("way"), F.col("m._role").alias("role"))
    parts = members.join(refs.select("way", "refs"), "way", "left").groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("at", "role", "refs"))).alias("parts"))

    @F.pandas_udf("array<struct<outer:boolean,refs:array<bigint>>>")
    def assemble(column: pd.Series) -> pd.Series:
        out = []
        for parts in column:
            if any(p["refs"] is None for p in parts):
                out.append([])
            else:
                out.append([{"outer": o, "refs": r} for o, r in stitch([(p["role"] or "", list(p["refs"])) for p in parts])])
        return pd.Series(out)

    made = parts.select("_id", F.posexplode(assemble("parts")).alias("ring", "r")).select("_id", "ring", F.col("r.outer").alias("outer"), F.col("r.refs").alias("refs"))
    made = _placed(made.select(F.struct("_id", "ring", "outer").alias("way"), F.lit(None).alias("tags"), "refs"), places)
    whole = made.groupBy("way._id").agg(F.bool_and("whole").alias("whole"), F.sort_array(F.collect_list(F.struct("way.ring", "way.outer", "pts"))).alias("r")).where("whole")
    from_relations = whole.join(shaped.select("_id", "tags"), "_id").select(
        (F.col("_id") * 2 + 1).alias("id"), "tags", F.transform("r", lambda x: F.struct(x["outer"].alias("outer"), x["pts"].alias("pts"))).alias("rings")
    )
    areas = g.with_inner_point(from_ways.unionByName(from_relations).withColumn("rings", g.normalize_rings(F.col("rings"))))
    areas = areas.select(F.struct(F.lit(2).alias("class"), "id").alias("seq"), F.lit("area").alias("kind"), "tags", "rings", F.col("p.x").alias("px"), F.col("p.y").alias("py"))
    return points.unionByName(lines).unionByName(areas)


def _placed(lines: DataFrame, places: DataFrame) -> DataFrame:
    """(way, tags, refs) with pts, the places of its nodes in order, and whether all are known."""
    spread = lines.select("way", F.posexplode("refs").alias("at", "ref")).join(places, "ref", "left")
    pts = spread.groupBy("way").agg(F.sort_array(F.collect_list(F.struct("at", "x", "y"))).alias("p"), F.bool_and(F.col("x").isNotNull()).alias("whole"))
    pts = pts.select("way", "whole", F.transform("p", lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"))).alias("pts"))
    return lines.select("way", "tags").join(pts, "way")
