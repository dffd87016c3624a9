"""Tools that several operators share: scratch tables, global ranks and connected groups."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postalith.store import made, remove, shared_dir

#: The white space that separates words in every word-based operator.
WORD = r"[^\x20\x09-\x0D]+"


#: Scratch tables are read once or twice: they are not worth much time to compress.
_QUICK = ("parquet.compression.codec.zstd.level", "1")
_stages: dict[str, Scratch] = {}


class Scratch:
    """Tables written to the shared folder, to cut lineage and to use a costly result twice.

    A lost executor loses none of them. ``drop`` frees one that only later tables were made from.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.tables: dict[str, str] = {}
        self.root = made(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")

    @classmethod
    def stage(cls, spark: SparkSession, name: str, frees: str | None = None) -> Scratch:
        """Scratch of a pipeline stage. It frees that of the stage it names, whose result is written by now."""
        if frees in _stages:
            _stages.pop(frees).clear()
        _stages[name] = cls(spark, name)
        return _stages[name]

    def clear(self) -> None:
        self.drop(*list(self.tables))
        remove(self.spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        df.write.mode("overwrite").option("compression", compression).option(*_QUICK).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def bucketed(self, df: DataFrame, name: str, key: str, compression: str = "snappy", dealt: bool = False) -> DataFrame:
        """A table whose rows lie by the hash of a key: joins and aggregations on it need not move them.

        dealt says that df comes out of a shuffled join on the key, so each bucket is in one task already.
        """
        count = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        table = f"postalith_{uuid.uuid4().hex}"
        where = (df if dealt else df.repartition(count, key)).write.bucketBy(count, key).option("path", self.path(name)).option("compression", compression).option(*_QUICK)
        where.saveAsTable(table)
        self.tables[name] = table
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(name)}")
            remove(self.spark, self.path(name))


def global_rank(df: DataFrame, keys: list[Column | str], scratch: Scratch, name: str, rank: str = "rank") -> DataFrame:
    """Number the rows from 0 in the order of the keys, without bringing them to one task.

    Rows are range-partitioned and sorted, the numbered partitions are written once (range bounds are sampled, so
    they must not be drawn again), and each partition's rows are shifted by what lies before. Only one count per
    partition comes to the driver. Keys should end in something that tells rows apart, else a large tie is one task.
    """
    held = scratch.keep(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), name
    )
    part = F.shiftright(F.col("_at"), 33)
    counts = sorted((r["p"], r["n"]) for r in held.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for p, n in counts:
        offsets.append((p, total))
        total += n
    table = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    return (
        held.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .withColumn(rank, F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_offset", "_at")
    )


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected groups of an undirected graph (a, b of type long): a row (node, component) for each node of an edge.

    component is the smallest node of the group. Each round hooks every node to its smallest neighbour, follows the
    hooks to their roots by pointer doubling, and contracts the graph; the number of nodes at least halves, so rounds
    grow with the logarithm of the graph. All is joins and partial minima over written tables: a node with very many
    neighbours is pre-aggregated on the map side and its joins can be split. Self links give a group of their own.
    """
    spark = edges.sparkSession
    step = 0
    work = scratch.keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-e0")
    labels = None
    while True:
        both = work.select("a", "b").union(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = scratch.keep(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up")), f"{name}-h{step}-0"
        )
        jump = 0
        while hooks.where("node <> up").limit(1).count():
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            moved = hooks.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved"))
            hooks = scratch.keep(moved, f"{name}-h{step}-{jump + 1}")
            scratch.drop(f"{name}-h{step}-{jump}")
            jump += 1
            if not hooks.where("moved").limit(1).count():
                break
        hooks = hooks.select("node", "up")
        if labels is None:
            now = hooks.select("node", F.col("up").alias("component"))
        else:
            up = hooks.select(F.col("node").alias("component"), "up")
            now = labels.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        labels = scratch.keep(now, f"{name}-l{step}")
        left = hooks.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        right = hooks.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        work = scratch.keep(
            work.join(left, "a").join(right, "b").where("ua <> ub")
            .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(),
            f"{name}-e{step + 1}",
        )
        scratch.drop(f"{name}-e{step}", f"{name}-h{step}-{jump}", *([f"{name}-l{step - 1}"] if step else []))
        step += 1
        if not work.limit(1).count():
            return spark.read.schema(labels.schema).parquet(scratch.path(f"{name}-l{step - 1}"))


def extended(labels: DataFrame, more: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The groups (node, component) of a graph that also has the links more (a, b); nodes of theirs may be new.

    The graph is first contracted by the groups it has, so only links between different groups are followed.
    """
    of = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    lifted = more.join(of("a"), "a", "left").join(of("b"), "b", "left")
    lifted = scratch.keep(lifted.select("a", "b", "of_a", "of_b", F.coalesce("of_a", "a").alias("x"), F.coalesce("of_b", "b").alias("y")), f"{name}-lifted")
    if not lifted.where("x <> y").limit(1).count():
        return labels
    merged = components(lifted.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")), scratch, name)
    # nodes that no group has yet stand for themselves; each comes once, however many links it has
    new = lifted.where("of_a is null").select("a").union(lifted.where("of_b is null").select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    every = labels.unionByName(new).join(merged.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left")
    return scratch.keep(every.select("node", F.coalesce("now", "component").alias("component")), f"{name}-labels")


#: The rows of one key in a join of join_hot are at most this part of all, where the key's other rows do not share a task.
PART = 1000


def join_hot(left: DataFrame, right: DataFrame, on: str, rows: str) -> DataFrame:
    """An inner join on a key that stands once in right; rows names right's column with how often it stands in left.

    Keys with a thousandth of the rows or more, a thousand at most, are broadcast, so their rows stay where they are.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    hot = F.col(rows) * PART >= total
    some = F.broadcast(right.where(hot))
    rest = left.join(some.select(on), on, "left_anti").join(right.where(~hot), on)
    return left.join(some, on).unionByName(rest)


#: Numbers of 64 bits in the filter of perhaps: half a megabyte, whatever the table.
NUMBERS = 1 << 16


def perhaps(left: DataFrame, right: DataFrame, on: list[str], others: bool = False) -> DataFrame:
    """The rows of left whose key may be in right, and some more; or, with others, all the rest, which surely is not.

    A broadcast table of 2 ** 22 bits tells. So rows without a partner need not move before a join; where right
    has very many keys no row is held back, and the join is the same. Keys are not null.
    """
    h = lambda: F.xxhash64(F.lit(3), *on)
    number = lambda: F.pmod(F.shiftrightunsigned(h(), 6), F.lit(NUMBERS)).cast("int").alias("_number")
    bit = lambda: F.call_function("shiftleft", F.lit(1).cast("long"), h().bitwiseAND(F.lit(63)).cast("int"))
    bits = right.select(number(), bit().alias("_bit")).groupBy("_number").agg(F.bit_or("_bit").alias("_bits"))
    told = left.select("*", number(), bit().alias("_bit")).join(F.broadcast(bits), "_number", "left")
    has = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))
    return told.where(~has if others else has).select(*left.columns)
