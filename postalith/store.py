"""Tables held in the folder that the driver and the executors share, to cut long plans."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from postalith.ship import ship

_own: str | None = None
_made: list[tuple[SparkSession, str]] = []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file systems."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def made(spark: SparkSession, path: str) -> str:
    """Remember a folder, to delete it when Python ends."""
    _made.append((spark, path))
    return path


def _clear() -> None:
    for spark, path in _made:
        if spark.sparkContext._jsc is None:  # stopped: only what this machine sees can go
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
        else:
            remove(spark, path)


atexit.register(_clear)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, named by spark.checkpoint.dir.

    Where the setting is absent a temporary folder stands in for it, but only on one machine: a cluster's executors
    would not see it, so there its absence raises.
    """
    ship(spark)
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    global _own
    if _own is None:
        _own = tempfile.mkdtemp(prefix="postalith-")
        atexit.register(shutil.rmtree, _own, True)
    return f"file://{_own}"


def held(df: DataFrame) -> DataFrame:
    """The same rows, written once and read from there: a lost executor loses nothing, and the plan starts anew."""
    path = made(df.sparkSession, f"{shared_dir(df.sparkSession)}/held-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
