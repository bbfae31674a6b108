"""Cutting lineage with written tables in the cluster's checkpoint folder."""

from __future__ import annotations

import gc
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# of each thread, the cuts of every settled() it is in
_inside = threading.local()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder in the shared one named by ``spark.checkpoint.dir``.

    A session whose checkpoint folder was set on the context keeps that one. Where
    none is named and all runs in this process, as in tests, the warehouse folder
    is used; a cluster must name one, as its executors share no other.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getCheckpointDir()
    if root is None and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if root is None:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    # one folder per application, so that it can be removed after a run
    return f"{root.rstrip('/')}/kerbstone/{spark.sparkContext.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as Parquet in the scratch folder and read it back.

    Unlike an in-memory copy this survives lost executors, and unlike an RDD
    checkpoint later steps can prune its columns and see its size on disk.
    """
    path = f"{scratch_root(df.sparkSession)}/{uuid.uuid4().hex}"
    for made in getattr(_inside, "made", [])[-1:]:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """:func:`cut` of what ``make`` returns, without the cuts that it took.

    Those are removed, so nothing but the result may read them. The JVM is asked to
    collect, as Spark removes a shuffle's files only when its plan is collected.
    """
    _inside.made = [*getattr(_inside, "made", []), []]
    try:
        out = make()
        took = _inside.made[-1]
        _inside.made[-1] = []
        out = cut(out)
        kept = _inside.made[-1]
    finally:
        _inside.made = _inside.made[:-1]
    for made in _inside.made[-1:]:
        made += kept
    for path in took:
        _remove(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def discard(df: DataFrame) -> None:
    """Remove the folder of one :func:`cut` whose rows nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return
    path = files[0].rsplit("/", 1)[0]
    if not path.split(":")[-1].lstrip("/").startswith(scratch_root(spark).split(":")[-1].lstrip("/")):
        raise ValueError("not a cut of this application")
    _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application has cut; its results must be written or taken."""
    _remove(spark, scratch_root(spark))
