"""The folder that driver and executors share, and lineage that is cut there."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; only a local session without one has a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="spark-")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, kept in the shared folder: they survive lost executors and are not worked out again."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    own = df.checkpoint()
    # Shuffle files that led here go when the driver collects its garbage, which it seldom does by itself.
    gc.collect()
    sc._jvm.System.gc()
    return own


def kept(df: DataFrame) -> DataFrame:
    """The same rows as `cut` keeps them, as a Parquet table: by columns and compressed, a small part of a checkpoint's bytes."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """The same rows, for a join of rows as many as the data's: by a shuffle, never by a broadcast.

    Spark estimates a table by the size of its files.  Texts that are made of a few bytes of a compressed column are
    hundreds of times as large, and what seems small enough for a broadcast then fills the driver.
    """
    return df.hint("merge")


def dealt(df: DataFrame, by: str) -> DataFrame:
    """The same rows, those of equal `by` in one partition: what is dealt so is joined, summed and numbered by `by` and more without another shuffle."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")  # else a join by more keys deals both sides anew
    return df.repartition(int(conf.get("spark.sql.shuffle.partitions")), by)


def spread(df: DataFrame) -> DataFrame:
    """The same rows, dealt over all of a shuffle's partitions before work that is long for a row and its few bytes.

    A scan makes as many tasks as its files have bytes and row groups, and adaptive plans join small partitions: a million
    short rows are one task or two, whatever is done with each.  A number that is given is kept as it is.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
