"""What several of the corpus operators share: reading tables, cutting lineage, labels, samples and components."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Most bytes of an Arrow batch; a longer row is a batch of its own.
BATCH_BYTES = 8 << 20


def arrow_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bounds the rows and bytes of an Arrow batch, so that a batch of long texts fits a Python worker.

    Python workers also get this library's folder as a place to import from; where executors don't see that folder, the
    library is shipped with --py-files.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    home = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([x for x in known if x] + [home])


def plus(df: DataFrame, column: str, kind: str) -> T.StructType:
    """The schema of `df` and one more column."""
    return T.StructType([*df.schema.fields, T.StructField(column, T._parse_datatype_string(kind))])


def unused(df: DataFrame, name: str) -> str:
    """`name`, or the first of it with underscores that no column of `df` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it; without one, only a local session has a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.gettempdir() + "/checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut, kept in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    own = df.checkpoint(eager=True)
    tidied(df.sparkSession)
    return own


def stored(df: DataFrame, *by: str) -> DataFrame:
    """The same rows as a Parquet table of its own in the shared folder, which readers take columns of, and parts by the values of `by`."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidied(spark: SparkSession) -> None:
    """Has the driver give back what earlier jobs left: their garbage, and with it shuffle files that nothing refers to.

    They go when the driver's JVM collects its garbage, which it seldom does by itself.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def bucket(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % n


def held_out(doc_id: str, n: int, r: int) -> Column:
    return F.coalesce(bucket(doc_id, n) == r, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, n: int, r: int, most: int) -> DataFrame:
    """(doc_id, text, y) of at most `most` labelled documents outside the held-out fold, the same ones every time.

    Both labels get half of the places, by hash of the id, as far as they have rows.  A document whose label rows
    disagree counts as unlabelled.  Only ids and labels are ordered; the texts of the chosen ones are then looked up.
    """
    known = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & (bucket("doc_id", n) != r))
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_most")).where("y = _most").drop("_most")
    )
    chosen = None
    for y in (0, 1):
        own = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2)
        chosen = own if chosen is None else chosen.unionByName(own)
    # `most` ids and flags: a few hundred kB at most.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())


#: Rows of a partition that `packed` and `components` aim at.
PART_ROWS = 100_000
#: Edges that a task of `components` holds at a time.
EDGES = 2_000_000


def _parts(rows: int) -> int:
    return max(1, -(-rows // PART_ROWS))


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """`cut`, in no more partitions than the measured number of rows needs, and that number: each partition costs the next shuffle a file."""
    rows = Observation()
    own = cut(df.observe(rows, F.count(F.lit(1)).alias("n")))
    n = rows.get["n"]
    return own.coalesce(_parts(n)), n


def packed(df: DataFrame) -> DataFrame:
    """`counted` without the number."""
    return counted(df)[0]


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, other) for every node but the least one of each connected part of the edges (u, v)."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        for end in (a, b, label[a], label[b]):
            np.minimum.at(after, end, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    other = np.flatnonzero(label != np.arange(len(ids)))
    return ids[label[other]], ids[other]


def _contracted(batches):
    """Edges (u, v), of each u together, as stars; a u whose edges go on beyond what is held takes its least node along."""
    held: list[pa.Table] = []

    def flush(last: bool):
        u, v = (pa.concat_arrays([x.column(c).combine_chunks() if isinstance(x.column(c), pa.ChunkedArray) else x.column(c) for x in held]).to_numpy(zero_copy_only=False) for c in ("u", "v"))
        root, node = _stars(u, v)
        held.clear()
        if not last:
            least = min([u[-1], *root[node == u[-1]]])
            if least != u[-1]:
                held.append(pa.RecordBatch.from_arrays([pa.array([u[-1]]), pa.array([least])], names=["u", "v"]))
        return pa.RecordBatch.from_arrays([pa.array(root), pa.array(node)], names=["u", "v"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= EDGES:
            yield flush(False)
    if held:
        yield flush(True)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable, for every id that some link has.

    Each round deals the edges, both ways round, by one end, and every task turns the parts that its edges connect into
    stars around their least node; it ends when no node has two such centres or is one itself.  A round shuffles edges
    only; rounds grow with the logarithm of a chain's length.  Tasks hold EDGES edges at a time, however many a node has.
    """
    kind = links.schema[a].dataType.simpleString()
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    while True:
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        edges = packed(both.repartition("u").sortWithinPartitions("u").mapInArrow(_contracted, f"u {kind}, v {kind}"))
        ends = edges.select(F.inline(F.array(F.struct(F.col("v").alias("id"), "u"), F.struct(F.col("u").alias("id"), F.lit(None).cast(kind).alias("u")))))
        labels = ends.groupBy("id").agg(F.min("u").alias("component"), F.max("u").alias("most"), F.bool_or(F.col("u").isNull()).alias("centre"))
        unsettled = Observation()
        labels = cut(labels.observe(unsettled, F.count_if(F.expr("component <> most or (component is not null and centre)")).alias("n")))
        if not unsettled.get["n"]:
            return labels.select("id", F.coalesce("component", "id").alias("component"))
