"""Sinks: tables published together under one manifest, and small documents as stable JSON."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stable_json(value: object) -> str:
    """Sorted names, two spaces, one newline at the end."""
    return json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False) + "\n"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm.org.apache.hadoop.fs.Path


def digest(df: DataFrame) -> str:
    """A digest of the rows, whatever their order: sums of two hashes, and the count."""
    text = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    row = df.agg(F.count("*"), F.sum(F.xxhash64(text).cast("decimal(38,0)")), F.sum(F.hash(text).cast("decimal(38,0)"))).first()
    return ":".join(str(x) for x in row)


def delete(spark: SparkSession, path: str) -> None:
    fs, at, _ = _fs(spark, path)
    fs.delete(at, True)


def listed(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(path, seconds of the last change) of what lies in a folder; none if it isn't there."""
    fs, at, _ = _fs(spark, path)
    return [(f"{path}/{x.getPath().getName()}", x.getModificationTime() / 1000) for x in fs.listStatus(at)] if fs.exists(at) else []


def _lines(path: str, spark: SparkSession) -> str:
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def manifests(spark: SparkSession, root: str) -> list[str]:
    """Paths of the complete manifests, the newest last; those still being written have names of another kind."""
    return sorted(p for p, _ in listed(spark, f"{root}/manifests") if p.rpartition("/")[2].startswith("m-") and p.endswith(".json"))


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads(_lines(path, spark))


def current(spark: SparkSession, root: str) -> dict:
    """The newest manifest: version, and each table's path and digest; empty before the first publication."""
    found = manifests(spark, root)
    return read_document(spark, found[-1]) if found else {}


def write_document(spark: SparkSession, path: str, value: object) -> None:
    """One small document, complete or not there at all: written under another name and renamed."""
    fs, at, make = _fs(spark, path)
    staged = make(f"{at.getParent().toString()}/_staged-{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(stable_json(value).encode()))
    out.close()
    if not fs.rename(staged, at):
        fs.delete(staged, False)
        raise FileExistsError(path)


def publish(tables: Mapping[str, DataFrame], root: str, check: Callable[[Mapping[str, DataFrame]], list[str]] | None = None, documents: Mapping[str, object] = {}) -> dict:  # noqa: B006
    """Writes all tables and `documents` beside the ones in use, and then a manifest of the next number; {"changed", "manifest"}.

    Readers follow the manifest with the highest number.  It appears by one rename to a name that is not taken, so a
    crash at any moment leaves them with the publication before, and of two writers one fails.  Errors of `check` on
    what was written leave the old publication in place.  If no table's rows differ, no manifest is written.  What was
    written and isn't named in the end is deleted; what a crash leaves is for `vacuum`.
    """
    spark = next(iter(tables.values())).sparkSession
    before, version = current(spark, root), uuid.uuid4().hex
    named = False
    try:
        written = {}
        for name, df in tables.items():
            df.write.parquet(f"{root}/data/{version}/{name}")
            written[name] = spark.read.parquet(f"{root}/data/{version}/{name}")
        if check and (errors := check(written)):
            raise ValueError("; ".join(errors))
        found = {name: {"path": f"data/{version}/{name}", "digest": digest(df)} for name, df in written.items()}
        if before and {k: v["digest"] for k, v in before["tables"].items()} == {k: v["digest"] for k, v in found.items()}:
            return {"changed": False, "manifest": before}
        for name, value in documents.items():
            write_document(spark, f"{root}/data/{version}/{name}.json", value)
        manifest = {"version": version, "number": before.get("number", 0) + 1, "tables": found, "documents": {n: f"data/{version}/{n}.json" for n in documents}, "schemas": {n: df.schema.jsonValue() for n, df in written.items()}}
        write_document(spark, f"{root}/manifests/m-{manifest['number']:012d}.json", manifest)
        named = True
        return {"changed": True, "manifest": manifest}
    finally:
        if not named:
            delete(spark, f"{root}/data/{version}")


def vacuum(spark: SparkSession, root: str, keep: int = 2, grace_s: float = 86400.0) -> int:
    """Deletes manifests but the newest `keep`, and data versions that none of the others names; the number of versions deleted.

    What is younger than `grace_s` seconds stays: a writer may not have named it yet, a reader may be at it.
    """
    now, every = time.time(), manifests(spark, root)
    kept = set(every[-keep:] if keep else every)
    for path, at in listed(spark, f"{root}/manifests"):
        if path not in kept and now - at >= grace_s:
            delete(spark, path)
    live = {read_document(spark, m)["version"] for m in manifests(spark, root)}
    dead = [p for p, at in listed(spark, f"{root}/data") if p.rpartition("/")[2] not in live and now - at >= grace_s]
    for path in dead:
        delete(spark, path)
    return len(dead)


def json_lines(df: DataFrame) -> DataFrame:
    """Rows as JSON texts with sorted names, as a terminal prints them."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def change_report(changes: DataFrame, kinds: int = 100) -> dict:
    """Number of changes of each kind, and whether one is a regression; for a document of its own."""
    counts = {r["kind"]: r["count"] for r in changes.groupBy("kind").count().limit(kinds).collect()}  # kinds are a fixed list
    return {"changes": counts, "has_regression": any(k != "new_market" for k in counts)}
