"""A tree of JSON documents with numbered states: written by tasks, committed at one go, told apart by digests.

Documents (path, value) are dealt to a fixed number of buckets.  Each document has a digest, each bucket one of its
documents' digests, and the state one of its buckets'.  A state is a manifest that names the buckets' indexes, which name
the documents' files.  What didn't change keeps its file: a change of one document writes that document, its bucket's
index and a manifest.  Two states are compared by the buckets that differ.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tallyquill.sources.publish import current, delete, listed, manifests, read_document, stable_json, write_document

#: Buckets of a tree; a tree keeps the number it began with.
BUCKETS = 64
_SCHEMA = "bucket int, path string, value string"


def _files(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, as tasks reach it."""
    if "://" in root or root.startswith("file:"):
        return pafs.FileSystem.from_uri(root.replace("file:/", "file:///", 1) if root.startswith("file:/") and not root.startswith("file://") else root)
    return pafs.LocalFileSystem(), root


def _write(fs: pafs.FileSystem, path: str, text: str) -> None:
    fs.create_dir(posixpath.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(text.encode())


def _read(fs: pafs.FileSystem, path: str) -> str:
    with fs.open_input_stream(path) as source:
        return source.read().decode()


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass
class Written(WriterCommitMessage):
    """The buckets that a task has written or found unchanged: number, index file, digest, documents, files written."""

    buckets: list[tuple[int, str, str, int, int]]


class TreeWriter(DataSourceWriter):
    """Writes rows (bucket, path, value), sorted, with each bucket whole in one task.

    Tasks write only below the folder of their transaction, each try under a name of its own, so that a try that is lost
    or repeated leaves nothing that a reader sees.
    """

    def __init__(self, root: str, transaction: str, before: dict[str, str]):
        self.root, self.transaction, self.before = root, transaction, before

    def write(self, iterator: Iterator) -> Written:
        fs, root = _files(self.root)
        own, found, bucket, lines, n_new, known = f"data/{self.transaction}/{uuid.uuid4().hex}", [], None, [], 0, {}

        def settle() -> None:
            text = "".join(f"{json.dumps(x, ensure_ascii=False)}\n" for x in lines)
            digest = _digest("".join(f"{path}\0{told}\n" for path, told, _ in lines))
            at = self.before.get(str(bucket))
            if at is None or lines != list(known.values()):
                at = f"{own}/index-{bucket:04d}.jsonl"
                _write(fs, f"{root}/{at}", text)
            found.append((bucket, at, digest, len(lines), n_new))

        for row in iterator:
            if row["bucket"] != bucket:
                if bucket is not None:
                    settle()
                bucket, lines, n_new = row["bucket"], [], 0
                at = self.before.get(str(bucket))
                known = {x[0]: x for x in map(json.loads, _read(fs, f"{root}/{at}").splitlines())} if at else {}
            text = stable_json(json.loads(row["value"]))
            told, old = _digest(text), known.get(row["path"])
            if lines and lines[-1][0] == row["path"]:
                raise ValueError(f"two documents of one path: {row['path']}")
            if old is None or old[1] != told:
                old = [row["path"], told, f"{own}/{row['path']}"]
                _write(fs, f"{root}/{old[2]}", text)
                n_new += 1
            lines.append(old)
        if bucket is not None:
            settle()
        return Written(found)

    def commit(self, messages: list[Written]) -> None:
        """All tasks are done: their buckets are put together beside what they wrote; the manifest comes after this."""
        fs, root = _files(self.root)
        every = {str(b): {"index": at, "digest": digest, "documents": n, "written": new} for m in messages if m for b, at, digest, n, new in m.buckets}
        _write(fs, f"{root}/data/{self.transaction}/committed.json", stable_json(every))

    def abort(self, messages: list[Written]) -> None:
        """Some task failed for good: all that any task wrote goes."""
        fs, root = _files(self.root)
        if fs.get_file_info(f"{root}/data/{self.transaction}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/data/{self.transaction}")


class Tree(DataSource):
    """`spark.write.format("document_tree")`, with options root, transaction and before (each bucket's index file, as JSON)."""

    @classmethod
    def name(cls) -> str:
        return "document_tree"

    def schema(self) -> str:
        return _SCHEMA

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return TreeWriter(self.options["root"], self.options["transaction"], json.loads(self.options["before"]))


def publish_documents(documents: DataFrame, root: str, buckets: int = BUCKETS) -> dict:
    """Makes documents (path, value as JSON text) the tree's next state; {"changed", "manifest", "written"}.

    The state is all of `documents`: what isn't there any more goes.  Files are stable JSON: sorted names, two spaces, one
    newline at the end, nulls written.  Without any difference nothing is kept and no manifest is written.  A crash at any
    moment leaves readers with the state before, and of two writers one fails.
    """
    spark = documents.sparkSession
    spark.dataSource.register(Tree)
    before, transaction = current(spark, root), uuid.uuid4().hex
    buckets = before.get("n_buckets", buckets)
    known = {b: x["index"] for b, x in before.get("buckets", {}).items()}
    rows = documents.select(F.pmod(F.crc32(F.encode("path", "utf-8")), F.lit(buckets)).cast("int").alias("bucket"), "path", "value")
    rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "path")
    rows.write.format("document_tree").options(root=root, transaction=transaction, before=json.dumps(known)).mode("append").save()
    folder = f"{root}/data/{transaction}"
    found = read_document(spark, f"{folder}/committed.json")
    written = sum(x.pop("written") for x in found.values())
    top = _digest("".join(f"{b}:{found[b]['digest']}\n" for b in sorted(found, key=int)))
    if before and top == before["digest"]:
        delete(spark, folder)
        return {"changed": False, "manifest": before, "written": 0}
    manifest = {"number": before.get("number", 0) + 1, "transaction": transaction, "digest": top, "n_buckets": buckets, "documents": sum(x["documents"] for x in found.values()), "buckets": found}
    write_document(spark, f"{root}/manifests/m-{manifest['number']:012d}.json", manifest)
    return {"changed": True, "manifest": manifest, "written": written}


def _index(spark: SparkSession, root: str, files: list[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], "path string, digest string, file string")
    lines = spark.read.text([f"{root}/{x}" for x in files])
    own = F.from_json("value", "array<string>")
    return lines.select(own[0].alias("path"), own[1].alias("digest"), own[2].alias("file"))


def state(spark: SparkSession, root: str, manifest: dict | None = None) -> DataFrame:
    """(path, digest, file) of every document of a state, the current one unless told otherwise."""
    manifest = current(spark, root) if manifest is None else manifest
    return _index(spark, root, [x["index"] for x in manifest.get("buckets", {}).values()])


def changes(spark: SparkSession, root: str, old: dict, new: dict) -> DataFrame:
    """(path, change) of the documents that were added, removed or changed between two states; equal buckets aren't read."""
    a, b = old.get("buckets", {}), new.get("buckets", {})
    if old and new and old["n_buckets"] != new["n_buckets"]:
        raise ValueError("states of one tree have the same number of buckets")
    differ = [k for k in {*a, *b} if a.get(k, {}).get("digest") != b.get(k, {}).get("digest")]
    was, now = (_index(spark, root, [x[k]["index"] for k in differ if k in x]).select("path", F.col("digest").alias(n)) for x, n in ((a, "was"), (b, "now")))
    kind = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "changed")
    return was.join(now, "path", "full_outer").select("path", kind.alias("change")).where("change is not null")


def documents(spark: SparkSession, root: str, manifest: dict | None = None) -> DataFrame:
    """(path, value) of a state: the index says which files, and tasks read them."""
    def read(batches):
        fs, base = _files(root)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array([_read(fs, f"{base}/{x}") for x in batch.column("file").to_pylist()], pa.string())], names=["path", "value"])

    return state(spark, root, manifest).select("path", "file").mapInArrow(read, "path string, value string")


def vacuum(spark: SparkSession, root: str, keep: int = 2, grace_s: float = 86400.0) -> int:
    """Deletes manifests but the newest `keep`, and every file that none of these names; the number of files deleted.

    What is younger than `grace_s` seconds stays, as a writer may not have named it yet or a reader may have just looked
    up its manifest.  The files that are named and those that are there are compared by a join, and tasks delete.
    """
    every = manifests(spark, root)
    kept, now = every[-keep:] if keep else every, time.time()
    stale = [m for m, at in listed(spark, f"{root}/manifests") if m not in kept and m.endswith(".json") and now - at >= grace_s]
    live = [read_document(spark, m) for m in every if m not in stale]
    for m in stale:
        delete(spark, m)
    named = spark.createDataFrame([(x["index"],) for m in live for x in m["buckets"].values()] + [(f"data/{m['transaction']}/committed.json",) for m in live], "file string")
    for m in live:
        named = named.unionByName(state(spark, root, m).select("file"))
    folders = spark.createDataFrame([(p,) for p, _ in listed(spark, f"{root}/data")], "folder string")

    def present(batches):
        fs, base = _files(root)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                inside = fs.get_file_info(pafs.FileSelector(f"{base}/data/{posixpath.basename(folder)}", recursive=True))
                own = [(x.path[len(base) + 1 :], x.mtime.timestamp()) for x in inside if x.type == pafs.FileType.File]
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in own], pa.string()), pa.array([t for _, t in own], pa.float64())], names=["file", "at"])

    def remove(batches):
        fs, base = _files(root)
        for batch in batches:
            for x in batch.column("file").to_pylist():
                try:
                    fs.delete_file(f"{base}/{x}")
                except FileNotFoundError:  # a try of this task before this one
                    pass
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    dead = folders.repartition(max(1, min(200, folders.count()))).mapInArrow(present, "file string, at double").where(F.col("at") <= now - grace_s).join(named.distinct(), "file", "left_anti")
    gone = dead.select("file").mapInArrow(remove, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    for folder, at in listed(spark, f"{root}/data"):
        if now - at >= grace_s and spark.createDataFrame([(folder,)], "folder string").mapInArrow(present, "file string, at double").isEmpty():
            delete(spark, folder)
    return gone
