"""The document tree: what is written, what a crash leaves, what differs, and what is cleaned up."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyquill.sources import documents, publish


def tree(spark, markets):
    rows = [(f"json/{c}.json", json.dumps(v)) for c, v in markets.items()]
    return spark.createDataFrame(rows, "path string, value string").repartition(3)


def held(spark, root, manifest=None):
    return {r.path: r.value for r in documents.documents(spark, root, manifest).collect()}


def files(root):
    return sorted(str(p.relative_to(root)) for p in Path(root, "data").rglob("*") if p.is_file() and not p.name.startswith("."))


MARKETS = {c: {"country": c, "b": None, "a": ["ü", 1]} for c in ("DE", "FR", "US", "GB", "JP")}


def test_one_change_writes_one_file(spark, tmp_path):
    root = str(tmp_path)
    first = documents.publish_documents(tree(spark, MARKETS), root, buckets=4)
    assert first["changed"] and first["written"] == 5 and held(spark, root)["json/DE.json"] == '{\n  "a": [\n    "ü",\n    1\n  ],\n  "b": null,\n  "country": "DE"\n}\n'
    before = files(root)
    again = documents.publish_documents(tree(spark, MARKETS), root)
    assert not again["changed"] and again["manifest"] == first["manifest"] and files(root) == before
    second = documents.publish_documents(tree(spark, MARKETS | {"FR": {"country": "FR"}}), root)
    new = [f for f in files(root) if f not in before]
    assert second["written"] == 1 and [f.rpartition("/")[2] for f in new if "index" not in f and "committed" not in f] == ["FR.json"] and sum("index" in f for f in new) == 1
    assert {(r.path, r.change) for r in documents.changes(spark, root, first["manifest"], second["manifest"]).collect()} == {("json/FR.json", "changed")}
    assert held(spark, root, first["manifest"]) != held(spark, root) and len(held(spark, root)) == 5
    third = documents.publish_documents(tree(spark, {c: MARKETS[c] for c in ("DE", "US")} | {"IT": {}}), root)
    got = {(r.path, r.change) for r in documents.changes(spark, root, second["manifest"], third["manifest"]).collect()}
    assert got == {("json/FR.json", "removed"), ("json/GB.json", "removed"), ("json/JP.json", "removed"), ("json/IT.json", "added")} and third["manifest"]["number"] == 3


def test_a_state_is_named_at_the_end_or_not_at_all(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    first = documents.publish_documents(tree(spark, MARKETS), root)
    before = files(root)
    broken = tree(spark, MARKETS | {"FR": {"x": 1}}).withColumn("value", F.when(F.col("path") == "json/US.json", "{ no json").otherwise(F.col("value")))
    with pytest.raises(Exception, match="Expecting property name"):  # a task fails: abort takes back what the others wrote
        documents.publish_documents(broken, root)
    assert files(root) == before and publish.current(spark, root) == first["manifest"]
    with monkeypatch.context() as m:  # all tasks are done, and the driver dies before the manifest
        m.setattr(documents, "write_document", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            documents.publish_documents(tree(spark, MARKETS | {"FR": {"x": 1}}), root)
    assert publish.current(spark, root) == first["manifest"] and held(spark, root)["json/FR.json"].count("country") == 1 and len(files(root)) > len(before)
    assert documents.vacuum(spark, root, grace_s=3600) == 0  # a writer may still be at it
    assert documents.vacuum(spark, root, grace_s=0) > 0 and files(root) == before
    twice = tree(spark, MARKETS).unionByName(tree(spark, {"DE": {}}))
    with pytest.raises(Exception, match="two documents of one path"):
        documents.publish_documents(twice, root)


def test_states_that_are_kept_stay_whole(spark, tmp_path):
    root, states = str(tmp_path), []
    for n in range(5):
        states.append(documents.publish_documents(tree(spark, MARKETS | {"FR": {"n": n}}), root)["manifest"])
    documents.vacuum(spark, root, keep=2, grace_s=0)
    assert [json.loads(held(spark, root, m)["json/FR.json"])["n"] for m in states[-2:]] == [3, 4] and len(held(spark, root, states[-2])) == 5
    assert len(publish.manifests(spark, root)) == 2 and sum(f.endswith("FR.json") for f in files(root)) == 2
    assert documents.publish_documents(tree(spark, {}), root)["changed"] and held(spark, root) == {}


def test_failed_publications_leave_nothing(spark, tmp_path):
    root = str(tmp_path)
    publish.publish({"t": spark.range(3)}, root)
    for n in range(10):
        with pytest.raises(ValueError):
            publish.publish({"t": spark.range(n)}, root, check=lambda t: ["no"])
    assert not publish.publish({"t": spark.range(3)}, root)["changed"] and len(list(Path(root, "data").iterdir())) == 1
    Path(root, "data", "crashed").mkdir()
    publish.publish({"t": spark.range(4)}, root)
    publish.publish({"t": spark.range(5)}, root)
    assert publish.vacuum(spark, root, keep=1, grace_s=3600) == 0
    assert publish.vacuum(spark, root, keep=1, grace_s=0) == 3 and spark.read.parquet(f"{root}/{publish.current(spark, root)['tables']['t']['path']}").count() == 5
