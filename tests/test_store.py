"""The keyed store: put, replace, touch, drop, expire, compact, broken entries, writers beside each other, counters."""

import glob

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyquill.sources import files, publish, store

RESPONSE = "method string, url string, market string, locale string, status int, headers map<string,string>, content binary, fetched_at double"


def response(path, body=b"x", at=100.0, status=200, method="GET", market="DE", **headers):
    return (method, f"https://h/{path}", market, "en-de", status, {k.replace("_", "-"): v for k, v in headers.items()}, body, at)


def put(spark, root, *rows, now):
    return store.put(store.answers(spark.createDataFrame(list(rows), RESPONSE)), root, now)


def asked(spark, root, *paths, now=110.0, ttl=50.0, market="DE"):
    requests = spark.createDataFrame([("get", f"https://h/{p}?utm_source=z", market, "en-de") for p in paths], "method string, url string, market string, locale string")
    rows, seen = store.looked_up(requests, root, now, ttl)
    got = {r.url.rpartition("/")[2].partition("?")[0]: bytes(r.content) if r.hit else None for r in rows.collect()}
    return got, seen.get


def test_the_newest_entry_of_a_key_counts(spark, tmp_path):
    root = str(tmp_path)
    assert asked(spark, root, "a") == ({"a": None}, {"hits": 0, "misses": 1, "bytes_avoided": 0, "broken": 0})
    put(spark, root, response("a", b"old"), response("a", b"older", 90.0), response("b", b"\x00\xff"), response("c", status=500), response("d", b"abc", content_length="9"), response("e", method="POST"), now=1)
    got, counts = asked(spark, root, "a", "b", "c", "d", "e")
    assert got == {"a": b"old", "b": b"\x00\xff", "c": None, "d": None, "e": None} and counts == {"hits": 2, "misses": 3, "bytes_avoided": 5, "broken": 0}
    put(spark, root, response("a", b"new", 99.0), now=2)
    assert asked(spark, root, "a")[0] == {"a": b"new"} and asked(spark, root, "a", now=149.5)[0] == {"a": None}
    put(spark, root, response("a", None, 140.0, 304), now=3)
    assert asked(spark, root, "a", now=149.5)[0] == {"a": b"new"}
    put(spark, root, response("a", b"secret", 141.0, cache_control="private"), now=4)
    assert asked(spark, root, "a", "b")[0] == {"a": None, "b": b"\x00\xff"}
    assert asked(spark, root, "b", market="US")[0] == {"b": None}


def test_compaction_keeps_what_counts(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        put(spark, root, response("a", b"%d" % n, 100.0 + n), response(f"only{n}", b"o", 60.0 + 20 * n), now=10.0 + n)
    state = store.compact(spark, root, 125.0, 50.0)
    assert len(state["parts"]) == 1 and store.newest(spark, root).count() == 4  # a, and the three that are young enough
    assert asked(spark, root, "a", "only0", "only3", now=125.0)[0] == {"a": b"3", "only0": None, "only3": b"o"}
    assert store.vacuum(spark, root, keep=1, grace_s=3600) == 0 and store.vacuum(spark, root, keep=1, grace_s=0) == 4
    put(spark, root, response("a", b"again", 90.0), now=20.0)
    assert asked(spark, root, "a", now=125.0)[0] == {"a": b"again"} and store.newest(spark, root).count() == 4
    assert store.compact(spark, str(tmp_path / "none"), 0.0, 1.0) == {}


def test_writers_beside_each_other_lose_nothing(spark, tmp_path, monkeypatch):
    """Another writer takes the number between this one's look and its manifest; compaction keeps puts that came meanwhile."""
    root, write = str(tmp_path), store.write_document
    put(spark, root, response("a"), now=1)

    def late(*args):
        monkeypatch.setattr(store, "write_document", write)
        put(spark, root, response("b"), now=2)
        return write(*args)

    monkeypatch.setattr(store, "write_document", late)
    assert put(spark, root, response("c"), now=3)["number"] == 3
    monkeypatch.setattr(store, "write_document", late)
    store.compact(spark, root, 110.0, 50.0)
    assert asked(spark, root, "a", "b", "c")[0] == {"a": b"x", "b": b"x", "c": b"x"} and publish.current(spark, root)["number"] == 5


def test_broken_entries_are_misses_until_replaced(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, response("a", b"good"), response("b", b"other"), now=1)
    for path in glob.glob(f"{root}/data/*/bucket=*/*.parquet"):
        own = pq.read_table(path)
        bodies = [b"damaged" if x == b"good" else x for x in own["content"].to_pylist()]
        pq.write_table(own.set_column(own.schema.get_field_index("content"), "content", pa.array(bodies, pa.binary())), path)
    for crc in glob.glob(f"{root}/data/*/bucket=*/.*.crc"):
        open(crc, "wb").close()
    spark.catalog.clearCache()
    import os

    for crc in glob.glob(f"{root}/data/*/bucket=*/.*.crc"):
        os.remove(crc)
    got, counts = asked(spark, root, "a", "b")
    assert got == {"a": None, "b": b"other"} and counts["broken"] == 1
    put(spark, root, response("a", b"fresh"), now=2)
    assert asked(spark, root, "a")[0] == {"a": b"fresh"}
    assert store.compact(spark, root, 110.0, 50.0)["number"] == 3 and store.newest(spark, root).where("not intact").count() == 0


def test_repeated_rows_of_a_cache_double_nothing(spark):
    asked_for = spark.createDataFrame([("get", "http://a/p", "DE", "en-de")], "method string, url string, market string, locale string")
    kept = files.kept_responses(asked_for.select("*", F.lit(200).alias("status"), F.create_map(F.lit("x"), F.lit("y")).alias("headers"), F.explode(F.array(F.lit("abc"), F.lit("abd"))).alias("content"), F.lit(100.0).alias("fetched_at")))
    rows = files.cached(asked_for, kept.unionByName(kept), 110.0, 60).collect()
    assert len(rows) == 1 and rows[0].hit and bytes(rows[0].content) == b"abd"


@pytest.mark.parametrize("fails", [False, True])
def test_counters_count_a_row_once(tmp_path, fails):
    """A task that is tried again counts its rows once; run in a session of its own, which tries tasks twice."""
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
import os
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
def run(batches):
    from pyspark import TaskContext
    for b in batches:
        yield b
    if {fails} and TaskContext.get().attemptNumber() == 0:
        raise ValueError("lost")
seen = Observation()
spark.range(0, 1000, 1, 4).observe(seen, F.count("*").alias("n")).mapInArrow(run, "id long").write.format("noop").mode("overwrite").save()
print("N", seen.get["n"])
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200, cwd=Path(__file__).parents[1])
    assert "N 1000" in done.stdout, done.stderr[-2000:]
