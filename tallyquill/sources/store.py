"""A keyed store of responses: appended parts, the newest entry of each key, expiry, and compaction to one part.

Every put is a part of its own, written beside the others and then named by the next manifest.  Bodies are bytes, kept
with their digest.  Which entry of a key counts is settled on small columns; bodies are read for these alone.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyquill.functions.web import cache_directives, cache_key, cacheable, market_matches
from tallyquill.sources.publish import current, delete, listed, manifests, read_document, write_document

#: Folders that a part's keys are dealt into; a read of some keys leaves out the others.
BUCKETS = 16
#: What an entry has beside its key; `op` is put, touch (the body is still good) or drop.
_ENTRY = "op string, status int, headers map<string,string>, content binary, digest string, fetched_at double, market string, locale string"
_STORED = f"key string, {_ENTRY}, stored_at double, row long, bucket int"


def _named(spark: SparkSession, root: str, parts: Callable[[list[str]], list[str]], tries: int = 20) -> dict:
    """The next manifest with what `parts` makes of the parts of the one before; another writer's is taken into account."""
    for left in range(tries - 1, -1, -1):
        before = current(spark, root)
        after = {"number": before.get("number", 0) + 1, "parts": parts(before.get("parts", []))}
        try:
            write_document(spark, f"{root}/manifests/m-{after['number']:012d}.json", after)
            return after
        except FileExistsError:
            if not left:
                raise
    raise AssertionError


def _append(entries: DataFrame, root: str, stored_at: Column) -> str:
    part = f"data/{uuid.uuid4().hex}"
    own = entries.withColumns({"stored_at": stored_at, "row": F.monotonically_increasing_id(), "bucket": F.pmod(F.crc32(F.encode("key", "utf-8")), F.lit(BUCKETS)).cast("int")})
    own.write.partitionBy("bucket").parquet(f"{root}/{part}")
    return part


def answers(responses: DataFrame) -> DataFrame:
    """What responses (method, url, market, locale, status, headers, content, fetched_at) mean for the store.

    A good one is put; one that may not be kept drops what is there; `304` tells that what is there is still good; others
    mean nothing.
    """
    told = cache_directives(F.col("headers")["cache-control"])
    op = (
        F.when(F.col("status") == 304, "touch").when(F.map_contains_key(told, "no-store") | F.map_contains_key(told, "private"), "drop")
        .when(cacheable("status", F.col("headers")["content-length"], F.octet_length("content")), "put")
    )
    own = responses.where(F.upper("method") == "GET").select(cache_key("method", "url", "market", "locale").alias("key"), op.alias("op"), "status", "headers", F.col("content").cast("binary").alias("content"), "fetched_at", "market", "locale").where("op is not null")
    body = F.when(F.col("op") == "put", F.coalesce("content", F.lit("").cast("binary")))
    return own.withColumns({"content": body, "headers": F.when(F.col("op") == "put", F.col("headers"))}).withColumn("digest", F.sha2("content", 256)).select("key", *[c.split()[0] for c in _ENTRY.replace("map<string,string>", "map").split(", ")])


def put(entries: DataFrame, root: str, now: float | None = None) -> dict:
    """Adds entries of `answers`; of several of one key the one fetched last counts, and all count before earlier puts."""
    spark = entries.sparkSession
    part = _append(entries, root, F.lit(time.time() if now is None else now))
    return _named(spark, root, lambda parts: [*parts, part])


def _rows(spark: SparkSession, root: str, manifest: dict) -> DataFrame:
    if not manifest.get("parts"):
        return spark.createDataFrame([], _STORED)
    own = spark.read.schema(_STORED.replace(", bucket int", "")).option("ignoreCorruptFiles", "true")
    found = [own.parquet(f"{root}/{p}").withColumn("bucket", F.pmod(F.crc32(F.encode("key", "utf-8")), F.lit(BUCKETS)).cast("int")) for p in manifest["parts"]]
    rows = found[0]
    for x in found[1:]:
        rows = rows.unionByName(x)
    return rows


def newest(spark: SparkSession, root: str, keys: DataFrame | None = None, manifest: dict | None = None) -> DataFrame:
    """(key, status, headers, content, fetched_at, market, locale, intact) of every key's newest entry, or of `keys` alone.

    Dropped keys have none; a touch after an entry tells when it was last found good.  `intact` is false where the body
    is not what was put.
    """
    every = _rows(spark, root, current(spark, root) if manifest is None else manifest)
    if keys is not None:
        every = every.join(keys.select("key").where("key is not null").distinct(), "key", "left_semi")
    place = F.struct("stored_at", "fetched_at", "row")
    last = every.groupBy("key").agg(F.max(F.when(F.col("op") != "touch", F.struct(place.alias("at"), "op"))).alias("own"), F.max(F.when(F.col("op") == "touch", place)).alias("touched"))
    last = last.where("own.op = 'put'").select("key", "own.at.stored_at", "own.at.row", F.when(F.col("touched") > F.col("own.at"), F.col("touched.fetched_at")).alias("touched_at"))
    found = every.where("op = 'put'").join(last, ["key", "stored_at", "row"])
    intact = F.coalesce(F.sha2("content", 256) == F.col("digest"), F.lit(False))
    return found.select("key", "status", "headers", "content", F.coalesce("touched_at", "fetched_at").alias("fetched_at"), "market", "locale", intact.alias("intact"))


def looked_up(requests: DataFrame, root: str, now: float, ttl_s: float) -> tuple[DataFrame, Observation]:
    """Requests (method, url, market, locale) with `hit` and the content of their entry, and counters of the same pass.

    An entry counts if it is intact, younger than `ttl_s` and of the market asked for.  The counters (hits, misses,
    bytes_avoided, broken) are there once an action on the rows is done, and count each row once, however often a task
    was tried.
    """
    spark = requests.sparkSession
    keyed = requests.withColumn("key", cache_key("method", "url", "market", "locale"))
    kept = newest(spark, root, keyed).select("key", "content", "fetched_at", F.col("market").alias("_market"), F.col("locale").alias("_locale"), "intact")
    both = keyed.join(kept, "key", "left")
    hit = F.coalesce(F.col("intact") & (F.lit(now) - F.col("fetched_at") < ttl_s) & market_matches("_market", "market", "_locale", "locale") & (F.upper("method") == "GET"), F.lit(False))
    rows = both.withColumn("hit", hit).withColumns({"content": F.when(F.col("hit"), F.col("content")), "_broken": F.coalesce(~F.col("intact"), F.lit(False))})
    seen = Observation()
    rows = rows.observe(seen, F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.coalesce(F.sum(F.when(F.col("hit"), F.octet_length("content"))), F.lit(0)).alias("bytes_avoided"), F.count_if("_broken").alias("broken"))
    return rows.drop("_market", "_locale", "_broken", "intact"), seen


def compact(spark: SparkSession, root: str, now: float, ttl_s: float) -> dict:
    """One part of all newest entries that are intact and younger than `ttl_s`; puts that come meanwhile stay beside it."""
    before = current(spark, root)
    if not before:
        return before
    good = newest(spark, root, manifest=before).where(F.col("intact") & (F.lit(now) - F.col("fetched_at") < ttl_s)).drop("intact").withColumns({"op": F.lit("put"), "digest": F.sha2("content", 256)})
    # What is compacted is as old as can be, so that any put counts before it.
    part = _append(good, root, F.lit(0.0))
    return _named(spark, root, lambda parts: [part, *(p for p in parts if p not in before["parts"])])


def vacuum(spark: SparkSession, root: str, keep: int = 2, grace_s: float = 86400.0) -> int:
    """Deletes manifests but the newest `keep` and parts that none of the others names, if older than `grace_s`; the number of parts."""
    now, kept = time.time(), set(manifests(spark, root)[-keep:])
    for path, at in listed(spark, f"{root}/manifests"):
        if path not in kept and now - at >= grace_s:
            delete(spark, path)
    live = {p for m in manifests(spark, root) for p in read_document(spark, m)["parts"]}
    dead = [p for p, at in listed(spark, f"{root}/data") if p.removeprefix(f"{root}/") not in live and now - at >= grace_s]
    for path in dead:
        delete(spark, path)
    return len(dead)
