"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against windows of training words."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyquill.llm import tokens
from tallyquill.llm.common import arrow_batches, cut

#: Words of a window; shorter items are one window.
WINDOW = 13
#: Most characters of benchmark text in one broadcast set; a larger benchmark is scanned for block after block.
BLOCK_CHARS = 16_000_000
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20


class GramSet:
    """The windows of some benchmark items as arrays: of each length the sorted hashes, where each window starts, its item.

    An item costs about 30 bytes a word; windows are compared by the 64-bit hashes of all their words.
    """

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        words, parts, before = [], {}, 0
        for first in range(0, len(items), 1000):
            for w in tokens.words(pa.array([t for _, t in items[first : first + 1000]], pa.string()), tokens.ALNUM):
                words.append(w.hashes)
                for n in sorted({min(width, int(c)) for c in w.counts if c}):
                    at, hashes = w.grams(n)
                    rows = w.rows[at]
                    keep = (w.counts[rows] == n) if n < width else np.ones(len(at), dtype=bool)
                    parts.setdefault(n, []).append((hashes[keep], at[keep] + before, rows[keep] + first + w.first))
                before += len(w.hashes)
        self.ids = [i for i, _ in items]
        self.words = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
        self.sets, self.bits = {}, {}
        for n, own in parts.items():
            hashes, starts, rows = (np.concatenate(x) for x in zip(*own))
            order = np.argsort(hashes, kind="stable")
            self.sets[n] = hashes[order], starts[order].astype(np.int64), rows[order].astype(np.int32)
            # A bit table settles almost every window that is no hit with one look.
            self.bits[n] = np.zeros(1 << 22, dtype=bool)
            self.bits[n][(hashes >> np.uint64(42)).astype(np.int64)] = True

    def hits(self, w: tokens.Words, n: int) -> list[tuple[int, list[str]]]:
        """(first word, items) of each window of n words that occurs in an item, compared by the hash of each word."""
        at, hashes = w.grams(n)
        maybe = np.flatnonzero(self.bits[n][(hashes >> np.uint64(42)).astype(np.int64)])
        own, starts, rows = self.sets[n]
        lo, hi = (np.searchsorted(own, hashes[maybe], side=side) for side in ("left", "right"))
        some = lo < hi
        found = []
        for k, s, e in zip(maybe[some].tolist(), lo[some].tolist(), hi[some].tolist()):
            i = int(at[k])
            mine = w.hashes[i : i + n]
            items = {self.ids[rows[j]] for j in range(s, e) if np.array_equal(self.words[starts[j] : starts[j] + n], mine)}
            if items:
                found.append((i, sorted(items)))
        return found


def _merged(ends: list[int]) -> list[tuple[int, int]]:
    """Disjoint stretches that cover the same words; `ends` holds starts and ends in turn."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(zip(ends[::2], ends[1::2])):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _blocks(benchmark: DataFrame, limit: int) -> list[DataFrame]:
    """(item_id, text) of the benchmark in parts of at most about `limit` characters: one where its measured size allows."""
    own = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null")
    chars = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = int(-(-chars // limit)) or 1
    return [own] if n == 1 else [own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def _hits(rows: DataFrame, benchmark: DataFrame, width: int, limit: int, result, schema: T.StructType) -> DataFrame:
    """`result(batch, words, spans, items)` of batches of rows that have `text`, with what the benchmark hits in them.

    A benchmark of one block is broadcast.  Of a larger one, one block at a time is: what it hits is kept in the shared
    folder by row, and at the end every row is given what all blocks hit in it.
    """
    spark = rows.sparkSession
    blocks = _blocks(benchmark, limit)

    def scan(shared, out):
        def run(batches):
            grams = GramSet(shared.value, width)
            for batch in batches:
                yield from out(batch, *_scan(batch.column("text"), grams))

        return run

    if len(blocks) == 1:
        shared = spark.sparkContext.broadcast([tuple(r) for r in blocks[0].collect()])  # `limit` characters at most
        return rows.mapInArrow(scan(shared, lambda *x: [result(*x)]), schema)
    rows = cut(rows.withColumn("_row", F.monotonically_increasing_id()))
    found = None

    def some(batch, _, spans, items):
        at = [i for i, x in enumerate(spans) if x]
        yield pa.RecordBatch.from_arrays([batch.column("_row").take(pa.array(at, pa.int64())), pa.array([[v for s in spans[i] for v in s] for i in at], pa.list_(pa.int64())), pa.array([sorted(items[i]) for i in at], pa.list_(pa.string()))], names=["_row", "spans", "items"])

    for block in blocks:
        shared = spark.sparkContext.broadcast([tuple(r) for r in block.collect()])
        own = cut(rows.select("_row", "text").mapInArrow(scan(shared, some), "_row long, spans array<long>, items array<string>"))
        shared.unpersist()
        found = own if found is None else found.unionByName(own)
    every = found.groupBy("_row").agg(F.flatten(F.collect_list("spans")).alias("_spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("_items"))

    def known(batches):
        for batch in batches:
            spans, items = ([x or [] for x in batch.column(c).to_pylist()] for c in ("_spans", "_items"))
            own = batch.drop_columns(["_row", "_spans", "_items"])
            yield result(own, list(tokens.words(batch.column("text"), tokens.ALNUM)), [_merged(x) for x in spans], [set(x) for x in items])

    return rows.join(every, "_row", "left").select(*rows.columns, "_spans", "_items").mapInArrow(known, schema)


def _scan(text: pa.Array, grams: GramSet) -> tuple[list[tokens.Words], list[list[tuple[int, int]]], list[set[str]]]:
    """The words of the texts; of each, the stretches of words that windows cover, and the items they are from."""
    parts = list(tokens.words(text, tokens.ALNUM))
    spans: list[list[int]] = [[] for _ in range(len(text))]
    items: list[set[str]] = [set() for _ in range(len(text))]
    for w in parts:
        rows = w.rows
        for n in grams.sets:
            for i, found in grams.hits(w, n):
                row = int(rows[i])
                start = i - int(w.bounds[row])
                spans[w.first + row] += (start, start + n)
                items[w.first + row].update(found)
    return parts, [_merged(x) for x in spans], items


def _contaminated(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and SHARE * n_hit >= n_words


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of `docs`: which words of it lie in a window that also occurs in a benchmark item.

    A window is `width` consecutive words of an item, or the whole item if it has fewer.  The benchmark's windows are
    broadcast as a hash set, whose size is checked first: beyond `block_chars` characters one block of items after the
    other is broadcast, and neither the driver nor a task holds more than one.  Documents are never shuffled for a
    benchmark of one block.  Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans (start and end
    word of each covered stretch, one after the other) and items.

    Null and empty texts have no words and are clean.  Null items and items without words are no windows.  Repeated
    rows are judged one by one; an item id that repeats stands for all its texts.  Without documents there are no rows,
    and without items every document is clean.  Other columns are ignored.
    """
    arrow_batches(docs.sparkSession)

    def result(batch, parts, spans, items):
        n_words = np.concatenate([w.counts for w in parts]) if parts else np.zeros(0, dtype=np.int64)
        n_hit = [sum(e - s for s, e in x) for x in spans]
        named = [sorted(x) for x in items]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in named], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in named], pa.string()),
                pa.array([_contaminated(h, int(n)) for h, n in zip(n_hit, n_words)], pa.bool_()),
                pa.array([[v for s in x for v in s] for x in spans], pa.list_(pa.int64())), pa.array(named, pa.list_(pa.string())),
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans", "items"],
        )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_spans array<long>, items array<string>"
    return _hits(docs.select("doc_id", "text"), benchmark, width, block_chars, result, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", width: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without contaminated ones, or, with remove="spans", with every hit stretch of words cut out.

    The columns stay those of `docs`.  Null texts stay null and are kept.  Cutting leaves what stands between words in
    place and joins what is left on either side by one space.  Repeated rows and empty tables are as in `contamination`.
    """
    arrow_batches(docs.sparkSession)

    def result(batch, parts, spans, _):
        if remove == "documents":
            keep = [not _contaminated(sum(e - s for s, e in x), int(n)) for x, n in zip(spans, (c for w in parts for c in w.counts))]
            return batch.filter(pa.array(keep, pa.bool_()))
        if not any(spans):
            return batch
        texts = batch.column("text").to_pylist()
        for w in parts:
            for row in range(w.n_rows):
                if own := spans[w.first + row]:
                    texts[w.first + row] = _without(texts[w.first + row].encode(), w, row, own)
        at = batch.schema.names.index("text")
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return _hits(docs, benchmark, width, block_chars, result, docs.schema)


def _without(raw: bytes, w: tokens.Words, row: int, stretches: list[tuple[int, int]]) -> str:
    base, first, at, left = int(w.row_bytes[row]), int(w.bounds[row]), 0, []
    for s, e in stretches:
        left.append(raw[at : int(w.starts[first + s]) - base].strip())
        at = int(w.ends[first + e - 1]) - base
    left.append(raw[at:].strip())
    return b" ".join(x for x in left if x).decode()
