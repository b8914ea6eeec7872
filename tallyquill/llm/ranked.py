"""Ranked lexical search: for each item the documents with the highest scores, by a threshold-seeded join.

Of every term the k-th highest impact among all documents is stored.  The largest one of an item's terms is a lower bound
of the item's k-th score, for that term alone brings k documents so far.  An item's terms are put in descending order of
their highest impacts: from the term on behind which the sum of what is left stays below the bound, a document can't get
in by those terms alone.  Only the terms before it make candidates; those that can still reach the bound are scored
exactly over all terms.  What a task has found raises the bound further.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.llm import tokens
from tallyquill.llm.common import arrow_batches, stored

#: Documents of an item.
K = 10
#: Most characters of items in one broadcast table; of more, one block after the other is searched for.
BLOCK_CHARS = 4_000_000
#: (document, term, item) triples that a task holds at a time; those of one document are held together.
TRIPLES = 1 << 21

#: Fixed values of the score: a document's length counts for 90 of 100 parts.
SCALE, STEEP, SLOPE, FLAT = 1_000_000_000, 1000, 8, 10


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths(n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    return FLAT + (100 - FLAT) * n * n_docs // total


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * (SCALE * tf // (STEEP * tf + SLOPE * m))


def _terms(texts: pa.Array):
    """(first row, number of rows, row of each term, the terms) of runs of rows; only A-Z are lower-cased."""
    for first, raw, row_bytes in tokens.chunks(texts):
        data = tokens.LOWER[raw]
        starts, ends, bounds = tokens.spans(data, row_bytes, tokens.ALNUM)
        yield first, np.diff(bounds), tokens.word_array(data, tokens.ALNUM, starts, ends)


@dataclass
class Items:
    """A block of items: their ids, the distinct terms of all, and (item, term) pairs in order of item."""

    ids: pa.Array
    vocabulary: pa.Array
    item: np.ndarray
    term: np.ndarray

    @classmethod
    def of(cls, ids: pa.Array, texts: pa.Array) -> Items:
        """Texts of one id make one item."""
        coded = ids.dictionary_encode()
        own, words = coded.indices.to_numpy(), [(np.repeat(np.arange(f, f + len(n)), n), w) for f, n, w in _terms(texts)]
        terms = pa.chunked_array([w for _, w in words], pa.large_binary()).combine_chunks().dictionary_encode()
        rows = np.concatenate([r for r, _ in words]) if words else np.zeros(0, dtype=np.int64)
        size = max(1, len(terms.dictionary))
        pairs = np.unique(own[rows].astype(np.int64) * size + terms.indices.to_numpy())
        return cls(coded.dictionary, terms.dictionary, pairs // size, pairs % size)


def _indexed(items: Items):
    """Rows (doc_id, n, terms, tfs) of the documents that have terms: of each the block's terms, in order, and how often."""

    def run(batches):
        size = max(1, len(items.vocabulary))
        for batch in batches:
            for first, n, words in _terms(batch.column("text")):
                found = pc.fill_null(pc.index_in(words, value_set=items.vocabulary), -1).to_numpy()
                keys = (np.repeat(np.arange(len(n)), n) * size + found)[found >= 0]
                keys, tf = np.unique(keys, return_counts=True)
                kept = np.flatnonzero(n)
                offsets = pa.array(np.append(np.searchsorted(keys, kept * size), len(keys)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array((x).astype(np.int32))) for x in (keys % size, tf)]
                ids = batch.column("doc_id").take(pa.array(kept + first))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n[kept]), *lists], names=["doc_id", "n", "terms", "tfs"])

    return run


def _pairs(batch: pa.RecordBatch, weights: np.ndarray, n_docs: int, total: int):
    """(number of terms of each document, terms, impacts) of a batch of the index."""
    terms, tfs = batch.column("terms"), batch.column("tfs")
    counts = pc.list_value_length(terms).to_numpy().astype(np.int64)
    m = np.repeat(lengths(batch.column("n").to_numpy(), n_docs, total), counts)
    term = terms.flatten().to_numpy().astype(np.int64)
    return counts, term, impacts(weights[term], tfs.flatten().to_numpy().astype(np.int64), m)


def _strongest(weights: np.ndarray, n_docs: int, total: int, k: int):
    """Of each term a task's k highest impacts."""

    def run(batches):
        term, impact = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        least = np.full(len(weights), -1)
        for batch in batches:
            _, t, x = _pairs(batch, weights, n_docs, total)
            higher = x > least[t]
            term, impact = np.append(term, t[higher]), np.append(impact, x[higher])
            order = np.lexsort((-impact, term))
            term, impact = term[order], impact[order]
            place = np.arange(len(term)) - np.searchsorted(term, term)
            least[term[place == k - 1]] = impact[place == k - 1]
            term, impact = term[place < k], impact[place < k]
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(impact)], names=["term", "impact"])

    return run


class Seeded:
    """The join of index rows with a block's items above a bound of each item's k-th score."""

    def __init__(self, items: Items, ceiling: np.ndarray, kth: np.ndarray, k: int, id_type: pa.DataType):
        order = np.lexsort((items.term, -ceiling[items.term], items.item))
        self.items, self.k = items, k
        self.item, self.term = items.item[order], items.term[order]
        self.ceiling = ceiling[self.term]
        self.first = np.searchsorted(self.item, np.arange(len(items.ids) + 1))
        # The seed: the largest k-th impact of an item's terms.
        self.bound = np.zeros(len(items.ids), dtype=np.int64)
        np.maximum.at(self.bound, self.item, kth[self.term])
        self.best = pa.table({"item": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "doc_id": pa.array([], id_type)})
        self._prune()

    def _prune(self) -> None:
        """Which pairs make candidates, and what an item's other terms add at most."""
        total = np.append(np.cumsum(self.ceiling[::-1])[::-1], 0)
        self.rest = total[:-1] - total[self.first[self.item + 1]]
        essential = self.rest >= self.bound[self.item]
        self.n_essential = np.bincount(self.item[essential], minlength=len(self.bound))
        left = self.first[:-1] + self.n_essential
        self.left = np.where(left < self.first[1:], np.append(self.rest, 0)[np.minimum(left, len(self.rest))], 0)
        pairs = np.flatnonzero(essential)
        pairs = pairs[np.argsort(self.term[pairs], kind="stable")]
        self.by_term = self.item[pairs]
        self.at = np.searchsorted(self.term[pairs], np.arange(len(self.items.vocabulary) + 1))

    def scan(self, doc_ids: pa.Array, counts: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        starts = np.append(0, np.cumsum(counts))
        triples = np.append(0, np.cumsum(self.at[term + 1] - self.at[term]))[starts]
        doc = 0
        while doc < len(counts):
            upto = max(doc + 1, int(np.searchsorted(triples, triples[doc] + TRIPLES, side="right")) - 1)
            lo, hi = starts[doc], starts[upto]
            self._part(doc_ids, np.repeat(np.arange(doc, upto), counts[doc:upto]), term[lo:hi], impact[lo:hi])
            doc = upto

    def _part(self, doc_ids: pa.Array, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        n_items, n_terms = len(self.bound), len(self.items.vocabulary)
        here = self.at[term + 1] - self.at[term]
        pair = np.repeat(np.arange(len(term)), here)
        if not len(pair):
            return
        item = self.by_term[np.arange(len(pair)) - np.repeat(np.cumsum(here) - here, here) + self.at[term][pair]]
        keys = doc[pair] * n_items + item
        order = np.argsort(keys, kind="stable")
        keys, added = keys[order], impact[pair][order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, score = keys[new], np.add.reduceat(added, new)
        d, i = keys // n_items, keys % n_items
        # Candidates that can't reach the bound with all that is left go; the rest is scored over all terms.
        may = score + self.left[i] >= self.bound[i]
        d, i, score = d[may], i[may], score[may]
        begin, n = self.first[i] + self.n_essential[i], self.first[i + 1] - self.first[i] - self.n_essential[i]
        who = np.repeat(np.arange(len(d)), n)
        others = self.term[np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + begin[who]]
        known, wanted = doc * n_terms + term, d[who] * n_terms + others
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        more = np.where(known[at] == wanted, impact[at], 0)
        np.add.at(score, who, more)
        in_ = (score >= self.bound[i]) & (score > 0)
        if in_.any():
            self._keep(pa.table({"item": i[in_], "score": score[in_], "doc_id": doc_ids.take(pa.array(d[in_]))}))

    def _keep(self, found: pa.Table) -> None:
        every = pa.concat_tables([self.best, found])
        every = every.take(pc.sort_indices(every, sort_keys=[("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")], null_placement="at_end"))
        item, score = every["item"].to_numpy(), every["score"].to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        self.best = every.filter(pa.array(place < self.k)).combine_chunks()
        full = place == self.k - 1
        self.bound[item[full]] = np.maximum(self.bound[item[full]], score[full])
        self._prune()

    def result(self) -> pa.RecordBatch:
        own = self.best
        return pa.RecordBatch.from_arrays([self.items.ids.take(own["item"].combine_chunks()), own["doc_id"].combine_chunks(), own["score"].combine_chunks()], names=["item_id", "doc_id", "score"])


def _blocks(items: DataFrame, limit: int) -> list[DataFrame]:
    own = items.select("item_id", F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    chars = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = int(-(-chars // limit)) or 1
    return [own] if n == 1 else [own.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b) for b in range(n)]


def search(docs: DataFrame, items: DataFrame, k: int = K, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k documents of the highest scores above 0, equal ones by ascending id.

    One pass writes an index of the documents' lengths and of the items' terms in them; terms that no item has can't
    change a score.  The items are broadcast in blocks of at most about `block_chars` characters, and of each term two
    numbers reach the driver, so that what is broadcast or collected is bounded by a block, however many documents there
    are.  Documents are never shuffled: tasks send at most k of them an item, however common a term is.

    Null and empty texts have no term and aren't counted.  Each row is a document, also one that repeats an id, and a
    null id comes after all others.  Texts of one item id make one item; null ids and items without terms have no
    results.  Other columns are ignored, and empty tables give none.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type, item_type = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    out = f"item_id {item_type}, doc_id {id_type}, score long"
    found = spark.createDataFrame([], out)
    for block in _blocks(items, block_chars):
        rows = block.toArrow().combine_chunks()  # `block_chars` characters at most
        ids, texts = ((x.chunk(0) if x.num_chunks else pa.array([], x.type)) for x in (rows["item_id"], rows["text"]))
        own = Items.of(ids, texts)
        if not len(own.vocabulary):
            continue
        shared = spark.sparkContext.broadcast(own)
        index = stored(docs.mapInArrow(lambda batches, s=shared: _indexed(s.value)(batches), f"doc_id {id_type}, n long, terms array<int>, tfs array<int>"))
        n_docs, total = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        weights = np.zeros(len(own.vocabulary), dtype=np.int64)
        for term, df in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the block's terms
            weights[term] = weight(n_docs, df)
        high = index.select("n", "terms", "tfs").mapInArrow(lambda batches, x=(weights, n_docs, total, k): _strongest(*x)(batches), "term long, impact long")
        place = F.row_number().over(Window.partitionBy("term").orderBy(F.desc("impact")))
        high = high.withColumn("place", place).where(F.col("place") <= k).groupBy("term")
        ceiling, kth = np.zeros_like(weights), np.zeros_like(weights)
        for term, most, least in high.agg(F.max("impact"), F.max(F.when(F.col("place") == k, F.col("impact")))).collect():  # the block's terms
            ceiling[term], kth[term] = most, least or 0
        bounds = spark.sparkContext.broadcast((weights, ceiling, kth, n_docs, total))

        def join(batches, shared=shared, bounds=bounds):
            weights, ceiling, kth, n_docs, total = bounds.value
            own = None
            for batch in batches:
                own = own or Seeded(shared.value, ceiling, kth, k, batch.schema.field("doc_id").type)
                own.scan(batch.column("doc_id"), *_pairs(batch, weights, n_docs, total))
            if own:
                yield own.result()

        found = found.unionByName(index.mapInArrow(join, out))
    ranks = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", ranks).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
