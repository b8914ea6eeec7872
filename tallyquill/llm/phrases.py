"""Phrase collocations by hierarchical pair naming.

Frequent words get ids.  A phrase of k words is the pair of two phrases of k - 1 words that overlap in all but its ends,
so texts are sequences of ids in which adjacent frequent ids are replaced, level after level, by the id of their pair.
Pairs are counted and named over all documents at once; what is not frequent breaks a sequence and makes no longer
phrase.  A pair's two ids are its parents: its first and last words.  Counts of all beginnings and endings are handed
down from the parents, which settles where a phrase is cut, and a phrase that lies in a longer one is that one's parent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.llm import tokens
from tallyquill.llm.common import arrow_batches, cut, stored

#: Least occurrences of a phrase, its most words, and phrases of a language that are returned.
LEAST, LONGEST, TOP = 100, 5, 2000
#: A phrase goes if a longer one around it has this percentage of its occurrences.
PERCENT = 100
#: Most names, and most bytes of words, that are broadcast; more are joined.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 64 << 20
#: Distinct pairs that a task counts before it sends them on.
HELD = 1 << 20
#: Parts that each key of a join of positions is dealt into, for one pair may be a large share of all positions.
SALTS = 16

#: Bytes that end a piece; words are runs of anything but these, blanks and tabs.
STOPS = np.zeros(256, dtype=bool)
STOPS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
WORD = ~STOPS
WORD[[0x20, 0x09]] = False


def _words(batch: pa.RecordBatch):
    """(language, rows of the batch, words of each, the words, whether a piece ends before each) of runs of rows of one language."""
    langs = batch.column("lang").dictionary_encode()
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        rows = np.flatnonzero(langs.indices.to_numpy() == code)
        texts = batch.column("text").take(pa.array(rows))
        for first, raw, row_bytes in tokens.chunks(texts):
            data = tokens.LOWER[raw]
            starts, ends, bounds = tokens.spans(data, row_bytes, WORD)
            stops = np.append(0, np.cumsum(STOPS[data]))[starts]
            fresh = np.append(True, stops[1:] != stops[:-1])[: len(starts)]
            yield lang, rows[first : first + len(bounds) - 1], np.diff(bounds), tokens.word_array(data, WORD, starts, ends), fresh


def _word_counts(batches):
    """(lang, word, c), and for each language all its words with no word."""
    for batch in batches:
        for lang, _, _, words, _ in _words(batch):
            if not len(words):
                continue
            own = words.value_counts()
            values, counts = own.field("values").cast(pa.large_string()), own.field("counts")
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(own) + 1)), pa.concat_arrays([values, pa.nulls(1, pa.large_string())]).cast(pa.string()), pa.concat_arrays([counts, pa.array([len(words)])])], names=["lang", "word", "c"])


def _sequences(counts: np.ndarray, ids: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, offsets, ids) of sequences with 0 where nothing goes on, of the rows that have two ids side by side."""
    row = np.repeat(np.arange(len(counts)), counts)
    new_row = np.append(True, row[1:] != row[:-1])[: len(row)]
    gaps = (fresh & ~new_row).astype(np.int64)
    out = np.zeros(len(ids) + int(gaps.sum()), dtype=np.int64)
    at = np.arange(len(ids)) + np.cumsum(gaps)
    out[at] = ids
    rows = np.zeros(len(out), dtype=np.int64)
    rows[at] = row
    rows[at[gaps > 0] - 1] = row[gaps > 0]
    return _dense(rows, out)


def _dense(row: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same sequences without ids that stand alone and without zeros but one between ids."""
    same = row[1:] == row[:-1]
    beside = same & (ids[1:] > 0) & (ids[:-1] > 0)
    kept = np.append(beside, False) | np.append(False, beside) if len(ids) else np.zeros(0, dtype=bool)
    ids = np.where(kept, ids, 0)
    # One zero behind each run of ids.
    kept |= np.append(False, kept[:-1] & same)[: len(ids)]
    row, ids = row[kept], ids[kept]
    own, first = np.unique(row, return_index=True)
    return own, np.append(first, len(row)), ids


def _batch(keys: pa.Array, offsets: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], names=["row", "ids"])


def _adjacent(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row in the batch, ids, places of the first of two ids side by side in a row)."""
    ids = batch.column("ids")
    row = np.repeat(np.arange(len(ids)), pc.list_value_length(ids).to_numpy())
    flat = ids.flatten().to_numpy()
    return row, flat, np.flatnonzero((row[1:] == row[:-1]) & (flat[1:] > 0) & (flat[:-1] > 0))


def _counted(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    left, right, c = (np.concatenate(x) for x in zip(*parts))
    if max(left.max(initial=0), right.max(initial=0)) < 1 << 31:
        order = np.argsort(left << 31 | right)
    else:
        order = np.lexsort((right, left))
    left, right, c = left[order], right[order], c[order]
    new = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))[: len(left)]
    return left[new], right[new], np.add.reduceat(c, new) if len(new) else c


def _pair_counts(batches):
    """(left, right, c) of the pairs of a task, sent on when there are many."""
    parts, rows = [], 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=["left", "right", "c"])

    for batch in batches:
        _, ids, at = _adjacent(batch)
        parts.append((ids[at], ids[at + 1], np.ones(len(at), dtype=np.int64)))
        rows += len(at)
        if rows >= HELD:
            parts = [_counted(parts)]
            rows = len(parts[0][0])
            if rows >= HELD // 2:
                yield out()
                parts, rows = [], 0
    if parts:
        parts = [_counted(parts)]
        yield out()


def _numbered(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows with an `id` from 1 on, without gaps, and how many there are; only the sizes of partitions are collected."""
    own = cut(df)
    sizes = dict(own.groupBy(F.spark_partition_id().alias("p")).count().collect())
    before, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append(total + 1)
        total += sizes.get(p, 0)
    if not total:
        return own.withColumn("id", F.lit(0).cast("long")), 0
    part, place = F.spark_partition_id(), F.monotonically_increasing_id()
    first = F.element_at(F.array(*[F.lit(x).cast("long") for x in before]), part + 1)
    return own.withColumn("id", place - F.shiftleft(part.cast("long"), 33) + first), total


def _join_positions(positions: DataFrame, names: DataFrame, on: list[str]) -> DataFrame:
    """Sequences (row, ids) of the positions (row, pos, *on) that have a name: the way for more names than are broadcast."""
    salted = names.select(*on, "id").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = positions.withColumn("_salt", F.pmod(F.xxhash64("row", "pos"), F.lit(SALTS)).cast("int")).join(salted, [*on, "_salt"])
    every = named.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("at"))  # a row is one document
    near = lambda x, i: (i > 0) & (F.get("at", i - 1)["pos"] == x["pos"] - 1)
    return every.select("row", F.flatten(F.transform("at", lambda x, i: F.when(near(x, i), F.array(x["id"])).otherwise(F.array(F.lit(0).cast("long"), x["id"])))).alias("ids"))


def _encoded(docs: DataFrame, names: DataFrame, small: bool) -> DataFrame:
    """Texts (row, lang, text) as sequences of the ids of their frequent words."""
    if small:
        known: dict[str, tuple] = {}
        table = names.select("lang", "word", "id").toArrow()  # BROADCAST_ROWS rows and BROADCAST_BYTES bytes at most
        for lang in pc.unique(table["lang"]).to_pylist():
            own = table.filter(pc.equal(table["lang"], lang))
            known[lang] = own["word"].combine_chunks().cast(pa.large_string()).cast(pa.large_binary()), own["id"].to_numpy()
        shared = docs.sparkSession.sparkContext.broadcast(known)

        def encode(batches):
            for batch in batches:
                for lang, rows, counts, words, fresh in _words(batch):
                    if lang in shared.value and len(words):
                        vocabulary, ids = shared.value[lang]
                        found = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy()
                        own, offsets, seq = _sequences(counts, np.where(found < 0, 0, ids[found]), fresh)
                        yield _batch(batch.column("row").take(pa.array(rows[own])), offsets, seq)

        return docs.mapInArrow(encode, "row long, ids array<long>")

    def places(batches):
        for batch in batches:
            for lang, rows, counts, words, fresh in _words(batch):
                row = np.repeat(rows, counts)
                new_row = np.append(True, row[1:] != row[:-1])[: len(row)]
                pos = np.arange(len(row)) + np.cumsum(fresh & ~new_row)
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(row)), pa.array(pos), pa.array([lang] * len(row), pa.string()), words.cast(pa.large_string()).cast(pa.string())], names=["row", "pos", "lang", "word"])

    return _join_positions(docs.mapInArrow(places, "row long, pos long, lang string, word string"), names, ["lang", "word"])


def _renamed(seq: DataFrame, names: DataFrame, small: bool) -> DataFrame:
    """Sequences in which two ids side by side are replaced by their pair's id, and by 0 where that has none."""
    if small:
        table = names.select("left", "right", "id").toArrow()  # BROADCAST_ROWS rows at most, of ids below 2 ** 31
        keys = table["left"].to_numpy() << 31 | table["right"].to_numpy()
        order = np.argsort(keys)
        shared = seq.sparkSession.sparkContext.broadcast((keys[order], table["id"].to_numpy()[order]))

        def rename(batches):
            for batch in batches:
                keys, names = shared.value
                row, ids, at = _adjacent(batch)
                pairs = ids[at] << 31 | ids[at + 1]
                found = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                out = np.zeros(len(ids), dtype=np.int64)
                out[at] = np.where(keys[found] == pairs, names[found], 0)
                own, offsets, new = _dense(row, out)
                yield _batch(batch.column("row").take(pa.array(own)), offsets, new)

        return seq.mapInArrow(rename, "row long, ids array<long>")

    def places(batches):
        for batch in batches:
            row, ids, at = _adjacent(batch)
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(row[at])), pa.array(at), pa.array(ids[at]), pa.array(ids[at + 1])], names=["row", "pos", "left", "right"])

    return _join_positions(seq.mapInArrow(places, "row long, pos long, left long, right long"), names, ["left", "right"])


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's `top` phrases of 2 to `longest` words.

    Each level is one pass that counts pairs in each task and sums them over all, and one that replaces them.  Names up to
    `broadcast_rows` are broadcast behind a count; more are joined by salted positions.  Lists of names, which are at most
    a share 1 / `least` of all words a level, stay distributed.  Scores are worked out in decimals of 38 digits.

    A null language counts as `und`.  Null and empty texts have no words.  Each row counts, also one that repeats others;
    phrases with equal scores and occurrences are ranked by their bytes.  Other columns are ignored, ids are not needed,
    and no rows give none.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = own.mapInArrow(_word_counts, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("a"))
    words = cut(words.where(F.col("word").isNull() | (F.col("a") >= least)))
    totals = words.where("word is null").select("lang", F.col("a").alias("n"))
    none = F.array().cast("array<long>")
    level, rows = _numbered(words.where("word is not null").select("lang", "word", F.col("word").alias("phrase"), "a", none.alias("heads"), none.alias("tails")))
    size = words.agg(F.sum(F.octet_length("word"))).first()[0] or 0
    seq, found, k = own, [], 1
    while rows and k < longest:
        small = rows <= broadcast_rows and (size <= BROADCAST_BYTES if k == 1 else before < 1 << 31)
        seq = stored(_encoded(seq, level, small) if k == 1 else _renamed(seq, level, small))
        before, k = rows, k + 1
        pairs = seq.mapInArrow(_pair_counts, "left long, right long, c long").groupBy("left", "right").agg(F.sum("c").alias("a")).where(F.col("a") >= least)
        first = level.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("begin"), F.concat("heads", F.array("a")).alias("heads"))
        last = level.select(F.col("id").alias("right"), "word", F.concat("tails", F.array("a")).alias("tails"))
        # The parents' counts: of the first 1 .. k - 1 words and of the last ones.
        level, rows = _numbered(pairs.join(first, "left").join(last, "right").select("left", "right", "lang", "word", F.concat_ws(" ", "begin", "word").alias("phrase"), "a", "heads", "tails"))
        found.append(level)
    schema = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
    if not found:
        return spark.createDataFrame([], schema)
    kept = None
    for shorter, longer in zip(found, [*found[1:], None]):
        if longer is not None:
            around = longer.select(F.explode(F.array("left", "right")).alias("id"), F.col("a").alias("longer")).groupBy("id").agg(F.max("longer").alias("longer"))
            shorter = shorter.join(around, "id", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))
        shorter = shorter.select("lang", "phrase", "a", "heads", "tails")
        kept = shorter if kept is None else kept.unionByName(shorter)
    wide = lambda c: c.cast("decimal(18,0)")
    cuts = F.explode(F.transform("heads", lambda l, j: F.struct(j.alias("cut"), l.alias("l"), F.get("tails", F.size("tails") - 1 - j).alias("r"))))  # noqa: E741
    scored = kept.join(totals, "lang").select("lang", "phrase", "a", "n", cuts.alias("c")).select("lang", "phrase", "a", "n", "c.*")
    scored = scored.withColumns({"above": F.lit(1000).cast("decimal(4,0)") * wide(F.col("a")) * wide(F.col("n")), "below": wide(F.col("l")) * wide(F.col("r"))})
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct(F.expr("above div below").alias("score"), "cut", "a", "l", "r", "n")).alias("best")).select("lang", "phrase", "best.*")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
