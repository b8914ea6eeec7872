"""Language by rank-order profiles: out-of-place distance between a text's most frequent n-grams and each language's."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyquill.llm import tokens
from tallyquill.llm.common import arrow_batches, bucket, held_out

#: N-grams of a profile, and so the distance of one that a language's profile doesn't have.
RANKS = 300
#: Distinct n-grams that a task counts before it sends its sums on.
FLUSH = 2_000_000
UNDETERMINED = "und"
_fold: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """By code point: the lower-case letter, or 0 for what is no letter."""
    if not _fold:
        points = np.zeros(0x110000, dtype=np.uint64)
        for c in (*range(0xD800), *range(0xE000, 0x110000)):
            if (x := chr(c)).isalpha():
                points[c] = ord(x.lower()[0])
        _fold.append(points)
    return _fold[0]


def grams(text: str) -> np.ndarray:
    """The text's letters, pairs and triples of letters, with one blank at either end of a word, as numbers.

    Runs of anything but letters are one blank; no n-gram crosses a word's end.
    """
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    letters = np.zeros(len(points) + 2, dtype=np.uint64)
    letters[1:-1] = _letters()[points]
    blank = letters == 0
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    if blank.all():
        return letters[:0]
    first = int(np.argmin(blank))
    keep[first - 1] = True
    own = letters[keep]
    two = (own[:-1] << np.uint64(21)) | own[1:]
    three = ((own[:-2] << np.uint64(42)) | (own[1:-1] << np.uint64(21)) | own[2:])[own[1:-1] > 0]
    return np.concatenate([own[own > 0], two, three])


def ranked(text: str, most: int = RANKS) -> np.ndarray:
    """The most frequent n-grams, in order of count and then of number."""
    values, counts = np.unique(grams(text), return_counts=True)
    if len(values) > most:  # at least the `most` largest counts, ties at the end included
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        values, counts = values[counts >= least], counts[counts >= least]
    return values[np.argsort(-counts, kind="stable")][:most]


def _counted(batches):
    """Batches of (text, lang) to (lang, gram, n), summed in the task."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out():
        for lang, (g, n) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
        sums.clear()

    for batch in batches:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            found.setdefault(lang, []).append(np.unique(grams(text.as_py()), return_counts=True))
        for lang, parts in found.items():
            if lang in sums:
                parts.append(sums[lang])
            values, place = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
            sums[lang] = values, np.bincount(place, np.concatenate([n for _, n in parts]), len(values)).astype(np.int64)
        if sum(len(v) for v, _ in sums.values()) > FLUSH:
            yield from out()
    yield from out()


def fit(docs: DataFrame, most: int = RANKS) -> dict[str, np.ndarray]:
    """Each language's `most` frequent n-grams in order, counted over all documents outside the held-out fold.

    Counts are summed in tasks and by Spark; only the profiles, `most` n-grams for each language, reach the driver.
    """
    arrow_batches(docs.sparkSession)
    own = docs.where((bucket("doc_id", 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    sums = own.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = sums.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))).where(F.col("rank") <= most)
    rows = best.orderBy("lang", "rank").toPandas()
    return {lang: g.gram.to_numpy().astype(np.uint64) for lang, g in rows.groupby("lang", sort=True)}


def _predictions(profiles: dict[str, np.ndarray], most: int):
    names = sorted(profiles)
    keys = np.unique(np.concatenate([profiles[x] for x in names])) if names else np.zeros(0, dtype=np.uint64)
    place = np.full((len(names), len(keys) + 1), -1)
    for k, x in enumerate(names):
        place[k, np.searchsorted(keys, profiles[x])] = np.arange(len(profiles[x]))

    def predict(text: str) -> tuple[str, float]:
        own = ranked(text, most)
        if not len(own) or not names:
            return UNDETERMINED, 0.0
        at = np.searchsorted(keys, own)
        at[keys[np.minimum(at, len(keys) - 1)] != own] = len(keys)
        there = place[:, at]
        distance = np.where(there < 0, most, np.abs(there - np.arange(len(own)))).sum(axis=1) / (most * len(own))
        best = int(np.argmin(distance))
        return names[best], float(1 - distance[best])

    return predict


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], most: int = RANKS) -> DataFrame:
    """`docs` with lang_pred and score (1: the ranks of the chosen profile; 0: none of its n-grams) of each whole text.

    Null, empty and letterless texts are `und` with score 0, as all are if nothing was learnt.  Ties go to the first
    language by name.  Columns of those names are replaced.
    """
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    own = docs.drop("lang_pred", "score")

    def run(batches):
        predict = _predictions(shared.value, most)
        for batch in batches:
            found = [predict(t.as_py() or "") for t in batch.column("text")]
            added = [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "lang_pred", "score"])

    return own.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in own.schema)}, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs`."""
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")
