"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm import tokens
from tallyquill.llm.common import arrow_batches, held_out, labelled_sample, plus

#: log2 of the number of weights.
BITS = 20
#: Most labelled documents that the weights are learnt from, half of them of each label where there are so many.
SAMPLE = 10_000
#: Rows that are learnt from in all rounds together, so that few labels are passed over more often; least and most rounds.
PASSED, ROUNDS, MOST_ROUNDS = 12_000, 2, 16
ALPHA, BETA, L1, L2 = 0.3, 1.0, 6.0, 0.2
#: A document is toxic if its score is at least this.
THRESHOLD = 0.7
_SEEDS = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def features(w: tokens.Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of each distinct feature of each row, sorted.

    Features are hashes of words, of their first four and five bytes, of pairs of neighbouring words, and of pairs
    with one word left out between them (skip-grams), each present or absent.
    """
    h, rows, n = w.hashes, w.rows, len(w.hashes)
    parts = [(rows, tokens.mix(h ^ _SEEDS[0])), (rows, tokens.prefixes(w, 4)), (rows, tokens.prefixes(w, 5))]
    for gap, seed in ((1, _SEEDS[1]), (2, _SEEDS[2])):
        if n > gap:
            same = np.flatnonzero(rows[:-gap] == rows[gap:])
            parts.append((rows[same], tokens.mix(h[same] * seed + h[same + gap])))
    shift = np.uint64(64 - bits)
    return tokens.by_row(np.concatenate([r for r, _ in parts]), np.concatenate([(v >> shift).astype(np.int64) for _, v in parts]))


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The proximal step: zero within L1, else scaled by the coordinate's own rate."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _learn(state, size: int):
    """Passes once over the sample, in the order of its rows, from the broadcast state; gives the coordinates it changed."""

    def run(batches):
        known, own_z, own_n = state.value
        z, n = np.zeros(size), np.zeros(size)
        z[known], n[known] = own_z, own_n
        touched = np.zeros(len(z), dtype=bool)
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for w in tokens.words(batch.column("text"), tokens.ALNUM):
                rows, at = features(w)
                bounds = np.searchsorted(rows, np.arange(w.n_rows + 1))
                for r in range(w.n_rows):
                    own = np.append(at[bounds[r] : bounds[r + 1]], 0)  # 0: the bias
                    zi, ni = z[own], n[own]
                    wi = weights(zi, ni)
                    g = 1 / (1 + np.exp(-np.clip(wi.sum(), -35, 35))) - y[w.first + r]
                    z[own] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
                    n[own] = ni + g * g
                    touched[own] = True
        own = np.flatnonzero(touched)
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(z[own]), pa.array(n[own])], names=["k", "z", "n"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> np.ndarray:
    """Weights learnt from a bounded sample of the labelled documents outside the held-out fold.

    One learner passes over the whole sample in each round, so that a coordinate's sums count all of its documents and
    L1 means the same whatever the number of rows.  Learners side by side do worse: averaged, each coordinate has one
    part's documents only; added up, the steps that all of them make overshoot.  What a round sends is bounded by the
    number of weights.
    """
    arrow_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    own = labelled_sample(docs, labels, "toxic", 3, 1, sample)
    own = own.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "text").persist()
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    try:
        rounds = min(max(ROUNDS, -(-PASSED // max(own.count(), 1))), MOST_ROUNDS)
        for _ in range(rounds):
            known = np.flatnonzero(n).astype(np.int32)
            state = sc.broadcast((known, z[known], n[known]))
            rows = own.mapInArrow(_learn(state, len(z)), "k long, z double, n double").toArrow()
            k = rows["k"].to_numpy()
            z[k], n[k] = rows["z"].to_numpy(), rows["n"].to_numpy()
            state.destroy()
    finally:
        own.unpersist()
    return weights(z, n)


def _probabilities(text: pa.Array, learnt: np.ndarray) -> np.ndarray:
    scores = np.zeros(len(text))
    for w in tokens.words(text, tokens.ALNUM):
        rows, at = features(w, int(len(learnt)).bit_length() - 1)
        scores[w.first : w.first + w.n_rows] = np.bincount(rows, learnt[at], w.n_rows)
    return 1 / (1 + np.exp(-np.clip(scores + learnt[0], -35, 35)))


def score(docs: DataFrame, learnt: np.ndarray, column: str = "score") -> DataFrame:
    """`docs` with each whole text's toxicity between 0 and 1 in `column`.

    Null and empty texts get the score of a text without words.  Rows are scored one by one, so repeated rows, ties
    and columns of other names don't matter; a column named like `column` is replaced.
    """
    arrow_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(learnt.astype(np.float32))
    own = docs.drop(column)

    def run(batches):
        for batch in batches:
            scored = _probabilities(batch.column("text"), model.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scored)], names=[*batch.schema.names, column])

    return own.mapInArrow(run, plus(own, column, "double"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
