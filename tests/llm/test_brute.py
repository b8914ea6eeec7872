"""Learning operators against plain loops over the same rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyquill.llm import language, tokens, toxicity
from tests.llm.test_search import prose
from tests.sameness import SF


def grams_of(text):
    """Letters, pairs and triples of the words of a text with a blank at either end, as numbers."""
    words, word = [], ""
    for c in [*(text or ""), " "]:
        if c.isalpha():
            word += c.lower()[0]
        elif word:
            words.append(word)
            word = ""
    found = Counter()
    for w in words:
        own = [0, *map(ord, w), 0]
        found.update(own[1:-1])
        found.update((a << 21) | b for a, b in zip(own, own[1:]))
        found.update((a << 42) | (b << 21) | c for a, b, c in zip(own, own[1:], own[2:]))
    return found


def best(counts, most):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]]


def test_languages_are_plain_out_of_place_distances(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", (F.crc32(F.col("doc_id").cast("string")) % 5).alias("fold"))
    rows = docs.collect()
    sums = defaultdict(Counter)
    for r in rows:
        if r.fold != 0 and r.lang is not None and r.text is not None:
            sums[r.lang].update(grams_of(r.text))
    profiles = {x: {g: k for k, g in enumerate(best(c, language.RANKS))} for x, c in sums.items()}
    got = {r.doc_id: (r.lang_pred, r.score, r.held_out) for r in language.languages(docs).collect()}
    for r in rows:
        own = best(grams_of(r.text), language.RANKS)
        if not own:
            assert got[r.doc_id] == ("und", 0.0, r.fold == 0)
            continue
        distance = {x: sum(abs(p[g] - k) if g in p else language.RANKS for k, g in enumerate(own)) / (language.RANKS * len(own)) for x, p in profiles.items()}
        name = min(distance, key=lambda x: (distance[x], x))
        assert got[r.doc_id][0] == name and abs(got[r.doc_id][1] - (1 - distance[name])) < 1e-12 and got[r.doc_id][2] == (r.fold == 0)


def test_toxicity_is_learnt_as_by_plain_ftrl(spark):
    texts = prose(60, 5)
    rows = [(i, t + (" vile insult" if i % 3 == 0 else "")) for i, t in enumerate(texts)]
    rows[4] = (4, "long text " * 6000)  # whole, however long
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0).alias("toxic"))
    own = docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1).orderBy(F.xxhash64("doc_id"), "text").collect()
    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        if abs(z[k]) <= toxicity.L1:
            return 0.0
        return -(z[k] - math.copysign(toxicity.L1, z[k])) / ((toxicity.BETA + math.sqrt(n[k])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(min(max(toxicity.ROUNDS, -(-toxicity.PASSED // len(own))), toxicity.MOST_ROUNDS)):
        for r in own:
            (w,) = tokens.words(pa.array([r.text]), tokens.ALNUM)
            at = [*toxicity.features(w)[1].tolist(), 0]
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(map(weight, at))))))
            steps = {}
            for k in at:
                g = p - (1 if r.doc_id % 3 == 0 else 0)
                steps[k] = (z[k] + g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / toxicity.ALPHA * weight(k), n[k] + g * g)
            for k, (a, b) in steps.items():
                z[k], n[k] = a, b
    learnt = toxicity.fit(docs, labels)
    want = {k: weight(k) for k in z}
    assert np.flatnonzero(learnt).tolist() == sorted(k for k, w in want.items() if w)
    assert all(abs(learnt[k] - w) < 1e-6 for k, w in want.items())
    scored = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, labels).collect()}
    assert all(scored[r.doc_id] == (r.doc_id % 3 == 0) for r in own)


def test_scores_at_the_threshold_are_predicted(spark):
    """A score that is just the threshold counts as reached, one just below it doesn't."""
    at = math.log(toxicity.THRESHOLD / (1 - toxicity.THRESHOLD))
    for bias, predicted in ((at + 1e-6, 1), (at - 1e-3, 0)):
        learnt = np.zeros(1 << toxicity.BITS)
        learnt[0] = bias
        rows = toxicity.score(spark.createDataFrame([(1, None), (2, ""), (3, "tied words"), (3, "tied words")], "doc_id long, text string"), learnt).collect()
        assert len({r.score for r in rows}) == 1 and all((r.score >= toxicity.THRESHOLD) == bool(predicted) for r in rows)
