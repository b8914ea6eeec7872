"""Ranked search and phrase collocations against SQL and brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyquill.llm import phrases, ranked
from tallyquill.llm.queries import ORACLE_SQL, QUERIES
from tests.sameness import SF, connection, same

LOWER = {i: i + 32 for i in range(65, 91)}


def searched(docs, items, k=10):
    """(item, rank, doc, score) as the contract says, over (id, text) rows."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    own = [(i, Counter(w), len(w)) for i, w in ((i, cut(t)) for i, t in docs) if w]
    total, df = sum(n for _, _, n in own), Counter(w for _, c, _ in own for w in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i].update(cut(t))
    out = []
    for item, words in asked.items():
        scores = []
        for i, c, n in own:
            m = 10 + 90 * n * len(own) // total
            score = sum(math.floor(1000 * math.log((2 * len(own) + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m)) for w in words & c.keys())
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def mined(docs, least, longest=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) as the contract says, over (lang, text) rows."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\n\v\f\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        candidates = {p: a for p, a in own.items() if a >= least and len(p) > 1}
        inside = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                inside.update((q) for q in (p[i : i + k] for i in range(len(p) - k + 1)) if 100 * a >= 100 * own[q])
        best = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(best)[:top])]
    return sorted(out)


def prose(n, seed, words=40, length=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Über", "ümlaut", "x y", "don't", "z\x1f"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return ["".join(w + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in r.choices(vocabulary, weights, k=r.randrange(1, length))) for _ in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_phrase_pairs"])
def test_same_rows_as_sql(spark, name):
    same(QUERIES[name](spark, str(SF)), ORACLE_SQL[name], connection())


@pytest.mark.parametrize("limit", [ranked.BLOCK_CHARS, 300])
def test_search_is_brute_force(spark, limit, monkeypatch):
    docs = [(i % 300, t) for i, t in enumerate(prose(400, 1))]
    items = [(i % 17, t) for i, t in enumerate(prose(20, 2, 60, 12))] + [(100, None), (101, "Q.Q"), (102, "nowhere"), (None, "w1")]
    monkeypatch.setattr(ranked, "TRIPLES", 50)
    got = ranked.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id int, text string"), block_chars=limit)
    assert rows(got) == searched(docs, items)


def test_search_keeps_ties_by_id(spark):
    docs = [(i, "same words here") for i in random.Random(4).sample(range(1000), 60)] + [(5000 + i, f"other text {i}") for i in range(200)]
    got = ranked.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame([("i", "words Here")], "item_id string, text string"))
    assert rows(got) == searched(docs, [("i", "words Here")])


def test_bounds_prune_and_lose_nothing():
    """One rare term decides; documents that hold but common terms are no candidates."""
    ids, texts = ranked.pa.array(["i"]), ranked.pa.array(["rare common other"])
    items = ranked.Items.of(ids, texts)
    at = {w.as_py(): n for n, w in enumerate(items.vocabulary)}
    ceiling, kth = np.zeros(3, dtype=np.int64), np.zeros(3, dtype=np.int64)
    ceiling[[at[b"rare"], at[b"common"], at[b"other"]]] = 900, 30, 20
    kth[at[b"rare"]] = 800
    own = ranked.Seeded(items, ceiling, kth, 10, ranked.pa.int64())
    assert own.n_essential.tolist() == [1] and own.left.tolist() == [50] and own.bound.tolist() == [800]


def test_search_of_awkward_rows(spark):
    docs = [(1, None), (2, ""), (3, " .\n"), (4, "one"), (5, "one two"), (5, "one two"), (None, "one two"), (7, "word " * 200_000 + "two"), (8, "ÜBER über \u0000")]
    items = [(1, "One TWO three"), (1, "über"), (2, "word"), (3, "ÜBER")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS n", "'r' AS rank", "2 AS item_id")
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS doc_id")
    assert rows(ranked.search(df, asked)) == searched(docs, items)
    assert ranked.search(df.limit(0), asked).count() == 0 == ranked.search(df, asked.limit(0)).count()


@pytest.mark.parametrize("names", [phrases.BROADCAST_ROWS, 0, 30])
def test_phrases_are_brute_force(spark, names):
    docs = [(["en", "de", None, "und"][i % 4], t) for i, t in enumerate(prose(600, 7))] + [("en", "a b c d e f. " * 20)] * 3
    df = spark.createDataFrame(docs, "lang string, text string").repartition(6)
    got = phrases.collocations(df, least=15, broadcast_rows=names)
    assert rows(got) == rows_of(mined(docs, 15))


def rows_of(expected):
    return sorted(expected, key=str)


def test_phrases_exactly_and_in_order(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 64)
    docs = [("x", t) for t in prose(900, 11, words=8, length=30)]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert rows(phrases.collocations(df, least=20, longest=4, top=25)) == rows_of(mined(docs, 20, 4, 25))


def test_products_beyond_64_bits(spark):
    a, n = 10**12, 10**13
    sql = f"SELECT (cast(1000 AS decimal(4,0)) * cast({a} AS decimal(18,0)) * cast({n} AS decimal(18,0))) div (cast({a + 7} AS decimal(18,0)) * cast({a + 3} AS decimal(18,0)))"
    assert spark.sql(sql).first()[0] == 1000 * a * n // ((a + 7) * (a + 3))


def test_phrases_of_awkward_rows(spark):
    docs = [(None, None), ("en", ""), ("en", ".,;\n"), ("en", "one"), (None, "a b. a b"), ("und", "a b"), ("en", "Über uns " * 5000), ("de", "x\u0000 y\u001f x\u0000 y\u001f")] * 2
    df = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 AS row", "'q' AS a", "0 AS n", "'w' AS word", "3 AS id", "4 AS c")
    for least in (2, 4, 10_000, 10**9):
        assert rows(phrases.collocations(df, least=least)) == rows_of(mined(docs, least))
    assert phrases.collocations(df.limit(0)).count() == 0
