"""The corpus operators on the smallest tables against SQL and brute force, and on awkward rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyquill.llm import chat, decontaminate, html, jaccard, language, lm, mixing, neighbours, quality, toxicity
from tallyquill.llm.queries import ORACLE_SQL, QUERIES
from tests.sameness import SF, connection, same

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
AWKWARD = [(1, None), (2, ""), (3, "   \n"), (4, "one"), (5, "one two three four five"), (5, "one two three four five"), (6, "word " * 30_000), (7, "ẞß œ 漢字 \u0000 end"), (None, "no id here at all")]


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def docs_of(spark, rows=AWKWARD):
    """With columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = {"lang": F.lit("en"), "source": F.when(F.col("doc_id") % 2 == 0, "a"), "n_chars": F.length("text").cast("long"), "score": F.lit(1), "key": F.lit("k"), "size": F.lit("s"), "id": F.lit(0)}
    return df.withColumns(extra)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, 1, None), (5, 0, 0), (6, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    same(QUERIES[name](spark, str(SF)), ORACLE_SQL[name], con)


def groups(links, ids):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, n):
    w = SPACED.findall((text or "").translate(LOWER))
    return set(zip(*(w[k:] for k in range(n)))) if len(w) >= n else {tuple(w)} if w else set()


def brute_groups(texts, n, percent):
    sets = {i: shingles(t, n) for i, t in texts.items()}
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if 100 * (both := len(sets[a] & sets[b])) >= percent * (len(sets[a]) + len(sets[b]) - both)]
    return groups(links, sets), {i: len(s) for i, s in sets.items()}


def test_jaccard_join_against_all_pairs(spark, documents):
    of, n = brute_groups({i: r.text for i, r in documents.items()}, 3, 90)
    got = QUERIES["op9_jaccard_rtree"](spark, str(SF)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (n[i], of[i]) for i in documents}


def test_jaccard_join_of_made_near_copies(spark):
    draw = np.random.default_rng(1)
    rows = []
    for base in range(30):
        words = [f"w{x}" for x in draw.integers(0, 5000, int(draw.integers(3, 200)))]
        for copy in range(6):
            own = list(words)
            for at in draw.integers(0, len(own), int(draw.integers(0, 1 + len(own) // 25))):
                own[at] = "x"
            rows.append((base * 10 + copy, " ".join(own)))
    for n, percent in ((3, 90), (5, 80)):
        of, size = brute_groups(dict(rows), n, percent)
        got = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (size[i], of[i]) for i in of}


def test_jaccard_join_on_awkward_rows(spark):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_join(docs_of(spark)).collect())
    assert got == Counter([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 3, 5), (5, 3, 5), (6, 1, 6), (7, 3, 7), (None, 3, None)])
    assert jaccard.jaccard_join(docs_of(spark).limit(0)).count() == 0
    assert jaccard.keep_one(docs_of(spark)).columns == docs_of(spark).columns


def brute_hits(text, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w, hit, found = word.findall((text or "").translate(LOWER)), set(), set()
    for item, t in items:
        own = word.findall((t or "").translate(LOWER))
        n = min(13, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark):
    items = [(1, "a short item"), (2, " ".join(f"q{i}" for i in range(20))), (3, None), (None, "x"), (4, "..."), (2, "second text of two")]
    rows = [*AWKWARD, (8, "A SHORT, item! and " + " ".join(f"q{i}" for i in range(3, 19))), (9, "w " * 100 + "a short item"), (10, " ".join(f"q{i}" for i in range(12)))]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    want = Counter((i, n, h, tuple(x)) for i, t in rows for n, h, x in [brute_hits(t, [y for y in items if y[0] is not None])])
    for block in (decontaminate.BLOCK_CHARS, 10):  # one broadcast set, or several
        got = decontaminate.contamination(docs_of(spark, rows), benchmark, block_chars=block).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
        assert {r.doc_id for r in got if r.contaminated} == {8}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs_of(spark, rows), benchmark, remove="spans").collect()}
    assert cut[8] == "! and" and cut[1] is None and cut[4] == "one"
    assert decontaminate.decontaminate(docs_of(spark, rows), benchmark).count() == len(rows) - 1
    assert decontaminate.contamination(docs_of(spark), benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_mixture(spark, documents):
    got = QUERIES["op4_mix_pareto"](spark, str(SF)).collect()
    assert len(got) == len(documents) and all(r.taken <= 3 * r.size for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), rows in by.items():
        assert abs(sum(r.taken for r in rows) - target) <= max(r.size for r in rows)
    assert sorted(map(tuple, got)) == sorted(map(tuple, QUERIES["op4_mix_pareto"](spark, str(SF)).collect()))
    awkward = mixing.mixture(docs_of(spark)).collect()
    assert len(awkward) == len(AWKWARD) and {r.size for r in awkward if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mixture(docs_of(spark).limit(0)).count() == 0


@pytest.mark.parametrize("of, n, r, fit, score", [("quality", 4, 2, quality.fit, quality.score), ("toxic", 3, 1, toxicity.fit, toxicity.score)])
def test_classifiers_tell_made_labels_apart(spark, of, n, r, fit, score):
    draw = np.random.default_rng(2)
    common = [f"c{x}" for x in range(300)]
    good, bad = [f"pleasant{x}" for x in range(20)], [f"awful{x}" for x in range(20)]
    rows, marks = [], []
    for i in range(1200):
        y = int(draw.random() < 0.5)
        own = [common[k] for k in draw.integers(0, 300, 60)] + [(good if y else bad)[k] for k in draw.integers(0, 20, 12)]
        rows.append((i, " ".join(draw.permutation(own))))
        marks.append((i, y))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, f"doc_id long, {of} int")
    scores = {x.doc_id: x.score for x in score(docs, fit(docs, labels)).collect()}
    told = [(scores[i], y) for i, y in marks if zlib.crc32(str(i).encode()) % n == r]
    assert np.mean([(s >= 0.5) == y for s, y in told]) > 0.95


def test_toxicity_is_learnt_from_few_rows(spark):
    df = lambda name: spark.read.parquet(f"{SF.parent}/sf0.01/{name}.parquet")
    toxic = {r.doc_id: r.toxic for r in df("labels").where("toxic is not null").collect()}
    told = [(r.predicted, toxic[r.doc_id]) for r in toxicity.toxicity(df("documents"), df("labels")).collect() if r.held_out and r.doc_id in toxic]
    caught = sum(p for p, y in told if y)
    assert caught >= 0.3 * sum(y for _, y in told)
    assert sum(p for p, y in told if not y) <= 0.02 * sum(not y for _, y in told)


def test_classifiers_on_awkward_rows(spark, labels):
    for f in (quality.quality, toxicity.toxicity):
        got = f(docs_of(spark), labels).collect()
        assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % (4 if f is quality.quality else 3) == (2 if f is quality.quality else 1)) for r in got)
        assert f(docs_of(spark).limit(0), labels.limit(0)).count() == 0


def test_languages(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op7_language_ranks"](spark, str(SF)).collect()}
    told = [(got[i].lang_pred, r.lang) for i, r in documents.items() if got[i].held_out and r.lang and re.search(r"\w{3}", r.text or "")]
    assert np.mean([a == b for a, b in told]) > 0.9
    awkward = {r.doc_id: r for r in language.languages(docs_of(spark)).collect()}
    assert [awkward[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and awkward[1].score == 0
    assert language.languages(docs_of(spark).limit(0)).count() == 0


def test_rank_distance_by_hand():
    profiles = {"a": language.ranked("aaa aab"), "b": language.ranked("zzz")}
    name, score = language._predictions(profiles, language.RANKS)("aaa aab")
    assert name == "a" and score == 1.0


def test_language_model_base_scores(spark, documents):
    kept = {i: [*SPACED.findall((r.text or "").translate(LOWER)), None] for i, r in documents.items()}
    counts = Counter(w for i, ws in kept.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for r in QUERIES["op8_hidden_markov"](spark, str(SF)).collect():
        want = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in kept[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(kept[r.doc_id]), sum(counts[w] > 0 for w in kept[r.doc_id]), total)
        assert r.base_score == pytest.approx(want, rel=1e-9) and r.score < 0


def test_forward_recursion_against_all_paths():
    draw = np.random.default_rng(3)
    model = lm.Model(draw.dirichlet(np.ones(2)), draw.dirichlet(np.ones(2), 2), draw.dirichlet(np.ones(4), 2))
    seen = np.array([[0, 3, 3, 3], [2, 1, 0, 3]])
    packed = lm.Packed(np.array([1, 0]), np.array([0, 2, 4, 5, 6]), np.array([2, 0, 1, 3, 0, 3]))
    got = lm.forward(model, packed)
    for row, n, value in zip(seen, (2, 4), got):
        total = 0.0
        for path in np.ndindex(*(2,) * n):
            p = model.start[path[0]]
            for t in range(n):
                p *= model.emit[path[t], row[t]] * (model.move[path[t - 1], path[t]] if t else 1)
            total += p
        assert value == pytest.approx(math.log(total))
    sums = lm._zero(model)
    assert lm.expectations(model, packed, sums) == pytest.approx(got.sum())
    assert sums.start.sum() == pytest.approx(2) and sums.move.sum() == pytest.approx(4) and sums.emit.sum() == pytest.approx(6)


def test_expected_counts_against_all_paths():
    draw = np.random.default_rng(5)
    model = lm.Model(draw.dirichlet(np.ones(2)), draw.dirichlet(np.ones(2), 2), draw.dirichlet(np.ones(4), 2))
    row = (2, 1, 0, 3)
    want, total = lm._zero(model), 0.0
    for path in np.ndindex(2, 2, 2, 2):
        p = model.start[path[0]] * np.prod([model.emit[k, x] for k, x in zip(path, row)]) * np.prod([model.move[a, b] for a, b in zip(path, path[1:])])
        total += p
        want.start[path[0]] += p
        for a, b in zip(path, path[1:]):
            want.move[a, b] += p
        for k, x in zip(path, row):
            want.emit[k, x] += p
    (w,) = lm.tokens.words(pa.array(["x", None, "one two three"]))
    packed = lm._by_position(w, np.array([3, *row[:3]]), 3)
    assert packed.order.tolist() == [2, 0, 1] and packed.seen.tolist() == [2, 3, 3, 1, 3, 0, 3]
    got = lm._zero(model)
    lm.expectations(model, lm.Packed(np.array([0]), np.arange(5), np.array(row)), got)
    for name in ("start", "move", "emit"):
        assert np.allclose(getattr(got, name), getattr(want, name) / total)


def test_language_model_on_awkward_rows(spark):
    got = lm.language_model(docs_of(spark)).collect()
    assert len(got) == len(AWKWARD) and {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1} and all(math.isfinite(r.score) for r in got)
    assert lm.language_model(docs_of(spark).limit(0)).count() == 0


def test_embeddings_against_all_pairs(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(400, 16))
    every = np.concatenate([base, base[:60] + draw.normal(scale=0.05, size=(60, 16)), base[:20]])
    rows = [(i, v.tolist()) for i, v in enumerate(every)] + [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15)]
    unit = every / np.linalg.norm(every, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    of = groups(zip(*np.nonzero(near)), range(len(every)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "unit": F.lit(2)})
    got = {r.vec_id: r for r in neighbours.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    found = sum(got[i].n_links for i in range(len(every)))
    assert all(got[i].n_links <= near[i].sum() for i in range(len(every))) and found >= 0.95 * near.sum()
    assert np.mean([got[i].component_id == of[i] for i in range(len(every))]) >= 0.98
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 905))
    assert neighbours.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_apart_from_the_starts_and_across_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 100)
    draw = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    groups_, pairs = unit(draw.normal(size=(16, 64))), unit(draw.normal(size=(500, 64)))
    near = unit(np.repeat(groups_, 60, axis=0) + 0.02 * draw.normal(size=(960, 64)))  # more than a point's candidates
    other = unit(draw.normal(size=(500, 64)))
    other = unit(other - (other * pairs).sum(axis=1, keepdims=True) * pairs)
    x = np.concatenate([near, pairs, 0.956 * pairs + np.sqrt(1 - 0.956**2) * other])
    alike = (x @ x.T >= neighbours.COSINE) & ~np.eye(len(x), dtype=bool)
    rows = neighbours.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    got = np.zeros(len(x))
    for r in rows:
        got[r.vec_id] = r.n_links
    linked = alike.sum(axis=1)
    assert (got <= linked).all() and (got[linked > 0] / linked[linked > 0]).mean() >= 0.9
    assert all(r.component_id == 60 * (r.vec_id // 60) for r in rows if r.vec_id < 960)


def test_search_reaches_parts_of_a_graph_without_a_start():
    draw = np.random.default_rng(4)
    x = np.repeat(draw.normal(size=(30, 64)), 60, axis=0) + 0.02 * draw.normal(size=(1800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = neighbours.pruned(x)
    a, b = np.append(a, b), np.append(b, a)
    search = neighbours.Searcher(x, [np.unique(b[a == i]) for i in range(len(x))], neighbours.BEAM)
    assert all(len(search.near(x[60 * k], neighbours.COSINE)) == 60 for k in range(30))


def test_perspectives_give_the_dialogue(spark):
    turns = [(1, 1, "system", "Be kind"), (1, 2, "ann", "Hi"), (1, 3, "bob", None), (1, 3, "bob", None), (1, None, None, "late"), (None, 1, "ann", "x"), (2, 1, "system", "only")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("speaker", F.lit("clash"))
    got = chat.perspectives(df, block=2).collect()
    assert {(r.conv_id, r.speaker) for r in got} == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    own = sorted((r for r in got if (r.conv_id, r.speaker) == (1, "ann")), key=lambda r: r.position)
    whole = "".join(r.segment for r in own)
    assert whole == "<|system|>Be kind<|end|>\n<|assistant|>Hi<|end|>\n<|user name=bob|><|end|>\n<|user name=bob|><|end|>\n<|user name=unknown|>late<|end|>\n"
    assert all(whole[r.start : r.end] == r.segment for r in own)
    assert [whole[r.mask_start : r.mask_end] for r in own if r.train] == ["Hi<|end|>\n"]
    assert chat.perspectives(df.limit(0)).count() == 0


def test_main_text(spark):
    article = "".join(f"<p>Sentence number {i} of the article &amp; its   body.</p>" for i in range(5))
    page = f"<html><head><title>T</title><script>x</script></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>Blog</a></li></ul></nav><div class='ad'>Buy now.</div><article><h1>Head</h1>{article}</article><footer>&copy; us</footer></body></html>"
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<nav><a href='/'>Home</a></nav>" * 3), (5, "u", page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in html.main_texts(df).collect()}
    want = "Head " + " ".join(f"Sentence number {i} of the article & its body." for i in range(5))
    assert [got[i].text for i in (1, 2, 3, 4, 5)] == [want, "", "", "", want] and got[1].n_chars == len(want)


def test_pipeline_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, sf = docs, str(SF)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf)
        assert after.columns == docs.columns
        rows = {r.doc_id for r in after.select("doc_id").collect()}
        before = {r.doc_id: r.text for r in kept.collect()}
        assert rows <= set(before)
        if name == "near_duplicates":
            of, _ = brute_groups(before, corpus_pipeline.WORDS, corpus_pipeline.PERCENT)
            assert rows == {i for i in before if of[i] == i}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            hits = {i: brute_hits(t, items) for i, t in before.items()}
            assert rows == {i for i, (n, h, _) in hits.items() if not (h and 20 * h >= n)}
        kept = after.select("*").where(F.col("doc_id").isin([*rows]))
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()} <= rows
