"""Ordered folds against plain loops, with groups that go on over many batches."""

import random

import pytest
from pyspark.sql import functions as F

from tallyquill.operators import lines, rules
from tallyquill.operators.folds import folded


@pytest.fixture(params=[2, 10_000])
def batch_rows(spark, request):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(request.param))
    yield request.param
    spark.conf.set(name, before)


def attached(rows):
    """Each row's group by looking through all groups, the latest first."""
    groups, out = [], []
    for r in rows:
        above = r["path"][:-1] or r["path"]
        found = None
        for n in range(len(groups) - 1, -1, -1) if r["modifier"] else ():
            g = groups[n]
            free = g["role"] in ("included", "free")
            fits = g["above"] == above and g["product"] == r["product"] and (g["variant"] == r["variant"] or r["variant"] in ("online_domestic_cards", "domestic_cards", "standard"))
            if fits and (free or g["has_fee"]) and not (r["role"] in ("included", "free") and not free):
                found = n
                break
        if found is None:
            groups.append({"role": r["role"], "has_fee": r["has_fee"]})
            found = len(groups) - 1
        groups[found].update(above=above, product=r["product"], variant=r["variant"])
        out.append(found)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_attachment_is_that_of_a_search(seed):
    r = random.Random(seed)
    make = lambda: {"path": r.choice([["a"], ["a", "b"], ["a", "c"], ["x", "c"]]), "product": r.choice(["p", "q"]), "variant": r.choice(["standard", "v", "w", "domestic_cards"]), "modifier": r.random() < 0.6, "role": r.choice(["base", "maximum", "free", "included"]), "has_fee": r.random() < 0.6}
    rows = [make() for _ in range(300)]
    fold = rules.Attached()
    assert [fold(x)[0] for x in rows] == attached(rows)


class Running:
    def __init__(self):
        self.sum = 0

    def __call__(self, r):
        self.sum += r["v"] or 0
        return self.sum, None if r["v"] is None else str(r["v"])


def test_a_state_goes_on_over_batches(spark, batch_rows):
    r = random.Random(1)
    rows = [(r.choice(["a", "b", None]), i, r.choice([None, 1, 2])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, at int, v int").repartition(7)
    got = folded(df, ["k"], ["at"], {"v": F.col("v")}, Running, {"sum": "bigint", "told": "string"})
    want, sums = {}, {}
    for k, at, v in rows:
        sums[k] = sums.get(k, 0) + (v or 0)
        want[at] = (k, sums[k], None if v is None else str(v))
    assert {x.at: (x.k, x["sum"], x.told) for x in got.collect()} == want
    assert folded(df.limit(0), ["k"], ["at"], {"v": F.col("v")}, Running, {"sum": "bigint", "told": "string"}).count() == 0


def test_phrases_of_sections_over_batches(spark, batch_rows):
    bodies = ["1.5% + 20p\nfor domestic cards\nper charge\nSome prose\nif they are new", "Dispute fee\n$15\nper dispute", "for nothing\nno fee here", "Rates from\n2%", "", None, "Included\nwith 3 things\n5%\n\nof it"]
    df = spark.createDataFrame([(i % 5, "1%" if i == 3 else "Cards", b) for i, b in enumerate(bodies * 20)], "key int, heading string, body string")
    got = {}
    for x in lines.phrases(df, ["key"]).collect():
        got.setdefault(x.key, []).append(x.phrase)
    once = lambda b, h="Cards": [x.phrase for x in lines.phrases(spark.createDataFrame([(1, h, b)], "key int, heading string, body string"), ["key"]).orderBy("entry_no").collect()]
    told = {b: once(b) for b in bodies}
    assert told[bodies[0]] == ["1.5% + 20p for domestic cards per charge if they are new"] and told[bodies[1]] == ["Dispute fee $15 per dispute"] and told[bodies[3]] == ["Rates from 2%"] and told[bodies[2]] == told[None] == []
    want = {}
    for i, b in enumerate(bodies * 20):
        for p in once(b, "1%") if i == 3 else told[b]:
            want.setdefault(i % 5, []).append(p)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_lines_and_phrases_are_read_once(spark):
    """Each line goes to Python once to be read and once to be folded; a condition on a phrase doesn't read it again."""
    df = spark.createDataFrame([(1, "Cards", "5%\n\n Learn more \nfor new ones\nDispute fee\n$15"), (2, "2% each", None), (3, "", "\n"), (4, None, "free")], "key int, heading string, body string")
    own = lines.phrases(df, ["key"])
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("ArrowEvalPython"), plan.count("MapInArrow")) == (1, 1)
    assert sorted((r.key, r.entry_no, r.phrase, [t.kind for t in r.tokens]) for r in own.collect()) == [(1, 0, "5% for new ones", ["percentage"]), (1, 1, "Dispute fee $15", ["amount"]), (2, 0, "2% each", ["percentage"]), (4, 0, "free", ["qualifier"])]
