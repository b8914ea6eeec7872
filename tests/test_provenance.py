"""Containment with owners and the provenance of merged rules, against brute force and known rules."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyquill.operators import containment, identities, rules
from tallyquill.plans.queries import QUERIES
from tests.sameness import SF
from tests.test_rules import ENTRY, entry


def taken_up(groups):
    """(key, owner) and the keys of what each group ends up with, in order: first superset first, from the start after each."""
    left, owner, lists = [k for k, _ in groups], {}, {k: [k] for k, _ in groups}
    parts = {k: set(p) for k, p in groups}
    changed = True
    while changed:
        changed = False
        for a in left:
            b = next((b for b in left if b != a and parts[a] <= parts[b]), None)
            if b is not None:
                owner[a] = b
                lists[b] = lists[b] + lists[a]
                left.remove(a)
                changed = True
                break
    return owner, {k: lists[k] for k in left}


@pytest.mark.parametrize("seed", range(4))
def test_owners_are_those_of_one_by_one(spark, seed):
    r = random.Random(seed)
    groups = [(f"k{i:03d}", r.sample("abcdef"[: 2 + seed], k=r.randrange(0, 2 + seed))) for i in range(60)]
    df = spark.createDataFrame([("x", k, p) for k, p in groups] + [("y", k, p) for k, p in groups[:7]], "s string, key string, parts array<string>").withColumn("_sel", containment.selected(["s"]))
    found = containment.owners(df, "key", "parts")
    for s, own in (("x", groups), ("y", groups[:7])):
        owner, lists = taken_up(own)
        here = F.get_json_object("_sel", "$.s") == s
        assert {x.key: x.owner for x in found.where(here).collect()} == owner
        ends = containment.followed(found, "key").where(here).collect()
        for root, members in lists.items():
            assert [root, *(x.key for x in sorted((x for x in ends if x.root == root), key=lambda x: x.path))] == members


def test_a_chain_of_any_length_is_followed(spark):
    df = spark.createDataFrame([("s", f"k{i:03d}", [f"p{j}" for j in range(i)]) for i in range(40)] + [("s", None, None)], "_sel string, key string, parts array<string>").where("key is not null")
    ends = containment.followed(containment.owners(df, "key", "parts"), "key").collect()
    assert {x.root for x in ends} == {"k039"} and {len(x.path) for x in ends} == set(range(1, 40))
    assert containment.owners(df.limit(0), "key", "parts").count() == 0


@pytest.mark.parametrize("n_parts", [9, 150])
def test_a_selector_that_a_task_holds_asks_no_index(spark, monkeypatch, n_parts):
    """Selectors within a task, at its limit and beyond it have the owners, ways and ends that the index finds."""
    r = random.Random(n_parts)
    rows = [(f"s{i % 40}", f"k{i:04d}", r.choices([f"p{j}" for j in range(n_parts)], k=r.randrange(5)) if i % 9 else [f"p{j}" for j in range(n_parts)][: i % 5] + [None]) for i in range(700)]
    df = spark.createDataFrame([*rows, ("alone", "k", ["p1"])], "_sel string, key string, parts array<string>").repartition(5)
    told = lambda: sorted(map(tuple, containment.followed(containment.owners(df, "key", "parts"), "key").join(containment.owners(df, "key", "parts"), ["_sel", "key"]).collect()))
    with monkeypatch.context() as m:
        m.setattr(containment, "contained", lambda _: pytest.fail("the index is asked"))
        own = told()
    for group, paths in ((0, 0), (17, 5)):
        with monkeypatch.context() as m:
            m.setattr(containment, "GROUP", group)
            m.setattr(containment, "PATHS", paths)
            assert told() == own
    assert own


def test_absorbed_subsets_ask_no_index_and_read_their_groups_once(spark, monkeypatch):
    monkeypatch.setattr(containment, "contained", lambda _: pytest.fail("the index is asked"))
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("s", 1, ["a"]), ("s", 2, ["a", "b"]), ("s", 3, None), ("t", 4, ["a"]), ("t", 5, ["a", None]), (None, 6, ["c"]), (None, 7, ["c", "d"])], "s string, k long, parts array<string>")
    got = identities.absorbed_subsets(df.mapInArrow(counted, df.schema), ["s"], "k", "parts").collect()
    assert sorted(r.k for r in got) == [2, 5, 7] and seen.value == 7


def test_selectors_go_on_over_batches(spark):
    """Runs of a selector over many batches, and sets more than a task's table of comparisons has rows for."""
    name, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.range(600).selectExpr("cast(id % 3 as string) _sel", "id key", "transform(sequence(0, 5), x -> cast(id * id % 7 * x % 5 as string)) parts")
    own = sorted(map(tuple, containment.owners(df, "key", "parts").collect()))
    try:
        spark.conf.set(name, "7")
        assert sorted(map(tuple, containment.owners(df, "key", "parts").collect())) == own and own
    finally:
        spark.conf.set(name, before)


def test_a_large_selector_is_compared_block_by_block(monkeypatch):
    r = random.Random(2)
    masks = containment._masks(np.repeat(np.arange(300), 3), np.array([r.randrange(12) * 6 for _ in range(900)]), 300, 70)
    own = containment._taken_up(masks)
    monkeypatch.setattr(containment, "CELLS", 300 * 7)
    assert containment._taken_up(masks).tolist() == own.tolist() and (own >= 0).any()


def test_parts_of_a_fee_go_to_what_holds_them(spark):
    """A base row that is repeated without its cap is no conflict, and says where it came from."""
    base = "ACH Direct Debit 0.8% + $0.30"
    rows = [entry(0, base, ("Payment methods", "ACH Direct Debit")), entry(1, base, ("Payment methods", "ACH Direct Debit")), entry(2, "ACH Direct Debit $5.00 cap", ("Payment methods", "ACH Direct Debit"))]
    found, _ = rules.classified(spark.createDataFrame(rows, ENTRY))
    own = identities.deduplicated_rules(found, ["url"]).collect()
    assert [(r.status, r.percentage, r.fixed_amount, r.maximum_amount, r.entry_ids) for r in own] == [("calculable_rule", "0.8", "0.30", "5.00", ["e01", "e02", "e00"])]
    assert own[0].source_texts == [base, "ACH Direct Debit $5.00 cap"] and [(x.entry_id, x.text) for x in own[0].fragments] == [("e01", base), ("e02", "ACH Direct Debit $5.00 cap")]
    assert len(own[0].rule_ids) == 2 and own[0].evidence_ids == ["e01", "e02", "e00"]


def test_three_fees_of_one_identity(spark):
    """What lies within a fee goes to it alone; what differs stays apart; unspecified ones are one row without a fee."""
    part = lambda v, k="percentage": (k, v, None, "EUR", None, None, None)
    fee = {"r1": [part("1")], "r2": [part("1"), part("5", "maximum_fee")], "r3": [part("7")]}
    schema = (
        "url string, product_id string, variant_id string, entry_id string, rule_id string, entry_ids array<string>, fee_components array<struct<type:string,value:string,amount:string,currency:string,basis_points:string,operator:string,minor_amount:string>>,"
        "conditions array<struct<dimension:string,operator:string,value:string>>, unit string, exactness string, behavior string, status string, confidence double, fee_evidence struct<type:string,confidence:double>, source_texts array<string>,"
        "fragments array<struct<entry_id:string,text:string>>, phrases array<string>, evidence_ids array<string>, notes array<string>, percentage string"
    )
    for product in ("payments", "unspecified"):
        rows = [("u", product, None, e, r, [e], fee[r], [], "per_charge", "exact", "conditional", "calculable_rule", 0.8, ("explicit", 0.8), ["t" + e], [(e, "t" + e)], [], [e], ["n"], "1") for r, e in (("r1", "e1"), ("r2", "e2"), ("r3", "e3"))]
        got = sorted(identities.deduplicated_rules(spark.createDataFrame(rows, schema), ["url"]).collect(), key=lambda r: r.entry_id)
        if product == "payments":
            assert [(r.status, r.entry_ids, r.source_texts, r.rule_ids) for r in got] == [("conflict", ["e2", "e1"], ["te2", "te1"], ["r2", "r1"]), ("conflict", ["e3"], ["te3"], ["r3"])]
            assert all(r.notes == ["n", identities.CONFLICT_NOTE] and r.confidence == 0 for r in got)
        else:
            (one,) = got
            assert (one.status, one.percentage, one.fee_components, one.unit, one.behavior, one.is_candidate) == ("informational", None, [], "informational", "informational", False)
            assert one.entry_ids == ["e2", "e1", "e3"] and one.rule_ids == ["r2", "r1", "r3"] and one.rule_id not in ("r1", "r2", "r3")


@pytest.mark.parametrize("name", ["h19_h22_entries", "a01_a11_market_fees", "a03_a05_rule_provenance", "j13_containment_owners"])
def test_rows_as_many_as_the_data_are_not_broadcast(spark, name):
    plan = QUERIES[name](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_items_carry_numbers_in_place_of_keys_and_paths(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(identities, "put_together", lambda items, by, kinds: seen.append((by, items.schema)) or containment.put_together(items, by, kinds))
    QUERIES["a03_a05_rule_provenance"](spark, str(SF))
    ((by, schema),) = seen
    assert [schema[c].dataType.simpleString() for c in by] == ["string", "int"]
    assert [f.dataType.simpleString() for f in schema["place"].dataType] == ["int", "string", "string", "int"]


def test_items_are_not_shuffled(spark):
    """What rules are told of is many times their rows: it's put together where the rules lie."""
    plan = QUERIES["a03_a05_rule_provenance"](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Generate")] and plan.count("Exchange") == 3


def test_identities_beyond_a_task_have_the_same_rules(spark, monkeypatch):
    told = lambda: sorted(map(str, QUERIES["a03_a05_rule_provenance"](spark, str(SF)).collect()))
    own = told()
    monkeypatch.setattr(containment, "GROUP", 20)
    monkeypatch.setattr(containment, "PATHS", 5)
    assert told() == own
