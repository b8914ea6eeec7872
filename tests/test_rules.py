"""Fee entries to rules, order with ties, publication and its crash, on small rows whose results are known."""

import pytest
from pyspark.sql import functions as F

from tallyquill.functions import money
from tallyquill.operators import checks, identities, lines, order, pages, rules, snapshots
from tallyquill.sources import files, publish

ENTRY = "url string, source_order int, entry_id string, section_path array<string>, fee_category string, source_text string, source_evidence string, payment_method string, channel string, account_country string"


def entry(n, text, path=("Payments", "Cards"), evidence="", url="u", country="US"):
    return (url, n, f"e{n:02d}", list(path), None, text, evidence, None, None, country)


def test_forms_of_amounts():
    found = lambda t: [(x["number"], x["unit"]) for x in money.found_amounts(t)]
    assert found("$1.50 and 2 €, EUR 3 or 4 USD, 20p") == [("1.50", "$"), ("2", "€"), ("3", "EUR"), ("4", "USD"), ("20", "p")]
    assert found("US$ 5") == [] and found("$1 billion") == [] and found("P24") == []
    assert found("EUR 1.2.34 €7") == [("7", "€")]  # what is no number takes no place from what is one
    assert found("A$5") == [("5", "A$")] and found("10 000 €") == [("10 000", "€")]


def test_entries_become_rules(spark):
    rows = [
        entry(0, "2.9% + $0.30 per successful charge for domestic cards"), entry(1, "$5.00 cap"), entry(2, "Included"), entry(3, "Over 250 million API requests"), entry(4, "Contact sales"),
        entry(5, "$59 reader", ("Terminal",)), entry(6, "1.5% for international cards"), entry(7, None),
    ]
    found, left = rules.classified(spark.createDataFrame(rows, ENTRY))
    got = {r.entry_id: r for r in found.collect()}
    first = got["e00"]
    assert (first.product_id, first.variant_id, first.status, first.percentage, first.fixed_amount, first.maximum_amount) == ("payments", "online_domestic_cards", "calculable_rule", "2.9", "0.30", "5.00")
    assert first.entry_ids == ["e00", "e01"] and first.confidence == 0.85 and first.unit == "per_charge" and first.channel == "online"
    assert got["e02"].status == "included" and got["e02"].unit == "informational"
    assert got["e06"].variant_id == "online_international_cards" and {c.dimension: c.value for c in got["e06"].conditions}["card_region"] == "international"
    assert {r.entry_id: r.status for r in left.collect()} == {"e03": "ignored_non_fee", "e04": "custom_pricing", "e05": "informational"}
    assert got["e07"].status == "non_calculable" and got["e07"].label == ""


def test_rules_of_one_identity(spark):
    same = "2.9% + $0.30 per successful charge for domestic cards"
    rows = [entry(0, same), entry(1, same), entry(2, "1% per charge for domestic cards", url="v"), entry(3, "3% per charge for domestic cards", url="v")]
    every = spark.createDataFrame(rows, ENTRY)
    found, left = rules.classified(every)
    got = {(r.url, tuple(r.entry_ids)): r.status for r in identities.deduplicated_rules(found, ["url"]).collect()}
    assert got == {("u", ("e00", "e01")): "calculable_rule", ("v", ("e02",)): "conflict", ("v", ("e03",)): "conflict"}
    counted = identities.counters(every.select("url", "entry_id", F.lit(True).alias("has_fee")), identities.deduplicated_rules(found, ["url"]), left, ["url"])
    assert {r.url: (r.source_entries, r.dropped_numeric_entries, r.calculable_rules, r.blocking_fee_conflicts) for r in counted.collect()} == {"u": (2, 0, 1, 0), "v": (2, 0, 0, 2)}
    assert identities.summed(counted, ["url"]).first().source_entries == 4


def test_modifiers_take_from_their_base():
    row = lambda **x: {"path": ["a", "b"], "product": "payments", "variant": "standard", "modifier": False, "role": "base", "has_fee": True} | x
    along = lambda fold, own: [fold(r) for r in own]
    assert [n for (n,) in along(rules.Attached(), [row(), row(modifier=True, role="maximum"), row(path=["a", "c"]), row(modifier=True, role="included"), row(path=["z", "b"], modifier=True)])] == [0, 0, 1, 2, 3]
    seen = lambda **x: {"path": ["a"], "product": "ideal", "method": None, "region": None, "tier": None, "modifier": False, "role": "base"} | x
    got = along(rules.Inherited(), [seen(method="ideal", region="eea", tier="premium"), seen(product="unspecified", modifier=True, role="maximum"), seen(), seen(path=["b"])])
    assert [g[0] for g in got] == ["ideal", "ideal", "ideal", "ideal"]
    assert [g[1:] for g in got] == [("ideal", "eea", "premium"), ("ideal", "eea", "premium"), ("ideal", "eea", None), (None, None, None)]


def test_order_with_ties(spark):
    rows = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 2, "c"), ("k", None, "d")], "key string, at int, v string")
    for n in (1, 3):
        shuffled = rows.repartition(n)
        assert order.first_per_key(shuffled, ["key"], [F.col("at").desc()]).first().v == "c"
        assert [r.v for r in order.later_duplicates(shuffled.where("at = 1"), ["key"], ["at"]).collect()] == ["b"]
        got = {r.v: r.source_order for r in order.renumbered(shuffled, ["key"], [F.col("at").asc_nulls_first()]).collect()}
        assert got == {"d": 0, "a": 1, "b": 2, "c": 3}
        parted = order.renumbered(shuffled.where("at is not null"), ["key"], ["at"], parts=4)
        assert {r.v: r.source_order for r in parted.collect()} == {"a": 0, "b": 1, "c": 2}
    sets = spark.createDataFrame([("s", 1, ["a"]), ("s", 2, ["a", "b"]), ("s", 3, ["b", "a"]), ("s", 4, ["c"])], "sel string, id int, parts array<string>")
    assert {r.id for r in identities.absorbed_subsets(sets, ["sel"], "id", "parts").collect()} == {3, 4}


def test_counts_that_drop(spark):
    of = lambda *rows: spark.createDataFrame(rows, "country string, n_sections long, n_entries long, n_rules long, status string")
    old, new = of(("A", 10, 10, 4, "complete"), ("B", 10, 10, 4, "partial"), ("C", 0, 0, 0, "complete")), of(("A", 4, 5, 0, "unclassified"), ("B", 10, 4, 1, "partial"), ("C", 1, 1, 1, "complete"))
    assert {(r.kind, r.country) for r in snapshots.market_counts(old, new).collect()} == {
        ("sharp_section_drop", "A"), ("lost_core_category", "A"), ("classified_to_unclassified", "A"), ("sharp_entry_drop", "B"), ("sharp_rule_drop", "B"),
    }


def test_publication_survives_a_crash(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "site")
    one, two = spark.range(2), spark.range(3)
    assert publish.publish({"t": one}, root)["changed"] and publish.current(spark, root)["number"] == 1
    with monkeypatch.context() as m:
        m.setattr(publish, "write_document", lambda *a: (_ for _ in ()).throw(OSError("no more disk")))
        with pytest.raises(OSError):
            publish.publish({"t": two}, root)
    (tmp_path / "site" / "manifests" / "_staged-x").write_text("{")
    now = publish.current(spark, root)
    assert now["number"] == 1 and spark.read.parquet(f"{root}/{now['tables']['t']['path']}").count() == 2
    assert not publish.publish({"t": one}, root)["changed"]
    assert publish.publish({"t": two}, root, documents={"report": {"b": 1, "a": None}})["manifest"]["number"] == 2
    with pytest.raises(FileExistsError):  # another writer took the number
        publish.write_document(spark, f"{root}/manifests/m-000000000002.json", {})
    assert publish.current(spark, root)["schemas"]["t"]["fields"][0]["name"] == "id"


def test_pages_that_are_none(spark):
    rows = [(429, "", ""), (503, "", ""), (403, "", ""), (404, "", ""), (200, "Security check", "<form id='captcha'>"), (200, "Sign in", "<form action='/login'><input type='password'>"), (200, "Pricing", "Standard pricing")]
    got = [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s int, t string, p string").orderBy("i").select(pages.blocked("s", "t", "p")).collect()]
    assert got == ["rate_limited", "server_error", "login", "client_error", "challenge", "login", None]


def test_cached_requests_are_counted(spark):
    asked = spark.createDataFrame([("get", "http://a/p", "DE", "en-de"), ("get", "http://a/q", "DE", "en-de")], "method string, url string, market string, locale string")
    kept = files.kept_responses(asked.limit(1).select("*", F.lit(200).alias("status"), F.create_map(F.lit("content-length"), F.lit("3")).alias("headers"), F.lit("abc").alias("content"), F.lit(100.0).alias("fetched_at")))
    assert tuple(files.cache_counters(files.cached(asked, kept, 110.0, 60)).first()) == (1, 1, 3)


def test_errors_are_named(spark):
    assert checks.schema_errors(spark.range(1), {"id": "bigint", "v": "string"}) == ["v: missing, not string"]
    counts = spark.createDataFrame([("rules", 3)], "metric string, value long")
    assert [r.metric for r in checks.metric_errors(counts, spark.createDataFrame([("rules", 4)], "metric string, value long")).collect()] == ["rules"]
    with pytest.raises(ValueError, match="A: x"):
        checks.every_error(spark.createDataFrame([("A", "x")], "country string, error string"), strict=True)
    own = lines.Phrases()
    assert [*own.step("Dispute fee", "label"), *own.step("$15", "fee"), *own.step("per charge", "qualifier"), *own.rest()] == ["Dispute fee $15 per charge"]


def test_rows_of_one_file_are_dealt_before_long_work(spark):
    own = spark.createDataFrame([entry(i, "2.9% + $0.30") for i in range(40)], ENTRY).coalesce(1)
    assert rules.described(own).select("entry_id").rdd.getNumPartitions() > 1
    left = rules.classified(own)[1]
    assert left.where("status = 'ignored_non_fee'").select("entry_id").rdd.getNumPartitions() > 1
