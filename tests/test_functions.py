"""Expressions and operators on small rows whose results are known."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyquill import tables
from tallyquill.functions import money, text, web
from tallyquill.operators import identities, lines, pages, snapshots
from tallyquill.plans.oracle import SQL
from tallyquill.plans.queries import QUERIES
from tallyquill.sources import files, publish
from tests.sameness import same


def values(spark, column, items, of="x string"):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, {of}").orderBy("i").select(column).collect()]


def test_decimals(spark):
    given = {"1,5": "1.5", "1.000,50": "1000.50", "1,000.50": "1000.50", "1.000": "1000", "0.30": "0.30", "1.2345": "12345", "12": "12", "x": None, "1 000": "1000", "": None, None: None, "1.2.3": None}
    assert values(spark, money.decimal_text("x"), given) == list(given.values())


def test_points_and_minor_units(spark):
    assert values(spark, money.basis_points("x"), ["1.5", "2", "3.25", None, "x"]) == ["150.0", "200", "325.00", None, None]
    rows = spark.createDataFrame([("1234", "JPY"), ("0.250", "BHD"), ("0.25", "EUR"), ("0.259", "EUR"), ("x", "EUR")], "a string, c string")
    assert [r[0] for r in rows.select(money.minor_amount("a", "c")).collect()] == ["1234", "250", "25", "25", None]


@pytest.mark.parametrize(
    "phrase, percentage, amount, currency, exactness",
    [
        ("1,5% + 0,25 €", "1.5", "0.25", "EUR", "exact"),
        ("Starting at 2.99% + $0.35", "2.99", "0.35", "USD", "from"),
        ("+ 2% if currency conversion is required", "2", None, None, "exact"),
        ("20p per charge", None, "0.20", "GBP", "exact"),
        ("over $1 billion moved", None, None, None, "exact"),
        ("Included", None, None, None, "included"),
        ("A$5 cap, maximum 3 %", "3", "5", "AUD", "range"),
        (None, None, None, None, "exact"),
    ],
)
def test_phrases(spark, phrase, percentage, amount, currency, exactness):
    assert tuple(values(spark, money.parsed("x"), [phrase])[0]) == (percentage, amount, currency, exactness)


def test_names_and_identifiers(spark):
    assert values(spark, text.method_id("x"), ["iDEAL | Wero"]) == ["ideal_wero"]
    assert values(spark, text.country("x"), [" de ", "deu", None]) == ["DE", None, None]
    assert values(spark, text.stable_id(F.col("x"), F.lit("Standard ")), ["Payments"]) == ["0e9f1da87a65b55d"]
    assert values(spark, text.deduplicated("x"), ["a b a b c", "a a", "x y z x y z", None]) == ["a b c", "a a", "x y z", None]
    assert values(spark, text.earliest_method("x"), ["pay by cards or iDEAL", "none", None]) == ["card", None, None]


def test_addresses(spark):
    given = ["HTTPS://A.Example.com/X?b=2&utm_source=q&a=1#f", "http://h/p"]
    assert values(spark, web.normalized("x"), given) == ["https://a.example.com/X?a=1&b=2", "http://h/p"]
    assert values(spark, web.redacted("x"), ["http://h/p?Token=s&a=1;x", "http://h/p"]) == ["http://h/p?Token=<redacted>&a=1&x", "http://h/p"]
    assert values(spark, web.host_allowed("x", ["example.com"]), ["https://a.example.com/", "https://example.com.evil.org/", None]) == [True, False, False]
    assert values(spark, web.country_of_path("x"), ["/en-de/pricing", "/gb", "/pricing", "/in/pricing/local-payment-methods"]) == ["DE", "GB", None, "IN"]
    assert values(spark, web.country_of_locale("x"), ["en-gb", "fr", "de", None]) == ["GB", "FR", None, None]


def test_sections_follow_the_headings(spark):
    page = "<h1>Fees</h1><p>Intro</p><h2>Cards</h2><p>1.5% + 0.25 €<br>for domestic cards</p><script>x()</script><h3>In &amp; out</h3><a href='/a'>More</a><h2>Other</h2>"
    rows = pages.sections(spark.createDataFrame([(1, "https://h/p/", page), (2, None, None)], "page_id int, url string, html string")).orderBy("source_order").collect()
    assert [r.section_path for r in rows] == [["Fees"], ["Fees", "Cards"], ["Fees", "Cards", "In & out"], ["Fees", "Other"]]
    assert rows[1].body == "1.5% + 0.25 €\nfor domestic cards" and rows[2].links[0].uri == "https://h/a"


def test_lines_join_their_fee(spark):
    body = "Dispute fee\n15.00 €\nper dispute\n35% share of online payments\nfor whom\nFrom\n2%\nNo digits here"
    rows = lines.phrases(spark.createDataFrame([(1, "Cards", body), (2, None, None)], "id int, heading string, body string"), ["id"]).orderBy("entry_no").collect()
    assert [r.phrase for r in rows] == ["Dispute fee 15.00 € per dispute for whom", "35% share of online payments", "From 2%"]


def test_identities(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x", "calculable_rule"), ("a", 2, "x", "calculable_rule"), ("a", 3, "y", "informational"), ("b", 4, "x", "calculable_rule"), ("b", 5, "y", "calculable_rule"), ("c", 6, "x", "informational"), ("c", 7, "y", "informational")],
        "s string, e int, signature string, status string",
    ).withColumn("confidence", F.lit(0.9))
    groups = identities.merged(rows, ["s"], "signature", "e", "status", "e").withColumn("is_candidate", F.col("status") == "calculable_rule")
    got = {(r.s, r.first_at): (r.status, r.confidence, r.entry_ids) for r in identities.resolved(groups, ["s"]).collect()}
    assert got == {("a", 1): ("calculable_rule", 0.9, [1, 2, 3]), ("b", 4): ("conflict", 0.0, [4]), ("b", 5): ("conflict", 0.0, [5]), ("c", 6): ("informational", 0.9, [6, 7])}


def test_identities_of_one_place_stay_apart(spark):
    rows = spark.createDataFrame([("a", 1, "x", 1), ("a", 1, "y", 2), ("a", 5, "y", 3)], "s string, at int, signature string, e int").withColumns({"confidence": F.lit(0.9), "status": F.lit("calculable_rule")})
    groups = identities.merged(rows, ["s"], "signature", "at", "status", "e").withColumn("is_candidate", F.lit(True))
    assert sorted(r.entry_ids for r in identities.resolved(groups, ["s"]).collect()) == [[1], [2, 3]]


def test_lines_of_one_order_and_number_as_sql_has_them(spark, tmp_path):
    line = "l_partkey long, l_returnflag string, l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_linestatus string"
    rows = [(1, "A", 10, 1, 30.0, 0.05, 0.02, "O"), (1, "A", 10, 1, 30.0, 0.07, 0.04, "O"), (1, "A", 11, 2, 30.0, 0.07, 0.04, "O"), (2, "A", 10, 1, 9.0, 0.05, 0.02, "O"), (2, "A", 10, 1, 8.0, 0.05, 0.02, "O")]
    spark.createDataFrame(rows, line).write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    same(QUERIES["a01_a05_identities"](spark, str(tmp_path)), SQL["a01_a05_identities"], con)


def test_snapshots(spark):
    rule = "country string, rule_id string, percentage string, fixed_amount string, fixed_currency string, at int"
    old = spark.createDataFrame([("DE", "r", "2.9", "0.30", "EUR", 1), ("DE", "z", "0", None, None, 2)], rule)
    new = spark.createDataFrame([("DE", "r", "10.0", "0.30", "USD", 1), ("DE", "z", "1", None, None, 2)], rule)
    assert sorted(r.kind for r in snapshots.rule_values(old, new).collect()) == ["currency_changed", "large_percentage_change", "large_percentage_change"]
    assert snapshots.rule_values(old, old).isEmpty()


def test_publication_is_one_swap(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    one = {"rules": spark.range(10), "markets": spark.range(3)}
    assert publish.publish(one, root)["changed"]
    kept = publish.current(spark, root)
    assert not publish.publish(one, root)["changed"] and publish.current(spark, root) == kept
    with pytest.raises(ValueError, match="bad"):
        publish.publish({"rules": spark.range(11), "markets": spark.range(3)}, root, check=lambda _: ["bad"])
    assert publish.current(spark, root) == kept
    assert publish.publish({"rules": spark.range(11), "markets": spark.range(3)}, root)["changed"]
    assert spark.read.parquet(f"{root}/{publish.current(spark, root)['tables']['rules']['path']}").count() == 11


def test_cache_and_seed(spark):
    requests = spark.createDataFrame([("GET", "http://h/p?utm_source=x", "DE", "de"), ("GET", "http://h/q", "DE", "de")], "method string, url string, market string, locale string")
    key = requests.select(web.cache_key("method", F.lit("http://h/p"), "market", "locale")).first()[0]
    cache = spark.createDataFrame([(key, b"x", 1000.0, 200)], "key string, content binary, fetched_at double, status int")
    assert [r.hit for r in files.cached(requests, cache, 1500.0, 600).orderBy("url").collect()] == [True, False]
    assert not files.cached(requests, cache, 2500.0, 600).where("hit").count()
    assert files.discovered_or_seed(files.seed_markets(spark).limit(0)).count() == len(tables.SEED_MARKETS)


def test_python_holds_a_few_rows_of_a_batch():
    import pyarrow as pa

    held = []
    got = text.sliced([pa.array(["a", None, "b"] * 100)], lambda own: held.append(len(own)) or own, pa.string(), rows=64)
    assert got.to_pylist() == ["a", None, "b"] * 100 and max(held) == 64
    assert text.sliced([pa.array([], pa.string())], lambda own: own, pa.string()).to_pylist() == []


def test_a_leading_method_is_looked_for_at_the_front_alone(spark):
    got = values(spark, text.earliest_method("x", within=1), ["Pay iDEAL", "iDEAL or card", "pay by card", "a card", " card", None])
    assert got == ["ideal", "ideal", None, "card", "card", None]
    assert "(.*?)" not in str(text.earliest_method("x", within=1))
