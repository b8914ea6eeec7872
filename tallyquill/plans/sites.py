"""Queries over responses, pages of local methods, markets and publications, with the SQL of each that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill import tables
from tallyquill.functions import web
from tallyquill.operators import checks, lines, pages, snapshots
from tallyquill.plans.registry import query
from tallyquill.sources import files
from tallyquill.sources.files import table

SQL: dict[str, str] = {}


def _pick(words: list, n: Column) -> Column:
    return F.get(F.array(*map(F.lit, words)), n.cast("int"))


def _list(words: list) -> str:
    return "[" + ", ".join("NULL" if w is None else str(w) if isinstance(w, int) else f"'{w}'" for w in words) + "]"


_STATUS, _MARKET, _LOCALE = [200, 200, 404, 500], ["DE", "FR", ""], ["en-de", "fr", "en-fr"]


@query
def s11_s12_responses(spark, sf):
    n = F.col("event_id")
    own = table(spark, sf, "events").select("event_id", _pick(_STATUS, n % 4).alias("status"), F.when(n % 3 > 0, (n % 7).cast("string")).alias("told"), (n % 5).alias("length"), _pick(_MARKET, n % 3).alias("m"), _pick(_LOCALE, n / 2 % 3).alias("l"))
    return own.select("event_id", web.cacheable("status", F.col("told"), F.col("length")).alias("cacheable"), web.market_matches("m", F.lit("de"), "l", F.lit("en-de")).alias("matches"))


SQL["s11_s12_responses"] = f"""SELECT event_id, {_list(_STATUS)}[event_id % 4 + 1] = 200 AND (event_id % 3 = 0 OR event_id % 7 = event_id % 5) AS cacheable,
    m = '' OR (m = 'DE' AND (NOT contains(l, '-') OR split_part(l, '-', 2) = 'de')) AS matches FROM (SELECT event_id, {_list(_MARKET)}[event_id % 3 + 1] AS m, {_list(_LOCALE)}[event_id // 2 % 3 + 1] AS l FROM events)"""


@query
def s15_seed_markets(spark, sf):
    """The nations that were discovered beyond some key; where there are any, the seed relation doesn't count."""
    found = table(spark, sf, "nation").where("n_nationkey > 4").select(F.substring("n_name", 1, 2).alias("country"), F.lit("fr").alias("language"), F.col("n_name").alias("name"))
    return files.discovered_or_seed(files.built_markets(found, "https://x.com/")).select("country", "name", "locale")


SQL["s15_seed_markets"] = "SELECT upper(substr(n_name, 1, 2)) AS country, n_name AS name, 'fr-' || lower(substr(n_name, 1, 2)) AS locale FROM nation WHERE n_nationkey > 4"


@query
def s19_confirmed_markets(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    tests = o.select(
        F.col("o_custkey").cast("string").alias("country"), F.when(k % 2 == 0, "pricing").otherwise("methods").alias("kind"), _pick(_STATUS, k / 2 % 4).alias("status"), (F.col("o_orderstatus") == "P").alias("failed"),
        F.when(k % 5 == 0, "XX").alias("served"), (k % 10 == 0).alias("redirected"), (F.col("o_totalprice") > 150000).alias("is_pricing"),
    )
    return files.confirmed(tests)


SQL["s19_confirmed_markets"] = f"""WITH t AS (SELECT o_custkey::VARCHAR AS country, o_orderkey % 2 = 0 AS main, {_list(_STATUS)}[o_orderkey // 2 % 4 + 1] AS status, o_orderstatus = 'P' AS failed, o_orderkey % 5 = 0 AS other, o_orderkey % 10 = 0 AS redirected, o_totalprice > 150000 AS price FROM orders)
    SELECT country, CASE WHEN bool_or(main AND price AND NOT other AND NOT failed) THEN 'ok' WHEN bool_or(other AND redirected AND NOT failed) THEN 'unsupported' WHEN bool_or((failed AND status <> 404) OR (other AND NOT redirected AND NOT failed)) THEN 'transient' ELSE 'unsupported' END AS outcome
    FROM t GROUP BY country"""


@query
def s20_built_markets(spark, sf):
    own = table(spark, sf, "nation").select(F.substring("n_name", 1, 2).alias("country"), F.when(F.col("n_regionkey") > 1, "fr").alias("language"), F.col("n_name").alias("name"))
    return files.built_markets(own, "https://x.com/")


SQL["s20_built_markets"] = f"""SELECT upper(c) AS country, n_name AS name, l || '-' || c AS locale, m AS market, 'https://x.com/' || m AS url, cur AS currency FROM (SELECT *, CASE WHEN c IN ({_list(tables.DIRECT_MARKETS)[1:-1]}) THEN c ELSE l || '-' || c END AS m,
      map {{{', '.join(f"'{k}': '{v}'" for k, v in tables.CURRENCY_BY_COUNTRY.items())}}}[upper(c)] AS cur FROM (SELECT n_name, lower(substr(n_name, 1, 2)) AS c, CASE WHEN n_regionkey > 1 THEN 'fr' ELSE 'en' END AS l FROM nation))"""

_SUMS = ["US$ 5", "A$ 5", "x€ 3", "AED 7 or INR 5", "IDR 3.000", "none", "BRL 4"]


@query
def h14_h16_price_pages(spark, sf):
    k = F.col("p_partkey")
    page = F.concat(F.lit("<html><body>"), _pick(["Standard Pricing", "nothing", "Fees per transaction"], k % 3), F.lit("</body></html>"))
    url = F.concat(F.lit("https://x.com/"), _pick(["en-de/pricing", "pricing", "fr/pricing/all"], k / 3 % 3))
    is_page = pages.is_price_page(_pick(_STATUS, k % 4), F.lit("text/html; charset=utf-8"), url, page, _pick(["en-DE", "en_us", "fr"], k / 9 % 3))
    return table(spark, sf, "part").select("p_partkey", pages.first_currency(_pick(_SUMS, k % 7)).alias("currency"), pages.has_prices(page).alias("has_prices"), is_page.alias("is_page"))


SQL["h14_h16_price_pages"] = f"""SELECT p_partkey, ['USD', 'USD', 'EUR', 'AED', 'IDR', NULL, 'BRL'][p_partkey % 7 + 1] AS currency, p_partkey % 3 <> 1 AS has_prices,
    p_partkey % 3 <> 1 AND {_list(_STATUS)}[p_partkey % 4 + 1] = 200 AND ['de', 'us', 'fr'][p_partkey // 3 % 3 + 1] = ['de', 'us', 'fr'][p_partkey // 9 % 3 + 1] AS is_page FROM part"""

_CARD = (
    '<h2>Wallets</h2><div data-js-controller="LocalPaymentMethodsPricingCard"><h4>', '</h4><section class="PricingGridPrice"><span class="PricingGridPrice__caption">Domestic</span> <strong class="PricingGridPrice__amount">1.5%</strong>'
    ' <span class="PricingGridPrice__label">per charge</span><div class="PricingGridSubprice">+ 1% abroad</div></section><p>More text</p></div>',
)


@query
def h03_h05_cards(spark, sf):
    own = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("page_id"), F.lit("https://x.com/").alias("url"), F.concat(F.lit(_CARD[0]), "s_name", F.lit(_CARD[1])).alias("html"), F.lit("local-payment-methods").alias("page_kind"))
    return pages.extracted(own).select("page_id", "source_order", "heading", "body", F.array_join("section_path", " > ").alias("path"))


SQL["h03_h05_cards"] = """SELECT s_suppkey AS page_id, k AS source_order, h AS heading, CASE k WHEN 0 THEN 'More text' ELSE '' END AS body, 'Wallets > ' || h AS path
    FROM (SELECT s_suppkey, k, s_name || [' Domestic 1.5% per charge', ' Domestic + 1% abroad'][k + 1] AS h FROM supplier, (VALUES (0), (1)) AS v(k))"""


@query
def h19_h22_entries(spark, sf):
    k = F.col("o_orderkey")
    body = F.concat(_pick(["1.5% + 0.25 € for cards", "Market share of 5%", "+ 2% for"], k % 3), F.lit("\nKlarna\n"), _pick(["Dispute fee", "per charge", "Included"], k / 3 % 3), F.lit("\n$15.00"))
    own = table(spark, sf, "orders").select(k.alias("page"), F.lit(0).alias("source_order"), F.lit("Cards").alias("heading"), body.alias("body"), F.array(F.lit("Payments"), F.lit("Cards")).alias("section_path"))
    return lines.entries(own, ["page"]).select("page", "entry_no", "source_text", "payment_method", "channel", F.length("source_evidence").alias("evidence_chars"))


#: What each of the nine bodies tells, read by hand: phrase, method, and the characters that follow it.
_TOLD = [
    (a, b, n, text, "klarna" if "Klarna" in text else "card", rest)
    for a, first in enumerate(("1.5% + 0.25 € for cards", "Market share of 5%", "+ 2% for"))
    for b, second in enumerate(("Dispute fee", "per charge", "Included"))
    for n, (text, rest) in enumerate([
        # A qualifier goes to the last fee, whose words then stand apart on the page: what follows is the whole body.
        (f"{first} {second}", len(f"{first}\nKlarna\n{second}\n$15.00")) if b == 1 and a != 1 else (f"{first} Klarna" if a == 2 else first, len(f"Klarna\n{second}\n$15.00")),
        *([("Included", len("$15.00"))] if b == 2 else []), ("Dispute fee $15.00" if b == 0 else "$15.00", 0),
    ])
]
SQL["h19_h22_entries"] = f"""SELECT o_orderkey AS page, n AS entry_no, source_text, payment_method, NULL::VARCHAR AS channel, chars AS evidence_chars
    FROM orders JOIN (VALUES {', '.join(map(str, _TOLD))}) AS v(a, b, n, source_text, payment_method, chars) ON o_orderkey % 3 = a AND o_orderkey // 3 % 3 = b"""


def _lined(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))


@query
def a18_market_totals(spark, sf):
    one = lambda df, c: df.select(F.col(c).cast("string").alias("country"))
    lined, orders = _lined(spark, sf), table(spark, sf, "orders")
    status = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("country"), F.col("c_mktsegment").alias("status"))
    return snapshots.market_totals(one(orders, "o_custkey"), one(lined, "o_custkey"), one(lined.where("l_quantity > 40"), "o_custkey"), one(orders.where("o_orderstatus = 'F'"), "o_custkey"), status)


SQL["a18_market_totals"] = """WITH o AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1), l AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (l_quantity > 40) AS r FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT c_custkey::VARCHAR AS country, coalesce(o.n, 0) AS n_sections, coalesce(l.n, 0) + coalesce(r, 0) + coalesce(f, 0) AS n_entries, coalesce(r, 0) AS n_rules, c_mktsegment AS status FROM customer LEFT JOIN o ON c_custkey = o.o_custkey LEFT JOIN l ON c_custkey = l.o_custkey"""

_LABELS = ["2.50 € per charge", "fee of 250 EUR", "$2.50", "20p per charge", "1.234,50 €", "no amount"]


@query
def v02_v03_calculator(spark, sf):
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    kind = _pick(["fixed_amount", "fixed_surcharge", "included"], n % 3)
    part = F.struct(kind.alias("type"), _pick(["2.50", "0.20", "1234.50"], q % 3).alias("amount"), _pick(["EUR", "GBP"], q % 2).alias("currency"), _pick(["250", "20", "123450"], q % 3).alias("minor_amount"), F.lit(None).cast("string").alias("value"))
    condition = F.struct(_pick(["channel", "card_origin"], q % 2).alias("dimension"), F.lit("x").alias("value"))
    own = _lined(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", _pick(_LABELS, F.col("l_partkey") % 6).alias("label"), F.array(part).alias("c"), F.array(condition).alias("k"), F.lit("per_transaction").alias("unit"))
    return checks.violations(own, ["l_orderkey", "l_linenumber", "l_partkey"], {
        "no_component": checks.not_calculable("c"), "only_surcharge": checks.only_surcharge("c", "k"), "large_fixed": checks.large_fixed("c", "unit"), "amount_in_label": checks.unnamed_amount("label", "c"), "currency_in_label": checks.unnamed_currency("label", "c"),
    })


SQL["v02_v03_calculator"] = """WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber % 3 AS t, l_quantity::INT % 3 AS a, l_quantity::INT % 2 AS c, l_partkey % 6 AS l FROM lineitem),
    r AS (SELECT *, CASE a WHEN 0 THEN l IN (0, 2) WHEN 1 THEN l = 3 AND c = 1 ELSE l = 4 END AS told, CASE c WHEN 0 THEN l IN (0, 1, 4) ELSE l IN (3) OR l = 0 END AS named FROM t)
    SELECT l_orderkey, l_linenumber, l_partkey, 'no_component' AS rule FROM r WHERE t = 2 UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'only_surcharge' FROM r WHERE t = 1 AND c = 0 UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'large_fixed' FROM r WHERE t = 0 AND a = 2
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'amount_in_label' FROM r WHERE t = 0 AND NOT told UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'currency_in_label' FROM r WHERE t = 0 AND told AND NOT named"""


@query
def v17_publication_errors(spark, sf):
    lined = _lined(spark, sf)
    country = F.col("o_custkey").cast("string")
    condition = F.array(F.struct(F.lit("unit").alias("dimension"), F.lit("eq").alias("operator"), F.col("l_returnflag").alias("value")))
    rules = lined.select(country.alias("country"), F.lit("payments").alias("product_id"), F.col("l_linestatus").alias("variant_id"), condition.alias("conditions"), F.when(F.col("l_tax") > 0.05, "conflict").when(F.col("l_quantity") > 35, "calculable_rule").otherwise("included").alias("status"))
    markets = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("country"), (F.col("c_custkey") % 7 - 5).alias("dropped_numeric_entries"), (F.col("c_custkey") % 11 - 9).alias("blocking_fee_conflicts"))
    return checks.publication_errors(markets, rules, rules.where("status = 'none'"))


SQL["v17_publication_errors"] = """WITH r AS (SELECT o_custkey::VARCHAR AS country, l_linestatus AS v, l_returnflag AS f, CASE WHEN l_tax > 0.05 THEN 'conflict' WHEN l_quantity > 35 THEN 'calculable_rule' ELSE 'included' END AS s FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
    SELECT c_custkey::VARCHAR AS country, 'dropped_entries' AS error FROM customer WHERE c_custkey % 7 > 5 UNION ALL SELECT c_custkey::VARCHAR, 'blocking_conflicts' FROM customer WHERE c_custkey % 11 > 9
    UNION ALL SELECT DISTINCT country, 'mixed_identity' FROM (SELECT country FROM r GROUP BY country, v, f HAVING bool_or(s = 'conflict') AND bool_or(s <> 'conflict'))
    UNION ALL SELECT country, 'nothing_calculable' FROM r WHERE s <> 'conflict' GROUP BY country HAVING NOT bool_or(s = 'calculable_rule') UNION ALL SELECT NULL, 'no_core_rules'"""


@query
def v18_source_errors(spark, sf):
    k = F.col("n_nationkey")
    code = _pick(["de", "fr", "gb", "us"], k % 4)
    markets = table(spark, sf, "nation").select(k.cast("string").alias("n"), code.alias("country"), F.lit("EUR").alias("currency")).groupBy("country").agg(F.min("currency").alias("currency"))
    sources = table(spark, sf, "nation").select(code.alias("country"), F.concat(F.lit("https://x.com/"), _pick(["de", "fr", "gb"], k % 3), F.lit("/pricing")).alias("url"), _pick(["DE", "FR", "GB", "US", None], k % 5).alias("served"))
    index = sources.groupBy("country").agg(F.collect_set("url").alias("urls")).withColumn("urls", F.when(F.col("country") == "fr", F.array(F.lit("x"))).otherwise(F.col("urls")))
    rules = _lined(spark, sf).select(_pick(["de", "fr", "gb", "us"], F.col("o_custkey") % 4).alias("country"), F.lit("calculable_rule").alias("status"), F.lit("payments").alias("product_id"), F.lit(None).cast("string").alias("payment_method"), F.when(F.col("o_custkey") % 4 == 2, "GBP").otherwise("EUR").alias("fixed_currency"))
    return checks.source_errors(sources, markets, index, rules)


SQL["v18_source_errors"] = """WITH s AS (SELECT ['de', 'fr', 'gb', 'us'][n_nationkey % 4 + 1] AS country, ['de', 'fr', 'gb'][n_nationkey % 3 + 1] AS addressed, ['de', 'fr', 'gb', 'us', NULL][n_nationkey % 5 + 1] AS served FROM nation)
    SELECT DISTINCT country, 'served_elsewhere' AS error FROM s WHERE served <> country UNION ALL SELECT DISTINCT country, 'addressed_elsewhere' FROM s WHERE addressed <> country UNION ALL SELECT 'fr', 'index_urls' UNION ALL SELECT 'gb', 'currency'"""


@query
def v19_state_errors(spark, sf):
    k = F.col("c_custkey")
    own = table(spark, sf, "customer").select(k.cast("string").alias("country"), (k % 2 == 0).alias("in_index"), (k % 3 == 0).alias("in_unsupported"), (k % 5 == 0).alias("in_transient"), (k % 4 < 2).alias("in_core"), _pick(["complete", "partial"], k % 7 / 4).alias("derivation"), F.lit("complete").alias("calculator"))
    return checks.every_error(checks.state_errors(own))


SQL["v19_state_errors"] = """WITH s AS (SELECT c_custkey::VARCHAR AS country, c_custkey % 2 = 0 AS i, c_custkey % 3 = 0 AS u, c_custkey % 5 = 0 AS t, c_custkey % 4 < 2 AS c, c_custkey % 7 < 4 AS done FROM customer), n AS (SELECT *, i::INT + u::INT + t::INT AS n FROM s)
    SELECT country, 'not_one_state' AS error FROM n WHERE n <> 1 UNION ALL SELECT country, 'incomplete' FROM n WHERE n = 1 AND i AND NOT done UNION ALL SELECT country, 'no_core_rules' FROM n WHERE n = 1 AND i AND NOT c
    UNION ALL SELECT country, 'core_without_index' FROM n WHERE c AND NOT i UNION ALL SELECT country, 'core_not_supported' FROM n WHERE c AND (u OR t)"""
