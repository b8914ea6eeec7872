"""Queries and SQL of what is published: documents against their schemas, rules against all semantic checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyquill import tables
from tallyquill.functions import dimensions, evidence, web
from tallyquill.operators import catalog, checks, identities, pages, schemas, snapshots
from tallyquill.plans.registry import query
from tallyquill.sources import documents, files, publish, store
from tallyquill.sources.files import table
from tallyquill.sources.shared import shared_folder


@query
def v20_document_errors(spark, sf):
    """Customers as index documents of two markets, in which something is wrong by turns."""
    k, lit = F.col("c_custkey"), F.lit
    code = F.upper(F.substring("c_mktsegment", 1, 2))
    first = F.struct(F.when(k % 7 != 0, code).alias("account_country"), F.concat(lit("m"), k).alias("market_code"), F.when(k % 13 == 0, lit("")).otherwise(lit("en")).alias("locale"), lit("json/x.json").alias("data_path"), F.array(lit("http://x"), F.when(k % 17 != 0, lit("http://y"))).alias("source_urls"))
    second = F.struct(F.concat(code, F.when(k % 5 == 0, lit("9")).otherwise(lit(""))).alias("account_country"), lit("n").alias("market_code"), lit("de").alias("locale"), lit("json/y.json").alias("data_path"), F.array(lit("http://z")).alias("source_urls"))
    body = F.to_json(F.struct(F.when(k % 11 == 0, lit("one")).alias("schema_version"), F.array(first, second).alias("markets")))
    value = F.when(k % 19 == 0, F.substring(body, 1, 20)).when(k % 23 == 0, lit("[1]")).otherwise(body)
    return schemas.document_errors(table(spark, sf, "customer").select("c_custkey", value.alias("value")), "index").select("c_custkey", "place", "error")

def _pick(words: list, n) -> F.Column:
    return F.get(F.array(*(F.lit(w).cast("string") for w in words)), n.cast("int"))


def _list(words: list) -> str:
    return "[" + ", ".join("NULL" if w is None else f"'{w}'" for w in words) + "]"


#: A valid rule's columns, and what each fault changes, with the errors that it then has.
_SUM = "1.5% + €0.25"
_FAULTS = [
    ({}, []), ({"channel": None}, ["channel"]), ({"unit": None}, ["unit"]), ({"behavior": None}, ["behavior"]), ({"parts": 1}, ["no_component"]), ({"parts": 2}, ["only_surcharge"]), ({"kind": "marketing_prose"}, ["evidence"]),
    ({"confidence": "0.5"}, ["confidence"]), ({"parts": 3, "label": "1.234,50 €"}, ["large_fixed"]), ({"label": "no amount"}, ["amount_in_label"]), ({"label": "1.5% + 0.25"}, ["currency_in_label"]), ({"parts": 4}, ["minor_amount"]),
    ({"parts": 5}, ["basis_points"]), ({"label": "Free: " + _SUM}, ["contradictory"]), ({"label": "Custom pricing " + _SUM}, ["pricing_plan"]), ({"variant_id": "online_domestic_cards", "product_id": "radar", "label": "Radar " + _SUM}, ["addon_variant", "card_condition"]),
    ({"label": "Radar " + _SUM}, ["addon_product"]), ({"product_id": "smart_disputes", "unit": "per_dispute"}, ["smart_disputes"]), ({"label": "Starting at " + _SUM}, ["exactness"]), ({"label": "Conversion fee paid by customers " + _SUM}, ["payer"]),
    ({"phrases": "a fee|a fee"}, ["repeated_phrases"]), ({"kind": "cross_fragment_fee_evidence"}, ["crossed", "evidence"]), ({"unit": "per_dispute"}, ["dispute_unit"]), ({"payment_method": "klarna"}, ["method"]), ({"country": "ZZ"}, ["unknown_market"]),
    ({"product_id": "nosuch", "payment_method": "nosuch"}, ["unknown_method"]), ({"key": "twice"}, ["repeated_identity"]), ({"label": "Market share of 5% " + _SUM, "sources": "share of online payments"}, ["market_share"]),
    ({"kind": "cross_fragment_fee_evidence", "status": "non_calculable"}, ["crossed"]),
]
_TWICE = next(i for i, (f, _) in enumerate(_FAULTS) if f.get("key"))
_VALID = {
    "channel": "online", "unit": "per_transaction", "behavior": "conditional", "kind": "explicit_fee_phrase", "confidence": "0.85", "label": _SUM, "product_id": "payments", "variant_id": None, "payment_method": None, "country": "DE",
    "phrases": "", "sources": _SUM, "status": "calculable_rule", "exactness": "exact", "key": None,
}


def _parts(*own: dict) -> F.Column:
    kind = "array<struct<type:string,value:string,amount:string,currency:string,basis_points:string,minor_amount:string>>"
    return F.array(*(F.struct(*(F.lit(x.get(n)).cast("string").alias(n) for n in ("type", "value", "amount", "currency", "basis_points", "minor_amount"))) for x in own)).cast(kind)


@query
def v16_semantic_errors(spark, sf):
    """lineitem as published rules, each valid but for one fault that its line tells."""
    n = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_partkey")) % len(_FAULTS)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    told = {c: _pick([f.get(c, v) for f, _ in _FAULTS], n) for c, v in _VALID.items()}
    share, fixed = {"type": "percentage", "value": "1.5", "basis_points": "150"}, {"type": "fixed_amount", "amount": "0.25", "currency": "EUR", "minor_amount": "25"}
    forms = [_parts(share, fixed), _parts(), _parts({"type": "percentage_surcharge", "value": "1.5", "basis_points": "150"}), _parts({"type": "fixed_amount", "amount": "1234.50", "currency": "EUR", "minor_amount": "123450"}), _parts(share, fixed | {"minor_amount": "26"}), _parts(share | {"basis_points": "151"}, fixed)]
    condition = F.array(F.struct(F.lit("channel").alias("dimension"), F.lit("eq").alias("operator"), F.lit("online").alias("value")))
    rules = table(spark, sf, "lineitem").select(key.alias("rule_id"), n.alias("fault"), *(c.alias(k) for k, c in told.items() if k not in ("confidence", "phrases", "sources", "kind", "variant_id", "key")), F.coalesce(told["variant_id"], told["key"], key).alias("variant_id"),
        told["confidence"].cast("double").alias("confidence"), F.filter(F.split(told["phrases"], "[|]"), lambda x: x != "").alias("phrases"), F.array(told["sources"]).alias("sources"), F.struct(told["kind"].alias("type")).alias("fee_evidence"),
        F.get(F.array(*forms), _pick([f.get("parts", 0) for f, _ in _FAULTS], n).cast("int")).alias("fee_components"), condition.alias("conditions"))
    # An add-on as a payment has a condition that only cards have, which tells such rules apart.
    rules = rules.withColumn("conditions", F.when(F.col("variant_id") == "online_domestic_cards", F.array(F.struct(F.lit("card_region").alias("dimension"), F.lit("eq").alias("operator"), F.col("rule_id").alias("value")))).otherwise(F.col("conditions")))
    one = lambda c, *values: table(spark, sf, "region").select(F.explode(F.array(*map(F.lit, values))).alias(c)).distinct()
    return checks.semantic_errors(rules, one("country", "DE", "FR"), one("method", "klarna", "card"), ["rule_id", "fault"])


@query
def d27_core_rules(spark, sf):
    """lineitem as rules with components or with flat fields alone, as a calculator reads them."""
    n, share = F.col("l_linenumber"), F.round(F.col("l_discount") * 100).cast("int").cast("string")
    part = F.struct(F.lit("percentage").alias("type"), share.alias("value"), *(F.lit(None).cast("string").alias(c) for c in ("amount", "currency", "basis_points", "operator", "minor_amount")), F.lit("e").alias("source_entry_id"), F.lit("t").alias("source_text"))
    some = F.array(part)
    rules = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("rule_id"), F.lit("payments").alias("product_id"), F.lit("standard").alias("variant_id"), F.when(n > 2, "Fee").alias("label"), F.lit("DE").alias("account_country"), F.lit("online").alias("channel"), F.lit(None).cast("string").alias("payment_method"),
        F.array().cast("array<struct<dimension:string,operator:string,value:string>>").alias("conditions"), F.when(n % 2 == 0, some).otherwise(F.slice(some, 1, 0)).alias("fee_components"), F.lit("per_charge").alias("unit"), F.lit("conditional").alias("behavior"), F.lit("exact").alias("exactness"),
        _pick(["classified", "calculable_rule", "conflict", "informational"], n % 4).alias("status"), F.col("l_tax").alias("confidence"), F.struct(F.lit("explicit_fee_phrase").alias("type")).alias("fee_evidence"), share.alias("percentage"), F.lit("9").alias("basis_points"),
        F.when(n > 4, "0.30").alias("fixed_amount"), F.lit("30").alias("fixed_amount_minor"), F.lit("EUR").alias("fixed_currency"), F.lit("").alias("minimum_amount"), F.when(n > 5, "5").alias("maximum_amount"),
    )
    told = F.array_join(F.transform("fee_components", lambda c: F.concat_ws("/", c["type"], c["value"], c["amount"], c["currency"], c["minor_amount"], c["basis_points"])), ";")
    return catalog.core_rules(rules, "the provider").select("rule_id", "label", "provider", "classification_status", told.alias("components"))


@query
def v17_report_errors(spark, sf):
    """Each region as one publication with the documents that its nations stand for."""
    k = F.col("n_nationkey")
    path = _pick(["change-report.json", "meta/crawl-report.json", "meta/revision.json", "json/DE.json", "other"], k % 5)
    value = F.when(k == 0, '{"has_regression": true}').when(k == 1, "{ broken").when(k == 2, '{"revision": "b"}').otherwise("{}")
    return checks.report_errors(table(spark, sf, "nation").select(path.alias("path"), value.alias("value")), "a")


@query
def j14_page_order(spark, sf):
    own = table(spark, sf, "orders")
    entries = own.select("o_custkey", F.col("o_orderpriority").alias("url"), (F.col("o_orderkey") % 10).alias("source_order"), F.col("o_orderkey").alias("entry_id"))
    pages = own.where("o_orderpriority not like '5%'").select("o_custkey", F.col("o_orderpriority").alias("url"), ((F.col("o_custkey") + F.ascii("o_orderpriority")) % 5 + 1).alias("position")).distinct()
    return catalog.in_page_order(entries, pages, ["o_custkey"]).select("o_custkey", "entry_id", "source_order")


@query
def f13_unsupported(spark, sf):
    return catalog.unsupported_only(table(spark, sf, "orders").select("o_orderkey", _pick(["unsupported", "transient_failure", "explicitly_excluded", None], F.col("o_orderkey") % 4).alias("status")))


@query
def s10_expiry(spark, sf):
    k = F.col("event_id")
    header, expires = _pick(["max-age=60", "public", "no-cache", "s-maxage=5"], k % 4), _pick(["Wed, 31 Jan 2024 12:00:00 GMT", "Fri, 02 Feb 2024 12:00:00 GMT", "soon", None], k / 4 % 4)
    return table(spark, sf, "events").select("event_id", web.fresh(F.lit(30), 864000, header, expires, 1706745600.0).alias("fresh"))  # 1 February 2024


@query
def s13_decoded_pages(spark, sf):
    """Pages as bytes of two charsets, some of which say so and some of which say another."""
    k = F.col("page_id")
    text = F.concat(F.when(k % 2 == 0, "").otherwise("<meta charset='ISO-8859-1'>"), F.regexp_replace("html", "(?i)<meta[^>]*>", ""), F.lit("é"))
    content = F.when(k % 3 == 0, F.encode(F.regexp_replace(text, r"[^\x00-\xFF]", "?"), "ISO-8859-1")).otherwise(F.encode(text, "UTF-8"))
    return table(spark, sf, "pages").select("page_id", files.decoded(content).alias("d")).select("page_id", "d.charset", "d.error", F.length("d.html").alias("chars"))


@query
def s16_footer_markets(spark, sf):
    links = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("position"), F.initcap("n_name").alias("text"), F.concat(F.lit("/"), "c_custkey").alias("href"))
    return pages.footer_markets(links, table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code"))).select("code", "position", "href", "is_alias")


@query
def s18_candidate_urls(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", F.posexplode(web.candidate_urls(F.lit("https://x.com"), F.concat(F.lit("m"), "s_suppkey"))).alias("place", "url"))


@query
def a20_has_regression(spark, sf):
    """Whether a supplier's lines, as changes of one kind each, hold a regression."""
    kinds = table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") > 0, "new_market").otherwise("sharp_rule_drop").alias("kind"))
    more = table(spark, sf, "lineitem").select(F.when(F.col("l_quantity") > 49, "sharp_rule_drop").otherwise("new_market").alias("kind"))
    return snapshots.has_regression(kinds).select(F.lit("new").alias("changes"), "has_regression").unionByName(snapshots.has_regression(more).select(F.lit("mixed").alias("changes"), "has_regression"))


@query
def k09_json_lines(spark, sf):
    return publish.json_lines(table(spark, sf, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") > 9, F.col("n_regionkey")).alias("n_regionkey")))


_FEATURE = (["radar", "tax", "disputes", "payments", "smart_disputes"], ["Radar for fraud teams", "Machine Learning", "Tax Complete", "tax basic", None], ["Dispute fee", "Won Disputes!", None])
_VARIANT = {
    "product": ["payments", "terminal", "radar", "smart_disputes", "tax", "klarna", "three_d_secure"], "plan": [None, "custom"], "feature": [None, "basic"], "low": ["if you win", "lost", "x"], "via": ["in_person", "online", None],
    "region": ["domestic", "international", "uk", "eea", None], "tier": [None, "premium"], "kind": [None, "debit"], "origin": [None, "international", "domestic"], "method": ["card", "tap_to_pay", None],
}
#: Each column's words change after so many rows, so that all combinations come up.
_STEP = {c: s for c, s in zip(_VARIANT, (1, 7, 3, 5, 11, 13, 17, 19, 23, 29))}


@query
def d09_d15_d26_dimensions(spark, sf):
    k = F.col("l_partkey") + F.col("l_orderkey") * 31 + F.col("l_linenumber")
    v = {c: _pick(words, F.floor(k / _STEP[c]) % len(words)) for c, words in _VARIANT.items()}
    f = [_pick(words, F.floor(k / s) % len(words)) for words, s in zip(_FEATURE, (1, 5, 25))]
    variant = dimensions.variant_id(v["product"], v["plan"], v["feature"], v["low"], v["method"], v["via"], v["region"], v["tier"], v["origin"], v["kind"])
    base = dimensions.base_conditions(v["product"], v["method"], v["via"], v["region"], v["tier"], v["origin"], F.lit("DE"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", dimensions.product_feature(*f).alias("feature"), variant.alias("variant"), F.array_join(F.transform(base, lambda c: F.concat_ws("=", c["dimension"], c["value"])), ";").alias("conditions"))


@query
def f05_f07_components(spark, sf):
    """Components of lineitem rows as terminal prices, numbers that are part of a name, and contradictions."""
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    part = lambda kind, amount, text: F.struct(kind.alias("type"), F.lit(None).cast("string").alias("value"), amount.alias("amount"), F.lit("USD").alias("currency"), text.alias("source_text"))
    amount = q.cast("string")
    text = F.concat(_pick(["$ ", "portal ", "USD ", "€", "P", ""], q % 6), amount, F.lit(" each"))
    parts = F.array(part(_pick(["fixed_amount", "percentage", "maximum_fee"], n % 3), amount, text), part(_pick(["included", "fixed_amount"], n % 2), F.lit("3"), F.lit("$3")))
    words = _pick(["reader", "reader processing fee", "cards"], q % 3)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", evidence.is_hardware_price(_pick(["terminal", "payments"], n % 2), F.lit(None).cast("string"), words, parts).alias("hardware"), evidence.is_number_of_name(parts).alias("name"), evidence.is_contradictory(parts).alias("contradictory"),
    )


_RULE_STATUS = ["calculable_rule", "non_calculable", "conflict", "included", "free", "informational", "custom_pricing", "unsupported_fee_shape"]
_LEFT_STATUS = ["unclassified_fee_candidate", "ambiguous", "unsupported_fee_shape", "ignored_non_fee", "reference_only", "included", "free", "informational", "custom_pricing"]


@query
def a08_a11_counters(spark, sf):
    """All counters of each supplier, whose lines are entries, rules and leftovers by turns, and of all together."""
    n = F.col("l_linenumber")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    own = table(spark, sf, "lineitem").select("l_suppkey", n.alias("n"), key.alias("entry_id"), (F.col("l_tax") > 0.02).alias("has_fee"), F.col("l_partkey").alias("k"), (F.col("l_quantity") > 25).alias("is_candidate"))
    rules = own.where("n < 4").select("l_suppkey", F.array("entry_id").alias("entry_ids"), _pick(_RULE_STATUS, F.col("k") % len(_RULE_STATUS)).alias("status"), "is_candidate")
    left = own.where("n in (5, 6)").select("l_suppkey", "entry_id", _pick(_LEFT_STATUS, F.col("k") % len(_LEFT_STATUS)).alias("status"), "has_fee")
    found = identities.counters(own, rules, left, ["l_suppkey"])
    return found.unionByName(identities.summed(found, ["l_suppkey"]).withColumn("l_suppkey", F.lit(None).cast("long")))


@query
def k01_k02_document_tree(spark, sf):
    """Suppliers as documents of a tree, published twice, the second time with one that changed, and read again."""
    root = f"{shared_folder(spark)}/tree-{uuid.uuid4().hex}"
    own = table(spark, sf, "supplier")
    docs = lambda name: own.select(F.concat(F.lit("json/S"), "s_suppkey", F.lit(".json")).alias("path"), F.to_json(F.struct(name.alias("name"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("nation"), F.array("s_suppkey").alias("ids")), {"ignoreNullFields": "false"}).alias("value"))
    before = documents.publish_documents(docs(F.col("s_name")), root)["manifest"]
    after = documents.publish_documents(docs(F.when(F.col("s_suppkey") == 7, "other").otherwise(F.col("s_name"))), root)["manifest"]
    return documents.documents(spark, root).join(documents.changes(spark, root, before, after), "path", "left")


@query
def s06_k10_store(spark, sf):
    """Customers' pages put into a store by turns, some twice, dropped or found still good, and asked for again."""
    root, k = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", F.col("c_custkey")
    page = table(spark, sf, "customer").select(k.alias("k"), F.lit("GET").alias("method"), F.concat(F.lit("https://x.com/p"), k).alias("url"), F.lit("DE").alias("market"), F.lit("de-de").alias("locale"))
    first = page.withColumns({"status": F.when(F.col("k") % 5 == 0, 500).otherwise(200), "headers": F.create_map(F.lit("x"), F.lit("y")), "content": F.concat(F.lit("old "), "k"), "fetched_at": F.lit(100.0)})
    later = page.where("k % 3 = 0").withColumns({"status": F.when(F.col("k") % 2 == 0, 304).otherwise(200), "headers": F.create_map(F.lit("cache-control"), F.when(F.col("k") % 7 == 0, "private").otherwise("public")), "content": F.concat(F.lit("new "), "k"), "fetched_at": F.lit(180.0)})
    store.put(store.answers(first), root, 1.0)
    store.put(store.answers(later), root, 2.0)
    rows, _ = store.looked_up(page, root, 200.0, 60.0)
    return rows.select("k", "hit", F.col("content").cast("string").alias("content"), "fetched_at")


def _case(column: str, words: list, n: str) -> str:
    return f"{_list(words)}[({n}) % {len(words)} + 1] AS {column}"


_K = "(l_partkey + l_orderkey * 31 + l_linenumber)"
_DIMENSIONS = ", ".join(_case(c, words, f"{_K} // {_STEP[c]}") for c, words in _VARIANT.items()) + ", " + ", ".join(_case(c, words, f"{_K} // {s}") for c, words, s in zip(("fp", "fh", "fn"), _FEATURE, (1, 5, 25)))

_R = ", ".join(f"count(*) FILTER (s = '{x}') AS {x}" for x in _RULE_STATUS)
_L = ", ".join(f"count(*) FILTER (s = '{x}') AS {x}" for x in _LEFT_STATUS)
_CLOSED = ", ".join(f"'{x}'" for x in tables.CLOSED)

SQL = {
    "a08_a11_counters": f"""WITH o AS (SELECT l_suppkey, l_linenumber AS n, l_tax > 0.02 AS fee, {_list(_RULE_STATUS)}[l_partkey % 8 + 1] AS rs, {_list(_LEFT_STATUS)}[l_partkey % 9 + 1] AS ls, l_quantity > 25 AS cand FROM lineitem),
        e AS (SELECT l_suppkey, count(*) AS source_entries, count(*) FILTER (fee) AS numeric_source_entries, count(*) FILTER (fee AND (n < 4 OR n IN (5, 6))) AS referenced_numeric_entries, count(*) FILTER (fee AND n >= 4 AND n NOT IN (5, 6)) AS dropped_numeric_entries FROM o GROUP BY l_suppkey),
        r AS (SELECT l_suppkey, count(*) FILTER (s = 'conflict' AND cand) AS blocking_fee_conflicts, count(*) FILTER (s = 'conflict' AND NOT cand) AS informational_conflicts, {_R} FROM (SELECT *, rs AS s FROM o WHERE n < 4) GROUP BY l_suppkey),
        l AS (SELECT l_suppkey, count(*) FILTER (fee AND s NOT IN ({_CLOSED})) AS numeric_fee_candidates, {_L} FROM (SELECT *, ls AS s FROM o WHERE n IN (5, 6)) GROUP BY l_suppkey),
        c AS (SELECT e.*, coalesce(blocking_fee_conflicts, 0) AS blocking_fee_conflicts, coalesce(informational_conflicts, 0) AS informational_conflicts, coalesce(numeric_fee_candidates, 0) AS numeric_fee_candidates, coalesce(calculable_rule, 0) AS calculable_rules, coalesce(non_calculable, 0) AS non_calculable_rules,
            coalesce(conflict, 0) AS conflicting_rule_identities, coalesce(unclassified_fee_candidate, 0) AS unclassified_fee_candidates, coalesce(ambiguous, 0) AS ambiguous_entries, coalesce(r.unsupported_fee_shape, 0) + coalesce(l.unsupported_fee_shape, 0) AS unsupported_fee_shapes, coalesce(ignored_non_fee, 0) AS ignored_non_fee,
            coalesce(reference_only, 0) AS reference_only, coalesce(r.included, 0) + coalesce(l.included, 0) AS included, coalesce(r.free, 0) + coalesce(l.free, 0) AS free, coalesce(r.informational, 0) + coalesce(l.informational, 0) AS informational, coalesce(r.custom_pricing, 0) + coalesce(l.custom_pricing, 0) AS custom_pricing
          FROM e LEFT JOIN r ON r.l_suppkey = e.l_suppkey LEFT JOIN l ON l.l_suppkey = e.l_suppkey)
        SELECT * FROM c UNION ALL SELECT NULL, {', '.join(f'sum({x})::BIGINT' for x in ('source_entries', 'numeric_source_entries', 'referenced_numeric_entries', 'dropped_numeric_entries', 'blocking_fee_conflicts', 'informational_conflicts', 'numeric_fee_candidates', 'calculable_rules', 'non_calculable_rules', 'conflicting_rule_identities', 'unclassified_fee_candidates', 'ambiguous_entries', 'unsupported_fee_shapes', 'ignored_non_fee', 'reference_only', 'included', 'free', 'informational', 'custom_pricing'))} FROM c""",
    "k01_k02_document_tree": """SELECT 'json/S' || s_suppkey || '.json' AS path, '{' || chr(10) || '  "ids": [' || chr(10) || '    ' || s_suppkey || chr(10) || '  ],' || chr(10) || '  "name": "' || CASE WHEN s_suppkey = 7 THEN 'other' ELSE s_name END || '",' || chr(10)
          || '  "nation": ' || CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey::VARCHAR ELSE 'null' END || chr(10) || '}' || chr(10) AS value, CASE WHEN s_suppkey = 7 THEN 'changed' END AS change FROM supplier""",
    "s06_k10_store": """WITH c AS (SELECT c_custkey AS k, c_custkey % 5 <> 0 AS kept, c_custkey % 3 = 0 AS again, c_custkey % 2 = 0 AS same, c_custkey % 7 = 0 AS own FROM customer),
        s AS (SELECT *, again AND NOT same AND NOT own AS replaced, again AND NOT same AND own AS dropped, again AND same AND kept AS touched FROM c),
        f AS (SELECT k, CASE WHEN dropped THEN NULL WHEN replaced OR touched THEN 180.0 WHEN kept THEN 100.0 END::DOUBLE AS seen, replaced FROM s)
        SELECT k, coalesce(seen > 140, false) AS hit, CASE WHEN seen > 140 THEN CASE WHEN replaced THEN 'new ' ELSE 'old ' END || k END AS content, seen AS fetched_at FROM f""",
    "v16_semantic_errors": """WITH r AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS rule_id, (l_orderkey * 7 + l_linenumber * 3 + l_partkey) % """ + str(len(_FAULTS)) + """ AS fault FROM lineitem)
        SELECT rule_id, fault, error AS rule FROM r JOIN (VALUES """ + ", ".join(f"({i}, '{e}')" for i, (_, errors) in enumerate(_FAULTS) for e in errors) + """) AS v(f, error) ON f = fault
        WHERE error <> 'repeated_identity' OR (SELECT count(*) FROM r WHERE fault = """ + str(_TWICE) + """) > 1
        UNION ALL SELECT rule_id, fault, 'repeated_identity' FROM (SELECT *, count(*) OVER (PARTITION BY rule_id) AS n FROM r) WHERE n > 1 AND fault <> """ + str(_TWICE),
    "d27_core_rules": """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS rule_id, CASE WHEN l_linenumber > 2 THEN 'Fee' ELSE 'payments' END AS label, 'the provider' AS provider, CASE l_linenumber % 4 WHEN 0 THEN 'classified' ELSE 'calculable_rule' END AS classification_status,
          CASE WHEN l_linenumber % 2 = 0 THEN 'percentage/' || round(l_discount * 100)::INT
            ELSE concat_ws(';', 'percentage/' || round(l_discount * 100)::INT || '/9', CASE WHEN l_linenumber > 4 THEN 'fixed_amount/0.30/EUR/30' END, CASE WHEN l_linenumber > 5 THEN 'maximum_fee/5/EUR' END) END AS components
        FROM lineitem WHERE l_linenumber % 4 < 2""",
    "v17_report_errors": """SELECT NULL::VARCHAR AS country, error FROM (VALUES ('has_regression'), ('bad_change_report'), ('bad_crawl_report'), ('other_revision')) AS v(error) WHERE (SELECT count(*) FROM nation) = 25""",
    "j14_page_order": """WITH p AS (SELECT DISTINCT o_custkey, o_orderpriority, (o_custkey + ascii(o_orderpriority)) % 5 + 1 AS position FROM orders WHERE o_orderpriority NOT LIKE '5%')
        SELECT o_custkey, o_orderkey AS entry_id, (row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(position, 0), o_orderkey % 10, o_orderkey) - 1)::INT AS source_order FROM orders LEFT JOIN p USING (o_custkey, o_orderpriority)""",
    "f13_unsupported": """SELECT o_orderkey, ['unsupported', 'transient_failure', 'explicitly_excluded', NULL][o_orderkey % 4 + 1] AS status FROM orders WHERE o_orderkey % 4 <> 1""",
    "s10_expiry": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN event_id // 4 % 4 <> 0 ELSE false END AS fresh FROM events""",
    "s13_decoded_pages": r"""WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '' ELSE '<meta charset=''ISO-8859-1''>' END || regexp_replace(html, '(?i)<meta[^>]*>', '', 'g') || 'é' AS text FROM pages)
        SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'UTF-8' ELSE 'ISO-8859-1' END AS charset, CASE WHEN page_id % 2 = 0 AND page_id % 3 = 0 THEN 'bytes are not UTF-8' END AS error, (CASE WHEN page_id % 2 = 1 AND page_id % 3 <> 0 THEN strlen(text) ELSE length(text) END)::INT AS chars FROM p""",
    "s16_footer_markets": """SELECT c_nationkey AS code, c_custkey AS position, '/' || c_custkey AS href, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) > 1 AS is_alias FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "s18_candidate_urls": """SELECT s_suppkey, place::INT AS place, 'https://x.com/m' || s_suppkey || '/pricing' || ['', '/local-payment-methods'][place + 1] AS url FROM supplier, (VALUES (0), (1)) AS v(place)""",
    "a20_has_regression": """SELECT 'new' AS changes, bool_or(l_linenumber <= 0) AS has_regression FROM lineitem UNION ALL SELECT 'mixed', bool_or(l_quantity > 49) FROM lineitem""",
    "k09_json_lines": """SELECT '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || CASE WHEN n_nationkey > 9 THEN n_regionkey::VARCHAR ELSE 'null' END || '}' AS value FROM nation""",
    "d09_d15_d26_dimensions": f"""WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, {_DIMENSIONS} FROM lineitem),
        h AS (SELECT *, coalesce(origin = 'international', false) OR coalesce(region = 'international', false) AS abroad, CASE WHEN via = 'in_person' THEN 'in_person' ELSE 'online' END AS place, coalesce('_' || kind, '') || '_cards' AS cards, product IN ('payments', 'terminal') AS card FROM d)
        SELECT l_orderkey, l_linenumber, l_partkey,
          CASE fp WHEN 'radar' THEN CASE WHEN fh = 'Radar for fraud teams' THEN 'fraud_teams' WHEN fh = 'Machine Learning' THEN 'machine_learning' END WHEN 'tax' THEN CASE fh WHEN 'Tax Complete' THEN 'complete' WHEN 'tax basic' THEN 'basic' END
            WHEN 'payments' THEN NULL ELSE CASE fn WHEN 'Dispute fee' THEN 'dispute_fee' WHEN 'Won Disputes!' THEN 'won_disputes' END END AS feature,
          CASE WHEN product IN ('three_d_secure', 'radar') AND plan IS NOT NULL THEN plan || '_pricing' WHEN product = 'smart_disputes' THEN CASE low WHEN 'if you win' THEN 'won_dispute' WHEN 'lost' THEN 'lost_dispute' ELSE 'standard' END
            WHEN product = 'tax' AND feature IS NOT NULL THEN feature WHEN product = 'payments' THEN place || CASE WHEN tier = 'premium' THEN '_premium_cards' ELSE '_' || CASE WHEN abroad OR coalesce(region = 'uk', false) THEN 'international' ELSE 'domestic' END || cards END
            WHEN product = 'terminal' THEN CASE WHEN method = 'tap_to_pay' THEN 'tap_to_pay' ELSE CASE WHEN abroad THEN 'international' ELSE 'domestic' END || cards END ELSE 'standard' END AS variant,
          concat_ws(';', 'payment_method=' || method, 'channel=' || via, CASE WHEN card THEN 'card_region=' || region END, CASE WHEN card AND region IS NOT NULL THEN 'card_origin=' || origin END, CASE WHEN card THEN 'card_tier=' || tier END,
            CASE WHEN NOT card AND region IS NOT NULL THEN 'cross_border=' || (region <> 'domestic') END, CASE WHEN NOT card THEN 'transaction_region=' || region END, 'account_country=DE') AS conditions FROM h""",
    "f05_f07_components": """SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber % 2 = 0 AND l_quantity::INT % 3 = 0 AND ((l_linenumber % 3 = 0 AND l_quantity::INT >= 10)) AS hardware,
          l_linenumber % 3 <> 1 AND l_quantity::INT % 6 IN (1, 4) AS name, l_linenumber % 2 = 0 AS contradictory FROM lineitem""",
    "v20_document_errors": """WITH d AS (SELECT c_custkey, c_custkey AS k FROM customer WHERE c_custkey % 19 <> 0 AND c_custkey % 23 <> 0)
        SELECT c_custkey, '$' AS place, 'no JSON' AS error FROM customer WHERE c_custkey % 19 = 0
        UNION ALL SELECT c_custkey, '$', 'no object' FROM customer WHERE c_custkey % 23 = 0 AND c_custkey % 19 <> 0
        UNION ALL SELECT c_custkey, '$.schema_version', 'no integer' FROM d WHERE k % 11 = 0
        UNION ALL SELECT c_custkey, '$.markets[0].account_country', 'missing' FROM d WHERE k % 7 = 0
        UNION ALL SELECT c_custkey, '$.markets[0].source_urls[1]', 'null' FROM d WHERE k % 17 = 0
        UNION ALL SELECT c_custkey, '$.markets[1].account_country', 'not like ^[A-Za-z]{2}$' FROM d WHERE k % 5 = 0""",
}
