"""Queries and SQL of rules that are merged with all that tells where they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyquill.operators import containment, identities
from tallyquill.plans.registry import query
from tallyquill.sources.files import table
from tallyquill.sources.shared import shuffled

_PARTS = ("type", "value", "amount", "currency", "basis_points", "operator", "minor_amount")


def _part(kind: str, **values) -> F.Column:
    return F.struct(F.lit(kind).alias("type"), *(values.get(n, F.lit(None)).cast("string").alias(n) for n in _PARTS[1:]))


def _rules(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as classified rules: supplier, flag and a remainder of the order identify; discount, tax and quantity make the fee."""
    own = table(spark, sf, "lineitem").withColumns({"l_shipmode": F.concat(F.lit("m"), F.col("l_orderkey") % 7), "l_shipinstruct": F.concat(F.lit("said "), (F.col("l_suppkey") + F.col("l_linenumber")) % 3)})
    share, tax, q = F.round(F.col("l_discount") * 100).cast("int"), F.round(F.col("l_tax") * 100).cast("int"), F.col("l_quantity").cast("int")
    parts = F.array_compact(F.array(
        F.when(q > 6, _part("percentage", value=share % 3)), F.when(tax > 2, _part("fixed_amount", amount=tax % 2, currency=F.lit("EUR"))), F.when(q > 30, _part("maximum_fee", amount=F.lit(5), currency=F.lit("EUR"))),
    ))
    entry = F.concat(F.lpad((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), 12, "0"), F.lit("-"), F.lpad(F.col("l_partkey").cast("string"), 8, "0"))
    texts = F.array(F.col("l_shipinstruct"), F.concat(F.lit("part "), F.col("l_partkey") % 4))
    status = F.when(F.col("l_linenumber") < 3, "calculable_rule").when(F.col("l_linenumber") < 5, "non_calculable").otherwise("informational")
    return own.select(
        F.col("l_suppkey").alias("url"), F.when(F.col("l_returnflag") == "N", "unspecified").otherwise(F.col("l_returnflag")).alias("product_id"), F.when(F.col("l_shipmode") != "m3", F.col("l_shipmode")).alias("variant_id"), entry.alias("entry_id"),
        F.concat(F.lit("r"), F.col("l_orderkey") % 50).alias("rule_id"), F.array(entry, F.concat(F.lit("p"), F.col("l_partkey") % 9)).alias("entry_ids"), parts.alias("fee_components"), F.array().cast("array<struct<dimension:string,operator:string,value:string>>").alias("conditions"),
        F.when(F.col("l_linestatus") == "O", "per_charge").otherwise("per_transaction").alias("unit"), F.lit("exact").alias("exactness"), F.lit("conditional").alias("behavior"), status.alias("status"), F.col("l_tax").alias("confidence"),
        F.struct(F.col("l_shipmode").alias("type"), F.col("l_tax").alias("confidence")).alias("fee_evidence"), texts.alias("source_texts"), F.array(F.struct(entry.alias("entry_id"), F.col("l_shipinstruct").alias("text"))).alias("fragments"),
        F.slice(texts, 2, 1).alias("phrases"), F.array(entry).alias("evidence_ids"), F.array(F.concat(F.lit("line "), "l_linenumber")).alias("notes"), F.when(q > 6, share % 3).cast("string").alias("percentage"),
    )


@query
def a03_a05_rule_provenance(spark, sf):
    own = identities.deduplicated_rules(_rules(spark, sf), ["url"])
    joined = lambda c: F.array_join(c, ",").alias(c)
    return own.select(
        F.col("url").alias("supplier"), "product_id", "variant_id", "entry_id", "n_rules", "status", F.col("confidence").cast("decimal(6,2)").alias("confidence"), "is_candidate", "percentage", "unit", F.size("fee_components").alias("n_components"),
        joined("entry_ids"), joined("source_texts"), joined("rule_ids"), F.array_join(F.transform("fragments", lambda x: F.concat_ws("=", x["text"], x["entry_id"])), ",").alias("fragments"), joined("phrases"), joined("evidence_ids"), joined("notes"),
    )


@query
def j13_containment_owners(spark, sf):
    """Orders as sets of their lines' kinds, near orders together: the order that takes each up, where it ends, and by which way."""
    own = table(spark, sf, "lineitem").groupBy(F.floor(F.col("l_orderkey") / 200).alias("near"), "l_orderkey").agg(F.collect_set(F.concat("l_returnflag", F.col("l_linenumber") % 4)).alias("parts"))
    sets = own.select(containment.selected(["near"]).alias("_sel"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0").alias("key"), "parts")
    found = containment.owners(sets, "key", "parts")
    ends = containment.followed(found, "key").join(shuffled(found), ["_sel", "key"])
    return ends.select(F.get_json_object("_sel", "$.near").cast("long").alias("near"), "key", "owner", "root", F.array_join("path", ">").alias("path"))


_OWNERS = """,
        held AS (SELECT a.sel, a.key, b.key AS other, len(b.parts) > len(a.parts) AS more FROM sets a JOIN sets b ON a.sel = b.sel AND a.key <> b.key AND list_has_all(b.parts, a.parts)),
        taken AS (SELECT DISTINCT sel, key FROM held WHERE more OR other > key),
        edges AS (SELECT sel, key, coalesce(min(other) FILTER (other < key AND NOT gone), min(other) FILTER (other > key)) AS owner
                  FROM (SELECT held.*, t.key IS NOT NULL AS gone FROM held LEFT JOIN taken t ON t.sel = held.sel AND t.key = other) WHERE (sel, key) IN (SELECT (sel, key) FROM taken) GROUP BY sel, key),
        ways AS (SELECT sel, key, owner AS top, [key] AS path FROM edges UNION ALL SELECT w.sel, w.key, e.owner, list_prepend(w.top, w.path) FROM ways w JOIN edges e ON e.sel = w.sel AND e.key = w.top),
        ends AS (SELECT w.sel, w.key, w.top AS root, w.path FROM ways w LEFT JOIN edges e ON e.sel = w.sel AND e.key = w.top WHERE e.key IS NULL)"""

SQL = {
    "j13_containment_owners": f"""WITH RECURSIVE sets AS (SELECT l_orderkey // 200 AS sel, lpad(l_orderkey::VARCHAR, 9, '0') AS key, list_sort(list(DISTINCT l_returnflag || (l_linenumber % 4))) AS parts FROM lineitem GROUP BY ALL){_OWNERS}
        SELECT sel::BIGINT AS near, key, owner, root, array_to_string(path, '>') AS path FROM ends JOIN edges USING (sel, key)""",
    "a03_a05_rule_provenance": f"""WITH RECURSIVE raw AS (SELECT l_suppkey AS supplier, CASE l_returnflag WHEN 'N' THEN 'unspecified' ELSE l_returnflag END AS product_id, CASE WHEN l_shipmode <> 'm3' THEN l_shipmode END AS variant_id,
          lpad((l_orderkey * 10 + l_linenumber)::VARCHAR, 12, '0') || '-' || lpad(l_partkey::VARCHAR, 8, '0') AS entry_id, round(l_discount * 100)::INT % 3 AS share, round(l_tax * 100)::INT AS tax, l_quantity::INT AS q, 'r' || (l_orderkey % 50) AS rule_id, 'p' || (l_partkey % 9) AS other_id,
          CASE l_linestatus WHEN 'O' THEN 'per_charge' ELSE 'per_transaction' END AS unit, CASE WHEN l_linenumber < 3 THEN 'calculable_rule' WHEN l_linenumber < 5 THEN 'non_calculable' ELSE 'informational' END AS status, l_tax AS confidence,
          l_shipinstruct AS said, 'part ' || (l_partkey % 4) AS part, 'line ' || l_linenumber AS note FROM (SELECT *, 'm' || (l_orderkey % 7) AS l_shipmode, 'said ' || ((l_suppkey + l_linenumber) % 3) AS l_shipinstruct FROM lineitem)),
        own AS (SELECT *, supplier || '|' || product_id || '|' || coalesce(variant_id, '-') AS sel, list_sort(list_filter([CASE WHEN q > 6 THEN 's' || share END, CASE WHEN tax > 2 THEN 'a' || (tax % 2) END, CASE WHEN q > 30 THEN 'm' END], lambda x: x IS NOT NULL)) AS parts FROM raw),
        sets AS (SELECT sel, parts, unit, min(entry_id) AS key, arg_min(status, (CASE status WHEN 'calculable_rule' THEN 0 WHEN 'non_calculable' THEN 2 ELSE 3 END, entry_id)) AS status, max(confidence) AS confidence, count(*) AS n_rules,
          arg_min(CASE WHEN q > 6 THEN share END, entry_id) AS percentage FROM own GROUP BY sel, parts, unit){_OWNERS},
        roots AS (SELECT s.*, (status = 'calculable_rule' OR (status = 'non_calculable' AND len(parts) > 0)) AS is_candidate, sel LIKE '%|unspecified|%' AS loose FROM sets s WHERE (sel, key) NOT IN (SELECT (sel, key) FROM taken)),
        counted AS (SELECT *, count(*) OVER w AS n, count(*) FILTER (is_candidate) OVER w AS fees, min(key) OVER w AS least, min(key) FILTER (is_candidate) OVER w AS fee FROM roots WINDOW w AS (PARTITION BY sel)),
        kinds AS (SELECT *, CASE WHEN loose AND n > 1 THEN 'loose' WHEN fees > 1 THEN 'conflict' ELSE 'plain' END AS kind, CASE WHEN loose AND n > 1 THEN least WHEN fees > 1 THEN key ELSE coalesce(fee, least) END AS taker FROM counted),
        placed AS (SELECT s.sel, s.parts, s.unit, k.taker, list_concat([CASE WHEN k.key = k.taker THEN '' ELSE k.key END], coalesce(e.path, [])) AS path
                   FROM sets s LEFT JOIN ends e ON e.sel = s.sel AND e.key = s.key JOIN kinds k ON k.sel = s.sel AND k.key = coalesce(e.root, s.key)),
        items AS (SELECT o.sel, taker, path, entry_id, rule_id, unnest([{{'kind': 'e', 'item': entry_id, 'at': 0, 'told': ''}}, {{'kind': 'e', 'item': other_id, 'at': 1, 'told': ''}}, {{'kind': 't', 'item': said, 'at': 0, 'told': ''}}, {{'kind': 't', 'item': part, 'at': 1, 'told': ''}},
                    {{'kind': 'r', 'item': rule_id, 'at': 0, 'told': ''}}, {{'kind': 'f', 'item': said, 'at': 0, 'told': entry_id}}, {{'kind': 'p', 'item': part, 'at': 0, 'told': ''}}, {{'kind': 'v', 'item': entry_id, 'at': 0, 'told': ''}}, {{'kind': 'n', 'item': note, 'at': 0, 'told': ''}}]) AS x
                  FROM own o JOIN placed p ON p.sel = o.sel AND p.parts = o.parts AND p.unit = o.unit),
        once AS (SELECT sel, taker, x.kind AS kind, x.item AS item, min((path, entry_id, rule_id, x.at)) AS place, arg_min(x.told, (path, entry_id, rule_id, x.at)) AS told FROM items GROUP BY sel, taker, x.kind, x.item),
        lists AS (SELECT sel, taker, string_agg(item, ',' ORDER BY place) FILTER (kind = 'e') AS entry_ids, string_agg(item, ',' ORDER BY place) FILTER (kind = 't') AS source_texts, string_agg(item, ',' ORDER BY place) FILTER (kind = 'r') AS rule_ids,
                    string_agg(item || '=' || told, ',' ORDER BY place) FILTER (kind = 'f') AS fragments, string_agg(item, ',' ORDER BY place) FILTER (kind = 'p') AS phrases, string_agg(item, ',' ORDER BY place) FILTER (kind = 'v') AS evidence_ids, string_agg(item, ',' ORDER BY place) FILTER (kind = 'n') AS notes
                  FROM once GROUP BY sel, taker)
        SELECT split_part(k.sel, '|', 1)::BIGINT AS supplier, split_part(k.sel, '|', 2) AS product_id, nullif(split_part(k.sel, '|', 3), '-') AS variant_id, key AS entry_id, n_rules, CASE kind WHEN 'loose' THEN 'informational' WHEN 'conflict' THEN 'conflict' ELSE status END AS status,
          (CASE kind WHEN 'plain' THEN confidence ELSE 0 END)::DECIMAL(6,2) AS confidence, is_candidate AND kind <> 'loose' AS is_candidate, CASE WHEN kind <> 'loose' THEN percentage::VARCHAR END AS percentage, CASE kind WHEN 'loose' THEN 'informational' ELSE unit END AS unit,
          (CASE kind WHEN 'loose' THEN 0 ELSE len(parts) END)::INT AS n_components, entry_ids, source_texts, rule_ids, fragments, phrases, evidence_ids, CASE kind WHEN 'conflict' THEN notes || ',{identities.CONFLICT_NOTE}' ELSE notes END AS notes
        FROM kinds k JOIN lists l ON l.sel = k.sel AND l.taker = k.key WHERE k.key = k.taker""",
}
