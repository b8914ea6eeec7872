"""DuckDB SQL with the rows of each query that SQL can express."""

from __future__ import annotations

from tallyquill import tables
from tallyquill.plans import entries_oracle, folds_oracle, provenance, published, sites

_PHRASE = "(round(l_discount * 100)::INT || ',' || lpad((round(l_tax * 100)::INT)::VARCHAR, 2, '0') || '% + ' || l_quantity::INT || '.25 €')"
_FEES = f"(SELECT *, {_PHRASE} AS phrase, round(l_discount * 100)::INT || '.' || lpad((round(l_tax * 100)::INT)::VARCHAR, 2, '0') AS share FROM lineitem)"
_KEY = "l_orderkey, l_linenumber, l_partkey"
_TURNS = "PARTITION BY conv_id ORDER BY turn, role, text"
_HALF = "TIMESTAMP '1996-01-01'"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _first(column: str, table: dict[str, str]) -> str:
    return "CASE " + " ".join(rf"WHEN regexp_matches({column}, '\b{k}\b') THEN '{v}'" for k, v in table.items()) + " END"


_WORDS = [*tables.EXACTNESS, "per charge", "if it is"]
_PARTED = f"(SELECT p_partkey, {_list(_WORDS)}[p_partkey % {len(_WORDS)} + 1] || ' ' || p_name AS phrase FROM part)"
_NAMES = [m.replace("_", " ") for m in tables.METHODS]
_METHOD_PHRASE = f"'Pay by ' || {_list(_NAMES)}[(p_partkey + 3) % {len(_NAMES)} + 1] || ' or ' || {_list(_NAMES)}[(p_partkey + 11) % {len(_NAMES)} + 1] || 's'"
_HEADERS = "['max-age=60', 'no-cache', 'public, max-age=86400', 'max-age=0', 'private'][event_id % 5 + 1]"
_AGE = "(1706659200 - floor(epoch(ts))::BIGINT)"
_STACKED = "['1% per card', '1% per card per month', '2 per bank per holder', '2 per bank per holder per month', '3 per charge per charge per charge'][p_partkey % 5 + 1]"
_CLEAN = "regexp_replace(regexp_replace(url, '#.*$', ''), '[?].*$', '')"
_ORIGIN = f"regexp_extract({_CLEAN}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*')"
_KEPT = f"list_sort(list_filter(string_split(CASE WHEN contains(regexp_replace(url, '#.*$', ''), '?') THEN regexp_replace(regexp_replace(url, '#.*$', ''), '^[^?]*[?]', '') ELSE '' END, '&'), lambda p: p <> '' AND NOT list_contains({_list(tables.TRACKING)}, lower(split_part(p, '=', 1)))))"
_NORMAL = f"lower({_ORIGIN}) || substr({_CLEAN}, length({_ORIGIN}) + 1) || CASE WHEN len({_KEPT}) > 0 THEN '?' || array_to_string({_KEPT}, '&') ELSE '' END"

_RULES = f"""halves AS (SELECT n_name AS country, l_partkey AS rule_id, (round(l_discount * 100)::INT)::VARCHAR AS percentage, (l_quantity::INT)::VARCHAR AS fixed_amount, l_returnflag AS fixed_currency,
        l_orderkey * 100 + l_linenumber AS pos, o_orderkey, o_orderdate < {_HALF} AS old
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN lineitem ON o_orderkey = l_orderkey)"""
_IDENTITY = """rules AS (SELECT l_partkey, l_returnflag, l_orderkey * 100 + l_linenumber AS entry_id, l_tax AS confidence, (round(l_discount * 100)::INT)::VARCHAR AS value,
        CASE WHEN l_linestatus = 'O' THEN 'calculable_rule' WHEN l_quantity > 25 THEN 'non_calculable' ELSE 'informational' END AS status FROM lineitem),
      told AS (SELECT *, status <> 'informational' AS is_candidate FROM rules)"""
_NATION_RULES = """r AS (SELECT n_name AS country, CASE WHEN l_linenumber < 6 THEN lower(l_returnflag || '_' || l_linestatus) END AS method, l_returnflag || l_linestatus AS display,
        substr(sha256(l_partkey || '|' || l_suppkey), 1, 16) AS rule_id, CASE WHEN l_tax > 0.06 THEN 'conflict' WHEN l_tax > 0.03 THEN 'classified' ELSE 'informational' END AS status
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

SQL: dict[str, str] = {
    **entries_oracle.SQL,
    **folds_oracle.SQL,
    **sites.SQL,
    **provenance.SQL,
    **published.SQL,
    "t02_t04_percentage": f"SELECT {_KEY}, phrase, share AS percentage, (share::DECIMAL(10,2) * 100)::DECIMAL(14,2)::VARCHAR AS basis_points FROM {_FEES}",
    "t03_parse_decimal": f"""SELECT {_KEY}, q || [',5', '.000,50', ',000.50', '.000', ',1234', ' 000', '.25.'][k + 1] AS written, q || ['.5', '000.50', '000.50', '000', '1234', '000', NULL][k + 1] AS number
        FROM (SELECT *, (l_quantity::INT)::VARCHAR AS q, l_linenumber % 7 AS k FROM lineitem)""",
    "t05_t09_tokens": f"""SELECT {_KEY}, share AS percentage, q || '.25' AS amount, 'EUR' AS currency, 'exact' AS exactness, 2 AS n_tokens, substr(sha256('amount:' || q || '.25:EUR'), 1, 16) AS token_id
        FROM (SELECT *, (l_quantity::INT)::VARCHAR AS q FROM {_FEES})""",
    "t06_t07_exactness": f"""SELECT p_partkey, {_first('lower(phrase)', tables.EXACTNESS)} AS exactness,
        array_to_string(list_filter(['+', 'if', 'for', 'per'], lambda x: contains(lower(phrase), x)), ' ') AS operators FROM {_PARTED}""",
    "t11_minor_amount": f"""SELECT {_KEY}, c AS currency, (trunc((l_quantity::INT || '.259')::DECIMAL(20,6) * CASE c WHEN 'JPY' THEN 1 WHEN 'KWD' THEN 1000 ELSE 100 END)::BIGINT)::VARCHAR AS minor
        FROM (SELECT *, ['EUR', 'JPY', 'KWD'][l_linenumber % 3 + 1] AS c FROM lineitem)""",
    "t13_first_match": """SELECT p_partkey, CASE WHEN contains(t, 'promo') AND contains(t, 'steel') THEN 'promotion_steel' WHEN contains(t, 'promo') OR contains(t, 'economy') THEN 'promotion'
        WHEN regexp_matches(t, '^(large|medium)') THEN 'sized' WHEN contains(t, 'small') THEN 'small' WHEN contains(t, 'brass') OR contains(t, 'nickel') THEN 'metal' ELSE 'other' END AS product FROM (SELECT p_partkey, lower(p_type) AS t FROM part)""",
    "t15_t16_names": """SELECT p_partkey, array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i AND x <> ''), ' ') AS words, replace(lower(p_type), ' ', '_') AS snake
        FROM (SELECT *, string_split(lower(p_name || ' ' || p_type || ' ' || p_name), ' ') AS w FROM part)""",
    "t17_stacked_units": f"SELECT p_partkey, {_STACKED} AS phrase, p_partkey % 5 IN (2, 3) AS stacked FROM part",
    "t23_t24_identifiers": """SELECT p_partkey, substr(sha256(lower(trim(p_brand)) || '|' || lower(trim(p_type))), 1, 16) AS id, regexp_replace(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS method,
        upper(substr(p_name, 1, 2)) AS country, CASE WHEN regexp_matches(upper(substr(p_type, 1, 3)), '^[A-Z]{3}$') THEN upper(substr(p_type, 1, 3)) END AS currency, 'en-gb' AS locale FROM part""",
    "t25_market_share": f"""SELECT doc_id, coalesce(len(list_filter({_list(tables.MARKET_SHARE)}, lambda x: contains(lower(text), x))) > 0 OR regexp_matches(lower(text), '{tables.MARKET_SHARE_PATTERN}'), false) AS is_share FROM documents""",
    "t26_t27_methods": f"""WITH p AS (SELECT p_partkey, lower({_METHOD_PHRASE}) AS t FROM part), m AS (SELECT unnest({_list(tables.METHODS)}) AS method),
        f AS (SELECT p_partkey, method, length(regexp_extract(t, '^(.*?)\\b' || replace(method, '_', ' ') || 's?\\b', 1)) AS pos FROM p, m WHERE regexp_matches(t, '\\b' || replace(method, '_', ' ') || 's?\\b'))
        SELECT p_partkey, method, coalesce({' '.join(['CASE'] + [f"WHEN method IN ({', '.join(repr(x) for x in v)}) THEN '{k}'" for k, v in tables.FAMILIES.items()])} END, 'other') AS family
        FROM (SELECT p_partkey, arg_min(method, (pos, -length(method), method)) AS method FROM f GROUP BY p_partkey)""",
    "s04_s08_addresses": f"""SELECT page_id, {_NORMAL} AS normalized, regexp_replace(url, '[?#].*$', '') || '?Token=<redacted>&a=1' AS redacted,
        regexp_matches(lower({_ORIGIN}), '://([^/]*[.])?example[.]com$') AS allowed FROM pages""",
    "s07_cache_key": f"""SELECT page_id, sha256('{{"locale":"de-de","market":"DE","method":"GET","url":"' || {_NORMAL} || '","version":"1"}}') AS key FROM pages""",
    "s09_s10_freshness": f"""SELECT event_id, h AS header, age < 864000 AS by_age, age < 864000 AND CASE event_id % 5 WHEN 0 THEN age < 60 WHEN 1 THEN false WHEN 2 THEN age < 86400 WHEN 3 THEN false ELSE true END AS by_header
        FROM (SELECT event_id, {_HEADERS} AS h, {_AGE} AS age FROM events)""",
    "h01_heading_counts": r"""SELECT page_id, len(h) AS n_headings, list_max(list_transform(h, lambda x: x::INT)) AS deepest FROM (SELECT page_id, regexp_extract_all(html, '(?i)<h([1-6])[\s>]', 1) AS h FROM pages)""",
    "h10_h13_page_metadata": r"""SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title, lang AS html_lang, length(substr(html, 1, 2000))::INT AS evidence_chars,
        coalesce(CASE WHEN lang IN ('en', 'de') THEN NULL WHEN contains(lang, '-') THEN upper(string_split(lang, '-')[-1]) WHEN regexp_matches(lang, '^[a-z]{2}$') THEN upper(lang) END,
          nullif(upper(regexp_extract(lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)), '^/?(?:[a-z]{2}-)?([a-z]{2})(?:/pricing(?:/local-payment-methods)?)?/*$', 1)), '')) AS detected_market
        FROM (SELECT *, nullif(regexp_extract(html, '(?i)<html[^>]*\slang="([^"]*)"', 1), '') AS lang FROM pages)""",
    "j10_w03_nearest_before": f"""SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER ({_TURNS} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS asked_at,
        count(CASE WHEN role = 'user' THEN 1 END) OVER ({_TURNS} ROWS UNBOUNDED PRECEDING) AS group_no FROM conversations""",
    "w01_w04_carried_forward": f"SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN length(text)::INT END IGNORE NULLS) OVER ({_TURNS} ROWS UNBOUNDED PRECEDING) AS said FROM conversations",
    "w02_renumbered": "SELECT event_id, event_type, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1)::INT AS source_order FROM events",
    "w05_heading_paths": """WITH h AS (SELECT user_id, event_id, (event_id * 7 % 3 + event_id % 2 + 1)::INT AS level, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
        a AS (SELECT x.event_id, y.event_id AS above, y.pos FROM h x JOIN h y ON x.user_id = y.user_id AND y.pos <= x.pos AND (y.level < x.level OR y.pos = x.pos)
              WHERE NOT EXISTS (SELECT 1 FROM h z WHERE z.user_id = x.user_id AND z.pos > y.pos AND z.pos <= x.pos AND z.level <= y.level))
        SELECT user_id, event_id, level, path FROM h JOIN (SELECT event_id, string_agg(above, '>' ORDER BY pos) AS path FROM a GROUP BY event_id) USING (event_id)""",
    "w06_first_per_key": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n = 1",
    "a15_duplicates": "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents WHERE text IS NOT NULL) WHERE n > 1",
    "r01_r03_market_sets": f"""WITH w AS (SELECT DISTINCT o_custkey::VARCHAR AS country FROM orders WHERE o_orderdate < {_HALF}), n AS (SELECT DISTINCT o_custkey::VARCHAR AS country FROM orders WHERE o_orderdate >= {_HALF}),
        s AS (SELECT (SELECT count(*) FROM w) AS n, (SELECT count(*) FROM w WHERE country NOT IN (SELECT country FROM n)) AS lost)
        SELECT 'removed_market' AS kind, country, NULL::VARCHAR AS key, NULL::VARCHAR AS before, NULL::VARCHAR AS after FROM w WHERE country NOT IN (SELECT country FROM n)
        UNION ALL SELECT 'new_market', country, NULL, NULL, NULL FROM n WHERE country NOT IN (SELECT country FROM w)
        UNION ALL SELECT 'sharp_market_drop', NULL, NULL, n::VARCHAR, (n - lost)::VARCHAR FROM s WHERE n > 0 AND lost > 0.2 * n""",
    "r04_r08_market_counts": f"""WITH m AS (SELECT o_orderdate < {_HALF} AS old, o_custkey::VARCHAR AS country, count(DISTINCT o_orderkey) AS n_sections, count(*) AS n_entries, count(*) FILTER (l_quantity > 40) AS n_rules,
          CASE WHEN count(*) > 6 THEN 'complete' WHEN count(*) > 3 THEN 'partial' ELSE 'unclassified' END AS status FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
        b AS (SELECT o.country, o.n_sections AS s1, n.n_sections AS s2, o.n_entries AS e1, n.n_entries AS e2, o.n_rules AS r1, n.n_rules AS r2, o.status AS t1, n.status AS t2 FROM m o JOIN m n USING (country) WHERE o.old AND NOT n.old)
        SELECT 'sharp_section_drop' AS kind, country, NULL::VARCHAR AS key, s1::VARCHAR AS before, s2::VARCHAR AS after FROM b WHERE s1 > 0 AND s2 < 0.5 * s1
        UNION ALL SELECT 'sharp_entry_drop', country, NULL, e1::VARCHAR, e2::VARCHAR FROM b WHERE e1 > 0 AND e2 < 0.5 * e1
        UNION ALL SELECT 'lost_core_category', country, NULL, r1::VARCHAR, r2::VARCHAR FROM b WHERE r1 > 0 AND r2 = 0
        UNION ALL SELECT 'sharp_rule_drop', country, NULL, r1::VARCHAR, r2::VARCHAR FROM b WHERE r1 > 0 AND r2 > 0 AND r2 < 0.5 * r1
        UNION ALL SELECT 'classified_to_unclassified', country, NULL, t1, t2 FROM b WHERE t1 IN ('complete', 'partial') AND t2 = 'unclassified'""",
    "r09_r11_rule_values": f"""WITH {_RULES}, l AS (SELECT * FROM halves QUALIFY row_number() OVER (PARTITION BY old, country, rule_id ORDER BY pos DESC, percentage, fixed_amount, fixed_currency) = 1),
        b AS (SELECT o.country, o.rule_id::VARCHAR AS key, o.percentage AS p1, n.percentage AS p2, o.fixed_amount AS a1, n.fixed_amount AS a2, o.fixed_currency AS c1, n.fixed_currency AS c2 FROM l o JOIN l n USING (country, rule_id) WHERE o.old AND NOT n.old)
        SELECT 'large_percentage_change' AS kind, country, key, p1 AS before, p2 AS after FROM b WHERE CASE WHEN p1::DOUBLE = 0 THEN p2::DOUBLE <> 0 ELSE abs((p2::DOUBLE - p1::DOUBLE) / p1::DOUBLE) > 0.5 END
        UNION ALL SELECT 'large_fixed_change', country, key, a1, a2 FROM b WHERE a1::DOUBLE <> 0 AND abs((a2::DOUBLE - a1::DOUBLE) / a1::DOUBLE) > 0.5
        UNION ALL SELECT 'currency_changed', country, key, c1, c2 FROM b WHERE c1 IS DISTINCT FROM c2""",
    "r12_duplicate_rules": f"""WITH {_RULES} SELECT 'duplicate_identifier' AS kind, country, rule_id::VARCHAR AS key, NULL::VARCHAR AS before, NULL::VARCHAR AS after
        FROM (SELECT *, row_number() OVER (PARTITION BY country, rule_id ORDER BY pos) AS n FROM halves WHERE NOT old) WHERE n > 1""",
    "r13_r15_state_transitions": f"""WITH s AS (SELECT o_custkey AS country, CASE o_orderstatus WHEN 'F' THEN 'supported' WHEN 'O' THEN 'unsupported' ELSE 'transient' END AS state, o_orderdate < {_HALF} AS old FROM orders),
        w AS (SELECT DISTINCT country FROM s WHERE old AND state = 'supported'), n AS (SELECT country, bool_or(state = 'supported') AS a, bool_or(state = 'unsupported') AS b, bool_or(state = 'transient') AS c FROM s WHERE NOT old GROUP BY country)
        SELECT CASE WHEN b THEN 'supported_to_unsupported' WHEN c THEN 'supported_to_transient' ELSE 'discovered_to_missing' END AS kind, country FROM w LEFT JOIN n USING (country) WHERE NOT coalesce(a, false)""",
    "u05_changed_files": f"""WITH f AS (SELECT o_custkey AS path, o_orderdate < {_HALF} AS old, max(o_orderstatus || o_orderpriority) AS sha FROM orders GROUP BY ALL)
        SELECT path, CASE WHEN o.sha IS NULL THEN 'added' WHEN n.sha IS NULL THEN 'removed' ELSE 'changed' END AS change FROM (FROM f WHERE old) o FULL JOIN (FROM f WHERE NOT old) n USING (path) WHERE o.sha IS DISTINCT FROM n.sha""",
    "a01_a05_identities": f"""WITH {_IDENTITY}, g AS (SELECT l_partkey, l_returnflag, value, is_candidate, min(entry_id) AS first_at, arg_min(status, (CASE status WHEN 'calculable_rule' THEN 0 WHEN 'non_calculable' THEN 2 ELSE 3 END, entry_id, status)) AS status, max(confidence) AS confidence, list(entry_id ORDER BY entry_id) AS ids FROM told GROUP BY ALL),
        k AS (SELECT *, count(*) OVER s AS n, count(*) FILTER (is_candidate) OVER s AS fees, row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY first_at) AS place, list(ids) OVER (PARTITION BY l_partkey, l_returnflag ORDER BY first_at ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS every
              FROM g WINDOW s AS (PARTITION BY l_partkey, l_returnflag))
        SELECT l_partkey, l_returnflag, first_at, CASE WHEN fees > 1 THEN 'conflict' ELSE status END AS status, (CASE WHEN fees > 1 THEN 0 ELSE confidence END)::DECIMAL(6,2) AS confidence,
          array_to_string(CASE WHEN fees > 1 THEN ids ELSE flatten(every) END, ',') AS entry_ids FROM k WHERE fees > 1 OR (fees = 1 AND is_candidate) OR (fees = 0 AND place = 1)""",
    "j13_absorbed_subsets": """WITH s AS (SELECT l_suppkey, l_orderkey, l_orderkey % 12 AS month, list_sort(list(DISTINCT l_returnflag)) AS parts FROM lineitem GROUP BY ALL)
        SELECT l_suppkey, month, l_orderkey, array_to_string(parts, ',') AS parts FROM s x WHERE NOT EXISTS (SELECT 1 FROM s y WHERE y.l_suppkey = x.l_suppkey AND y.month = x.month AND list_has_all(y.parts, x.parts)
          AND (len(y.parts) > len(x.parts) OR (len(y.parts) = len(x.parts) AND y.l_orderkey > x.l_orderkey)))""",
    "a08_a11_coverage": f"""WITH {_IDENTITY}, t AS (SELECT *, CASE WHEN l_returnflag = 'R' AND l_partkey % 7 = 0 THEN 'conflict' ELSE status END AS s FROM told),
        r AS (SELECT l_partkey, count(*) AS rules, count(*) FILTER (s = 'calculable_rule') AS calculable_rules, count(*) FILTER (s = 'conflict') AS conflicts, count(*) FILTER (s = 'conflict' AND is_candidate) AS blocking_conflicts, count(*) FILTER (s <> 'conflict') AS authoritative FROM t GROUP BY l_partkey),
        e AS (SELECT p_partkey AS l_partkey, count(*) AS leftovers, count(*) FILTER (p_size >= 10) AS unresolved, count(*) FILTER (p_size > 20) AS numeric_fee_candidates FROM part GROUP BY p_partkey),
        b AS (SELECT l_partkey, coalesce(rules, 0) AS rules, coalesce(calculable_rules, 0) AS calculable_rules, coalesce(conflicts, 0) AS conflicts, coalesce(blocking_conflicts, 0) AS blocking_conflicts, coalesce(authoritative, 0) AS authoritative,
              coalesce(leftovers, 0) AS leftovers, coalesce(unresolved, 0) AS unresolved, coalesce(numeric_fee_candidates, 0) AS numeric_fee_candidates FROM r FULL JOIN e USING (l_partkey))
        SELECT *, CASE WHEN rules = 0 AND leftovers = 0 THEN 'unclassified' WHEN authoritative = 0 THEN 'partial' WHEN unresolved = 0 THEN 'complete' ELSE 'partial' END AS derivation,
          CASE WHEN authoritative = 0 AND (conflicts > 0 OR leftovers > 0) THEN 'partial' WHEN authoritative = 0 THEN 'unclassified' WHEN numeric_fee_candidates > 0 THEN 'partial' ELSE 'complete' END AS calculator FROM b""",
    # A fee line takes the label before it, if no other line but qualifiers stands between, and all qualifiers up to the next fee.
    "h17_fee_phrases": f"""WITH l AS (SELECT l_orderkey, CASE l_linenumber % 3 WHEN 0 THEN 'for domestic cards' WHEN 1 THEN phrase ELSE 'Dispute fee' END AS line, l_linenumber % 3 AS kind, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'for domestic cards' WHEN 1 THEN phrase ELSE 'Dispute fee' END) AS pos FROM {_FEES} AS f),
        g AS (SELECT *, count(*) FILTER (kind = 1) OVER (PARTITION BY l_orderkey ORDER BY pos) AS n FROM l), p AS (SELECT *, lag(kind) OVER (PARTITION BY l_orderkey ORDER BY pos) AS before FROM l WHERE kind <> 0),
        q AS (SELECT l_orderkey, n, count(*) AS n_qualifiers FROM g WHERE kind = 0 AND n > 0 GROUP BY l_orderkey, n), f AS (SELECT l_orderkey, pos, line, coalesce(before = 2, false) AS labelled FROM p WHERE kind = 1)
        SELECT f.l_orderkey, (g.n - 1)::INT AS entry_no, CASE WHEN labelled THEN 'Dispute fee ' ELSE '' END || f.line || repeat(' for domestic cards', coalesce(n_qualifiers, 0)::INT) AS phrase, 2 AS n_tokens
        FROM f JOIN g ON g.l_orderkey = f.l_orderkey AND g.pos = f.pos LEFT JOIN q ON q.l_orderkey = f.l_orderkey AND q.n = g.n""",
    "a12_method_catalog": f"""WITH {_NATION_RULES} SELECT method, 'other' AS family, min(display) AS display, string_agg(DISTINCT country, ',' ORDER BY country) AS countries, string_agg(DISTINCT 'https://x.com/' || country, ',' ORDER BY 'https://x.com/' || country) AS urls,
          sha256(string_agg(DISTINCT rule_id, ',' ORDER BY rule_id)) AS rule_ids, count(DISTINCT rule_id) AS n_rules FROM r WHERE method IS NOT NULL AND status <> 'conflict' GROUP BY method""",
    "a13_core_fees": f"""WITH {_NATION_RULES}, c AS (SELECT country, count(*) FILTER (status = 'classified') AS n, count(*) FILTER (status <> 'classified') AS u FROM r GROUP BY country)
        SELECT n_name AS country, coalesce(n, 0)::INT AS n_core, coalesce(u, 0) AS unclassified_count FROM nation LEFT JOIN c ON n_name = country""",
    "a14_market_index": """SELECT n_nationkey, sha256('{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}') AS content_hash FROM nation""",
    "a16_a17_identity_checks": f"""WITH {_NATION_RULES} SELECT rule_id, count(*) AS n, count(*) FILTER (status = 'conflict') AS conflicts, count(*) FILTER (status <> 'conflict') AS authoritative FROM r GROUP BY rule_id HAVING count(*) > 1 AND conflicts > 0 AND authoritative > 0""",
    "j05_used_and_dropped": "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS used FROM customer",
    "j06_missing_references": "SELECT doc_id, quality, toxic FROM labels WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documents d WHERE d.lang = 'en' AND d.doc_id = labels.doc_id)",
    "j09_v19_one_state": """WITH c AS (SELECT DISTINCT c_custkey::BIGINT AS id FROM customer), o AS (SELECT DISTINCT o_custkey::BIGINT AS id FROM orders), s AS (SELECT DISTINCT s_suppkey::BIGINT AS id FROM supplier), n AS (SELECT DISTINCT n_nationkey::BIGINT AS id FROM nation)
        SELECT id, c.id IS NOT NULL AS in_customer, o.id IS NOT NULL AS in_orders, s.id IS NOT NULL AS in_supplier, n.id IS NOT NULL AS in_nation,
          (c.id IS NOT NULL)::INT + (o.id IS NOT NULL)::INT + (s.id IS NOT NULL)::INT + (n.id IS NOT NULL)::INT AS n_states,
          (c.id IS NOT NULL)::INT + (o.id IS NOT NULL)::INT + (s.id IS NOT NULL)::INT + (n.id IS NOT NULL)::INT = 1 AS exactly_one
        FROM c FULL JOIN o USING (id) FULL JOIN s USING (id) FULL JOIN n USING (id)""",
    "v01_v05_rule_checks": f"""WITH f AS (SELECT *, l_linenumber % 2 = 0 AS eur FROM lineitem)
        SELECT {_KEY}, 'minor_amount' AS rule FROM f WHERE (l_quantity * 100)::INT <> CASE WHEN eur THEN l_quantity::INT * 100 ELSE l_quantity::INT END
        UNION ALL SELECT {_KEY}, 'basis_points' FROM f WHERE round(l_tax * 10000)::INT <> round(l_discount * 100)::INT * 100
        UNION ALL SELECT {_KEY}, 'contradictory' FROM f WHERE l_discount > 0 AND l_linenumber = 3
        UNION ALL SELECT {_KEY}, 'calculable' FROM f WHERE l_returnflag = 'A' OR 1 - l_discount * 4 < 0.7""",
    "v06_v15_semantic_checks": f"""WITH f AS (SELECT {_KEY}, l_quantity::INT AS q, l_partkey AS p, l_linenumber AS n FROM lineitem),
        t AS (SELECT *, CASE WHEN n < 7 THEN p % 9 END AS label, ['pricing_plan', 'card_region', 'dispute_state', 'payer', 'feature_enabled', 'transaction_type'][q % 6 + 1] AS d, ['custom', 'standard', 'won', 'customer', 'smart_disputes'][p % 5 + 1] AS v,
          ['payments', 'terminal', 'radar', 'smart_disputes', 'disputes'][(n + q) % 5 + 1] AS product, CASE WHEN n % 3 > 0 THEN ['card', 'terminal', 'radar'][q % 3 + 1] END AS method FROM f)
        SELECT {_KEY}, 'market_share' AS rule FROM t WHERE label = 7 AND q % 3 <> 0
        UNION ALL SELECT {_KEY}, 'pricing_plan' FROM t WHERE (label = 0 AND NOT (d = 'pricing_plan' AND v = 'custom')) OR (label = 1 AND NOT (d = 'pricing_plan' AND v = 'standard'))
        UNION ALL SELECT {_KEY}, 'addon_variant' FROM t WHERE product IN ('radar', 'smart_disputes') AND q % 2 = 0
        UNION ALL SELECT {_KEY}, 'addon_product' FROM t WHERE (label = 2 AND product <> 'radar') OR label IN (3, 8) OR (label = 6 AND product <> 'smart_disputes')
        UNION ALL SELECT {_KEY}, 'smart_disputes' FROM t WHERE product = 'smart_disputes'
        UNION ALL SELECT {_KEY}, 'exactness' FROM t WHERE label = 4 AND n % 2 = 1
        UNION ALL SELECT {_KEY}, 'payer' FROM t WHERE label = 5 AND NOT (d = 'payer' AND v = 'customer')
        UNION ALL SELECT {_KEY}, 'method' FROM t WHERE method IS NOT NULL AND CASE product WHEN 'payments' THEN method <> 'card' WHEN 'terminal' THEN method = 'radar' ELSE method <> product END
        UNION ALL SELECT {_KEY}, 'dispute_unit' FROM t WHERE p % 2 = 0 AND product NOT IN ('disputes', 'smart_disputes') AND NOT (d IN ('dispute_state', 'transaction_type') AND v = 'won')
        UNION ALL SELECT {_KEY}, 'card_condition' FROM t WHERE product NOT IN ('payments', 'terminal') AND d = 'card_region'
        UNION ALL SELECT {_KEY}, 'repeated_phrases' FROM t WHERE n % 2 = 0""",
    "x01_windowed_counts": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
}

_ROWS = "SELECT kind, country::VARCHAR AS country, key, before, after FROM"
_LINED = "FROM (SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS orders"
SQL["u04_all_changes"] = " UNION ALL ".join(f"{_ROWS} ({SQL[q].replace('FROM orders WHERE', _LINED + ' WHERE') if q == 'r01_r03_market_sets' else SQL[q]})" for q in ("r01_r03_market_sets", "r04_r08_market_counts", "r09_r11_rule_values", "r12_duplicate_rules"))
SQL["u04_all_changes"] += f" UNION ALL SELECT kind, country::VARCHAR, NULL, NULL, NULL FROM ({SQL['r13_r15_state_transitions']})"
