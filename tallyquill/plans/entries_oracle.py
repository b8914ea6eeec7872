"""DuckDB SQL for the queries over fee entries; keyword cascades are CASE expressions over the same fixed tables."""

from __future__ import annotations

import re

from tallyquill import tables
from tallyquill.plans.entries import COUNTRIES, EVIDENCE, PATHS, PHRASES


def _text(x: object) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_text(w) for w in words) + "]"


def _has(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, {_text(w)})" for w in words) + ")"


def _test(column: str, key) -> str:
    if isinstance(key, re.Pattern):
        return f"regexp_matches({column}, '{key.pattern}')"
    if isinstance(key, frozenset):
        return "(" + " AND ".join(f"contains({column}, '{k}')" for k in sorted(key)) + ")"
    return _has(column, (key,) if isinstance(key, str) else key)


def _first(column: str, table) -> str:
    return "CASE " + " ".join(f"WHEN {_test(column, k)} THEN '{v}'" for k, v in table) + " END"


def _named(words) -> str:
    return "|".join(w.replace("_", " ") for w in sorted(words, key=lambda w: (-len(w), w)))


_LINES = "list_filter(list_transform(string_split(evidence, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
_UNIT = "|".join(re.escape(c) for c in sorted({*tables.CURRENCIES, *tables.SYMBOLS}, key=lambda c: (-len(c), c)))
_IS_PRICE = rf"(lower({{0}}) IN ({_list(tables.PRICE_LINES)[1:-1]}) OR regexp_matches({{0}}, '(?i)^(?:{_UNIT})?\s*[\d\s,.]*\s*(?:{_UNIT})?\s*(?:per)?$'))"
_NUMBER = r"\d+(?:\.\d+)?"

_ENTRIES = f"""e AS (SELECT p_partkey::VARCHAR AS entry_id, (p_partkey / 60)::INT AS _x, (p_partkey // 60)::VARCHAR AS url, (p_partkey % 60)::INT AS source_order,
      string_split({_list(PATHS)}[(p_partkey // 7) % {len(PATHS)} + 1], '|') AS path_list, {_list(p[0] for p in PHRASES)}[p_partkey * 5 % {len(PHRASES)} + 1] AS text,
      {_list(EVIDENCE)}[(p_partkey // 11) % {len(EVIDENCE)} + 1] AS evidence, {_list(COUNTRIES)}[(p_partkey // 60) % {len(COUNTRIES)} + 1] AS country,
      {_list(p[1] for p in PHRASES)}[p_partkey * 5 % {len(PHRASES)} + 1] AS pct, {_list(p[2] for p in PHRASES)}[p_partkey * 5 % {len(PHRASES)} + 1] AS amount, {_list(p[3] for p in PHRASES)}[p_partkey * 5 % {len(PHRASES)} + 1] AS currency,
      {_list(p[4] for p in PHRASES)}[p_partkey * 5 % {len(PHRASES)} + 1] AS parsed, {_list(p[5] for p in PHRASES)}[p_partkey * 5 % {len(PHRASES)} + 1] AS n_tokens FROM part),
    t AS (SELECT *, lower(text) AS low, lower(array_to_string(path_list, ' ')) AS path, lower(evidence) AS ev, path_list[-1] AS heading, pct IS NOT NULL OR amount IS NOT NULL AS has_fee FROM e),
    a AS (SELECT *, path || ' ' || low AS near, path || ' ' || low || ' ' || ev AS everything FROM t)"""

_REGION = "list_sort(list_filter([" + ", ".join(
    f"{{'at': CASE WHEN regexp_matches(near, '{(p := pattern.replace('(?! exchange)', ''))}') THEN length(regexp_extract(near, '^(.*?)(?:{p})', 1)) ELSE -1 END, 'k': {k}, 'v': '{v}'}}" for k, (pattern, v) in enumerate(tables.CARD_REGIONS)
) + "], lambda x: x.at >= 0))[1].v"
_METHOD_NAME = rf"\b({_named(tables.METHODS)})s?\b"
_HEAD = "array_to_string(list_filter(string_split(low, ' '), lambda w: w <> '')[1:6], ' ')"
_LISTED = f"{_list(m.replace('_', ' ') for m in tables.METHODS)}"
_METHOD = rf"""CASE WHEN contains(low || ' ' || path, 'tap to pay') THEN 'tap_to_pay'
      WHEN len(string_split(regexp_extract({_HEAD}, '^(.*?){_METHOD_NAME}', 1), ' ')) <= 2 AND regexp_matches({_HEAD}, '{_METHOD_NAME}') AND len(list_filter(string_split(regexp_extract({_HEAD}, '^(.*?){_METHOD_NAME}', 1), ' '), lambda w: w <> '')) <= 1
        THEN CASE WHEN regexp_extract({_HEAD}, '{_METHOD_NAME}', 1) = 'terminal' AND contains(low, 'card') THEN 'card' ELSE replace(regexp_extract({_HEAD}, '{_METHOD_NAME}', 1), ' ', '_') END
      WHEN starts_with(trim(low), '+') AND regexp_matches(low, '\b(?:for|of|per|optional)\s+({_named(tables.METHODS)})s?\b') THEN replace(regexp_extract(low, '\b(?:for|of|per|optional)\s+({_named(tables.METHODS)})s?\b', 1), ' ', '_')
      WHEN regexp_extract(everything, '{_METHOD_NAME}', 1) = 'terminal' AND contains(everything, 'card') THEN 'card'
      ELSE nullif(replace(regexp_extract(everything, '{_METHOD_NAME}', 1), ' ', '_'), '') END"""
_CHANNEL = f"CASE WHEN {_has('everything', ('terminal', 'in-person', 'in person', 'tap to pay', 'reader'))} THEN 'in_person' WHEN {_has('everything', ('online', 'checkout', 'payment link', 'card', 'payment', 'wallet'))} THEN 'online' END"
_STARTS = [(re.compile("|".join(rf"\b{re.escape(w)}" for w in words)), product) for words, product in tables.PRODUCT_WORDS]
_OTHER_METHODS = [m.replace("_", " ") for m in tables.METHODS if m not in ("card", "terminal")]
_PRODUCT = f"""coalesce(CASE WHEN NOT {_has('lower(heading)', _OTHER_METHODS)} THEN {_first('lower(heading)', _STARTS)} END,
      CASE method WHEN 'card' THEN CASE WHEN coalesce(channel = 'in_person', false) OR {_has('path', ('terminal', 'tap to pay', 'in-person', 'in person'))} THEN 'terminal' ELSE 'payments' END WHEN 'terminal' THEN 'terminal' WHEN 'tap_to_pay' THEN 'terminal' ELSE method END,
      {_first('everything', tables.PRODUCT_WORDS)}, CASE WHEN contains(near, 'card') OR (contains(near, 'payment') AND NOT contains(near, 'payment method')) OR (has_fee AND contains(near, 'payment methods')) THEN 'payments'
        WHEN contains(near, 'ach') THEN 'ach_direct_debit' WHEN contains(near, 'sepa') THEN 'sepa_direct_debit' END, 'unspecified')"""
_DISPUTE = "(" + " OR ".join(f"(contains(low, '{w}') AND regexp_matches(string_split(low, '{w}')[1], '[0-9][^0-9]{{0,40}}$'))" for w in tables.DISPUTE_WORDS) + ")"
_CARD = "product IN ('payments', 'terminal')"
_METHODS_SQL = ", ".join(f"'{m}'" for m in (*tables.METHODS, "payments", "terminal"))
_PRODUCTS = f"""m AS (SELECT *, {_METHOD} AS method, {_CHANNEL} AS channel, {_DISPUTE} AS dedicated FROM a), p AS (SELECT *, {_PRODUCT} AS product FROM m)"""
_WIDE = f"CASE WHEN has_fee AND {_has('low', tables.FEE_TERMS)} THEN low ELSE low || ' ' || ev END"
_HOW = rf"""CASE WHEN {_has('wide', ('contact sales', 'custom quote'))} THEN 'custom' WHEN regexp_matches(wide, 'start(s|ing) (at|from)') THEN 'from' WHEN regexp_matches(wide, '\b(?:cap|maximum|max)\b') THEN 'range'
      WHEN contains(wide, 'up to') AND NOT regexp_matches(wide, 'up to \d+\s?(month|day|week|year)') THEN 'range' WHEN regexp_matches(wide, '\b(?:minimum|min)\b') THEN 'from' WHEN {_has('wide', ('included', 'no additional fee'))} THEN 'included'
      WHEN {_has('wide', ('free', 'no fee'))} THEN 'free' WHEN {_has('wide', ('overage', 'allotment', 'volume pricing', 'custom package'))} THEN 'custom'
      WHEN parsed = 'custom' AND has_fee AND {_has('wide', tables.FEE_TERMS)} THEN 'exact' ELSE parsed END"""
_ROLES = rf"""w AS (SELECT *, {_WIDE} AS wide FROM a), h AS (SELECT *, {_HOW} AS how FROM w),
    r AS (SELECT *, CASE WHEN how = 'range' OR regexp_matches(wide, '\b(?:cap|capped|maximum|max)\b') THEN 'maximum' WHEN regexp_matches(wide, '\b(?:minimum|min)\b') THEN 'minimum'
      WHEN how = 'included' OR contains(wide, 'no additional') THEN 'included' WHEN how = 'free' THEN 'free' WHEN how = 'custom' OR contains(wide, 'contact sales') THEN 'custom'
      WHEN how = 'from' OR regexp_matches(wide, 'starting (at|from)') THEN 'from' WHEN contains(wide, 'uplift') THEN 'base' WHEN (starts_with(text, '+') OR (n_tokens = 1 AND contains(text, '+'))) AND NOT contains(low, 'tap to pay') THEN 'surcharge' ELSE 'base' END AS role FROM h)"""
_MODIFIER = "CASE WHEN has_fee THEN role IN ('maximum', 'minimum') AND pct IS NULL ELSE role IN ('maximum', 'minimum', 'included', 'free') AND NOT contains(low, 'tap to pay') END"
_LINE_KIND = "CASE WHEN contains(x, 'api integration') OR contains(x, 'payment apis') THEN 'api' WHEN contains(x, 'no-code integration') OR contains(x, 'no code integration') THEN 'no_code' END"
_STOP = f"list_position(list_transform(lines, lambda x: contains(x, number) AND {_IS_PRICE.format('x')}), true)"
_MARKETING = f"(({_has('low', tables.MAGNITUDES)} AND {_has('low', ('customers', 'users', 'addressable', 'process'))}) OR (NOT {_has('low', tables.FEE_TERMS)} AND {_has('low', tables.MARKETING_TERMS)}))"
_TOLD = " OR ".join("(" + " AND ".join(f"contains(around, '{w.format(provider='the provider')}')" for w in row) + ")" for row in tables.NO_FEES)
_TABLE_NAMES = _named({*tables.METHODS, *tables.NETWORK_NAMES})

SQL: dict[str, str] = {
    "t05_t09_forms": f"WITH {_ENTRIES} SELECT entry_id, text AS source_text, pct AS percentage, amount, currency, parsed AS exactness, n_tokens::INT AS n_tokens FROM t",
    "d01_d05_cards": rf"""WITH {_ENTRIES}, r AS (SELECT *, coalesce({_REGION}, CASE WHEN NOT contains(near, 'tap to pay') AND country IS NOT NULL AND contains(near, 'card') THEN 'domestic' END) AS region FROM a),
        l AS (SELECT *, list_sort(list_distinct(list_filter(list_transform(regexp_split_to_array(regexp_extract(text, '^([A-Za-z][A-Za-z\s,]+(?:,\s*and\s+)?[A-Za-z])', 1), ',|\band\b'),
            lambda x: map {{{', '.join(f"'{k}': '{v}'" for k, v in tables.CUSTOMER_COUNTRIES.items())}}}[lower(trim(x))]), lambda x: x IS NOT NULL))) AS codes FROM r)
        SELECT entry_id, region, CASE WHEN region IS NULL THEN CASE WHEN country IS NOT NULL THEN 'domestic' END
            WHEN region = 'domestic' OR (country IN ({_list(tables.EEA)[1:-1]}) AND region = 'eea') OR (country = 'GB' AND region = 'uk') OR region = lower(country) THEN 'domestic' ELSE 'international' END AS origin,
          CASE WHEN regexp_matches(low, 'card|tier|scheme') THEN {_first('low', tables.CARD_TIERS)} END AS tier,
          CASE WHEN regexp_matches(low, '\bdebit\s+cards?\b|\bcards?\s+debit\b') THEN 'debit' WHEN regexp_matches(low, '\bcredit\s+cards?\b|\bcards?\s+credit\b') OR (country = 'IN' AND contains(low, 'card') AND NOT contains(low, 'debit') AND regexp_matches(low, 'issued (in|outside)')) THEN 'credit' END AS card_type,
          coalesce(array_to_string(list_filter([CASE WHEN {_has('low', ('american express', 'amex'))} THEN 'amex' END, CASE WHEN contains(low, 'mastercard') THEN 'mastercard' END, CASE WHEN contains(low, 'visa') THEN 'visa' END], lambda x: x IS NOT NULL), ','), '') AS networks,
          CASE WHEN len(codes) > 0 AND NOT coalesce(len(codes) = 1 AND codes[1] = country, false) THEN array_to_string(codes, ',') END AS countries FROM l""",
    "d06_d08_d18_terms": rf"""WITH {_ENTRIES}, {_PRODUCTS}, n AS (SELECT *, string_split(ev, chr(10)) AS lines, nullif(regexp_extract(text, '{_NUMBER}'), '') AS number FROM p),
        i AS (SELECT *, list_position(list_transform(lines, lambda x: contains(x, number)), true) AS pos, list_transform(lines, lambda x: {_LINE_KIND}) AS kinds,
          list_transform(lines, lambda x: coalesce({_LINE_KIND}, CASE WHEN contains(x, 'billing, checkout, invoicing, and payment links') OR contains(x, 'taxes calculated and collected') THEN 'no_code' END)) AS more FROM n)
        SELECT entry_id, coalesce(CASE WHEN method = 'link' THEN {_first('low', tables.LINK_VARIANTS)} END, {_first('low', tables.AFFIRM_VARIANTS)}) AS variant, {_first('low', tables.PRICING_TIERS)} AS tier,
          {_first('low', tables.CONTRACTS)} AS contract, {_first("(path || ' ' || low)", tables.PRICING_PLANS)} AS plan,
          coalesce(CASE WHEN regexp_matches(low, 'no[- ]code') THEN 'no_code' WHEN {_has('low', ('api integration', 'payment apis'))} THEN 'api' END, CASE WHEN pos > 0 THEN list_filter(kinds[1:pos], lambda x: x IS NOT NULL)[-1] END, list_filter(more, lambda x: x IS NOT NULL)[1]) AS integration_type,
          CASE WHEN product = 'disputes' OR (dedicated AND {_has('low', ('disputed payment', 'lost disputes', 'smart dispute'))}) THEN 'per_dispute' WHEN dedicated AND contains(low, 'failed payment') THEN 'per_attempt'
            ELSE coalesce({_first('low', tables.UNITS)}, CASE WHEN method IS NOT NULL OR product IN ({_list((*tables.DEBIT_PRODUCTS, *tables.METHOD_PRODUCTS))[1:-1]}) THEN 'per_transaction' END,
              CASE product {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in tables.PRODUCT_UNITS.items())} END) END AS unit FROM i""",
    "d09_d15_products": f"""WITH {_ENTRIES}, {_PRODUCTS} SELECT entry_id, method, channel, product, dedicated, {_CARD} AS is_card, product IN ({_METHODS_SQL}) AS is_method,
        contains(low, 'for international transactions') AND (contains(low, '+') OR contains(low, 'surcharge')) AS abroad FROM p""",
    "d16_d19_d22_roles": f"WITH {_ENTRIES}, {_ROLES} SELECT entry_id, how AS exactness, role, {_MODIFIER} AS is_modifier FROM r",
    "d21_components": rf"""WITH {_ENTRIES}, {_ROLES}, k AS (SELECT *, CASE WHEN role = 'surcharge' THEN 'fixed_surcharge' WHEN {_has("(role || ' ' || low)", tables.AMOUNT_ROLES[0][0])} THEN 'maximum_fee'
            WHEN {_has("(role || ' ' || low)", tables.AMOUNT_ROLES[1][0])} THEN 'minimum_fee' WHEN role IN ('included', 'free') THEN role WHEN role = 'custom' THEN 'custom_pricing' ELSE 'fixed_amount' END AS kind,
          CASE length(split_part(pct, '.', 2)) WHEN 0 THEN (pct::DECIMAL(10,0)::INT * 100)::VARCHAR WHEN 1 THEN ((pct::DECIMAL(10,1) * 100)::DECIMAL(12,1))::VARCHAR ELSE ((pct::DECIMAL(10,2) * 100)::DECIMAL(12,2))::VARCHAR END AS points FROM r)
        SELECT entry_id, CASE WHEN n_tokens = 0 THEN CASE WHEN role IN ('included', 'free') THEN role WHEN role = 'custom' THEN 'custom_pricing' ELSE 'non_calculable' END || ':::'
          ELSE concat_ws(';', kind || ':' || amount || ':' || currency || ':' || trunc(amount::DECIMAL(12,2) * 100)::INT::VARCHAR, CASE WHEN role = 'surcharge' THEN 'percentage_surcharge' ELSE 'percentage' END || ':' || pct || '::' || points) END AS components FROM k""",
    "t18_t22_headings": rf"""WITH {_ENTRIES}, n AS (SELECT *, nullif(regexp_extract(text, '{_NUMBER}'), '') AS number, {_LINES} AS lines FROM t), s AS (SELECT *, {_STOP} AS stop FROM n),
        h AS (SELECT *, CASE WHEN number IS NOT NULL THEN list_filter(CASE WHEN stop > 0 THEN lines[1:stop - 1] ELSE lines END, lambda x: NOT {_IS_PRICE.format('x')} AND len(string_split(x, ' ')) <= 8)[-1] END AS nearest FROM s)
        SELECT entry_id, nearest, CASE WHEN ends_with(low, ' per') THEN list_filter(list_transform(string_split(lower(nearest), ' '), lambda w: regexp_replace(w, '[^a-z0-9]', '', 'g')), lambda w: list_contains({_list(tables.UNIT_NOUNS)}, w))[-1] END AS noun,
          has_fee, trim(low) = '' OR {_IS_PRICE.format('low')} AS is_price FROM h""",
    "f01_f08_evidence": rf"""WITH {_ENTRIES}, b AS (SELECT *, low || ' ' || ev AS around FROM t), s AS (SELECT *, {_has('low', tables.STATISTICS)} AND has_fee AS share FROM b)
        SELECT entry_id, share OR (NOT ({_has('around', tables.FEE_TERMS)} AND has_fee) AND ({_TOLD} OR (starts_with(low, 'included:') AND NOT has_fee)
            OR (contains(around, 'pci compliant') AND NOT regexp_matches(around, '\d+(?:\.\d+)?%?\s*(?:per|month|year|transaction)')))) AS statistic, {_MARKETING} AS marketing, share, {_has('low', tables.PROMOTIONS)} AS promotion,
          {_has('low', tables.FEE_TERMS)} AS fee_phrase, regexp_matches(low, '(?:\d\s*%|[A-Za-z]?[€£$¥₹₩]\s*\d|\d\s*[€£$¥₹₩])') AND regexp_matches(low, '\b(?:{_TABLE_NAMES})\b') AS table_value FROM s""",
    "t21_account_country": "SELECT p_partkey, ['DE', 'GB', 'US', NULL, 'BE'][p_partkey % 5 + 1] AS country FROM part",
}
