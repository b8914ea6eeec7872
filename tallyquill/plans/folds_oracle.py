"""SQL of the ordered folds over entries: what a row takes from the one before it, its variant, and the base it joins.

The columns that a row's own wording gives come from the SQL of the other queries; each fold is a recursion along a page.
"""

from __future__ import annotations

from tallyquill import tables
from tallyquill.plans.entries_oracle import _ENTRIES, _METHODS_SQL, _first, _has
from tallyquill.plans.entries_oracle import SQL as ENTRIES

_ROWS = f"""e0 AS (WITH {_ENTRIES} SELECT entry_id, url, source_order, path_list, low, has_fee FROM t),
    x AS (SELECT e0.*, row_number() OVER (PARTITION BY url ORDER BY source_order, entry_id) AS rn, p.product, CASE WHEN p.product IN ({_METHODS_SQL}) THEN p.method END AS taken_method, p.method, p.channel, c.region, c.origin, c.tier, c.card_type, w.plan, r.role, r.is_modifier
          FROM e0 JOIN ({ENTRIES['d09_d15_products']}) p USING (entry_id) JOIN ({ENTRIES['d01_d05_cards']}) c USING (entry_id) JOIN ({ENTRIES['d06_d08_d18_terms']}) w USING (entry_id) JOIN ({ENTRIES['d16_d19_d22_roles']}) r USING (entry_id))"""

_LOOSE = "((x.product = 'payments' AND i.product NOT IN ('payments', 'terminal')) OR (x.product = 'unspecified' AND i.product NOT IN ('payments', 'terminal', 'unspecified')))"
_NEW = f"CASE WHEN x.path_list = i.path_list AND x.is_modifier AND {_LOOSE} THEN i.product ELSE x.product END"
_TAKES = f"x.path_list = i.path_list AND (x.is_modifier OR {_NEW} = i.product)"

_INHERITED = f"""i AS (SELECT entry_id, url, rn, path_list, product, taken_method AS method, region, tier FROM x WHERE rn = 1
      UNION ALL SELECT x.entry_id, x.url, x.rn, x.path_list, {_NEW}, CASE WHEN {_TAKES} THEN coalesce(x.taken_method, i.method) ELSE x.taken_method END, CASE WHEN {_TAKES} THEN coalesce(x.region, i.region) ELSE x.region END,
        CASE WHEN {_TAKES} AND x.role NOT IN ('base', 'from', 'range') THEN coalesce(x.tier, i.tier) ELSE x.tier END FROM i JOIN x ON x.url = i.url AND x.rn = i.rn + 1)"""

_ABROAD = "(coalesce(x.origin = 'international', false) OR coalesce(x.region IN ('international', 'non-eea', 'non eea'), false))"
_CARDS = "coalesce('_' || x.card_type, '') || '_cards'"
_FEATURE = "CASE WHEN contains(lower(x.path_list[-1]), 'complete') THEN 'complete' WHEN contains(lower(x.path_list[-1]), 'basic') THEN 'basic' END"
_VARIANTS = rf"""v AS (SELECT x.entry_id, x.url, x.rn, i.product, i.method, i.region, i.tier, x.role, x.is_modifier, x.has_fee, array_to_string(CASE WHEN len(x.path_list) > 1 THEN x.path_list[1:len(x.path_list) - 1] ELSE x.path_list END, '|') AS above,
        CASE WHEN i.product IN ('three_d_secure', 'authorization_boost', 'radar', 'adaptive_pricing') AND x.plan IS NOT NULL THEN x.plan || '_pricing'
          WHEN i.product = 'smart_disputes' THEN CASE WHEN regexp_matches(x.low, '\b(won|win)\b') THEN 'won_dispute' WHEN contains(x.low, 'lost') THEN 'lost_dispute' ELSE 'standard' END
          WHEN i.product = 'tax' AND {_FEATURE} IS NOT NULL THEN {_FEATURE}
          WHEN i.product = 'payments' THEN CASE WHEN x.channel = 'in_person' THEN 'in_person' ELSE 'online' END || CASE WHEN x.tier = 'premium' THEN '_premium_cards' ELSE '_' || CASE WHEN {_ABROAD} OR coalesce(x.region = 'uk', false) THEN 'international' ELSE 'domestic' END || {_CARDS} END
          WHEN i.product = 'terminal' THEN CASE WHEN x.method = 'tap_to_pay' THEN 'tap_to_pay' ELSE CASE WHEN {_ABROAD} THEN 'international' ELSE 'domestic' END || {_CARDS} END ELSE 'standard' END AS variant
      FROM i JOIN x USING (entry_id))"""

# A group is a row's section above, product and variant, and whether its base is free or has a fee; the last that fits is taken.
_FITS = """g.groups[k].above = v.above AND g.groups[k].product = v.product AND (g.groups[k].variant = v.variant OR v.variant IN ('online_domestic_cards', 'domestic_cards', 'standard'))
        AND (g.groups[k].free OR g.groups[k].fee) AND NOT (v.role IN ('included', 'free') AND NOT g.groups[k].free)"""
_OWN = "{'above': v.above, 'product': v.product, 'variant': v.variant, 'free': v.role IN ('included', 'free'), 'fee': v.has_fee}"
_KEPT = "{'above': v.above, 'product': v.product, 'variant': v.variant, 'free': g.groups[f].free, 'fee': g.groups[f].fee}"
_GROUPS = f"""g AS (SELECT v.entry_id, v.url, v.rn, 0 AS group_no, [{_OWN}] AS groups FROM v WHERE rn = 1
      UNION ALL SELECT entry_id, url, rn, CASE WHEN f IS NULL THEN len(groups) ELSE f - 1 END, CASE WHEN f IS NULL THEN list_append(groups, own) ELSE list_concat(list_append(groups[1:f - 1], kept), groups[f + 1:]) END
        FROM (SELECT *, {_KEPT.replace('v.', '').replace('g.groups', 'groups')} AS kept FROM (SELECT v.*, g.groups, {_OWN} AS own, CASE WHEN v.is_modifier THEN list_max(list_filter(range(1, len(g.groups) + 1), lambda k: {_FITS})) END AS f FROM g JOIN v ON v.url = g.url AND v.rn = g.rn + 1)))"""

_WON = r"\b(won|win)\b"
_SNAKE = r"array_to_string(list_filter(regexp_split_to_array(lower(regexp_replace(nearest, '[^\w\s]', '', 'g')), '\s+'), lambda w: w <> ''), '_')"
_KIND = "CASE WHEN lost THEN 'dispute' WHEN contains(near, 'failed payment') THEN 'failed' WHEN contains(near, 'refund') THEN 'refund' END"
_STATE = rf"""CASE WHEN contains(near, 'won disputes') OR (disputed AND regexp_matches(low, '{_WON}')) THEN 'won' WHEN contains(near, 'lost disputes') OR (disputed AND regexp_matches(low, '\blost\b')) THEN 'lost'
      WHEN contains(near, 'received') AND disputed THEN 'received' WHEN contains(near, 'countered') OR (contains(near, 'respond') AND disputed) THEN 'countered' END"""
#: (dimension, value, where it holds) of every condition, in order; a null value makes none.
_CONDITIONS = [
    ("card_region", "region", "card"), ("card_origin", "origin", "card AND region IS NOT NULL"), ("card_tier", "tier", "card"), ("card_type", "card_type", "card"), ("card_network", "nullif(networks, '')", "card"), ("customer_country", "'GB'", "card AND region = 'uk'"),
    ("presentment_currency", "'USD,other'", f"card AND {_has('low', ('usd or other currency', 'other currency presentment'))}"), ("cross_border", "CASE WHEN far = 'domestic' THEN 'false' ELSE 'true' END", "NOT card AND far IS NOT NULL"), ("transaction_region", "far", "NOT card"),
    ("payment_method", "method", "card"), ("channel", "channel", "true"), ("currency_conversion_required", "'true'", "contains(near, 'currency conversion') AND (instr(low, 'domestic') = 0 OR instr(low, 'currency conversion') = 0 OR instr(low, 'domestic') > instr(low, 'currency conversion'))"),
    ("settlement_timing", _first("low", tables.SETTLEMENTS), "true"), ("pricing_plan", "plan", "true"),
    ("product_feature", f"CASE product WHEN 'radar' THEN CASE WHEN contains(heading, 'fraud teams') THEN 'fraud_teams' WHEN contains(heading, 'machine learning') THEN 'machine_learning' END WHEN 'tax' THEN CASE WHEN contains(heading, 'complete') THEN 'complete' WHEN contains(heading, 'basic') THEN 'basic' END WHEN 'disputes' THEN {_SNAKE} WHEN 'smart_disputes' THEN {_SNAKE} END", "true"),
    ("integration_type", "integration_type", "true"), ("payment_method_variant", "variant", "true"), ("pricing_tier", "pricing_tier", "true"), ("contract_length", "contract", "true"), ("customer_country", "countries", "true"), ("transaction_type", "'wire'", "wire"), ("payment_method_variant", "'wire'", "wire AND method IS NOT NULL"),
    ("feature_enabled", "'smart_disputes'", "disputes AND contains(near, 'smart dispute')"), ("payer", "'customer'", f"adaptive AND contains(near, 'customer') AND {_has('low', ('pay', 'present', 'bear'))}"), ("fee_type", "'conversion_fee'", "adaptive AND contains(near, 'conversion')"),
    ("dispute_state", "'lost'", "dedicated AND lost"), ("transaction_type", _KIND, "dedicated"), ("dispute_state", _STATE, "disputes OR product = 'refunds'"), ("transaction_type", "'dispute'", f"disputes AND NOT wire AND NOT (dedicated AND ({_KIND}) IS NOT NULL)"),
    ("recurring", "'true'", _has("path", ("recurring", "subscription"))), ("recurring", "'false'", _has("path", ("one-time", "one time"))), ("managed_payments", "'true'", "contains(path, 'managed payments')"), ("success", "'true'", _has("low", ("per successful transaction", "per successful charge"))),
    ("transaction_type", f"coalesce({_first('low', tables.TRANSACTIONS)}, CASE WHEN product = 'instant_payouts' THEN 'payout' END)", "true"), ("card_entry_mode", "'manual'", _has("low", ("manually entered", "manual entry", "moto"))),
]
_MORE = f"""c AS (SELECT i.entry_id, i.product, x.low, x.method, x.channel, x.region, x.origin, x.tier, x.card_type, x.plan, lower(x.path_list[-1]) AS heading, lower(array_to_string(x.path_list, ' ')) AS path, lower(array_to_string(x.path_list, ' ')) || ' ' || x.low AS near, d.networks, d.countries,
        w.variant, w.tier AS pricing_tier, w.contract, w.integration_type, n.nearest, p.dedicated, i.product IN ('payments', 'terminal') AS card, i.product IN ('smart_disputes', 'disputes') AS disputes, regexp_matches(x.low, 'wire (payment|transfer)') AS wire,
        CASE WHEN i.product NOT IN ('payments', 'terminal') AND x.region IS NOT NULL AND contains(x.low, 'for international transactions') AND (contains(x.low, '+') OR contains(x.low, 'surcharge')) THEN 'international' ELSE x.region END AS far
      FROM i JOIN x USING (entry_id) JOIN ({ENTRIES['d01_d05_cards']}) d USING (entry_id) JOIN ({ENTRIES['d06_d08_d18_terms']}) w USING (entry_id) JOIN ({ENTRIES['t18_t22_headings']}) n USING (entry_id) JOIN ({ENTRIES['d09_d15_products']}) p USING (entry_id)),
    k AS (SELECT *, product = 'adaptive_pricing' OR contains(near, 'adaptive pricing') AS adaptive, contains(near, 'dispute') AS disputed, {_has('near', ('lost disputes', 'disputed payment'))} AS lost FROM c)"""

SQL: dict[str, str] = {
    "d17_d26_conditions": f"""WITH RECURSIVE {_ROWS}, {_INHERITED}, {_MORE}
        SELECT entry_id, concat_ws(';', {', '.join(f"CASE WHEN {holds} THEN '{name}=' || ({value}) END" for name, value, holds in _CONDITIONS)}) AS conditions FROM k""",
    "w01_j10_groups": f"""WITH RECURSIVE {_ROWS}, {_INHERITED}, {_VARIANTS}, {_GROUPS}
        SELECT entry_id, url, product AS product_id, method AS payment_method, region AS card_region, tier AS card_tier, variant AS variant_id, is_modifier, group_no::INT AS group_no FROM v JOIN (SELECT entry_id, group_no FROM g) USING (entry_id)""",
}
