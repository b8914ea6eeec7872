"""Dimensions of a fee entry: columns over its own text, the headings above it and the evidence around it.

Functions take lower-cased texts where they are named `low`, `path` or `evidence`: the entry's own text, its section
path joined by spaces, and the text that follows it on the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyquill import tables
from tallyquill.functions.money import once
from tallyquill.functions.text import collapsed, earliest_method, first_listed_method, first_match, has_any, looked_up, snake_case

NUMBER = r"\d+(?:\.\d+)?"


def _in(value: Column, values: Iterable[str]) -> Column:
    return F.coalesce(value.isin(*values), F.lit(False))


def card_region(low: Column, method: Column, country: Column) -> Column:
    """Of the text and headings: the earliest marker; else domestic where cards are named and the country is known."""
    found = [F.struct(F.regexp_instr(low, F.lit(m)).alias("at"), F.lit(k).alias("k"), F.lit(v).alias("region")) for k, (m, v) in enumerate(tables.CARD_REGIONS)]
    first = F.array_min(F.filter(F.array(*found), lambda x: x["at"] > 0))["region"]
    tap = low.contains("tap to pay") | F.coalesce(method == "tap_to_pay", F.lit(False))
    return F.coalesce(first, F.when(~tap & country.isNotNull() & low.contains("card"), F.lit("domestic")))


def card_tier(low: Column) -> Column:
    return F.when(low.rlike("card|tier|scheme"), first_match(low, tables.CARD_TIERS))


def card_type(low: Column, country: Column) -> Column:
    """Debit or credit by wording; in India the general rate of cards issued in or outside it is the credit rate."""
    general = F.coalesce(country == "IN", F.lit(False)) & low.contains("card") & ~low.contains("debit") & low.rlike("issued (in|outside)")
    return F.when(low.rlike(r"\bdebit\s+cards?\b|\bcards?\s+debit\b"), "debit").when(low.rlike(r"\bcredit\s+cards?\b|\bcards?\s+credit\b") | general, "credit")


def card_networks(low: Column) -> Column:
    """Array of the networks that the text names, sorted; empty if none."""
    return F.array_compact(F.array(*(F.when(has_any(low, (w,) if isinstance(w, str) else w), F.lit(n)) for w, n in tables.NETWORKS)))


def card_origin(region: Column, country: Column) -> Column:
    """Domestic or international, seen from the account's country."""
    low = F.lower(region)
    home = (low == "domestic") | (_in(F.upper(country), tables.EEA) & low.isin("eea", "european economic area")) | F.coalesce((country == "GB") & (low == "uk"), F.lit(False)) | F.coalesce(low == F.lower(country), F.lit(False))
    return F.when(region.isNull(), F.when(country.isNotNull(), F.lit("domestic"))).when(home, "domestic").otherwise("international")


def customer_countries(text: Column, country: Column) -> Column:
    """Codes of a leading list of countries, sorted; null without any, or if the account's own is the only one."""
    listed = F.regexp_extract(text, r"^([A-Za-z][A-Za-z\s,]+(?:,\s*and\s+)?[A-Za-z])", 1)
    codes = F.transform(F.split(listed, r",|\band\b"), lambda p: looked_up(F.lower(F.trim(p)), tables.CUSTOMER_COUNTRIES))
    return once(F.array_sort(F.array_distinct(F.array_compact(codes))), lambda own: F.when((F.size(own) > 0) & ~F.coalesce((F.size(own) == 1) & (own[0] == country), F.lit(False)), own))


def method_variant(low: Column, method: Column) -> Column:
    return F.coalesce(F.when(method == "link", first_match(low, tables.LINK_VARIANTS)), first_match(low, tables.AFFIRM_VARIANTS))


def pricing_tier(low: Column) -> Column:
    return first_match(low, tables.PRICING_TIERS)


def contract_length(low: Column) -> Column:
    return first_match(low, tables.CONTRACTS)


def pricing_plan(path: Column, low: Column) -> Column:
    return first_match(F.concat_ws(" ", path, low), tables.PRICING_PLANS)


def _integration(line: Column, more: bool) -> Column:
    """`more` also takes what the products without code are called."""
    code = has_any(line, ("api integration", "payment apis"))
    none = has_any(line, ("no-code integration", "no code integration", *(("billing, checkout, invoicing, and payment links", "taxes calculated and collected") if more else ())))
    return F.when(code, F.lit("api")).when(none, F.lit("no_code"))


def integration_type(text: Column, evidence: Column) -> Column:
    """Own wording; else the heading nearest above the price in the evidence; else the evidence's first marker."""
    low = F.lower(text)
    own = F.when(low.rlike("no[- ]code"), "no_code").when(has_any(low, ("api integration", "payment apis")), "api")
    price = F.nullif(F.regexp_extract(text, NUMBER, 0), F.lit(""))

    def around(lines: Column) -> Column:
        at = F.array_min(F.array_compact(F.transform(lines, lambda x, i: F.when(x.contains(price), i + 1))))
        above = F.array_compact(F.transform(F.slice(lines, F.lit(1), F.coalesce(at, F.lit(0))), lambda x: _integration(x, more=False)))
        first = F.array_compact(F.transform(lines, lambda x: _integration(x, more=True)))
        return F.coalesce(F.try_element_at(above, F.lit(-1)), F.try_element_at(first, F.lit(1)))

    return F.coalesce(own, once(F.split(F.lower(evidence), "\r?\n"), around))


_UNIT = "|".join(re.escape(c) for c in sorted({*tables.CURRENCIES, *tables.SYMBOLS}, key=lambda c: (-len(c), c)))


def is_price_line(line: Column) -> Column:
    """Whether a line is a fragment of a price, by its wording or as nothing but a number and its unit."""
    own = F.trim(line)
    return (own == "") | own.isin(*tables.PRICE_LINES) | own.rlike(rf"(?i)^(?:{_UNIT})?\s*[\d\s,.]*\s*(?:{_UNIT})?\s*(?:per)?$")


def nearest_heading(text: Column, evidence: Column) -> Column:
    """The evidence's last short line before the line that holds the text's first number, which must be a price line."""
    number = F.nullif(F.regexp_extract(text, NUMBER, 0), F.lit(""))

    def before(lines: Column) -> Column:
        stop = F.array_min(F.array_compact(F.transform(lines, lambda x, i: F.when(x.contains(number) & is_price_line(F.lower(x)), i))))
        short = F.filter(F.slice(lines, F.lit(1), F.coalesce(stop, F.size(lines)).cast("int")), lambda x: ~is_price_line(F.lower(x)) & (F.size(F.split(collapsed(x), " ")) <= 8))
        return F.try_element_at(short, F.lit(-1))

    lines = F.filter(F.transform(F.split(evidence, "\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(number.isNotNull(), once(lines, before))


def per_noun(text: Column, evidence: Column) -> Column:
    """The unit that completes a text's dangling "per": the last one that the nearest heading names."""
    words = F.transform(F.split(F.lower(nearest_heading(text, evidence)), r"\s+"), lambda w: F.regexp_replace(w, "[^a-z0-9]", ""))
    return F.when(F.rtrim(F.lower(text)).endswith(" per"), F.try_element_at(F.filter(words, lambda w: w.isin(*tables.UNIT_NOUNS)), F.lit(-1)))


def product_feature(product: Column, heading: Column, nearest: Column) -> Column:
    own = F.coalesce(F.lower(heading), F.lit(""))
    return (
        F.when(product == "radar", F.when(own.contains("fraud teams"), "fraud_teams").when(own.contains("machine learning"), "machine_learning"))
        .when(product == "tax", F.when(own.contains("complete"), "complete").when(own.contains("basic"), "basic"))
        .when(product.isin("disputes", "smart_disputes"), snake_case(nearest))
    )


def surcharge_method(low: Column, evidence: Column) -> Column:
    """The method that a surcharge's own qualifier names, or, where that breaks off at "for", the next line."""
    own = first_listed_method(low, r"(?:for|of|per|optional)\s+")
    following = F.when(low.rlike(r"\b(for|for optional)\s*$"), first_listed_method(F.split(evidence, "\r?\n")[0]))
    return F.coalesce(own, following)


def payment_method(low: Column, path: Column, evidence: Column, given: Column) -> Column:
    """The method at the start of the text; else of a surcharge's qualifier; else the first anywhere; else the one given."""
    everything = F.concat_ws(" ", path, low, evidence)
    by_card = lambda found, text: F.when((found == "terminal") & text.contains("card"), F.lit("card")).otherwise(found)
    leading = earliest_method(low, within=1)
    surcharge = F.when(F.trim(low).startswith("+"), surcharge_method(low, evidence))
    found = F.coalesce(by_card(leading, low), surcharge, by_card(earliest_method(everything), everything), by_card(given, everything))
    return F.when(F.concat_ws(" ", low, path).contains("tap to pay"), F.lit("tap_to_pay")).otherwise(found)


def channel(low: Column, path: Column, evidence: Column, given: Column) -> Column:
    everything = F.concat_ws(" ", path, low, evidence)
    own = F.when(has_any(everything, ("terminal", "in-person", "in person", "tap to pay", "reader")), "in_person").when(has_any(everything, ("online", "checkout", "payment link", "card", "payment", "wallet")), "online")
    return F.coalesce(given, own)


def page_method(low: Column, path: Column) -> Column:
    """A method as extraction names it: the list's first that the text holds, else that the first heading with one holds."""
    first = lambda t: first_match(t, [(m, m.replace(" ", "_")) for m in tables.PAGE_METHODS])
    return F.coalesce(first(low), F.try_element_at(F.array_compact(F.transform(path, lambda p: first(F.lower(p)))), F.lit(1)))


def page_channel(low: Column, path: Column) -> Column:
    own = F.concat_ws(" ", path, low)
    return F.when(has_any(own, ("terminal", "in-person", "tap to pay", "reader")), "in_person").when(has_any(own, ("online", "checkout", "payment link")), "online")


def heading_product(heading: Column) -> Column:
    """The product that a heading names; none if it names a method."""
    named = has_any(heading, [m.replace("_", " ") for m in tables.METHODS if m not in ("card", "terminal")])
    starts = [(re.compile("|".join(rf"\b{re.escape(w)}" for w in words)), product) for words, product in tables.PRODUCT_WORDS]
    return F.when(~named, first_match(heading, starts))


def product_id(low: Column, path: Column, evidence: Column, category: Column, heading: Column, method: Column, via: Column, has_fee: Column) -> Column:
    """By the heading, else the method, else wording anywhere, else as a generic payment."""
    in_person = F.coalesce(via == "in_person", F.lit(False)) | has_any(path, ("terminal", "tap to pay", "in-person", "in person"))
    by_method = F.when(method == "card", F.when(in_person, "terminal").otherwise("payments")).when(method.isin("terminal", "tap_to_pay"), "terminal").otherwise(method)
    everything = F.concat_ws(" ", path, F.coalesce(F.lower(category), F.lit("")), low, evidence)
    near = F.concat_ws(" ", path, low)
    generic = near.contains("card") | (near.contains("payment") & ~near.contains("payment method")) | (has_fee & near.contains("payment methods"))
    return F.coalesce(
        heading_product(heading), by_method, first_match(everything, tables.PRODUCT_WORDS), F.when(generic, "payments").when(near.contains("ach"), "ach_direct_debit").when(near.contains("sepa"), "sepa_direct_debit"),
        F.lit("unspecified"),
    )


def is_card_product(product: Column) -> Column:
    return _in(product, ("payments", "terminal"))


def is_method_product(product: Column) -> Column:
    return _in(product, (*tables.METHODS, "payments", "terminal"))


def international_surcharge(low: Column) -> Column:
    return low.contains("for international transactions") & (low.contains("+") | low.contains("surcharge"))


def dispute_fee(low: Column) -> Column:
    """Whether a number stands at most 40 characters before the first mention of a dispute, failure or refund."""
    near = F.lit(False)
    for word in tables.DISPUTE_WORDS:
        near = near | (low.contains(word) & F.substring_index(low, word, 1).rlike("[0-9][^0-9]{0,40}$"))
    return near


def variant_id(product: Column, plan: Column, feature: Column, low: Column, method: Column, via: Column, region: Column, tier: Column, origin: Column, kind: Column) -> Column:
    abroad = (F.coalesce(origin == "international", F.lit(False)) | _in(region, ("international", "non-eea", "non eea")))
    home = lambda far: F.concat(F.when(far, "international").otherwise("domestic"), F.coalesce(F.concat(F.lit("_"), kind), F.lit("")), F.lit("_cards"))
    place = F.when(F.coalesce(via, F.lit("online")) == "in_person", "in_person").otherwise("online")
    cards = F.when(tier == "premium", F.concat(place, F.lit("_premium_cards"))).otherwise(F.concat(place, F.lit("_"), home(abroad | _in(region, ("uk",)))))
    return (
        F.when(product.isin("three_d_secure", "authorization_boost", "radar", "adaptive_pricing") & plan.isNotNull(), F.concat(plan, F.lit("_pricing")))
        .when(product == "smart_disputes", F.when(low.rlike(r"\b(won|win)\b"), "won_dispute").when(low.contains("lost"), "lost_dispute").otherwise("standard"))
        .when(product.isin("tax", "identity", "billing") & feature.isNotNull(), feature)
        .when(product == "payments", cards).when(product == "terminal", F.when(method == "tap_to_pay", "tap_to_pay").otherwise(home(abroad))).otherwise("standard")
    )


def is_fee_phrase(text: Column) -> Column:
    return has_any(text, tables.FEE_TERMS)


def has_base_fee(parsed: Column) -> Column:
    return parsed["percentage"].isNotNull() | parsed["amount"].isNotNull()


def exactness(parsed: Column, text: Column) -> Column:
    """Of a text that may be wider than the fee: what its wording says, else what its fee says."""

    def of(low: Column) -> Column:
        concrete = (parsed["exactness"] == "custom") & has_base_fee(parsed) & is_fee_phrase(low)
        return (
            F.when(has_any(low, ("contact sales", "custom quote")), "custom").when(low.rlike("start(s|ing) (at|from)"), "from").when(low.rlike(r"\b(?:cap|maximum|max)\b"), "range")
            .when(low.contains("up to") & ~low.rlike(r"up to \d+\s?(month|day|week|year)"), "range").when(low.rlike(r"\b(?:minimum|min)\b"), "from")
            .when(has_any(low, ("included", "no additional fee")), "included").when(has_any(low, ("free", "no fee")), "free")
            .when(has_any(low, ("overage", "allotment", "volume pricing", "custom package")), "custom").when(concrete, "exact").otherwise(parsed["exactness"])
        )

    return once(F.lower(text), of)


def told_by(text: Column, evidence: Column, parsed: Column) -> Column:
    """The text alone where it states a fee in fee words, else with the evidence."""
    return F.when(has_base_fee(parsed) & is_fee_phrase(text), text).otherwise(F.concat_ws(" ", text, F.coalesce(evidence, F.lit(""))))


def role(text: Column, evidence: Column, parsed: Column, tokens: Column, method: Column) -> Column:
    """What an entry is within its row: maximum, minimum, included, free, custom, from, surcharge or base."""
    wide = told_by(text, evidence, parsed)
    tap = F.lower(text).contains("tap to pay") | F.coalesce(method == "tap_to_pay", F.lit(False))
    plus = F.trim(text).startswith("+") | F.coalesce((F.size(tokens) == 1) & (tokens[0]["operator"] == "+"), F.lit(False))

    def of(x: Column) -> Column:
        how, low = x["how"], x["low"]
        return (
            F.when((how == "range") | low.rlike(r"\b(?:cap|capped|maximum|max)\b"), "maximum").when(low.rlike(r"\b(?:minimum|min)\b"), "minimum")
            .when((how == "included") | low.contains("no additional"), "included").when(how == "free", "free").when((how == "custom") | low.contains("contact sales"), "custom")
            .when((how == "from") | low.rlike("starting (at|from)"), "from").when(low.contains("uplift"), "base").when(plus & ~tap, "surcharge").otherwise("base")
        )

    return once(F.struct(exactness(parsed, wide).alias("how"), F.lower(wide).alias("low")), of)


def unit(low: Column, product: Column, method: Column) -> Column:
    dedicated = dispute_fee(low)
    dispute = (product == "disputes") | (dedicated & has_any(low, ("disputed payment", "lost disputes", "smart dispute")))
    default = F.when(method.isNotNull() | product.isin(*tables.DEBIT_PRODUCTS, *tables.METHOD_PRODUCTS), "per_transaction")
    return F.when(dispute, "per_dispute").when(dedicated & low.contains("failed payment"), "per_attempt").otherwise(F.coalesce(first_match(low, tables.UNITS), default, looked_up(product, tables.PRODUCT_UNITS)))


def condition(name: str, value: Column | str, when: Column | None = None) -> Column:
    """A condition (dimension, operator, value), or null where `when` doesn't hold or the value is null."""
    value = (F.lit(value) if isinstance(value, str) else value).cast("string")
    holds = value.isNotNull() if when is None else value.isNotNull() & F.coalesce(when, F.lit(False))
    return F.when(holds, F.struct(F.lit(name).alias("dimension"), F.lit("eq").alias("operator"), value.alias("value")))


def region_conditions(product: Column, region: Column) -> list[Column]:
    """Of products without cards a region tells where the payment goes."""
    other = ~is_card_product(product)
    return [condition("cross_border", F.when(region == "domestic", "false").otherwise("true"), other & region.isNotNull()), condition("transaction_region", region, other)]


def base_conditions(product: Column, method: Column, via: Column, region: Column, tier: Column, origin: Column, country: Column) -> Column:
    card = is_card_product(product)
    return F.array_compact(F.array(
        condition("payment_method", method), condition("channel", via), condition("card_region", region, card), condition("card_origin", origin, card & region.isNotNull()), condition("card_tier", tier, card),
        *region_conditions(product, region), condition("account_country", country),
    ))


def conditions(e: dict[str, Column]) -> Column:
    """All conditions that an entry's wording sets, in order; `e` has the entry's texts and dimensions by name."""
    low, path, product = e["low"], e["path"], e["product_id"]
    both, card = F.concat_ws(" ", path, low), is_card_product(product)
    region = F.when(~card & e["card_region"].isNotNull() & international_surcharge(low), "international").otherwise(e["card_region"])
    networks = F.array_join(F.array_sort(e["card_networks"]), ",")
    conversion_at, domestic_at = F.instr(low, "currency conversion"), F.instr(low, "domestic")
    converts = both.contains("currency conversion") & ((domestic_at == 0) | (conversion_at == 0) | (domestic_at > conversion_at))
    wire, dedicated = low.rlike("wire (payment|transfer)"), dispute_fee(low)
    adaptive = (product == "adaptive_pricing") | both.contains("adaptive pricing")
    disputes, disputed = product.isin("smart_disputes", "disputes"), both.contains("dispute")
    lost = has_any(both, ("lost disputes", "disputed payment"))
    own_kind = F.when(lost, "dispute").when(both.contains("failed payment"), "failed").when(both.contains("refund"), "refund")
    state = (
        F.when(both.contains("won disputes") | (disputed & low.rlike(r"\b(won|win)\b")), "won").when(both.contains("lost disputes") | (disputed & low.rlike(r"\blost\b")), "lost")
        .when(both.contains("received") & disputed, "received").when(both.contains("countered") | (both.contains("respond") & disputed), "countered")
    )
    kind = F.coalesce(first_match(low, tables.TRANSACTIONS), F.when(product == "instant_payouts", F.lit("payout")))
    return F.array_compact(F.array(
        condition("card_region", region, card), condition("card_origin", e["card_origin"], card & region.isNotNull()), condition("card_tier", e["card_tier"], card), condition("card_type", e["card_type"], card),
        condition("card_network", networks, card & (networks != "")), condition("customer_country", "GB", card & (region == "uk")),
        condition("presentment_currency", "USD,other", card & has_any(low, ("usd or other currency", "other currency presentment"))), *region_conditions(product, region),
        condition("payment_method", e["payment_method"], card), condition("channel", e["channel"]), condition("currency_conversion_required", "true", converts),
        condition("settlement_timing", first_match(low, tables.SETTLEMENTS)), condition("pricing_plan", e["pricing_plan"]), condition("product_feature", e["product_feature"]),
        condition("integration_type", e["integration_type"]), condition("payment_method_variant", method_variant(low, e["payment_method"])), condition("pricing_tier", pricing_tier(low)),
        condition("contract_length", contract_length(low)), condition("customer_country", F.array_join(e["customer_countries"], ",")), condition("transaction_type", "wire", wire),
        condition("payment_method_variant", "wire", wire & e["payment_method"].isNotNull()), condition("feature_enabled", "smart_disputes", disputes & both.contains("smart dispute")),
        condition("payer", "customer", adaptive & both.contains("customer") & has_any(low, ("pay", "present", "bear"))), condition("fee_type", "conversion_fee", adaptive & both.contains("conversion")),
        condition("dispute_state", "lost", dedicated & lost), condition("transaction_type", own_kind, dedicated), condition("dispute_state", state, disputes | (product == "refunds")),
        condition("transaction_type", "dispute", disputes & ~wire & ~F.coalesce(dedicated & own_kind.isNotNull(), F.lit(False))),
        condition("recurring", "true", has_any(path, ("recurring", "subscription"))), condition("recurring", "false", has_any(path, ("one-time", "one time"))),
        condition("managed_payments", "true", path.contains("managed payments")), condition("success", "true", has_any(low, ("per successful transaction", "per successful charge"))),
        condition("transaction_type", kind), condition("card_entry_mode", "manual", has_any(low, ("manually entered", "manual entry", "moto"))),
    ))


def first_conditions(every: Column) -> Column:
    """Of the conditions of one dimension the first."""
    return once(F.transform(every, lambda c: c["dimension"]), lambda names: F.filter(every, lambda c, i: F.array_position(names, c["dimension"]) == i + 1))
