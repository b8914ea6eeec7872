"""Fee entries to rules: dimensions, what a row takes from the row before it, modifiers joined to their base, rules.

Entries have url, source_order, entry_id, section_path, fee_category, source_text, source_evidence, payment_method,
channel and account_country.  Rows of one page are read in order, in one pass over sorted partitions; pages are handled apart.
"""

from __future__ import annotations

from array import array

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill import tables
from tallyquill.functions import dimensions as d
from tallyquill.functions import evidence as ev
from tallyquill.functions import money
from tallyquill.functions.text import deduplicated, first_match, ordered_unique, stable_id, stacked_units
from tallyquill.operators.folds import folded
from tallyquill.operators.order import settled
from tallyquill.sources.shared import cut, spread

_COMPONENT = ("type", "value", "amount", "currency", "basis_points", "operator", "minor_amount", "source_entry_id", "source_text")


def _component(*values: Column | None) -> Column:
    return F.struct(*((F.lit(None) if v is None else v).cast("string").alias(n) for n, v in zip(_COMPONENT, values)))


def components(tokens: Column, role: Column, entry_id: Column, text: Column) -> Column:
    """Typed fee components of an entry's tokens; without tokens, one that tells what the row is."""
    capped = first_match(F.concat_ws(" ", role, F.lower(text)), tables.AMOUNT_ROLES)
    kind = F.when(role == "surcharge", "fixed_surcharge").when(capped.isNotNull(), capped).when(role.isin("included", "free"), role).when(role == "custom", "custom_pricing").otherwise("fixed_amount")
    share = F.when(role == "surcharge", "percentage_surcharge").otherwise("percentage")
    own = F.transform(F.filter(tokens, lambda t: t["kind"].isin("percentage", "amount")), lambda t: F.when(
        t["kind"] == "percentage", _component(share, t["value"], None, None, t["basis_points"], t["operator"], None, entry_id, text)
    ).otherwise(_component(kind, None, t["value"], t["currency"], None, t["operator"], money.minor_amount(t["value"], t["currency"]), entry_id, text)))
    only = F.when(role.isin("included", "free"), role).when(role == "custom", "custom_pricing").otherwise("non_calculable")
    return F.when(F.size(tokens) == 0, F.array(_component(only, None, None, None, None, None, None, entry_id, text))).otherwise(own)


def is_modifier(role: Column, fee: Column, low: Column, given_method: Column) -> Column:
    """Caps, minimums and included or free statements; a row with a fee only if it tells nothing but a cap or minimum."""
    tap = low.contains("tap to pay") | F.coalesce(given_method == "tap_to_pay", F.lit(False))
    bound = role.isin("maximum", "minimum")
    return F.when(d.has_base_fee(fee), bound & ~F.exists(fee["tokens"], lambda t: t["kind"] == "percentage")).otherwise((bound | role.isin("included", "free")) & ~tap)


def described(entries: DataFrame) -> DataFrame:
    """Entries with what their own wording tells: fee, role, product, method, channel, region, tier and the rest."""
    return _described(spread(entries))


def _described(entries: DataFrame) -> DataFrame:
    text, given = F.col("source_text"), F.col("given_method")
    rows = entries.withColumnsRenamed({"payment_method": "given_method", "channel": "given_channel"})
    rows = rows.withColumns({"source_text": F.coalesce(text, F.lit("")), "source_evidence": F.coalesce("source_evidence", F.lit("")), "section_path": F.coalesce("section_path", F.array().cast("array<string>"))})
    rows = rows.withColumns({"fee": money.fee("source_text"), "low": F.lower(text), "path": F.lower(F.array_join("section_path", " ")), "evidence": F.lower("source_evidence")})
    low, path, around = F.col("low"), F.col("path"), F.col("evidence")
    rows = rows.withColumns({
        "own_method": d.payment_method(low, path, around, given), "own_channel": d.channel(low, path, around, F.col("given_channel")),
        "own_region": d.card_region(F.concat_ws(" ", path, low), given, F.col("account_country")), "own_tier": d.card_tier(low), "card_type": d.card_type(low, F.col("account_country")),
        "card_networks": d.card_networks(low), "customer_countries": d.customer_countries(text, F.col("account_country")), "pricing_plan": d.pricing_plan(path, low),
        "integration_type": d.integration_type(text, F.col("source_evidence")), "nearest": d.nearest_heading(text, F.col("source_evidence")),
        "role": d.role(text, F.col("source_evidence"), F.col("fee"), F.col("fee.tokens"), given), "exactness": d.exactness(F.col("fee"), d.told_by(text, F.col("source_evidence"), F.col("fee"))),
        "heading": F.coalesce("fee_category", F.try_element_at("section_path", F.lit(-1))), "once_text": deduplicated("source_text"),
    })
    rows = rows.withColumns({
        "own_product": d.product_id(low, path, around, F.col("fee_category"), F.col("heading"), F.col("own_method"), F.col("own_channel"), d.has_base_fee(F.col("fee"))),
        "is_modifier": is_modifier(F.col("role"), F.col("fee"), low, given),
    })
    return rows


_LOOSE = ("payments", "terminal")


class Inherited:
    """What each row of a page has after it took from the row before it in the same section: product, method, region, tier."""

    def __init__(self):
        self.path, self.before = None, None

    def __call__(self, r: dict) -> tuple:
        product, method, region, tier = r["product"], r["method"], r["region"], r["tier"]
        if self.before is not None and self.path == r["path"]:
            old, old_method, old_region, old_tier = self.before
            loose = product == "payments" and old not in _LOOSE or product == "unspecified" and old not in (*_LOOSE, "unspecified")
            if r["modifier"] and loose:
                product = old
            if r["modifier"] or product == old:
                method, region = method or old_method, region or old_region
                if r["role"] not in ("base", "from", "range"):
                    tier = tier or old_tier
        self.before, self.path = (product, method, region, tier), r["path"]
        return self.before


#: Variants of a modifier that fit every variant of its product.
_GENERAL = ("online_domestic_cards", "domestic_cards", "standard")


class Attached:
    """The group of each row of a page: a modifier's is the latest that it fits, else one of its own.

    Groups that can take modifiers are kept by section above and product, apart by whether their base is a fee or is free:
    the latest one, and of each variant a stack of group numbers.  Only the latest one's variant ever changes, and it is
    the top of its stack, so every row takes a few steps however many groups there are, and a group takes eight bytes.
    """

    def __init__(self):
        self.n, self.open = 0, {}

    def __call__(self, r: dict) -> tuple[int]:
        path = tuple(r["path"])
        where = (path[:-1] or path, r["product"])
        given = r["role"] in ("included", "free")
        found, own = -1, None
        if r["modifier"]:
            for free in (True,) if given else (True, False):
                kept = self.open.get((*where, free))
                if kept is None:
                    continue
                stack = kept["stacks"].get(r["variant"])
                latest = kept["latest"] if r["variant"] in _GENERAL else stack[-1] if stack else -1
                if latest > found:
                    found, own = latest, kept
        if own is None:
            found = self.n
            self.n += 1
            if given or r["has_fee"]:
                own = self.open.setdefault((*where, given), {"latest": -1, "variant": None, "stacks": {}})
                own["latest"], own["variant"] = found, r["variant"]
                own["stacks"].setdefault(r["variant"], array("q")).append(found)
        elif r["variant"] in _GENERAL and own["variant"] != r["variant"]:
            own["stacks"][own["variant"]].pop()
            own["variant"] = r["variant"]
            own["stacks"].setdefault(r["variant"], array("q")).append(found)
        return (found,)


def _ordered(a: Column, b: Column) -> Column:
    """By source order, then by entry id."""
    less = (a["source_order"] < b["source_order"]) | ((a["source_order"] == b["source_order"]) & (a["entry_id"] < b["entry_id"]))
    same = (a["source_order"] == b["source_order"]) & (a["entry_id"] == b["entry_id"])
    return F.when(same, 0).when(less, -1).otherwise(1)


_ORDER = ["source_order", "entry_id"]


def enriched(entries: DataFrame, by: list[str] = ["url"]) -> DataFrame:  # noqa: B006
    """`described` entries with product_id, payment_method, card_region, card_tier, card_origin, variant_id and conditions.

    A row takes product, method, region and tier from the row before it of the same section where it is a modifier, or
    has the same product; what was taken is passed on.
    """
    return _enriched(spread(entries), by)


def _enriched(entries: DataFrame, by: list[str]) -> DataFrame:
    rows = _described(entries)
    method = F.when(d.is_method_product(F.col("own_product")), F.col("own_method"))
    seen = {"path": F.col("section_path"), "product": F.col("own_product"), "method": method, "region": F.col("own_region"), "tier": F.col("own_tier"), "modifier": F.col("is_modifier"), "role": F.col("role")}
    rows = folded(rows, by, _ORDER, seen, Inherited, {"product_id": "string", "payment_method": "string", "card_region": "string", "card_tier": "string"})
    country, product, low = F.col("account_country"), F.col("product_id"), F.col("low")
    rows = rows.withColumns({
        "product_feature": d.product_feature(product, F.try_element_at("section_path", F.lit(-1)), F.col("nearest")), "card_origin": d.card_origin(F.col("card_region"), country), "own_origin": d.card_origin(F.col("own_region"), country),
    })
    own = {c: F.col(c) for c in ("low", "path", "product_id", "card_type", "card_networks", "pricing_plan", "product_feature", "integration_type", "customer_countries")}
    own |= {"card_region": F.col("own_region"), "card_origin": F.col("own_origin"), "card_tier": F.col("own_tier"), "payment_method": F.col("own_method"), "channel": F.col("own_channel")}
    return rows.withColumns({
        "variant_id": d.variant_id(product, F.col("pricing_plan"), F.col("product_feature"), low, F.col("own_method"), F.col("own_channel"), F.col("own_region"), F.col("own_tier"), F.col("own_origin"), F.col("card_type")),
        "conditions": d.conditions(own), "components": components(F.col("fee.tokens"), F.col("role"), F.col("entry_id"), F.col("source_text")),
    })


def grouped(rows: DataFrame, by: list[str] = ["url"]) -> DataFrame:  # noqa: B006
    """`enriched` rows with group_no: each modifier with the latest base before it that it fits.

    It fits a group of the same section above, the product of the group's last row, and its variant or a general one;
    the base must be a fee or an included or free row, and what is included or free doesn't join a fee.
    """
    seen = {"path": F.col("section_path"), "product": F.col("product_id"), "variant": F.col("variant_id"), "modifier": F.col("is_modifier"), "role": F.col("role"), "has_fee": d.has_base_fee(F.col("fee"))}
    return folded(rows, by, _ORDER, seen, Attached, {"group_no": "int"})


def behavior(parts: Column, label: Column, how: Column) -> Column:
    added = F.exists(parts, lambda c: c["type"].isin("percentage_surcharge", "fixed_surcharge"))
    loose = F.exists(parts, lambda c: c["type"].isin("included", "free")) | F.coalesce(how == "custom", F.lit(False))
    return F.when(added, "additive").when(F.lower(label).rlike(r"\b(or|alternative|instead of)\b"), "alternative").when(loose, "informational").otherwise("conditional")


def filled_channel(via: Column, product: Column, method: Column, low: Column) -> Column:
    present = (product == "terminal") | F.coalesce(method == "tap_to_pay", F.lit(False)) | low.rlike("in[- ]person|tap to pay")
    return F.coalesce(via, F.when(present, F.lit("in_person")).when(method.isNotNull() | product.isin(*tables.ONLINE_PRODUCTS) | low.rlike("card|payment"), F.lit("online")))


def filled_unit(unit: Column, product: Column, method: Column) -> Column:
    return F.coalesce(unit, F.when(product == "disputes", F.lit("per_dispute")).when(method.isNotNull(), F.lit("per_transaction")))


def first_component(parts: Column, kinds: tuple[str, ...], field: str) -> Column:
    """A field of the first component of one of the kinds, as flat rules show it."""
    return F.try_element_at(F.filter(parts, lambda c: c["type"].isin(*kinds)), F.lit(1))[field]


def assembled(rows: DataFrame, by: list[str] = ["url"]) -> DataFrame:  # noqa: B006
    """One row per group of `grouped` rows: the rule that it makes, its status and its entries.

    Components of all rows are joined; of conditions the first of a dimension counts, the base row's own dimensions
    before what wording infers; the first exactness counts unless a later row is custom, from or a range.  A group
    without components is a rule only if it says that something is included or free.
    """
    item = ["source_order", "entry_id", "source_text", "once_text", "fee", "components", "conditions", "exactness", "section_path"]
    base = ["product_id", "variant_id", "payment_method", "own_method", "own_channel", "card_region", "card_tier", "card_origin", "own_region", "own_origin", "own_tier", "low", "path", "evidence", "source_evidence", "role", "account_country", "given_method", "source_text", "once_text", "fee", "entry_id"]
    place = F.struct("source_order", "entry_id")
    own = rows.groupBy(*by, "group_no").agg(F.array_sort(F.collect_list(F.struct(*item)), _ordered).alias("items"), F.min_by(F.struct(*base), place).alias("base"))
    own = own.select(*by, "group_no", "items", *(F.col(f"base.{c}").alias(c) for c in base))
    of = lambda c: F.flatten(F.transform("items", lambda x: x[c]))
    seeds = d.base_conditions(F.col("product_id"), F.col("payment_method"), F.col("own_channel"), F.col("card_region"), F.col("card_tier"), F.col("card_origin"), F.col("account_country"))
    own = own.withColumns({
        "fee_components": of("components"), "conditions": d.first_conditions(F.concat(seeds, of("conditions"))),
        "exactness": F.aggregate("items", F.lit(None).cast("string"), lambda a, x: F.when(a.isNull() | x["exactness"].isin("custom", "from", "range"), x["exactness"]).otherwise(a)),
        "entry_ids": F.transform("items", lambda x: x["entry_id"]), "source_texts": ordered_unique(F.transform("items", lambda x: x["once_text"])), "label": F.col("once_text"),
        "method": F.coalesce("payment_method", F.when(d.is_method_product(F.col("product_id")), F.col("own_method"))),
        "combined": F.lower(F.array_join(F.flatten(F.transform("items", lambda x: F.filter(F.concat(x["section_path"], F.array(x["source_text"])), lambda t: t != ""))), " ")),
        "calculable": d.has_base_fee(F.col("fee")) | F.exists(of("components"), lambda c: c["type"].isin("percentage", "fixed_amount", "percentage_surcharge", "fixed_surcharge")),
    })
    low, parts = F.col("low"), F.col("fee_components")
    noun = d.per_noun(F.col("source_text"), F.col("source_evidence"))
    wide = F.concat_ws(" ", "combined", "source_evidence")
    told = F.when(F.rtrim(low).endswith(" per"), F.coalesce(F.concat(F.col("combined"), F.lit(" per "), noun), wide)).when(~low.rlike("[a-z]{3,}"), wide).otherwise(F.col("combined"))
    positive = F.filter("items", lambda x: F.exists(x["components"], lambda c: c["type"].isin("percentage", "fixed_amount", "percentage_surcharge", "fixed_surcharge")))
    shares = lambda x: ev.is_share_number(x["once_text"], x["fee"])
    crossed = (F.size(positive) > 0) & F.forall(positive, shares) & F.exists("items", lambda x: d.is_fee_phrase(x["once_text"]) & ~shares(x))
    own = settled(own, {"fee_evidence": ev.decided(
        ev.is_promotion(F.col("combined")), ev.is_marketing(F.col("once_text")), crossed, ev.is_hardware_price(F.col("product_id"), F.col("given_method"), F.concat_ws(" ", "path", "low"), parts),
        ev.is_number_of_name(parts), ev.is_contradictory(parts), d.is_fee_phrase(told), ev.is_table_value(F.trim(F.concat_ws(" ", "path", "low", "evidence"))),
    )})
    own = settled(own, {
        "channel": filled_channel(F.col("own_channel"), F.col("product_id"), F.col("method"), low), "unit": filled_unit(d.unit(low, F.col("product_id"), F.col("own_method")), F.col("product_id"), F.col("method")),
        "behavior": behavior(parts, F.col("label"), F.col("exactness")), "empty": F.size(parts) == 0,
    })
    own = settled(own, {"found": ev.status(F.col("exactness"), F.col("calculable"), F.col("fee_evidence"), F.col("channel"), F.col("unit"), F.col("behavior"))})
    found = F.col("found")
    stacked = (F.col("product_id") == "unspecified") & stacked_units("source_text")
    bare = F.when(F.col("role").isin("included", "free"), F.col("role")).when(F.col("role") == "custom", "custom_pricing").when(ev.is_promotion(F.col("source_text")), "custom_pricing").otherwise("informational")
    status = F.when(F.col("empty"), bare).when(stacked, "unsupported_fee_shape").otherwise(found["status"])
    kept = F.when(F.col("empty"), F.when(F.col("role").isin("included", "free"), 0.7).otherwise(0.0)).otherwise(found["confidence"])
    identity = F.transform(F.array_sort("conditions"), lambda c: F.concat_ws("=", c["dimension"], c["value"]))
    card = d.is_card_product(F.col("product_id"))
    plain = lambda c, other: F.when(F.col("empty"), F.lit(other)).otherwise(F.col(c))
    told = F.filter("items", lambda x: ~F.coalesce(ev.is_marketing(x["once_text"]), F.lit(False)))
    own = settled(own, {
        "fragments": F.when(F.col("empty"), F.array()).otherwise(F.transform("items", lambda x: F.struct(x["entry_id"].alias("entry_id"), x["once_text"].alias("text")))), "evidence_ids": F.when(F.col("empty"), F.slice("entry_ids", 1, 1)).otherwise(F.col("entry_ids")),
        "phrases": F.when(F.col("empty"), F.array("once_text")).otherwise(ordered_unique(F.transform(told, lambda x: x["once_text"]))), "fee_evidence": F.when(F.col("empty"), F.struct(bare.alias("type"), F.lit(0.7).alias("confidence"))).otherwise(F.col("fee_evidence")),
        "notes": F.when(F.col("empty"), F.array().cast("array<string>")).otherwise(F.concat(F.array(F.concat(F.lit("product="), "product_id"), F.concat(F.lit("variant="), "variant_id")), F.transform("conditions", lambda c: F.concat_ws("=", c["dimension"], c["value"])))),
        "status": status, "confidence": kept, "rule_id": stable_id("product_id", "variant_id", F.array_join(identity, "|"), "entry_id"), "unit": F.coalesce(plain("unit", "informational"), F.lit("informational")),
        "behavior": plain("behavior", "informational"), "exactness": F.coalesce(plain("exactness", "included"), F.lit("exact")), "entry_ids": F.when(F.col("empty"), F.slice("entry_ids", 1, 1)).otherwise(F.col("entry_ids")),
        "percentage": first_component(parts, ("percentage", "percentage_surcharge"), "value"), "basis_points": first_component(parts, ("percentage", "percentage_surcharge"), "basis_points"),
        "fixed_amount": first_component(parts, ("fixed_amount",), "amount"), "fixed_amount_minor": first_component(parts, ("fixed_amount",), "minor_amount"),
        "fixed_currency": first_component(parts, ("fixed_amount",), "currency"), "minimum_amount": first_component(parts, ("minimum_fee",), "amount"), "maximum_amount": first_component(parts, ("maximum_fee",), "amount"),
        "card_region": F.when(card, F.col("own_region")), "card_origin": F.when(card, F.col("own_origin")), "card_tier": F.when(card, F.col("own_tier")),
    })
    return own.select(
        *by, "group_no", "rule_id", "entry_id", "entry_ids", "product_id", "variant_id", "label", "account_country", "channel", F.col("method").alias("payment_method"), "card_region", "card_origin", "card_tier", "percentage",
        "basis_points", "fixed_amount", "fixed_amount_minor", "fixed_currency", "minimum_amount", "maximum_amount", "unit", "exactness", "behavior", "conditions", "fee_components", "source_texts", "fragments", "phrases", "evidence_ids", "notes", "fee_evidence",
        "status", "confidence", "items",
    )


def classified(entries: DataFrame, by: list[str] = ["url"], provider: str = "the provider") -> tuple[DataFrame, DataFrame]:  # noqa: B006
    """(rules, leftovers (by, entry_id, status, has_fee)) of entries; what is a statistic isn't grouped.

    A null text is an empty one; what has no fee and says nothing of the kind is a rule that can't be calculated.
    """
    marked = settled(spread(entries), {"_fee": money.fee("source_text")})
    marked = settled(marked, {"_no_fee": F.coalesce(ev.is_statistic(F.col("source_text"), F.col("source_evidence"), F.col("_fee"), provider), F.lit(False)), "_has_fee": d.has_base_fee(F.col("_fee"))})
    # Rules and leftovers are two readings of the same groups, which are therefore kept.
    found = cut(assembled(grouped(_enriched(marked.where("not _no_fee").drop("_fee", "_no_fee", "_has_fee"), by), by), by))
    rules = found.where(F.col("status").isin(*tables.KEPT)).drop("items")
    rest = found.where(~F.col("status").isin(*tables.KEPT)).select(*by, "status", F.explode(F.filter("items", lambda x: F.array_contains("entry_ids", x["entry_id"]))).alias("x"))
    rest = rest.select(*by, F.col("x.entry_id").alias("entry_id"), "status", d.has_base_fee(F.col("x.fee")).alias("has_fee"))
    no_fees = marked.where("_no_fee").select(*by, "entry_id", F.lit("ignored_non_fee").alias("status"), F.col("_has_fee").alias("has_fee"))
    return rules, rest.unionByName(no_fees)
