"""Quality checks: predicates over rules, references between tables, and states that exclude one another."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill import tables
from tallyquill.functions.money import basis_points, decimal_text, minor_amount
from tallyquill.functions.text import condition_key, earliest_method, first_match, has_any, looked_up, market_share
from tallyquill.functions.web import country_of_path


def violations(rows: DataFrame, key: list[str], rules: Mapping[str, Column]) -> DataFrame:
    """One row per key and rule that is broken; all rules are looked at in one pass."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items())))
    return rows.select(*key, F.explode(found).alias("rule"))


def minor_mismatch(amount: str, currency: str, minor: str) -> Column:
    return ~F.col(minor).eqNullSafe(minor_amount(amount, currency))


def points_mismatch(percentage: str, points: str) -> Column:
    return F.col(points).try_cast("decimal(28,10)") != basis_points(percentage).try_cast("decimal(28,10)")


def contradictory(text: str, fee: Column) -> Column:
    """A positive fee whose text also says that it is free or included."""
    return fee & (has_any(text, ("included", "no additional")) | (F.lower(F.col(text)).rlike(r"\bfree\b") & ~has_any(text, ("interest-free", "not free"))))


def calculable(channel: str, unit: str, behavior: str, confidence: str, components: str) -> Column:
    """A rule that claims to be calculable and lacks what a calculator needs."""
    return F.col(channel).isNull() | F.col(unit).isNull() | F.col(behavior).isNull() | (F.col(confidence) < 0.7) | (F.coalesce(F.size(components), F.lit(0)) == 0)


_BASES, _ADDED, _BOUNDS = ("percentage", "fixed_amount"), ("percentage_surcharge", "fixed_surcharge"), ("maximum_fee", "minimum_fee")
_MODIFYING = ("currency_conversion_required", "card_origin", "dispute_state", "transaction_type", "cross_border", "transaction_region")


def _has_type(components: str, kinds: tuple[str, ...]) -> Column:
    return F.exists(components, lambda c: c["type"].isin(*kinds))


def not_calculable(components: str) -> Column:
    """No component that a calculator knows."""
    return ~_has_type(components, (*_BASES, *_ADDED, *_BOUNDS))


def only_surcharge(components: str, conditions: str) -> Column:
    """A surcharge without a base fee, and without a condition that it could depend on."""
    return _has_type(components, _ADDED) & ~_has_type(components, _BASES) & ~F.exists(conditions, lambda c: c["dimension"].isin(*_MODIFYING))


def bad_evidence(kind: str) -> Column:
    return ~F.coalesce(F.col(kind).isin(*tables.GOOD_EVIDENCE), F.lit(False))


def large_fixed(components: str, unit: str, least_minor: int = 1000) -> Column:
    """A fixed amount per transaction that looks like a price: large, and without a percentage."""
    largest = F.array_max(F.transform(F.filter(components, lambda c: c["type"] == "fixed_amount"), lambda c: c["minor_amount"].try_cast("decimal(28,4)")))
    return (F.col(unit) == "per_transaction") & (largest >= least_minor) & ~_has_type(components, ("percentage", "percentage_surcharge"))


def _markers(currency: Column) -> Column:
    """The code and the symbols of a currency, in lower case."""
    symbols: dict[str, list[str]] = {}
    for symbol, code in tables.SYMBOLS.items():
        symbols.setdefault(code, []).append(symbol.lower())
    pairs = [x for code, own in symbols.items() for x in (F.lit(code), F.array(*map(F.lit, own)))]
    return F.concat(F.array(F.lower(currency)), F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(currency)), F.array().cast("array<string>")))


def refers_to(label: Column, c: Column) -> Column:
    """Whether a lower-cased label holds a component's amount: as written, as a number of the same value, or in minor units."""
    numbers = F.transform(F.regexp_extract_all(label, F.lit(r"[0-9][0-9\s,.]*"), 0), lambda n: decimal_text(n).try_cast("decimal(28,10)"))
    value = decimal_text(c["amount"]).try_cast("decimal(28,10)")
    minor = {code: s for s in tables.MINOR_SYMBOLS for code in [tables.SYMBOLS[s]]}
    symbol = looked_up(F.upper(c["currency"]), minor)
    small = F.coalesce(F.regexp_like(label, F.concat(F.lit(r"\Q"), c["minor_amount"], F.lit(r"\E\s*\Q"), symbol, F.lit(r"\E"))), F.lit(False))
    return c["amount"].isNull() | label.contains(c["amount"]) | F.coalesce(F.exists(numbers, lambda n: n == value), F.lit(False)) | small


def unnamed_amount(label: str, components: str) -> Column:
    """A fixed amount that the label doesn't tell."""
    low = F.lower(F.coalesce(F.col(label), F.lit("")))
    return F.exists(components, lambda c: (c["type"] == "fixed_amount") & ~refers_to(low, c))


def unnamed_currency(label: str, components: str) -> Column:
    """A fixed amount that the label tells without its currency."""
    low = F.lower(F.coalesce(F.col(label), F.lit("")))
    return F.exists(components, lambda c: (c["type"] == "fixed_amount") & c["amount"].isNotNull() & c["currency"].isNotNull() & refers_to(low, c) & ~F.exists(_markers(c["currency"]), lambda m: low.contains(m)))


def crossed_evidence(kind: str) -> Column:
    """The fee's number and its wording come from different fragments."""
    return F.col(kind) == "cross_fragment_fee_evidence"


def _of(conditions: str, dimension: str) -> Column:
    """The value of the last condition of a dimension; null without one."""
    own = F.filter(conditions, lambda c: c["dimension"] == dimension)
    return F.try_element_at(own, F.lit(-1))["value"]


def _lacks(conditions: str, dimension: str, value: str) -> Column:
    return ~_of(conditions, dimension).eqNullSafe(F.lit(value))


def said(label: str, phrases: str) -> Column:
    """Label and evidence phrases as one lower-cased text, which the checks below read."""
    return F.lower(F.concat_ws(" ", F.coalesce(F.col(label), F.lit("")), F.array_join(F.coalesce(phrases, F.array().cast("array<string>")), " ")))


def untrusted_share(told: str, sources: str) -> Column:
    """Market-share wording although no fee component comes from a text that states a fee."""
    states_fee = lambda s: (F.lower(s).rlike(tables.FEE_WORDING) | s.contains("+ ") | s.contains("%")) & ~market_share(s)
    return market_share(told) & ~F.exists(F.coalesce(sources, F.array().cast("array<string>")), lambda s: F.coalesce(states_fee(s), F.lit(False)))


def plan_missing(told: str, conditions: str) -> Column:
    """Custom or standard pricing is written, and the condition that says so is missing."""
    broken = F.lit(False)
    for plan, words in tables.PLAN_WORDING.items():
        broken = broken | (has_any(told, words) & _lacks(conditions, "pricing_plan", plan))
    return broken


def addon_as_payment(product: str, variant: str) -> Column:
    return F.col(product).isin(*tables.ADDONS) & F.col(variant).isin(*tables.PAYMENT_VARIANTS)


def other_addon(told: str, product: str) -> Column:
    """The text names an add-on, and the product is another."""
    named = first_match(told, tables.ADDON_WORDING)
    return named.isNotNull() & ~named.eqNullSafe(F.col(product))


def smart_dispute_conditions(product: str, conditions: str) -> Column:
    return (F.col(product) == "smart_disputes") & (_lacks(conditions, "feature_enabled", "smart_disputes") | _lacks(conditions, "dispute_state", "won"))


def not_from(told: str, exactness: str) -> Column:
    return has_any(told, ("starting at", "starting from")) & ~F.col(exactness).eqNullSafe(F.lit("from"))


def payer_missing(told: str, conditions: str) -> Column:
    return F.col(told).contains("conversion fee") & F.col(told).contains("customer") & _lacks(conditions, "payer", "customer")


def leading_method(label: str) -> Column:
    """The method that a label begins with, after one other word at most."""
    return earliest_method(label, within=1)


def method_mismatch(product: str, method: str, label: str | None = None) -> Column:
    """The payment method, or the one that the label begins with, isn't one that the product goes with."""
    p, m = F.coalesce(F.col(product), F.lit("")), F.col(method)
    own = m.isNotNull() & F.when(p == "payments", m != "card").when(p == "terminal", ~m.isin("card", "terminal", "tap_to_pay")).otherwise(p != m)
    if label is None:
        return own
    # The label is read only where a product could differ from it, and once.
    named = F.exists(F.array(leading_method(label)), lambda m: F.coalesce((m == "card") | (p != m), F.lit(False)))
    return own | (~p.isin("payments", "terminal") & named)


def dispute_unit(product: str, unit: str, conditions: str) -> Column:
    """A fee per dispute on a product that has nothing to do with disputes."""
    states = F.exists(conditions, lambda c: c["dimension"].isin("transaction_type", "dispute_state") & c["value"].isin(*tables.DISPUTE_STATES))
    return (F.col(unit) == "per_dispute") & ~F.coalesce(F.col(product), F.lit("")).isin("disputes", "smart_disputes") & ~F.coalesce(states, F.lit(False))


def card_conditions(product: str, conditions: str) -> Column:
    """A product without cards has a condition that only cards have."""
    return ~F.coalesce(F.col(product), F.lit("")).isin("payments", "terminal") & F.exists(conditions, lambda c: c["dimension"].isin("card_region", "card_origin", "card_tier"))


def repeated_phrases(phrases: str) -> Column:
    return F.size(phrases) > F.size(F.array_distinct(phrases))


def missing_references(rows: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Rows whose reference is not null and not known."""
    return rows.where(F.col(column).isNotNull()).join(known.select(F.col(known_column).alias("_known")).distinct(), F.col(column) == F.col("_known"), "left_anti")


def one_state(states: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Keys of several tables with a flag for each, the number of states, and whether it is exactly one.

    The tables are put under one another and grouped once, which is one shuffle however many there are.
    """
    every = None
    for name, df in states.items():
        own = df.select(F.col(key).alias(key), F.lit(name).alias("_state"))
        every = own if every is None else every.unionByName(own)
    flags = [F.coalesce(F.bool_or(F.col("_state") == n), F.lit(False)).alias(f"in_{n}") for n in states]
    out = every.groupBy(key).agg(*flags)
    n = sum((F.col(f"in_{x}").cast("int") for x in states), F.lit(0))
    return out.withColumns({"n_states": n, "exactly_one": n == 1})


def repeated_identities(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def mixed_identities(rows: DataFrame, key: list[str], status: str = "status") -> DataFrame:
    """Keys that have both conflicts and other rules."""
    conflict = F.col(status) == "conflict"
    return rows.groupBy(*key).agg(F.count_if(conflict).alias("conflicts"), F.count_if(~conflict).alias("authoritative")).where("conflicts > 0 and authoritative > 0")


def used_and_dropped(entries: DataFrame, used: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(entries that something refers to, entries that nothing does)."""
    own = used.select(key).distinct()
    return entries.join(own, key, "left_semi"), entries.join(own, key, "left_anti")


def rule_errors(rules: DataFrame, key: list[str]) -> DataFrame:
    """One row per key and broken check of published rules, as `rules.classified` makes them, with `phrases` and `sources`.

    Some checks hold only for rules that claim to be calculable.
    """
    own = rules.withColumns({"_told": said("label", "phrases"), "_kind": F.col("fee_evidence.type"), "_claims": F.col("status").isin("calculable_rule", "classified")})
    claims = F.col("_claims")
    when_claimed = {
        "channel": F.col("channel").isNull(), "unit": F.col("unit").isNull(), "behavior": F.col("behavior").isNull(), "no_component": not_calculable("fee_components"), "only_surcharge": only_surcharge("fee_components", "conditions"),
        "evidence": bad_evidence("_kind"), "confidence": F.col("confidence") < tables.LEAST_CONFIDENCE, "large_fixed": large_fixed("fee_components", "unit"), "amount_in_label": unnamed_amount("label", "fee_components"),
        "currency_in_label": unnamed_currency("label", "fee_components"), "minor_amount": F.exists("fee_components", lambda c: c["amount"].isNotNull() & ~c["minor_amount"].eqNullSafe(minor_amount(c["amount"], c["currency"]))),
        "basis_points": F.exists("fee_components", lambda c: F.coalesce(c["basis_points"].try_cast("decimal(28,10)") != basis_points(c["value"]).try_cast("decimal(28,10)"), F.lit(False))),
        "contradictory": contradictory("label", _has_type("fee_components", (*_BASES, *_ADDED))), "pricing_plan": plan_missing("_told", "conditions"), "addon_variant": addon_as_payment("product_id", "variant_id"),
        "addon_product": other_addon("_told", "product_id"), "smart_disputes": smart_dispute_conditions("product_id", "conditions"), "exactness": not_from("_told", "exactness"), "payer": payer_missing("_told", "conditions"),
        "market_share": untrusted_share("_told", "sources"),
    }
    always = {
        "crossed": crossed_evidence("_kind"), "method": method_mismatch("product_id", "payment_method", "label"), "dispute_unit": dispute_unit("product_id", "unit", "conditions"),
        "card_condition": card_conditions("product_id", "conditions"), "repeated_phrases": repeated_phrases("phrases"),
    }
    return violations(own, key, {k: claims & v for k, v in when_claimed.items()} | always)


def semantic_errors(rules: DataFrame, markets: DataFrame, methods: DataFrame, key: list[str]) -> DataFrame:
    """All errors of published rules: `rule_errors`, markets and methods that aren't known, and identities that repeat."""
    row = lambda df, name: df.select(*key, F.lit(name).alias("rule"))
    identity = rules.withColumn("_identity", condition_key("conditions"))
    several = repeated_identities(identity, ["country", "product_id", "variant_id", "_identity"]).drop("n")
    repeated = identity.join(several, several.columns, "left_semi")
    return (
        rule_errors(rules, key).unionByName(row(missing_references(rules, "country", markets, "country"), "unknown_market"))
        .unionByName(row(missing_references(rules, "payment_method", methods, "method"), "unknown_method")).unionByName(row(repeated, "repeated_identity"))
    )


def publication_errors(markets: DataFrame, rules: DataFrame, core: DataFrame) -> DataFrame:
    """(country, error) of a publication: markets (country, dropped_numeric_entries, blocking_fee_conflicts), rules, core rules.

    Dropped entries, open conflicts, identities that are both a conflict and a rule, markets none of whose rules is
    calculable, and, with a null country, rules without any core rule.
    """
    error = lambda df, name: df.select("country", F.lit(name).alias("error"))
    identity = rules.withColumn("_identity", condition_key("conditions"))
    mixed = mixed_identities(identity, ["country", "product_id", "variant_id", "_identity"]).select("country").distinct()
    good = rules.where("status <> 'conflict'").groupBy("country").agg(F.bool_or(F.col("status").isin("calculable_rule", "classified")).alias("good"))
    empty = good.agg(F.count("*").alias("n")).join(core.agg(F.count("*").alias("m"))).where("n > 0 and m = 0").select(F.lit(None).cast("string").alias("country"))  # two single rows
    return (
        error(markets.where("dropped_numeric_entries > 0"), "dropped_entries").unionByName(error(markets.where("blocking_fee_conflicts > 0"), "blocking_conflicts")).unionByName(error(mixed, "mixed_identity"))
        .unionByName(error(good.where("not good"), "nothing_calculable")).unionByName(error(empty, "no_core_rules"))
    )


def report_errors(documents: DataFrame, revision: str | None = None) -> DataFrame:
    """(country, error) of a publication's own documents (path, value): reports that are missing, no JSON, tell of a
    regression, or were made by another revision than `revision`.  The country is null: they are about all markets."""
    parsed = F.try_parse_json("value")
    path = lambda p: F.col("path") == p
    flag, told = F.try_variant_get(parsed, "$.has_regression", "boolean"), F.try_variant_get(parsed, "$.revision", "string")
    one = documents.agg(
        F.bool_or(path("change-report.json")).alias("changes"), F.bool_or(path("meta/crawl-report.json")).alias("crawl"), F.bool_or(path("change-report.json") & flag).alias("regression"),
        F.bool_or(path("change-report.json") & (parsed.isNull() | flag.isNull())).alias("bad_changes"), F.bool_or(path("meta/crawl-report.json") & parsed.isNull()).alias("bad_crawl"),
        F.bool_or(path("meta/revision.json") & parsed.isNull()).alias("bad_revision"), F.bool_or(path("meta/revision.json") & (told != F.lit(revision))).alias("other_revision"),
    )
    yes, no = lambda c: F.coalesce(c, F.lit(False)), lambda c: ~F.coalesce(F.col(c), F.lit(False))
    kinds = {"no_change_report": no("changes"), "no_crawl_report": no("crawl"), "has_regression": yes("regression"), "bad_change_report": yes("bad_changes"), "bad_crawl_report": yes("bad_crawl"), "bad_revision": yes("bad_revision"), "other_revision": yes("other_revision")}
    found = one.select(F.explode(F.array_compact(F.array(*(F.when(F.col(c) if isinstance(c, str) else c, F.lit(n)) for n, c in kinds.items())))).alias("error"))
    return found.select(F.lit(None).cast("string").alias("country"), "error")


def source_errors(sources: DataFrame, markets: DataFrame, index: DataFrame, rules: DataFrame) -> DataFrame:
    """(country, error) of markets (country, currency) against their sources (country, url, served), the index (country, urls)
    and their rules: pages served for, or addressed to, another country, addresses that differ, and card fees in another
    currency."""
    error = lambda df, name: df.select("country", F.lit(name).alias("error")).distinct()
    own = sources.withColumn("_addressed", country_of_path(F.try_parse_url("url", F.lit("PATH"))))
    urls = sources.groupBy("country").agg(F.collect_set("url").alias("_urls")).join(index, "country")
    differ = (F.size(F.array_except("_urls", "urls")) > 0) | (F.size(F.array_except("urls", "_urls")) > 0)
    card = (F.col("product_id") == "payments") | (F.col("payment_method") == "card")
    priced = rules.where(F.col("status").isin("calculable_rule", "classified") & card).join(markets.select("country", "currency"), "country")
    return (
        error(own.where(F.upper("served") != F.upper("country")), "served_elsewhere").unionByName(error(own.where(F.col("_addressed") != F.upper("country")), "addressed_elsewhere"))
        .unionByName(error(urls.where(differ), "index_urls")).unionByName(error(priced.where(F.upper("fixed_currency") != F.upper("currency")), "currency"))
    )


def state_errors(states: DataFrame) -> DataFrame:
    """(country, error) of `one_state` rows (in_index, in_unsupported, in_transient, in_core, derivation, calculator).

    A market has one state; a supported one is complete and has core rules, any other has none.
    """
    n = sum((F.col(c).cast("int") for c in ("in_index", "in_unsupported", "in_transient")), F.lit(0))
    done = F.coalesce((F.col("derivation") == "complete") & (F.col("calculator") == "complete"), F.lit(False))
    found = violations(states, ["country"], {
        "not_one_state": n != 1, "incomplete": (n == 1) & F.col("in_index") & ~done, "no_core_rules": (n == 1) & F.col("in_index") & ~F.col("in_core"), "core_without_index": F.col("in_core") & ~F.col("in_index"),
        "core_not_supported": F.col("in_core") & (F.col("in_unsupported") | F.col("in_transient")),
    })
    return found.withColumnRenamed("rule", "error")


def schema_errors(df: DataFrame, required: Mapping[str, str]) -> list[str]:
    """Columns of `required` (name to type) that a table lacks, or has with another type."""
    own = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [f"{n}: {own.get(n, 'missing')}, not {t}" for n, t in required.items() if own.get(n) != t]


def metric_errors(counts: DataFrame, told: DataFrame) -> DataFrame:
    """Metrics (metric, value) that are told with another value than counted."""
    both = told.select("metric", F.col("value").alias("told")).join(counts.select("metric", F.col("value").alias("counted")), "metric", "left")
    return both.where(~F.col("told").eqNullSafe(F.col("counted")))


def every_error(*checks: DataFrame, strict: bool = False) -> DataFrame:
    """(country, error) of all checks, in order; with `strict`, any error is raised instead, the first ten of them named."""
    found = checks[0]
    for c in checks[1:]:
        found = found.unionByName(c)
    found = found.orderBy("country", "error")
    if strict and (some := found.limit(10).collect()):
        raise ValueError("; ".join(f"{r['country']}: {r['error']}" for r in some))
    return found
