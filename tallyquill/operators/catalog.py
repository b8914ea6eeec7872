"""Aggregates across markets: method catalog, fees nested by market, index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.functions.text import method_family
from tallyquill.operators.containment import put_together
from tallyquill.operators.order import renumbered


def method_catalog(rules: DataFrame) -> DataFrame:
    """Per method of (method, display, country, rule_id, url, status): family, first display name, and the distinct countries,
    rule ids and addresses in order, with their numbers.  Conflicts and rules without a method don't count.

    Repeats are gone before a list is made, and names without any list are told apart by `n_rules` alone.
    """
    own = rules.where("method is not null and status <> 'conflict'")
    parts = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("item")) for k, c in (("countries", "country"), ("rule_ids", "rule_id"), ("urls", "url"))))
    items = own.select("method", F.explode(parts).alias("x")).select("method", "x.kind", "x.item", F.col("x.item").alias("place"), F.lit(None).cast("string").alias("told")).where("item is not null")
    lists = put_together(items, ["method"], ("countries", "rule_ids", "urls"))
    names = own.groupBy("method").agg(F.min("display").alias("display"))
    found = names.join(lists, "method", "left").select("method", method_family("method").alias("family"), "display", *(F.coalesce(F.transform(c, lambda x: x["item"]), F.array().cast("array<string>")).alias(c) for c in ("countries", "rule_ids", "urls")))
    return found.withColumn("n_rules", F.size("rule_ids").cast("long"))


#: Statuses of rules that a calculator reads.
CORE = ("classified", "calculable_rule")
#: Fields of a published fee component.
_COMPONENT = ("type", "value", "amount", "currency", "minor_amount", "basis_points", "operator")


def core_components(components: str = "fee_components") -> Column:
    """Components without where they come from; of a rule without any, those that its flat fields tell."""
    part = lambda **own: F.struct(*(own.get(n, F.lit(None)).cast("string").alias(n) for n in _COMPONENT))
    told = lambda kind, c, **own: F.when(F.coalesce(F.col(c) != "", F.lit(False)), part(type=F.lit(kind), **own))
    flat = F.array_compact(F.array(
        told("percentage", "percentage", value=F.col("percentage"), basis_points=F.col("basis_points")), told("fixed_amount", "fixed_amount", amount=F.col("fixed_amount"), currency=F.col("fixed_currency"), minor_amount=F.col("fixed_amount_minor")),
        told("minimum_fee", "minimum_amount", amount=F.col("minimum_amount"), currency=F.col("fixed_currency")), told("maximum_fee", "maximum_amount", amount=F.col("maximum_amount"), currency=F.col("fixed_currency")),
    ))
    own = F.transform(components, lambda c: part(**{n: c[n] for n in _COMPONENT}))
    return F.when(F.size(components) > 0, own).otherwise(flat)


def core_rules(rules: DataFrame, provider: str) -> DataFrame:
    """The rules that a calculator reads, as they are published: no provenance, components as `core_components` has them."""
    label = F.coalesce(F.nullif("label", F.lit("")), "product_id")
    return rules.where(F.col("status").isin(*CORE)).select(
        "rule_id", "product_id", "variant_id", label.alias("label"), F.lit(provider).alias("provider"), "account_country", "channel", "payment_method", "conditions", core_components().alias("fee_components"), "unit", "behavior", "exactness",
        F.col("status").alias("classification_status"), "confidence", "fee_evidence",
    )


def core_fees(rules: DataFrame, markets: DataFrame) -> DataFrame:
    """Per market the number of rules that a calculator reads and of all others; markets without rules stay.

    The rules themselves are `core_rules`; nothing is gathered to be counted.
    """
    good = F.col("status").isin(*CORE)
    own = rules.groupBy("country").agg(F.count_if(good).cast("int").alias("n_core"), F.count_if(~good).alias("unclassified_count"))
    return markets.join(own, "country", "left").withColumns({"n_core": F.coalesce("n_core", F.lit(0)), "unclassified_count": F.coalesce("unclassified_count", F.lit(0))})


def unsupported_only(markets: DataFrame) -> DataFrame:
    """Markets (status) that are not supported, without those that failed for the moment."""
    return markets.where(~F.coalesce(F.col("status") == "transient_failure", F.lit(False)))


def in_page_order(entries: DataFrame, pages: DataFrame, by: list[str]) -> DataFrame:
    """Entries (by, url, source_order, entry_id) numbered anew within `by`: pages by their `position`, then as they stand.

    `pages` (by, url, position) is a list of addresses; entries of an address that isn't in it come with the first page.
    """
    known = pages.groupBy(*by, "url").agg(F.min("position").alias("_page"))
    rows = entries.join(known, [*by, "url"], "left").withColumn("_page", F.coalesce("_page", F.lit(0)))
    return renumbered(rows, by, ["_page", "source_order", "entry_id"]).drop("_page")


def market_index(markets: DataFrame, *content: str) -> DataFrame:
    """Markets with the sha256 of their content columns as JSON."""
    return markets.withColumn("content_hash", F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256))
