"""Queries over fee entries that are made of the part table: its keys pick phrase, headings, evidence and country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.functions import dimensions, evidence, money, text
from tallyquill.operators import identities, rules
from tallyquill.plans.registry import query
from tallyquill.sources.files import table

#: Phrases with what a reader sees in them: percentage, amount, currency, exactness, number of tokens.
PHRASES = [
    ("1.5% + 0.25 € for European Economic Area cards", "1.5", "0.25", "EUR", "exact", 2),
    ("2.9% + $0.30 per successful charge for domestic cards", "2.9", "0.30", "USD", "exact", 2),
    ("3,25% + 20p for international credit cards", "3.25", "0.20", "GBP", "exact", 2),
    ("2% per transaction for cards issued outside India", "2", None, None, "exact", 1),
    ("1.2% for UK debit cards", "1.2", None, None, "exact", 1),
    ("+ 2% if currency conversion is required", "2", None, None, "exact", 1),
    ("$5.00 cap", None, "5.00", "USD", "exact", 1),
    ("minimum USD 1.00", None, "1.00", "USD", "from", 1),
    ("Included", None, None, None, "included", 1),
    ("Free for premium Visa and Mastercard cards", None, None, None, "free", 1),
    ("iDEAL 0.80 EUR per transaction", None, "0.80", "EUR", "exact", 1),
    ("A$15.00 for disputed payments", None, "15.00", "AUD", "exact", 1),
    ("Klarna 3.29% + 1.000,35 €", "3.29", "1000.35", "EUR", "exact", 2),
    ("Link 2.6% + $0.30 for Instant Bank Payments", "2.6", "0.30", "USD", "exact", 2),
    ("Affirm Enhanced 5 % + $0.30", "5", "0.30", "USD", "exact", 2),
    ("+ $0.10 per authorization for Tap to Pay", None, "0.10", "USD", "exact", 1),
    ("Starting at $10 per month", None, "10", "USD", "from", 1),
    ("$400 per year with a 1-year contract", None, "400", "USD", "exact", 1),
    ("Custom quote for volume pricing", None, None, None, "custom", 1),
    ("0.4% uplift per Visa resolution", "0.4", None, None, "exact", 1),
    ("$0.50 per", None, "0.50", "USD", "exact", 1),
    ("Over 250 million API requests", None, None, None, "exact", 0),
    ("P24 2.2% + 0.30 €", "2.2", "0.30", "EUR", "exact", 2),
    ("$59 reader", None, "59", "USD", "exact", 1),
    ("Custom pricing 0.7% per successful transaction", "0.7", None, None, "custom", 1),
    ("Canada, France, and Spain 1.4%", "1.4", None, None, "exact", 1),
    ("0.5% of billing volume, no-code", "0.5", None, None, "exact", 1),
    ("€0.03 per API call", None, "0.03", "EUR", "exact", 1),
    ("2 $ per institution per account holder per month", None, "2", "USD", "exact", 1),
    ("wire transfer $8.00", None, "8.00", "USD", "exact", 1),
    ("30% of customers use cards", "30", None, None, "exact", 1),
]
PATHS = [
    "Payments", "Payments|Cards", "Terminal", "Radar|Machine Learning", "Disputes", "Payment methods|Smart Disputes", "Tax|Tax Complete", "Payment methods|ACH Direct Debit", "Custom pricing|Adaptive Pricing",
    "Invoicing", "Subscriptions|Managed payments", "Fees",
]
EVIDENCE = ["", "online checkout", "Visa resolution\n$0.50\nin person", "API integration\n0.5%\nno-code integration\n$0.03", "Visa lookup\n0.4\nwaived for some", "per bank account"]
COUNTRIES = ["US", "GB", "IN", "DE", None]


def _picked(words: list[str | None], n: Column) -> Column:
    return F.get(F.array(*(F.lit(w).cast("string") for w in words)), n.cast("int"))


def entries(spark, sf) -> DataFrame:
    """A page for every 60 parts, with an entry for each of them."""
    k = F.col("p_partkey")
    own = table(spark, sf, "part").select(
        (k / 60).cast("int").cast("string").alias("url"), (k % 60).cast("int").alias("source_order"), k.cast("string").alias("entry_id"), F.split(_picked(PATHS, (k / 7).cast("int") % len(PATHS)), "[|]").alias("section_path"),
        F.lit(None).cast("string").alias("fee_category"), _picked([p[0] for p in PHRASES], k * 5 % len(PHRASES)).alias("source_text"), _picked(EVIDENCE, (k / 11).cast("int") % len(EVIDENCE)).alias("source_evidence"),
        F.lit(None).cast("string").alias("payment_method"), F.lit(None).cast("string").alias("channel"), _picked(COUNTRIES, (k / 60).cast("int") % len(COUNTRIES)).alias("account_country"),
    )
    return own


@query
def t05_t09_forms(spark, sf):
    own = entries(spark, sf).select("entry_id", "source_text", money.fee("source_text").alias("f"))
    return own.select("entry_id", "source_text", "f.percentage", "f.amount", "f.currency", "f.exactness", F.size("f.tokens").alias("n_tokens"))


@query
def d01_d05_cards(spark, sf):
    own = rules.described(entries(spark, sf))
    return own.select("entry_id", F.col("own_region").alias("region"), dimensions.card_origin(F.col("own_region"), F.col("account_country")).alias("origin"), F.col("own_tier").alias("tier"), "card_type", F.array_join("card_networks", ",").alias("networks"), F.array_join("customer_countries", ",").alias("countries"))


@query
def d06_d08_d18_terms(spark, sf):
    own = rules.described(entries(spark, sf))
    low = F.col("low")
    return own.select(
        "entry_id", dimensions.method_variant(low, F.col("own_method")).alias("variant"), dimensions.pricing_tier(low).alias("tier"), dimensions.contract_length(low).alias("contract"), F.col("pricing_plan").alias("plan"),
        "integration_type", dimensions.unit(low, F.col("own_product"), F.col("own_method")).alias("unit"),
    )


@query
def d09_d15_products(spark, sf):
    own = rules.described(entries(spark, sf))
    card = dimensions.is_card_product(F.col("own_product"))
    return own.select(
        "entry_id", F.col("own_method").alias("method"), F.col("own_channel").alias("channel"), F.col("own_product").alias("product"), dimensions.dispute_fee(F.col("low")).alias("dedicated"), card.alias("is_card"),
        dimensions.is_method_product(F.col("own_product")).alias("is_method"), dimensions.international_surcharge(F.col("low")).alias("abroad"),
    )


@query
def d16_d19_d22_roles(spark, sf):
    return rules.described(entries(spark, sf)).select("entry_id", "exactness", "role", "is_modifier")


@query
def d17_d26_conditions(spark, sf):
    own = rules.enriched(entries(spark, sf))
    texts = F.transform("conditions", lambda c: F.concat_ws("=", c["dimension"], c["value"]))
    return own.select("entry_id", F.array_join(texts, ";").alias("conditions"))


@query
def d21_components(spark, sf):
    own = rules.described(entries(spark, sf))
    parts = rules.components(F.col("fee.tokens"), F.col("role"), F.col("entry_id"), F.col("source_text"))
    told = F.transform(parts, lambda c: F.concat_ws(":", c["type"], F.coalesce(c["value"], c["amount"], F.lit("")), F.coalesce(c["currency"], F.lit("")), F.coalesce(c["basis_points"], c["minor_amount"], F.lit(""))))
    return own.select("entry_id", F.array_join(told, ";").alias("components"))


@query
def t18_t22_headings(spark, sf):
    own = rules.described(entries(spark, sf))
    return own.select("entry_id", F.col("nearest"), dimensions.per_noun(F.col("source_text"), F.col("source_evidence")).alias("noun"), dimensions.has_base_fee(F.col("fee")).alias("has_fee"), dimensions.is_price_line(F.col("low")).alias("is_price"))


@query
def f01_f08_evidence(spark, sf):
    own = entries(spark, sf).withColumn("fee", money.fee("source_text"))
    t, fee = F.col("source_text"), F.col("fee")
    return own.select(
        "entry_id", evidence.is_statistic(t, F.col("source_evidence"), fee).alias("statistic"), evidence.is_marketing(t).alias("marketing"), evidence.is_share_number(t, fee).alias("share"),
        evidence.is_promotion(t).alias("promotion"), dimensions.is_fee_phrase(t).alias("fee_phrase"), evidence.is_table_value(F.lower(t)).alias("table_value"),
    )


@query
def w01_j10_groups(spark, sf):
    own = rules.grouped(rules.enriched(entries(spark, sf)))
    return own.select("entry_id", "url", "product_id", "payment_method", "card_region", "card_tier", "variant_id", "is_modifier", "group_no")


@query
def a06_a07_f09_rules(spark, sf):
    found, _ = rules.classified(entries(spark, sf))
    return found.select("url", "group_no", "entry_id", "product_id", "variant_id", "unit", "exactness", "behavior", "channel", "status", "confidence", F.col("fee_evidence.type").alias("evidence"), "percentage", "fixed_amount", "fixed_currency")


@query
def f11_f13_leftovers(spark, sf):
    _, left = rules.classified(entries(spark, sf))
    return left.select("url", "entry_id", "status", "has_fee")


@query
def a01_a11_market_fees(spark, sf):
    """Entries to rules, rules of one identity to one, and the counters of each page, as one publication has them."""
    every = entries(spark, sf)
    found, left = rules.classified(every)
    merged = identities.deduplicated_rules(found, ["url"])
    numbered = every.select("url", "entry_id", dimensions.has_base_fee(money.fee("source_text")).alias("has_fee"))
    return identities.counters(numbered, merged, left, ["url"])


@query
def t21_account_country(spark, sf):
    own = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("https://x.com/"), _picked(["en-de/pricing", "gb/pricing/local-payment-methods", "pricing", "about", "fr-be/pricing"], F.col("p_partkey") % 5)).alias("url"))
    return own.select("p_partkey", text.account_country("url").alias("country"))
