"""What speaks against a fee: statistics, marketing, promotions, hardware prices, numbers in names, contradictions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyquill import tables
from tallyquill.functions.dimensions import has_base_fee, is_fee_phrase
from tallyquill.functions.money import once
from tallyquill.functions.text import has_any

_PRICED = ("fixed_amount", "fixed_surcharge")


def is_marketing(text: Column) -> Column:
    """Claims of audience or volume, and marketing words without any wording of a fee."""
    claim = has_any(text, tables.MAGNITUDES) & has_any(text, ("customers", "users", "addressable", "process"))
    return claim | (~is_fee_phrase(text) & has_any(text, tables.MARKETING_TERMS))


def is_share_number(text: Column, parsed: Column) -> Column:
    """A statistic of market share or adoption that holds a number."""
    return has_any(text, tables.STATISTICS) & has_base_fee(parsed)


def is_promotion(text: Column) -> Column:
    return has_any(text, tables.PROMOTIONS)


def is_statistic(text: Column, evidence: Column, parsed: Column, provider: str = "the provider") -> Column:
    """Whether an entry is no fee at all: marketing or a figure about the platform of `provider`."""
    both = F.lower(F.concat_ws(" ", text, F.coalesce(evidence, F.lit(""))))
    told = F.lit(False)
    for words in tables.NO_FEES:
        every = F.lit(True)
        for w in words:
            every = every & both.contains(w.format(provider=provider.lower()))
        told = told | every
    told = told | (both.contains("pci compliant") & ~both.rlike(r"\d+(?:\.\d+)?%?\s*(?:per|month|year|transaction)")) | (F.lower(text).startswith("included:") & ~has_base_fee(parsed))
    return is_share_number(text, parsed) | (~(is_fee_phrase(both) & has_base_fee(parsed)) & told)


def is_hardware_price(product: Column, method: Column, path_and_text: Column, components: Column) -> Column:
    """Terminals' prices of `LEAST_HARDWARE_PRICE` or more, in words of hardware and not of processing."""
    amounts = F.transform(F.filter(components, lambda c: c["type"].isin(*_PRICED) & c["currency"].isNotNull()), lambda c: c["amount"].try_cast("decimal(28,10)"))
    terminal = F.coalesce((product == "terminal") | (method == "terminal"), F.lit(False))
    return terminal & F.coalesce(F.array_max(amounts) >= tables.LEAST_HARDWARE_PRICE, F.lit(False)) & ~has_any(path_and_text, tables.PROCESSING) & has_any(path_and_text, tables.HARDWARE)


def is_number_of_name(components: Column) -> Column:
    """Whether an amount follows a word of letters that is no unit of money, as a number does that is part of a name."""
    units = (*tables.SYMBOLS, *tables.CURRENCIES)

    def of(c: Column) -> Column:
        words = F.regexp_extract_all(c["source_text"], F.concat(F.lit(r"(?:^|\s)([A-Za-z]+)\s*\Q"), c["amount"], F.lit(r"\E\b")), F.lit(1))
        priced = c["type"].isin(*_PRICED, "maximum_fee", "minimum_fee") & c["amount"].isNotNull()
        return F.coalesce(priced & F.exists(words, lambda w: ~w.isin(*tables.SYMBOLS) & ~F.upper(w).isin(*units)), F.lit(False))

    return F.exists(components, of)


def is_contradictory(components: Column) -> Column:
    """A fee beside a statement that it is included or free."""
    return F.exists(components, lambda c: c["type"].isin(*tables.FEE_TYPES)) & F.exists(components, lambda c: c["type"].isin("included", "free"))


_NAMED = "|".join(re.escape(n.replace("_", " ")) for n in sorted({*tables.METHODS, *tables.NETWORK_NAMES}, key=lambda n: (-len(n), n)))


def is_table_value(text: Column) -> Column:
    """A percentage or amount beside the name of a method or card network, in lower-cased text."""
    return text.rlike(tables.PRICE_PATTERN) & text.rlike(rf"\b(?:{_NAMED})\b")


def decided(promotion: Column, marketing: Column, crossed: Column, hardware: Column, name: Column, contradiction: Column, phrase: Column, table_value: Column) -> Column:
    """(type, confidence) of the first of the findings that holds."""
    kinds = [
        (promotion, "promotional_language", 0.1), (marketing, "marketing_prose", 0.0), (crossed, "cross_fragment_fee_evidence", 0.0), (hardware, "hardware_price", 0.0), (name, "alphanumeric_method_name", 0.0),
        (contradiction, "contradictory_fee_evidence", 0.0), (phrase, "explicit_fee_phrase", 0.85), (table_value, "pricing_table_value", 0.75),
    ]
    found = [F.when(F.coalesce(holds, F.lit(False)), F.struct(F.lit(t).alias("type"), F.lit(c).alias("confidence"))) for holds, t, c in kinds]
    return F.coalesce(*found, F.struct(F.lit("insufficient").alias("type"), F.lit(0.0).alias("confidence")))


def status(how: Column, calculable: Column, evidence: Column, via: Column, unit: Column, behavior: Column) -> Column:
    """(status, confidence) of a rule by its exactness, its evidence and whether channel, unit and behavior are known."""
    kind = evidence["type"]
    first = (
        F.when((how == "custom") | (~calculable & (how == "from")), "custom_pricing").when(how.isin("included", "free"), how)
        .when(calculable & kind.isin(*tables.GOOD_EVIDENCE), "calculable_rule").otherwise("non_calculable")
    )
    weak = kind.isin("contradictory_fee_evidence", "cross_fragment_fee_evidence")
    known = via.isNotNull() & unit.isNotNull() & behavior.isNotNull() & (evidence["confidence"] >= tables.LEAST_CONFIDENCE) & kind.isin(*tables.GOOD_EVIDENCE)

    def then(own: Column) -> Column:
        return (
            F.when(kind == "promotional_language", "custom_pricing").when(kind.isin("marketing_prose", "hardware_price", "alphanumeric_method_name"), "informational")
            .when(weak | ((own == "calculable_rule") & ~known), "non_calculable").otherwise(own)
        )

    return once(once(first, then), lambda own: F.struct(own.alias("status"), F.when(own == "calculable_rule", evidence["confidence"]).otherwise(0.0).alias("confidence")))
