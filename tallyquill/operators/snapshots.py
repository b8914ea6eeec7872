"""Differences between two publications: markets, counts, rules, states and files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.functions.money import relative_change
from tallyquill.operators.order import first_per_key, later_duplicates


@dataclass(frozen=True)
class Thresholds:
    """Shares by which counts may drop, and numbers may change, before it is reported."""

    market_drop: float = 0.2
    section_drop: float = 0.5
    entry_drop: float = 0.5
    rule_drop: float = 0.5
    percentage_change: float = 0.5
    fixed_change: float = 0.5


def _change(kind: str | Column, country: str | None, key: Column | None, before: Column | None, after: Column | None) -> list[Column]:
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    return [(F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), text(None if country is None else F.col(country)).alias("country"), text(key).alias("key"), text(before).alias("before"), text(after).alias("after")]


def market_sets(old: DataFrame, new: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Markets that went and came, and one row if too large a share of them went."""
    was, now = old.select("country").distinct(), new.select("country").distinct()
    gone, come = was.join(now, "country", "left_anti"), now.join(was, "country", "left_anti")
    sums = was.join(now.withColumn("_there", F.lit(True)), "country", "left").agg(F.count("*").alias("n"), F.count_if(F.col("_there").isNull()).alias("lost"))
    sharp = sums.where((F.col("n") > 0) & (F.col("lost") > t.market_drop * F.col("n")))
    return gone.select(*_change("removed_market", "country", None, None, None)).unionByName(come.select(*_change("new_market", "country", None, None, None))).unionByName(
        sharp.select(*_change("sharp_market_drop", None, None, F.col("n"), F.col("n") - F.col("lost")))
    )


def market_counts(old: DataFrame, new: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Of markets in both (country, n_sections, n_entries, n_rules, status): sharp drops, lost rules, lost classification."""
    both = old.alias("o").join(new.alias("n"), "country")
    o, n = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    drop = lambda c, share: (o(c) > 0) & (n(c) < (1 - share) * o(c))
    row = lambda kind, c, hit: F.when(hit, F.struct(*_change(kind, None, None, o(c), n(c))))
    lost = (o("n_rules") > 0) & (n("n_rules") == 0)
    found = F.array_compact(F.array(
        row("sharp_section_drop", "n_sections", drop("n_sections", t.section_drop)), row("sharp_entry_drop", "n_entries", drop("n_entries", t.entry_drop)),
        row("lost_core_category", "n_rules", lost), row("sharp_rule_drop", "n_rules", ~lost & drop("n_rules", t.rule_drop)),
        row("classified_to_unclassified", "status", o("status").isin("complete", "partial") & (n("status") == "unclassified")),
    ))
    return both.select("country", F.explode(found).alias("c")).select("c.kind", "country", "c.key", "c.before", "c.after")


def rule_values(old: DataFrame, new: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Of rules in both (country, rule_id, percentage, fixed_amount, fixed_currency, at): large changes and other currencies.

    Of rules that repeat an id the last one counts, on either side.
    """
    last = lambda df: first_per_key(df, ["country", "rule_id"], [F.col("at").desc()])
    both = last(old).alias("o").join(last(new).alias("n"), ["country", "rule_id"])
    o, n = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    far = lambda c, share: F.abs(relative_change(o(c), n(c))) > share
    row = lambda kind, c, hit: F.when(hit, F.struct(F.lit(kind).alias("kind"), o(c).cast("string").alias("before"), n(c).cast("string").alias("after")))
    found = F.array_compact(F.array(
        row("large_percentage_change", "percentage", far("percentage", t.percentage_change)),
        row("large_fixed_change", "fixed_amount", far("fixed_amount", t.fixed_change) & (o("fixed_amount").try_cast("double") != 0)),
        row("currency_changed", "fixed_currency", ~o("fixed_currency").eqNullSafe(n("fixed_currency"))),
    ))
    return both.select("country", F.col("rule_id").cast("string").alias("key"), F.explode(found).alias("c")).select("c.kind", "country", "key", "c.before", "c.after")


def duplicate_rules(new: DataFrame) -> DataFrame:
    return later_duplicates(new, ["country", "rule_id"], ["at"]).select(*_change("duplicate_identifier", "country", F.col("rule_id"), None, None))


def state_transitions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Markets (country, state) supported before and not now: unsupported, transient, or missing, the first that holds."""
    was = old.where("state = 'supported'").select("country").distinct()
    now = new.groupBy("country").agg(F.array_sort(F.collect_set("state")).alias("states"))
    lost = was.join(now, "country", "left").where(~F.coalesce(F.array_contains("states", "supported"), F.lit(False)))
    kind = (
        F.when(F.array_contains("states", "unsupported"), "supported_to_unsupported").when(F.array_contains("states", "transient"), "supported_to_transient")
        .when(F.col("states").isNull(), "discovered_to_missing")
    )
    return lost.select(*_change(kind, "country", None, None, None)).where("kind is not null")


def changed_files(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths (path, sha) that were added, removed or changed."""
    both = old.select("path", F.col("sha").alias("was")).join(new.select("path", F.col("sha").alias("now")), "path", "full_outer")
    kind = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "changed")
    return both.select("path", kind.alias("change")).where("change is not null")


#: Kinds that count as regressions; `new_market` doesn't.
def has_regression(changes: DataFrame) -> DataFrame:
    return changes.agg(F.coalesce(F.bool_or(F.col("kind") != "new_market"), F.lit(False)).alias("has_regression"))


def market_totals(sections: DataFrame, entries: DataFrame, rules: DataFrame, leftovers: DataFrame, statuses: DataFrame) -> DataFrame:
    """What `market_counts` compares, of tables that each have country: sections, entries with rules and leftovers, rules, status."""
    of = lambda df, n: df.groupBy("country").agg(F.count("*").alias(n))
    every = statuses.select("country", "status")
    for df, n in ((sections, "n_sections"), (entries, "_entries"), (rules, "n_rules"), (leftovers, "_left")):
        every = every.join(of(df, n), "country", "left")
    every = every.na.fill(0, ["n_sections", "_entries", "n_rules", "_left"])
    return every.select("country", "n_sections", (F.col("_entries") + F.col("n_rules") + F.col("_left")).alias("n_entries"), "n_rules", "status")


@dataclass(frozen=True)
class Publication:
    """One publication's relations: markets and counts per country, rules, and states of countries."""

    counts: DataFrame
    rules: DataFrame
    states: DataFrame


def changes(old: Publication, new: Publication, t: Thresholds = Thresholds()) -> DataFrame:
    """All changes from one publication to the next: markets, counts, rule values, repeated rules and states."""
    parts = [market_counts(old.counts, new.counts, t), rule_values(old.rules, new.rules, t), duplicate_rules(new.rules), state_transitions(old.states, new.states)]
    found = market_sets(old.counts, new.counts, t)
    for p in parts:
        found = found.unionByName(p)
    return found
