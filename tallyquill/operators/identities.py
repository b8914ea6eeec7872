"""Rules of one identity: equal fees are merged, differing ones are conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyquill import tables
from tallyquill.functions.text import condition_key, stable_id
from tallyquill.operators.containment import followed, owners_of_kept, put_together, selected
from tallyquill.sources.shared import cut, dealt, kept, shuffled


#: What makes two fee components equal.
_PARTS = ("type", "value", "amount", "currency", "basis_points", "operator", "minor_amount")


def fee_signature(components: str = "components", *rest: str) -> Column:
    """Text that is equal for equal sets of fee components and equal `rest` (unit, exactness, behavior, plan)."""
    own = F.array_sort(F.transform(components, lambda c: F.concat_ws("\u0001", *(F.coalesce(c[n], F.lit("")) for n in _PARTS))))
    return F.concat_ws("\u0003", F.array_join(own, "\u0002"), *(F.coalesce(r, F.lit("")) for r in rest))


def fee_candidate(status: str = "status", components: str = "components") -> Column:
    """Calculable rules, and others without calculation that have a fee's number."""
    number = F.exists(components, lambda c: c["type"].isin(*tables.FEE_TYPES) & (c["value"].isNotNull() | c["amount"].isNotNull()))
    return F.col(status).isin("calculable_rule", "classified") | ((F.col(status) == "non_calculable") & number)


#: Statuses of equal fees: the most concrete one is kept.
_CONCRETE = ("calculable_rule", "classified", "non_calculable")


def _concrete(status: Column) -> Column:
    """Rank of a status, 0 the most concrete."""
    return F.coalesce(*(F.when(status == s, F.lit(k)) for k, s in enumerate(_CONCRETE)), F.lit(len(_CONCRETE)))


def _in_order(items: Column, order: list[Column]) -> Column:
    """The distinct items of a group's rows, by the rows' order."""
    return F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(*order, items.alias("_items")))), lambda x: x["_items"])))


def merged(rules: DataFrame, selector: list[str], signature: str, order: str, status: str, ids: str, lists: tuple[str, ...] = (), first: tuple[str, ...] = ()) -> DataFrame:
    """One row per selector and signature.

    first_at, n_rules, the most concrete status (of equals the first row's), the best confidence, the distinct `ids` (one
    a row, as entry_ids) and those of the array columns `lists` in order, and the `first` columns of the first row.
    Rows of one place are put in order by their id, so results don't depend on how rows arrive.
    """
    place = [F.col(order).alias("_at"), F.col(ids).alias("_id")]
    found = rules.groupBy(*selector, signature).agg(
        F.min(order).alias("first_at"), F.min_by(status, F.struct(_concrete(F.col(status)), *place)).alias("_status"), F.max("confidence").alias("confidence"), F.count("*").alias("n_rules"),
        _in_order(F.array(ids), place).alias("_ids"), *(_in_order(F.coalesce(F.col(c), F.array().cast("array<string>")), place).alias(f"_{c}") for c in lists), F.min_by(F.struct(*first, F.lit(0).alias("_")), F.struct(*place)).alias("_first"),
    )
    names = {"_status": status, "_ids": "entry_ids"} | {f"_{c}": c for c in lists}
    return found.select("*", *(F.col(f"_first.{c}").alias(c) for c in first)).drop("_first").withColumnsRenamed(names)


def _outcomes(rows: DataFrame, by: list[str], order: str, candidate: str, loose: Column, root: str | None = None) -> DataFrame:
    """Rows with `_kind` of outcome (loose, conflict, plain) and `_taker`, the `order` of the row that takes each up.

    A row that stays takes up itself.  Of several groups of an unspecified product the first takes all; of one fee
    candidate and others it does; several candidates stay apart, with all others; without any, the first takes all.
    Rows whose `root` is another row don't count, and go where their root goes.
    """
    own, root = Window.partitionBy(*by), root or order
    stays = F.col(root) == F.col(order)
    rows = rows.withColumns({
        "_n": F.count(F.when(stays, 1)).over(own), "_fees": F.count(F.when(stays & F.col(candidate), 1)).over(own),
        "_least": F.min(F.when(stays, F.col(order))).over(own), "_fee": F.min(F.when(stays & F.col(candidate), F.col(order))).over(own),
    })
    many = loose & (F.col("_n") > 1)
    kind = F.when(many, "loose").when(F.col("_fees") > 1, "conflict").otherwise("plain")
    taker = F.when(many, F.col("_least")).when(F.col("_fees") > 1, F.col(root)).otherwise(F.coalesce("_fee", "_least"))
    return rows.withColumns({"_kind": kind, "_taker": taker}).drop("_n", "_fees", "_least", "_fee")


def resolved(groups: DataFrame, selector: list[str], status: str = "status", candidate: str = "is_candidate", unspecified: Column | None = None, lists: tuple[str, ...] = (), signature: str = "signature") -> DataFrame:
    """Groups of `merged` with their outcome; what stays takes entry_ids and `lists` of what goes, in order.

    Groups are in order of first_at and, where rules of several signatures have one place, of their `signature`.

    An unspecified product with several groups is one informational row.  A single fee candidate absorbs the rest;
    of several candidates every group is a conflict without confidence; without any, the first absorbs the others.
    Groups that are absorbed go, and their ids are given to the one that stays.
    """
    rows = groups.withColumns({"_sel": selected(selector), "_place": F.struct("first_at", signature)})
    rows = _outcomes(rows, ["_sel"], "_place", candidate, F.lit(False) if unspecified is None else unspecified)
    names = ("entry_ids", *lists)
    of = lambda c: F.transform(c, lambda x, i: F.struct(F.lit(c).alias("kind"), x.cast("string").alias("item"), i.alias("at")))
    every = F.flatten(F.array_compact(F.array(*map(of, names))))
    items = rows.select("_sel", "_taker", "_place", F.explode(every).alias("x")).select("_sel", "_taker", "x.kind", "x.item", F.struct("_place", "x.at").alias("place"), F.lit(None).cast("string").alias("told"))
    found = put_together(items, ["_sel", "_taker"], names)
    kinds = {c: groups.schema[c].dataType.simpleString() for c in names}
    found = found.select("_sel", F.col("_taker").alias("_place"), *(F.transform(c, lambda x: x["item"]).cast(kinds[c]).alias(f"_{c}") for c in names))
    own = rows.where(F.col("_place") == F.col("_taker")).join(shuffled(found), ["_sel", "_place"], "left")
    fails = F.col("_kind") != "plain"
    outcome = F.when(F.col("_kind") == "loose", "informational").when(F.col("_kind") == "conflict", "conflict").otherwise(F.col(status))
    own = own.withColumns({status: outcome, "confidence": F.when(fails, F.lit(0.0)).otherwise(F.col("confidence"))} | {c: F.coalesce(f"_{c}", F.array().cast(kinds[c])) for c in names})
    return own.select(*groups.columns)


def absorbed_subsets(groups: DataFrame, selector: list[str], key: str, parts: str) -> DataFrame:
    """Groups without those whose set of `parts` lies within another's of the same selector; of equal sets the last key stays."""
    own = cut(groups.withColumn("_sel", selected(selector)))
    return own.join(shuffled(owners_of_kept(own, key, parts).drop("owner")), ["_sel", key], "left_anti").select(*groups.columns)


#: Lists that tell where a rule comes from.
_PROVENANCE = ("entry_ids", "source_texts", "rule_ids", "fragments", "phrases", "evidence_ids", "notes")
#: Fields of a fee that an informational rule of several unspecified ones hasn't got.
_FEE_FIELDS = ("percentage", "basis_points", "fixed_amount", "fixed_amount_minor", "fixed_currency", "minimum_amount", "maximum_amount")
#: What tells a conflict, beside the evidence that a rule has.
CONFLICT_NOTE = "conflict: semantic identity with differing fee signature"


def _told(rules: DataFrame) -> Column:
    """(kind, item, at, told) of all that a rule brings along."""
    texts = lambda c: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x, i: F.struct(F.lit(c).alias("kind"), x.alias("item"), i.alias("at"), F.lit(None).cast("string").alias("told")))
    own = [texts(c) for c in ("entry_ids", "source_texts", "phrases", "evidence_ids", "notes")]
    own.append(F.array(F.struct(F.lit("rule_ids").alias("kind"), F.col("rule_id").alias("item"), F.lit(0).alias("at"), F.lit(None).cast("string").alias("told"))))
    own.append(F.transform("fragments", lambda x, i: F.struct(F.lit("fragments").alias("kind"), x["text"].alias("item"), i.alias("at"), x["entry_id"].alias("told"))))
    return F.filter(F.concat(*own), lambda x: x["item"] != "")


def deduplicated_rules(rules: DataFrame, by: list[str]) -> DataFrame:
    """`classified` rules of one identity (product, variant, conditions; within `by`) as one, or as conflicts.

    Rules of equal fees are merged: fees of the first, the most concrete status, the best confidence and evidence.  A
    group whose components lie within another's is taken up by it.  Of what then differs, a single fee candidate takes up
    the rest, several are all conflicts, and several of an unspecified product are one informational rule without a fee.

    Every rule comes with its provenance, in the order in which it was taken up: entry_ids, source_texts, rule_ids,
    fragments (each text with its first entry), the evidence's phrases and evidence_ids, and notes.  Each rule's items are
    in one row; neither a page nor an identity is ever gathered.  Rules are shuffled twice, as rows: for their groups,
    and for their items, which are told and put together where the rules of their identity lie.
    """
    selector = [*by, "product_id", "variant_id", "condition_key"]
    plan = F.try_element_at(F.filter("conditions", lambda c: c["dimension"] == "pricing_plan"), F.lit(1))["value"]
    part = lambda c: F.concat_ws("\u0001", *(F.coalesce(c[n], F.lit("")) for n in _PARTS))
    signed = lambda df: df.withColumn("plan", plan).withColumn("signature", fee_signature("fee_components", "unit", "exactness", "behavior", "plan"))
    own = rules.withColumn("condition_key", condition_key("conditions")).withColumn("_sel", selected(selector))
    place = F.struct(F.col("entry_id").alias("a"), F.col("rule_id").alias("b"))
    columns = [c for c in rules.columns if c not in {*by, "entry_ids", "source_texts", "fragments", "phrases", "evidence_ids", "notes", "status", "confidence", "fee_evidence"}]
    # Texts that a rule's other columns make are made where it is dealt to.
    groups = signed(dealt(own.select("_sel", *by, *columns, "condition_key", "status", "confidence", "fee_evidence"), "_sel")).groupBy("_sel", "signature").agg(
        F.min_by("status", F.struct(_concrete(F.col("status")), place)).alias("status"), F.max("confidence").alias("confidence"), F.count("*").alias("n_rules"),
        F.min_by("fee_evidence", F.struct(_concrete(F.col("status")), -F.col("confidence"), place)).alias("fee_evidence"), F.min_by(F.struct(*by, *columns, "condition_key"), place).alias("_first"),
    ).select("*", "_first.*").drop("_first")
    # Groups have numbers in the order of their keys, so that edges, paths and items carry numbers in place of keys.
    in_order = Window.partitionBy("_sel").orderBy(F.concat_ws("\u0001", "entry_id", "rule_id", F.sha2("signature", 256)))
    groups = kept(groups.withColumns({"_key": F.row_number().over(in_order), "is_candidate": fee_candidate("status", "fee_components"), "component_keys": F.transform("fee_components", part)}))
    ends = followed(owners_of_kept(groups, "_key", "component_keys"), "_key")
    placed = dealt(groups.select("_sel", "signature", "_key", "is_candidate", (F.col("product_id") == "unspecified").alias("_loose")), "_sel").join(shuffled(dealt(ends, "_sel")), ["_sel", "_key"], "left")
    placed = _outcomes(placed.withColumn("root", F.coalesce("root", "_key")), ["_sel"], "_key", "is_candidate", F.col("_loose"), "root")
    # A taker's own lists come first, then those of the groups it takes up, each with what it had taken up itself.
    path = F.concat(F.array(F.when(F.col("root") == F.col("_taker"), 0).otherwise(F.col("root"))), F.coalesce("path", F.array().cast("array<int>")))
    placed = placed.withColumns({"_path": path, "_no": F.dense_rank().over(Window.partitionBy("_sel").orderBy("_taker"))})
    placed = kept(placed.select("_sel", "signature", "_key", "_taker", "_kind", "_no", F.row_number().over(Window.partitionBy("_sel").orderBy("_no", "_path")).alias("_rank")))
    takers = kept(groups.drop("signature", "component_keys").join(shuffled(placed.where("_key = _taker").drop("_taker", "_rank")), ["_sel", "_key"]))
    items = dealt(signed(own).select("_sel", "signature", "entry_id", "rule_id", *(c for c in _PROVENANCE if c != "rule_ids")), "_sel").join(shuffled(dealt(placed.select("_sel", "signature", "_no", "_rank"), "_sel")), ["_sel", "signature"])
    items = items.select("_sel", "_no", "_rank", "entry_id", "rule_id", F.explode(_told(rules)).alias("x"))
    items = items.select("_sel", "_no", "x.kind", "x.item", "x.told", F.struct("_rank", "entry_id", "rule_id", "x.at").alias("place"))
    lists = put_together(items, ["_sel", "_no"], _PROVENANCE)
    fragment = lambda x: F.struct(x["told"].alias("entry_id"), x["item"].alias("text"))
    lists = lists.select("_sel", "_no", *(F.transform(c, fragment if c == "fragments" else lambda x: x["item"]).alias(c) for c in _PROVENANCE))
    found = lists.join(shuffled(dealt(takers, "_sel")), ["_sel", "_no"])
    loose, conflict = F.col("_kind") == "loose", F.col("_kind") == "conflict"
    identity = F.array_join(F.transform(F.array_sort("conditions"), lambda c: F.concat_ws("=", c["dimension"], c["value"])), "|")
    none = {c: F.when(~loose, F.col(c)) for c in _FEE_FIELDS if c in rules.columns}
    found = found.withColumns(none | {
        "status": F.when(loose, "informational").when(conflict, "conflict").otherwise(F.col("status")), "confidence": F.when(loose | conflict, F.lit(0.0)).otherwise(F.col("confidence")),
        "rule_id": stable_id("product_id", "variant_id", identity, F.when(loose, "informational").otherwise(F.col("signature"))), "fee_components": F.when(loose, F.array().cast(rules.schema["fee_components"].dataType)).otherwise(F.array_sort("fee_components")),
        "unit": F.when(loose, "informational").otherwise(F.col("unit")), "behavior": F.when(loose, "informational").otherwise(F.col("behavior")), "is_candidate": F.col("is_candidate") & ~loose,
        "notes": F.when(conflict, F.concat("notes", F.array(F.lit(CONFLICT_NOTE)))).otherwise(F.col("notes")),
    })
    return found.select(*by, *columns, "condition_key", "n_rules", "is_candidate", "status", "confidence", "fee_evidence", *_PROVENANCE)


#: Counters by the status of rules, and of entries that are left over; what both have is added up.
_RULE_COUNTERS = {
    "calculable_rule": "calculable_rules", "non_calculable": "non_calculable_rules", "conflict": "conflicting_rule_identities", "included": "included", "free": "free", "informational": "informational",
    "custom_pricing": "custom_pricing", "unsupported_fee_shape": "unsupported_fee_shapes",
}
_ENTRY_COUNTERS = {
    "unclassified_fee_candidate": "unclassified_fee_candidates", "ambiguous": "ambiguous_entries", "unsupported_fee_shape": "unsupported_fee_shapes", "ignored_non_fee": "ignored_non_fee",
    "reference_only": "reference_only", "included": "included", "free": "free", "informational": "informational", "custom_pricing": "custom_pricing",
}


def counters(entries: DataFrame, rules: DataFrame, leftovers: DataFrame, by: list[str]) -> DataFrame:
    """All counters of coverage per group: of entries (entry_id, has_fee), rules (entry_ids, status, is_candidate) and
    leftovers (entry_id, status, has_fee).

    An entry with a fee is dropped if neither a rule nor a leftover refers to it.  Groups without rules or leftovers
    have zeros.
    """
    used = rules.select(*by, F.explode("entry_ids").alias("entry_id")).unionByName(leftovers.select(*by, "entry_id")).distinct().withColumn("_used", F.lit(True))
    of_entries = entries.join(shuffled(used), [*by, "entry_id"], "left").groupBy(*by).agg(
        F.count("*").alias("source_entries"), F.count_if("has_fee").alias("numeric_source_entries"), F.count_if(F.col("has_fee") & F.col("_used").isNotNull()).alias("referenced_numeric_entries"),
        F.count_if(F.col("has_fee") & F.col("_used").isNull()).alias("dropped_numeric_entries"),
    )
    clash = F.col("status") == "conflict"
    of_rules = rules.groupBy(*by).agg(
        *(F.count_if(F.col("status") == s).alias(f"r_{c}") for s, c in _RULE_COUNTERS.items()), F.count_if(clash & F.col("is_candidate")).alias("blocking_fee_conflicts"), F.count_if(clash & ~F.col("is_candidate")).alias("informational_conflicts")
    )
    of_left = leftovers.groupBy(*by).agg(
        *(F.count_if(F.col("status") == s).alias(f"e_{c}") for s, c in _ENTRY_COUNTERS.items()), F.count_if(F.col("has_fee") & ~F.col("status").isin(*tables.CLOSED)).alias("numeric_fee_candidates")
    )
    every = of_entries.join(shuffled(of_rules), by, "left").join(shuffled(of_left), by, "left").na.fill(0)
    names = list(dict.fromkeys([*_RULE_COUNTERS.values(), *_ENTRY_COUNTERS.values()]))
    sums = [sum((F.col(p + n) for p, own in (("r_", _RULE_COUNTERS), ("e_", _ENTRY_COUNTERS)) if n in own.values()), F.lit(0)).cast("long").alias(n) for n in names]
    plain = ("source_entries", "numeric_source_entries", "referenced_numeric_entries", "dropped_numeric_entries", "blocking_fee_conflicts", "informational_conflicts", "numeric_fee_candidates")
    return every.select(*by, *plain, *sums)


def summed(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row with the sum of every counter over all groups."""
    return rows.agg(*(F.sum(c).alias(c) for c in rows.columns if c not in by))


def coverage(rules: DataFrame, leftovers: DataFrame, by: list[str]) -> DataFrame:
    """Counters per group of rules (status, is_candidate) and leftover entries (status, has_fee), and two summaries.

    derivation: unclassified without rules and leftovers, complete with rules and every leftover resolved, else partial.
    """
    r = rules.groupBy(*by).agg(
        F.count("*").alias("rules"), F.count_if(F.col("status") == "calculable_rule").alias("calculable_rules"), F.count_if(F.col("status") == "conflict").alias("conflicts"),
        F.count_if((F.col("status") == "conflict") & F.col("is_candidate")).alias("blocking_conflicts"), F.count_if(F.col("status") != "conflict").alias("authoritative"),
    )
    closed = F.col("status").isin("ignored_non_fee", "informational", "reference_only", "custom_pricing", "included", "free", "unsupported_fee_shape")
    e = leftovers.groupBy(*by).agg(F.count("*").alias("leftovers"), F.count_if(~closed).alias("unresolved"), F.count_if(~closed & F.col("has_fee")).alias("numeric_fee_candidates"))
    both = r.join(shuffled(e), by, "full_outer").na.fill(0)
    derivation = F.when((F.col("rules") == 0) & (F.col("leftovers") == 0), "unclassified").when(F.col("authoritative") == 0, "partial").when(F.col("unresolved") == 0, "complete").otherwise("partial")
    calculator = (
        F.when((F.col("authoritative") == 0) & ((F.col("conflicts") > 0) | (F.col("leftovers") > 0)), "partial").when(F.col("authoritative") == 0, "unclassified")
        .when(F.col("numeric_fee_candidates") > 0, "partial").otherwise("complete")
    )
    return both.withColumns({"derivation": derivation, "calculator": calculator})
