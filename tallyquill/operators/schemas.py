"""Published documents held against the schema of their kind: every error with its place, however deep it lies.

A kind is compiled into one expression over a document that was parsed as a variant, so that any JSON is read and a value
of another type is told and not lost.  The same kind makes the schema document that is published.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """What a value may be; fields are (name, kind, required, may be null)."""

    type: str
    one_of: tuple[str, ...] = ()
    pattern: str = ""
    inner: Kind | None = None
    fields: tuple[tuple[str, Kind, bool, bool], ...] = ()


TEXT, WHOLE, NUMBER, FLAG, ANY = (Kind(t) for t in ("string", "integer", "number", "boolean", "any"))
COUNTRY = Kind("string", pattern="^[A-Za-z]{2}$")


def one_of(words: str) -> Kind:
    return Kind("string", tuple(words.split()))


def items(inner: Kind) -> Kind:
    return Kind("array", inner=inner)


def mapping(inner: Kind) -> Kind:
    return Kind("map", inner=inner)


def record(fields: dict[str, Kind], texts: str = "", **more: str) -> Kind:
    """Fields by name; `!` behind a name: required, `?`: may be null.  `texts`, and `wholes`, name more of that kind."""
    every = fields | {n: TEXT for n in texts.split()} | {n: WHOLE for n in more.get("wholes", "").split()}
    return Kind("object", fields=tuple((n.rstrip("!?"), k, n.endswith("!"), n.endswith("?")) for n, k in every.items()))


# The names, types and values of published documents.
_STATUS = one_of("classified unclassified non_calculable partial calculable_rule reference_only included free custom_pricing informational unsupported_fee_shape unclassified_fee_candidate ignored_non_fee ambiguous conflict")
_EXACTNESS = one_of("exact from range tiered included free custom non_calculable")
_DERIVATION = one_of("complete partial unclassified failed")
_CALCULATOR = one_of("complete partial unclassified failed not_calculable")
_UNIT = one_of("per_transaction per_attempt per_dispute per_payout per_refund per_api_call per_verification per_screened_transaction per_connected_account per_active_user monthly yearly per_invoice per_charge informational")
_BEHAVIOR = one_of("additive alternative mutually_exclusive conditional informational")
_EVIDENCE = one_of("explicit_fee_phrase pricing_table_value structured_fee_field product_price marketing_prose promotional_language hardware_price alphanumeric_method_name insufficient custom_pricing included free contradictory_fee_evidence cross_fragment_fee_evidence")
_COMPONENT_TYPE = one_of("percentage fixed_amount maximum_fee minimum_fee percentage_surcharge fixed_surcharge included free tiered custom_pricing non_calculable")

_LINK = record({}, "text? uri?")
_TOKEN = record({"is_minor_currency": FLAG}, "raw! kind value? amount? currency? operator? percentage? basis_points? exactness? token_id? note?")
_COMPONENT = record({"type!": _COMPONENT_TYPE}, "value? amount? currency? minor_amount? basis_points? schedule_id? operator? source_text? source_entry_id?")
_CONDITION = record({"value!": ANY}, "dimension! operator evidence?")
_FEE_EVIDENCE = record({"type!": _EVIDENCE, "source_entry_ids": items(TEXT), "phrases": items(TEXT), "confidence": NUMBER})
_SOURCE = record({}, "requested_url! effective_url? canonical_url? detected_market? detected_locale? detected_currency? page_id? page_title? page_updated_at? source_updated_at? etag? last_modified? content_sha256? evidence_text?")
_SECTION = record({"level?": WHOLE, "section_path": items(TEXT), "links": items(_LINK)}, "section_id? heading? body?", wholes="source_order")
_ENTRY = record(
    {"section_path": items(TEXT), "qualifiers": items(TEXT), "footnotes": items(TEXT), "tokens": items(_TOKEN), "links": items(_LINK), "context": mapping(ANY), "classification_status": _STATUS, "confidence": NUMBER, "classification_evidence": items(TEXT)},
    "entry_id! source_text! source_url! product? product_category? fee_category? payment_method_family? payment_method? channel? source_evidence?", wholes="source_order",
)
_RULE = record(
    {
        "contributing_entry_ids": items(TEXT), "currency_conversion_required?": FLAG, "recurring?": FLAG, "unit": _UNIT, "exactness": _EXACTNESS, "behavior": _BEHAVIOR, "conditions": items(_CONDITION), "additional_fees": items(TEXT),
        "fee_components": items(_COMPONENT), "source_texts": items(TEXT), "source_fragments": items(mapping(ANY)), "classification_status": _STATUS, "confidence": NUMBER, "classification_evidence": items(TEXT), "fee_evidence?": _FEE_EVIDENCE,
    },
    "rule_id! entry_id? product_id? variant_id? label? name? provider account_country? channel? payment_method? card_origin? card_region? card_tier? customer_country? presentment_currency? settlement_currency? transaction_amount_min? transaction_amount_max? "
    "billing_type? payout_type? dispute_state? percentage? basis_points? fixed_amount? fixed_amount_minor? fixed_currency? minimum_amount? maximum_amount? source_text? source_url?",
)
_COVERAGE = record({}, wholes="source_entries calculable_rules non_calculable_rules numeric_source_entries referenced_numeric_entries dropped_numeric_entries numeric_fee_candidates unclassified_fee_candidates ambiguous_entries conflicting_rule_identities unsupported_fee_shapes ignored_non_fee reference_only included free informational custom_pricing blocking_fee_conflicts informational_conflicts")
_MARKET = record({"account_country!": COUNTRY, "languages": items(record({}, "code! name?")), "status": one_of("discovered supported unsupported pricing_page_unavailable transient_failure")}, "market_code! country_name! locale! url_prefix! region? preferred_language? default_currency?")
_UNSUPPORTED = record({"account_country?": COUNTRY, "requested_urls": items(TEXT), "status": one_of("unsupported pricing_page_unavailable transient_failure explicitly_excluded")}, "market_code! country_name? reason? checked_at?")
_CORE_RULE = record(
    {"conditions": items(_CONDITION), "fee_components": items(_COMPONENT), "classification_status": _STATUS, "exactness": _EXACTNESS, "confidence": NUMBER, "fee_evidence?": _FEE_EVIDENCE},
    "rule_id! product_id? variant_id? label? provider account_country? channel? payment_method? unit behavior",
)
_HEAD = {"schema_version": WHOLE, "generated_at?": TEXT}

KINDS: dict[str, Kind] = {
    "market": record(
        _HEAD | {
            "market!": _MARKET, "sources": items(_SOURCE), "sections": items(_SECTION), "entries": items(_ENTRY), "derived_rules": items(_RULE), "unclassified_entries": items(_ENTRY), "warnings": items(record({"context?": mapping(ANY)}, "code! message!")),
            "derivation_status": _DERIVATION, "calculator_coverage_status": _CALCULATOR, "coverage_summary": _COVERAGE, "transient_failure": FLAG, "unsupported_reason?": TEXT, "requested_urls": items(TEXT),
        }
    ),
    "index": record(_HEAD | {"markets": items(record({"account_country!": COUNTRY, "source_urls": items(TEXT), "schema_version": WHOLE}, "market_code! locale! data_path! source_updated_at? derivation_status? calculator_coverage_status? content_sha256?"))}),
    "core_fees": record(_HEAD | {"markets": items(record({"account_country!": COUNTRY, "derivation_status!": _DERIVATION, "calculator_coverage_status": _CALCULATOR, "coverage_summary": _COVERAGE, "rules": items(_CORE_RULE)}, "market_code! locale!", wholes="unclassified_count"))}),
    "payment_methods": record(_HEAD | {"methods": items(record({"localized_names": items(record({}, "language! name!")), "supported_account_countries": items(TEXT), "fee_rule_refs": items(TEXT), "source_refs": items(TEXT)}, "method_id! family! display_name!"))}),
    "manifest": record(_HEAD | {"markets": items(_MARKET), "unsupported": items(_UNSUPPORTED), "aliases": mapping(TEXT), "fee_page_urls": mapping(items(TEXT)), "transient_failures": items(_UNSUPPORTED)}),
}

#: How a variant's own schema begins for each type.
_TELLS = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DECIMAL", "DOUBLE"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "map": ("OBJECT",), "array": ("ARRAY",)}
_ERRORS = "array<struct<place:string,error:string>>"


def _errors(root: Column, path: str, kind: Kind, place: Column) -> Column:
    """Errors of the value at `path` of a variant, which is there and no null."""
    none = F.array().cast(_ERRORS)
    if kind.type == "any":
        return none
    said = lambda text: F.array(F.struct(place.alias("place"), F.lit(text).alias("error"))).cast(_ERRORS)
    own = F.schema_of_variant(F.try_variant_get(root, path, "variant"))
    fits = F.lit(False)
    for t in _TELLS[kind.type]:
        fits = fits | own.startswith(t)
    if kind.type == "object":
        parts = []
        for name, inner, required, nullable in kind.fields:
            at = f"{path}.{name}"
            there = F.concat(place, F.lit(f".{name}"))
            tells = F.schema_of_variant(F.try_variant_get(root, at, "variant"))
            lacks = F.array(F.struct(there.alias("place"), F.lit("missing").alias("error"))).cast(_ERRORS) if required else none
            null = none if nullable else F.array(F.struct(there.alias("place"), F.lit("null").alias("error"))).cast(_ERRORS)
            parts.append(F.when(tells.isNull(), lacks).when(tells == "VOID", null).otherwise(_errors(root, at, inner, there)))
        inside = F.flatten(F.array(*parts)) if parts else none
    elif kind.type == "array":
        each = lambda x, i: _item(x, kind.inner, F.concat(place, F.lit("["), i.cast("string"), F.lit("]")))
        inside = F.flatten(F.transform(F.try_variant_get(root, path, "array<variant>"), each))
    elif kind.type == "map":
        pairs = F.map_entries(F.try_variant_get(root, path, "map<string,variant>"))
        inside = F.flatten(F.transform(pairs, lambda x: _item(x["value"], kind.inner, F.concat(place, F.lit("."), x["key"]))))
    else:
        text, inside = F.try_variant_get(root, path, "string"), none
        if kind.one_of:
            inside = F.when(~text.isin(*kind.one_of), said("not one of its values")).otherwise(none)
        elif kind.pattern:
            inside = F.when(~text.rlike(kind.pattern), said(f"not like {kind.pattern}")).otherwise(none)
    return F.when(fits, inside).otherwise(said(f"no {kind.type}"))


def _item(x: Column, kind: Kind, place: Column) -> Column:
    """Errors of an item of a list or map, which may be null only where anything may be."""
    if kind.type == "any":
        return F.array().cast(_ERRORS)
    null = F.array(F.struct(place.alias("place"), F.lit("null").alias("error"))).cast(_ERRORS)
    return F.when(x.isNull() | F.is_variant_null(x), null).otherwise(_errors(x, "$", kind, place))


def document_errors(documents: DataFrame, kind: str, value: str = "value") -> DataFrame:
    """Documents with place and error, one row for each error; those without any have none.

    Places are names and numbers, as `$.markets[2].locale`.  Fields that a kind doesn't know are let through.
    """
    whole = F.try_parse_json(F.col(value))
    no = F.array(F.struct(F.lit("$").alias("place"), F.lit("no JSON").alias("error"))).cast(_ERRORS)
    found = F.when(F.col("_doc").isNull(), no).otherwise(_errors(F.col("_doc"), "$", KINDS[kind], F.lit("$")))
    return documents.withColumn("_doc", whole).withColumn("_error", F.explode(found)).select(*documents.columns, "_error.place", "_error.error")


def document_schema(kind: str, base: str) -> dict:
    """The schema document of a kind, with `base` as the beginning of its id."""

    def told(k: Kind) -> dict:
        if k.type == "any":
            return {}
        if k.type == "object":
            props = {n: (told(i) if not null else {"anyOf": [told(i), {"type": "null"}]}) for n, i, _, null in k.fields}
            return {"type": "object", "properties": props, "required": [n for n, _, required, _ in k.fields if required]}
        own = {"type": "object", "additionalProperties": told(k.inner)} if k.type == "map" else {"type": k.type}
        return own | ({"items": told(k.inner)} if k.type == "array" else {}) | ({"enum": list(k.one_of)} if k.one_of else {}) | ({"pattern": k.pattern} if k.pattern else {})

    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "$id": f"{base.rstrip('/')}/{kind.replace('_', '-')}-v1.schema.json"} | told(KINDS[kind])
