"""Schema checks of all kinds of documents, with errors at any depth."""

import copy
import json

import pytest

from tallyquill.operators import schemas

MARKET = {"market_code": "en-de", "account_country": "DE", "country_name": "Germany", "locale": "en-de", "url_prefix": "/en-de", "languages": [{"code": "en"}], "region": None}
RULE = {
    "rule_id": "r1", "conditions": [{"dimension": "card_region", "value": ["eea"]}], "fee_components": [{"type": "percentage", "value": "1.5"}], "unit": "per_transaction", "exactness": "exact", "confidence": 0.85, "fee_evidence": {"type": "explicit_fee_phrase", "phrases": ["x"]},
    "source_fragments": [{"text": "x", "entry_id": None}], "classification_status": "calculable_rule", "unknown": {"field": 1},
}
GOOD = {
    "market": {"schema_version": 1, "market": MARKET, "derived_rules": [RULE], "entries": [{"entry_id": "e", "source_text": "t", "source_url": "u", "tokens": [{"raw": "1%"}], "context": {"a": None}}], "warnings": [{"code": "c", "message": "m", "context": None}], "coverage_summary": {"free": 0}},
    "index": {"markets": [{"account_country": "de", "market_code": "m", "locale": "l", "data_path": "p", "source_urls": []}]},
    "core_fees": {"schema_version": 1, "markets": [{"account_country": "DE", "market_code": "en-de", "locale": "en-de", "derivation_status": "complete", "rules": [RULE], "unclassified_count": 0}]},
    "payment_methods": {"methods": [{"method_id": "card", "family": "card", "display_name": "Card", "supported_account_countries": ["DE"], "fee_rule_refs": ["r1"]}]},
    "manifest": {"markets": [MARKET], "unsupported": [], "aliases": {"a": "b"}, "fee_page_urls": {"DE": ["u"]}, "transient_failures": [{"market_code": "x", "status": "transient_failure"}]},
}
BAD = [
    ("market", ("market",), {}, {f"$.market.{n}:missing" for n in ("account_country", "market_code", "country_name", "locale", "url_prefix")}),
    ("market", ("derivation_status",), "invalid", {"$.derivation_status:not one of its values"}), ("market", ("derived_rules", 0, "fee_components", 0, "type"), "odd", {"$.derived_rules[0].fee_components[0].type:not one of its values"}),
    ("market", ("derived_rules", 0, "fee_evidence", "phrases", 0), 5, {"$.derived_rules[0].fee_evidence.phrases[0]:no string"}), ("market", ("entries", 0, "tokens", 0), None, {"$.entries[0].tokens[0]:null"}),
    ("market", ("derived_rules", 0, "source_fragments", 0), "x", {"$.derived_rules[0].source_fragments[0]:no map"}), ("market", ("coverage_summary", "free"), 1.5, {"$.coverage_summary.free:no integer"}), ("market", ("transient_failure",), "no", {"$.transient_failure:no boolean"}),
    ("market", ("derived_rules", 0, "confidence"), "high", {"$.derived_rules[0].confidence:no number"}), ("market", ("derived_rules",), {}, {"$.derived_rules:no array"}), ("market", ("schema_version",), None, {"$.schema_version:null"}),
    ("index", ("markets", 0, "account_country"), "D1", {"$.markets[0].account_country:not like ^[A-Za-z]{2}$"}), ("index", ("markets", 0, "locale"), None, {"$.markets[0].locale:null"}),
    ("core_fees", ("markets", 0, "rules", 0, "conditions", 0), {"dimension": "x"}, {"$.markets[0].rules[0].conditions[0].value:missing"}), ("core_fees", ("markets", 0, "derivation_status"), None, {"$.markets[0].derivation_status:null"}),
    ("payment_methods", ("methods", 0), {}, {f"$.methods[0].{n}:missing" for n in ("method_id", "family", "display_name")}),
    ("manifest", ("fee_page_urls", "DE"), "u", {"$.fee_page_urls.DE:no array"}), ("manifest", ("aliases", "a"), None, {"$.aliases.a:null"}), ("manifest", ("transient_failures", 0, "status"), "ok", {"$.transient_failures[0].status:not one of its values"}),
]


@pytest.mark.parametrize("kind", sorted(schemas.KINDS))
def test_errors_are_told_with_their_place(spark, kind):
    docs, want = [("good", GOOD[kind]), ("list", [1]), ("text", "x")], {("list", "$:no object"), ("text", "$:no object"), ("broken", "$:no JSON"), ("null", "$:no JSON")}
    for n, (k, path, value, errors) in enumerate(BAD):
        if k == kind:
            doc = copy.deepcopy(GOOD[kind])
            at = doc
            for p in path[:-1]:
                at = at[p]
            at[path[-1]] = value
            docs.append((str(n), doc))
            want |= {(str(n), e) for e in errors}
    rows = [(i, json.dumps(d)) for i, d in docs] + [("broken", '{"a": '), ("null", None)]
    found = schemas.document_errors(spark.createDataFrame(rows, "id string, value string"), kind).collect()
    assert {(r.id, f"{r.place}:{r.error}") for r in found} == want


@pytest.mark.parametrize("kind", sorted(schemas.KINDS))
def test_schema_documents(kind):
    own = schemas.document_schema(kind, "https://example.com/schemas/")
    assert own["$id"] == f"https://example.com/schemas/{kind.replace('_', '-')}-v1.schema.json" and own["type"] == "object" and "$schema" in own
    assert {n for n, v in own["properties"].items() if n == "generated_at"} == {"generated_at"} and json.loads(json.dumps(own)) == own
    if kind == "index":
        assert own["properties"]["markets"]["items"]["required"] == ["account_country", "market_code", "locale", "data_path"]
