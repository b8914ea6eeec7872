"""Scans that keep what they can't read, entities in headings, and small publication parts."""

import json

import pytest
from pyspark.sql import functions as F

from tallyquill.operators import catalog, checks, pages
from tallyquill.sources import files


def test_page_files_of_any_charset(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    own = {
        "a.html": "<p>é</p>".encode(), "b.html": '<meta charset="iso-8859-1"><p>é</p>'.encode("latin-1"), "c.html": "<p>é</p>".encode("latin-1"), "sub/d.html": b"\xef\xbb\xbf<p>x</p>", "e.html": b"",
        "f.html": "<meta http-equiv='Content-Type' content='text/html; charset=Windows-1252'>ü".encode("latin-1"), "g.html": "<meta charset=odd>ü".encode(),
    }
    for name, data in own.items():
        (tmp_path / name).write_bytes(data)
    got = {r.url.rpartition("/")[2]: (r.html, r.charset, r.error) for r in files.page_files(spark, str(tmp_path)).collect()}
    assert got["a.html"] == ("<p>é</p>", "UTF-8", None) and got["c.html"] == ("<p>é</p>", "UTF-8", "bytes are not UTF-8") and got["d.html"] == ("<p>x</p>", "UTF-8", None)
    assert got["b.html"][0].endswith("<p>é</p>") and got["f.html"][0].endswith("ü") and got["g.html"][0].endswith("ü") and len(got) == 6


def test_broken_documents_leave_a_trace(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"a": 1, "b": {"c": "x"}}, indent=2))
    (tmp_path / "broken.json").write_text('{"a": 1,\n "b": ')
    (tmp_path / "other.json").write_text('{"a": "one"}')
    got = {r.url.rpartition("/")[2]: (r.a, r.b.c if r.b else None, r.error is None) for r in files.json_documents(spark, str(tmp_path), "a int, b struct<c:string>").collect()}
    assert got["good.json"] == (1, "x", True) and got["broken.json"][2] is False and got["other.json"][0] is None and got["other.json"][2] is False
    with pytest.raises(Exception):
        files.json_documents(spark, str(tmp_path), "a int, b struct<c:string>", strict=True).collect()


def test_entities_are_decoded_once(spark):
    page = [(1, "https://x.com/", "<h1>AT&amp;amp;T &amp;lt;b&amp;gt; &eacute;</h1>1 &lt; 2")]
    got = pages.sections(spark.createDataFrame(page, "page_id int, url string, html string")).first()
    assert got.heading == "AT&amp;T &lt;b&gt; é" and got.body == "1 < 2"


def test_reports_of_a_publication(spark):
    of = lambda **d: sorted(r.error for r in checks.report_errors(spark.createDataFrame([(p.replace("__", "/").replace("_", "-") + ".json", v) for p, v in d.items()], "path string, value string"), "a").collect())
    assert of(**{"change_report": '{"has_regression": false}', "meta__crawl_report": "{}", "meta__revision": '{"revision": "a"}'}) == []
    assert of(x="{}") == ["no_change_report", "no_crawl_report"] and of(change_report='{"has_regression": true}', meta__crawl_report="{") == ["bad_crawl_report", "has_regression"]
    assert of(change_report="{}", meta__crawl_report="[]", meta__revision='{"revision": "b"}') == ["bad_change_report", "other_revision"]


def test_page_order_and_unsupported(spark):
    entries = spark.createDataFrame([("m", "u2", 0, "a"), ("m", "u1", 1, "b"), ("m", "u1", 0, "c"), ("m", "new", 5, "d"), ("n", "u1", 0, "e")], "country string, url string, source_order int, entry_id string")
    order = spark.createDataFrame([("m", "u1", 0), ("m", "u2", 1), ("m", "u2", 7)], "country string, url string, position int")
    assert {r.entry_id: r.source_order for r in catalog.in_page_order(entries, order, ["country"]).collect()} == {"c": 0, "b": 1, "d": 2, "a": 3, "e": 0}
    rows = spark.createDataFrame([("a", "unsupported"), ("b", "transient_failure"), ("c", None)], "country string, status string")
    assert {r.country for r in catalog.unsupported_only(rows).collect()} == {"a", "c"}


def test_a_catalog_with_repeats_and_none(spark):
    rows = spark.createDataFrame([("ideal", "iDEAL", "NL", "r1", "u", "calculable_rule")] * 3 + [("ideal", "Ideal", "BE", "r2", None, "included"), (None, "x", "NL", "r3", "u", "included"), ("p24", "P24", "PL", "r4", "u", "conflict")], "method string, display string, country string, rule_id string, url string, status string")
    (one,) = catalog.method_catalog(rows).collect()
    assert (one.method, one.display, one.countries, one.rule_ids, one.urls, one.n_rules) == ("ideal", "Ideal", ["BE", "NL"], ["r1", "r2"], ["u"], 2) and one.family
    assert catalog.core_fees(rows.withColumn("status", F.col("status")), spark.createDataFrame([("NL",), ("XX",)], "country string")).orderBy("country").collect()[0].n_core == 3
