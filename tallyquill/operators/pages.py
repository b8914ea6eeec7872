"""Web pages to metadata, headings, links and markets."""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill import tables
from tallyquill.functions.text import cleaned_fee, col, collapsed, first_match, has_any, looked_up, sliced
from tallyquill.functions.web import country_of_locale, country_of_path, locale_of_url
from tallyquill.operators.order import heading_paths, renumbered

#: Elements whose own text is no body text.
_SKIPPED = ("script", "style", "nav", "footer", "header")


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _of_html(name: str) -> Column:
    return _some(F.regexp_extract("html", rf"(?i)<html[^>]*\s{name}=\"([^\"]*)\"", 1))


def metadata(pages: DataFrame) -> DataFrame:
    """`pages` (url, html) with title, page id, language, canonical address, update date and evidence (2000 characters of
    html), null where a page has none."""
    return pages.withColumns({
        "title": F.coalesce(_some(F.trim(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))), _of_html("data-page-title")), "page_key": _of_html("data-page-id"),
        "html_lang": _of_html("lang"), "updated_at": _of_html("data-page-updated"),
        "canonical_url": _some(F.regexp_extract("html", r"(?i)<link[^>]*rel=\"canonical\"[^>]*href=\"([^\"]*)\"", 1)),
        "evidence": F.substring("html", 1, 2000),
    })


def first_currency(text: Column | str) -> Column:
    """The currency of the first pattern of the list that the text holds."""
    own, found = col(text), None
    for pattern, code in tables.CURRENCY_PATTERNS:
        found = F.when(own.rlike(pattern), code) if found is None else found.when(own.rlike(pattern), code)
    return found


def market(pages: DataFrame) -> DataFrame:
    """Pages of `metadata` with detected_market and detected_currency.

    The market is that of the language, the canonical address, the address, a country named in the title, or the only
    country of the currency of the page's first fee with one; the currency, where no fee tells it, is the market's.
    """
    path = lambda u: F.try_parse_url(col(u), F.lit("PATH"))
    title = first_match("title", tables.COUNTRY_NAMES.items())
    counts = Counter(tables.CURRENCY_BY_COUNTRY.values())
    lone = {c: k for k, c in tables.CURRENCY_BY_COUNTRY.items() if counts[c] == 1}
    told = F.coalesce(country_of_locale("html_lang"), country_of_path(path("canonical_url")), country_of_path(path("url")), title)
    fees = F.array_compact(F.transform(F.regexp_extract_all(visible_text("html"), F.lit(tables.FIRST_FEE), 0), lambda x: first_currency(x)))
    priced = F.when(told.isNull(), F.try_element_at(fees, F.lit(1)))
    found = pages.withColumns({"_told": told, "_priced": priced})
    found = found.withColumn("detected_market", F.coalesce("_told", looked_up(F.col("_priced"), lone)))
    return found.withColumn("detected_currency", F.coalesce("_priced", looked_up(F.col("detected_market"), tables.CURRENCY_BY_COUNTRY))).drop("_told", "_priced")


def has_prices(text: Column | str) -> Column:
    """Whether a page's text holds the wording of a price page."""
    return has_any(text, tables.PAGE_SIGNALS)


def is_price_page(status: Column | str, content_type: Column | str, url: Column | str, page: Column | str, lang: Column | str) -> Column:
    """A good response in html with the wording of prices, whose language names no other country than its address."""
    country = lambda x: F.element_at(F.split(F.translate(F.lower(x), "_", "-"), "-"), -1)
    asked = locale_of_url(url)
    agrees = F.when(asked.isNotNull() & col(lang).isNotNull(), country(asked) == country(col(lang))).otherwise(True)
    return F.coalesce((col(status) == 200) & F.lower(col(content_type)).contains("html") & has_prices(visible_text(page)) & agrees, F.lit(False))


def blocked(status: Column | str, title: Column | str, page: Column | str) -> Column:
    """Why a response is no page: rate_limited, server_error, login, client_error or challenge; null for a page.

    A page is a challenge if its title says so and one sign, or without it two: a form or frame of a check, one on the
    body, and no wording of prices.  It is a login if of password form, title and missing prices two hold.
    """
    s, low = col(status), F.lower(F.coalesce(col(title), F.lit("")))
    bare = F.when(has_prices(visible_text(page)), 0).otherwise(1)
    sign = lambda c: F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0)
    challenge = sign(col(page).rlike(tables.CHALLENGE_MARKS)) + sign(col(page).rlike(r"(?is)<body[^>]*(?:captcha|challenge|security-check)")) + bare
    login = sign(col(page).rlike(tables.LOGIN_FORM)) + sign(has_any(low, tables.LOGIN_TITLES)) + bare
    return (
        F.when(s == 429, "rate_limited").when(s >= 500, "server_error").when(s.isin(401, 403), "login").when(s >= 400, "client_error")
        .when((challenge >= 2) | (has_any(low, tables.CHALLENGE_TITLES) & (challenge >= 1)), "challenge").when((login >= 2) & col(page).rlike(tables.LOGIN_FORM), "login")
    )


class _Headings(HTMLParser):
    """Headings with the text between them, and links, of one page."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[dict] = []
        self.open: list[str] = []
        self.heading: list[str] | None = None
        self.link: tuple[str, list[str]] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.rows.append({"level": int(tag[1]), "heading": "", "body": [], "links": []})
            self.heading = []
        elif tag == "a" and self.rows and (href := dict(attrs).get("href")):
            self.link = href, []
        self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.heading is not None and self.rows:
            self.rows[-1]["heading"] = " ".join(" ".join(self.heading).split())
            self.heading = None
        if tag == "a" and self.link:
            self.rows[-1]["links"].append({"text": " ".join(" ".join(self.link[1]).split()), "uri": self.link[0]})
            self.link = None
        if tag in self.open:
            del self.open[len(self.open) - 1 - self.open[::-1].index(tag) :]

    def handle_data(self, data):
        text = data.strip()
        if not text or not self.rows or (self.open and self.open[-1] in _SKIPPED):
            return
        if self.link:
            self.link[1].append(text)
        if self.heading is not None:
            self.heading.append(text)
        else:
            self.rows[-1]["body"].append(text)


_SECTIONS = "array<struct<level:int,heading:string,body:string,links:array<struct<text:string,uri:string>>>>"


_ARROW_SECTIONS = pa.list_(pa.struct({"level": pa.int32(), "heading": pa.string(), "body": pa.string(), "links": pa.list_(pa.struct({"text": pa.string(), "uri": pa.string()}))}))


def _sections(url: pa.Array, page: pa.Array) -> pa.Array:
    def one(u: str | None, p: str | None) -> list[dict]:
        parser = _Headings()
        parser.feed(p or "")
        parser.close()
        return [
            r | {"body": "\n".join(r["body"]) or None, "links": [x | {"uri": urljoin(u or "", x["uri"])} for x in r["links"]]}
            for r in parser.rows
        ]

    return sliced([url, page], lambda us, ps: [*map(one, us, ps)], _ARROW_SECTIONS)


def sections(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per heading: key, source_order, level, heading, body, links and section_path (the headings it is under).

    A small parser cuts a page at its headings; ancestors are found by windows over the headings of each page.
    """
    rows = pages.select(key, F.posexplode(F.arrow_udf(_sections, _SECTIONS)("url", "html")).alias("source_order", "s")).select(key, "source_order", "s.*")
    return heading_paths(rows, [key], ["source_order"])


def heading_counts(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Number of headings and highest level of each page, by patterns only."""
    found = F.regexp_extract_all("html", F.lit(r"(?i)<h([1-6])[\s>]"), 1)
    return pages.select(key, F.size(found).cast("long").alias("n_headings"), F.array_max(F.transform(found, lambda x: x.cast("int"))).alias("deepest"))


def footer_markets(links: DataFrame, countries: DataFrame) -> DataFrame:
    """Markets from (position, text, href) by country name: the first link of a country is its market, later ones aliases."""
    named = links.join(F.broadcast(countries.select(F.lower("name").alias("_name"), "code")), F.lower(F.trim("text")) == F.col("_name")).drop("_name")  # a list of countries
    return renumbered(named, ["code"], ["position"], "_place").withColumn("is_alias", F.col("_place") > 0).drop("_place")


def visible_text(page: Column | str) -> Column:
    own = F.regexp_replace(col(page), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    return collapsed(F.regexp_replace(own, r"<[^>]*>", " "))


class _Cards(HTMLParser):
    """Cards of local methods: the heading above each, its title, and its text cut at price rows and their parts."""

    def __init__(self) -> None:
        super().__init__()
        self.cards: list[dict] = []
        self.family, self.heading, self.open = "Payment methods", None, []

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        classes = own.get("class") or ""
        kind = next((k for k, m in (("caption", tables.CAPTION_MARK), ("amount", tables.AMOUNT_MARK), ("label", tables.LABEL_MARK), ("sub", tables.SUBPRICE_MARK)) if m in classes), None)
        if own.get("data-js-controller") == tables.CARD_MARK:
            kind = "card"
            self.cards.append({"family": self.family, "title": "", "rows": [], "lines": []})
        elif kind is None and tag == "section" and tables.ROW_MARK in classes and self._in("card"):
            kind = "row"
            self.cards[-1]["rows"].append({"caption": "", "amount": "", "label": "", "subs": [], "lines": []})
        elif kind is None and tag in ("h2", "h3", "h4", "p", "li"):
            kind = tag
        if kind == "sub" and self._in("row"):
            self.cards[-1]["rows"][-1]["subs"].append("")
        if kind in ("p", "li") and self._in("card"):
            (self.cards[-1]["rows"][-1] if self.cards[-1]["rows"] and not self._in("row") else self.cards[-1])["lines"].append("")
        if kind in ("h2", "h3") and not self._in("card"):
            self.heading = ""
        if tag not in ("br", "img", "input", "meta", "link", "hr"):
            self.open.append((tag, kind))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass
        if tag in ("h2", "h3") and self.heading is not None:
            if self.heading.strip() and not any(c.isdigit() for c in self.heading):
                self.family = " ".join(self.heading.split())
            self.heading = None

    def _in(self, kind: str) -> bool:
        return any(k == kind for _, k in self.open)

    def handle_data(self, data):
        if self.heading is not None:
            self.heading += data
        if not self._in("card"):
            return
        card = self.cards[-1]
        row = card["rows"][-1] if card["rows"] else None
        if row is not None and self._in("row"):
            if self._in("sub") and row["subs"]:
                row["subs"][-1] += data
            for part in ("caption", "amount", "label"):
                if self._in(part):
                    row[part] += data
        elif self._in("h4") or self._in("h3"):
            card["title"] += data
        if (self._in("p") or self._in("li")) and not self._in("row") and (lines := (row or card)["lines"]):
            lines[-1] += data


def _rows_of(page: str | None) -> list[dict]:
    parser = _Cards()
    parser.feed(page or "")
    parser.close()
    out = []
    for card in parser.cards:
        base = {"family": card["family"], "title": card["title"]}
        for row in card["rows"]:
            out.append(base | {"parts": [row["caption"], row["amount"], row["label"]], "lines": row["lines"], "grid": True})
            out.extend(base | {"parts": [row["caption"], sub], "lines": [], "grid": True} for sub in row["subs"])
        if not card["rows"]:
            out.append(base | {"parts": [], "lines": card["lines"], "grid": False})
    return out


_CARD_ROWS = "array<struct<family:string,title:string,parts:array<string>,lines:array<string>,grid:boolean>>"


def cards(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Sections of pages of local methods: one per card, or, where cards have price rows, one per row and per price below it.

    A card's family is the nearest heading before it without digits.  A row's heading is its caption, amount and label,
    headed by the method's title unless it begins with it; the lines that follow a row are its body.
    """
    rows = pages.select(key, F.posexplode(F.pandas_udf(lambda p: p.map(_rows_of), _CARD_ROWS)("html")).alias("source_order", "c"))
    clean = lambda xs: F.filter(F.transform(xs, lambda x: cleaned_fee(x)), lambda x: x != "")
    rows = rows.select(key, "source_order", F.col("c.family").alias("family"), cleaned_fee("c.title").alias("title"), F.array_join(clean(F.col("c.parts")), " ").alias("own"), F.array_distinct(clean(F.col("c.lines"))).alias("lines"), "c.grid")
    named = F.when(F.col("grid") & (F.col("title") != "") & ~F.lower("own").startswith(F.lower("title")), F.concat_ws(" ", "title", "own")).otherwise(F.when(F.col("grid"), F.col("own")).otherwise(F.col("title")))
    priced = F.col("title").rlike(tables.PRICED_TITLE) & ~F.col("grid")
    body = F.array_join(F.when(priced, F.concat(F.array("title"), "lines")).otherwise(F.col("lines")), "\n")
    found = rows.withColumns({"heading": named, "body": body, "level": F.lit(3)}).where("heading <> ''")
    return found.select(key, "source_order", "level", "heading", "body", F.array("family", "heading").alias("section_path"))


def extracted(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Sections of (key, url, html, page_kind): cards of pages of local methods, headings of all others."""
    local = F.col("page_kind") == "local-payment-methods"
    columns = [key, "source_order", "level", "heading", "body", "section_path"]
    return cards(pages.where(local), key).select(columns).unionByName(sections(pages.where(~F.coalesce(local, F.lit(False))), key).select(columns))
