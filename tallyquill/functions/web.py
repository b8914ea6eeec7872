"""Web addresses, cache identities and cache headers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyquill import tables
from tallyquill.functions.text import col


def host_allowed(url: Column | str, hosts: list[str]) -> Column:
    """Whether the host is one of `hosts` or below one."""
    host = F.lower(F.try_parse_url(col(url), F.lit("HOST")))
    ok = F.lit(False)
    for h in hosts:
        ok = ok | (host == h) | host.endswith("." + h)
    return F.coalesce(ok, F.lit(False))


def _parts(url: Column) -> tuple[Column, Column, Column]:
    bare = F.substring_index(url, "#", 1)
    base = F.substring_index(bare, "?", 1)
    return bare, base, F.when(F.instr(bare, "?") > 0, F.substring(bare, F.instr(bare, "?") + 1, F.length(bare))).otherwise("")


def redacted(url: Column | str) -> Column:
    """The address with the values of secret query parameters hidden."""
    bare, base, query = _parts(col(url))
    hidden = F.transform(
        F.filter(F.split(query, "[;&]"), lambda p: p != ""),
        lambda p: F.when((F.instr(p, "=") > 0) & F.lower(F.substring_index(p, "=", 1)).isin(*tables.SECRET), F.concat(F.substring_index(p, "=", 1), F.lit("=<redacted>"))).otherwise(p),
    )
    return F.when(query == "", col(url)).otherwise(F.concat_ws("?", base, F.array_join(hidden, "&")))


def normalized(url: Column | str) -> Column:
    """Scheme and host in lower case, query parameters sorted and without tracking ones, no fragment."""
    _, base, query = _parts(col(url))
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(*tables.TRACKING)))
    clean = F.concat(F.lower(origin), F.substring(base, F.length(origin) + 1, F.length(base)))
    return F.when(F.size(kept) > 0, F.concat_ws("?", clean, F.array_join(kept, "&"))).otherwise(clean)


def cache_key(method: Column | str, url: Column | str, market: Column | str, locale: Column | str, version: str = "1") -> Column:
    """sha256 of the request's identity as JSON with sorted names."""
    fields = F.struct(col(locale).alias("locale"), col(market).alias("market"), F.upper(col(method)).alias("method"), normalized(url).alias("url"), F.lit(version).alias("version"))
    return F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256)


def cache_directives(header: Column | str) -> Column:
    """Map from each directive of a Cache-Control header, in lower case, to its value or null; of repeats the last holds."""
    own = F.filter(F.transform(F.split(F.coalesce(col(header), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    keys = F.transform(own, lambda d: F.lower(F.trim(F.substring_index(d, "=", 1))))
    last = F.filter(F.arrays_zip(own.alias("d"), keys.alias("k")), lambda x: F.lit(True))
    return F.map_from_entries(
        F.transform(
            F.array_distinct(keys),
            lambda k: F.struct(k, F.element_at(F.transform(F.filter(last, lambda x: x["k"] == k), lambda x: F.when(F.instr(x["d"], "=") > 0, F.trim(F.regexp_replace(x["d"], '^[^=]*=|"', "")))), -1)),
        )
    )


def http_time(text: Column | str) -> Column:
    """Seconds since 1970 of an HTTP date such as `Wed, 31 Jan 2024 12:00:00 GMT`; null for anything else."""
    bare = F.regexp_replace(F.trim(col(text)), r"^[A-Za-z]+,\s*|\s*GMT$", "")
    return F.unix_seconds(F.try_to_timestamp(F.concat(bare, F.lit(" +0000")), F.lit("dd MMM yyyy HH:mm:ss Z")))


def fresh(age_s: Column | str, ttl_s: float, header: Column | str | None = None, expires: Column | str | None = None, now: float | None = None) -> Column:
    """Whether a kept page may be used: by its age alone, or, with a Cache-Control header, as that says too.

    An Expires date counts, against `now`, where the header sets no age.
    """
    young = col(age_s) < ttl_s
    if header is None:
        return young
    d = cache_directives(header)
    most = F.coalesce(F.try_element_at(d, F.lit("s-maxage")), F.try_element_at(d, F.lit("max-age"))).try_cast("long")
    until = F.lit(True) if expires is None else F.coalesce(F.lit(now) < http_time(expires), F.lit(True))
    return young & ~F.map_contains_key(d, "no-cache") & F.coalesce((most > 0) & (col(age_s) < most), until)


def cacheable(status: Column | str, told: Column, length: Column) -> Column:
    """Whether a response may be kept: it is whole as far as its content-length tells, and no error."""
    number = told.try_cast("long")
    return F.coalesce((col(status) == 200) & F.when(told.isNull(), True).otherwise(number == length), F.lit(False))


def market_matches(cached_market: Column | str, market: Column | str, cached_locale: Column | str, locale: Column | str) -> Column:
    """Whether a kept page was served for the market asked for; what isn't known doesn't speak against it."""
    country = lambda x: F.when(col(x).contains("-"), F.element_at(F.split(F.lower(col(x)), "-"), -1))
    unknown = F.coalesce(col(cached_market) == "", F.lit(True)) | F.coalesce(col(market) == "", F.lit(True))
    same = (F.upper(col(cached_market)) == F.upper(col(market))) & F.coalesce(country(cached_locale) == country(locale), F.lit(True))
    return unknown | F.coalesce(same, F.lit(False))


def locale_of_url(url: Column | str) -> Column:
    """The locale or country that a price page's address names; `us` for the root's."""
    path = F.regexp_replace(F.lower(F.try_parse_url(col(url), F.lit("PATH"))), "^/+|/+$", "")
    return F.when(path.rlike("^pricing(/|$)"), "us").otherwise(F.nullif(F.regexp_extract(path, "^([a-z]{2}(?:-[a-z]{2})?)/pricing", 1), F.lit("")))


def country_of_locale(locale: Column | str) -> Column:
    """Country of a locale: its last part, or a bare two-letter code; languages alone say nothing."""
    own = F.lower(F.trim(col(locale)))
    return F.when(own.isin("en", "de") | (own == ""), None).when(own.contains("-"), F.upper(F.element_at(F.split(own, "-"), -1))).when(own.rlike("^[a-z]{2}$"), F.upper(own))


def country_of_path(path: Column | str) -> Column:
    """Country of a path such as /en-de/pricing, /gb or /in."""
    return F.upper(F.nullif(F.regexp_extract(F.lower(col(path)), r"^/?(?:[a-z]{2}-)?([a-z]{2})(?:/pricing(?:/local-payment-methods)?)?/*$", 1), F.lit("")))


def candidate_urls(base: Column | str, locale: Column | str) -> Column:
    """Addresses where a market's fees may stand."""
    root = F.concat(col(base), F.lit("/"), col(locale), F.lit("/pricing"))
    return F.array(root, F.concat(root, F.lit("/local-payment-methods")))
