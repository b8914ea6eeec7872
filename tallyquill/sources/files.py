"""Sources: tables, page files, JSON documents, a page cache, and the seed relation of countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyquill import tables
from tallyquill.functions.money import currency_of_country
from tallyquill.functions.text import looked_up
from tallyquill.functions.web import cache_key, cacheable, fresh

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Charsets that a page may name; others are read as UTF-8.
_CHARSETS = {"utf-8": "UTF-8", "utf8": "UTF-8", "iso-8859-1": "ISO-8859-1", "latin-1": "ISO-8859-1", "latin1": "ISO-8859-1", "windows-1252": "ISO-8859-1", "us-ascii": "US-ASCII", "utf-16": "UTF-16"}


def decoded(content: Column, told: Column | None = None) -> Column:
    """(html, charset, error) of a page's bytes: by `told`, else by its own meta element or mark, else as UTF-8.

    Bytes that aren't of the charset are an error, and are then read as Latin-1, which reads any.
    """
    head = F.lower(F.decode(F.substring(content, 1, 2048), "ISO-8859-1"))
    meta = F.nullif(F.regexp_extract(head, "<meta[^>]*charset=[\"' ]*([a-z0-9_-]+)", 1), F.lit(""))
    marked = F.when(F.hex(F.substring(content, 1, 3)) == "EFBBBF", "utf-8")
    named = F.coalesce(*([F.lower(told)] if told is not None else []), marked, meta, F.lit("utf-8"))
    charset = F.coalesce(looked_up(named, _CHARSETS), F.lit("UTF-8"))
    utf8 = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string"))
    latin = F.decode(content, "ISO-8859-1")
    text = F.when(charset == "UTF-8", utf8).when(charset == "ISO-8859-1", latin).when(charset == "UTF-16", F.decode(content, "UTF-16")).otherwise(F.when(F.is_valid_utf8(content.cast("string")), F.decode(content, "ISO-8859-1")))
    return F.struct(F.coalesce(F.regexp_replace(text, "^\ufeff", ""), latin).alias("html"), charset.alias("charset"), F.when(text.isNull(), F.concat(F.lit("bytes are not "), charset)).alias("error"))


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """(url, html, charset, error) of every file below a folder, each read whole and decoded by what it says of itself.

    Files without a byte are no pages: Spark's scan leaves them out.
    """
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return own.select(F.col("path").alias("url"), decoded(F.col("content")).alias("d")).select("url", "d.*")


def json_documents(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = False) -> DataFrame:
    """Documents of several lines each with url and error; a broken one is a row of nulls with its text as `error`, or
    raises if `strict`."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    own = spark.read.schema(T.StructType([*kind.fields, T.StructField("_broken", T.StringType())])).option("recursiveFileLookup", "true")
    rows = own.json(path, multiLine=True, mode="FAILFAST" if strict else "PERMISSIVE", columnNameOfCorruptRecord="_broken")
    return rows.select(F.col("_metadata.file_path").alias("url"), *kind.fieldNames(), F.col("_broken").alias("error"))


def seed_markets(spark: SparkSession) -> DataFrame:
    """The markets that are known before any page is read; languages are joined by commas."""
    return spark.createDataFrame(tables.SEED_MARKETS, "market string, country string, name string, region string, locale string, languages string, currency string")


def discovered_or_seed(found: DataFrame) -> DataFrame:
    """The discovered markets, or the seed relation where there are none."""
    return seed_markets(found.sparkSession) if found.isEmpty() else found


def cached(requests: DataFrame, cache: DataFrame, now: float, ttl_s: float) -> DataFrame:
    """Requests (method, url, market, locale) with the newest good page of their identity, if it is fresh, and `hit`.

    A cache with several rows of a key counts the one fetched last; requests are never doubled.
    """
    keyed = requests.withColumn("key", cache_key("method", "url", "market", "locale"))
    age = F.lit(now) - F.col("fetched_at")
    good = cache.where(fresh(age, ttl_s) & (F.col("status") == 200)).groupBy("key").agg(F.max_by(F.struct("content", "fetched_at"), F.struct("fetched_at", "content")).alias("_newest")).select("key", "_newest.*")
    return keyed.join(good, "key", "left").withColumn("hit", F.col("content").isNotNull())


def cache_counters(requests: DataFrame) -> DataFrame:
    """Hits, misses and bytes that hits avoided, of `cached` requests."""
    return requests.agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.coalesce(F.sum(F.when(F.col("hit"), F.octet_length("content"))), F.lit(0)).alias("bytes_avoided"))


def kept_responses(responses: DataFrame) -> DataFrame:
    """Cache entries (key, status, headers, content as bytes, fetched_at) of the responses that may be kept."""
    own = responses.where(cacheable("status", F.col("headers")["content-length"], F.octet_length("content"))).withColumn("key", cache_key("method", "url", "market", "locale"))
    return own.select("key", "status", "headers", F.col("content").cast("binary").alias("content"), "fetched_at")


def built_markets(codes: DataFrame, base: str) -> DataFrame:
    """Markets from (country, language, name): locale, market code, address and currency.  Some countries have an address of their own."""
    code, language = F.lower(F.col("country")), F.coalesce(F.lower(F.col("language")), F.lit("en"))
    locale = F.concat_ws("-", language, code)
    own = codes.select(F.upper("country").alias("country"), F.coalesce("name", F.upper("country")).alias("name"), locale.alias("locale"), F.when(code.isin(*tables.DIRECT_MARKETS), code).otherwise(locale).alias("market"))
    return own.withColumns({"url": F.concat(F.lit(base.rstrip("/") + "/"), "market"), "currency": currency_of_country("country")})


def confirmed(tests: DataFrame) -> DataFrame:
    """Per country of tested pages (country, kind, status, failed, served, redirected, is_pricing): ok, unsupported or transient.

    A main page that is a price page of the country confirms it.  Otherwise a redirect to another country's page makes it
    unsupported, then a failure, or another country's page without a redirect, transient; without either it is unsupported.
    """
    other = F.coalesce(F.upper(F.col("served")) != F.upper(F.col("country")), F.lit(False))
    good = (F.col("kind") == "pricing") & F.coalesce(F.col("is_pricing"), F.lit(False)) & ~other & ~F.col("failed")
    flags = tests.groupBy("country").agg(
        F.bool_or(good).alias("good"), F.bool_or(other & F.col("redirected") & ~F.col("failed")).alias("elsewhere"),
        F.bool_or((F.col("failed") & ~F.coalesce(F.col("status") == 404, F.lit(False))) | (other & ~F.col("redirected") & ~F.col("failed"))).alias("transient"),
    )
    return flags.select("country", F.when(F.col("good"), "ok").when(F.col("elsewhere"), "unsupported").when(F.col("transient"), "transient").otherwise("unsupported").alias("outcome"))
