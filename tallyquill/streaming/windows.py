"""Extensions: fee phrases from a stream, and counts by window with late rows up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.functions.money import tokens


def tokenized(stream: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their fee tokens; no state, so batch and stream give the same."""
    return stream.withColumn("tokens", tokens(text))


def windowed_counts(events: DataFrame, at: str, by: list[str], size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows per window and key; rows later than the watermark are left out on streams."""
    return events.withWatermark(at, late).groupBy(F.window(at, size), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")
