"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyquill.llm.common import cut

#: Weights of the sources in order of code point, nulls last, from the start again as often as needed.
WEIGHTS = (5, 2, 1)
#: Times that a document may be taken at most, and so a source.
MOST = 3
#: Documents of a source that are ordered exactly to find where its sample ends, on average.
BUCKET_ROWS = 1000


def words(text: str = "text") -> Column:
    """Number of runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MOST) -> DataFrame:
    """(source, source_size, n, target) of a table of sources with their sizes.

    Each source gets words by weight, but at most `most` times its own; what that leaves is dealt out to the others by
    weight again.  With sources ordered by how soon they reach their limit, those up to some place are at their limit
    and the others share what is left: that place is found with running sums over the table of sources.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    limits = sizes.withColumn("weight", F.element_at(cycle, (place % len(weights) + 1).cast("int"))).withColumn("most", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = limits.withColumn("level", level).withColumn("rank", F.row_number().over(order))
    first = levels.where(F.col("level") * F.col("weight") <= F.col("most")).agg(F.min_by("level", "rank").alias("common"))
    return levels.crossJoin(F.broadcast(first)).select(  # one row
        "source", "source_size", "n", F.when(F.col("common").isNull(), F.col("most")).otherwise(F.least("most", F.col("common") * F.col("weight"))).alias("target")
    )


def _uniform(seed: int) -> Column:
    """A number between 0 and 1 from the id's md5, or without an id from that of the text, the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), "_digest")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _inside(p: Column) -> Column:
    """A chance kept off 0 and 1, where odds have no value."""
    return F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))


def _odds(p: Column) -> Column:
    return p / (1.0 - p)


def _ranked(rows: DataFrame, aims: DataFrame, most: int, seed: int) -> DataFrame:
    """`rows` with their source's aims, copies due, certain copies, Pareto key and bucket of keys."""
    due = F.when(F.col("_weighted") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("_weighted") * F.col("_weight"))).otherwise(0.0)
    dealt = _with(rows, aims).withColumn("_due", due).withColumn("_certain", F.floor("_due"))
    ranked = dealt.withColumn("_key", _odds(_uniform(seed)) / _odds(_inside(F.col("_due") - F.col("_certain"))))
    # Times the source's usual odds, keys spread evenly over 0 to 1 as odds.
    share = F.col("target") / F.col("source_size")
    spread = F.col("_key") * _odds(_inside(F.coalesce(share - F.floor(share), F.lit(0.0))))
    return ranked.withColumn("_bucket", F.floor(F.coalesce(spread / (1 + spread), F.lit(0.0)) * F.greatest(F.ceil(F.col("n") / BUCKET_ROWS), F.lit(1))))


#: The order of a source's documents; what is equal in all but the last is the same row repeated, and told apart by its place.
_PLACE = ("_key", "doc_id", "size", "_digest", "_row")


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MOST, seed: int = 0) -> DataFrame:
    """Per source: size, target, and where its Pareto sample ends, of rows (doc_id, source, size, _weight, _digest, _row).

    A document is due target / source_size copies, times its weight against its source's mean.  The whole ones are
    certain.  The rest is its chance in the sample: documents rank by random odds over inclusion odds, and a source
    takes them in that order as long as they fit in the words that certain copies leave open, and then the one of the
    next documents whose size is nearest to what is still open.  Ranks are cut into buckets of about BUCKET_ROWS rows,
    whose sums say in which of them a source's sample ends; only the rows of that bucket and the next are ordered.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"), F.sum(F.col("size") * F.col("_weight")).alias("_weighted"))
    aims = cut(_with(sizes.select("source", "_weighted"), targets(sizes.drop("_weighted"), weights, share, most)))
    ranked = _ranked(sized, aims, most, seed)
    sums = cut(ranked.groupBy("source", "_bucket").agg(F.sum("size").alias("words"), F.sum(F.col("_certain") * F.col("size")).alias("certain")))
    open_words = _with(aims, sums.groupBy("source").agg(F.sum("certain").alias("certain"))).select("source", (F.col("target") - F.col("certain")).alias("open"))
    run = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    starts = _with(sums.withColumn("before", F.sum("words").over(run) - F.col("words")), open_words).where("before <= open")
    # What follows is read more than once, and is small: a row per source, and the rows near the end of its sample.
    last = starts.groupBy("source").agg(F.max_by(F.struct("_bucket", "before", "open"), "_bucket").alias("e")).select("source", F.col("e._bucket").alias("end_bucket"), "e.before", "e.open")
    last = cut(last)

    near = _with(ranked.select("source", "_bucket", *_PLACE), last).where("_bucket between end_bucket and end_bucket + 1")
    order = Window.partitionBy("source").orderBy(*_PLACE).rowsBetween(Window.unboundedPreceding, 0)
    near = cut(near.withColumn("upto", F.col("before") + F.sum("size").over(order)))
    fits = F.col("upto") <= F.col("open")
    ends = near.groupBy("source").agg(F.max(F.when(fits, F.struct(*_PLACE))).alias("end"), F.coalesce(F.max(F.when(fits, F.col("upto"))), F.max("before")).alias("filled"))
    ends = cut(ends)
    gap = F.col("open") - F.col("filled")
    nearest = _with(near.where(~fits), ends).where(F.abs(gap - F.col("size")) < gap)
    one = nearest.groupBy("source").agg(F.min_by(F.struct(*_PLACE), F.struct(F.abs(gap - F.col("size")), *_PLACE)).alias("one_more"))
    return cut(_with(_with(_with(aims, last.select("source", "end_bucket"), "left"), ends.select("source", "end"), "left"), one, "left"))


def _with(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by source, where null is a source like any other."""
    other = right.withColumnRenamed("source", "_source")
    return left.join(other, left["source"].eqNullSafe(other["_source"]), how).drop("_source")


def _taken(docs: DataFrame, weights: tuple[int, ...], share: float, most: int, seed: int, weight: str | None) -> DataFrame:
    """`docs` with size, source_size, target, copies and taken."""
    own = F.lit(1.0) if weight is None else F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = docs.drop("size", "source_size", "target", "copies", "taken").withColumn("size", words()).withColumn("_weight", own)
    rows = rows.withColumns({"_digest": F.md5(F.coalesce("text", F.lit(""))), "_row": F.monotonically_increasing_id()})
    aims = plan(cut(rows.select("doc_id", "source", "size", "_weight", "_digest", "_row")), weights, share, most, seed)
    place = F.struct(*_PLACE)
    in_end = (F.col("_bucket") >= F.col("end_bucket")) & ((F.col("end").isNotNull() & (place <= F.col("end"))) | (F.col("one_more").isNotNull() & (place == F.col("one_more"))))
    sampled = F.coalesce((F.col("_bucket") < F.col("end_bucket")) | in_end, F.lit(False))
    found = _ranked(rows, aims, most, seed).withColumn("copies", F.least(F.col("_certain") + sampled.cast("int"), F.lit(most)).cast("long"))
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    return found.select(*kept, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MOST, seed: int = 0, weight: str | None = None) -> DataFrame:
    """`docs` with size (words), source_size, target (its source's), copies and taken (copies times size) of every row.

    Null texts have size 0; a null source is one of its own and comes last.  Rows that share an id, or have none, are told
    apart by their texts, and rows that repeat others wholly by their place in the table, so that a sample ends at its target
    also among them.  An empty table gives no rows.  No copy count exceeds `most`.  A column named like a new one
    is replaced.  Texts are never shuffled: per-source sums are, and the rows near the end of a source's sample.
    """
    return _taken(docs, weights, share, most, seed, weight)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of `mixture` that are taken at least once."""
    return mixture(docs, **options).where("copies > 0")
