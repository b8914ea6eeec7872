"""Operators that depend on order: nearest earlier row, values carried forward, first per key, numbering, headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _upto(by: list[str], order: list, before: bool = False):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)


def settled(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Rows with `columns` added, or replaced, before anything that filters on them.

    A filter on a long expression would otherwise be moved below it, and the expression computed again, and all that it
    is made of; a generated row is a border that filters don't cross.
    """
    kept = [c for c in rows.columns if c not in columns]
    return rows.select(*kept, F.inline(F.array(F.struct(*(v.alias(n) for n, v in columns.items())))))


def nearest_before(rows: DataFrame, by: list[str], order: list, base: Column, value: str, into: str) -> DataFrame:
    """Each row with `value` of the latest earlier row of its group for which `base` holds; one sort, no range join."""
    return rows.withColumn(into, F.last(F.when(base, F.col(value)), ignorenulls=True).over(_upto(by, order, before=True)))


def carried_forward(rows: DataFrame, by: list[str], order: list, columns: list[str]) -> DataFrame:
    """Nulls of `columns` filled with the last value before them within a group."""
    return rows.withColumns({c: F.last(c, ignorenulls=True).over(_upto(by, order)) for c in columns})


def grouped_by_base(rows: DataFrame, by: list[str], order: list, base: Column, into: str = "group_no") -> DataFrame:
    """Rows numbered by how many base rows have come so far: a modifier gets its base's number, 0 before any base."""
    return rows.withColumn(into, F.count(F.when(base, 1)).over(_upto(by, order)))


def total(rows: DataFrame, order: list, *known: str) -> list:
    """`order`, and after it every other column that can be ordered, so that only equal rows are ties."""
    more = [f.name for f in rows.schema.fields if f.name not in known and f.dataType.typeName() not in ("map", "variant")]
    return [*order, *(F.col(c) for c in more)]


def first_per_key(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key; rows that `order` leaves equal are told apart by their other columns."""
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(*key).orderBy(*total(rows, order, *key)))).where("_place = 1").drop("_place")


def later_duplicates(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """Every row of a key but the first, in the order of `first_per_key`."""
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(*key).orderBy(*total(rows, order, *key)))).where("_place > 1").drop("_place")


def renumbered(rows: DataFrame, by: list[str], order: list, into: str = "source_order", parts: int = 1) -> DataFrame:
    """Rows of each group numbered from 0; ties are told apart by the other columns.

    With `parts`, groups are cut into so many ranges of the first of `order`, numbered apart, and each range's numbers
    begin after the rows of those before it: a group of any size is then sorted in parts.  Ranges are even shares between
    the group's least and greatest value, which must be a number or a time.
    """
    every = total(rows, order, *by)
    if parts <= 1:
        return rows.withColumn(into, F.row_number().over(Window.partitionBy(*by).orderBy(*every)) - 1)
    first = order[0] if isinstance(order[0], Column) else F.col(order[0])
    value = rows.withColumn("_v", first.cast("double"))
    ends = value.groupBy(*by).agg(F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    place = F.when(F.col("_most") > F.col("_least"), F.least(F.floor((F.col("_v") - F.col("_least")) / (F.col("_most") - F.col("_least")) * parts), F.lit(parts - 1))).otherwise(0)
    same = [F.col(f"_g{k}").eqNullSafe(F.col(c)) for k, c in enumerate(by)]
    keyed = lambda df: df.withColumnsRenamed({c: f"_g{k}" for k, c in enumerate(by)})
    placed = value.join(keyed(ends), same, "left").withColumn("_part", F.coalesce(place, F.lit(-1))).drop("_least", "_most", "_v", *(f"_g{k}" for k in range(len(by))))
    sizes = placed.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    own = placed.withColumn("_place", F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*every)) - 1)
    return own.join(keyed(before).withColumnRenamed("_part", "_p"), [*same, F.col("_part") == F.col("_p")]).withColumn(into, (F.col("_place") + F.col("_before")).cast("int")).drop("_place", "_before", "_part", "_p", *(f"_g{k}" for k in range(len(by))))


def heading_paths(headings: DataFrame, by: list[str], order: list, level: str = "level", text: str = "heading", levels: int = 6) -> DataFrame:
    """Headings with `section_path`: the open heading of each level above, and their own.

    The heading of a level is open until one of that level or above follows: the last one of level k counts if no
    heading of a lower level stands after it, which is seen from their running numbers.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    own = headings.withColumn("_at", place)
    last = {k: F.max(F.when(F.col(level) == k, F.col("_at"))).over(_upto(by, order)) for k in range(1, levels + 1)}
    names = {k: F.last(F.when(F.col(level) == k, F.col(text)), ignorenulls=True).over(_upto(by, order)) for k in range(1, levels + 1)}
    own = own.withColumns({f"_l{k}": v for k, v in last.items()} | {f"_n{k}": v for k, v in names.items()})
    parts = []
    for k in range(1, levels + 1):
        above = F.greatest(F.lit(0), *(F.coalesce(f"_l{j}", F.lit(0)) for j in range(1, k)), F.lit(0))
        parts.append(F.when((F.col(level) >= k) & (F.col(f"_l{k}") > above), F.col(f"_n{k}")))
    path = F.array_compact(F.array(*parts))
    return own.withColumn("section_path", path).drop("_at", *(f"_l{k}" for k in last), *(f"_n{k}" for k in names))
