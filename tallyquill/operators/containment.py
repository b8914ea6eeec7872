"""Sets within sets: which set takes up which, followed to the end, and lists put together in order.

Groups of a selector that a task can hold are dealt to tasks by their selector, and compared there as bit masks.  In a
larger selector containment is searched for by an inverted index: a set lies only within sets that hold each of its
parts, so it asks for those of its rarest part, and what it finds is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyquill.sources.shared import cut, kept, shuffled

#: Groups of a selector that one task compares, and steps that it takes for them, at most; larger ones ask the index.
GROUP, STEPS = 1 << 15, 1 << 33
#: Edges of a selector that one task follows at most: as many paths, no longer than that.
PATHS = 1 << 10
#: Cells of a table of comparisons that a task holds at a time.
CELLS = 1 << 22


def selected(selector: list[str]) -> Column:
    """One text for the values of `selector`, equal just for equal values, nulls included."""
    return F.to_json(F.struct(*selector))


def contained(sets: DataFrame) -> DataFrame:
    """(_sel, _set, _large): every set of `sets` (_sel, _set, _parts) within another of the same `_sel`.

    `_set` names a set of distinct texts within `_sel`, and differs where they differ.  An empty set lies in all others.
    """
    # Every set has the empty part as well, which is the rarest one of an empty set only.
    each = sets.select("_sel", "_set", F.size("_parts").alias("_size"), F.explode(F.concat(F.array(F.lit("")), F.transform("_parts", lambda p: F.concat(F.lit("="), p)))).alias("_part"))
    often = each.groupBy("_sel", "_part").agg(F.count("*").alias("_often"))
    rarest = each.join(shuffled(often), ["_sel", "_part"]).groupBy("_sel", "_set", "_size").agg(F.min(F.struct("_often", F.col("_part") == "", "_part"))["_part"].alias("_part"))
    other = each.select("_sel", F.col("_set").alias("_large"), F.col("_size").alias("_more"), "_part")
    maybe = rarest.join(shuffled(other), ["_sel", "_part"]).where(F.col("_size") < F.col("_more")).select("_sel", "_set", "_large")
    small, large = sets.select("_sel", "_set", F.col("_parts").alias("_own")), sets.select("_sel", F.col("_set").alias("_large"), "_parts")
    inside = F.size(F.array_except("_own", "_parts")) == 0
    return maybe.join(shuffled(small), ["_sel", "_set"]).join(shuffled(large), ["_sel", "_large"]).where(inside).select("_sel", "_set", "_large")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, bounds of the selectors among them): rows of one `_sel` follow one another and are never parted."""
    held: list[pa.RecordBatch] = []

    def told(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
        sel = rows.column("_sel").combine_chunks()
        ends = np.flatnonzero(pc.not_equal(sel[1:], sel[:-1]).to_numpy(zero_copy_only=False)) + 1
        return rows, np.concatenate([[0], ends, [len(sel)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if batch.column("_sel")[-1] == held[0].column("_sel")[0]:
            continue
        rows, bounds = told(pa.Table.from_batches(held))
        yield rows.slice(0, bounds[-2]).combine_chunks(), bounds[:-1]
        held = rows.slice(bounds[-2]).to_batches()
    if held:
        rows, bounds = told(pa.Table.from_batches(held))
        yield rows.combine_chunks(), bounds


def _masks(rows: np.ndarray, codes: np.ndarray, n_rows: int, n_codes: int) -> np.ndarray:
    """A row of bits for each set, one for each part."""
    out = np.zeros((n_rows, max(1, -(-n_codes // 64))), dtype=np.uint64)
    np.bitwise_or.at(out, (rows, codes // 64), np.uint64(1) << (codes % 64).astype(np.uint64))
    return out


def _inside(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each set of `a` lies within each of `b`, 64 parts at a time."""
    out = np.ones((len(a), len(b)), dtype=bool)
    for k in range(a.shape[1]):
        out &= (a[:, k, None] & ~b[None, :, k]) == 0
    return out


def _taken_up(masks: np.ndarray) -> np.ndarray:
    """The place of the owner of each of a selector's groups, in order of their keys; -1 for none."""
    n = len(masks)
    order = np.lexsort(masks.T)
    new = np.ones(n, dtype=bool)
    new[1:] = (masks[order[1:]] != masks[order[:-1]]).any(axis=1)
    of = np.empty(n, dtype=np.int64)
    of[order] = np.cumsum(new) - 1
    sets = masks[order[new]]
    last = np.full(len(sets), -1, dtype=np.int64)
    np.maximum.at(last, of, np.arange(n))
    step = max(1, CELLS // n)
    within = np.empty(len(sets), dtype=bool)
    for i in range(0, len(sets), step):
        within[i : i + step] = _inside(sets[i : i + step], sets).sum(axis=1) > 1
    kept = np.where(within, n, last)  # of sets that nothing takes up
    out = np.full(n, -1, dtype=np.int64)
    by_set = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[by_set], np.arange(len(sets) + 1))
    for i in range(0, len(sets), step):
        inside = _inside(sets[i : i + step], sets)
        lowest = np.where(inside & within[i : i + step, None], kept, n).min(axis=1)
        members = by_set[starts[i] : starts[min(i + step, len(sets))]]
        for j in range(0, len(members), step):
            own = members[j : j + step]
            later = inside[of[own] - i][:, of] & (np.arange(n) > own[:, None])
            following = np.where(later.any(axis=1), later.argmax(axis=1), -1)
            out[own] = np.where(lowest[of[own] - i] < own, lowest[of[own] - i], following)
    return out


def _compared(batches):
    """Rows (_sel, _key, _parts), by selector and in order of their keys, to (_sel, _key, owner)."""
    for rows, bounds in _runs(batches):
        sel, key, parts = (rows.column(c).combine_chunks() for c in ("_sel", "_key", "_parts"))
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        codes, row, ends = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes), np.concatenate([[0], np.cumsum(sizes)])
        few = _masks(row, codes, len(sizes), len(coded.dictionary)) if len(coded.dictionary) <= 64 else None
        owner = np.full(len(sizes), -1, dtype=np.int64)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo > 1:
                if few is None:
                    names, own = np.unique(codes[ends[lo] : ends[hi]], return_inverse=True)
                    found = _taken_up(_masks(row[ends[lo] : ends[hi]] - lo, own, hi - lo, len(names)))
                else:
                    found = _taken_up(few[lo:hi])
                owner[lo:hi] = np.where(found >= 0, found + lo, -1)
        at = np.flatnonzero(owner >= 0)
        yield pa.RecordBatch.from_arrays([sel.take(pa.array(at)), key.take(pa.array(at)), key.take(pa.array(owner[at]))], names=["_sel", "_key", "owner"])


def _indexed(members: DataFrame) -> DataFrame:
    """(_sel, _key, owner) of `members` (_sel, _key, _parts), however many a selector has, by the inverted index."""
    members = members.withColumn("_set", F.to_json("_parts"))
    sets = cut(members.groupBy("_sel", "_set").agg(F.max("_key").alias("_last"), F.first("_parts").alias("_parts")))
    members = members.drop("_parts")
    pairs = cut(contained(sets))
    largest = sets.join(shuffled(pairs), ["_sel", "_set"], "left_anti").select("_sel", F.col("_set").alias("_large"), "_last")
    lowest = pairs.join(shuffled(largest), ["_sel", "_large"]).groupBy("_sel", "_set").agg(F.min("_last").alias("_lowest"))
    around = pairs.join(shuffled(members.select("_sel", F.col("_set").alias("_large"), "_key")), ["_sel", "_large"]).select("_sel", "_set", "_key")
    lined = members.withColumn("_own", F.lit(True)).unionByName(around.withColumn("_own", F.lit(False)))
    after = lined.withColumn("_next", F.lead("_key").over(Window.partitionBy("_sel", "_set").orderBy("_key"))).where("_own")
    owner = F.when(F.col("_lowest") < F.col("_key"), F.col("_lowest")).otherwise(F.col("_next"))
    return after.join(shuffled(lowest), ["_sel", "_set"], "left").select("_sel", "_key", owner.alias("owner")).where("owner is not null")


def _by_selector(rows: DataFrame, beyond: Column, held, schema: str, spread_out) -> DataFrame:
    """`held` of the selectors that a task holds, batch by batch, and `spread_out` of those that are `beyond` it, if there are any."""
    large = cut(rows.groupBy("_sel").agg(beyond.alias("_beyond")).where("_beyond").select("_sel"))
    within = lambda own: own.repartition("_sel").sortWithinPartitions("_sel", "_key").mapInArrow(held, schema)
    if large.isEmpty():
        return within(rows)
    return within(rows.join(shuffled(large), "_sel", "left_anti")).unionByName(spread_out(cut(rows.join(shuffled(large), "_sel", "left_semi"))))


def owners(groups: DataFrame, key: str, parts: str) -> DataFrame:
    """(_sel, key, owner) of every group that another of its `_sel` takes up; keys are distinct within `_sel` and their order counts.

    Groups are gone through in order of their keys.  One whose parts lie within another's is taken up by the first of
    those that are left: one before it that nothing takes up, else the first one after it.  Of equal sets the last stays.
    """
    return owners_of_kept(cut(groups.select("_sel", key, parts)), key, parts)


def owners_of_kept(groups: DataFrame, key: str, parts: str) -> DataFrame:
    """`owners` of groups that are read more than once at no cost, such as those whose lineage was cut."""
    own = F.array_sort(F.array_distinct(F.filter(F.coalesce(F.col(parts), F.array()).cast("array<string>"), lambda p: p.isNotNull())))
    members = groups.select("_sel", F.col(key).alias("_key"), own.alias("_parts"))
    kind, n = members.schema["_key"].dataType.simpleString(), F.count("*").cast("double")
    beyond = (n > GROUP) | (n * n * (F.sum(F.size("_parts")) / 64 + 1) > STEPS)
    found = _by_selector(members, beyond, _compared, f"_sel string, _key {kind}, owner {kind}", _indexed)
    return kept(found.withColumnRenamed("_key", key))


def _lengthened(now: DataFrame) -> DataFrame:
    """`followed` of edges (_sel, _key, _top), however many a selector has: each round doubles the length of the paths that are known."""
    now = now.withColumn("path", F.array("_key"))
    nothing = F.array().cast(now.schema["path"].dataType)
    while True:
        above = now.select("_sel", F.col("_key").alias("_top"), F.col("_top").alias("_higher"), F.col("path").alias("_more"))
        if now.join(shuffled(above), ["_sel", "_top"], "left_semi").isEmpty():
            return now.select("_sel", "_key", F.col("_top").alias("root"), "path")
        now = cut(now.join(shuffled(above), ["_sel", "_top"], "left").select("_sel", "_key", F.coalesce("_higher", "_top").alias("_top"), F.concat(F.coalesce("_more", nothing), "path").alias("path")))


def _walked(batches):
    """Rows (_sel, _key, _top), by selector, to (_sel, _key, root, path)."""
    for rows, bounds in _runs(batches):
        sel, key, top = (rows.column(c).combine_chunks() for c in ("_sel", "_key", "_top"))
        names, tops, paths = key.to_pylist(), top.to_pylist(), []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            at = {names[i]: i for i in range(lo, hi)}
            known: dict[int, list[int]] = {}
            for i in range(lo, hi):
                way, j = [], i
                while j is not None and j not in known:
                    way.append(j)
                    j = at.get(tops[j])
                for x in reversed(way):
                    known[x] = [*known[j], x] if j is not None else [x]
                    j = x
            paths += [known[i] for i in range(lo, hi)]
        ends = np.cumsum([0, *map(len, paths)])
        steps = np.fromiter((x for p in paths for x in p), dtype=np.int64, count=ends[-1])
        made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), key.take(pa.array(steps)))
        yield pa.RecordBatch.from_arrays([sel, key, top.take(pa.array(steps[ends[:-1]])), made], names=["_sel", "_key", "root", "path"])


def followed(edges: DataFrame, key: str) -> DataFrame:
    """(_sel, key, root, path) of `owners`: the group in which each ends, and the keys from below the root down to its own.

    Put in order of their paths, groups are in the order in which their lists are joined to the root's.
    """
    now = edges.select("_sel", F.col(key).alias("_key"), F.col("owner").alias("_top"))
    kind = now.schema["_key"].dataType.simpleString()
    found = _by_selector(now, F.count("*") > PATHS, _walked, f"_sel string, _key {kind}, root {kind}, path array<{kind}>", _lengthened)
    return found.withColumnRenamed("_key", key)


def put_together(items: DataFrame, by: list[str], kinds: tuple[str, ...]) -> DataFrame:
    """One row per `by` with a list for each of `kinds`: the distinct items, each at its least place, with what is told there.

    `items` has `by`, kind, item, place (anything with an order) and told.  Repeats are gone before a list is made, so a
    key of any number of rows takes the memory of its distinct items, which the list itself has.  Items that are dealt by
    a column of `by` stay where they are.
    """
    once = items.groupBy(*by, "kind", "item").agg(F.min("place").alias("place"), F.min_by("told", "place").alias("told"))
    lists = [F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("place", "item", "told")))).alias(k) for k in kinds]
    return once.groupBy(*by).agg(*lists)
