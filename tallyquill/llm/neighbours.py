"""Embedding near-duplicates by a robust-pruned flat graph that is built on overlapping cluster shards."""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm.common import arrow_batches, components, cut
from tallyquill.llm.tokens import mix

#: Least cosine of a link.
COSINE = 0.95
#: Vectors that the centroids are fitted on at most, vectors of a shard aimed at, and most centroids.
SAMPLE, SHARD, CENTROIDS = 20_000, 500, 1024
#: Centroids of which one this near to another is left out, so that what is alike has one nearest centroid.
APART = 0.7
#: Shards that a vector belongs to; most vectors of a block of a shard.
OVERLAP, BLOCK = 2, 2048
#: Out-degree of the graph, its pruning factor, width of the search, and medoids that it starts from.
DEGREE, ALPHA, BEAM, MEDOIDS = 24, 1.2, 24, 8
#: Queries of the recall audit, least recall (in sum and as a mean over queries), and how often the search is widened if
#: it isn't reached: first WIDER times as many shards, compared exactly, then all pairs of blocks.
AUDIT, RECALL, RETRIES, WIDER = 200, 0.95, 2, 4
_LOG = logging.getLogger(__name__)


def _units(batches):
    """Batches of (vec_id, embedding) to (vec_id, unit vector in double precision, two digests) of the usable rows."""
    for batch in batches:
        ids, units, ones, twos = [], [], [], []
        for i, e in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
            if i is None or not e or any(x is None for x in e):
                continue
            x = np.asarray(e, dtype=np.float64)
            top = np.abs(x).max()
            if not np.isfinite(x).all() or not top:
                continue
            x = x / top
            x = x / np.sqrt(x @ x)
            bits = (x + 0.0).view(np.uint64) + np.arange(len(x), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            ids.append(i)
            units.append(x.tobytes())
            ones.append(int(mix(bits).sum().view(np.int64)))
            twos.append(int(mix(bits ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum().view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("vec_id").type), pa.array(units, pa.binary()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64())], names=["vec_id", "unit", "d1", "d2"])


def _matrix(column) -> np.ndarray:
    rows = [np.frombuffer(x, dtype=np.float64) for x in column.to_pylist()]
    return np.stack(rows) if rows else np.zeros((0, 0))


def _centroids(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the sample's first rows, and then only centroids that are apart from one another."""
    own = sample[:k].copy()
    for _ in range(6):
        near = np.argmax(sample @ own.T, axis=1)
        sums = np.zeros_like(own)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1)
        own[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    kept: list[int] = []
    alike = own @ own.T
    for i in range(len(own)):
        if not kept or alike[i, kept].max() < APART:
            kept.append(i)
    return own[kept]


def _assigned(centroids, overlap: int):
    """Batches of vectors to one row per vector and shard: its nearest centroids, the first of which is its own."""

    def run(batches):
        c = centroids.value
        for batch in batches:
            x = _matrix(batch.column("unit"))
            if not len(x):
                continue
            n = min(overlap, len(c))
            near = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :n]
            rows = np.repeat(np.arange(len(x)), n)
            own = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(near.ravel()), pa.array(np.tile(np.arange(n) == 0, len(x))), pa.array([x.tobytes() for x in near.astype(np.int32)], pa.binary()).take(pa.array(rows))], names=[*own.schema.names, "shard", "primary", "shards"])

    return run


def pruned(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of the robust-pruned graph: of its nearest, a point drops those that a kept one is nearer to.

    All points go through their candidates at once, rank by rank.
    """
    n = len(x)
    if n < 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    alike = x @ x.T
    np.fill_diagonal(alike, -np.inf)
    m = min(2 * degree, n - 1)
    near = np.argpartition(-alike, m - 1, axis=1)[:, :m]
    order = np.argsort(-np.take_along_axis(alike, near, axis=1), axis=1, kind="stable")
    near = np.take_along_axis(near, order, axis=1)
    far = np.maximum(2 - 2 * np.take_along_axis(alike, near, axis=1), 0)  # squared distances
    open_, kept, count = np.ones(near.shape, dtype=bool), np.zeros(near.shape, dtype=bool), np.zeros(n, dtype=int)
    for r in range(m):
        take = open_[:, r] & (count < degree)
        kept[take, r] = True
        count += take
        if r + 1 < m:
            between = np.maximum(2 - 2 * alike[near[:, r, None], near[:, r + 1 :]], 0)
            open_[:, r + 1 :] &= ~(take[:, None] & (alpha * alpha * between <= far[:, r + 1 :]))
    kept[:, 0] = True
    rows, cols = np.nonzero(kept)
    return rows, near[rows, cols]


def _build(table: pa.Table) -> pa.Table:
    ids = table.column("vec_id").to_numpy()
    a, b = pruned(_matrix(table.column("unit")))
    return pa.table({"a": ids[a], "b": ids[b]})


def _parts(edges: list[np.ndarray]) -> np.ndarray:
    """Of each point the smallest point that edges, followed both ways, connect it with."""
    label = np.arange(len(edges))
    a, b = np.repeat(label, [len(x) for x in edges]), np.concatenate([*edges, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    while True:
        after = label.copy()
        np.minimum.at(after, a, label[b])
        np.minimum.at(after, b, label[a])
        after = after[after]
        if (after == label).all():
            return label
        label = after


class Searcher:
    """Range-expanding greedy search over a graph of points."""

    def __init__(self, x: np.ndarray, edges: list[np.ndarray], beam: int):
        self.x, self.edges, self.beam = x, edges, beam
        starts = [int(np.argmax(x @ x.sum(axis=0)))]  # the medoid, and then points far from those before
        far = x @ x[starts[0]]
        while len(starts) < min(MEDOIDS, len(x)):
            starts.append(int(np.argmin(far)))
            far = np.maximum(far, x @ x[starts[-1]])
        parts = _parts(edges)
        first, place = np.unique(parts, return_index=True)
        self.starts = np.append(starts, place[~np.isin(first, parts[starts])]).astype(np.int64)  # one of each part that they don't reach

    def near(self, q: np.ndarray, least: float) -> np.ndarray:
        """Points found whose cosine to q is at least `least`."""
        seen = np.zeros(len(self.x), dtype=bool)
        seen[self.starts] = True
        pool, alike = self.starts, self.x[self.starts] @ q
        done = np.zeros(len(self.x), dtype=bool)
        while True:  # greedy: open the best few of the beam until none is left
            ahead = pool[~done[pool]][:4]
            if not len(ahead):
                break
            done[ahead] = True
            new = np.unique(np.concatenate([self.edges[i] for i in ahead]))
            new = new[~seen[new]]
            seen[new] = True
            pool, alike = np.concatenate([pool, new]), np.concatenate([alike, self.x[new] @ q])
            top = np.argsort(-alike, kind="stable")
            inside = int((alike >= least).sum())
            top = top[: max(self.beam, inside)]  # whatever is in range stays, so the range is expanded to its border
            pool, alike = pool[top], alike[top]
        return pool[alike >= least]


def _lists(own: np.ndarray, lists: list) -> list[np.ndarray]:
    """Adjacency lists of ids as lists of places in `own`, without what isn't there."""
    order = np.argsort(own)
    edges = []
    for near in lists:
        at = np.array(near or [], dtype=np.int64)
        place = np.minimum(np.searchsorted(own[order], at), len(own) - 1)
        edges.append(order[place[own[order][place] == at]])
    return edges


def _search(least: float, exact: bool):
    """A cell: the queries of one block against the graph of one block; side 0 has the points, side 1 other queries.

    Gives (id, other, n): for each query the weighted number of links, with `other` null, and links that connect what
    the cell has not connected yet, with n 0.  Exactly, it compares all of them, and reports a link in the first only of
    the shards that its ends share.
    """

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        points, queries = np.flatnonzero(side == 0), np.flatnonzero(table.column("asks").to_numpy(zero_copy_only=False))
        empty = pa.table({"id": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        if not len(points) or not len(queries):
            return empty
        x, ids, weight = _matrix(table.column("unit")), table.column("vec_id").to_numpy(), table.column("copies").to_numpy()
        if exact:
            shards, here = np.stack([np.frombuffer(t, dtype=np.int32) for t in table.column("shards").to_pylist()]), table.column("shard")[0].as_py()

            def hits():
                for k in range(0, len(queries), 64):
                    few = queries[k : k + 64]
                    row, col = np.nonzero(x[few] @ x[points].T >= least)
                    ours, theirs = shards[few[row]], shards[points[col]]
                    both = (ours[:, :, None] == theirs[:, None, :]).any(axis=2)
                    mine = np.where(both, ours, np.iinfo(np.int32).max).min(axis=1) == here if len(row) else np.zeros(0, dtype=bool)
                    for r, q in enumerate(few):
                        yield q, points[col[mine & (row == r)]]

        else:
            search = Searcher(x[points], _lists(ids[points], [table.column("near")[int(p)].as_py() for p in points]), BEAM)

            def hits():
                for q in queries:
                    yield q, points[search.near(x[q], least)]

        parent = {int(i): int(i) for i in ids}

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        a, b, n = [], [], []
        for q, found in hits():
            found = found[ids[found] != ids[q]]
            if len(found):
                a.append(int(ids[q]))
                b.append(None)
                n.append(int(weight[found].sum()))
            for i in ids[found].tolist():
                one, two = root(int(ids[q])), root(i)
                if one != two:
                    parent[max(one, two)] = min(one, two)
                    a.append(int(ids[q]))
                    b.append(i)
                    n.append(0)
        return pa.table({"id": pa.array(a, pa.int64()), "other": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def _brute(queries, least: float):
    """Batches of vectors to the weighted number of links that each audited query has among them, without its own."""

    def run(batches):
        ids, q = queries.value
        for batch in batches:
            x = _matrix(batch.column("unit"))
            if len(x) and len(q):
                hit = (q @ x.T >= least) & (ids[:, None] != batch.column("vec_id").to_numpy()[None])
                n = hit @ batch.column("copies").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64))], names=["id", "n"])

    return run


def _links(nodes: DataFrame, centroids, least: float, overlap: int, exact: bool) -> DataFrame:
    """(id, other, n) of `_search` over all cells: by graph in each vector's own shard, or exactly in all its shards."""
    return _compared(nodes.mapInArrow(_assigned(centroids, overlap), "vec_id long, unit binary, copies long, shard long, primary boolean, shards binary"), least, exact)


def _compared(placed: DataFrame, least: float, exact: bool) -> DataFrame:
    """(id, other, n) of nodes that have a shard, block against block."""
    sizes = placed.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    placed = cut(placed.join(F.broadcast(sizes), "shard").withColumn("own", F.pmod(F.xxhash64("vec_id"), F.col("blocks"))))  # at most CENTROIDS rows
    asks = F.lit(True) if exact else F.col("primary")
    if exact:
        lists = placed.withColumn("near", F.lit(None).cast("array<bigint>"))
    else:
        edges = placed.groupBy("shard", "own").applyInArrow(_build, "a long, b long")
        both = edges.union(edges.select("b", "a")).distinct()
        lists = placed.join(cut(both.groupBy(F.col("a").alias("vec_id")).agg(F.collect_list("b").alias("near"))), "vec_id", "left")
    cells = lists.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    points = cells.select("shard", F.col("own").alias("p"), F.col("other").alias("q"), "vec_id", "unit", "copies", "shards", "near", F.lit(0).alias("side"), ((F.col("own") == F.col("other")) & asks).alias("asks"))
    asking = cells.where((F.col("own") != F.col("other")) & asks).select("shard", F.col("other").alias("p"), F.col("own").alias("q"), "vec_id", "unit", "copies", "shards", F.lit(None).cast("array<bigint>").alias("near"), F.lit(1).alias("side"), F.lit(True).alias("asks"))
    return cut(points.unionByName(asking).groupBy("shard", "p", "q").applyInArrow(_search(least, exact), "id long, other long, n long"))


#: Sampled vectors with links that an audit needs, if the table has so many.
LINKED = 50


def _audited(nodes: DataFrame, n: int, least: float):
    """(id, n): the links that brute force finds of a sample of nodes, those that have any; more are drawn if few have."""
    sc = nodes.sparkSession.sparkContext
    for size in (AUDIT, 10 * AUDIT):
        asked = nodes.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(max(1, n // size))) == 0).select("vec_id", "unit").limit(2 * size).toPandas()
        queries = sc.broadcast((asked.vec_id.to_numpy(), _matrix(asked.unit.pipe(pa.array))))
        true = nodes.mapInArrow(_brute(queries, least), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).where("n > 0").toPandas()
        if len(true) >= LINKED or size >= n:
            break
    return true


def _found(nodes: DataFrame, n: int, least: float) -> DataFrame:
    """(id, other, n) of `_search` over nodes of one length, by as wide a search as the audited recall asks for."""
    sc = nodes.sparkSession.sparkContext
    sample = _matrix(nodes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("unit").toPandas()["unit"].pipe(pa.array))
    centroids = sc.broadcast(_centroids(sample, max(1, min(CENTROIDS, n // SHARD, len(sample)))))
    true = _audited(nodes, n, least)
    for widen in range(RETRIES + 1):
        if widen == RETRIES:
            centroids = sc.broadcast(centroids.value[:1])  # one shard: all pairs of blocks
        found = _links(nodes, centroids, least, OVERLAP if not widen else OVERLAP * WIDER, widen > 0)
        got = found.where(F.col("other").isNull() & F.col("id").isin(true.id.tolist())).groupBy("id").agg(F.sum("n").alias("got")).toPandas()
        share = true.merge(got, on="id", how="left").fillna({"got": 0})
        recall = min(share.got.sum() / share.n.sum(), (share.got / share.n).clip(upper=1).mean()) if len(share) else 1.0
        _LOG.info("search %d: recall %.4f over %d queries", widen, recall, len(share))
        if recall >= RECALL:
            return found
    raise RuntimeError(f"recall is {recall:.4f}, below {RECALL}")


def near_duplicates(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding).

    Equal vectors are collapsed to one node first and counted as links of each other.  Nodes go to the shards of their
    nearest centroids, fitted on a bounded sample; each shard's graph is built and pruned in a task, the adjacency
    lists of all shards are united, and every node is searched for in its nearest shard from medoids, keeping on for as
    long as points in range turn up.  Every link reported is checked in double precision.  A sample of queries is
    compared with brute force over all nodes; short of RECALL, in sum or as a mean over queries, more shards of each
    vector are compared exactly, and then all nodes, and it is an error if that falls short.  The recall is logged.
    Shards of more than BLOCK nodes are searched block against block.

    Vectors that are null, empty, zero or hold null or non-finite components have no links and are their own
    component; so are rows whose vec_id is null, with a null component.  Rows that repeat a vec_id and its
    vector count once; a vec_id with several vectors is one node for each.  Vectors link within their length only: the
    commonest length, and those of more than BLOCK vectors, are searched as above, others exactly, block against block.  An empty table gives none.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    arrow_batches(spark)
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    units = cut(every.mapInArrow(_units, "vec_id long, unit binary, d1 long, d2 long"))
    pairs = units.select("vec_id", "d1", "d2").distinct()
    same = pairs.groupBy("d1", "d2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    copy_of = cut(pairs.join(same, ["d1", "d2"]).select("vec_id", "rep", "copies"))
    nodes = cut(units.join(same, ["d1", "d2"]).where("vec_id = rep").select("vec_id", "unit", "copies").dropDuplicates(["vec_id", "unit"]))
    length = F.octet_length("unit")
    sizes = nodes.groupBy(length.alias("n")).count().where("count > 1").orderBy(F.desc("count"), "n")
    # The commonest length, and all of more than BLOCK vectors, of which there are one in BLOCK vectors at most.
    sizes = {r.n: r["count"] for r in sizes.limit(1).union(sizes.where(F.col("count") > BLOCK)).collect()}
    few = nodes.where(~length.isin(*sizes)) if sizes else nodes
    # Other lengths are shards of their own; a shard's number is told as four bytes, the lowest first.
    digits = F.lpad(F.hex(length), 8, "0")
    told = F.unhex(F.concat(*(F.substring(digits, k, 2) for k in (7, 5, 3, 1))))
    found = _compared(few.select("vec_id", "unit", "copies", length.cast("long").alias("shard"), F.lit(True).alias("primary"), told.alias("shards")), least, True)
    for size, n in sizes.items():
        found = found.unionByName(_found(nodes.where(length == size), n, least))
    counts = found.groupBy("id").agg(F.sum("n").alias("linked"))
    groups = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    known = copy_of.join(counts, copy_of["rep"] == counts["id"], "left").drop("id").join(groups, F.col("rep") == F.col("id"), "left")
    known = known.groupBy("vec_id").agg(F.sum(F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.min(F.coalesce("component", "rep")).alias("component"))
    result = every.select("vec_id").join(known, "vec_id", "left")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"), (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"))
