"""N-gram Jaccard join: points of group counts in R-trees, overlap bounded by summed coordinate minima, pairs verified."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyquill.llm import tokens
from tallyquill.llm.common import arrow_batches, components, counted, cut

#: Words of a shingle, and the least similarity of a link in percent.
WORDS, PERCENT = 3, 90
#: Shingles of a set for each coordinate of its point, about; a point has LEAST_GROUPS coordinates at least.
PER_GROUP, LEAST_GROUPS = 4, 64
#: Points of an R-tree's leaf, and most points of one block; larger groups are joined block by block.
LEAF, BLOCK = 16, 256
#: Ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: One document of HOT_SHARE tells which cells are hot: those of HOT sampled sets or more, the HOT_CELLS largest at most;
#: a hot cell's sets are dealt to HOT_PARTS.
HOT_SHARE, HOT, HOT_CELLS, HOT_PARTS = 1024, 64, 100_000, 256


def shingle_sets(w: tokens.Words, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's distinct shingles, sorted; a row of fewer words has its whole sequence as one."""
    rows, parts = w.rows, []
    for k in range(1, n + 1):
        at, hashes = w.grams(k)
        own = rows[at]
        short = w.counts[own] == k if k < n else np.ones(len(at), dtype=bool)
        parts.append((own[short], hashes[short]))
    return tokens.by_row(np.concatenate([r for r, _ in parts]), np.concatenate([h for _, h in parts]))


def _fingerprints(rows: np.ndarray, values: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit digests of each row's set."""
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    size = np.diff(bounds)
    out = []
    for seed in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(tokens.mix(values ^ np.uint64(seed)), out=total[1:])
        out.append(tokens.mix(total[bounds[1:]] - total[bounds[:-1]] + size.astype(np.uint64)))
    return size, *out


def _coded(point: np.ndarray) -> bytes:
    """A point's coordinates in half a byte, one, two or four bytes each, as the largest needs, after a byte that tells it.

    A point has an even number of coordinates, of which one byte takes two.
    """
    if (most := point.max(initial=0)) < 16 and len(point) % 2 == 0:
        return bytes([0]) + (point[0::2] | point[1::2] << 4).astype("<u1").tobytes()
    size = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([size]) + point.astype(f"<u{size}").tobytes()


def _decoded(coded: bytes) -> np.ndarray:
    if not coded[0]:
        both = np.frombuffer(coded, dtype="<u1", offset=1)
        return np.stack([both & 15, both >> 4], axis=1).ravel().astype(np.int32)
    return np.frombuffer(coded, dtype=f"<u{coded[0]}", offset=1).astype(np.int32)


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    """The point in fewer groups: those of the same leading bits are added up."""
    return point.reshape(*point.shape[:-1], groups, -1).sum(axis=-1, dtype=np.int32)


def points_of(rows: np.ndarray, values: np.ndarray, n_rows: int) -> list[np.ndarray]:
    """The points of sets: how many of a set's shingles fall into each group of leading hash bits.

    Larger sets have more groups, a power of two, so that a point tells as much of every set.
    """
    size = np.bincount(rows, minlength=n_rows)
    groups = np.maximum(LEAST_GROUPS, 1 << np.ceil(np.log2(np.maximum(size, 1) / PER_GROUP)).clip(0, 30).astype(np.int64))
    ends = np.cumsum(groups)
    at = (ends - groups)[rows] + (((values >> np.uint64(32)) * groups[rows].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    every = np.bincount(at, minlength=int(ends[-1]) if n_rows else 0)
    return np.split(every, ends[:-1])


def _base(n: int):
    def run(batches):
        for batch in batches:
            for w in tokens.words(batch.column("text")):
                rows, values = shingle_sets(w, n)
                size, one, two = _fingerprints(rows, values, w.n_rows)
                coded = pa.array([_coded(p) for p in points_of(rows, values, w.n_rows)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(w.first, w.n_rows), pa.array(size, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), coded], names=["doc_id", "n", "fp", "fp2", "point"])

    return run


def leading(rows: np.ndarray, values: np.ndarray, n_rows: int, percent: int, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle): each set's first shingles in an order that is the same for all sets, rare ones first.

    Sets that link have so many shingles in common that the first common one is among the first of either: of a set of b
    shingles, any that it links with has at least b * percent / 100 of them, so b less that, and one more, are enough.
    """
    hashes, levels = common
    at = np.minimum(np.searchsorted(hashes, values), max(len(hashes) - 1, 0))
    level = np.where(hashes[at] == values, levels[at], 0) if len(hashes) else np.zeros(len(values), dtype=np.int64)
    order = np.lexsort((values, level, rows))
    size = np.bincount(rows, minlength=n_rows)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
    keep = place < (size + (-size * percent) // 100 + 1)[rows]
    return rows[keep], values[order][keep]


def size_class(size: np.ndarray, percent: int) -> np.ndarray:
    """Classes of sizes: sets that link are of one class or of neighbouring ones."""
    return np.floor(np.log(np.maximum(size, 1)) / np.log(100 / percent) * (1 - 1e-9)).astype(np.uint64) if percent < 100 else np.asarray(size, dtype=np.uint64)


def classed(size: np.ndarray, values: np.ndarray, percent: int) -> np.ndarray:
    """Each shingle's name in its set's class, then each one's in the next class: sets that link share a name in one of them."""
    at = size_class(size, percent)
    return tokens.mix(np.concatenate([values, values]) ^ tokens.mix(np.concatenate([at, at + np.uint64(1)])))


def differ(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of this size and one that it links with don't share, at most."""
    return (size + size * 100 // percent) * (100 - percent) // (100 + percent)


def group_names(rows: np.ndarray, values: np.ndarray, n_rows: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, name): names such that any two different sets that link have one in common, and hardly any others do.

    The sets of a class and of the one below are cut into the class's number of groups by leading hash bits, and a name
    is the digest of a whole group.  Sets that differ in d shingles have all but d groups in common.  So each set needs
    only its d + 1 largest groups, ties in order: of the common groups the largest is among them in both sets.  Where
    that could be a group of one shingle or none, the set has its leading shingles for names as well.
    """
    size = np.bincount(rows, minlength=n_rows)
    most, lowest = differ(size, percent), size_class(size, percent).astype(np.int64)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(tokens.mix(values ^ np.uint64(0xD1B54A32D192ED03)), out=total[1:])
    out = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))]
    for above in (0, 1):
        own = lowest + above
        top = np.floor(np.exp((own + 1) * np.log(100 / percent) / (1 - 1e-9))).astype(np.int64) + 1 if percent < 100 else size
        groups = np.where(most > 0, 1 + differ(top, percent) * 4 // 3, 0)  # sets that can't differ are one already
        at = np.flatnonzero(groups[rows])
        r = rows[at]
        g = (((values[at] >> np.uint64(32)) * groups[r].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (g[1:] != g[:-1]))) if len(at) else at
        after = np.append(first[1:], len(at))[: len(first)]
        r, g, count = r[first], g[first], after - first
        digest = tokens.mix(total[at[after - 1] + 1] - total[at[first]] + tokens.mix((own[r] << 32 | g).astype(np.uint64)))
        order = np.lexsort((g, -count, r))
        filled = np.bincount(r, minlength=n_rows)
        place = np.arange(len(r)) - np.repeat(np.cumsum(filled) - filled, filled)
        keep = order[(place <= most[r]) & (count[order] > 1)]
        out.append((r[keep], digest[keep]))
        short = ((groups > 0) & (np.bincount(r[keep], minlength=n_rows) <= most))[rows]
        r, led = leading(rows[short], values[short], n_rows, percent, (values[:0], lowest[:0]))
        out.append((r, np.split(classed(size[r], led, percent), 2)[above]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _named(n: int, percent: int):
    def run(batches):
        for batch in batches:
            for w in tokens.words(batch.column("text")):
                rows, values = shingle_sets(w, n)
                _, fp, _ = _fingerprints(rows, values, w.n_rows)
                first = np.zeros(w.n_rows, dtype=bool)
                first[np.unique(fp, return_index=True)[1]] = True  # copies within a batch have the same names
                keep = first[rows]
                r, names = group_names(rows[keep], values[keep], w.n_rows, percent)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(fp[r].view(np.int64))], names=["name", "fp"])

    return run


def least_overlap(a: np.ndarray | int, b: np.ndarray | int, percent: int = PERCENT) -> np.ndarray:
    """Shingles that sets of a and b have in common at least if they link."""
    return -(-(np.asarray(a) + b) * percent // (100 + percent))


class RTree:
    """Points packed by sort-tile-recursive order into leaves, and leaves into nodes, each with its box's upper corner."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.size = points, points.sum(axis=1)
        order = self._tiles(np.arange(len(points)), leaf, list(np.argsort(-points.var(axis=0))[:3]))
        self.leaves = [order[i : i + leaf] for i in range(0, len(order), leaf)]
        self.levels = []
        high = np.stack([points[x].max(axis=0) for x in self.leaves])
        least, most = (np.array([f(self.size[x]) for x in self.leaves]) for f in (np.min, np.max))
        self.levels.append((high, least, most))
        while len(high) > leaf:
            cuts = np.arange(0, len(high), leaf)
            high, least, most = np.maximum.reduceat(high, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)
            self.levels.append((high, least, most))
        self.leaf = leaf

    def _tiles(self, own: np.ndarray, leaf: int, axes: list[int]) -> np.ndarray:
        """Order by size first, then by the coordinates that vary most, slab by slab."""
        keys = [self.size, *(self.points[:, a] for a in axes)]

        def cut(part: np.ndarray, depth: int) -> list[np.ndarray]:
            part = part[np.argsort(keys[depth][part], kind="stable")]
            if len(part) <= leaf or depth == len(keys) - 1:
                return [part]
            n = max(1, int(np.ceil((len(part) / leaf) ** (1 / (len(keys) - depth)))))
            return [y for x in np.array_split(part, n) for y in cut(x, depth + 1)]

        return np.concatenate(cut(own, 0))

    def search(self, p: np.ndarray, percent: int = PERCENT) -> np.ndarray:
        """Points whose overlap with p may suffice: below a box's corner, the minima's sum bounds every point within."""
        n = int(p.sum())
        nodes = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most = self.levels[depth]
            fits = (least[nodes] * percent <= 100 * n) & (most[nodes] * 100 >= percent * n)
            fits &= np.minimum(high[nodes], p).sum(axis=1) >= least_overlap(n, least[nodes], percent)
            nodes = nodes[fits]
            if depth:
                below = len(self.levels[depth - 1][0])
                nodes = np.concatenate([np.arange(x * self.leaf, min((x + 1) * self.leaf, below)) for x in nodes]) if len(nodes) else nodes
        if not len(nodes):
            return nodes
        own = np.concatenate([self.leaves[x] for x in nodes])
        size = self.size[own]
        fits = (size * percent <= 100 * n) & (size * 100 >= percent * n)
        return own[fits & (np.minimum(self.points[own], p).sum(axis=1) >= least_overlap(n, size, percent))]


class _Block:
    """A block's members in R-trees, one for each number of groups that their points have."""

    def __init__(self, members: list[tuple]):
        self.members, self.points = members, [_decoded(m[2]) for m in members]
        self.groups = np.array([len(p) for p in self.points])
        self.trees: dict[tuple[int, bool], tuple[np.ndarray, RTree]] = {}

    def _tree(self, groups: int, wider: bool) -> tuple[np.ndarray, RTree | None]:
        """(members, tree) of the points of so many groups, and, if `wider`, of twice as many."""
        if (groups, wider) not in self.trees:
            own = np.flatnonzero((self.groups == groups) | (wider & (self.groups == 2 * groups)))
            self.trees[groups, wider] = own, RTree(np.stack([folded(self.points[i], groups) for i in own])) if len(own) else None
        return self.trees[groups, wider]

    def search(self, point: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(members, bound of their overlap) that may link; sets that link differ by one doubling of groups at most."""
        found, bounds = [], []
        for groups, wider in ((len(point), True), (len(point) // 2, False)):
            own, tree = self._tree(groups, wider)
            if tree is not None:
                p = folded(point, groups)
                at = tree.search(p, percent)
                found.append(own[at])
                bounds.append(np.minimum(tree.points[at], p).sum(axis=1) / (tree.size[at] + p.sum()))
        return (np.concatenate(found), np.concatenate(bounds)) if found else (np.zeros(0, dtype=np.int64), np.zeros(0))


def _block_pairs(probes: list[tuple], members: list[tuple], percent: int, nearest: bool) -> list[tuple]:
    """(probe, member) that may link and aren't connected yet; with `nearest`, for each probe only the likeliest.

    Rows are (id, component, point, is a probe).  Two probes are tried once, by the one of the smaller id.
    """
    block, out = _Block(members), []
    for i, comp, coded, _ in probes:
        found, bounds = block.search(_decoded(coded), percent)
        own = [(b, members[j][0]) for j, b in zip(found, bounds) if members[j][1] != comp and (not members[j][3] or i < members[j][0])]
        out.extend((i, j) for _, j in (sorted(own, key=lambda x: (-x[0], x[1]))[:1] if nearest else own))
    return out


def _tree_join(percent: int, nearest: bool):
    """Blocks of rows, probes first, to pairs: each block's members are put into an R-tree, and its probes searched there."""

    def run(batches):
        block, probes, members = None, [], []
        for batch in batches:
            found = []
            for at, side, *row in zip(*(batch.column(x).to_pylist() for x in ("block", "side", "id", "comp", "point", "probe"))):
                if at != block:
                    if probes and members:
                        found.extend(_block_pairs(probes, members, percent, nearest))
                    block, probes, members = at, [], []
                (members if side else probes).append(row)
            if found:
                yield _pairs(found)
        if probes and members and (found := _block_pairs(probes, members, percent, nearest)):
            yield _pairs(found)

    return run


def _pairs(found: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _row_sets(batch: pa.RecordBatch, n: int):
    """Each row's sorted shingle hashes, in order."""
    for w in tokens.words(batch.column("text")):
        rows, values = shingle_sets(w, n)
        bounds = np.searchsorted(rows, np.arange(w.n_rows + 1))
        yield from (values[bounds[i] : bounds[i + 1]] for i in range(w.n_rows))


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or len(small) * 100 < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify(n: int, percent: int):
    """Rows (a, part, side, id, text), of each a and part the text of a first, to the pairs (a, id) that link."""

    def run(batches):
        of, sets = None, []
        for batch in batches:
            found = []
            for a, part, side, i, own in zip(*(batch.column(x).to_pylist() for x in ("a", "part", "side", "id")), _row_sets(batch, n)):
                if (a, part) != of:
                    of, sets = (a, part), []
                if not side:
                    sets.append(own)
                elif any(_alike(x, own, percent) for x in sets):
                    found.append((a, i))
            if found:
                yield _pairs(found)

    return run


def _linked(docs: DataFrame, pairs: DataFrame, n_words: int, percent: int) -> tuple[DataFrame, int]:
    """The pairs (a, b) that link, and their number.  Of each a, blocks of its partners; a text is moved once for each of its blocks."""
    kind = pairs.schema["a"].dataType.simpleString()
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    both = F.inline(F.array(*(F.struct(F.lit(side).alias("side"), F.col(x).alias("id")) for side, x in enumerate(("a", "b")))))
    named, n = counted(pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), "parts").alias("part"), both).distinct())
    wanted = F.broadcast(named) if n <= BROADCAST_IDS else named
    texts = docs.join(wanted, docs["doc_id"] == wanted["id"]).select("a", "part", "side", "id", "text")
    texts = texts.repartition("a", "part").sortWithinPartitions("a", "part", "side")
    return counted(texts.mapInArrow(_verify(n_words, percent), f"a {kind}, b {kind}").distinct())


def _cells(docs: DataFrame, sets: DataFrame, n_words: int, percent: int) -> DataFrame:
    """(head, id, point, top): the cells that sets are dealt to; every two sets that link are in a cell together.

    A cell holds all sets that share a name (`group_names`) whose first set is the cell's head, once each, however many
    names they share.  Whole groups of shingles are shared by near copies only, so cells grow with these and not with
    the shingles that any two texts happen to share.  A name of many sets, as a sample of the documents tells, gets a
    head from the sample, and its sets are dealt to several tasks; the sample settles only who is head.
    """
    docs = docs.where("doc_id is not null")
    make, kind = _named(n_words, percent), "name long, fp long"
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SHARE)) == 0).mapInArrow(make, kind)
    hot = sample.groupBy("name").agg(F.min("fp").alias("hot_head"), F.count("*").alias("m")).where(F.col("m") >= HOT)
    hot = hot.orderBy(F.desc("m"), "name").limit(HOT_CELLS).select("name", "hot_head")
    part = F.when(F.col("hot_head").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp"), F.lit(HOT_PARTS)))
    named = docs.mapInArrow(make, kind).join(F.broadcast(hot), "name", "left").withColumn("part", part)
    shared = named.select(F.coalesce("hot_head", F.min("fp").over(Window.partitionBy("name", "part"))).alias("head"), "fp").where("head <> fp")
    cells = shared.select("head", F.explode(F.array("fp", "head")).alias("fp")).distinct()
    return cut(cells.join(sets, "fp").select("head", F.col("rep").alias("id"), "point", (F.col("fp") == F.col("head")).alias("top")))


def _candidates(cells: DataFrame, percent: int, nearest: bool = False) -> tuple[DataFrame, int]:
    """Pairs (a, b) of sets of a cell, of which one is a probe, in different components, that may link by their points, and their number.

    A large cell's members go into several trees, and its probes are searched in each of them, block by block.
    """
    kind = cells.schema["id"].dataType.simpleString()
    sizes = cells.groupBy("head").agg(F.ceil(F.count("*") / BLOCK).alias("trees"), F.ceil(F.count(F.when(F.col("probe"), 1)) / BLOCK).alias("probings"), (F.min("comp") < F.max("comp")).alias("apart")).where("probings > 0 and apart").drop("apart")
    blocks = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    x, y = F.pmod(F.xxhash64("id"), "trees"), F.pmod(F.xxhash64("id"), "probings")
    member = F.transform(blocks("probings"), lambda k: F.struct(F.lit(1).alias("side"), x.alias("x"), k.alias("y")))
    probe = F.transform(blocks("trees"), lambda k: F.struct(F.lit(0).alias("side"), k.alias("x"), y.alias("y")))
    dealt = cells.join(sizes, "head").select("head", "id", "comp", "point", "probe", F.inline(F.when(F.col("probe"), F.concat(member, probe)).otherwise(member)))
    blocks = dealt.select("side", F.concat_ws(",", "head", "x", "y").alias("block"), "id", "comp", "point", "probe")
    return counted(blocks.repartition("block").sortWithinPartitions("block", "side").mapInArrow(_tree_join(percent, nearest), f"a {kind}, b {kind}").distinct())


def _sets(docs: DataFrame, n_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a row per document; a row per set, with the smallest id that has it; links between copies)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = cut(docs.mapInArrow(_base(n_words), f"doc_id {kind}, n long, fp long, fp2 long, point binary"))
    known = base.where("n > 0 and doc_id is not null")
    sets = cut(known.groupBy("fp", "fp2", "n").agg(F.min(F.struct("doc_id", "point")).alias("s")).select("fp", "fp2", "n", F.col("s.doc_id").alias("rep"), F.col("s.point").alias("point")))
    copies = known.drop("point").join(sets.drop("point"), ["fp", "fp2", "n"]).where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    return base, sets, copies


def similar_links(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(one row per document with doc_id, n and its set's digests; links (a, b) that connect what is similar; components).

    Links are between document ids: every pair of different sets of which one is linked, directly, or through links
    that are given.  That is enough to find every group, and a large group needs few of its pairs.
    """
    arrow_batches(docs.sparkSession, 500)
    docs = docs.select("doc_id", "text")
    base, sets, copies = _sets(docs, n_words)
    cells = _cells(docs, sets, n_words, percent)
    # First a cell's head is searched among its members, which connects most of what is alike.  What stays apart from the
    # head is searched next: the likeliest partner of each, then all partners whose bound allows a link.
    pairs, _ = _candidates(cells.withColumns({"comp": F.col("id"), "probe": F.col("top")}), percent)
    links = copies.unionByName(_linked(docs, pairs, n_words, percent)[0])
    of, new = components(links), True
    for nearest in (True, False):
        if new:
            every = cut(cells.join(of, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component"))
        tops = every.where("top").groupBy("head").agg(F.min("comp").alias("main"))
        # A head has been searched among all of its cell, and what is left without it needs two components to be tried.
        placed = every.where("not top").join(tops, "head").withColumn("probe", F.col("comp") != F.col("main"))
        pairs, n = _candidates(placed, percent, nearest)
        if not n:  # a probe without a likeliest partner has none at all
            break
        found, new = _linked(docs, pairs, n_words, percent)
        if new:
            links = links.unionByName(found)
            of = components(of.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(found))
    return base, links, of


def all_links(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Every link (a, b) between different sets, a < b, each set named by the smallest doc_id that has it.

    The rows grow with the square of a group of near copies; `jaccard_join` needs no such list.
    """
    arrow_batches(docs.sparkSession, 500)
    docs = docs.select("doc_id", "text")
    base, sets, _ = _sets(docs, n_words)
    cells = _cells(docs, sets, n_words, percent).withColumns({"comp": F.col("id"), "probe": F.lit(True)})
    found, _ = _linked(docs, _candidates(cells, percent)[0], n_words, percent)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def jaccard_join(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs`.

    Two documents link when their sets of `n_words`-word shingles overlap by at least `percent` of their union; the
    component is the smallest doc_id that links reach.  Sets of one digest are collapsed first, so a group of copies
    costs one row each.  Sets are dealt to cells in which every linked pair meets; candidates come from the cells'
    R-trees of count points, which bound the overlap; every surviving pair is verified on the shingles' 64-bit hashes.

    Null texts and texts without words have no shingles and are their own component.  Rows of one doc_id are one node.
    A null doc_id has no component.  Other columns are ignored.
    """
    base, _, found = similar_links(docs, n_words, percent)
    joined = base.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` without those of a document whose component has a smaller doc_id; all columns are kept."""
    _, _, found = similar_links(docs, n_words, percent)
    gone = found.where("id <> component").select(F.col("id").alias("_gone"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti").select(*docs.columns)
