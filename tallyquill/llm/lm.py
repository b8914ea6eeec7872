"""Language-model scores: a hidden Markov model trained by Baum-Welch counts that Spark sums over partitions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyquill.llm import tokens
from tallyquill.llm.common import arrow_batches, bucket, cut, held_out, stored, tidied

#: Hidden states; words that are symbols of their own; classes that the other words fall into by their first bytes.
STATES, SYMBOLS, CLASSES = 6, 16_384, 512
#: Most frequent words whose counts are broadcast; the counts of rarer ones are looked up by a join.
HEAD = 131_072
#: Rounds, each over all training documents, and shares that these are kept in.
ROUNDS, SHARES = 10, 4
#: What a symbol counts in a state beyond what is seen.
PSEUDO = 0.1
#: Bytes of text that are worked on at a time; a longer text is taken alone.
CHUNK = 1 << 22
#: Bytes of text whose words are only counted or looked up at a time.
PIECE = 1 << 18
#: Distinct words that a task counts before it sends its sums on.
FLUSH = 2_000_000
#: Leading bits by which a word is looked up.
BITS = 18
#: Symbols that a task of a round holds; cells and texts that the recursions run over at a time, and positions that they run unscaled.
HELD, CELLS, ROWS, UNSCALED = 1 << 22, 600_000, 256, 16
#: Cells whose posteriors are worked out at a time, so that they stay in a processor's cache.
BLOCK = 1 << 14
_END = np.uint64(0x5851F42D4C957F2D)
_LOG10 = np.log(10)


def classes(w: tokens.Words, at: np.ndarray | None = None) -> np.ndarray:
    """A class for each word, or those at `at`: a hash of its first two bytes and its last one."""
    ends = w.ends if at is None else w.ends[at]
    last = tokens.mix(w.data[ends - 1].astype(np.uint64) + np.uint64(911)) if len(ends) else np.zeros(0, dtype=np.uint64)
    return ((tokens.mix(tokens.prefixes(w, 2, at) + last) >> np.uint64(32)) % np.uint64(CLASSES)).astype(np.int64)


def _word_counts(batches):
    """Batches of training texts to (word, class, n), summed in the task; the end of a text is a word of class -1."""
    held: list[tuple[np.ndarray, ...]] = []
    ends = 0

    def merged():
        words, kinds, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(words)
        new = _starts(words[order])
        held[:] = [(words[order[new]], kinds[order[new]], np.add.reduceat(n[order], new))]
        return pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), *map(pa.array, held[0][1:])], names=["word", "kind", "n"])

    for batch in batches:
        ends += batch.num_rows
        for w in tokens.words(batch.column("text"), limit=PIECE):
            if len(w.hashes):
                order = np.argsort(w.hashes)
                new = _starts(w.hashes[order])
                held.append((w.hashes[order[new]], classes(w, order[new]), np.diff(np.append(new, len(order)))))
        if sum(len(x[0]) for x in held) > 2 * FLUSH:
            found = merged()
            if found.num_rows > FLUSH:
                yield found
                held.clear()
    if ends:
        held.append((np.array([_END]), np.array([-1]), np.array([ends])))
        yield merged()


def _starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1]))


@dataclass
class Vocabulary:
    """The most frequent words, sorted by hash, with counts and symbols, and the sums over each class of other words."""

    words: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray  # -1: none of its own
    kinds: np.ndarray
    total: int
    distinct: int
    end: int
    class_words: np.ndarray
    class_distinct: np.ndarray

    @property
    def n_symbols(self) -> int:
        return SYMBOLS + CLASSES + 1

    @cached_property
    def places(self) -> np.ndarray:
        """The first word of each leading BITS bits, or what comes after: words are hashes, and few share these."""
        return np.searchsorted(self.words, np.arange(1 << BITS, dtype=np.uint64) << np.uint64(64 - BITS))

    def floor(self) -> float:
        return self.total + 0.1 * (self.distinct + 1)

    def class_floor(self) -> np.ndarray:
        return self.class_words + 0.1 * (self.class_distinct + 1)


def _least(counts: DataFrame) -> int:
    """The least count such that at most HEAD words have it or more: found from a histogram, so that no task sorts words.

    Counts fall into 32 steps for each doubling, a few thousand in all.
    """
    step = F.floor(F.log2("n") * 32)
    steps = counts.where("kind >= 0").groupBy(step.alias("step")).agg(F.count("*").alias("m"), F.min("n").alias("n")).collect()
    least, total = 1 << 62, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        if (total := total + r["m"]) > HEAD:
            break
        least = r["n"]
    return least


def vocabulary(counts: DataFrame) -> Vocabulary:
    """What the driver needs of a table of all words' counts: sums, and the HEAD most frequent words."""
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("kind") < 0, F.col("n"))), F.lit(0))).first()
    head = counts.where((F.col("kind") >= 0) & (F.col("n") >= _least(counts))).toPandas().sort_values(["n", "word"], ascending=[False, True], ignore_index=True)
    symbols = np.where(np.arange(len(head)) < SYMBOLS, np.arange(len(head)), -1)
    per_class = counts.where("kind >= 0").groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    n[per_class.kind], v[per_class.kind] = per_class.n, per_class.v
    own = symbols >= 0
    np.subtract.at(n, head.kind.to_numpy()[own], head.n.to_numpy()[own])
    np.subtract.at(v, head.kind.to_numpy()[own], 1)
    words = head.word.to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(words)
    return Vocabulary(words[order], head.n.to_numpy()[order], symbols[order], head.kind.to_numpy()[order], int(whole[0]), int(whole[1]), int(whole[2]), n, v)


def _looked_up(w: tokens.Words, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word its place in the vocabulary's head (-1: none), its symbol and its class."""
    if not len(v.words):
        kinds = classes(w)
        return np.full(len(kinds), -1), SYMBOLS + kinds, kinds
    last = len(v.words) - 1
    at = np.minimum(v.places[w.hashes >> np.uint64(64 - BITS)], last)
    late = np.flatnonzero((v.words[at] < w.hashes) & (at < last))
    while len(late):
        at[late] += 1
        late = late[(v.words[at[late]] < w.hashes[late]) & (at[late] < last)]
    known = v.words[at] == w.hashes
    kinds = v.kinds[at]
    rare = np.flatnonzero(~known)
    kinds[rare] = classes(w, rare)
    own = np.where(known, v.symbols[at], -1)
    return np.where(known, at, -1), np.where(own >= 0, own, SYMBOLS + kinds), kinds


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states x symbols


def first_model(n_symbols: int, states: int = STATES) -> Model:
    noise = np.random.default_rng(7).dirichlet(np.full(states, 1.0), n_symbols).T + 0.05
    move = np.full((states, states), 0.02 / max(states - 1, 1))
    np.fill_diagonal(move, 0.98)
    return Model(np.full(states, 1 / states), move, noise / noise.sum(axis=1, keepdims=True))


@dataclass
class Packed:
    """Texts with their ends, position by position: at each, the symbols of those still running, the longest text first."""

    order: np.ndarray  # rows, the longest first
    offsets: np.ndarray  # position t has the cells offsets[t]..offsets[t + 1]
    seen: np.ndarray

    @property
    def places(self) -> np.ndarray:
        """Each cell's place in `order`."""
        return np.arange(len(self.seen)) - np.repeat(self.offsets[:-1], np.diff(self.offsets))


def _by_position(w: tokens.Words, symbols: np.ndarray, end: int) -> Packed:
    return _packed(w.counts, symbols, end)


def _packed(counts: np.ndarray, symbols: np.ndarray, end: int) -> Packed:
    """Texts of so many symbols each, one after the other, position by position."""
    lengths = counts + 1
    order = np.argsort(-lengths, kind="stable")
    running = np.searchsorted(-lengths[order], -np.arange(int(lengths.max())), side="left")
    offsets = np.append(0, np.cumsum(running))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    seen = np.empty(int(offsets[-1]), dtype=np.int64)
    seen[offsets[np.arange(len(symbols)) - np.repeat(np.cumsum(counts) - counts, counts)] + np.repeat(rank, counts)] = symbols
    seen[offsets[counts] + rank] = end
    return Packed(order, offsets, seen)


def _packs(counts: np.ndarray, symbols: np.ndarray, end: int) -> Iterator[Packed]:
    """The same, texts of like lengths together, about as many cells as ROWS of them have or CELLS; a longer text is alone."""
    order = np.argsort(-counts, kind="stable")
    starts, cells = np.cumsum(counts) - counts, np.append(0, np.cumsum(counts[order] + 1))
    first = 0
    while first < len(order):
        most = min(CELLS, ROWS * (counts[order[first]] + 1))
        last = max(first + 1, int(np.searchsorted(cells, cells[first] + most, side="right")) - 1)
        own = order[first:last]
        n = counts[own]
        yield _packed(n, symbols[np.arange(n.sum()) + np.repeat(starts[own] - (np.cumsum(n) - n), n)], end)
        first = last


def _forward(model: Model, p: Packed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scaled forward values, scales, emissions) of every cell."""
    emit = np.ascontiguousarray(model.emit.T)[p.seen]
    alphas, scales, ones = np.empty_like(emit), np.empty(len(emit)), np.ones(len(model.start))
    before = 0
    for lo, hi in zip(p.offsets[:-1].tolist(), p.offsets[1:].tolist()):
        a = alphas[lo:hi]
        if lo:
            np.matmul(alphas[before : before + hi - lo], model.move, out=a)
            a *= emit[lo:hi]
        else:
            np.multiply(emit[lo:hi], model.start, out=a)
        a /= np.matmul(a, ones, out=scales[lo:hi])[:, None]
        before = lo
    return alphas, scales, emit


def forward(model: Model, p: Packed) -> np.ndarray:
    """Natural log-likelihood of each row by the scaled forward recursion."""
    _, scales, _ = _forward(model, p)
    likelihood = np.empty(len(p.order))
    likelihood[p.order] = np.bincount(p.places, np.log(scales), len(p.order))
    return likelihood


def expectations(model: Model, p: Packed, sums: Model) -> float:
    """Adds the rows' expected counts of starts, moves and emissions to `sums`; their log-likelihood.

    Forward and backward values are scaled at every UNSCALED-th position; each cell's posteriors are made to sum to 1.
    """
    later = np.ascontiguousarray(model.emit.T)[p.seen]
    alphas, beta, scales, ones = np.empty_like(later), np.ones_like(later), np.ones(len(later)), np.ones(len(model.start))
    move, back = np.ascontiguousarray(model.move), np.ascontiguousarray(model.move.T)
    offsets, total = p.offsets.tolist(), 0.0
    first = offsets[1]
    np.multiply(later[:first], model.start, out=alphas[:first])
    for t in range(1, len(offsets) - 1):
        lo, hi, before = offsets[t], offsets[t + 1], offsets[t - 1]
        a = alphas[lo:hi]
        np.dot(alphas[before : before + hi - lo], move, out=a)
        np.multiply(a, later[lo:hi], out=a)
        if t % UNSCALED == 0:
            a /= np.dot(a, ones, out=scales[lo:hi])[:, None]
            total += float(np.log(scales[lo:hi]).sum())
    for t in range(len(offsets) - 2, 0, -1):
        lo, hi, before = offsets[t], offsets[t + 1], offsets[t - 1]
        b, after = beta[lo:hi], later[lo:hi]
        if t % UNSCALED == 0:
            b /= (b @ ones)[:, None]
        np.multiply(after, b, out=after)
        np.dot(after, back, out=beta[before : before + hi - lo])
    running, rows, n = np.diff(p.offsets), np.arange(first), len(later)
    total += float(np.log(alphas[p.offsets[np.searchsorted(-running, -rows) - 1] + rows] @ ones).sum())
    previous = np.arange(first, n) - np.repeat(running[:-1], running[1:])
    posterior, moved = np.empty((len(ones), n)), np.zeros_like(move)
    for lo in range(0, n, BLOCK):
        own, then = slice(lo, lo + BLOCK), slice(max(lo, first), max(lo + BLOCK, first))
        beta[own] *= alphas[own]
        scales[own] *= (whole := beta[own] @ ones)
        np.divide(beta[own].T, whole, out=posterior[:, own])
        moved += alphas[previous[then.start - first : then.stop - first]].T @ (later[then] / scales[then, None])
    sums.start += posterior[:, :first].sum(axis=1)
    sums.move += move * moved
    for k, own in enumerate(posterior):
        sums.emit[k] += np.bincount(p.seen, own, sums.emit.shape[1])
    return total


def _zero(model: Model) -> Model:
    return Model(np.zeros_like(model.start), np.zeros_like(model.move), np.zeros_like(model.emit))


def maximised(sums: Model) -> Model:
    start, move, emit = sums.start + PSEUDO, sums.move + PSEUDO, sums.emit + PSEUDO
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _coded(vocabulary):
    """Batches of training texts (share, text) to the same with their symbols, two bytes each."""

    def run(batches):
        v = vocabulary.value
        for batch in batches:
            for w in tokens.words(batch.column("text"), limit=PIECE):
                own, bounds = batch.slice(w.first, w.n_rows), (2 * w.bounds).astype(np.int32)
                seen = pa.Array.from_buffers(pa.binary(), w.n_rows, [None, pa.py_buffer(bounds), pa.py_buffer(_looked_up(w, v)[1].astype(np.uint16))])
                yield pa.RecordBatch.from_arrays([own.column("share"), own.column("text"), seen], names=["share", "text", "seen"])

    return run


def _texts(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of symbols, symbols) of batches of coded texts, until about HELD symbols are there."""
    counts, symbols = [], []
    for batch in batches:
        seen = batch.column("seen").cast(pa.large_binary())
        _, bounds, data = seen.buffers()
        at = np.frombuffer(bounds, dtype=np.int64)[seen.offset : seen.offset + len(seen) + 1] if len(seen) else np.zeros(1, dtype=np.int64)
        counts.append(np.diff(at) // 2)
        symbols.append(np.frombuffer(data, dtype=np.uint16, count=(at[-1] - at[0]) // 2, offset=at[0]) if at[-1] > at[0] else np.zeros(0, dtype=np.uint16))
        if sum(map(len, symbols)) >= HELD:
            yield np.concatenate(counts), np.concatenate(symbols)
            counts, symbols = [], []
    if counts:
        yield np.concatenate(counts), np.concatenate(symbols)


def _baum_welch(model):
    """Batches of coded texts to expected counts (row, k, n): row -1 starts, -2 - i moves from state i, else symbols."""

    def run(batches):
        m = model.value
        sums = _zero(m)
        for counts, symbols in _texts(batches):
            for p in _packs(counts, symbols, m.emit.shape[1] - 1):
                expectations(m, p, sums)
        own = np.flatnonzero(sums.emit.sum(axis=0))
        row = np.concatenate([own, [-1], -2 - np.arange(len(m.start))])
        values = np.concatenate([sums.emit[:, own].T, sums.start[None], sums.move])
        columns = [pa.array(values[:, k].copy()) for k in range(values.shape[1])]
        yield pa.RecordBatch.from_arrays([pa.array(row), *columns], names=["row", *(f"s{k}" for k in range(len(columns)))])

    return run


#: Training documents that make shares; fewer are one.
LEAST = 1000


def _round(docs: DataFrame, shared, model: Model) -> DataFrame:
    """Expected counts (row, s0, ...) that tasks find in coded `docs` by the `shared` model."""
    return docs.select("seen").mapInArrow(_baum_welch(shared), "row long, " + ", ".join(f"s{i} double" for i in range(len(model.start))))


def _gathered(found: DataFrame, model: Model) -> Model:
    """The sums of what tasks found, which are bounded by states times symbols."""
    k = len(model.start)
    rows = found.groupBy("row").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(k))).toPandas()
    values, at = rows[[f"s{i}" for i in range(k)]].to_numpy(), rows.row.to_numpy()
    sums = _zero(model)
    sums.emit[:, at[at >= 0]] = values[at >= 0].T
    sums.start[:] = values[at == -1].sum(axis=0)
    for i in range(k):
        sums.move[i] = values[at == -2 - i].sum(axis=0)
    return sums


def fit(docs: DataFrame) -> tuple[DataFrame, Vocabulary, Model]:
    """(all training words' counts, vocabulary, model), from documents outside the held-out fold.

    Each round of Baum-Welch is one job that counts all training documents by the model of the round before.  Their texts
    are looked up once, and kept in shares with their symbols, which the rounds read alone.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    own = docs.where(bucket("doc_id", 10) != 0).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = cut(own.select("text").mapInArrow(_word_counts, "word long, kind long, n long").groupBy("word").agg(F.first("kind").alias("kind"), F.sum("n").alias("n")))
    v = vocabulary(counts)
    model = first_model(v.n_symbols)
    n = SHARES if v.end >= LEAST else 1
    texts = own.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("share"), "text")
    coded = stored(texts.mapInArrow(_coded(spark.sparkContext.broadcast(v)), "share int, text string, seen binary"), "share")
    tasks = max(1, -(-own.rdd.getNumPartitions() // n))  # of a share: of all, as many as read the documents
    shares = [coded.where(F.col("share") == k).coalesce(tasks) for k in range(n)]
    for _ in range(ROUNDS):
        tidied(spark)
        shared = spark.sparkContext.broadcast(model)
        sums = _gathered(reduce(DataFrame.unionByName, [_round(share, shared, model) for share in shares]), model)
        shared.unpersist()
        if sums.emit.sum():  # else nothing was counted, and nothing is learnt
            model = maximised(sums)
    return counts, v, model


def _scored(shared, model):
    """Batches of (row, doc_id, text) to one row of sums for each text, and one for each of its words beyond the head.

    The words that the head has are settled here; a rarer word brings its class's sums along, and its count is joined.
    """

    def run(batches):
        v, m = shared.value, model.value
        base = np.log10(np.append(v.counts, v.end) + 0.1) - np.log10(v.floor())
        inside = np.log10(v.counts + 0.1) - np.log10(v.class_floor()[v.kinds]) if len(v.counts) else np.zeros(0)
        inside = np.where(v.symbols >= 0, 0.0, inside)
        for batch in batches:
            for w in tokens.words(batch.column("text"), limit=CHUNK):
                at, symbols, kinds = _looked_up(w, v)
                rows, known = w.rows, at >= 0
                score = forward(m, _by_position(w, symbols, v.n_symbols - 1)) / _LOG10
                score += np.bincount(rows[known], inside[at[known]], w.n_rows)
                sums = np.bincount(rows[known], base[at[known]], w.n_rows) + base[-1]
                n_known = np.bincount(rows[known], minlength=w.n_rows) + (v.end > 0)
                ids = batch.column("_row").slice(w.first, w.n_rows)
                n = w.n_rows
                nothing = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column("doc_id").slice(w.first, n), nothing, nothing, nothing, pa.array(w.counts + 1), pa.array(n_known), pa.array(sums), pa.array(score)],
                    names=_NAMES,
                )
                rare = np.flatnonzero(~known)
                if len(rare):
                    order = rare[np.lexsort((w.hashes[rare], rows[rare]))]
                    new = np.ones(len(order), dtype=bool)
                    new[1:] = (rows[order][1:] != rows[order][:-1]) | (w.hashes[order][1:] != w.hashes[order][:-1])
                    first = np.flatnonzero(new)
                    times = np.diff(np.append(first, len(order)))
                    own = order[first]
                    empty = [pa.nulls(len(own), t) for t in (batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(rows[own])), empty[0], pa.array(w.hashes[own].view(np.int64)), pa.array(kinds[own]), pa.array(times), *empty[1:]], names=_NAMES
                    )

    return run


_NAMES = ["_row", "doc_id", "word", "kind", "times", "n_tokens", "n_known", "base_score", "score"]


def score(docs: DataFrame, counts: DataFrame, v: Vocabulary, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row of `docs`; null texts are empty.

    The model: a state path, each state emitting a frequent word, the class of any other word, or the end; a word of a
    class has its share of the class's count.  `score` is the log10 probability of the whole text.  Repeated rows are
    scored one by one; other columns are ignored.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    sc = spark.sparkContext
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = rows.mapInArrow(_scored(sc.broadcast(v), sc.broadcast(model)), f"_row long, doc_id {kind}, word long, kind long, times long, n_tokens long, n_known long, base_score double, score double")
    # A text's own row is looked up under a word of its own, so that those rows spread like the others.
    parts = parts.withColumn("at", F.coalesce("word", F.xxhash64("_row")))
    floors = spark.createDataFrame([(k, float(x)) for k, x in enumerate(np.log10(v.class_floor()))], "kind long, class_floor double")
    joined = parts.join(counts.select(F.col("word").alias("at"), F.col("n").alias("c")), "at", "left").join(F.broadcast(floors), "kind", "left")
    rare = F.col("word").isNotNull()
    seen = F.log10(F.coalesce("c", F.lit(0)) + 0.1)
    sums = joined.groupBy("_row").agg(
        F.first("doc_id", True).alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.when(rare, F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).otherwise(F.col("n_known"))).alias("n_known"),
        F.sum(F.when(rare, (seen - float(np.log10(v.floor()))) * F.col("times")).otherwise(F.col("base_score"))).alias("base_score"),
        F.sum(F.when(rare, (seen - F.col("class_floor")) * F.col("times")).otherwise(F.col("score"))).alias("score"),
    )
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(v.total).cast("long").alias("train_tokens"), "base_score", "score")


def language_model(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the scores of every row of `docs` by a model of its documents outside the held-out fold."""
    found = score(docs, *fit(docs))
    return found.select("doc_id", held_out("doc_id", 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
