"""Quality: how much better a dictionary of good texts compresses a text than a dictionary of bad ones."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyquill.llm import tokens
from tallyquill.llm.common import arrow_batches, held_out, labelled_sample, plus, unused

#: Most labelled documents that dictionaries and calibration are made from, half of each label where there are so many.
SAMPLE = 8000
#: Texts are compressed in blocks of so many bytes, so that the dictionary counts more than repetition within a text.
BLOCK = 1024
#: Bytes of each dictionary; of a sampled block that goes into training one; of samples for one dictionary.
DICTIONARY, PIECE, PIECES = 112_640, 400, 2_000_000
LEVEL = 3
#: Bytes of a text that is little evidence.
SHORT = 64
#: A document is of good quality if its score is at least this.
THRESHOLD = 0.7


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float
    short: float
    offset: float

    @property
    def fitted(self) -> bool:
        """Whether there were labels of both kinds; otherwise every score is 0.5."""
        return bool(self.slope or self.short or self.offset)

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        return [_compressor(x) for x in (self.good, self.bad)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    own = zstandard.ZstdCompressionDict(dictionary)
    own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_dict_id=False, write_checksum=False)


def difference(data: memoryview | bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    """Bytes that the bad dictionary needs beyond the good one's, by the text's bytes; the whole text counts.

    SHORT further bytes that say nothing are added to the text's own, as a few words are little evidence.
    """
    n = len(data)
    blocks = [data[i : i + BLOCK] for i in range(0, n, BLOCK)]
    return (sum(len(bad.compress(b)) for b in blocks) - sum(len(good.compress(b)) for b in blocks)) / (n + SHORT)


def _pieces(docs: DataFrame, y: int) -> list[bytes]:
    """One piece of each sampled text of label y, from a place that the id's hash gives, in a fixed order."""
    chars = F.greatest(F.length("text") - PIECE // 2, F.lit(1))
    piece = F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(7)), chars) + 1).cast("int"), F.lit(PIECE))
    rows = docs.where((F.col("y") == y) & (F.col("fold") > 0)).select(piece.alias("piece")).orderBy(F.xxhash64("doc_id"), "piece").limit(PIECES // PIECE)
    return [p for r in rows.collect() if (p := r.piece.encode()[:PIECE])]


def _dictionary(pieces: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too few pieces to train on: their text itself serves
        return b" ".join(pieces)[:DICTIONARY] or b" " * 8


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Two dictionaries and a logistic calibration from a bounded sample of labelled documents outside the held-out fold.

    Three of four sampled documents give the dictionaries' pieces; all others are compressed by tasks, and only their
    differences reach the driver for the calibration.  Without labels of both kinds every score is 0.5.
    """
    own = labelled_sample(docs, labels, "quality", 4, 2, sample).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4))).persist()
    try:
        good, bad = (_dictionary(_pieces(own, y)) for y in (1, 0))
        model = Model(good, bad, 0.0, 0.0, 0.0)
        told = _differences(own.where("fold = 0").select("y", "text"), model).select("y", "difference", _shortness().alias("short")).toPandas()
    finally:
        own.unpersist()
    y = told.y.to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        model.slope, model.short, model.offset = _logistic(told[["difference", "short"]].to_numpy(), y)
    return model


def _shortness() -> Column:
    return SHORT / (F.coalesce(F.octet_length("text"), F.lit(0)) + SHORT)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A factor for each column and an offset, by Newton's method with a little shrinkage."""
    scale = x.std(axis=0)
    scale[scale == 0] = 1
    x = np.column_stack([x / scale, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(b)), x.T @ (p - y) + 0.05 * b)
        b -= step
        if np.abs(step).max() < 1e-9:
            break
    return (b / np.append(scale, 1)).tolist()


def _differences(docs: DataFrame, model: Model, column: str = "difference") -> DataFrame:
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        good, bad = shared.value.compressors()
        for batch in batches:
            data, at = tokens.buffers(batch.column("text"))
            raw = memoryview(data)
            found = [difference(raw[at[i] : at[i + 1]], good, bad) for i in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, plus(docs, column, "double"))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """`docs` with each whole text's quality between 0 and 1 in `column`.

    Null and empty texts compress alike with both dictionaries and get the calibration's value of 0.  Rows are scored
    one by one; a column named like `column` is replaced, all others stay.
    """
    told = unused(docs, "_difference")
    own = _differences(docs.drop(column), model, told)
    return own.withColumn(column, 1 / (1 + F.exp(-(F.col(told) * model.slope + _shortness() * model.short + model.offset)))).drop(told)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
