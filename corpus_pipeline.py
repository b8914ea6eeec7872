"""A corpus pipeline over `documents`: quality, toxicity, near copies, benchmark contamination, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as the
next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyquill.llm import decontaminate, jaccard, mixing, quality, toxicity
from tallyquill.llm.common import shared_folder, table, tidied, unused


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good; it learns from those left that have labels.

    Without labels of both kinds nothing can be learnt, and all documents stay.  Null and empty texts are scored like
    others, repeated rows and ties alike; no documents give none.  Columns stay, whatever their names.
    """
    tidied(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "_score")
    return quality.score(docs, model, score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns) if model.fitted else docs


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject; where it learnt nothing, all stay.

    Null and empty texts are scored like others, repeated rows and ties alike; no documents give none.
    """
    tidied(spark)
    learnt = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "_score")
    return toxicity.score(docs, learnt, score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that shingle similarity links, the rows of the smallest id.

    Null and empty texts and null ids are in no group and stay; rows that repeat an id stay or go together.
    """
    tidied(spark)
    return jaccard.keep_one(docs, WORDS, PERCENT)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that benchmark passages contaminate; null and empty texts are clean, rows judged one by one."""
    tidied(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: the documents taken, with the number of copies, size, target and words taken; texts without words have size 0."""
    tidied(spark)
    return mixing.mix(docs)


#: Words of a shingle, and the least similarity of near copies in percent.
WORDS, PERCENT = 5, 80

STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", no_near_copies),
    ("decontamination", no_benchmark),
    ("mixture", mixed),
]

#: SQL can express neither classifier; tests hold the near copies and the contamination of a run against brute force, and
#: what the other stages keep against their own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each keeps is a table in the shared folder."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return kept
        kept.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
