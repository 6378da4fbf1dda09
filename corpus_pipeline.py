"""From raw documents to packed training sequences, one Spark job after another.

Every stage takes the documents that the stage before it kept, as rows of the ``documents``
table, and works on all of them: texts that the quality classifier or the rules reject are
dropped, one document of each group of near copies stays, and what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railctx.llm import jaccard_join, packing, quality_classifier, quality_rules
from railctx.llm.arrow import ship, written
from railctx.llm.queries import LEAST_QUALITY, held_out

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the compression classifier scores below the bar."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    classifier = quality_classifier.fit(docs, labels, ~held_out(F.col("doc_id")))
    return quality_classifier.keep(docs, classifier, LEAST_QUALITY)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base or that the rules find improbable."""
    return quality_rules.keep(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies keep the document with the smallest id."""
    ship(spark)
    return jaccard_join.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 token ids, none of which crosses documents."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("n-gram Jaccard join", drop_copies),
    ("packing", pack),
]

#: The classifier and the joint estimate of the rules cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each stage's result is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
