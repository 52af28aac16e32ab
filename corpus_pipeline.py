"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the one before it kept, written as Parquet, and all but the last return the
columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontamination, near_duplicates, packing, quality_rules
from ledgerloom.llm.common import Workspace, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, fit on labelled ones, predicts to be good."""
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.scored(docs, model).where("predicted = 1").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles, 80 % alike)."""
    return near_duplicates.without_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's passages, or with few of their words."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL can't express the model; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the last one's rows."""
    space = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = space.store(stage(spark, docs, sf_dir), name)
    return docs
