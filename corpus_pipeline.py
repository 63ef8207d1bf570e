"""The corpus pipeline: quality, exact copies, near copies, source mix, packing. Each stage applies one operator
of docframe.llm to all rows that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docframe.llm import exact_dedup as exact
from docframe.llm import minhash, mixing, packing
from docframe.llm._io import cut, table
from docframe.llm.quality import QualityModel


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from labels, scores at 0.3 or more."""
    return QualityModel.fit(docs, table(spark, sf_dir, "labels")).keep(docs, 0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact.dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, likeness 0.8) the document with the smallest doc_id."""
    return minhash.near_dedup(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1 in turn, at most three repetitions: a repeated document is a repeated row, and every row
    is a whole document."""
    return mixing.mix_whole(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mix), ("packing", pack)]

#: A trained classifier and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
