"""A training-data pipeline: quality rules, quality classifier, exact dedup, near dedup,
packing. Each stage takes the documents that the stage before it kept, written as Parquet
and read again.

Defined results: null and empty texts fail the quality rules; repeated rows become one at
exact dedup; an empty table gives an empty result; extra columns of documents are carried
as they are. Every stage judges whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslab.llm import op1_quality, op3_exact, op7_pack, op8_quality, op10_neardup
from corpuslab.llm.common import saved, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_quality.passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_quality.good_documents(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_exact.distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_neardup.representatives(docs, width=5)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_pack.with_crc(op7_pack.pack(docs))


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("exact_dedup", exact_dedup),
          ("near_dedup", near_dedup), ("packing", packing)]

#: zstandard ratios, a trained model and a tokenizer: SQL can't express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return saved(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
