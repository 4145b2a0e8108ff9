"""The corpus pipeline: five stages over ``documents``, each one operator of ``tablesync.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all rows
its predecessor kept.  All but the last return the columns of ``documents``: rejected
documents are gone, dropped lines are cut from the texts, one document of each
near-duplicate group stays, and a document is there as often as the mix takes it.
The last returns where every token piece lies in the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.llm import line_dedup, mixing, packing, quality, simhash
from tablesync.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# Outlier estimates, SimHash components and best-fit packing are not SQL;
# tests/llm/test_pipeline.py holds run() against a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
