"""A pipeline over documents: each stage is one operator of tapeloom.llm, and all but the last return documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import decontamination, near_dedup, packing, secret_scan, toxicity
from tapeloom.llm.common import discard, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose restored text scores 0.3 or more."""
    return toxicity.without_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least doc_id of each group. Rows without a doc_id stay; of a doc_id that repeats all rows stay if one is kept."""
    judged = near_dedup.near_duplicates(docs, width=5, percent=80)
    gone = judged.groupBy(F.col("doc_id").alias("_gone")).agg(F.bool_or("kept").alias("stays")).filter(~F.col("stays"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; every document stays."""
    return secret_scan.redacted(docs)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of the documents that are left."""
    return packing.pack(docs, packing.word_count(F.col("text")))


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", secret_scans),
    ("packing", length_packing),
]

#: The stages learn, hash and decode; SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read again; a stage's table is emptied once the next one is written.

    Defined results: null and empty texts pass all filters; rows without a doc_id stay; repeated rows stay together;
    an empty documents, labels or benchmark table removes nothing; other columns are kept whatever their names; texts of
    any length are read whole.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done: list[DataFrame] = []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        discard(*done)
        done = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
