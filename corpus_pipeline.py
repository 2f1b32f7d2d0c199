"""The training-text pipeline: five stages over documents, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns the rows it keeps with all columns of documents; the
last one returns the packed sequences. The operators are those of caseload.llm with their defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseload.llm.decontaminate import drop_contaminated
from caseload.llm.exact_dedup import drop_exact_copies
from caseload.llm.packing import pack
from caseload.llm.quality import drop_low_quality, trained
from caseload.llm.rows import read_table
from caseload.llm.simhash import drop_near_copies
from caseload.session import shared_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, trained(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs).drop("row_key")


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near),
    ("decontaminate", drop_benchmark),
    ("pack", pack_sequences),
]

#: A trained classifier, XXH64 fingerprints and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; what each one keeps lies in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
