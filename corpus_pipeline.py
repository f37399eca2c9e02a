"""The corpus pipeline: each stage is one of the training-data operators at its production settings.

A stage takes (spark, docs, sf_dir) and gives the documents that it keeps, with their columns, whatever else these hold; the last one
gives the documents of the mix and ``repeats``, how often each is read. Null and blank texts are not toxic, are one group of
exact copies, are linked with nothing, hold no benchmark item, and have no words to mix, so the mix leaves them out. A null id is a value
like any other. Repeated rows are exact copies, of which one stays. An empty table gives an empty one. Stages are written as Parquet and read again, so each starts from files and a lost executor costs one stage's tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontamination, exact_dedup, mixing, near_dedup, toxicity
from tidewater.llm.common import checkpoint_folder, table
from tidewater.llm.queries import learnable


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, learnable(table(spark, sf_dir, "labels"))))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, shingle=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_exact_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("source mix", mixed),
]

#: Compression distances, MinHash joins and latent retrieval have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
