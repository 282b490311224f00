"""The corpus pipeline: from documents to packed token sequences.

Each stage is a function of (spark, docs, sf_dir) that applies one operator of `platterflow.llm` to all
documents its predecessor kept. All but the last return the columns of documents. Between stages the
documents are written as Parquet to the shared folder and read again, so a stage that loses
executors is repeated from there.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from platterflow.llm import exact_dedup, packing, quality, simhash, substring_dedup
from platterflow.llm.common import prepared, table
from platterflow.session import shared_folder


def drop_rejected(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.without_rejected(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return substring_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", drop_rejected),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

# The scorer, the fingerprints, the chains and the packers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES: dict[str, str] = {}
