"""A training corpus from raw documents, stage by stage.

Each stage takes what its predecessor kept, written as Parquet and read again, and works on all
of it: quality classifier, line dedup, SimHash near-dedup, mixing, packing.  All but the last
return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlog.llm import lines, mixing, packing, quality, simhash
from recordlog.llm.common import store
from recordlog.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (a score of 0.7 or more)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.accepted(docs, labels)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches; n_chars follows the text."""
    return lines.dedup(docs, short=True).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: shingles of 3 words, 2 bits."""
    return simhash.dedup(docs, words=3, bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes; a document that stands twice has its pieces twice."""
    return packing.pack_documents(docs, tokenizer_path()).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc32").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [("quality classifier", keep_quality), ("line dedup", drop_lines), ("simhash near-dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack)]

#: The classifier's boosting and the token vocabulary have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
