"""The corpus pipeline: documents to shards, one operator a stage.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns the columns of documents; the last returns the shard
assignment. ``run`` writes each stage as Parquet in the shared folder and reads
it back, so a lost executor repeats tasks of one stage only; the folder goes
when the result is stored. Null, empty and
very long texts, repeated rows and extra columns are handled as the operators
say; empty tables pass through every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from eventide.llm.decontaminate import clean_rows
from eventide.llm.mixing import OTHER_WEIGHT, WEIGHTS, mixed_rows
from eventide.llm.neardup import without_copies
from eventide.llm.rules import passing_rows
from eventide.llm.shared import kept, lean, remove_folder, shared_dir
from eventide.llm.sharding import sharded

SHARDS = 24


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the adaptive thresholds of their language and source."""
    lean(spark)
    return passing_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    lean(spark)
    return without_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    lean(spark)
    return clean_rows(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the Pfair schedule of their sources."""
    return mixed_rows(docs, WEIGHTS, OTHER_WEIGHT)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document; a shard's slots follow the order that
    the documents are stored in, which is the mixture's."""
    return sharded(docs, [1.0] * SHARDS, stored_order=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{shared_dir(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    result = kept(STAGES[-1][1](spark, docs, sf_dir))  # a few numbers a document
    remove_folder(spark, folder)
    return result


#: The thresholds come from quantile sketches, and tiling is iterative: no SQL.
ORACLE_SQL = None
