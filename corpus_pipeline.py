"""From documents to a sharded training corpus, stage by stage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.llm.common import table
from barweave.llm.decontamination import decontaminate
from barweave.llm.mixing import draw_shards, measure, mix
from barweave.llm.near_join import keep_one
from barweave.llm.quality import judge_quality
from barweave.llm.sharding import assign_shards
from barweave.session import shared_folder

# Near copies of the stage: word shingles and percent of similarity.
SHINGLE, PERCENT = 5, 80
SHARDS = tuple(f"shard-{n:02d}" for n in range(16))


def _with_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` with ``clean_text`` as the text; a changed text is measured anew."""

    def column(name: str) -> Column:
        if name == "text":
            return F.col("clean_text").alias(name)
        if name == "n_chars":
            changed = ~F.col("clean_text").eqNullSafe(F.col("text"))
            size = F.length("clean_text").cast(docs.schema[name].dataType)
            return F.when(changed, size).otherwise(F.col(name)).alias(name)
        return F.col(name)

    return rows.select(*map(column, docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that too many of their source's texts share."""
    return _with_text(judge_quality(docs).where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return keep_one(docs, percent=PERCENT, shingle=SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with passages of the benchmark cut out of their texts."""
    return _with_text(decontaminate(docs, table(spark, sf_dir, "benchmark")), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return draw_shards(mix(measure(docs))).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    return assign_shards(docs, ["doc_id"], SHARDS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# The second stage has no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
