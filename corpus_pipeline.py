"""From raw documents to a training mix: five stages, each an operator of ``tessera.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
All but the last return the columns of ``documents``. ``run`` writes each stage's rows as Parquet
into the shared checkpoint folder and reads them back for the next stage, so a lost executor
costs at most one stage's tasks.

Nulls, empty texts, repeated rows and empty tables: see the operators. A document that loses all
its lines to line dedup goes on with an empty text, which is linked with nothing and takes no
share of the mix. ``n_chars`` follows the text where the table has that column.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, mixing, near_dedup, quality_lm
from tessera.llm.common import table
from tessera.plans.session import ensure_checkpoint_dir

# The quality model and the alignments cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model accepts."""
    return quality_lm.judge(docs, table(spark, sf_dir, "labels")).filter("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a similar line elsewhere stands for."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_dropped_lines") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("near_dedup", near), ("decontaminate", benchmark), ("mix", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
