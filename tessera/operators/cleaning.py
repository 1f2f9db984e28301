"""Corpus cleaning pass (B1, B9-B11): one projection, two outputs sharing the same plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions.text import is_blank

REQUIRED_FIELDS = ["description", "query", "source"]


def missing_field(fields: Sequence[str] = REQUIRED_FIELDS):
    """B1: message for the first missing (null) field, in field order; null when none is missing."""
    return F.coalesce(
        *[F.when(F.col(f).isNull(), F.lit(f"Missing required field: {f}")) for f in fields]
    )


def annotate(df: DataFrame, id_col: str = "id") -> DataFrame:
    """B9 core: every input row with its cleaned columns, ``kept`` flag and ``issues`` list."""
    drop_issue = F.coalesce(
        missing_field(),
        F.when(is_blank("description"), F.lit("Empty description")),
        F.when(is_blank("query"), F.lit("Empty query")),
    )
    q = C.clean_query("query")
    return (
        df.select(
            F.col(id_col).cast("long").alias("id"),
            F.col("description").alias("raw_description"),
            F.col("query").alias("raw_query"),
            F.col("source").alias("raw_source"),
            drop_issue.alias("__drop"),
        )
        .withColumn("kept", F.col("__drop").isNull())
        .withColumn("query", F.when(F.col("kept"), C.clean_query("raw_query")))
        .withColumn("description", F.when(F.col("kept"), C.clean_description("raw_description")))
        .withColumn("source", F.when(F.col("kept"), C.clean_source("raw_source")))
        .withColumn(
            "issues",
            F.when(
                F.col("kept"),
                F.transform(C.syntax_errors("query"), lambda e: F.concat(F.lit("Syntax error: "), e)),
            ).otherwise(F.array(F.col("__drop"))),
        )
        .drop("__drop")
    )


def cleaned(annotated: DataFrame) -> DataFrame:
    """B9 output: the kept rows with metadata columns; ``id`` is the original index."""
    return annotated.filter("kept").select(
        "description",
        "query",
        "source",
        "id",
        C.text_length("query").alias("query_length"),
        C.text_length("description").alias("description_length"),
        C.complexity_score("query").cast("long").alias("complexity_score"),
        C.query_type("query").alias("query_type"),
        C.entities("query").alias("entities"),
    )


def issues(annotated: DataFrame) -> DataFrame:
    """Rows with any issue: index, the raw entry and the issue list."""
    has_issue = ~F.col("kept") | ~C.syntax_ok("query")
    return annotated.filter(has_issue).select(
        F.col("id").alias("index"),
        F.struct(
            F.col("raw_description").alias("description"),
            F.col("raw_query").alias("query"),
            F.col("raw_source").alias("source"),
        ).alias("entry"),
        "issues",
    )


def clean_corpus(df: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, issue rows). Syntax issues are reported but do not drop the row."""
    a = annotate(df, id_col)
    return cleaned(a), issues(a)


def filter_sources(df: DataFrame, sources: Sequence[str] | DataFrame, col: str = "source") -> DataFrame:
    """Keep rows whose source is exactly one of ``sources``.

    A Python list becomes an ``isin`` filter (pushed to the scan); a DataFrame of allowed sources
    becomes a left-semi join, which Spark broadcasts only when its measured size allows.
    """
    if isinstance(sources, DataFrame):
        allowed = sources.select(F.col(sources.columns[0]).alias("__src")).distinct()
        return df.join(allowed, df[col] == allowed["__src"], "left_semi")
    return df.filter(F.col(col).isin(list(sources)))
