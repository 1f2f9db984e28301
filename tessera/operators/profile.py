"""Corpus profile aggregations (E1-E7). Every one is a partial-then-final hash aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corpus_totals(df: DataFrame) -> DataFrame:
    """Entry count and average lengths (NULL averages on an empty corpus)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_entries"),
        F.avg("query_length").alias("avg_query_length"),
        F.avg("description_length").alias("avg_description_length"),
    )


def frequency(df: DataFrame, col: str, pct: bool = False, missing: str | None = None) -> DataFrame:
    """Rows per value; with ``pct`` the share of all rows in percent.

    The total is summed from the per-value counts (one row, broadcast by construction), so the
    input is scanned once.
    """
    c = F.coalesce(F.col(col), F.lit(missing)) if missing is not None else F.col(col)
    counts = df.groupBy(c.alias(col)).agg(F.count(F.lit(1)).alias("count"))
    if not pct:
        return counts
    total = counts.agg(F.sum("count").alias("__total"))  # from the counts: no second scan
    return counts.crossJoin(F.broadcast(total)).select(
        col, "count", (F.col("count") / F.col("__total") * 100.0).alias("percentage")
    )


def frequency_exploded(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Rows per list element (each list exploded)."""
    name = name or col
    return df.select(F.explode(col).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("count"))


def top_k(df: DataFrame, col: str, k: int = 10, order_col: str = "id") -> DataFrame:
    """The k most frequent values; ties broken by first appearance (lowest ``order_col``).

    One aggregate, then a top-k (TakeOrderedAndProject keeps k rows per partition).
    """
    agg = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"), F.min(order_col).alias("first_seen"))
    top = agg.orderBy(F.desc("count"), F.asc("first_seen")).limit(k)
    return top.select(col, "count", "first_seen")


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values."""
    return df.agg(F.count_distinct(col).alias(f"unique_{col}"))
