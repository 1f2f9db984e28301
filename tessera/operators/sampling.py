"""Seeded splits and samples.

Row order is the md5 of ``'{seed}:{id}'``: the same text in any engine, independent of
partitioning. To take the first n rows in that order exactly, rows are counted per bucket (leading
hex digits of the key); buckets below the cut go whole, and only the rows of the one bucket that
holds the cut are ranked. No other row is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def split_key(seed: int, id_col: str = "id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


# Hex digits of the key that name a bucket: 65,536 buckets.
BUCKET_DIGITS = 4


def _first_rows(keyed: DataFrame, id_col: str, group: list[str], wanted) -> DataFrame:
    """Add ``__in``: the row is among its group's first n by ``__key``.

    ``wanted(totals)`` turns one row per group with ``__size`` into one with ``__take`` (n). One
    row per group then holds the cut bucket and how many of its rows are taken.
    """
    b = F.substring("__key", 1, BUCKET_DIGITS)
    keyed = keyed.withColumn("__b", b)
    counts = keyed.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    take = wanted(counts.groupBy(*group).agg(F.sum("__n").alias("__size")))
    run = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counts.withColumn("__upto", F.sum("__n").over(run))
    names = [f"__g{i}" for i in range(len(group))]
    take = take.select(*[F.col(c).alias(n) for c, n in zip(group, names)], "__take")
    same = F.lit(True)
    for c, n in zip(group, names):
        same = same & F.col(c).eqNullSafe(F.col(n))
    # the cut bucket is the first that reaches n; before it, __upto - __n rows are taken
    cut = (upto.join(take, same).filter((F.col("__upto") >= F.col("__take")) & (F.col("__upto") - F.col("__n") < F.col("__take")))
           .select(*names, F.col("__b").alias("__cut"), (F.col("__take") - F.col("__upto") + F.col("__n")).alias("__more")))
    # a group of which nothing is taken has no cut bucket
    rows = keyed.join(cut if group else F.broadcast(cut), same, "left").drop(*names)
    sure = rows.filter(F.col("__cut").isNull() | (F.col("__b") != F.col("__cut"))).withColumn(
        "__in", F.coalesce(F.col("__b") < F.col("__cut"), F.lit(False)))
    rank = F.row_number().over(Window.partitionBy(*group, "__b").orderBy("__key", id_col))
    edge = rows.filter(F.col("__b") == F.col("__cut")).withColumn("__in", rank <= F.col("__more"))
    return sure.unionByName(edge).drop("__b", "__cut", "__more", "__key")


def train_test_split(
    df: DataFrame, train_ratio: float = 0.85, seed: int = 42, id_col: str = "id", stratify: str | None = None
) -> DataFrame:
    """add ``split`` (train/test). The test part has ceil(n * (1 - train_ratio)) rows.

    With ``stratify`` that total is shared among the strata: each gets the whole part of its
    share, and the rows left over go to the largest fractions (ties: lower stratum first).
    """
    if not 0 < train_ratio < 1:
        raise ValueError("train_ratio must be between 0 and 1")
    test_ratio = F.lit(1.0 - train_ratio)

    def wanted(totals: DataFrame) -> DataFrame:
        share = F.col("__size") * test_ratio
        if not stratify:
            return totals.withColumn("__take", F.ceil(share))
        every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        by_part = Window.orderBy((share - F.floor(share)).desc(), F.col(stratify).asc_nulls_first())
        t = totals.withColumn("__left", F.ceil(F.sum("__size").over(every) * test_ratio) - F.sum(F.floor(share)).over(every))
        more = F.when(F.row_number().over(by_part) <= F.col("__left"), 1).otherwise(0)
        return t.withColumn("__take", F.floor(share) + more)

    keyed = df.withColumn("__key", split_key(seed, id_col))
    rows = _first_rows(keyed, id_col, [stratify] if stratify else [], wanted)
    return rows.withColumn("split", F.when(F.col("__in"), "test").otherwise("train")).drop("__in")


def take_first(df: DataFrame, wanted, seed: int = 42, id_col: str = "id", flag: str = "chosen") -> DataFrame:
    """Add ``flag``: the row is among the first n in seeded order; ``wanted`` adds ``__take`` (n) to
    the one-row table that holds ``__size``."""
    keyed = df.withColumn("__key", split_key(seed, id_col))
    return _first_rows(keyed, id_col, [], wanted).withColumnRenamed("__in", flag)


def sample_n(df: DataFrame, n: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """the n rows first in seeded order; all rows when n >= size."""
    keyed = df.withColumn("__key", split_key(seed, id_col))
    take = lambda t: t.withColumn("__take", F.least(F.col("__size"), F.lit(n)))
    return _first_rows(keyed, id_col, [], take).filter("__in").drop("__in")


def split_shares(df: DataFrame, split_col: str = "split") -> DataFrame:
    """rows and percentage per split."""
    counts = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("__total"))  # from the counts: no second scan
    return counts.crossJoin(F.broadcast(total)).select(
        split_col, "rows", (F.col("rows") / F.col("__total") * 100.0).alias("percentage")
    )


def test_size(n: int, train_ratio: float) -> int:
    """Driver-side helper mirroring the split size rule (for tests)."""
    return math.ceil(n * (1.0 - train_ratio))
