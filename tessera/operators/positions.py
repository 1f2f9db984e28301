"""Dense row positions without a global sort into one task.

The reference numbers rows by their place in a Python list. Here the order key is cut into nested
levels of buckets by monotone expressions. Rows are numbered inside the finest bucket by a window
partitioned on it; the counts of each level give every bucket its offset within its parent, by
windows partitioned on the parent. Only the coarsest level has an unpartitioned window.

Integer ids are cut by radix: 2^20 ids in the finest bucket and at most 2^11 buckets below each
parent, whatever the spread of the ids over 64 bits. So no task sees more than 2^20 rows or 2^11
bucket counts of a parent, for dense and for sparse ids alike.

Only narrow columns should be numbered; join the wide rows to the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits below each level's bucket, coarse to fine: 64 bits in steps of 11, then 2^20 ids.
ID_SHIFTS = (53, 42, 31, 20)


def id_buckets(id_col: str) -> list[Column]:
    """Nested monotone buckets of a unique integer id, coarse to fine."""
    return [F.shiftright(F.col(id_col).cast("long"), k) for k in ID_SHIFTS]


def hash_bucket(hash_col: str, digits: int = 4) -> Column:
    """Monotone bucket for a hex hash column: its first ``digits`` hex digits.

    Four digits give 65,536 buckets: about 15M (small) rows per window partition at 10^12 rows,
    which sorts with spill, and a per-bucket count table of at most 65,536 rows.
    """
    return F.substring(F.col(hash_col), 1, digits)


def with_position(
    df: DataFrame,
    order: Sequence[str],
    buckets: Column | Sequence[Column],
    name: str = "pos",
    group: Sequence[str] = (),
) -> DataFrame:
    """Add ``name``: the 0-based rank of each row by ``order`` (within ``group`` if given).

    ``order`` must be unique (within the group) and each bucket monotone in ``order``, coarse to
    fine.
    """
    group, order = list(group), list(order)
    buckets = [buckets] if isinstance(buckets, Column) else list(buckets)
    levels = [f"__b{i}" for i in range(len(buckets))]
    keyed = df.withColumns(dict(zip(levels, buckets)))
    counts = keyed.groupBy(*group, *levels).agg(F.count(F.lit(1)).alias("__n"))
    offsets = None
    for i in range(len(levels)):
        parent, own = levels[:i], levels[i]
        at = counts.groupBy(*group, *parent, own).agg(F.sum("__n").alias("__n")) if i + 1 < len(levels) else counts
        run = Window.partitionBy(*group, *parent).orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
        at = at.select(*group, *parent, own, F.coalesce(F.sum("__n").over(run), F.lit(0)).alias("__o"))
        if offsets is not None:
            at = (at.join(offsets, [*group, *parent])
                  .withColumn("__o", F.col("__o") + F.col("__off")).drop("__off"))
        offsets = at.withColumnRenamed("__o", "__off")
    within = Window.partitionBy(*group, *levels).orderBy(*order)
    numbered = keyed.withColumn("__rn", F.row_number().over(within))
    return (
        numbered.join(offsets, [*group, *levels])
        .withColumn(name, (F.col("__off") + F.col("__rn") - 1).cast("long"))
        .drop(*levels, "__rn", "__off")
    )


def rank_in_groups(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "pos") -> DataFrame:
    """Add ``name``: the 0-based place of each row within its group, by ``order``; rows are written once.

    Rows are range-partitioned by group and order together, so a group of any size is spread over
    tasks; only the counts of (group, partition) meet in a window, one row per partition a group
    lies in. Rows of equal order are numbered in any order.
    """
    from ..plans.session import checkpointed

    group, order = list(group), list(order)
    placed = checkpointed(df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
                          .withColumn("__id", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__id", 33))
    parts = placed.groupBy(*group, "__part").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    run = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__before", F.coalesce(F.sum("__n").over(run), F.lit(0))).drop("__n")
    return (placed.join(parts, [*group, "__part"])
            .withColumn(name, F.col("__id") - F.col("__first") + F.col("__before"))
            .drop("__id", "__part", "__first", "__before"))
