"""Mixing sources to target weights (operator 3): Efraimidis-Spirakis sampling.

Each document draws a fixed uniform number from its id; its key is ``-ln(u) / w`` with ``w`` the
document's quality weight, so a smaller key is more likely for a better document. Within a
source whole epochs come first; the rest of the budget is filled along ascending keys by a
running sum of words, and the document at the budget's edge gives its remaining words only.

The running sum never puts a source into one task: keys fall into equal slices of their
distribution, slices are summed by a partial aggregate, only the one slice per source that holds
the budget's edge is ordered, and a slice has about ``slice_rows`` rows at any table size.

Null texts have size 0 and weight as an empty text; a null source is a source of its own, sorted
last. Rows with equal doc_id share a draw; ties are ordered by doc_id, size and quality, so
reruns agree. An empty table gives no rows; a table without words gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words

WEIGHTS = (5, 2, 1)
TOTAL_SHARE, MAX_EPOCHS = 1.5, 2


def quality_weight(text: Column) -> Column:
    """Between 0 and 1: falls with the share of symbols among the text's characters."""
    t = F.coalesce(text, F.lit(""))
    share = F.regexp_count(t, F.lit(r"[#*$%&|<>!]")) / F.greatest(F.length(t), F.lit(1))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(10.0) * share)


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) fixed by the id: 48 bits of its MD5."""
    h = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10)
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(2 ** 48))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes(source, source_size)`` -> plus ``target``.

    Sources are weighted by rank; the budget is shared by weight, no source above
    ``MAX_EPOCHS`` times its size. Sharing the excess again until none is above leads to one
    level L: target = min(cap, L * weight). Sorted by cap / weight, L follows from running sums.
    One row per source, so the two unpartitioned windows run over the source list only.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(MAX_EPOCHS)))
    by = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    every = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("budget", F.sum("source_size").over(every) * F.lit(TOTAL_SHARE))
         .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))))
    # levels rise while sources are capped and fall from the first that is not: theirs is the greatest
    s = s.withColumn("l", F.max("level").over(every))
    return s.select("source", "source_size",
                    F.least("cap", F.col("l") * F.col("w")).alias("target"))


def mix(docs: DataFrame, slice_rows: int = 20_000) -> DataFrame:
    """``docs(doc_id, text, source)`` -> doc_id, source, size, source_size, target, key, taken."""
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                       (-F.log(uniform(F.col("doc_id"))) / quality_weight(F.col("text"))).alias("key"))
    n = rows.select("doc_id").count()
    slices = max(1, -(-n // slice_rows))
    rows = rows.withColumn("slice", F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.lit(slices)))
    part = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    goal = targets(part.groupBy("source").agg(F.sum("words").alias("source_size")))
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(F.lit(0)).cast("long"))
    goal = goal.withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("slice"))
    part = (part.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
            .withColumnRenamed("source", "s_"))
    part = part.join(goal, F.col("s_").eqNullSafe(F.col("source"))).drop("s_")
    # one row per source and slice: what a slice gives in whole, or that it holds the edge
    state = part.select(F.col("source").alias("s_"), F.col("slice").alias("l_"), "source_size", "target", "epochs",
                        (F.col("rest") - F.col("before")).alias("room"),
                        (F.col("upto") <= F.col("rest")).alias("whole"))
    at = rows.join(state, F.col("source").eqNullSafe(F.col("s_")) & (F.col("slice") == F.col("l_"))).drop("s_", "l_")
    edge = (~F.col("whole")) & (F.col("room") > 0)
    sure = at.filter(~edge).withColumn("more", F.when(F.col("whole"), F.col("size")).otherwise(F.lit(0).cast("long")))
    w = (Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size")
         .rowsBetween(Window.unboundedPreceding, -1))
    cut_ = (at.filter(edge)
            .withColumn("more", F.greatest(F.lit(0).cast("long"), F.least(
                F.col("size"), F.col("room") - F.coalesce(F.sum("size").over(w), F.lit(0)))).cast("long")))
    return (sure.unionByName(cut_)
            .select("doc_id", "source", "size", "source_size", "target", "key",
                    (F.col("size") * F.col("epochs") + F.col("more")).cast("long").alias("taken")))
