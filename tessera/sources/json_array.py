"""Entries of JSON array files, each file read by many tasks.

A file is read as pieces that end at a comma, so Spark splits it by bytes wherever its commas are,
on one line or on many. What a piece does to the parser's state does not need the state before it: it
has a number of quotes and, for either answer to "does it begin inside a string", a change of
depth. Running sums of quotes, then of depths, give the state before each piece; a comma outside
strings at depth 1 ends an entry, and the running number of such commas is the entry's index. Sums
run inside a split (a bounded number of bytes) and over the totals of the splits, so no task sees a
whole file. An entry is put together from its own pieces only.

A backslash and the character after it are left out before quotes are counted; no piece begins after
a lone backslash, since JSON has no escaped comma. Files whose text is not one array stop the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLANK = " \t\r\n﻿"
_SPLIT = ["file", "split"]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, at, piece): at is the order within a split; split its first byte."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", ",").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"))


def _depth(tokens: Column, inside: int) -> Column:
    """(change, turns): change of depth over every second token, and whether a bracket opens right after one
    that closes, which no JSON has without a comma."""
    only = F.regexp_replace(F.array_join(F.filter(tokens, lambda t, i: i % 2 == inside), ""), r"[^\[\]{}]", "")
    change = (2 * F.length(F.regexp_replace(only, r"[\]}]", "")) - F.length(only)).cast("long")
    return F.struct(change.alias("change"), only.rlike(r"[\]}][\[{]").alias("turns"))


def _running(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all earlier pieces of the file."""
    before = lambda key, order: Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    total = rows.groupBy(*_SPLIT).agg(F.sum(value).alias("total"))
    total = total.select(*_SPLIT, F.coalesce(F.sum("total").over(before(["file"], "split")), F.lit(0)).alias("offset"))
    within = rows.withColumn("own", F.coalesce(F.sum(value).over(before(_SPLIT, "at")), F.lit(0)))
    return within.join(total, _SPLIT).withColumn(name, F.col("own") + F.col("offset")).drop("own", "offset")


def array_entries(spark: SparkSession, path: str) -> DataFrame:
    """(id, entry): the index and the text of each entry of the array file(s) at ``path``."""
    from ..plans.session import checkpointed

    plain = F.regexp_replace("piece", r"(?s)\\.", "")
    tokens = F.split(plain, '"', -1)
    outside, inside = _depth(F.col("tokens"), 0), _depth(F.col("tokens"), 1)
    pieces = checkpointed(_pieces(spark, path))
    # a file of no bytes gives no piece that could tell
    if pieces.select("file").distinct().count() < len(spark.read.text(path).inputFiles()):
        raise ValueError("The corpus file is not a JSON array")
    state = (pieces.select(*_SPLIT, "at", tokens.alias("tokens"))
             .select(*_SPLIT, "at", (F.size("tokens") - 1).cast("long").alias("quotes"), outside.alias("outside"), inside.alias("inside")))
    # narrow rows from here on; the texts join them at the end
    state = checkpointed(_running(state, "quotes", "before").select(
        *_SPLIT, "at", F.when(F.col("before") % 2 == 0, F.col("outside")).otherwise(F.col("inside")).alias("state"),
        ((F.col("before") + F.col("quotes")) % 2 == 0).alias("plain")).select(*_SPLIT, "at", "state.change", "state.turns", "plain"))
    depth = _running(state, "change", "before").withColumn("depth", F.col("before") + F.col("change"))
    depth = depth.withColumn("ends", (F.col("plain") & (F.col("depth") == 1)).cast("long"))
    placed = checkpointed(_running(depth.select(*_SPLIT, "at", "before", "depth", "plain", "turns", "ends"), "ends", "id"))
    last = placed.groupBy("file").agg(
        F.max_by(F.struct("split", "at", "depth", "plain"), F.struct("split", "at")).alias("end"),
        F.min_by(F.struct("split", "at"), F.struct("split", "at")).alias("begin"),
        # within the array the depth is 1 or more after every piece but the last
        F.count_if(F.col("plain") & (F.col("depth") < 1)).alias("closed"), F.count_if((F.col("depth") < 0) | F.col("turns")).alias("below"))
    here = F.struct("split", "at")
    whole = placed.join(last, "file").join(pieces, [*_SPLIT, "at"])
    text = F.trim("piece", F.lit(_BLANK))
    first, final = here == F.col("begin"), here == F.struct("end.split", "end.at")
    bad = (first & ~text.startswith("[")) | (final & ~text.endswith("]")) | (final & ((F.col("end.depth") != 0) | ~F.col("end.plain")))
    bad = bad | (F.col("closed") != 1) | (F.col("below") > 0)
    said = F.raise_error(F.lit("The corpus file is not a JSON array")).cast("boolean")
    whole = whole.filter(F.when(bad, said).otherwise(F.lit(True)))
    opened = F.when(first, F.regexp_replace("piece", rf"\A[{_BLANK}]*\[", "")).otherwise(F.col("piece"))
    own = whole.select("file", "id", "split", "at", F.when(final, F.regexp_replace(opened, rf"\][{_BLANK}]*\z", "")).otherwise(opened).alias("piece"))
    entries = own.groupBy("file", "id").agg(F.sort_array(F.collect_list(F.struct("split", "at", "piece"))).alias("p"))
    entries = entries.select("file", "id", F.array_join(F.transform("p", lambda x: x["piece"]), ",").alias("entry"))
    # an array without entries has one blank entry; any other blank entry is left for the reader to refuse
    sizes = placed.groupBy("file").agg(F.max("id").alias("last_id"))
    return entries.join(sizes, "file").filter(~((F.col("last_id") == 0) & (F.trim("entry", F.lit(_BLANK)) == ""))).select(
        F.col("id").cast("long").alias("id"), "entry")
