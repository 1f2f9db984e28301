"""Duplicate detection and removal.

Groups are keyed by the md5 of a canonical text, so a long text never becomes a shuffle key.
Counts and minima aggregate partially before the shuffle (one row per partition per key, even
for a key that holds a third of all rows). Member rows are matched back to their group with an
equi-join; a hot key there is split by AQE's skew-join handling instead of landing in one task.
Group members are returned as rows, never collected into one list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical_ws
from .positions import id_buckets, with_position


def _keyed(df: DataFrame, key: Column, id_col: str, materialize: bool = True) -> DataFrame:
    """(dup_key, __id) for every row. With ``materialize`` the small projection is checkpointed
    into the shared checkpoint folder, so the text is read and canonicalised once even though
    group sizes and group members both read the keys."""
    k = df.select(F.md5(key).alias("dup_key"), F.col(id_col).alias("__id"))
    if not materialize:
        return k
    from ..plans.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return k.checkpoint(eager=True)


def find_duplicates(df: DataFrame, query_col: str = "query", id_col: str = "id", materialize: bool = True) -> DataFrame:
    """Members of every canonical-query group with more than one row: (dup_key, id, group_size).

    The canonical form collapses whitespace and keeps case (``' '.join(q.split())``).
    """
    k = _keyed(df, canonical_ws(query_col), id_col, materialize)
    groups = k.groupBy("dup_key").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    return k.join(groups, "dup_key").select("dup_key", F.col("__id").alias(id_col), "group_size")


def duplicate_report(df: DataFrame, query_col: str = "query", id_col: str = "id", materialize: bool = True) -> DataFrame:
    """Per duplicate group, the kept (lowest) index and one row per removed index."""
    k = _keyed(df, canonical_ws(query_col), id_col, materialize)
    groups = k.groupBy("dup_key").agg(F.min("__id").alias("keep_index"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return k.join(groups, "dup_key").filter(F.col("__id") != F.col("keep_index")).select(
        "dup_key", "keep_index", F.col("__id").alias("remove_index")
    )


def dedup(df: DataFrame, query_col: str = "query", id_col: str = "id") -> DataFrame:
    """D3: keep the lowest-index row of every canonical-query group (``id_col`` is unique).

    The least id per key is a hash aggregate over (key, id); the ids that go are removed from the
    wide rows by an anti-join, whose small side AQE picks at run time.
    """
    k = _keyed(df, canonical_ws(query_col), id_col, materialize=False)
    keep = k.groupBy("dup_key").agg(F.min("__id").alias("keep"))
    gone = k.join(keep, "dup_key").filter(F.col("__id") != F.col("keep")).select(F.col("__id").alias(id_col))
    return df.join(gone, id_col, "left_anti").select(df.columns)


def duplicate_pairs(cleaned: DataFrame, field: str = "query", id_col: str = "id", materialize: bool = True) -> DataFrame:
    """(first, duplicate) pairs on the md5 of the lower-cased field.

    Positions are places in the cleaned list (ordered by id); ids are returned too.
    kind is ``exact_query_match`` or ``exact_description_match``.
    """
    kind = f"exact_{field}_match"
    base = cleaned.select(id_col, F.md5(F.lower(F.col(field))).alias("h"))
    if materialize:  # positions and first-of-group both read it: compute the cleaned rows once
        from ..plans.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(cleaned.sparkSession)
        base = base.checkpoint(eager=True)
    # positions rise with ids: the first of a group is its least id, a hash aggregate
    first = base.groupBy("h").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = base.join(first, "h").filter(F.col(id_col) > F.col("first_id")).select("first_id", F.col(id_col).alias("dup_id"))
    at = with_position(base.select(id_col), [id_col], id_buckets(id_col), name="pos")
    return (
        pairs.join(at.select(F.col(id_col).alias("first_id"), F.col("pos").alias("first_pos")), "first_id")
        .join(at.select(F.col(id_col).alias("dup_id"), F.col("pos").alias("dup_pos")), "dup_id")
        .select("first_pos", "dup_pos", "first_id", "dup_id", F.lit(kind).alias("kind"))
    )
