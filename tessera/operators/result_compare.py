"""Result-set comparison.

Results arrive as a long table ``(case_id, side, record)`` with ``side`` in {truth, generated}
and ``record`` a canonical JSON text (I2), plus one header row per (case, side) with the run's
success flag, error and raw record count. Comparison is two partial-then-final aggregations —
by (case, record hash), then by case — and no join of records, so a case with a third of all
records is still spread over record hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FUZZY_THRESHOLD = 0.8
TRUTH, GENERATED = "truth", "generated"


# ---------------------------------------------------------------- I1 graph values
def node_record(labels: Column, properties: Column) -> Column:
    """A node as a tagged record (identity is not kept)."""
    return F.struct(F.lit("node").alias("type"), labels.alias("labels"), properties.alias("properties"))


def rel_record(rel_type: Column, properties: Column) -> Column:
    """A relationship as a tagged record (endpoints are not kept)."""
    return F.struct(F.lit("relationship").alias("type"), rel_type.alias("rel_type"), properties.alias("properties"))


def path_record(nodes: Column, relationships: Column) -> Column:
    """A path: its length (relationship count), node records and relationship records."""
    return F.struct(
        F.lit("path").alias("type"),
        F.size(relationships).alias("length"),
        nodes.alias("nodes"),
        relationships.alias("relationships"),
    )


# ---------------------------------------------------------------- I2 canonical records
_SCALARS = (T.StringType, T.NumericType, T.BooleanType)


def _canon(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.StructType):
        fields = sorted(dt.fields, key=lambda f: f.name)
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(*[_canon(c[f.name], f.dataType).alias(f.name) for f in fields])
        )
    if isinstance(dt, T.MapType):
        # sorted by key alone: values may be of types that have no order
        by_key = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
        entries = F.array_sort(F.map_entries(c), by_key)
        entries = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), _canon(e["value"], dt.valueType).alias("value")))
        return F.map_from_entries(entries)
    if isinstance(dt, T.ArrayType):
        et = dt.elementType
        if isinstance(et, _SCALARS):
            # sorted only when every item is a scalar: a null item leaves the order untouched
            return F.when(F.exists(c, lambda x: x.isNull()), c).otherwise(F.sort_array(c))
        if isinstance(et, (T.StructType, T.MapType)):
            return F.transform(c, lambda x: _canon(x, et))
        return c
    return c


def canonical_record(df: DataFrame, cols: list[str] | None = None, name: str = "record") -> DataFrame:
    """Add ``name``: JSON of the chosen columns with keys sorted at every level, lists of
    scalars sorted, nulls written out (``1`` and ``1.0`` stay different)."""
    cols = cols or df.columns
    schema = df.select(*cols).schema
    rec = F.struct(*[_canon(F.col(f.name), f.dataType).alias(f.name) for f in sorted(schema.fields, key=lambda f: f.name)])
    return df.withColumn(name, F.to_json(rec, {"ignoreNullFields": "false"}))


# ---------------------------------------------------------------- I3/I4 comparison
def _per_record(records: DataFrame) -> DataFrame:
    """One row per case and record; the hash is moved as 16 bytes and sides are told by their counts."""
    is_t = F.col("side") == TRUTH
    is_g = F.col("side") == GENERATED
    return (
        records.withColumn("rh", F.unhex(F.md5(F.col("record"))))
        .groupBy("case_id", "rh")
        .agg(
            F.count_if(is_t).alias("n_t"),
            F.count_if(is_g).alias("n_g"),
            F.min("record").alias("record"),
        )
        .withColumns({"in_t": F.col("n_t") > 0, "in_g": F.col("n_g") > 0})
    )


def header_pivot(headers: DataFrame) -> DataFrame:
    """One row per case with both sides' success, error and raw record count."""
    t, g = F.col("side") == TRUTH, F.col("side") == GENERATED
    return headers.groupBy("case_id").agg(
        F.max(F.when(t, F.col("success"))).alias("truth_success"),
        F.max(F.when(t, F.col("error"))).alias("truth_error"),
        F.max(F.when(t, F.col("record_count"))).alias("truth_record_count"),
        F.max(F.when(g, F.col("success"))).alias("generated_success"),
        F.max(F.when(g, F.col("error"))).alias("generated_error"),
        F.max(F.when(g, F.col("record_count"))).alias("generated_record_count"),
    )


def compare(records: DataFrame, headers: DataFrame, threshold: float = FUZZY_THRESHOLD) -> DataFrame:
    """One row per case (from ``headers``) with the reference's comparison fields.

    Set semantics for common/missing/extra and the Jaccard score; raw counts keep multiplicity.
    Both sets empty -> score 1.0; truth empty only -> 0.0. If either side failed: no match,
    0 common, missing/extra = the raw counts, score 0, both errors kept.
    """
    per = _per_record(records)
    agg = per.groupBy("case_id").agg(
        F.sum("n_t").alias("raw_t"),
        F.sum("n_g").alias("raw_g"),
        F.count_if(F.col("in_t") & F.col("in_g")).alias("common"),
        F.count_if(F.col("in_t") & ~F.col("in_g")).alias("missing"),
        F.count_if(~F.col("in_t") & F.col("in_g")).alias("extra"),
        F.count_if(F.col("in_t")).alias("set_t"),
        F.count_if(F.col("in_g")).alias("set_g"),
    )
    h = header_pivot(headers)
    j = h.join(agg, "case_id", "left").fillna(0, ["raw_t", "raw_g", "common", "missing", "extra", "set_t", "set_g"])
    failed = ~F.coalesce(F.col("truth_success"), F.lit(False)) | ~F.coalesce(F.col("generated_success"), F.lit(False))
    union = F.col("set_t") + F.col("set_g") - F.col("common")
    score = (
        F.when((F.col("set_t") == 0) & (F.col("set_g") == 0), F.lit(1.0))
        .when(F.col("set_t") == 0, F.lit(0.0))
        .otherwise(F.col("common") / union)
    )
    t_count = F.coalesce(F.col("truth_record_count"), F.lit(0)).cast("long")
    g_count = F.coalesce(F.col("generated_record_count"), F.lit(0)).cast("long")
    return j.select(
        "case_id",
        F.when(failed, F.lit(False)).otherwise(
            (F.col("set_t") == F.col("set_g")) & (F.col("set_g") == F.col("common"))
        ).alias("strict_match"),
        F.when(failed, F.lit(False)).otherwise(score >= F.lit(threshold)).alias("fuzzy_match"),
        F.when(failed, t_count).otherwise(F.col("raw_t")).cast("long").alias("ground_truth_count"),
        F.when(failed, g_count).otherwise(F.col("raw_g")).cast("long").alias("generated_count"),
        F.when(failed, F.lit(0)).otherwise(F.col("common")).cast("long").alias("common_records"),
        F.when(failed, t_count).otherwise(F.col("missing")).cast("long").alias("missing_records"),
        F.when(failed, g_count).otherwise(F.col("extra")).cast("long").alias("extra_records"),
        F.when(failed, F.lit(0.0)).otherwise(score).alias("similarity_score"),
        failed.alias("either_failed"),
        F.when(failed, F.col("truth_error")).alias("ground_truth_error"),
        F.when(failed, F.col("generated_error")).alias("generated_error"),
        "truth_success", "generated_success",
        t_count.alias("truth_record_count"), g_count.alias("generated_record_count"),
    )


# ---------------------------------------------------------------- I5 samples
def compare_samples(records: DataFrame, k: int = 3) -> DataFrame:
    """Up to k records per case for each of truth, generated, common, missing, extra.

    Raw samples keep duplicates; set samples are distinct records. Order is by record text
    (the reference's set order is arbitrary). ``row_number <= k`` is planned as a
    window-group-limit, so each map task forwards at most k rows per group.
    """
    raw = records.select("case_id", F.col("side").alias("class"), "record")
    per = _per_record(records)
    cls = (
        F.when(F.col("in_t") & F.col("in_g"), "common")
        .when(F.col("in_t"), "missing")
        .otherwise("extra")
    )
    sets = per.select("case_id", cls.alias("class"), "record")
    both = raw.unionByName(sets)
    w = Window.partitionBy("case_id", "class").orderBy("record")
    return both.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- I6 outcome
OUTCOMES = ["skipped_syntax", "truth_failed", "truth_empty", "gen_failed", "gen_empty", "strict", "fuzzy", "mismatch"]


def outcome(syntax_valid: Column, cmp_prefix: str = "") -> Column:
    """The evaluation's comparison outcome for a case, in the reference's decision order."""
    p = cmp_prefix
    return (
        F.when(~syntax_valid, F.lit("skipped_syntax"))
        .when(~F.coalesce(F.col(p + "truth_success"), F.lit(False)), F.lit("truth_failed"))
        .when(F.col(p + "truth_record_count") == 0, F.lit("truth_empty"))
        .when(~F.coalesce(F.col(p + "generated_success"), F.lit(False)), F.lit("gen_failed"))
        .when(F.col(p + "generated_record_count") == 0, F.lit("gen_empty"))
        .when(F.col(p + "strict_match"), F.lit("strict"))
        .when(F.col(p + "fuzzy_match"), F.lit("fuzzy"))
        .otherwise(F.lit("mismatch"))
    )


def path_records(walks: DataFrame, nodes: DataFrame) -> DataFrame:
    """I1 for whole paths: ``walks(start, end, walk)`` of ``graph_match.shortest_walks`` ->
    ``(start, end, path_value)``, one record per path.

    The walk carries its relationships, so only the node records are joined (an equi-join on
    ids: hub nodes are split by AQE skew handling). Steps are put together again by the path's
    own hash, so paths of one (start, end) stay apart and a group holds one path's nodes.
    """
    paths = walks.select("start", "end", F.md5(F.to_json(F.struct("start", "walk"))).alias("pid"), "walk")
    nrec = nodes.select(F.col("id").alias("node"), node_record(F.col("labels"), F.col("props")).alias("rec"))
    steps = paths.select("start", "end", "pid", F.posexplode("walk").alias("pos", "step"))
    rel = F.when(F.col("pos") > 0, rel_record(F.col("step.rel.type"), F.map_from_entries("step.rel.props")))
    steps = steps.select("start", "end", "pid", "pos", F.col("step.node").alias("node"), rel.alias("rel"))
    by_pos = lambda a, b: F.when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0)
    whole = steps.join(nrec, "node").groupBy("start", "end", "pid").agg(
        F.array_sort(F.collect_list(F.struct("pos", "rec", "rel")), by_pos).alias("s"))
    rels = F.transform(F.slice("s", 2, F.size("s") - 1), lambda x: x["rel"])
    return whole.select("start", "end", path_record(F.transform("s", lambda x: x["rec"]), rels).alias("path_value"))
