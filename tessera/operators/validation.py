"""Validation results, batches and summaries."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from .positions import id_buckets, with_position


def validation_result(offline_ok: Column, online_ok: Column, offline_errors: Column, online_errors: Column) -> Column:
    """C4: the reference's ValidationResult as a struct.

    ok = offline_ok AND online_ok is not false (null = online check skipped);
    errors = offline errors followed by online errors.
    """
    return F.struct(
        (offline_ok & F.coalesce(online_ok, F.lit(True))).alias("ok"),
        offline_ok.alias("offline_ok"),
        online_ok.alias("online_ok"),
        F.concat(F.coalesce(offline_errors, F.array().cast("array<string>")),
                 F.coalesce(online_errors, F.array().cast("array<string>"))).alias("errors"),
    )


def validate_batch(
    df: DataFrame,
    validator: Callable[[str], tuple[bool, list[str]]] | None = None,
    query_col: str = "query",
    id_col: str = "id",
) -> DataFrame:
    """Validate every row. Missing query -> ``''``; description default ``Query {id+1}``.

    The built-in validator is the light syntax check (C3), evaluated as Spark expressions.
    A user ``validator(query) -> (ok, errors)`` runs through ``mapInPandas`` in Arrow batches.
    """
    base = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col("description"), F.concat(F.lit("Query "), (F.col(id_col) + 1).cast("string"))).alias("description"),
        F.coalesce(F.col(query_col), F.lit("")).alias("query"),
    )
    if validator is None:
        errs = C.syntax_errors("query")
        return base.withColumn("errors", errs).withColumn("offline_ok", F.size("errors") == 0).withColumn(
            "online_ok", F.lit(None).cast("boolean")
        ).withColumn("ok", F.col("offline_ok"))

    def run(batches):
        for pdf in batches:
            res = [validator(q) for q in pdf["query"]]
            pdf = pdf.copy()
            pdf["offline_ok"] = [bool(r[0]) for r in res]
            pdf["errors"] = [list(r[1]) for r in res]
            pdf["online_ok"] = pd.Series([None] * len(pdf), dtype="object")
            pdf["ok"] = pdf["offline_ok"]
            yield pdf

    schema = "id long, description string, query string, errors array<string>, offline_ok boolean, online_ok boolean, ok boolean"
    return base.mapInPandas(run, schema=schema)


def validation_summary(results: DataFrame, time_col: str = "execution_time") -> DataFrame:
    """One row of counts and percentages; semantic percentage over *tested* rows, null when none."""
    total = F.count(F.lit(1))
    syntax_valid = F.count_if(F.col("offline_ok"))
    sem_valid = F.count_if(F.col("online_ok") == F.lit(True))
    sem_tested = F.count_if(F.col("online_ok").isNotNull())
    overall = F.count_if(F.col("ok"))
    agg = results.agg(
        total.alias("total"),
        syntax_valid.alias("syntax_valid"),
        sem_valid.alias("semantic_valid"),
        sem_tested.alias("semantic_tested"),
        overall.alias("overall_valid"),
        F.sum(time_col).alias("__time"),
    )
    pct = lambda num, den: F.when(F.col(den) > 0, F.col(num) / F.col(den) * 100.0)
    return agg.select(
        "total", "syntax_valid", "semantic_valid", "semantic_tested", "overall_valid",
        F.coalesce(pct("syntax_valid", "total"), F.lit(0.0)).alias("syntax_valid_pct"),
        pct("semantic_valid", "semantic_tested").alias("semantic_valid_pct"),
        F.coalesce(pct("overall_valid", "total"), F.lit(0.0)).alias("overall_valid_pct"),
        F.coalesce(F.col("__time") / F.when(F.col("total") > 0, F.col("total")), F.lit(0.0)).alias("avg_time"),
    )


def failure_report(validated: DataFrame, time_col: str = "execution_time") -> tuple[DataFrame, DataFrame]:
    """Failing rows numbered by position among the validated rows (1-based), and a header row.

    ``validated`` holds the rows after the loader filter (A4) with ``offline_ok`` and ``errors``.
    """
    at = with_position(validated.select("id"), ["id"], id_buckets("id"), name="__pos")
    rows = validated.filter(~F.col("offline_ok")).join(at, "id").select(
        (F.col("__pos") + 1).alias("query_number"),
        "description", "source", "query",
        F.col("errors").alias("syntax_errors"),
        F.col(time_col).alias("validation_time"),
    )
    header = validated.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.count_if(~F.col("offline_ok")).alias("failed_queries_count"),
    )
    return rows, header


def timing_stats(df: DataFrame, time_col: str = "execution_time") -> DataFrame:
    """Total time, rows per second, fastest and slowest."""
    return df.agg(
        F.sum(time_col).alias("total_runtime"),
        F.count(F.lit(1)).alias("n"),
        F.min(time_col).alias("fastest"),
        F.max(time_col).alias("slowest"),
    ).select(
        "total_runtime",
        (F.col("n") / F.when(F.col("total_runtime") > 0, F.col("total_runtime"))).alias("queries_per_second"),
        "fastest",
        "slowest",
    )


def gate(df: DataFrame, flag: str = "offline_ok") -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows routed to the failure set) by one flag; both share the plan."""
    return df.filter(F.col(flag)), df.filter(~F.col(flag) | F.col(flag).isNull())
