"""Execution-run reporting (K1-K5) over a run log ``(run_id, description, query, status_code,
body, execution_time, validation_time)``: one row per submitted query and its HTTP response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as FC
from .positions import id_buckets, with_position

# --- fixed values that must equal the reference's -------------------------------------------
HTTP_ERRORS = {
    429: ("Rate limit exceeded (HTTP 429)", "Too many requests. Please wait and try again later."),
    401: ("Unauthorized (HTTP 401)", "Request not authorized. Check API token and permissions."),
    403: ("Forbidden (HTTP 403)", "Access to the resource is forbidden."),
    500: ("Internal Server Error (HTTP 500)", "The server encountered an internal error."),
}
NOT_FOUND_MESSAGE = "resource not found"
VALIDATION_TYPE = "pre_execution_syntax_check"
# ---------------------------------------------------------------------------------------------


def classify_response(df: DataFrame, status: str = "status_code", body: str = "body", query: str = "query") -> DataFrame:
    """K1: add ``error`` and ``details`` (null when absent) and ``ok`` for each response.

    Bodies are parsed once with ``try_parse_json`` (variant); key presence of ``errors`` is
    kept apart from ``errors: null``. The JSON parser's own message is not reproduced.
    """
    code = F.col(status)
    txt = F.col(body)
    v = F.try_parse_json(txt)
    df = df.withColumn("__v", v)
    has_errors = F.expr("try_variant_get(__v, '$.errors', 'variant')").isNotNull()
    msgs = F.expr("try_variant_get(__v, '$.errors', 'array<struct<message:string>>')")
    not_found = F.exists(F.coalesce(msgs, F.array().cast("array<struct<message:string>>")),
                         lambda e: e["message"] == F.lit(NOT_FOUND_MESSAGE))
    joined = F.array_join(F.transform(msgs, lambda e: F.concat(F.lit("'"), e["message"], F.lit("'"))), "\n")
    q = F.col(query)
    error = F.when(code == 429, F.lit(HTTP_ERRORS[429][0]))
    details = F.when(code == 429, F.lit(HTTP_ERRORS[429][1]))
    for c in (401, 403, 500):
        error = error.when(code == c, F.lit(HTTP_ERRORS[c][0]))
        details = details.when(code == c, F.lit(HTTP_ERRORS[c][1]))
    error = (
        error.when(code != 200, F.concat(F.lit("HTTP Error: "), code.cast("string")))
        .when(F.col("__v").isNull(), F.lit("JSONDecodeError"))
        .when(~has_errors, F.lit(None))
        .when(not_found, F.concat(F.lit("No matches found for query '"), q, F.lit("'")))
        .otherwise(F.concat(F.lit("Error in query '"), q, F.lit("'. Please fix and try again.")))
    )
    details = (
        details.when(code != 200, F.substring(txt, 1, 500))
        .when(F.col("__v").isNull(), F.concat(
            F.lit("Failed to parse API response as JSON. Status: "), code.cast("string"),
            F.lit(". Response text (first 200 chars): "), F.substring(txt, 1, 200)))
        .when(~has_errors | not_found, F.lit(None))
        .otherwise(joined)
    )
    empty = F.coalesce(
        F.size(F.expr("try_variant_get(__v, '$', 'map<string,variant>')")) == 0,
        F.size(F.expr("try_variant_get(__v, '$', 'array<variant>')")) == 0,
        F.lit(False),
    )
    return (
        df.withColumn("error", error)
        .withColumn("details", details)
        .withColumn("empty_result", F.col("error").isNull() & empty)
        .drop("__v")
    )


def run_status(classified: DataFrame, prevalidate: bool = True) -> DataFrame:
    """K2: syntax_failed / failed / success_no_data / success for each run.

    With pre-validation, a query failing the light syntax check is not executed. An error whose
    text contains ``404`` counts as a success without data (the reference's rule).
    """
    ok_syntax = FC.syntax_ok("query") if prevalidate else F.lit(True)
    status = (
        F.when(~ok_syntax, F.lit("syntax_failed"))
        .when(F.col("error").isNotNull() & F.col("error").contains("404"), F.lit("success_no_data"))
        .when(F.col("error").isNotNull(), F.lit("failed"))
        .when(F.col("empty_result"), F.lit("success_no_data"))
        .otherwise(F.lit("success"))
    )
    return classified.withColumn("syntax_checked", F.lit(prevalidate)).withColumn("syntax_ok", ok_syntax).withColumn(
        "run_status", status
    )


def run_statistics(runs: DataFrame) -> DataFrame:
    """K3: one row: totals by outcome and time statistics over executed runs.

    The validation average is null when no run was pre-validated."""
    executed = F.col("run_status") != "syntax_failed"
    t = F.when(executed, F.col("execution_time"))
    return runs.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.count_if(~executed).alias("syntax_failed"),
        F.count_if(executed).alias("executed"),
        F.count_if(F.col("run_status").isin("success", "success_no_data")).alias("successful"),
        F.count_if(F.col("run_status") == "failed").alias("failed"),
        F.avg(t).alias("avg_execution_time"),
        F.min(t).alias("min_execution_time"),
        F.max(t).alias("max_execution_time"),
        F.avg(F.when(F.col("syntax_checked"), F.col("validation_time"))).alias("avg_validation_time"),
    )


def _numbered(runs: DataFrame, which: Column, id_col: str) -> DataFrame:
    """Rows of ``which`` with ``__pos``, their place in the whole log: only ids are numbered."""
    at = with_position(runs.select(id_col), [id_col], id_buckets(id_col), name="__pos")
    return runs.filter(which).join(at, id_col)


def syntax_failed_runs(runs: DataFrame, id_col: str = "run_id") -> tuple[DataFrame, DataFrame]:
    """Queries that pre-validation kept from running, numbered as in the log, and a header row
    with the counts of all and of failed queries."""
    rows = _numbered(runs, F.col("run_status") == "syntax_failed", id_col).select(
        (F.col("__pos") + 1).alias("query_number"),
        F.col("description").alias("query_description"),
        F.col("query").alias("query_text"),
        FC.syntax_errors("query").alias("syntax_errors"),
        "validation_time",
    )
    header = runs.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.count_if(F.col("run_status") == "syntax_failed").alias("syntax_failed_count"),
    ).withColumn("validation_type", F.lit(VALIDATION_TYPE))
    return rows, header


def failed_runs(runs: DataFrame, id_col: str = "run_id") -> DataFrame:
    """K4: failed executions numbered by position in the run log (1-based)."""
    numbered = _numbered(runs, F.col("run_status") == "failed", id_col)
    msg = F.concat(
        F.lit("Error: "), F.col("error"),
        F.when(F.col("details").isNotNull(), F.concat(F.lit("\nDetails: "), F.col("details"))).otherwise(F.lit("")),
    )
    return numbered.select(
        (F.col("__pos") + 1).alias("query_number"),
        F.col("description").alias("query_description"),
        F.col("query").alias("query_text"),
        msg.alias("error_message"),
        "execution_time",
        F.when(F.col("syntax_checked") & F.col("syntax_ok"), F.lit("passed")).otherwise(F.lit("not_checked")).alias(
            "syntax_validation"
        ),
    )


def json_text(c: Column) -> Column:
    """A JSON text with one space after each comma and colon and none elsewhere between tokens,
    keys in their order: what a parse and a plain dump give. Numbers and escapes stay as written."""
    tokens = F.regexp_extract_all(c, F.lit(r'"(?:[^"\\]|\\.)*"|[^"\s,:]+|[,:]'), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.isin(",", ":"), F.concat(t, F.lit(" "))).otherwise(t)), "")


def preview(c, limit: int = 200) -> Column:
    """K5: the response, dumped as JSON, cut to ``limit`` characters plus ``...`` when longer."""
    c = json_text(F.col(c) if isinstance(c, str) else c)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("..."))).otherwise(c)
