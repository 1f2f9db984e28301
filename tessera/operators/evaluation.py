"""Evaluation of generated queries (J1-J6): per-case rows, one-row report, rates, verdict.

Inputs are tables: test cases ``(case_id, description, ground_truth_query)``, model responses
``(case_id, raw_response[, generation_time])`` and result records/headers for the comparison.
All joins are equi-joins on ``case_id``; the report is one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as FC
from ..functions import responses as FR
from ..functions import similarity as FS
from . import result_compare as RC
from .positions import id_buckets, with_position


def evaluate(
    cases: DataFrame,
    responses: DataFrame,
    records: DataFrame | None = None,
    headers: DataFrame | None = None,
    validate_syntax: bool = True,
    similarity_threshold: float = FS.SIMILARITY_THRESHOLD,
    fuzzy_threshold: float = RC.FUZZY_THRESHOLD,
    weights: tuple[float, float, float] = FS.DEFAULT_WEIGHTS,
    numbered: bool = True,
) -> DataFrame:
    """One row per test case.

    Generation errors (``ERROR:`` responses or no response) get syntax_valid false, the error
    text and null scores. The built-in validator is the light syntax check (C3); with
    ``validate_syntax=False`` every generated query counts as valid but is not counted as
    validated (the reference's counters stay 0 in that mode). ``numbered=False`` skips the
    1-based ``test_case_number`` (null then), which aggregate-only reports do not need.
    """
    if numbered:
        at = with_position(cases.select("case_id"), ["case_id"], id_buckets("case_id"), name="__pos")
        numbered = cases.join(at, "case_id")
    else:
        numbered = cases.withColumn("__pos", F.lit(None).cast("long"))
    resp = responses
    if "generation_time" not in resp.columns:
        resp = resp.withColumn("generation_time", F.lit(0.0))
    j = numbered.join(resp.select("case_id", "raw_response", "generation_time"), "case_id", "left")
    extracted = FR.extract_query("raw_response")
    j = j.withColumn("__e", extracted)
    err = F.col("raw_response").isNull() | FR.is_generation_error("__e")
    j = j.withColumn("generation_failed", err).withColumn(
        "generated_query", F.when(~err, F.col("__e"))
    ).withColumn(
        "generation_error",
        F.when(F.col("raw_response").isNull(), F.lit("no response")).when(err, F.col("__e")),
    )
    # a missing response stands for an exception of the generating call
    failed = F.array(F.when(F.col("raw_response").isNull(), F.lit("Generation failed with exception"))
                     .otherwise(F.lit("Generation failed")))
    if validate_syntax:
        errs = FC.syntax_errors("generated_query")
        j = j.withColumn(
            "syntax_errors",
            F.when(err, failed).otherwise(errs),
        ).withColumn("syntax_valid", F.size("syntax_errors") == 0).withColumn("validated", ~err)
    else:
        j = j.withColumn(
            "syntax_errors", F.when(err, failed).otherwise(F.array().cast("array<string>"))
        ).withColumn("syntax_valid", ~err).withColumn("validated", F.lit(False))
    j = FS.similarity_columns(j, "generated_query", "ground_truth_query", weights)
    j = j.withColumn(
        "similarity_bucket",
        F.when(~err, FS.similarity_bucket("exact_match", "overall_score", similarity_threshold)),
    )
    for c in ("exact_match", "token_similarity", "structural_similarity", "overall_score"):
        j = j.withColumn(c, F.when(~err, F.col(c)))
    if records is not None and headers is not None:
        cmp = RC.compare(records, headers, fuzzy_threshold)
        cmp = cmp.select("case_id", *[F.col(c).alias("cmp_" + c) for c in cmp.columns if c != "case_id"])
        j = j.join(cmp, "case_id", "left")
        oc = F.when(~err, RC.outcome(F.col("syntax_valid"), "cmp_"))
        j = j.withColumn("comparison_outcome", oc)
        compared = F.col("comparison_outcome").isin("strict", "fuzzy", "mismatch")
        j = j.withColumn("result_comparison_score", F.when(compared, F.col("cmp_similarity_score")))
    return j.select(
        (F.col("__pos") + 1).alias("test_case_number"),
        "case_id", "description", "ground_truth_query", "raw_response", "generated_query",
        "generation_time", "generation_error", "syntax_valid", "validated", "syntax_errors",
        "exact_match", "token_similarity", "structural_similarity", "overall_score", "similarity_bucket",
        F.when(F.col("generation_error").isNull(), F.struct(
            "exact_match", "token_similarity", "structural_similarity", "overall_score", "normalized_generated",
            "normalized_truth", "tokens_generated", "tokens_truth", "structure_generated", "structure_truth",
        )).alias("similarity_evaluation"),
        *([c for c in j.columns if c.startswith("cmp_")] + ["comparison_outcome", "result_comparison_score"]
          if records is not None and headers is not None else []),
    )


def eval_report(cases: DataFrame) -> DataFrame:
    """One row of counters and averages over the evaluated cases."""
    ok = F.col("generation_error").isNull()
    has_cmp = "comparison_outcome" in cases.columns
    outc = F.col("comparison_outcome") if has_cmp else F.lit(None).cast("string")
    score = F.col("result_comparison_score") if has_cmp else F.lit(None).cast("double")
    return cases.agg(
        F.count(F.lit(1)).alias("total_test_cases"),
        F.count_if(ok).alias("successful_generations"),
        F.count_if(~ok).alias("generation_errors"),
        F.count_if(ok & F.col("validated") & F.col("syntax_valid")).alias("syntax_valid_queries"),
        F.count_if(ok & F.col("validated") & ~F.col("syntax_valid")).alias("syntax_invalid_queries"),
        F.count_if(F.col("similarity_bucket") == "exact").alias("exact_matches"),
        F.count_if(F.col("similarity_bucket") == "high").alias("high_similarity_count"),
        F.count_if(F.col("similarity_bucket") == "medium").alias("medium_similarity_count"),
        F.count_if(F.col("similarity_bucket") == "low").alias("low_similarity_count"),
        F.coalesce(F.avg(F.when(ok, F.col("overall_score"))), F.lit(0.0)).alias("average_similarity_score"),
        F.count_if(outc == "strict").alias("result_strict_matches"),
        F.count_if(outc == "fuzzy").alias("result_fuzzy_matches"),
        F.count_if(outc.isin("truth_failed", "gen_failed")).alias("result_comparison_failures"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("average_result_comparison_score"),
        F.sum("generation_time").alias("total_runtime"),
    )


def eval_rates(report: DataFrame) -> DataFrame:
    """Derived rates in percent (0.0 when the denominator is zero) and time per case."""
    t, s = F.col("total_test_cases"), F.col("successful_generations")
    return report.select(
        "*",
        F.coalesce(F.col("syntax_valid_queries") / F.when(s > 0, s) * 100.0, F.lit(0.0)).alias("syntax_success_rate"),
        F.coalesce((F.col("exact_matches") + F.col("high_similarity_count")) / F.when(t > 0, t) * 100.0, F.lit(0.0)).alias(
            "accuracy_rate"
        ),
        F.coalesce(
            (F.col("result_strict_matches") + F.col("result_fuzzy_matches")) / F.when(t > 0, t) * 100.0, F.lit(0.0)
        ).alias("result_accuracy_rate"),
        F.coalesce(F.col("total_runtime") / F.when(t > 0, t), F.lit(0.0)).alias("average_time_per_case"),
    )


def _round(c, digits: int):
    """Half away from zero on the binary value: identical in Spark and SQL engines."""
    scale = 10.0 ** digits
    return F.floor(F.col(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def with_run(report: DataFrame, timestamp: str, provider: str, model: str, validate_syntax: bool = True,
             similarity_threshold: float = FS.SIMILARITY_THRESHOLD, compared: bool = True,
             fuzzy_threshold: float = RC.FUZZY_THRESHOLD) -> DataFrame:
    """The run's metadata in front of a report row; the time is a parameter, never the clock."""
    return report.select(
        F.lit(timestamp).alias("evaluation_timestamp"), F.lit(provider).alias("llm_provider"), F.lit(model).alias("llm_model"),
        F.lit(validate_syntax).alias("syntax_validation_enabled"), F.lit(similarity_threshold).alias("similarity_threshold"),
        F.lit(compared).alias("result_comparison_enabled"), F.lit(fuzzy_threshold).alias("result_fuzzy_threshold"), "*")


RUN_FIELDS = ["evaluation_timestamp", "llm_provider", "llm_model", "syntax_validation_enabled", "similarity_threshold"]


def stats_summary(rates: DataFrame) -> DataFrame:
    """The summary record: percentages to 2 digits, scores to 4, times to 2, and the run's
    metadata where the report has it (``with_run``)."""
    keep = [
        "total_test_cases", "successful_generations", "generation_errors", "syntax_valid_queries",
        "syntax_invalid_queries", "exact_matches", "high_similarity_count", "medium_similarity_count",
        "low_similarity_count",
    ]
    return rates.select(
        *[c for c in RUN_FIELDS if c in rates.columns],
        *keep,
        _round("syntax_success_rate", 2).alias("syntax_success_rate_percent"),
        _round("accuracy_rate", 2).alias("accuracy_rate_percent"),
        _round("average_similarity_score", 4).alias("average_similarity_score"),
        _round("total_runtime", 2).alias("total_runtime_seconds"),
        _round("average_time_per_case", 2).alias("average_time_per_case_seconds"),
    )


def valid_export(cases: DataFrame, provider: str, model: str) -> DataFrame:
    """Cases with a non-empty generated query and valid syntax, tagged with the run source."""
    keep = F.col("generated_query").isNotNull() & (F.col("generated_query") != "") & F.col("syntax_valid")
    return cases.filter(keep).select(
        "case_id", "description", "generated_query", F.col("ground_truth_query"),
        F.coalesce(F.col("overall_score"), F.lit(0.0)).alias("similarity_score"),
        F.lit(f"eval_{provider}_{model}").alias("source"),
    )


def verdict(report: DataFrame) -> DataFrame:
    """Perfect / excellent / valid_mixed / summary, with the accuracy rate."""
    t = F.col("total_test_cases")
    exact_high = F.col("exact_matches") + F.col("high_similarity_count")
    clean = (F.col("generation_errors") == 0) & (F.col("syntax_valid_queries") == F.col("successful_generations"))
    v = (
        F.when(clean & (F.col("exact_matches") == t), F.lit("perfect"))
        .when(clean & (exact_high == t), F.lit("excellent"))
        .when(clean, F.lit("valid_mixed"))
        .otherwise(F.lit("summary"))
    )
    return report.select(v.alias("verdict"), (exact_high / F.greatest(t, F.lit(1)) * 100.0).alias("accuracy_rate"),
                         "average_similarity_score")
