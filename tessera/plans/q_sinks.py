"""Registered queries for the writers (A6-A11): each writes under the session's shared
checkpoint folder and returns what a reader gets back, so the round trip is checked."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as OC
from ..operators import dedup as OD
from ..operators import evaluation as OE
from ..operators import profile as OP
from ..operators import runs as OR
from ..operators import sampling as OS
from ..sources import sinks as SK
from . import fixtures as X
from .q_cleaning import D_CLEANED, cleaned_corpus
from .q_eval import RUN_AT, _d_eval, _eval_cases
from .q_graph import _RUNS, _runs
from .q_profile import _d_pairs, _d_split
from .q_text import d_normalize, d_tokens
from .registry import d6, d_syntax, joined, r6, register
from .session import ensure_checkpoint_dir


def _out(spark: SparkSession, key: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "tessera-out", f"{key}-{uuid.uuid4().hex}")


_CLEAN_SEL = "SELECT id, description, query, source, query_length, description_length, complexity_score, query_type, entities FROM cleaned"


@register("write_corpus", "A", D_CLEANED + _CLEAN_SEL)
def q_write_corpus(spark, sf_dir):
    p = SK.write_corpus(cleaned_corpus(spark, sf_dir), _out(spark, "write_corpus"))
    return spark.read.parquet(p).withColumn("entities", joined("entities"))


def _flat(part: str, df, **cols):
    """Rows of one report part as (part, n, a, b, c): a number and up to three texts."""
    text = lambda c: (F.lit(None) if c is None else c).cast("string")
    return df.select(F.lit(part).alias("part"), cols["n"].cast("long").alias("n"), *[text(cols.get(c)).alias(c) for c in "abc"])


@register("write_validation_report", "A", _d_pairs("query").replace("\nSELECT CAST(f.first_pos", ", pairs AS (SELECT CAST(f.first_pos")
          + """)
, p2 AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos, md5(lower(description)) AS h FROM cleaned)
, pairs2 AS (SELECT p2.pos AS dup_pos, min(pos) OVER (PARTITION BY h) AS first_pos FROM p2)
SELECT 'issues' AS part, id AS n, array_to_string(issues, '|') AS a, raw_description AS b, raw_query AS c FROM e WHERE len(issues) > 0
UNION ALL SELECT 'duplicates', dup_pos, CAST(first_pos AS VARCHAR), kind, NULL FROM pairs
UNION ALL SELECT 'duplicates', CAST(dup_pos AS BIGINT), CAST(first_pos AS VARCHAR), 'exact_description_match', NULL FROM pairs2 WHERE dup_pos > first_pos
UNION ALL SELECT 'info', COUNT(*), CAST((SELECT COUNT(*) FROM e WHERE len(issues) > 0) AS VARCHAR), '1.0.0', '2024-01-31T00:00:00' FROM cleaned
UNION ALL SELECT 'types', COUNT(*), query_type, NULL, NULL FROM cleaned GROUP BY query_type""")
def q_write_report(spark, sf_dir):
    cleaned, issues = OC.clean_corpus(X.corpus(spark, sf_dir))
    pairs = OD.duplicate_pairs(cleaned, "query").unionByName(OD.duplicate_pairs(cleaned, "description"))
    info = cleaned.agg(F.count(F.lit(1)).alias("total_examples")).crossJoin(
        issues.agg(F.count(F.lit(1)).alias("validation_issues"))).withColumns(
        {"version": F.lit("1.0.0"), "created": F.lit(RUN_AT)})
    parts = SK.write_report({"dataset_info": info, "issues": issues, "duplicates": pairs,
                             "statistics": OP.frequency(cleaned, "query_type")}, _out(spark, "report"))
    back = {k: spark.read.json(p) for k, p in parts.items()}
    c = F.col
    return (_flat("issues", back["issues"], n=c("index"), a=joined("issues"), b=c("entry.description"), c=c("entry.query"))
            .unionByName(_flat("duplicates", back["duplicates"], n=c("dup_pos"), a=c("first_pos"), b=c("kind")))
            .unionByName(_flat("info", back["dataset_info"], n=c("total_examples"), a=c("validation_issues"), b=c("version"), c=c("created")))
            .unionByName(_flat("types", back["statistics"], n=c("count"), a=c("query_type"))))


@register("write_run_failures", "A", _RUNS + f"""
, n AS (SELECT *, row_number() OVER (ORDER BY run_id) AS query_number FROM st)
SELECT 'failed' AS part, query_number AS n, query_text AS a, message AS b, CASE WHEN syn THEN 'passed' ELSE 'not_checked' END AS c
FROM (SELECT *, query AS query_text, 'Error: ' || error || CASE WHEN details IS NOT NULL THEN chr(10) || 'Details: ' || details ELSE '' END AS message
      FROM n WHERE run_status = 'failed') f
UNION ALL SELECT 'syntax', query_number, query, array_to_string({d_syntax('query')}, '|'), description FROM n WHERE run_status = 'syntax_failed'
UNION ALL SELECT 'header', COUNT(*), CAST(count_if(run_status = 'syntax_failed') AS VARCHAR), 'pre_execution_syntax_check',
  CAST(count_if(run_status = 'failed') AS VARCHAR) FROM n""")
def q_write_failures(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    rows = OR.failed_runs(runs)
    syntax, header = OR.syntax_failed_runs(runs)
    header = header.crossJoin(rows.agg(F.count(F.lit(1)).alias("failed_queries_count")))
    parts = SK.write_failures(rows, header, _out(spark, "failures"), syntax=syntax)
    back = {k: spark.read.json(p) for k, p in parts.items()}
    c = F.col
    return (_flat("failed", back["failures"], n=c("query_number"), a=c("query_text"), b=c("error_message"), c=c("syntax_validation"))
            .unionByName(_flat("syntax", back["syntax_failures"], n=c("query_number"), a=c("query_text"), b=joined("syntax_errors"),
                               c=c("query_description")))
            .unionByName(_flat("header", back["header"], n=c("total_queries"), a=c("syntax_failed_count"), b=c("validation_type"),
                               c=c("failed_queries_count"))))


@register("write_eval_results", "A", _d_eval() + f"""
SELECT CAST(test_case_number AS BIGINT) AS test_case_number, case_id, description, ground_truth_query, generated_query, generation_error,
  syntax_valid, array_to_string(syntax_errors, '|') AS syntax_errors, exact_match, {d6('overall_score')} AS overall_score,
  CASE WHEN generation_error IS NULL THEN {d_normalize('generated_query')} END AS normalized_generated,
  CASE WHEN generation_error IS NULL THEN array_to_string({d_tokens(d_normalize('ground_truth_query'))}, ' ') END AS tokens_truth,
  similarity_bucket, comparison_outcome, {d6('result_comparison_score')} AS result_comparison_score,
  CAST((SELECT total_test_cases FROM rep) AS BIGINT) AS total_test_cases, 'fixture-model' AS llm_model FROM ev2""")
def q_write_eval(spark, sf_dir):
    cases = _eval_cases(spark, sf_dir)
    report = lambda written: OE.with_run(OE.eval_report(written), RUN_AT, "local", "fixture-model")
    parts = SK.write_eval(cases, report, _out(spark, "eval"))
    back = spark.read.json(parts["cases"])
    run = spark.read.json(parts["report"]).select("total_test_cases", "llm_model")
    sim = F.col("similarity_evaluation")
    return back.crossJoin(F.broadcast(run)).select(
        "test_case_number", "case_id", "description", "ground_truth_query", "generated_query", "generation_error", "syntax_valid",
        joined("syntax_errors").alias("syntax_errors"), "exact_match", r6("overall_score").alias("overall_score"),
        sim["normalized_generated"].alias("normalized_generated"), F.array_join(sim["tokens_truth"], " ").alias("tokens_truth"),
        "similarity_bucket", "comparison_outcome", r6("result_comparison_score").alias("result_comparison_score"),
        "total_test_cases", "llm_model")


@register("write_dedup", "A", X.duck_cte(corpus=X.DOC_CORPUS_SQL) + """
, k AS (SELECT *, md5(regexp_replace(regexp_replace(regexp_replace(query, '[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+', ' ', 'g'),
        '^[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+', '', 'g'), '[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+$', '', 'g')) AS h FROM corpus)
SELECT id, description, query, source FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY id) AS rn FROM k) t WHERE rn = 1""")
def q_write_dedup(spark, sf_dir):
    src = f"{sf_dir}/documents.parquet"
    p = SK.write_dedup(OD.dedup(X.doc_corpus(spark, sf_dir)), src, _out(spark, "dedup"))
    return spark.read.parquet(p)


@register("publish_splits", "A", _d_split().replace("\nSELECT id, CASE", ", sp AS (SELECT id, CASE") + """)
SELECT c.id, c.description, c.query, c.source, c.query_type, sp.split FROM cleaned c JOIN sp ON sp.id = c.id""")
def q_publish(spark, sf_dir):
    c = cleaned_corpus(spark, sf_dir).select("id", "description", "query", "source", "query_type")
    p = SK.publish(OS.train_test_split(c, 0.85, 42), _out(spark, "publish"))
    return spark.read.parquet(p)
