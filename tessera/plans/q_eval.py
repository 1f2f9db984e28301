"""Registered queries for groups I-J (result comparison and evaluation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as OE
from ..operators import loose_records as LR
from ..operators import result_compare as RC
from . import fixtures as X
from .q_text import d_extract, d_jac, d_normalize, d_struct, d_think, d_tokens
from .registry import d6, d_syntax, joined, r6, register

REC_COLS = ["l_returnflag", "l_linestatus", "l_quantity"]


def _records(spark, sf_dir, case_col="l_suppkey"):
    r = X.result_records(spark, sf_dir, case_col)
    return RC.canonical_record(r, REC_COLS).select("case_id", "side", "record")


def _d_compare(case_col: str = "l_suppkey", thr: float = 0.8) -> str:
    """DuckDB: per-case comparison from distinct record sets joined on their values."""
    return X.duck_cte(**X.duck_results(case_col)).replace("WITH ", "WITH ", 1) + f"""
, t AS (SELECT DISTINCT case_id, l_returnflag, l_linestatus, l_quantity FROM records WHERE side = 'truth')
, g AS (SELECT DISTINCT case_id, l_returnflag, l_linestatus, l_quantity FROM records WHERE side = 'generated')
, raw AS (SELECT case_id, count_if(side = 'truth') AS raw_t, count_if(side = 'generated') AS raw_g FROM records GROUP BY case_id)
, st AS (SELECT case_id, COUNT(*) AS set_t FROM t GROUP BY case_id)
, sg AS (SELECT case_id, COUNT(*) AS set_g FROM g GROUP BY case_id)
, cm AS (SELECT t.case_id, COUNT(*) AS common FROM t JOIN g ON t.case_id = g.case_id AND t.l_returnflag = g.l_returnflag
         AND t.l_linestatus = g.l_linestatus AND t.l_quantity = g.l_quantity GROUP BY t.case_id)
, hp AS (SELECT case_id,
           bool_or(success) FILTER (WHERE side = 'truth') AS truth_success,
           max(error) FILTER (WHERE side = 'truth') AS truth_error,
           max(record_count) FILTER (WHERE side = 'truth') AS truth_record_count,
           bool_or(success) FILTER (WHERE side = 'generated') AS generated_success,
           max(error) FILTER (WHERE side = 'generated') AS generated_error,
           max(record_count) FILTER (WHERE side = 'generated') AS generated_record_count
         FROM headers GROUP BY case_id)
, c0 AS (SELECT hp.*, coalesce(raw.raw_t, 0) AS raw_t, coalesce(raw.raw_g, 0) AS raw_g,
           coalesce(st.set_t, 0) AS set_t, coalesce(sg.set_g, 0) AS set_g, coalesce(cm.common, 0) AS common,
           NOT (coalesce(truth_success, FALSE) AND coalesce(generated_success, FALSE)) AS failed
         FROM hp LEFT JOIN raw USING (case_id) LEFT JOIN st USING (case_id) LEFT JOIN sg USING (case_id)
         LEFT JOIN cm USING (case_id))
, cmp AS (SELECT case_id, failed, truth_success, generated_success, truth_record_count, generated_record_count,
    truth_error, generated_error,
    CASE WHEN failed THEN FALSE ELSE set_t = set_g AND set_g = common END AS strict_match,
    CASE WHEN failed THEN CAST(0.0 AS DOUBLE)
         WHEN set_t = 0 AND set_g = 0 THEN CAST(1.0 AS DOUBLE) WHEN set_t = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE CAST(common AS DOUBLE) / (set_t + set_g - common) END AS score,
    CAST(CASE WHEN failed THEN truth_record_count ELSE raw_t END AS BIGINT) AS ground_truth_count,
    CAST(CASE WHEN failed THEN generated_record_count ELSE raw_g END AS BIGINT) AS generated_count,
    CAST(CASE WHEN failed THEN 0 ELSE common END AS BIGINT) AS common_records,
    CAST(CASE WHEN failed THEN truth_record_count ELSE set_t - common END AS BIGINT) AS missing_records,
    CAST(CASE WHEN failed THEN generated_record_count ELSE set_g - common END AS BIGINT) AS extra_records
  FROM c0)
, cmpf AS (SELECT *, NOT failed AND score >= {thr} AS fuzzy_match FROM cmp)
"""


# ---------------------------------------------------------------- I
@register("canonical_record", "I", """
, e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CASE WHEN label = 0 AND x < 0 THEN NULL
          ELSE CAST(floor(CAST(x AS DOUBLE) * 1000 + 0.5) AS BIGINT) END) AS dims FROM embeddings)
SELECT vec_id, to_json(struct_pack(
  dims := CASE WHEN len(list_filter(dims, lambda x: x IS NULL)) > 0 THEN dims ELSE list_sort(dims) END,
  label := label, vec_id := vec_id)) AS record FROM e""".replace("\n, e AS", "WITH e AS", 1))
def q_canonical_record(spark, sf_dir):
    e = X.table(spark, sf_dir, "embeddings")
    dims = F.transform("embedding", lambda x: F.when((F.col("label") == 0) & (x < 0), F.lit(None)).otherwise(
        F.floor(x.cast("double") * F.lit(1000) + F.lit(0.5))))
    e = e.select("vec_id", "label", dims.alias("dims"))
    return RC.canonical_record(e, ["vec_id", "label", "dims"]).select("vec_id", "record")


# records of four shapes: keys, types and nesting differ from row to row
@register("canonical_record_loose", "I", """
WITH w AS (SELECT *, string_split(p_name, ' ') AS ws FROM part),
q AS (SELECT *, '[' || array_to_string(list_transform(list_sort(ws), lambda x: '"' || x || '"'), ',') || ']' AS words FROM w)
SELECT p_partkey, CASE p_partkey % 4
  WHEN 0 THEN '{"name":"' || p_name || '","size":' || p_size || ',"tags":' || words || '}'
  WHEN 1 THEN '{"name":' || words || ',"size":"' || p_size || '"}'
  WHEN 2 THEN '{"x":{"a":{"l":[{"k":' || words || '},"m"],"n":null},"z":[' || array_to_string(list_sort([p_size, 30, 7]), ',') || ']}}'
  ELSE '["' || p_brand || '",' || p_size || ',{"b":[2,1,[' || p_size || ',0]],"w":' || words || '}]' END AS record
FROM q""")
def q_canonical_loose(spark, sf_dir):
    words = F.to_json(F.split("p_name", " "))
    size, text = F.col("p_size").cast("string"), lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    shape = F.col("p_partkey") % 4
    record = (F.when(shape == 0, text('{"tags":', words, ',"size":', size, ' , "name":"', F.col("p_name"), '"}'))
              .when(shape == 1, text('{"size":"', size, '","name":', words, "}"))
              .when(shape == 2, text('{"x":{"z":[', size, ',30,7],"a":{"n":null,"l":[{"k":', words, '},"m"]}}}'))
              .otherwise(text('["', F.col("p_brand"), '",', size, ',{"w":', words, ',"b":[2,1,[', size, ",0]]}]")))
    return LR.canonical_json(X.table(spark, sf_dir, "part").select("p_partkey", record.alias("raw")), "raw").select("p_partkey", "record")


@register("compare_results", "I", _d_compare() + f"""
SELECT case_id, strict_match, fuzzy_match, ground_truth_count, generated_count, common_records, missing_records,
       extra_records, {d6('score')} AS similarity_score FROM cmpf""")
def q_compare(spark, sf_dir):
    c = RC.compare(_records(spark, sf_dir), X.result_headers(spark, sf_dir))
    return c.select("case_id", "strict_match", "fuzzy_match", "ground_truth_count", "generated_count", "common_records",
                    "missing_records", "extra_records", r6("similarity_score").alias("similarity_score"))


@register("compare_failed", "I", _d_compare() + """
SELECT case_id, ground_truth_count, generated_count, missing_records, extra_records,
       truth_error AS ground_truth_error, generated_error FROM cmpf WHERE failed""")
def q_compare_failed(spark, sf_dir):
    c = RC.compare(_records(spark, sf_dir), X.result_headers(spark, sf_dir))
    return c.filter("either_failed").select("case_id", "ground_truth_count", "generated_count", "missing_records",
                                            "extra_records", "ground_truth_error", "generated_error")


@register("compare_samples", "I", X.duck_cte(**X.duck_results()) + """
, rr AS (SELECT case_id, side, to_json(struct_pack(l_linestatus := l_linestatus, l_quantity := l_quantity,
         l_returnflag := l_returnflag)) AS record FROM records)
, sets AS (SELECT case_id, record, bool_or(side = 'truth') AS in_t, bool_or(side = 'generated') AS in_g
           FROM rr GROUP BY case_id, record)
, allc AS (SELECT case_id, side AS class, record FROM rr
           UNION ALL SELECT case_id, CASE WHEN in_t AND in_g THEN 'common' WHEN in_t THEN 'missing' ELSE 'extra' END,
           record FROM sets)
SELECT * FROM (SELECT case_id, class, record, row_number() OVER (PARTITION BY case_id, class ORDER BY record) AS rank
               FROM allc) x WHERE rank <= 3""")
def q_compare_samples(spark, sf_dir):
    return RC.compare_samples(_records(spark, sf_dir), 3)


# ---------------------------------------------------------------- J
def _eval_cases(spark, sf_dir, with_results=True, numbered=True):
    c = X.corpus(spark, sf_dir).filter(F.col("description").isNotNull() & F.col("query").isNotNull())
    cases = c.select(F.col("id").alias("case_id"), "description", F.col("query").alias("ground_truth_query"))
    resp = X.responses(spark, sf_dir)
    if not with_results:
        return OE.evaluate(cases, resp, numbered=numbered)
    recs = _records(spark, sf_dir, "l_orderkey")
    heads = X.result_headers(spark, sf_dir, "l_orderkey")
    return OE.evaluate(cases, resp, recs, heads, numbered=numbered)


def _d_eval() -> str:
    base = _d_compare("l_orderkey")
    extra = X.duck_cte(**X.duck_responses()).replace("WITH ", ", ", 1)
    return base + extra + f"""
, cs AS (SELECT id AS case_id, description, query AS ground_truth_query FROM corpus
         WHERE description IS NOT NULL AND query IS NOT NULL)
, j AS (SELECT cs.*, r.raw_response, r.generation_time, row_number() OVER (ORDER BY cs.case_id) AS test_case_number,
        {d_extract(d_think('r.raw_response'))} AS e FROM cs LEFT JOIN responses r ON r.case_id = cs.case_id)
, k AS (SELECT *, raw_response IS NULL OR prefix(e, 'ERROR:') AS err FROM j)
, k2 AS (SELECT *, CASE WHEN NOT err THEN e END AS generated_query,
         CASE WHEN raw_response IS NULL THEN 'no response' WHEN err THEN e END AS generation_error FROM k)
, k3 AS (SELECT *, CASE WHEN raw_response IS NULL THEN ['Generation failed with exception'] WHEN err THEN ['Generation failed'] ELSE {d_syntax('generated_query')} END AS syntax_errors FROM k2)
, k4 AS (SELECT *, NOT err AND len(syntax_errors) = 0 AS syntax_valid,
         {d_normalize('generated_query')} AS ng, {d_normalize('ground_truth_query')} AS nt FROM k3)
, k5 AS (SELECT *, {d_tokens('ng')} AS tg, {d_tokens('nt')} AS tt, {d_normalize('ng')} AS ng2, {d_normalize('nt')} AS nt2 FROM k4)
, k6 AS (SELECT *, ng = nt AS ex, {d_jac('tg', 'tt')} AS tok,
   ((((CAST(0.0 AS DOUBLE) + {d_jac(d_struct('ng2', 'match_patterns'), d_struct('nt2', 'match_patterns'))} * CAST(0.4 AS DOUBLE))
      + {d_jac(d_struct('ng2', 'where_conditions'), d_struct('nt2', 'where_conditions'))} * CAST(0.3 AS DOUBLE))
      + {d_jac(d_struct('ng2', 'return_clauses'), d_struct('nt2', 'return_clauses'))} * CAST(0.2 AS DOUBLE))
      + {d_jac(d_struct('ng2', 'with_clauses'), d_struct('nt2', 'with_clauses'))} * CAST(0.1 AS DOUBLE))
      / CAST({repr(0.0 + 0.4 + 0.3 + 0.2 + 0.1)} AS DOUBLE) AS stru FROM k5)
, k7 AS (SELECT *, CASE WHEN ex THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.4 AS DOUBLE) * CAST(0.0 AS DOUBLE)
         + CAST(0.3 AS DOUBLE) * tok + CAST(0.3 AS DOUBLE) * stru END AS ov FROM k6)
, ev AS (SELECT k7.case_id, test_case_number, description, ground_truth_query, generated_query, generation_time,
    generation_error, syntax_valid, syntax_errors,
    CASE WHEN NOT err THEN ex END AS exact_match, CASE WHEN NOT err THEN tok END AS token_similarity,
    CASE WHEN NOT err THEN stru END AS structural_similarity, CASE WHEN NOT err THEN ov END AS overall_score,
    CASE WHEN err THEN NULL WHEN ex THEN 'exact' WHEN ov >= 0.8 THEN 'high' WHEN ov >= 0.5 THEN 'medium' ELSE 'low' END
      AS similarity_bucket,
    CASE WHEN err THEN NULL WHEN NOT syntax_valid THEN 'skipped_syntax'
         WHEN NOT coalesce(c.truth_success, FALSE) THEN 'truth_failed'
         WHEN c.truth_record_count = 0 THEN 'truth_empty'
         WHEN NOT coalesce(c.generated_success, FALSE) THEN 'gen_failed'
         WHEN c.generated_record_count = 0 THEN 'gen_empty'
         WHEN c.strict_match THEN 'strict' WHEN c.fuzzy_match THEN 'fuzzy' ELSE 'mismatch' END AS comparison_outcome,
    c.score AS cmp_score
  FROM k7 LEFT JOIN cmpf c ON c.case_id = k7.case_id)
, ev2 AS (SELECT *, CASE WHEN comparison_outcome IN ('strict', 'fuzzy', 'mismatch') THEN cmp_score END
          AS result_comparison_score FROM ev)
, rep AS (SELECT COUNT(*) AS total_test_cases, count_if(generation_error IS NULL) AS successful_generations,
    count_if(generation_error IS NOT NULL) AS generation_errors,
    count_if(generation_error IS NULL AND syntax_valid) AS syntax_valid_queries,
    count_if(generation_error IS NULL AND NOT syntax_valid) AS syntax_invalid_queries,
    count_if(similarity_bucket = 'exact') AS exact_matches, count_if(similarity_bucket = 'high') AS high_similarity_count,
    count_if(similarity_bucket = 'medium') AS medium_similarity_count, count_if(similarity_bucket = 'low') AS low_similarity_count,
    coalesce(avg(overall_score) FILTER (WHERE generation_error IS NULL), 0.0) AS average_similarity_score,
    count_if(comparison_outcome = 'strict') AS result_strict_matches, count_if(comparison_outcome = 'fuzzy') AS result_fuzzy_matches,
    count_if(comparison_outcome IN ('truth_failed', 'gen_failed')) AS result_comparison_failures,
    coalesce(avg(result_comparison_score), 0.0) AS average_result_comparison_score,
    sum(generation_time) AS total_runtime FROM ev2)
"""


RUN_AT = "2024-01-31T00:00:00"
_EV_COLS = ("token_similarity", "structural_similarity", "overall_score", "result_comparison_score")


@register("eval_cases", "J", _d_eval() + f"""
SELECT CAST(test_case_number AS BIGINT) AS test_case_number, case_id, generation_error, syntax_valid,
  array_to_string(syntax_errors, '|') AS syntax_errors, exact_match,
  {d6('token_similarity')} AS token_similarity, {d6('structural_similarity')} AS structural_similarity,
  {d6('overall_score')} AS overall_score, similarity_bucket, comparison_outcome,
  {d6('result_comparison_score')} AS result_comparison_score FROM ev2""")
def q_eval_cases(spark, sf_dir):
    e = _eval_cases(spark, sf_dir)
    return e.select("test_case_number", "case_id", "generation_error", "syntax_valid",
                    joined("syntax_errors").alias("syntax_errors"), "exact_match",
                    *[r6(c).alias(c) for c in _EV_COLS[:3]], "similarity_bucket", "comparison_outcome",
                    r6("result_comparison_score").alias("result_comparison_score"))


@register("comparison_outcome", "I", _d_eval() + "SELECT case_id, comparison_outcome FROM ev2")
def q_outcome(spark, sf_dir):
    return _eval_cases(spark, sf_dir).select("case_id", "comparison_outcome")


_REP_INT = ["total_test_cases", "successful_generations", "generation_errors", "syntax_valid_queries",
            "syntax_invalid_queries", "exact_matches", "high_similarity_count", "medium_similarity_count",
            "low_similarity_count", "result_strict_matches", "result_fuzzy_matches", "result_comparison_failures"]
_REP_DBL = ["average_similarity_score", "average_result_comparison_score", "total_runtime"]


@register("eval_report", "J", _d_eval() + "SELECT " + ", ".join(_REP_INT) + ", "
          + ", ".join(f"{d6(c)} AS {c}" for c in _REP_DBL) + " FROM rep")
def q_eval_report(spark, sf_dir):
    r = OE.eval_report(_eval_cases(spark, sf_dir, numbered=False))
    return r.select(*_REP_INT, *[r6(c).alias(c) for c in _REP_DBL])


_RATES = {
    "syntax_success_rate": "CASE WHEN successful_generations > 0 THEN syntax_valid_queries / successful_generations * 100.0 ELSE 0.0 END",
    "accuracy_rate": "CASE WHEN total_test_cases > 0 THEN (exact_matches + high_similarity_count) / total_test_cases * 100.0 ELSE 0.0 END",
    "result_accuracy_rate": "CASE WHEN total_test_cases > 0 THEN (result_strict_matches + result_fuzzy_matches) / total_test_cases * 100.0 ELSE 0.0 END",
    "average_time_per_case": "CASE WHEN total_test_cases > 0 THEN total_runtime / total_test_cases ELSE 0.0 END",
}


@register("eval_rates", "J", _d_eval() + "SELECT " + ", ".join(f"{d6(v)} AS {k}" for k, v in _RATES.items()) + " FROM rep")
def q_eval_rates(spark, sf_dir):
    r = OE.eval_rates(OE.eval_report(_eval_cases(spark, sf_dir, numbered=False)))
    return r.select(*[r6(c).alias(c) for c in _RATES])


def _d_round(expr: str, digits: int) -> str:
    s = 10 ** digits
    return f"CAST(floor(CAST({expr} AS DOUBLE) * {s} + 0.5) / {s} AS DOUBLE)"


@register("stats_summary", "J", _d_eval() + f"""
, rt AS (SELECT *, {_RATES['syntax_success_rate']} AS ssr, {_RATES['accuracy_rate']} AS acc,
         {_RATES['average_time_per_case']} AS atc FROM rep)
SELECT '2024-01-31T00:00:00' AS evaluation_timestamp, 'local' AS llm_provider, 'fixture-model' AS llm_model,
  TRUE AS syntax_validation_enabled, CAST(0.8 AS DOUBLE) AS similarity_threshold,
  total_test_cases, successful_generations, generation_errors, syntax_valid_queries, syntax_invalid_queries,
  exact_matches, high_similarity_count, medium_similarity_count, low_similarity_count,
  {_d_round('ssr', 2)} AS syntax_success_rate_percent, {_d_round('acc', 2)} AS accuracy_rate_percent,
  {_d_round('average_similarity_score', 4)} AS average_similarity_score, {_d_round('total_runtime', 2)} AS total_runtime_seconds,
  {_d_round('atc', 2)} AS average_time_per_case_seconds FROM rt""")
def q_stats_summary(spark, sf_dir):
    report = OE.with_run(OE.eval_report(_eval_cases(spark, sf_dir, numbered=False)), RUN_AT, "local", "fixture-model")
    s = OE.stats_summary(OE.eval_rates(report))
    return s.select(*[F.col(c).cast("double").alias(c) if c.endswith(("percent", "seconds", "score")) else c for c in s.columns])


@register("valid_queries_export", "J", _d_eval() + f"""
SELECT case_id, description, generated_query, ground_truth_query, {d6('coalesce(overall_score, 0.0)')} AS similarity_score,
       'eval_local_fixture-model' AS source FROM ev2
WHERE generated_query IS NOT NULL AND generated_query <> '' AND syntax_valid""")
def q_valid_export(spark, sf_dir):
    v = OE.valid_export(_eval_cases(spark, sf_dir), "local", "fixture-model")
    return v.select("case_id", "description", "generated_query", "ground_truth_query",
                    r6("similarity_score").alias("similarity_score"), "source")


@register("eval_verdict", "J", _d_eval() + f"""
SELECT CASE WHEN generation_errors = 0 AND syntax_valid_queries = successful_generations THEN
         CASE WHEN exact_matches = total_test_cases THEN 'perfect'
              WHEN exact_matches + high_similarity_count = total_test_cases THEN 'excellent' ELSE 'valid_mixed' END
       ELSE 'summary' END AS verdict,
  {d6('(exact_matches + high_similarity_count) / greatest(total_test_cases, 1) * 100.0')} AS accuracy_rate,
  {d6('average_similarity_score')} AS average_similarity_score FROM rep""")
def q_verdict(spark, sf_dir):
    v = OE.verdict(OE.eval_report(_eval_cases(spark, sf_dir, numbered=False)))
    return v.select("verdict", r6("accuracy_rate").alias("accuracy_rate"),
                    r6("average_similarity_score").alias("average_similarity_score"))
