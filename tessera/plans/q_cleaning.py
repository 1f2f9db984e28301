"""Registered queries for groups A-C (reads, cleaning, validation)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import cleaning as OC
from . import fixtures as X
from ..functions.text import is_blank
from .registry import D_WS, d_collapse, d_strip, joined, register

_CORPUS = X.duck_cte(**X.duck_corpus())

# Cleaning in DuckDB, written from the reference's rules.
_D_ANNOT = _CORPUS + f"""
, a AS (
  SELECT id, description AS raw_description, query AS raw_query, source AS raw_source,
    CASE WHEN description IS NULL THEN 'Missing required field: description'
         WHEN query IS NULL THEN 'Missing required field: query'
         WHEN source IS NULL THEN 'Missing required field: source'
         WHEN {d_strip('description')} = '' THEN 'Empty description'
         WHEN {d_strip('query')} = '' THEN 'Empty query'
    END AS drop_issue
  FROM corpus
), b AS (
  SELECT *,
    {d_strip(d_collapse('raw_query'))} AS q,
    regexp_replace({d_strip('raw_description')}, '(?i)^(find|get|return|show|list)[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]+', '') AS d0,
    {d_strip('raw_source')} AS s0
  FROM a
), c AS (
  SELECT *,
    upper(left(d0, 1)) || substr(d0, 2) AS d,
    CASE WHEN s0 = '' THEN 'unknown'
         WHEN s0 LIKE 'http%' THEN regexp_replace(s0, '[/#]+$', '')
         ELSE s0 END AS s,
    length(q) - length(replace(q, '(', '')) - (length(q) - length(replace(q, ')', ''))) AS paren,
    length(q) - length(replace(q, '[', '')) - (length(q) - length(replace(q, ']', ''))) AS bracket,
    length(q) - length(replace(q, '{{', '')) - (length(q) - length(replace(q, '}}', ''))) AS brace,
    regexp_matches(upper(q), 'MATCH|WHERE|RETURN|WITH|OPTIONAL|CREATE|DELETE|SET') AS has_kw
  FROM b
), e AS (
  SELECT *,
    CASE WHEN drop_issue IS NOT NULL THEN [drop_issue]
    ELSE list_filter([
      CASE WHEN NOT has_kw THEN 'Syntax error: No Cypher keywords found' END,
      CASE WHEN paren <> 0 THEN 'Syntax error: Unbalanced parentheses (difference: ' || paren || ')' END,
      CASE WHEN bracket <> 0 THEN 'Syntax error: Unbalanced brackets (difference: ' || bracket || ')' END,
      CASE WHEN brace <> 0 THEN 'Syntax error: Unbalanced braces (difference: ' || brace || ')' END
    ], lambda x: x IS NOT NULL) END AS issues
  FROM c
)
"""

D_CLEANED = _D_ANNOT + """
, cleaned AS (
  SELECT id, d AS description, q AS query, s AS source,
    CAST(length(q) AS BIGINT) AS query_length, CAST(length(d) AS BIGINT) AS description_length,
    CAST((strpos(q, 'shortestPath') > 0)::INT + (strpos(q, 'allShortestPaths') > 0)::INT
       + (strpos(q, 'OPTIONAL MATCH') > 0)::INT + (strpos(q, 'WITH') > 0)::INT
       + (strpos(q, 'UNION') > 0)::INT + (strpos(q, 'UNWIND') > 0)::INT
       + (strpos(q, 'CASE') > 0)::INT + (strpos(q, 'COLLECT') > 0)::INT
       + (strpos(q, 'COUNT') > 0)::INT + (strpos(q, 'datetime()') > 0)::INT AS BIGINT) AS complexity_score,
    CASE WHEN strpos(upper(q), 'MATCH') > 0 AND strpos(upper(q), 'RETURN') > 0 THEN
           CASE WHEN regexp_matches(upper(q), 'CREATE|SET|DELETE') THEN 'modification' ELSE 'read' END
         WHEN strpos(upper(q), 'CREATE') > 0 THEN 'create'
         WHEN strpos(upper(q), 'DELETE') > 0 THEN 'delete'
         ELSE 'other' END AS query_type,
    concat_ws('|',
      CASE WHEN regexp_matches(q, '(?i):User([^\\p{L}\\p{N}_]|$)') THEN 'User' END,
      CASE WHEN regexp_matches(q, '(?i):Computer([^\\p{L}\\p{N}_]|$)') THEN 'Computer' END,
      CASE WHEN regexp_matches(q, '(?i):Group([^\\p{L}\\p{N}_]|$)') THEN 'Group' END,
      CASE WHEN regexp_matches(q, '(?i):Domain([^\\p{L}\\p{N}_]|$)') THEN 'Domain' END,
      CASE WHEN regexp_matches(q, '(?i):GPO([^\\p{L}\\p{N}_]|$)') THEN 'GPO' END,
      CASE WHEN regexp_matches(q, '(?i):OU([^\\p{L}\\p{N}_]|$)') THEN 'OU' END,
      CASE WHEN regexp_matches(q, '(?i):Container([^\\p{L}\\p{N}_]|$)') THEN 'Container' END,
      CASE WHEN regexp_matches(q, '(?i):CertTemplate([^\\p{L}\\p{N}_]|$)') THEN 'CertTemplate' END
    ) AS entities,
    issues
  FROM e WHERE drop_issue IS NULL
)
"""


def cleaned_corpus(spark, sf_dir):
    cleaned, _ = OC.clean_corpus(X.corpus(spark, sf_dir))
    return cleaned


@register("clean_corpus", "B", D_CLEANED + "SELECT id, description, query, source, query_length, "
          "description_length, complexity_score, query_type, entities FROM cleaned")
def q_clean_corpus(spark, sf_dir):
    return cleaned_corpus(spark, sf_dir).withColumn("entities", joined("entities"))


# ---------------------------------------------------------------- A: readers
from ..functions import cleaning as FC  # noqa: E402
from ..functions.text import canonical_ws  # noqa: E402
from ..operators import validation as OV  # noqa: E402
from ..sources import corpus_io as IO  # noqa: E402
from .registry import d6, d_syntax, r6  # noqa: E402
from .session import ensure_checkpoint_dir  # noqa: E402

_DOCS = X.duck_cte(corpus=X.DOC_CORPUS_SQL)
_VAL = X.duck_cte(**X.duck_validation())


def _json_lines(df) -> str:
    """The derived corpus as JSON Lines in the shared folder; null fields are left out."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tessera-out/corpus-{uuid.uuid4().hex}.jsonl"
    df.write.json(path)
    return path


@register("read_corpus_strict", "A", _DOCS + "SELECT id, description, query, source FROM corpus")
def q_read_strict(spark, sf_dir):
    return IO.read_corpus(spark, _json_lines(X.doc_corpus(spark, sf_dir)), "strict", "jsonl")


@register("read_corpus_skip", "A", _CORPUS + f"""
SELECT {d_strip('description')} AS description, {d_strip('query')} AS query,
       coalesce(source, 'unknown') AS source, id
FROM corpus WHERE description IS NOT NULL AND query IS NOT NULL""")
def q_read_skip(spark, sf_dir):
    return IO.read_corpus(spark, _json_lines(X.corpus(spark, sf_dir)), "skip", "jsonl")


@register("read_corpus_default_desc", "A", _CORPUS + """
SELECT id, coalesce(description, 'No description provided.') AS description, query
FROM corpus WHERE query IS NOT NULL""")
def q_read_default_desc(spark, sf_dir):
    return IO.read_corpus(spark, _json_lines(X.corpus(spark, sf_dir)), "default_desc", "jsonl")


@register("read_corpus_defaults", "A", _CORPUS + """
SELECT id, query, coalesce(description, 'Query ' || (id + 1)) AS description,
       coalesce(source, 'Unknown') AS source
FROM corpus WHERE query IS NOT NULL""")
def q_read_defaults(spark, sf_dir):
    return IO.read_corpus(spark, _json_lines(X.corpus(spark, sf_dir)), "defaults", "jsonl")


@register("read_named_dataset", "A", "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en'")
def q_read_named(spark, sf_dir):
    df = IO.read_dataset(spark, f"{sf_dir}/documents.parquet", config="en", config_col="lang", required=("text",))
    return df.select("doc_id", "lang", "source", "n_chars")


# ---------------------------------------------------------------- B: cleaning columns
@register("check_required", "B", _CORPUS + """
SELECT id, CASE WHEN description IS NULL THEN 'Missing required field: description'
                WHEN query IS NULL THEN 'Missing required field: query'
                WHEN source IS NULL THEN 'Missing required field: source' END AS issue
FROM corpus""")
def q_check_required(spark, sf_dir):
    return X.corpus(spark, sf_dir).select("id", OC.missing_field().alias("issue"))


@register("clean_description", "B", _CORPUS + f"""
, t AS (SELECT id, regexp_replace({d_strip('description')},
        '(?i)^(find|get|return|show|list)[{D_WS}]+', '') AS d
        FROM corpus WHERE description IS NOT NULL AND {d_strip('description')} <> '')
SELECT id, upper(left(d, 1)) || substr(d, 2) AS description FROM t""")
def q_clean_description(spark, sf_dir):
    c = X.corpus(spark, sf_dir)
    return c.filter(F.col("description").isNotNull() & ~is_blank("description")).select(
        "id", FC.clean_description("description").alias("description"))


@register("clean_query", "B", _DOCS + f"""
SELECT id, {d_strip(d_collapse('query'))} AS query FROM corpus""")
def q_clean_query(spark, sf_dir):
    return X.doc_corpus(spark, sf_dir).select("id", FC.clean_query("query").alias("query"))


@register("clean_source", "B", _CORPUS + f"""
, t AS (SELECT id, {d_strip('source')} AS s FROM corpus WHERE source IS NOT NULL)
SELECT id, CASE WHEN s = '' THEN 'unknown' WHEN starts_with(s, 'http') THEN regexp_replace(s, '[/#]+$', '')
                ELSE s END AS source FROM t""")
def q_clean_source(spark, sf_dir):
    c = X.corpus(spark, sf_dir)
    return c.filter(F.col("source").isNotNull()).select("id", FC.clean_source("source").alias("source"))


@register("text_lengths", "B", _DOCS + f"""
, t AS (SELECT id, {d_strip(d_collapse('query'))} AS q,
        regexp_replace({d_strip('description')}, '(?i)^(find|get|return|show|list)[{D_WS}]+', '') AS d
        FROM corpus)
SELECT id, CAST(length(q) AS BIGINT) AS query_length, CAST(length(d) AS BIGINT) AS description_length FROM t""")
def q_text_lengths(spark, sf_dir):
    c = X.doc_corpus(spark, sf_dir)
    return c.select("id", FC.text_length(FC.clean_query("query")).alias("query_length"),
                    FC.text_length(FC.clean_description("description")).alias("description_length"))


@register("complexity_score", "B", _CORPUS + """
SELECT id, CAST(
  (position('shortestPath' IN query) > 0)::INT + (position('allShortestPaths' IN query) > 0)::INT
  + (position('OPTIONAL MATCH' IN query) > 0)::INT + (position('WITH' IN query) > 0)::INT
  + (position('UNION' IN query) > 0)::INT + (position('UNWIND' IN query) > 0)::INT
  + (position('CASE' IN query) > 0)::INT + (position('COLLECT' IN query) > 0)::INT
  + (position('COUNT' IN query) > 0)::INT + (position('datetime()' IN query) > 0)::INT AS BIGINT) AS complexity_score
FROM corpus WHERE query IS NOT NULL""")
def q_complexity(spark, sf_dir):
    c = X.corpus(spark, sf_dir).filter(F.col("query").isNotNull())
    return c.select("id", FC.complexity_score("query").cast("long").alias("complexity_score"))


@register("query_type", "B", _CORPUS + """
, t AS (SELECT id, upper(query) AS u FROM corpus WHERE query IS NOT NULL)
SELECT id, CASE WHEN contains(u, 'MATCH') AND contains(u, 'RETURN')
                  THEN CASE WHEN contains(u, 'CREATE') OR contains(u, 'SET') OR contains(u, 'DELETE')
                            THEN 'modification' ELSE 'read' END
                WHEN contains(u, 'CREATE') THEN 'create'
                WHEN contains(u, 'DELETE') THEN 'delete' ELSE 'other' END AS query_type FROM t""")
def q_query_type(spark, sf_dir):
    c = X.corpus(spark, sf_dir).filter(F.col("query").isNotNull())
    return c.select("id", FC.query_type("query").alias("query_type"))


_ENT = ["User", "Computer", "Group", "Domain", "GPO", "OU", "Container", "CertTemplate"]


@register("extract_entities", "B", _CORPUS + "SELECT id, concat_ws('|', " + ", ".join(
    f"CASE WHEN regexp_matches(lower(query), ':{e.lower()}([^\\p{{L}}\\p{{N}}_]|$)') THEN '{e}' END" for e in _ENT
) + ") AS entities FROM corpus WHERE query IS NOT NULL")
def q_entities(spark, sf_dir):
    c = X.corpus(spark, sf_dir).filter(F.col("query").isNotNull())
    return c.select("id", joined(FC.entities("query")).alias("entities"))


@register("issue_rows", "B", D_CLEANED + """
SELECT id AS index, raw_description, raw_query, raw_source, array_to_string(issues, '|') AS issues
FROM e WHERE len(issues) > 0""")
def q_issue_rows(spark, sf_dir):
    _, iss = OC.clean_corpus(X.corpus(spark, sf_dir))
    return iss.select("index", F.col("entry.description").alias("raw_description"),
                      F.col("entry.query").alias("raw_query"), F.col("entry.source").alias("raw_source"),
                      joined("issues").alias("issues"))


_SOURCES = ["https://example.org/s/3", "unknown", "author 2"]


@register("filter_sources", "B", D_CLEANED + "SELECT id, source FROM cleaned WHERE source IN ("
          + ", ".join(f"'{s}'" for s in _SOURCES) + ")")
def q_filter_sources(spark, sf_dir):
    return OC.filter_sources(cleaned_corpus(spark, sf_dir), _SOURCES).select("id", "source")


@register("canonical_ws", "B", _DOCS + f"SELECT id, {d_strip(d_collapse('query'))} AS canonical FROM corpus")
def q_canonical(spark, sf_dir):
    return X.doc_corpus(spark, sf_dir).select("id", canonical_ws("query").alias("canonical"))


# ---------------------------------------------------------------- C: validation
@register("has_keyword", "C", _CORPUS + """
SELECT id, regexp_matches(upper(query), 'MATCH|WHERE|RETURN|WITH|OPTIONAL|CREATE|DELETE|SET') AS has_keyword
FROM corpus WHERE query IS NOT NULL""")
def q_has_keyword(spark, sf_dir):
    c = X.corpus(spark, sf_dir).filter(F.col("query").isNotNull())
    return c.select("id", FC.has_keyword("query").alias("has_keyword"))


@register("balance_check", "C", _CORPUS + """
SELECT id,
  CAST(length(query) - length(replace(query, '(', '')) - (length(query) - length(replace(query, ')', ''))) AS BIGINT) AS paren,
  CAST(length(query) - length(replace(query, '[', '')) - (length(query) - length(replace(query, ']', ''))) AS BIGINT) AS bracket,
  CAST(length(query) - length(replace(query, '{', '')) - (length(query) - length(replace(query, '}', ''))) AS BIGINT) AS brace
FROM corpus WHERE query IS NOT NULL""")
def q_balance(spark, sf_dir):
    c = X.corpus(spark, sf_dir).filter(F.col("query").isNotNull())
    return c.select("id", FC.balance("query", "(", ")").alias("paren"), FC.balance("query", "[", "]").alias("bracket"),
                    FC.balance("query", "{", "}").alias("brace"))


@register("validate_syntax", "C", _CORPUS + f"""
, t AS (SELECT id, {d_syntax('query')} AS errs FROM corpus WHERE query IS NOT NULL)
SELECT id, len(errs) = 0 AS valid, array_to_string(errs, '|') AS errors FROM t""")
def q_validate_syntax(spark, sf_dir):
    c = X.corpus(spark, sf_dir).filter(F.col("query").isNotNull())
    e = FC.syntax_errors("query")
    return c.select("id", (F.size(e) == 0).alias("valid"), joined(e).alias("errors"))


@register("validation_result", "C", _VAL + f"""
, t AS (SELECT id, online_ok, online_error, {d_syntax("coalesce(query, '')")} AS errs FROM vin)
SELECT id, len(errs) = 0 AND coalesce(online_ok, TRUE) AS ok, len(errs) = 0 AS offline_ok, online_ok,
       array_to_string(list_concat(errs, CASE WHEN online_error IS NULL THEN [] ELSE [online_error] END), '|') AS errors
FROM t""")
def q_validation_result(spark, sf_dir):
    v = X.validation_input(spark, sf_dir)
    errs = FC.syntax_errors(F.coalesce(F.col("query"), F.lit("")))
    online = F.when(F.col("online_error").isNotNull(), F.array("online_error")).otherwise(F.array().cast("array<string>"))
    r = OV.validation_result(F.size(errs) == 0, F.col("online_ok"), errs, online)
    return v.select("id", r.alias("r")).select("id", "r.ok", "r.offline_ok", "r.online_ok", joined("r.errors").alias("errors"))


@register("validate_batch", "C", _CORPUS + f"""
, t AS (SELECT id, coalesce(description, 'Query ' || (id + 1)) AS description,
        {d_syntax("coalesce(query, '')")} AS errs FROM corpus)
SELECT id, description, len(errs) = 0 AS ok, array_to_string(errs, '|') AS errors FROM t""")
def q_validate_batch(spark, sf_dir):
    b = OV.validate_batch(X.corpus(spark, sf_dir))
    return b.select("id", "description", "ok", joined("errors").alias("errors"))


def _validated(spark, sf_dir):
    v = X.validation_input(spark, sf_dir)
    errs = FC.syntax_errors(F.coalesce(F.col("query"), F.lit("")))
    online = F.when(F.col("online_error").isNotNull(), F.array("online_error")).otherwise(F.array().cast("array<string>"))
    r = OV.validation_result(F.size(errs) == 0, F.col("online_ok"), errs, online)
    return v.select("id", "description", "source", "query", "execution_time", r.alias("r")).select(
        "id", "description", "source", "query", "execution_time", "r.*")


@register("validation_summary", "C", _VAL + f"""
, t AS (SELECT id, online_ok, execution_time, len({d_syntax("coalesce(query, '')")}) = 0 AS off FROM vin)
, s AS (SELECT COUNT(*) AS total, count_if(off) AS syntax_valid, count_if(online_ok) AS semantic_valid,
          count_if(online_ok IS NOT NULL) AS semantic_tested, count_if(off AND coalesce(online_ok, TRUE)) AS overall_valid,
          sum(execution_time) AS tsum FROM t)
SELECT total, syntax_valid, semantic_valid, semantic_tested, overall_valid,
  {d6("CASE WHEN total > 0 THEN syntax_valid * 100.0 / total ELSE 0 END")} AS syntax_valid_pct,
  {d6("CASE WHEN semantic_tested > 0 THEN semantic_valid * 100.0 / semantic_tested END")} AS semantic_valid_pct,
  {d6("CASE WHEN total > 0 THEN overall_valid * 100.0 / total ELSE 0 END")} AS overall_valid_pct,
  {d6("CASE WHEN total > 0 THEN tsum / total ELSE 0 END")} AS avg_time
FROM s""")
def q_validation_summary(spark, sf_dir):
    s = OV.validation_summary(_validated(spark, sf_dir))
    return s.select("total", "syntax_valid", "semantic_valid", "semantic_tested", "overall_valid",
                    *[r6(c).alias(c) for c in ("syntax_valid_pct", "semantic_valid_pct", "overall_valid_pct", "avg_time")])


@register("regex_op_rewrite", "C", _CORPUS + "SELECT id, replace(query, '=~', '=') AS query FROM corpus WHERE query IS NOT NULL")
def q_regex_rewrite(spark, sf_dir):
    c = X.corpus(spark, sf_dir).filter(F.col("query").isNotNull())
    return c.select("id", FC.relax_regex_op("query").alias("query"))


_D_LOADED = _VAL + f"""
, l AS (SELECT id, query, coalesce(description, 'Query ' || (id + 1)) AS description,
        coalesce(source, 'Unknown') AS source, execution_time, {d_syntax('query')} AS errs
        FROM vin WHERE query IS NOT NULL)
, n AS (SELECT *, row_number() OVER (ORDER BY id) AS query_number FROM l)
"""


def _loaded_validated(spark, sf_dir):
    v = X.validation_input(spark, sf_dir)
    loaded = IO.apply_read_mode(v.select("id", "description", "query", "source"), "defaults")
    loaded = loaded.join(v.select("id", "execution_time"), "id")
    e = FC.syntax_errors("query")
    return loaded.withColumn("errors", e).withColumn("offline_ok", F.size(e) == 0)


@register("syntax_failure_report", "C", _D_LOADED + """
SELECT CAST(query_number AS BIGINT) AS query_number, description, source, query,
       array_to_string(errs, '|') AS syntax_errors, execution_time AS validation_time
FROM n WHERE len(errs) > 0""")
def q_failure_report(spark, sf_dir):
    rows, _ = OV.failure_report(_loaded_validated(spark, sf_dir))
    return rows.withColumn("syntax_errors", joined("syntax_errors"))


@register("syntax_failure_header", "C", _D_LOADED + """
SELECT COUNT(*) AS total_queries, count_if(len(errs) > 0) AS failed_queries_count FROM l""")
def q_failure_header(spark, sf_dir):
    _, header = OV.failure_report(_loaded_validated(spark, sf_dir))
    return header


@register("timing_stats", "C", _VAL + f"""
SELECT {d6('sum(execution_time)')} AS total_runtime, {d6('COUNT(*) / sum(execution_time)')} AS queries_per_second,
       {d6('min(execution_time)')} AS fastest, {d6('max(execution_time)')} AS slowest FROM vin""")
def q_timing(spark, sf_dir):
    t = OV.timing_stats(X.validation_input(spark, sf_dir))
    return t.select(*[r6(c).alias(c) for c in t.columns])


@register("validity_gate", "C", _VAL + f"""
SELECT id, CASE WHEN len({d_syntax("coalesce(query, '')")}) = 0 THEN 'valid' ELSE 'failed' END AS route FROM vin""")
def q_gate(spark, sf_dir):
    v = _validated(spark, sf_dir)
    ok, bad = OV.gate(v, "offline_ok")
    return ok.select("id", F.lit("valid").alias("route")).unionByName(bad.select("id", F.lit("failed").alias("route")))
