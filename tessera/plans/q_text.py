"""Registered queries for groups G-H (responses and query similarity)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import responses as FR
from ..functions import similarity as FS
from ..operators import responses as ORS
from . import fixtures as X
from .registry import D_WS, d6, d_collapse, d_strip, joined, r6, register

# ---------------------------------------------------------------- DuckDB expressions
_NL = "chr(10)"


def d_think(x: str) -> str:
    return f"regexp_replace({x}, '(?s)<think>.*?</think>', '', 'g')"


def d_lines(x: str, extra: str = "TRUE") -> str:
    return (f"list_filter(list_transform(string_split({d_strip(x)}, {_NL}), lambda l: {d_strip('l')}), "
            f"lambda l: l <> '' AND {extra})")


def d_extract(s: str) -> str:
    """Extraction on an already think-stripped text ``s``."""
    o, c = f"strpos({s}, '<query>')", f"strpos({s}, '</query>')"
    inner = f"CASE WHEN {c} > {o} + 7 THEN substr({s}, {o} + 7, {c} - {o} - 7) ELSE '' END"
    untag = d_lines(s, "NOT (prefix(l, '<') AND suffix(l, '>')) AND NOT prefix(l, 'tags.')")
    return (f"CASE WHEN {o} > 0 AND {c} > 0 THEN array_to_string({d_lines(inner)}, {_NL}) "
            f"WHEN len({untag}) > 0 THEN array_to_string({untag}, {_NL}) ELSE {d_strip(s)} END")


def d_normalize(x: str) -> str:
    n = d_strip(d_collapse(f"lower({x})"))
    for ch in ["(", ")", "[", "]", ":", "=", "<", ">"]:
        esc = "\\" + ch if ch in "()[]" else ch
        n = f"regexp_replace({n}, '[{D_WS}]*{esc}[{D_WS}]*', '{ch}', 'g')"
    n = f"regexp_replace({n}, '''([^'']*)''', '\"\\1\"', 'g')"
    n = f"regexp_replace({n}, '(?s)//.*', '', 'g')"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN '' ELSE {d_strip(n)} END"


def d_tokens(n: str) -> str:
    return f"regexp_extract_all(lower({n}), '[\\p{{L}}\\p{{N}}_]+|[()\\[\\]{{}}:=<>!\\-]|\"[^\"]*\"', 0)"


_STRUCT = {
    "match_patterns": "match[WS]+([^where^return^with^order^limit]+)",
    "where_conditions": "where[WS]+([^return^with^order^limit]+)",
    "return_clauses": "return[WS]+([^order^limit]+)",
    "with_clauses": "with[WS]+([^match^where^return^order^limit]+)",
}


def d_struct(n2: str, name: str) -> str:
    pat = _STRUCT[name].replace("[WS]", f"[{D_WS}]")
    return f"list_transform(regexp_extract_all({n2}, '(?i){pat}', 1), lambda f: {d_strip('f')})"


def d_jac(a: str, b: str) -> str:
    return (f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN CAST(1.0 AS DOUBLE) "
            f"WHEN len({a}) = 0 OR len({b}) = 0 THEN CAST(0.0 AS DOUBLE) "
            f"ELSE CAST(len(list_distinct(list_intersect({a}, {b}))) AS DOUBLE) / len(list_distinct(list_concat({a}, {b}))) END")


_PAIRS = X.duck_cte(**X.duck_responses()) + f"""
, pr AS (SELECT r.case_id, c.query AS truth, {d_extract(d_think('r.raw_response'))} AS generated
         FROM responses r JOIN corpus c ON c.id = r.case_id)
, nm AS (SELECT case_id, {d_normalize('generated')} AS ng, {d_normalize('truth')} AS nt FROM pr)
, tk AS (SELECT case_id, ng, nt, {d_tokens('ng')} AS tg, {d_tokens('nt')} AS tt,
                {d_normalize('ng')} AS ng2, {d_normalize('nt')} AS nt2 FROM nm)
, st AS (SELECT case_id, ng, nt, tg, tt,
   {d_struct('ng2', 'match_patterns')} AS mg, {d_struct('nt2', 'match_patterns')} AS mt,
   {d_struct('ng2', 'where_conditions')} AS wg, {d_struct('nt2', 'where_conditions')} AS wt,
   {d_struct('ng2', 'return_clauses')} AS rg, {d_struct('nt2', 'return_clauses')} AS rt,
   {d_struct('ng2', 'with_clauses')} AS hg, {d_struct('nt2', 'with_clauses')} AS ht FROM tk)
, sc AS (SELECT *, ng = nt AS exact_match, {d_jac('tg', 'tt')} AS tok,
   ((((CAST(0.0 AS DOUBLE) + {d_jac('mg', 'mt')} * CAST(0.4 AS DOUBLE)) + {d_jac('wg', 'wt')} * CAST(0.3 AS DOUBLE))
      + {d_jac('rg', 'rt')} * CAST(0.2 AS DOUBLE)) + {d_jac('hg', 'ht')} * CAST(0.1 AS DOUBLE))
      / CAST({repr(0.0 + 0.4 + 0.3 + 0.2 + 0.1)} AS DOUBLE) AS stru FROM st)
, ov AS (SELECT *, CASE WHEN exact_match THEN CAST(1.0 AS DOUBLE)
   ELSE CAST(0.4 AS DOUBLE) * CAST(0.0 AS DOUBLE) + CAST(0.3 AS DOUBLE) * tok + CAST(0.3 AS DOUBLE) * stru END AS overall FROM sc)
"""

_SEP = " ¦ "


def _pairs(spark, sf_dir):
    r = X.responses(spark, sf_dir)
    c = X.corpus(spark, sf_dir).select(F.col("id").alias("case_id"), F.col("query").alias("truth"))
    return r.join(c, "case_id").select("case_id", "truth", FR.extract_query("raw_response").alias("generated"))


def _scored(spark, sf_dir):
    return FS.similarity_columns(_pairs(spark, sf_dir), "generated", "truth")


# ---------------------------------------------------------------- G
_RESP = X.duck_cte(**X.duck_responses())


@register("strip_think", "G", _RESP + f"SELECT case_id, {d_think('raw_response')} AS stripped FROM responses")
def q_strip_think(spark, sf_dir):
    return X.responses(spark, sf_dir).select("case_id", FR.strip_think("raw_response").alias("stripped"))


_HAS = "strpos(s, '<query>') > 0 AND strpos(s, '</query>') > 0"


@register("extract_tagged", "G", _RESP + f"""
, t AS (SELECT case_id, {d_think('raw_response')} AS s FROM responses)
SELECT case_id, {d_extract('s')} AS generated FROM t WHERE {_HAS}""")
def q_extract_tagged(spark, sf_dir):
    r = X.responses(spark, sf_dir).withColumn("s", FR.strip_think("raw_response"))
    has = (F.locate("<query>", F.col("s")) > 0) & (F.locate("</query>", F.col("s")) > 0)
    return r.filter(has).select("case_id", FR.extract_query("raw_response").alias("generated"))


@register("extract_untagged", "G", _RESP + f"""
, t AS (SELECT case_id, {d_think('raw_response')} AS s FROM responses)
SELECT case_id, {d_extract('s')} AS generated FROM t WHERE NOT ({_HAS})""")
def q_extract_untagged(spark, sf_dir):
    r = X.responses(spark, sf_dir).withColumn("s", FR.strip_think("raw_response"))
    has = (F.locate("<query>", F.col("s")) > 0) & (F.locate("</query>", F.col("s")) > 0)
    return r.filter(~has).select("case_id", FR.extract_query("raw_response").alias("generated"))


@register("response_status", "G", _RESP + f"""
, t AS (SELECT case_id, {d_extract(d_think('raw_response'))} AS e FROM responses)
SELECT case_id, CASE WHEN prefix(e, 'ERROR:') THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN NOT prefix(e, 'ERROR:') THEN e END AS generated_query,
       CASE WHEN prefix(e, 'ERROR:') THEN e END AS generation_error FROM t""")
def q_response_status(spark, sf_dir):
    r = X.responses(spark, sf_dir).select("case_id", FR.response_status(FR.extract_query("raw_response")).alias("s"))
    return r.select("case_id", "s.status", "s.generated_query", "s.generation_error")


SYSTEM_PROMPT = "You translate a task description into one graph query. Answer with <query> </query> tags only."


@register("build_messages", "G", X.duck_cte(**X.duck_corpus()) + f"""
SELECT id AS case_id, 'system' AS role0, '{SYSTEM_PROMPT}' AS content0, 'user' AS role1, description AS content1
FROM corpus WHERE description IS NOT NULL AND query IS NOT NULL""")
def q_build_messages(spark, sf_dir):
    c = X.corpus(spark, sf_dir).filter(F.col("description").isNotNull() & F.col("query").isNotNull())
    m = ORS.build_messages(c.select(F.col("id").alias("case_id"), "description"), SYSTEM_PROMPT)
    return m.select("case_id", F.col("messages")[0]["role"].alias("role0"), F.col("messages")[0]["content"].alias("content0"),
                    F.col("messages")[1]["role"].alias("role1"), F.col("messages")[1]["content"].alias("content1"))


# ---------------------------------------------------------------- H
@register("normalize_query", "H", X.duck_cte(corpus=X.DOC_CORPUS_SQL) + f"""
SELECT id, {d_normalize('query')} AS normalized FROM corpus""")
def q_normalize_docs(spark, sf_dir):
    return X.doc_corpus(spark, sf_dir).select("id", FS.normalize_query("query").alias("normalized"))


@register("normalize_generated", "H", _PAIRS + "SELECT case_id, ng AS normalized_generated, nt AS normalized_truth FROM nm")
def q_normalize_pairs(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return p.select("case_id", FS.normalize_query("generated").alias("normalized_generated"),
                    FS.normalize_query("truth").alias("normalized_truth"))


@register("tokenize_query", "H", _PAIRS + f"""
SELECT case_id, array_to_string(tg, '{_SEP}') AS tokens_generated, array_to_string(tt, '{_SEP}') AS tokens_truth FROM tk""")
def q_tokenize(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("case_id", joined("tokens_generated", _SEP).alias("tokens_generated"),
                    joined("tokens_truth", _SEP).alias("tokens_truth"))


@register("token_jaccard", "H", _PAIRS + f"SELECT case_id, {d6('tok')} AS token_similarity FROM sc")
def q_token_jaccard(spark, sf_dir):
    return _scored(spark, sf_dir).select("case_id", r6("token_similarity").alias("token_similarity"))


@register("query_structure", "H", _PAIRS + f"""
SELECT case_id, array_to_string(mg, '{_SEP}') AS match_patterns, array_to_string(wg, '{_SEP}') AS where_conditions,
       array_to_string(rg, '{_SEP}') AS return_clauses, array_to_string(hg, '{_SEP}') AS with_clauses FROM st""")
def q_structure(spark, sf_dir):
    s = _scored(spark, sf_dir)
    g = F.col("structure_generated")
    return s.select("case_id", *[joined(g[n], _SEP).alias(n) for n in FS.STRUCTURE_PATTERNS])


@register("structural_similarity", "H", _PAIRS + f"SELECT case_id, {d6('stru')} AS structural_similarity FROM sc")
def q_structural(spark, sf_dir):
    return _scored(spark, sf_dir).select("case_id", r6("structural_similarity").alias("structural_similarity"))


@register("query_similarity", "H", _PAIRS + f"""
SELECT case_id, exact_match, {d6('tok')} AS token_similarity, {d6('stru')} AS structural_similarity,
       {d6('overall')} AS overall_score FROM ov""")
def q_similarity(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("case_id", "exact_match", *[r6(c).alias(c) for c in ("token_similarity", "structural_similarity", "overall_score")])


def _d_bucket(thr: float) -> str:
    return (f"SELECT case_id, CASE WHEN exact_match THEN 'exact' WHEN overall >= {thr} THEN 'high' "
            f"WHEN overall >= 0.5 THEN 'medium' ELSE 'low' END AS bucket FROM ov")


@register("similarity_bucket", "H", _PAIRS + _d_bucket(0.8))
def q_bucket(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("case_id", FS.similarity_bucket("exact_match", "overall_score", 0.8).alias("bucket"))


@register("similarity_bucket_055", "H", _PAIRS + _d_bucket(0.55))
def q_bucket55(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("case_id", FS.similarity_bucket("exact_match", "overall_score", 0.55).alias("bucket"))
