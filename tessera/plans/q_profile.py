"""Registered queries for groups D-F (duplicates, profile, splits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup as OD
from ..operators import profile as OP
from ..operators import sampling as OS
from . import fixtures as X
from .q_cleaning import D_CLEANED, cleaned_corpus
from .registry import d6, d_collapse, d_strip, r6, register

_DOCS = X.duck_cte(corpus=X.DOC_CORPUS_SQL)
_DOCKEY = _DOCS + f", k AS (SELECT id, source, md5({d_strip(d_collapse('query'))}) AS dup_key FROM corpus)\n"


# ---------------------------------------------------------------- D: duplicates
@register("find_duplicates", "D", _DOCKEY + """
, g AS (SELECT dup_key, COUNT(*) AS group_size FROM k GROUP BY dup_key HAVING COUNT(*) > 1)
SELECT k.dup_key, k.id, g.group_size FROM k JOIN g ON k.dup_key = g.dup_key""")
def q_find_duplicates(spark, sf_dir):
    return OD.find_duplicates(X.doc_corpus(spark, sf_dir))


@register("duplicate_report", "D", _DOCKEY + """
, g AS (SELECT dup_key, min(id) AS keep_index FROM k GROUP BY dup_key HAVING COUNT(*) > 1)
SELECT g.dup_key, g.keep_index, k.id AS remove_index FROM k JOIN g ON k.dup_key = g.dup_key WHERE k.id <> g.keep_index""")
def q_duplicate_report(spark, sf_dir):
    return OD.duplicate_report(X.doc_corpus(spark, sf_dir))


@register("dedup_keep_first", "D", _DOCKEY + """
SELECT id, source FROM (SELECT id, source, row_number() OVER (PARTITION BY dup_key ORDER BY id) AS rn FROM k) t
WHERE rn = 1""")
def q_dedup(spark, sf_dir):
    return OD.dedup(X.doc_corpus(spark, sf_dir)).select("id", "source")


def _d_pairs(field: str) -> str:
    return D_CLEANED + f"""
, p AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos, md5(lower({field})) AS h FROM cleaned)
, f AS (SELECT h, min(pos) AS first_pos FROM p GROUP BY h)
SELECT CAST(f.first_pos AS BIGINT) AS first_pos, CAST(p.pos AS BIGINT) AS dup_pos, p0.id AS first_id, p.id AS dup_id,
       'exact_{field}_match' AS kind
FROM p JOIN f ON p.h = f.h JOIN p p0 ON p0.pos = f.first_pos WHERE p.pos > f.first_pos"""


@register("dup_pairs_query", "D", _d_pairs("query"))
def q_dup_pairs_query(spark, sf_dir):
    return OD.duplicate_pairs(cleaned_corpus(spark, sf_dir), "query")


@register("dup_pairs_description", "D", _d_pairs("description"))
def q_dup_pairs_desc(spark, sf_dir):
    return OD.duplicate_pairs(cleaned_corpus(spark, sf_dir), "description")


# ---------------------------------------------------------------- E: profile
@register("corpus_totals", "E", D_CLEANED + f"""
SELECT COUNT(*) AS total_entries, {d6('avg(query_length)')} AS avg_query_length,
       {d6('avg(description_length)')} AS avg_description_length FROM cleaned""")
def q_totals(spark, sf_dir):
    t = OP.corpus_totals(cleaned_corpus(spark, sf_dir))
    return t.select("total_entries", r6("avg_query_length").alias("avg_query_length"),
                    r6("avg_description_length").alias("avg_description_length"))


@register("freq_source", "E", D_CLEANED + "SELECT source, COUNT(*) AS count FROM cleaned GROUP BY source")
def q_freq_source(spark, sf_dir):
    return OP.frequency(cleaned_corpus(spark, sf_dir), "source")


@register("freq_query_type", "E", D_CLEANED + f"""
SELECT coalesce(query_type, 'unknown') AS query_type, COUNT(*) AS count,
       {d6('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM cleaned)')} AS percentage
FROM cleaned GROUP BY 1""")
def q_freq_type(spark, sf_dir):
    f = OP.frequency(cleaned_corpus(spark, sf_dir), "query_type", pct=True, missing="unknown")
    return f.select("query_type", "count", r6("percentage").alias("percentage"))


@register("freq_entity", "E", D_CLEANED + """
SELECT entity, COUNT(*) AS count FROM (SELECT unnest(string_split(entities, '|')) AS entity FROM cleaned
WHERE entities <> '') t GROUP BY entity""")
def q_freq_entity(spark, sf_dir):
    return OP.frequency_exploded(cleaned_corpus(spark, sf_dir), "entities", "entity")


@register("hist_complexity", "E", D_CLEANED + "SELECT complexity_score, COUNT(*) AS count FROM cleaned GROUP BY 1")
def q_hist(spark, sf_dir):
    return OP.frequency(cleaned_corpus(spark, sf_dir), "complexity_score")


@register("top_k", "E", D_CLEANED + """
SELECT source, COUNT(*) AS count, min(id) AS first_seen FROM cleaned GROUP BY source
ORDER BY count DESC, first_seen LIMIT 10""")
def q_top_k(spark, sf_dir):
    return OP.top_k(cleaned_corpus(spark, sf_dir), "source", 10)


@register("unique_count", "E", D_CLEANED + "SELECT COUNT(DISTINCT source) AS unique_source FROM cleaned")
def q_unique(spark, sf_dir):
    return OP.distinct_count(cleaned_corpus(spark, sf_dir), "source")


# ---------------------------------------------------------------- F: splits
_TEST_RATIO = repr(1.0 - 0.85)


def _d_split(partition: str = "") -> str:
    over_n = f"OVER ({'PARTITION BY ' + partition if partition else ''})"
    over_r = f"OVER ({'PARTITION BY ' + partition + ' ' if partition else ''}ORDER BY md5('42:' || id), id)"
    return D_CLEANED + f"""
, r AS (SELECT id, row_number() {over_r} - 1 AS pos, COUNT(*) {over_n} AS n FROM cleaned)
SELECT id, CASE WHEN pos < ceil(n * CAST({_TEST_RATIO} AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM r"""


@register("train_test_split", "F", _d_split())
def q_split(spark, sf_dir):
    return OS.train_test_split(cleaned_corpus(spark, sf_dir).select("id"), 0.85, 42)


_D_STRAT = D_CLEANED + f"""
, r AS (SELECT id, query_type, row_number() OVER (PARTITION BY query_type ORDER BY md5('42:' || id), id) AS rn FROM cleaned)
, n AS (SELECT query_type, COUNT(*) * CAST({_TEST_RATIO} AS DOUBLE) AS share FROM cleaned GROUP BY query_type)
, n2 AS (SELECT *, row_number() OVER (ORDER BY share - floor(share) DESC, query_type) AS place,
         ceil((SELECT COUNT(*) FROM cleaned) * CAST({_TEST_RATIO} AS DOUBLE)) - sum(floor(share)) OVER () AS spare FROM n)
SELECT id, CASE WHEN rn <= floor(share) + CASE WHEN place <= spare THEN 1 ELSE 0 END THEN 'test' ELSE 'train' END AS split
FROM r JOIN n2 ON n2.query_type = r.query_type"""


@register("stratified_split", "F", _D_STRAT)
def q_strat(spark, sf_dir):
    c = cleaned_corpus(spark, sf_dir).select("id", "query_type")
    return OS.train_test_split(c, 0.85, 42, stratify="query_type").select("id", "split")


@register("sample_n", "F", D_CLEANED + "SELECT id FROM cleaned ORDER BY md5('42:' || id), id LIMIT 100")
def q_sample(spark, sf_dir):
    return OS.sample_n(cleaned_corpus(spark, sf_dir).select("id"), 100, 42)


@register("split_shares", "F", "WITH s AS (" + _d_split().replace("\n)\nSELECT", ")\nSELECT") + f""")
SELECT split, COUNT(*) AS rows, {d6('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM s)')} AS percentage FROM s GROUP BY split""")
def q_shares(spark, sf_dir):
    s = OS.split_shares(OS.train_test_split(cleaned_corpus(spark, sf_dir).select("id"), 0.85, 42))
    return s.select("split", "rows", r6("percentage").alias("percentage"))
