"""Registered queries of group M, over traces derived from whole conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import training as TR
from . import fixtures as X
from .registry import register

_TR = X.duck_cte(traces=X.TRACES_SQL)
_SPLIT = _TR + """
, r AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || id), id) AS rn, COUNT(*) OVER () AS n FROM traces)
, sp AS (SELECT *, CASE WHEN rn <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train'
    WHEN rn <= floor(n * CAST(0.8 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM r)
"""


@register("format_instruction", "M", _TR + f"""
SELECT id, '{TR.INSTRUCTION}' AS instruction, coalesce(description, '') AS input, coalesce(query, '') AS output FROM traces""")
def q_instruction(spark, sf_dir):
    return TR.to_format(X.traces(spark, sf_dir), "instruction")


@register("format_conversation", "M", _TR + """
SELECT id, to_json([{'role': 'user', 'content': coalesce(description, '')},
                    {'role': 'assistant', 'content': coalesce(query, '')}]) AS messages FROM traces""")
def q_conversation(spark, sf_dir):
    c = TR.to_format(X.traces(spark, sf_dir), "conversation")
    return c.select("id", F.to_json("messages").alias("messages"))


@register("format_cot", "M", _TR + """
SELECT id, coalesce(description, '') AS prompt,
  CASE WHEN coalesce(reasoning_trace, '') = '' THEN coalesce(query, '')
       ELSE reasoning_trace || chr(10) || chr(10) || coalesce(query, '') END AS completion FROM traces""")
def q_cot(spark, sf_dir):
    return TR.to_format(X.traces(spark, sf_dir), "cot")


@register("format_qa", "M", _TR + """
SELECT id, coalesce(description, '') AS question, coalesce(query, '') AS answer FROM traces""")
def q_qa(spark, sf_dir):
    return TR.to_format(X.traces(spark, sf_dir), "qa")


@register("three_way_split", "M", _SPLIT + "SELECT id, split FROM sp")
def q_three_way(spark, sf_dir):
    return TR.three_way_split(X.traces(spark, sf_dir).select("id"))


@register("few_shot", "M", _SPLIT + """
SELECT id, description, query FROM sp WHERE split = 'train' ORDER BY md5('42:' || id), id LIMIT 3""")
def q_few_shot(spark, sf_dir):
    return TR.few_shot(TR.three_way_split(X.traces(spark, sf_dir).select("id", "description", "query"))).drop("split")


@register("training_filter", "M", _TR + "SELECT id, description, query, source FROM traces WHERE length(description) >= 10")
def q_filter(spark, sf_dir):
    return TR.training_filter(X.traces(spark, sf_dir)).select("id", "description", "query", "source")


@register("training_manifest", "M", _SPLIT + """
SELECT format, split, COUNT(*) AS rows FROM sp, (SELECT unnest(['instruction', 'conversation', 'cot', 'qa']) AS format) f
GROUP BY format, split""")
def q_manifest(spark, sf_dir):
    return TR.manifest(TR.three_way_split(X.traces(spark, sf_dir).select("id")))
