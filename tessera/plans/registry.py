"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where the
operator is expressible in SQL, an independent DuckDB oracle text over the driver's views.

Outputs are flat: arrays are joined to text, scores rounded as ``floor(x * 1e6 + 0.5) / 1e6`` and
counts cast to BIGINT, so both engines print identical values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
GROUP: dict[str, str] = {}


def register(key: str, group: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        GROUP[key] = group
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def r6(c) -> Column:
    """Round a double to 6 digits, half away from zero, identically in Spark and DuckDB."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.floor(c * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)).cast("double")


def joined(c, sep: str = "|") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c, sep)


# DuckDB counterparts used inside oracle texts.
def d6(expr: str) -> str:
    return f"CAST(floor(CAST({expr} AS DOUBLE) * 1e6 + 0.5) / 1e6 AS DOUBLE)"


# Python whitespace for RE2 (DuckDB) patterns.
D_WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def d_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^[{D_WS}]+|[{D_WS}]+$', '', 'g')"


def d_collapse(expr: str) -> str:
    return f"regexp_replace({expr}, '[{D_WS}]+', ' ', 'g')"


def d_syntax(q: str, prefix: str = "") -> str:
    """DuckDB list of the light syntax errors of text ``q`` (keyword, then bracket balances)."""
    def bal(o, c):
        return f"((length({q}) - length(replace({q}, '{o}', ''))) - (length({q}) - length(replace({q}, '{c}', ''))))"
    return (
        "list_filter(["
        f"CASE WHEN NOT regexp_matches(upper({q}), 'MATCH|WHERE|RETURN|WITH|OPTIONAL|CREATE|DELETE|SET') "
        f"THEN '{prefix}No Cypher keywords found' END, "
        f"CASE WHEN {bal('(', ')')} <> 0 THEN '{prefix}Unbalanced parentheses (difference: ' || {bal('(', ')')} || ')' END, "
        f"CASE WHEN {bal('[', ']')} <> 0 THEN '{prefix}Unbalanced brackets (difference: ' || {bal('[', ']')} || ')' END, "
        f"CASE WHEN {bal('{', '}')} <> 0 THEN '{prefix}Unbalanced braces (difference: ' || {bal('{', '}')} || ')' END"
        "], lambda x: x IS NOT NULL)"
    )


def load_all() -> None:
    """Import every query module so their ``register`` calls run."""
    from . import (  # noqa: F401
        q_cleaning,
        q_profile,
        q_text,
        q_eval,
        q_graph,
        q_sinks,
        q_training,
    )
