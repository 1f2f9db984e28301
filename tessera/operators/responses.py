"""Prompt assembly per case."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's -------------------------------------------
SCHEMA_HEADER = "\n\n# Neo4j Database Schema\n\nThe Neo4j database has the following schema:\n\n"
SCHEMA_FOOTER = (
    "\n\nUse this schema information when generating Cypher queries to ensure you reference the "
    "correct node labels, relationship types, and properties."
)
SCHEMA_FAILURE_MARKERS = ["could not be retrieved", "Schema loading failed"]
# ---------------------------------------------------------------------------------------------


def build_messages(df: DataFrame, system_prompt, description_col: str = "description") -> DataFrame:
    """Add ``messages``: [system prompt, user description] as (role, content) structs.

    ``system_prompt`` is a string or a Column (e.g. from :func:`with_schema`).
    """
    sp = F.lit(system_prompt) if isinstance(system_prompt, str) else system_prompt
    return df.withColumn(
        "messages",
        F.array(
            F.struct(F.lit("system").alias("role"), sp.alias("content")),
            F.struct(F.lit("user").alias("role"), F.col(description_col).alias("content")),
        ),
    )


def with_schema(df: DataFrame, system_prompt: str, schema_text: DataFrame) -> DataFrame:
    """Add ``system_prompt``: the prompt with the rendered schema section appended.

    ``schema_text`` is the one-row output of ``graph_profile.render_schema``; it is joined by
    broadcast (one row by construction). An empty or failed schema leaves the prompt unchanged.
    """
    t = F.col("__schema")
    ok = t.isNotNull() & (t != "")
    for m in SCHEMA_FAILURE_MARKERS:
        ok = ok & ~t.contains(m)
    one = F.broadcast(schema_text.select(F.col(schema_text.columns[0]).alias("__schema")))
    full = F.when(ok, F.concat(F.lit(system_prompt), F.lit(SCHEMA_HEADER), t, F.lit(SCHEMA_FOOTER))).otherwise(
        F.lit(system_prompt)
    )
    return df.crossJoin(one).withColumn("system_prompt", full).drop("__schema")
