"""Corpus readers (A1-A5).

Large corpora are JSON Lines or parquet with one row per entry and an ``id`` column (the original
index), or JSON array files of any size (``json_array``); Spark splits all of them across tasks.
Text that is not JSON of the expected shape, and JSON Lines entries without an ``id``, stop the read
with an error in every mode.

Key presence is kept apart from null values by parsing each entry as ``map<string,string>``;
a null value counts as missing (the reference would fail on it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import py_strip
from .json_array import array_entries

MODES = ("strict", "skip", "default_desc", "defaults")


def _field(m: Column, key: str) -> Column:
    return F.try_element_at(m, F.lit(key))


def read_entries(spark: SparkSession, path: str, fmt: str = "auto") -> DataFrame:
    """Read raw entries as ``(id, description, query, source)``; absent keys become null."""
    if fmt == "auto":
        fmt = "parquet" if path.endswith(".parquet") else ("jsonl" if path.endswith(".jsonl") else "json")
    if fmt == "parquet":
        df = spark.read.parquet(path)
        for c in ("description", "query", "source"):
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("string"))
        if "id" not in df.columns:
            raise ValueError("parquet corpora need an id column holding the original index")
        return df.select(F.col("id").cast("long"), "description", "query", "source")
    entry = {"mode": "FAILFAST"}
    if fmt == "jsonl":
        lines = spark.read.text(path).filter(F.trim("value") != "")
        lines = lines.select("value", F.from_json("value", "map<string,string>", entry).alias("m"))
        idx = _field(F.col("m"), "id").try_cast("long")
        said = F.raise_error(F.concat(F.lit("Entry without an integer id: "), F.substring("value", 1, 200))).cast("boolean")
        # a filter, so that the check comes before any filter on the fields
        lines = lines.filter(F.when(idx.isNull(), said).otherwise(F.lit(True)))
        rows = lines.select(idx.alias("id"), "m")
    else:
        # a blank entry (after a trailing comma) is no JSON object: from_json would make it null without an error
        text = F.when(F.trim("entry", F.lit(" \t\r\n")) != "", F.col("entry")).otherwise(
            F.raise_error(F.lit("The corpus file has an empty entry")).cast("string"))
        rows = array_entries(spark, path).select("id", F.from_json(text, "map<string,string>", entry).alias("m"))
    return rows.select("id", *[_field(F.col("m"), c).alias(c) for c in ("description", "query", "source")])


def apply_read_mode(df: DataFrame, mode: str = "strict") -> DataFrame:
    """Apply one of the reference's four loader behaviours to raw entries.

    strict       (A1): fail when an entry lacks description or query; rows unchanged.
    skip         (A2): drop such entries; strip both; source default ``unknown``; id kept.
    default_desc (A3): keep entries with a query; description default ``No description provided.``;
                       source dropped.
    defaults     (A4): keep entries with a query; description default ``Query {id+1}``;
                       source default ``Unknown``.
    """
    d, q, s = F.col("description"), F.col("query"), F.col("source")
    if mode == "strict":
        bad = F.when(d.isNull(), F.lit("description")).when(q.isNull(), F.lit("query"))
        said = F.raise_error(F.concat(F.lit("Entry "), F.col("id").cast("string"), F.lit(" missing required field: "), bad))
        # a filter, so that no column pruning and no count() leaves the check out
        return df.filter(F.when(bad.isNotNull(), said.cast("boolean")).otherwise(F.lit(True))).select(
            "id", "description", "query", "source")
    if mode == "skip":
        return df.filter(d.isNotNull() & q.isNotNull()).select(
            py_strip(d).alias("description"),
            py_strip(q).alias("query"),
            F.coalesce(s, F.lit("unknown")).alias("source"),
            "id",
        )
    if mode == "default_desc":
        return df.filter(q.isNotNull()).select(
            "id", F.coalesce(d, F.lit("No description provided.")).alias("description"), "query"
        )
    if mode == "defaults":
        return df.filter(q.isNotNull()).select(
            "id",
            q.alias("query"),
            F.coalesce(d, F.concat(F.lit("Query "), (F.col("id") + 1).cast("string"))).alias("description"),
            F.coalesce(s, F.lit("Unknown")).alias("source"),
        )
    raise ValueError(f"mode must be one of {MODES}")


def read_corpus(spark: SparkSession, path: str, mode: str = "strict", fmt: str = "auto") -> DataFrame:
    """A1-A4: read a corpus file and apply a loader mode."""
    return apply_read_mode(read_entries(spark, path, fmt), mode)


def read_dataset(
    spark: SparkSession,
    name: str,
    split: str | None = None,
    config: str | None = None,
    split_col: str = "split",
    config_col: str = "config",
    required: tuple[str, ...] = ("description", "query"),
) -> DataFrame:
    """A5: load a named dataset: a catalog table, or a local parquet/JSON path; filter split/config.

    Hub downloads are not built (network). Filters on the columns reach the parquet scan.
    """
    if "/" in name or "." in name and name.split(".")[-1] in ("parquet", "json", "jsonl"):
        fmt = "json" if name.endswith((".json", ".jsonl")) else "parquet"
        df = spark.read.format(fmt).load(name)
    else:
        df = spark.table(name)
    if config is not None:
        df = df.filter(F.col(config_col) == config)
    if split is not None:
        df = df.filter(F.col(split_col) == split)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Dataset missing required columns: {missing}")
    return df


INPUT_PARTITIONS = "tessera.input.partitions"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-repartition an input where the session asks for it (``tessera.input.partitions``).

    A file of one row group is one scan task. A caller with few such files and many cores can set
    the number of partitions to deal the rows over before heavy per-row work; unset, inputs are
    read as they are. The choice is the caller's and does not depend on the input's size.
    """
    n = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n), F.col(key)) if n else df
