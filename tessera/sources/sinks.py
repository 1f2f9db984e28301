"""Corpus and report writers (A6-A11). Every writer is a distributed ``DataFrameWriter`` call:
no part is collected to the driver, and JSON output is JSON Lines (one object per line).

Reports of several parts and corpora that replace themselves are versioned (``versions``): readers
see all parts of the last whole version, or of none.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame

from . import versions as V


def write_corpus(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Persist a (cleaned) corpus as parquet or JSON Lines."""
    df.write.mode(mode).format(fmt).save(path)
    return path


def write_report(parts: dict[str, DataFrame], directory: str, fmt: str = "json", mode: str = "errorifexists",
                 compression: str | None = None) -> dict:
    """One dataset per report part (dataset info, issues, duplicates, statistics...), as one version of ``directory``.

    A failure between parts leaves the last whole version the one that readers see. Gives each
    part's path; ``versions.read_part`` finds the last one's. With ``errorifexists`` a folder that
    has a version is refused; ``append`` and ``overwrite`` add one (old ones stay until cleaned).
    """
    return V.write_version(parts, directory, fmt, mode, compression).paths


def write_failures(rows: DataFrame, header: DataFrame, directory: str, mode: str = "errorifexists",
                   syntax: DataFrame | None = None) -> dict:
    """Failing rows, their one-row header (counts, validation type) and, of a run with
    pre-validation, the rows that failed it."""
    parts = {"failures": rows, "header": header} | ({"syntax_failures": syntax} if syntax is not None else {})
    return write_report(parts, directory, "json", mode)


def write_eval(cases: DataFrame, report: DataFrame | Callable[[DataFrame], DataFrame], directory: str, mode: str = "errorifexists") -> dict:
    """The full nested evaluation: cases (structs and lists kept) and the report row.

    ``report`` may be a function of the cases; it gets them as written, so they are evaluated once.
    A case holds its query in several forms, so the JSON Lines are written as gzip: one file a task."""
    later = (lambda written: report(written["cases"])) if callable(report) else report
    return write_report({"cases": cases, "report": later}, directory, "json", mode, "gzip")


def write_dedup(df: DataFrame, source_path: str, path: str, fmt: str = "parquet") -> str:
    """A10: write a deduplicated corpus. Over the path being read, that path has to be a versioned
    folder: the rows become its next version while the version being read stays as it is. A plain
    path is refused there (Spark would truncate its own input)."""
    if os.path.abspath(source_path.rstrip("/")) != os.path.abspath(path.rstrip("/")):
        return write_corpus(df, path, fmt)
    if V.last_version(df.sparkSession, path) is None:
        raise ValueError("write_dedup over the path being read needs a versioned folder (write_corpus_version)")
    return write_corpus_version(df, path, fmt)


def write_corpus_version(df: DataFrame, directory: str, fmt: str = "parquet") -> str:
    """A corpus as the next version of ``directory``; ``versions.read_part(.., "corpus")`` reads the last one."""
    return V.write_version({"corpus": df}, directory, fmt, "append").paths["corpus"]


def publish(df: DataFrame, directory: str, split_col: str = "split", fmt: str = "parquet",
            mode: str = "errorifexists") -> str:
    """Publish splits as one folder per split value (readers prune partitions by split).

    Each task writes its own rows of every split: nothing is shuffled, and a split that holds most
    rows is written by all tasks. Upload to a hub is not built (network)."""
    df.write.mode(mode).partitionBy(split_col).format(fmt).save(directory)
    return directory
