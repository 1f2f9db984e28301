"""Versioned folders: several datasets that become visible together.

A version's parts are written below ``data/<version>``; then one row that names the version and its
parts' paths is written as ``manifest/version=<n>``. That row is a single file, which the store
shows whole or not at all, and it is written last: a failure anywhere before it leaves readers with
the last whole version. Nothing is written into an older version, so a job may read one version
while it writes the next. Old versions stay until ``clean`` removes them.

One writer at a time: two writers of one folder take the same number, and the second is refused.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("errorifexists", "append", "overwrite")
_ROW = "name string, format string, paths map<string,string>"


@dataclass(frozen=True)
class Version:
    number: int
    format: str
    paths: dict[str, str]


def all_versions(spark: SparkSession, directory: str) -> list[Version]:
    """All whole versions, oldest first (one small row each)."""
    try:
        rows = spark.read.schema(f"{_ROW}, version long").json(os.path.join(directory, "manifest")).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((Version(r.version, r.format, dict(r.paths)) for r in rows), key=lambda v: v.number)


def last_version(spark: SparkSession, directory: str) -> Version | None:
    found = all_versions(spark, directory)
    return found[-1] if found else None


def write_version(parts: dict[str, DataFrame | Callable[[dict[str, DataFrame]], DataFrame]], directory: str, fmt: str = "json",
                  mode: str = "append", compression: str | None = None) -> Version:
    """Write all parts, then the manifest row that makes them the last version.

    A part may be a function of the parts written before it, read back from where they were
    written, so that what they cost is not spent again. The first part is a DataFrame.
    ``compression`` is the format's own option; readers tell it from the files' names.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if not parts:
        raise ValueError("a version needs a part")
    spark = next(iter(parts.values())).sparkSession
    last = last_version(spark, directory)
    if last is not None and mode == "errorifexists":
        raise ValueError(f"{directory} holds version {last.number} already")
    number, name = (last.number + 1 if last else 1), uuid.uuid4().hex
    paths = {p: os.path.join(directory, "data", name, p) for p in parts}
    written, wanted = {}, any(callable(df) for df in parts.values())
    for p, df in parts.items():
        df = df(written) if callable(df) else df
        df.write.format(fmt).options(**({"compression": compression} if compression else {})).save(paths[p])
        if wanted:
            written[p] = spark.read.schema(df.schema).format(fmt).load(paths[p])
    row = spark.range(1).select(F.lit(name).alias("name"), F.lit(fmt).alias("format"),
                                F.create_map(*[F.lit(x) for kv in paths.items() for x in kv]).alias("paths"))
    row.write.mode("errorifexists").json(os.path.join(directory, "manifest", f"version={number}"))
    return Version(number, fmt, paths)


def read_part(spark: SparkSession, directory: str, part: str, number: int | None = None) -> DataFrame:
    """A part of the last whole version, or of a given one."""
    found = {v.number: v for v in all_versions(spark, directory)}
    if not found:
        raise ValueError(f"{directory} holds no whole version")
    v = found.get(max(found) if number is None else number)
    if v is None or part not in v.paths:
        raise ValueError(f"{directory} has no part {part} in version {number}")
    return spark.read.format(v.format).load(v.paths[part])


def clean(spark: SparkSession, directory: str, keep: int = 1) -> list[int]:
    """Remove all but the last ``keep`` versions, the manifest row first; gives the removed numbers.

    Uses the store's own file system, so it needs a classic (not a Connect) session. Data of
    versions that never became whole goes too, so no writer may be at work.
    """
    if keep < 1:
        raise ValueError("keep must be 1 or more")
    every = all_versions(spark, directory)
    gone, stay = every[:-keep], every[-keep:]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda *x: jvm.org.apache.hadoop.fs.Path(os.path.join(directory, *x))
    fs = path().getFileSystem(conf)
    for v in gone:
        fs.delete(path("manifest", f"version={v.number}"), True)
    held = {os.path.basename(os.path.dirname(p)) for v in stay for p in v.paths.values()}
    if every:
        for f in fs.listStatus(path("data")):
            if f.getPath().getName() not in held:
                fs.delete(f.getPath(), True)
    return [v.number for v in gone]
