"""Shared helpers of the ``llm`` operators: reading tables, cutting lineage, words and hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import ensure_checkpoint_dir

# White space of the word definition `[^\x20\x09-\x0D]+` (Java and RE2 class body).
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Spark removes a query's shuffle files when it ends, not when its objects are found to be garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows to the shared checkpoint folder and go on from there.

    The shuffles that led here are not needed again: their files go as soon as the rows are written.
    A collection in the driver lets Spark's cleaner remove checkpoints no longer referred to.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    was = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        out = df.select("*").checkpoint(eager=True)  # a query takes the setting when it is made
    finally:
        spark.conf.set(CLEANUP, was)
    del df  # else what it reads is held until the next cut
    spark.sparkContext._jvm.System.gc()
    return out


def words(text: Column) -> Column:
    """Words of a text as an array (null and blank texts: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters neighbouring values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def mix32(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit integers that scatters neighbouring values."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x21F0AAAD)
    x = x ^ (x >> np.uint32(15))
    x = x * np.uint32(0xD35A2D97)
    return x ^ (x >> np.uint32(15))


_SEED = np.random.default_rng(20240501)
_BYTE_VALUE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE_VALUE[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]
_IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, kept between calls up to 8 MB."""
    if len(_POWERS[0]) < n:
        both = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x))
        if n > 1 << 20:
            return both[0], both[1]
        _POWERS[:] = both
    return _POWERS[0][:n], _POWERS[1][:n]


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and where each begins (one more offset at the end)."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    return data, at - at[0]


def word_places(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end byte of every word `[^\\x20\\x09-\\x0D]+`; no word crosses texts."""
    full = ~_IS_SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[at] = True
    empty = np.concatenate([[True], ~full, [True]])
    begin = np.flatnonzero(full & (empty[:-2] | border[:-1]))
    end = np.flatnonzero(full & (empty[2:] | border[1:])) + 1
    return begin, end


def word_hashes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in a row, and where each text's words begin.

    A word's hash is a polynomial of its bytes' random values, taken from one running sum.
    """
    data, at = raw_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    begin, end = word_places(data, at)
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE_VALUE)[data] * up, out=total[1:])
    hashes = mix64((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(begin, at)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20, row_bytes: int = 0):
    """A batch in slices of about ``max_bytes`` of one text column, each row counted as ``row_bytes``
    more, so that work arrays stay small."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + row_bytes
    part = np.concatenate([[0], np.cumsum(size)[:-1]]) // max_bytes if len(size) else size
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]]).astype(int)
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values (runs may cross texts; callers cut them)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = mix64(out + hashes[i:len(hashes) - n + 1 + i])
    return out


def shingle_sets(texts: pa.Array, n: int = 5) -> list[np.ndarray]:
    """Distinct word-shingle hashes (sorted) of each text.

    A text with fewer than ``n`` words has its whole word sequence as its one shingle; a text
    without words has none.
    """
    hashes, starts = word_hashes(texts, lower=True)
    runs = grams(hashes, n)
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= n:
            out.append(np.unique(runs[a:b - n + 1]))
        elif b > a:
            out.append(grams(hashes[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
