"""A bitmap of hashed 64-bit keys, to leave rows without a partner out of a shuffle.

The bitmap has a fixed number of bits (4 MB), so broadcasting it is safe at any input size. A key
that is in the set always passes; another one passes by chance, the more often the fuller the
bitmap, so it only saves work and an exact join always follows (an inner join with distinct keys:
the optimiser would move a semi-join below the test). It is made by a partial ``bit_or``
per word of 64 bits and put together into one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(11), key), F.lit(BITS))


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """One row with one array of BITS / 64 longs."""
    spark = keys.sparkSession
    at = keys.select(_place(F.col(key)).alias("p"))
    words = (at.select(F.shiftright("p", 6).alias("i"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
             .groupBy("i").agg(F.bit_or("b").alias("b")))
    every = spark.range(BITS // 64).withColumnRenamed("id", "i").join(words, "i", "left")
    # blocks of 1024 words are put together side by side, then the 512 blocks
    block = (every.groupBy(F.shiftright("i", 10).alias("k"))
             .agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("w"))
             .select("k", F.transform("w", lambda x: x["b"]).alias("w")))
    return block.agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("k", "w"))), lambda x: x["w"])).alias("bits_"))


def _bit(key: str) -> Column:
    p = _place(F.col(key))
    return F.getbit(F.get(F.col("bits_"), F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int"))


def maybe_in(rows: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """Rows whose key may be in the bitmap."""
    return rows.join(F.broadcast(bits), _bit(key) == 1).select(*rows.columns)


def not_in(rows: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """Rows whose key is surely not in the bitmap; the others are those of ``maybe_in``."""
    return rows.join(F.broadcast(bits), _bit(key) == 0).select(*rows.columns)
