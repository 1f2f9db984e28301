"""Canonical form of records of no common schema (I2 on untyped records), over VARIANT.

Records are JSON texts whose keys and types may differ from row to row. The canonical text has

- keys sorted at every level (VARIANT keeps them so);
- lists of only texts, or of only numbers and truth values, sorted (texts by code point, numbers by
  value with false as 0 and true as 1, equal ones in their old order);
- all other lists in their order: mixed scalars, nulls, lists in lists; records in lists are canonical
  themselves, lists inside a list keep their order at every depth;
- numbers as VARIANT writes them (``1.50`` as ``1.5``, ``1.0`` as ``1``, exponents as doubles), nulls
  written out. Of equal keys in one object the read stops.

A record without a list is its VARIANT's text. Others are opened level by level: one row per value of
an open level, so the rounds are the depth of the deepest record that holds lists, whatever the
number of records. The texts are put together from the deepest level up; a group is one container of
one record. Text that is not JSON stops the job; null gives null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.session import checkpointed


def _kind(js: Column) -> Column:
    """One letter: {, [, s (text), n (number or truth value), or - (null)."""
    c = F.substring(js, 1, 1)
    return F.when(c.isin("{", "["), c).when(c == '"', "s").when(js == "null", "-").otherwise("n")


def _is_open(js: Column) -> Column:
    """Values with a list inside still have to be opened; an empty list has nothing to sort."""
    return F.substring(js, 1, 1).isin("{", "[") & F.contains(js, F.lit("[")) & (js != "[]")


def _number(v: Column) -> Column:
    """A number's order: its value, exact where it is integral."""
    return F.struct(F.coalesce(F.try_variant_get(v, "$", "double"), F.try_variant_get(v, "$", "boolean").cast("double")).alias("about"),
                    F.try_variant_get(v, "$", "decimal(38,0)").alias("exact"))


def canonical_json(df: DataFrame, record: str, name: str = "record") -> DataFrame:
    """Add ``name``: the canonical text of the JSON text column ``record``; other columns pass through."""
    rows = checkpointed(df.withColumn("__id", F.monotonically_increasing_id()).withColumn("__text", F.col(record)))
    read = rows.select("__id", F.parse_json("__text").alias("v")).filter("v IS NOT NULL")
    level = checkpointed(read.select("__id", F.lit("").alias("path"), F.lit("").alias("up"), F.lit(0).alias("pos"), F.lit(None).cast("string").alias("key"),
                                     F.to_json("v").alias("js"), F.when(_is_open(F.to_json("v")), F.col("v")).alias("v")))
    levels = [level]
    while not level.filter("v IS NOT NULL").isEmpty():
        held = level.filter("v IS NOT NULL").select("__id", F.col("path").alias("up"), "v", _kind(F.col("js")).alias("in"))
        children = held.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()).select(
            F.col("pos").alias("c_pos"), F.col("key").alias("c_key"), F.col("value").alias("c_v")))
        js = F.to_json("c_v")
        # a list inside a list stays as it is
        opens = _is_open(js) & ~((F.col("in") == "[") & js.startswith("["))
        level = checkpointed(children.select(
            "__id", F.concat("up", F.lit("/"), F.col("c_pos").cast("string")).alias("path"), "up", F.col("c_pos").alias("pos"),
            F.col("c_key").alias("key"), js.alias("js"), F.when(opens, F.col("c_v")).alias("v"),
            F.when((F.col("in") == "[") & (_kind(js) == "n"), _number(F.col("c_v"))).alias("num"),
            F.when((F.col("in") == "[") & (_kind(js) == "s"), F.try_variant_get("c_v", "$", "string")).alias("str")))
        levels.append(level)
    done = None  # (__id, path, js) of the containers that were opened, one level deeper
    for level in reversed(levels):
        if done is not None:
            fresh = done.withColumnRenamed("js", "new")
            level = level.join(fresh, ["__id", "path"], "left").withColumn("js", F.coalesce("new", "js")).drop("new")
        if level is levels[0] or "num" not in level.columns:
            done = level.select("__id", "js")
            break
        item = F.struct("pos", "key", "js", "num", "str", _kind(F.col("js")).alias("kind"))
        group = level.groupBy("__id", "up").agg(F.sort_array(F.collect_list(item)).alias("items"))
        items = F.col("items")
        all_of = lambda k: F.forall(items, lambda x: x["kind"] == k)
        texts = F.transform(F.sort_array(F.transform(items, lambda x: F.struct(x["str"], x["pos"], x["js"].alias("js")))), lambda x: x["js"])
        numbers = F.transform(F.sort_array(F.transform(items, lambda x: F.struct(x["num"], x["pos"], x["js"].alias("js")))), lambda x: x["js"])
        listed = F.when(all_of("s"), texts).when(all_of("n"), numbers).otherwise(F.transform(items, lambda x: x["js"]))
        named = F.transform(items, lambda x: F.concat(F.regexp_replace(F.to_json(F.array(x["key"])), r"(?s)\A\[(.*)\]\z", "$1"), F.lit(":"), x["js"]))
        is_list = F.get(items, F.lit(0))["key"].isNull()
        text = F.when(is_list, F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]"))).otherwise(
            F.concat(F.lit("{"), F.array_join(named, ","), F.lit("}")))
        done = group.select("__id", F.col("up").alias("path"), text.alias("js"))
    return rows.join(done.withColumnRenamed("js", "__js"), "__id", "left").select(
        *[c for c in df.columns if c != name], F.col("__js").alias(name))
