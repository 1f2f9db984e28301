"""Property-graph schema profile.

A graph is two DataFrames: ``nodes(id, labels array<string>, props map<string,string>)`` and
``edges(src, dst, type, props map<string,string>)``. Every list produced here is a list of
distinct schema names (labels, types, keys): its size is bounded by the schema, not the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def node_labels(nodes: DataFrame) -> DataFrame:
    """L1: distinct node labels."""
    return nodes.select(F.explode("labels").alias("label")).distinct()


def relationship_types(edges: DataFrame) -> DataFrame:
    """L2: distinct relationship types."""
    return edges.select(F.col("type").alias("rel_type")).distinct()


def property_keys(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """L3: distinct property keys over nodes and edges."""
    nk = nodes.select(F.explode(F.map_keys("props")).alias("property_key"))
    ek = edges.select(F.explode(F.map_keys("props")).alias("property_key"))
    return nk.union(ek).distinct()


def _key_pairs(df: DataFrame, group: str, sample: int | None) -> DataFrame:
    """Distinct (group, key) pairs in one pass; a group without keys keeps one (group, null)."""
    if sample is not None:
        w = Window.partitionBy(group).orderBy(F.md5("__id"), "__id")
        df = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= sample)
    return df.select(group, F.explode_outer(F.map_keys("props")).alias("k")).distinct()


def _collect_keys(pairs: DataFrame, group: str) -> DataFrame:
    # collect_list skips the null key of key-less groups: they get an empty list
    return pairs.groupBy(group).agg(F.sort_array(F.collect_list("k")).alias("properties"))


def node_key_pairs(nodes: DataFrame, sample: int | None = None) -> DataFrame:
    per = nodes.select(F.col("id").alias("__id"), F.explode("labels").alias("label"), "props")
    return _key_pairs(per, "label", sample)


def relationship_key_pairs(edges: DataFrame, sample: int | None = None) -> DataFrame:
    per = edges.select(F.concat_ws("|", "src", "dst", "type", F.to_json("props")).alias("__id"),
                       F.col("type").alias("rel_type"), "props")
    return _key_pairs(per, "rel_type", sample)


def node_properties(nodes: DataFrame, sample: int | None = None) -> DataFrame:
    """L4: per label, the sorted property keys seen (in ``sample`` nodes per label when given,
    chosen by id hash; the reference looks at any 100)."""
    return _collect_keys(node_key_pairs(nodes, sample), "label")


def relationship_properties(edges: DataFrame, sample: int | None = None) -> DataFrame:
    """Per relationship type, the sorted property keys seen."""
    return _collect_keys(relationship_key_pairs(edges, sample), "rel_type")


def schema_summary(nodes: DataFrame, edges: DataFrame, sample: int | None = None) -> DataFrame:
    """The five parts as rows ``(kind, name, properties)``.

    Each side is read once into distinct (name, key) pairs. Each pair gives a row for its label or
    type and one for its key, so all five parts come from one grouping of the pairs.
    """
    pairs = node_key_pairs(nodes, sample).select(F.lit("node_label").alias("kind"), F.col("label").alias("name"), "k").unionByName(
        relationship_key_pairs(edges, sample).select(F.lit("relationship_type").alias("kind"), F.col("rel_type").alias("name"), "k"))
    none = F.lit(None).cast("string")
    parts = pairs.select(F.explode(F.array(
        F.struct("kind", "name", "k"),
        F.struct(F.lit("property_key").alias("kind"), F.col("k").alias("name"), none.alias("k")))).alias("p")).select("p.*")
    # keys are property names: their number is bounded by the schema
    return parts.filter(F.col("name").isNotNull()).groupBy("kind", "name").agg(F.sort_array(F.collect_set("k")).alias("properties"))


def render_schema(summary: DataFrame) -> DataFrame:
    """The prompt text of a schema summary, one row (size bounded by the schema)."""
    def section(kind: str) -> F.Column:
        items = F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("name", "properties"))))
        return F.transform(items, lambda x: F.concat(
            F.lit("- "), x["name"],
            F.when(F.size(x["properties"]) > 0, F.concat(F.lit(": "), F.array_join(x["properties"], ", "))).otherwise(F.lit("")),
        ))

    agg = summary.agg(
        section("node_label").alias("nodes"),
        section("relationship_type").alias("rels"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == "property_key", F.col("name")))).alias("keys"),
    )
    parts = F.concat(
        F.when(F.size("nodes") > 0, F.array_insert(F.col("nodes"), 1, F.lit("## Node Labels and Properties:"))).otherwise(
            F.array().cast("array<string>")),
        F.when(F.size("rels") > 0, F.array_insert(F.col("rels"), 1, F.lit("\n## Relationship Types and Properties:"))).otherwise(
            F.array().cast("array<string>")),
        F.when(F.size("keys") > 0, F.array(F.lit("\n## All Property Keys:"), F.array_join("keys", ", "))).otherwise(
            F.array().cast("array<string>")),
    )
    return agg.select(F.array_join(parts, "\n").alias("schema_text"))


def node_count(nodes: DataFrame) -> DataFrame:
    """Number of nodes."""
    return nodes.agg(F.count(F.lit(1)).alias("node_count"))
