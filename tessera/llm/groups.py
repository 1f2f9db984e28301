"""Candidate pairs of hash buckets, and the components they form (DataFrame operations only).

A bucket may hold a large part of all nodes, so no step lists all pairs of a bucket, collects a
bucket, or puts it into one window. Members meet the end nodes of their bucket, found by a partial
aggregate and joined back by an equi-join that AQE can split; those that are then still apart from
the bucket's largest component meet the whole bucket, in salted blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

BLOCK = 1000


def star_pairs(buckets: DataFrame) -> DataFrame:
    """``buckets(bucket, node)`` -> distinct ``(a, b)`` with ``a`` an end node of a shared bucket."""
    ends = (buckets.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
            .filter("lo < hi"))
    return (buckets.join(ends, "bucket")
            .select(F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("node").alias("b")),
                                      F.struct(F.col("hi").alias("a"), F.col("node").alias("b")))).alias("p"))
            .select("p.a", "p.b").filter("a <> b")
            .distinct())


def leftover_pairs(buckets: DataFrame, labels: DataFrame, held: DataFrame, near) -> DataFrame:
    """Pairs ``(a, b)`` of a bucket, ``a < b``, whose ends differ in component and are ``near``.

    ``buckets(bucket, node)``; ``labels(node, comp)`` of linked nodes; ``held(node, ...)`` has what
    ``near(x, y)`` reads of the two sides, prefixed with ``x`` and ``y``. Members outside a bucket's
    largest component meet all members of the bucket, in blocks of about ``BLOCK`` by ``BLOCK``;
    only near pairs leave the join.
    """
    named = buckets.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sizes = named.groupBy("bucket", "comp").agg(F.count("*").alias("k"))
    mixed = (sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.max("k").alias("top"), F.sum("k").alias("m"))
             .filter("m > top").select("bucket", "main", "m", (F.col("m") - F.col("top")).alias("r")))
    part = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "node"), F.ceil(F.col(count) / BLOCK))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(count) / BLOCK) - 1))
    rows = cut(named.join(mixed, "bucket").withColumn("rest", F.col("comp") != F.col("main")).drop("main").join(held, "node"))
    own = ["node", "comp", "rest", *[c for c in held.columns if c != "node"]]
    side = lambda p: [F.col(c).alias(f"{p}{c}") for c in own]
    queries = rows.filter("rest").withColumn("rc", part(1, "r")).withColumn("mc", every("m")).select("bucket", "rc", "mc", *side("x_"))
    members = rows.withColumn("mc", part(2, "m")).withColumn("rc", every("r")).select("bucket", "rc", "mc", *side("y_"))
    x, y = queries.alias("x"), members.alias("y")
    met = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("bucket", "rc", "mc")]
    return (x.join(y, [*met, F.col("x_comp") != F.col("y_comp"), ~F.col("y_rest") | (F.col("x_node") < F.col("y_node")), near("x_", "y_")])
            .select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """Connected components: ``edges(a, b)`` -> ``(node, comp)``, comp the least node reachable.

    Distributed union-find by alternating stars: large stars hang each node's larger neighbours
    under its least neighbour, small stars hang the smaller ones, until every component is a star
    around its least node (few rounds: path lengths shrink by a power each time). Each round is
    aggregates and joins on nodes; lineage is cut by a checkpoint. The loop ends when a round
    changes no edge, told by the count and two sums over hashes of the edges.
    """
    def canon(e: DataFrame) -> DataFrame:
        return (e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .filter("a < b").distinct())

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                     F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()

    e = cut(canon(edges))
    last = mark(e)
    while last[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # large star: each neighbour above u goes under min(u, its neighbours)
        large = canon(both.filter("b > a").join(least, "a")
                      .select(F.col("b"), F.least("a", "m").alias("a")))
        # small star: u and the neighbours below u go under the least of them
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = canon(large.join(down, "b").select("a", F.col("m").alias("b"))
                      .unionByName(down.select(F.col("b").alias("a"), F.col("m").alias("b"))))
        e = cut(small)
        now = mark(e)
        if now == last:
            break
        last = now
    return (e.select(F.col("b").alias("node"), F.col("a").alias("comp"))
            .unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("comp"))).distinct())
