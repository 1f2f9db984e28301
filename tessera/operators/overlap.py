"""Entities whose target sets overlap (N18), by a prefix-filtered set-overlap join.

Two entities are linked when 100 * |A and B| >= percent * |A or B| over their distinct targets.

1. Entities of at most ``WIDE`` edges or targets have their set in one row, in one global order of
   targets by rising degree; those with equal sets are one class, named by its least entity. Links
   are given between classes, entities by membership, so thousands of equal entities never become
   pairs.
2. Sets of n and m targets need a common part of ``alpha = ceil(percent * (n + m) / (100 + percent))``,
   so their first common target in that order has at least ``alpha`` targets from it on, in both.
   Only these rare first targets are indexed: a hub is last in every order and is indexed only for
   sets that are small enough to need it.
3. The larger set looks for partners under (target, size bucket), within the sizes the threshold
   allows and with the targets that a partner of that size could share first. Before a candidate
   leaves the join, positions and a 64-bit sketch of both sets bound the common part from above;
   neither bound can lose a link.
4. A (target, bucket) group with more than ``BLOCK`` rows on a side is dealt in blocks of both sides.
5. Candidates are verified by intersecting the two sets.
6. Sets of more than ``WIDE`` targets are never collected: equal ones are found by order-free hash
   sums, their targets are ranked by rows, and their pairs (with each other and with the sets that are
   large enough) are verified by counting the smaller set's targets in the larger set, by joins.

Null nodes and targets are no part of any set. Repeated edges count once. Entities without a
partner are in ``members`` only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.session import checkpointed
from .graph_match import directed
from .positions import rank_in_groups

BLOCK = 2000
GROWTH = 1.1  # sizes of a bucket differ by less than this factor,
EXACT = 10  # and up to this size a bucket is one size
WIDE = 1000
FEW = 500_000  # so many targets at most are broadcast


def _bucket(n: Column) -> Column:
    steps = F.floor(F.log(n / F.lit(EXACT)) / F.lit(math.log(GROWTH)) + F.lit(1e-9))
    return F.when(n <= EXACT, n).otherwise(EXACT + steps).cast("int")


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long")


def _alpha(n: Column, m: Column, percent: int) -> Column:
    """The least common part of linked sets of n and m targets."""
    return _ceil_div((n + m) * percent, 100 + percent)


def _bit(target: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(target), F.lit(64)).cast("int"))


def _common(x: str, y: str) -> Column:
    """The most targets that two sets can have in common, by their sketches."""
    only = lambda a, b: F.bit_count(F.col(f"{a}bits").bitwiseAND(F.bitwise_not(F.col(f"{b}bits"))))
    return F.least(F.col(f"{x}n") - only(x, y), F.col(f"{y}n") - only(y, x))


def target_classes(sets: DataFrame) -> DataFrame:
    """``sets(node, target)``, distinct -> (node, n, class, class_size): entities with equal sets are one class."""
    h1 = F.xxhash64("target").cast("decimal(38,0)")
    h2 = F.xxhash64(F.lit("#"), "target").cast("decimal(38,0)")
    sums = sets.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum(h1).alias("s1"), F.sum(h2).alias("s2"))
    classes = sums.groupBy("n", "s1", "s2").agg(F.min("node").alias("class"), F.count(F.lit(1)).alias("class_size"))
    return sums.join(classes, ["n", "s1", "s2"]).select("node", "n", "class", "class_size")


def _dealt(probes: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a block number on each side: groups within ``BLOCK`` rows have one block."""
    key = ["target", "bucket"]
    counts = lambda side, n: side.groupBy(*key).agg(F.count(F.lit(1)).alias(n))
    hot = (counts(probes, "r").join(counts(index, "m"), key)
           .select(*key, F.ceil(F.col("r") / BLOCK).alias("rb"), F.ceil(F.col("m") / BLOCK).alias("mb")).filter("rb > 1 OR mb > 1"))
    hot = checkpointed(hot)
    one = lambda c: F.coalesce(F.col(c), F.lit(1).cast("long"))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), one(c) - 1))
    own = lambda seed, c: F.pmod(F.xxhash64(F.lit(seed), "node"), one(c))
    p = probes.join(hot, key, "left").withColumn("rc", own(1, "rb")).withColumn("mc", every("mb")).drop("rb", "mb")
    i = index.join(hot, key, "left").withColumn("mc", own(2, "mb")).withColumn("rc", every("rb")).drop("rb", "mb")
    return p, i


def ranked_sets(sets: DataFrame) -> DataFrame:
    """``sets(node, target, n)`` -> (node, target, n, pos, bits), pos by rising degree; no set is collected."""
    degree = sets.groupBy("target").agg(F.count(F.lit(1)).alias("degree"))
    bits = sets.groupBy("node").agg(F.bit_or(_bit(F.col("target"))).alias("bits"))
    ranked = rank_in_groups(sets.join(degree, "target"), ["node"], ["degree", "target"])
    return checkpointed(ranked.select("node", "target", "n", "pos").join(bits, "node"))


def candidates(ranked: DataFrame, percent: int, above: int = 0) -> DataFrame:
    """Pairs (a, b) of ``ranked(node, target, n, pos, bits)``, no two sets equal, that may meet the threshold;
    n_a >= n_b and n_a > ``above``."""
    n, pos, bucket = F.col("n"), F.col("pos"), F.col("bucket")
    least = _ceil_div(n * percent, 100)
    # the smaller set of a pair needs at least the common part of two sets of its size
    index = ranked.filter(pos <= n - _alpha(n, n, percent)).withColumn("bucket", _bucket(n))
    probes = (ranked.filter((n > above) & (pos <= n - least))
              .withColumn("bucket", F.explode(F.sequence(_bucket(least), _bucket(n)))))
    need = _alpha(n, F.when(bucket <= EXACT, bucket).otherwise(least), percent)
    # a common part of n targets would be an equal set
    probes = probes.filter((pos <= n - need) & (need < n))
    probes, index = _dealt(probes, index)
    key = ["target", "bucket", "rc", "mc"]
    x = probes.select(*key, *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "pos", "bits")])
    y = index.select(*key, *[F.col(c).alias(f"y_{c}") for c in ("node", "n", "pos", "bits")])
    total = (F.col("x_n") + F.col("y_n")) * percent
    enough = lambda common: common * (100 + percent) >= total  # common >= alpha, without a division
    larger = (F.col("x_n") > F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_node") < F.col("y_node")) & enough(F.col("x_n") - 1))
    reach = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    met = enough(reach) & larger & enough(_common("x_", "y_"))
    return x.join(y, key).filter(met).select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct()


def _targets(edges: DataFrame, types, direction: str) -> DataFrame:
    return (directed(edges, types, direction).select("node", F.col("other").alias("target"))
            .filter("node IS NOT NULL AND target IS NOT NULL"))


def target_sets(edges: DataFrame, types=None, direction: str = "out") -> DataFrame:
    """Distinct (node, target) over the edges of ``types``."""
    return _targets(edges, types, direction).distinct()


def target_ranks(rows: DataFrame) -> DataFrame:
    """(target, rank): numbers in the order of rising degree."""
    degree = rows.groupBy("target").agg(F.count(F.lit(1)).alias("degree"))
    ranks = checkpointed(degree.orderBy("degree", "target").select("target", F.monotonically_increasing_id().alias("rank")))
    return F.broadcast(ranks) if ranks.count() <= FEW else ranks


def narrow_classes(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """``rows(node, target)``, few a node -> (id, node, n, targets, bits), one row a class, its target ranks in order."""
    sets = (rows.join(ranks, "target").select("node", "rank").repartition("node").groupBy("node")
            .agg(F.sort_array(F.collect_set("rank")).alias("targets")))
    keyed = sets.select("node", "targets", F.size("targets").cast("long").alias("n"), F.xxhash64("targets").alias("h1"),
                        F.xxhash64(F.lit("#"), "targets").alias("h2"))
    classes = keyed.groupBy("n", "h1", "h2").agg(F.min("node").alias("node"), F.first("targets").alias("targets"))
    bits = F.aggregate("targets", F.lit(0).cast("long"), lambda b, t: b.bitwiseOR(_bit(t)))
    return checkpointed(classes.select(F.monotonically_increasing_id().alias("id"), "node", "n", "targets", bits.alias("bits")))


def _narrow_links(classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b, n_a, n_b, n_both) between ``narrow_classes``."""
    first = F.slice("targets", F.lit(1), (F.col("n") - _ceil_div(F.col("n") * percent, 100) + 1).cast("int"))
    found = candidates(classes.select(F.col("id").alias("node"), "n", "bits", F.posexplode(first).alias("pos", "target")), percent)
    side = lambda c: classes.select(F.col("id").alias(f"id_{c}"), F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("targets").alias(f"t_{c}"))
    found = checkpointed(found).toDF("id_a", "id_b").join(side("a"), "id_a").join(side("b"), "id_b")
    return found.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("t_a", "t_b")).cast("long").alias("n_both"))


def _wide_links(classes: DataFrame, ranks: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """Links (a, b, n_a, n_b, n_both) of the sets of ``wide(node, target)`` with each other and with ``narrow_classes``."""
    reps = checkpointed(target_classes(wide).filter("node = class").select("node", "n"))
    enough = classes.filter(100 * F.col("n") >= percent * F.lit(WIDE + 1))
    held = checkpointed(wide.join(reps, "node").join(ranks, "target").select("node", F.col("rank").alias("target"), "n")
                        .unionByName(enough.select("node", F.explode("targets").alias("target"), "n")))
    reps = reps.unionByName(enough.select("node", "n"))
    found = checkpointed(candidates(ranked_sets(held), percent, WIDE))
    small = held.select(F.col("node").alias("b"), "target")
    large = held.select(F.col("node").alias("a"), "target")
    both = found.join(small, "b").join(large, ["a", "target"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_both"))
    side = lambda c: reps.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"))
    return both.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "n_both")


def shared_targets(edges: DataFrame, types=None, *, percent: int, direction: str = "out") -> tuple[DataFrame, DataFrame]:
    """(pairs, members): linked classes (a, b, n_a, n_b, n_both), a < b, and (node, n, class, class_size)."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    rows = _targets(edges, types, direction)
    name = F.xxhash64("node")  # a shared hash only sends more nodes to the exact count
    busy = checkpointed(rows.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > WIDE).select("name"))
    ranks = target_ranks(rows)
    wide = None
    if not busy.isEmpty():
        # many edges need not be many targets
        sets = checkpointed(rows.join(busy, name == F.col("name"), "left_semi").distinct())
        sizes = checkpointed(sets.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > WIDE).select("node"))
        wide = checkpointed(sets.join(sizes, "node", "left_semi"))
        rows = rows.join(busy, name == F.col("name"), "left_anti").unionByName(sets.join(sizes, "node", "left_anti"))
    classes = narrow_classes(rows, ranks)
    linked = _narrow_links(classes, percent)
    if wide is not None and not wide.isEmpty():
        linked = linked.unionByName(_wide_links(classes, ranks, wide, percent))
    linked = linked.filter(100 * F.col("n_both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("n_both")))
    swap = F.col("a") > F.col("b")
    turned = lambda p, q: F.when(swap, F.col(q)).otherwise(F.col(p))
    pairs = linked.select(turned("a", "b").alias("a"), turned("b", "a").alias("b"), turned("n_a", "n_b").alias("n_a"),
                          turned("n_b", "n_a").alias("n_b"), "n_both")
    return pairs, target_classes(target_sets(edges, types, direction))
