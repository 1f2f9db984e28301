"""Graph questions as DataFrame operators.

The reference hands these to a graph database; here a graph is ``nodes(id, labels, props)`` and
``edges(src, dst, type, props)`` and every hop is an equi-join on a node id. Hub nodes (one id
holding a large share of edges) are split by AQE's skew-join handling. Multi-hop operators
iterate on the driver only to build one join per hop and cut the lineage each hop with
``checkpoint()`` into the session's shared checkpoint folder. ``max_hops`` has no default; ``None``
goes on until no new pair is found. The work is per distinct start: pass each distinct place once
(say the nodes after a first hop) and join the origins to the result, instead of walking from every
origin.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..plans.session import checkpointed


def match_nodes(nodes: DataFrame, label: str, predicate: Column | None = None) -> DataFrame:
    """Nodes carrying ``label`` that satisfy ``predicate`` (on ``props``)."""
    df = nodes.filter(F.array_contains("labels", label))
    return df.filter(predicate) if predicate is not None else df


def _typed(edges: DataFrame, types: str | Sequence[str] | None) -> DataFrame:
    if types is None:
        return edges
    types = [types] if isinstance(types, str) else list(types)
    return edges.filter(F.col("type").isin(types))


def directed(edges: DataFrame, types=None, direction: str = "out") -> DataFrame:
    """Edges as (node, other) pairs in the requested direction; ``both`` is the union."""
    e = _typed(edges, types)
    out = e.select(F.col("src").alias("node"), F.col("dst").alias("other"), "type")
    inc = e.select(F.col("dst").alias("node"), F.col("src").alias("other"), "type")
    if direction == "out":
        return out
    if direction == "in":
        return inc
    if direction == "both":
        return out.unionByName(inc)
    raise ValueError("direction must be out, in or both")


def expand(frontier: DataFrame, edges: DataFrame, types=None, direction: str = "out", id_col: str = "id",
           optional: bool = False) -> DataFrame:
    """One hop from each frontier row: adds ``other`` (and ``rel_type``).

    ``optional=True`` keeps frontier rows without a match (OPTIONAL MATCH): a left join.
    """
    d = directed(edges, types, direction).withColumnRenamed("type", "rel_type")
    how = "left" if optional else "inner"
    return frontier.join(d, frontier[id_col] == d["node"], how).drop("node")


def _hops(first: int, max_hops: int | None):
    h = first
    while max_hops is None or h <= max_hops:
        yield h
        h += 1


def expand_var(starts: DataFrame, edges: DataFrame, types=None, *, min_hops: int = 1, max_hops: int | None,
               direction: str = "out", id_col: str = "id") -> DataFrame:
    """Variable-length reachability: distinct (start, end) with the least hop count >= ``min_hops``.

    Breadth-first from 64 starts at once: starts are numbered, each chunk of 64 has one row per node
    with a long of the starts that reached it and one of those that did so at this hop. A hop joins
    the new rows to the edges and merges them into the state by one aggregate (``bit_or``), so what
    is shuffled grows with nodes and chunks, not with (start, node) pairs; pairs are listed at the
    end. Below ``min_hops`` the new bits are all walks of just that length; from there on only starts
    not seen before go on, so cycles terminate. The start itself is reported when a cycle leads back
    to it, or at hop 0 when ``min_hops`` is 0.
    """
    if min_hops < 0:
        raise ValueError("min_hops must be 0 or more")
    d = checkpointed(directed(edges, types, direction).select("node", "other").distinct())
    at = F.col("__id")
    numbered = checkpointed(starts.select(F.col(id_col).alias("start")).distinct()
                            .withColumn("__id", F.monotonically_increasing_id())
                            .select("start", F.shiftright(at, 6).alias("chunk"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit")))
    none, bits = F.lit(0).cast("long"), F.bit_or(F.expr("shiftleft(1L, bit)"))
    first = numbered.groupBy("chunk", F.col("start").alias("node")).agg(bits.alias("new"))
    state = checkpointed(first.withColumn("seen", F.col("new") if min_hops == 0 else none))
    found = [state.withColumn("hops", F.lit(0))] if min_hops == 0 else []
    for h in _hops(1, max_hops):
        step = (state.filter("new <> 0").join(d, "node")
                .select("chunk", F.col("other").alias("node"), none.alias("seen"), F.col("new").alias("met")))
        if h > min_hops:
            step = step.unionByName(state.select("chunk", "node", "seen", none.alias("met")))
        merged = step.groupBy("chunk", "node").agg(F.bit_or("seen").alias("seen"), F.bit_or("met").alias("met"))
        state = checkpointed(merged.select(
            "chunk", "node", F.col("met").bitwiseAND(F.bitwise_not("seen")).alias("new"),
            (F.col("seen").bitwiseOR(F.col("met")) if h >= min_hops else none).alias("seen")))
        if state.filter("new <> 0").isEmpty():
            break
        if h >= min_hops:
            found.append(state.filter("new <> 0").withColumn("hops", F.lit(h)))
    names = numbered.groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("bit", "start"))).alias("names"))
    if not found:
        found = [state.limit(0).withColumn("hops", F.lit(0))]
    rows = reduce(DataFrame.unionByName, (f.select("chunk", "node", "new", "hops") for f in found)).join(names, "chunk")
    start = F.explode(F.expr("transform(filter(sequence(0, 63), i -> getbit(new, i) = 1), i -> element_at(names, i))")).alias("start")
    return rows.select(start, F.col("node").alias("end"), F.col("hops").cast("long").alias("hops"))


def reach_doubling(starts: DataFrame, edges: DataFrame, types=None, *, direction: str = "out", id_col: str = "id") -> DataFrame:
    """N3 without bound, for deep graphs (nested membership, chains): distinct (start, end) by walks of one hop or more.

    Path doubling: round i holds the pairs joined by a walk of just 2^i hops, and all ends within 2^i
    hops of a start; joining the two covers 2^(i+1) hops. A round without a new end is the last one:
    a farther end's shortest walk would pass one. So rounds grow with the logarithm of the depth, in
    cycles too. Walk pairs are at most one per node and round in chains, rings and trees; in wide
    graphs of many short cycles they approach all pairs, and ``expand_var`` is the better choice.
    """
    step = checkpointed(directed(edges, types, direction).select("node", "other").distinct())
    first = starts.select(F.col(id_col).alias("start")).distinct()
    found = checkpointed(first.join(step, F.col("start") == F.col("node")).select("start", F.col("other").alias("end")).distinct())
    while True:
        far = found.join(step, F.col("end") == F.col("node")).select("start", F.col("other").alias("end")).distinct()
        new = checkpointed(far.join(found, ["start", "end"], "left_anti"))
        if new.isEmpty():
            return found
        found = checkpointed(found.unionByName(new))
        ahead = step.select(F.col("node").alias("other"), F.col("other").alias("end"))
        step = checkpointed(step.join(ahead, "other").select("node", F.col("end").alias("other")).distinct())


def _plain_steps(edges: DataFrame, types, direction: str) -> DataFrame:
    d = directed(edges, types, direction).select("node", "other").distinct()
    return checkpointed(d.withColumn("rel", F.lit(None).cast("string")))


def shortest_path(starts: DataFrame, ends: DataFrame, edges: DataFrame, types=None, *, max_hops: int | None,
                  direction: str = "out", id_col: str = "id", min_hops: int = 1) -> DataFrame:
    """One shortest path per reachable (start, end); ties go to the smallest node sequence."""
    r = _least_walks(starts, ends, _plain_steps(edges, types, direction), max_hops, id_col, min_hops)
    return r.select("start", "end", "hops", _nodes_of())


def _least_walks(starts: DataFrame, ends: DataFrame, steps: DataFrame, max_hops: int | None, id_col: str, min_hops: int) -> DataFrame:
    """The smallest shortest walk per reachable (start, end), from two frontiers that meet: (start, end, hops, walk).

    Walks grow from the starts and, over reversed steps, from the ends, in turn. Each side keeps the
    smallest walk per pair, which is exact: of two walks to one node (from one node) of one length
    the smaller one stays smaller when continued. After each hop the two frontiers meet on their
    nodes; a pair of distance L is met when their depths add up to L, so each side goes half way.
    A smallest walk's halves are smallest walks to and from the node between them, so the smallest
    joined walk of the first meeting is the answer. When one side has no new node, or every
    pair is met, that is all.
    """
    none = F.lit(None).cast(steps.schema["rel"].dataType)
    here = F.array(F.struct(F.col("node").alias("node"), none.alias("rel")))
    fore = starts.select(F.col(id_col).alias("start"), F.col(id_col).alias("node")).distinct().withColumn("walk", here)
    back = ends.select(F.col(id_col).alias("end"), F.col(id_col).alias("node")).distinct()
    back = back.withColumn("tail", F.slice(here, 1, 0))
    fore, back = checkpointed(fore), checkpointed(back)
    seen = {"start": [fore.select("start", "node")], "end": [back.select("end", "node")]}
    met = [checkpointed(fore.join(back, "node").select("start", "end", F.lit(0).alias("hops"), "walk"))]
    open_pairs = fore.count() * back.count() - met[0].count()
    turned = steps.select(F.col("other").alias("node"), F.col("node").alias("other"), "rel")
    for h in _hops(1, max_hops):
        if not open_pairs:
            break
        if h % 2:
            ext = fore.join(steps, "node").select("start", F.col("other").alias("node"), F.concat(
                "walk", F.array(F.struct(F.col("other").alias("node"), "rel"))).alias("walk"))
            fore = new = _unseen(ext, seen["start"], "start", "walk")
        else:
            ext = back.join(turned, "node").select("end", F.col("other").alias("node"), F.concat(
                F.array(F.struct(F.col("node").alias("node"), "rel")), "tail").alias("tail"))
            back = new = _unseen(ext, seen["end"], "end", "tail")
        if new.isEmpty():
            break
        whole = fore.join(back, "node").select("start", "end", F.concat("walk", "tail").alias("walk"))
        known = reduce(DataFrame.unionByName, (m.select("start", "end") for m in met))
        met.append(checkpointed(whole.join(known, ["start", "end"], "left_anti").groupBy("start", "end")
                                .agg(F.min("walk").alias("walk")).select("start", "end", F.lit(h).alias("hops"), "walk")))
        open_pairs -= met[-1].count()
    every = reduce(DataFrame.unionByName, met)
    return every.filter(F.col("hops") >= min_hops).select("start", "end", F.col("hops").cast("long").alias("hops"), "walk")


def _unseen(ext: DataFrame, seen: list[DataFrame], side: str, walk: str) -> DataFrame:
    """The smallest walk to each node that this side has not come to before; ``seen`` grows by them."""
    known = reduce(DataFrame.unionByName, seen)
    new = checkpointed(ext.join(known, [side, "node"], "left_anti").groupBy(side, "node").agg(F.min(walk).alias(walk)))
    seen.append(new.select(side, "node"))
    return new


def shortest_dag(starts: DataFrame, steps: DataFrame, max_hops: int | None, id_col: str = "id") -> tuple[DataFrame, list[DataFrame]]:
    """All shortest paths from each start as predecessor rows, with their number, without listing one.

    ``steps(node, other, rel)``. Gives ``reached(start, node, hops, n_paths)`` and, for each hop, the
    rows ``(start, node, parent, rel)``: a shortest path to ``node`` comes from ``parent`` by ``rel``.
    Their number is at most that of the steps a start can take, however many paths they hold;
    ``n_paths`` adds up the parents' numbers (decimal, as numbers grow exponentially with hops).
    """
    cur = checkpointed(starts.select(F.col(id_col).alias("start"), F.col(id_col).alias("node")).distinct()
                       .withColumn("n_paths", F.lit(1).cast("decimal(38,0)")))
    reached, levels = [cur.withColumn("hops", F.lit(0).cast("long"))], []
    for h in _hops(1, max_hops):
        ext = cur.join(steps, "node").select("start", F.col("other").alias("node"), F.col("node").alias("parent"), "rel", "n_paths")
        known = reduce(DataFrame.unionByName, (r.select("start", "node") for r in reached))
        level = checkpointed(ext.join(known, ["start", "node"], "left_anti"))
        if level.isEmpty():
            break
        cur = checkpointed(level.groupBy("start", "node").agg(F.sum("n_paths").cast("decimal(38,0)").alias("n_paths")))
        reached.append(cur.withColumn("hops", F.lit(h).cast("long")))
        levels.append(level.drop("n_paths"))
    return reduce(DataFrame.unionByName, reached), levels


def unroll(levels: list[DataFrame], asked: DataFrame, rel: DataType) -> DataFrame:
    """The paths of ``asked(start, end, hops)`` out of ``shortest_dag``'s rows: (start, end, hops, walk).

    Paths are followed from their ends, so every row made is a part of a path that is asked for.
    """
    node = F.struct(F.col("start").alias("node"), F.lit(None).cast(rel).alias("rel"))
    blank = F.slice(F.array(node), 1, 0)
    pairs = asked.select("start", "end", "hops", F.col("end").alias("node")).withColumn("walk", blank)
    open_ = pairs.limit(0)
    for h in range(len(levels), 0, -1):
        here = pairs.filter(F.col("hops") == h).unionByName(open_)
        open_ = checkpointed(here.join(levels[h - 1], ["start", "node"]).select(
            "start", "end", "hops", F.col("parent").alias("node"),
            F.concat(F.array(F.struct(F.col("node").alias("node"), "rel")), "walk").alias("walk")))
    done = open_.unionByName(pairs.filter("hops = 0"))
    return done.select("start", "end", "hops", F.concat(F.array(node), "walk").alias("walk"))


def _asked(reached: DataFrame, ends: DataFrame, id_col: str, min_hops: int) -> DataFrame:
    e = ends.select(F.col(id_col).alias("node")).distinct()
    return reached.filter(F.col("hops") >= min_hops).join(e, "node", "left_semi").withColumnRenamed("node", "end")


def _nodes_of(walk: str = "walk") -> Column:
    return F.transform(walk, lambda x: x["node"]).alias("path")


def shortest_path_counts(starts: DataFrame, ends: DataFrame, edges: DataFrame, types=None, *, max_hops: int | None,
                         direction: str = "out", id_col: str = "id", min_hops: int = 1) -> DataFrame:
    """How many shortest node sequences lead from each start to each end: (start, end, hops, n_paths)."""
    reached, _ = shortest_dag(starts, _plain_steps(edges, types, direction), max_hops, id_col)
    return _asked(reached, ends, id_col, min_hops).select("start", "end", "hops", "n_paths")


def all_shortest_paths(starts: DataFrame, ends: DataFrame, edges: DataFrame, types=None, *, max_hops: int | None,
                       direction: str = "out", id_col: str = "id") -> DataFrame:
    """Every path (node sequence) of minimum length per reachable (start, end)."""
    steps = _plain_steps(edges, types, direction)
    reached, levels = shortest_dag(starts, steps, max_hops, id_col)
    return unroll(levels, _asked(reached, ends, id_col, 1), steps.schema["rel"].dataType).select("start", "end", "hops", _nodes_of())


def shortest_walks(starts: DataFrame, ends: DataFrame, edges: DataFrame, types=None, *, max_hops: int | None,
                   direction: str = "out", id_col: str = "id", every: bool = True, min_hops: int = 0) -> DataFrame:
    """Shortest paths with the relationships taken: (start, end, hops, walk array<(node, rel)>).

    ``rel`` is the relationship's (type, props as sorted entries, copy, back); parallel relationships give
    a path each. With ``every=False`` one path per (start, end), the smallest by nodes, then by
    relationships. Zero-hop paths (start = end) are included unless ``min_hops`` is 1.
    """
    # equal relationships between the same nodes are numbered, so each is a step of its own
    alike = (_typed(edges, types).select("src", "dst", "type", F.array_sort(F.map_entries("props")).alias("props"))
             .groupBy("src", "dst", "type", "props").agg(F.count(F.lit(1)).alias("n")))
    e = alike.select("src", "dst", "type", "props", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    rel = lambda back: F.struct("type", "props", "copy", F.lit(back).alias("back")).alias("rel")
    out = e.select(F.col("src").alias("node"), F.col("dst").alias("other"), rel(False))
    inc = e.select(F.col("dst").alias("node"), F.col("src").alias("other"), rel(True))
    steps = checkpointed({"out": out, "in": inc, "both": out.unionByName(inc)}[direction])
    if not every:
        return _least_walks(starts, ends, steps, max_hops, id_col, min_hops)
    reached, levels = shortest_dag(starts, steps, max_hops, id_col)
    return unroll(levels, _asked(reached, ends, id_col, min_hops), steps.schema["rel"].dataType)


def degree_filter(edges: DataFrame, types, min_exclusive: int, direction: str = "out") -> DataFrame:
    """Nodes with more than ``min_exclusive`` distinct neighbours over ``types`` (WITH ... WHERE)."""
    d = directed(edges, types, direction)
    return d.groupBy("node").agg(F.count_distinct("other").alias("degree")).filter(F.col("degree") > min_exclusive)


def union_matches(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION of two match results (distinct)."""
    return a.unionByName(b).distinct()


def unwind(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """One row per list element."""
    return df.withColumn(name or col, F.explode(col))


def collect_group(df: DataFrame, key: str, value: str, name: str = "item") -> DataFrame:
    """N11 (COLLECT), as rows: one ``(key, item)`` row per collected value with the group size.

    A list per key would put a whole group into one row (a key may hold a third of the data);
    rows carry the same content, and the group size comes from a partial aggregate joined back.
    Sort by ``(key, item)`` when reading for the reference's sorted lists.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("group_size"))
    return df.select(key, F.col(value).alias(name)).join(sizes, key)


def count_group(df: DataFrame, key: str) -> DataFrame:
    """Rows per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def recent(df: DataFrame, ts: str, days: int, as_of: str) -> DataFrame:
    """Rows within ``days`` before ``as_of`` (a parameter, never the wall clock)."""
    end = F.to_timestamp(F.lit(as_of))
    return df.filter((F.col(ts) > end - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(ts) <= end))


def off_hours(df: DataFrame, ts: str, start_hour: int = 8, end_hour: int = 20) -> DataFrame:
    """Rows on a weekend or outside [start_hour, end_hour), with the reason."""
    dow = F.dayofweek(ts)  # 1 = Sunday, 7 = Saturday
    hour = F.hour(ts)
    weekend = dow.isin(1, 7)
    night = (hour < start_hour) | (hour >= end_hour)
    reason = F.when(weekend, F.lit("weekend")).when(night, F.lit("night"))
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def regex_match(c, pattern: str) -> Column:
    """Cypher ``=~``: the whole string matches ``pattern``."""
    c = F.col(c) if isinstance(c, str) else c
    return c.rlike(rf"\A(?:{pattern})\z")


def first_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """ORDER BY ... LIMIT n (a top-k: n rows per partition, then merged)."""
    return df.orderBy(*order).limit(n)


def churn(events: DataFrame, user: str, ts: str, kinds: Sequence[str], kind_col: str, days: int, n: int,
          as_of: str) -> DataFrame:
    """Users with more than ``n`` events of ``kinds`` within ``days`` before ``as_of``."""
    e = recent(events.filter(F.col(kind_col).isin(list(kinds))), ts, days, as_of)
    return e.groupBy(user).agg(F.count(F.lit(1)).alias("n_events")).filter(F.col("n_events") > n)


def identical_targets(edges: DataFrame, types, direction: str = "out") -> DataFrame:
    """N18 (re-aimed): entities whose whole target set equals another entity's.

    Each entity's set is summarised by order-free aggregates (size and two independent 64-bit
    hash sums kept in DECIMAL, so no overflow) without collecting the set; entities are then
    grouped by that fingerprint. No pair of entities is ever emitted. Returns (node,
    group_size, group_first) for groups of two or more.
    """
    d = directed(edges, types, direction).select("node", "other").distinct()
    h1 = F.xxhash64("other").cast("decimal(38,0)")
    h2 = F.xxhash64(F.concat(F.lit("#"), F.col("other"))).cast("decimal(38,0)")
    fp = d.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum(h1).alias("s1"), F.sum(h2).alias("s2"))
    groups = fp.groupBy("n", "s1", "s2").agg(F.count(F.lit(1)).alias("group_size"), F.min("node").alias("group_first"))
    return fp.join(groups.filter("group_size > 1"), ["n", "s1", "s2"]).select("node", "group_size", "group_first")


def duplicate_property(nodes: DataFrame, label: str, key: str) -> DataFrame:
    """Nodes of ``label`` sharing the value of property ``key`` with another node."""
    m = match_nodes(nodes, label).select("id", F.try_element_at("props", F.lit(key)).alias("value")).filter(F.col("value").isNotNull())
    g = m.groupBy("value").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    return m.join(g, "value")
