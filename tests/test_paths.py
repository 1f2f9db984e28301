"""Reach by bitsets, predecessor rows with path counts, two meeting frontiers: against plain searches."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph_match as GM


def _frame(spark, edges):
    e = spark.createDataFrame([(a, b, "T") for a, b in edges], "src string, dst string, type string")
    return e.withColumn("props", F.create_map().cast("map<string,string>"))


def _ids(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def _out(edges):
    out = defaultdict(set)
    for a, b in edges:
        out[a].add(b)
    return out


def _reach(edges, starts, min_hops):
    """Least walk length >= min_hops to each node, from each start."""
    out, found = _out(edges), {}
    for s in starts:
        front, seen, h = {s}, set(), 0
        while front and h < 200:
            if h >= min_hops:
                front -= seen
                seen |= front
                found |= {(s, n): h for n in front}
            front, h = {m for n in front for m in out[n]}, h + 1
    return found


def _paths(edges, start):
    """All shortest paths from a start, by end."""
    out, paths, front = _out(edges), {start: [[start]]}, [start]
    while front:
        new = defaultdict(list)
        for n in front:
            for m in out[n]:
                if m not in paths:
                    new[m] += [p + [m] for p in paths[n]]
        paths |= new
        front = list(new)
    return paths


def _random_edges(seed, nodes, n):
    r = random.Random(seed)
    return [(f"n{r.randrange(nodes):03d}", f"n{r.randrange(nodes):03d}") for _ in range(n)]


@pytest.mark.parametrize("min_hops", [0, 1, 3])
def test_reach_of_many_starts(spark, min_hops):
    """More starts than one long holds, in several partitions, with cycles and loops."""
    edges = _random_edges(7, 150, 200)
    starts = sorted({a for a, _ in edges} | {"far off"})
    got = GM.expand_var(_ids(spark, starts).repartition(3), _frame(spark, edges), "T", min_hops=min_hops, max_hops=None).collect()
    rows = {(r.start, r.end): r.hops for r in got}
    assert len(rows) == len(got) and len(starts) > 64
    assert rows == _reach(edges, starts, min_hops)


def test_reach_of_no_start(spark):
    e = _frame(spark, [("a", "b")])
    assert GM.expand_var(_ids(spark, ["a"]).limit(0), e, "T", max_hops=None).count() == 0
    assert GM.expand_var(_ids(spark, ["b"]), e, "T", max_hops=None).count() == 0


def test_doubling_takes_few_rounds(spark, monkeypatch):
    """A chain of 3,000 nodes with a ring of 1,000 behind it: rounds grow with the logarithm."""
    edges = [(f"c{i}", f"c{i + 1}") for i in range(3000)] + [("c3000", "r0")] + [(f"r{i}", f"r{(i + 1) % 1000}") for i in range(1000)]
    writes, real = [], GM.checkpointed
    monkeypatch.setattr(GM, "checkpointed", lambda df: writes.append(1) or real(df))
    got = GM.reach_doubling(_ids(spark, ["c0", "r5", "c3000"]), _frame(spark, edges), "T")
    assert {(r.start, r["count"]) for r in got.groupBy("start").count().collect()} == {("c0", 4000), ("r5", 1000), ("c3000", 1000)}
    assert len(writes) <= 3 * 14


def test_doubling_matches_reach(spark):
    for seed, n in ((3, 50), (4, 90)):
        edges = _random_edges(seed, 40, n)
        starts = sorted({a for a, _ in edges})[:12]
        got = {(r.start, r.end) for r in GM.reach_doubling(_ids(spark, starts), _frame(spark, edges), "T").collect()}
        assert got == set(_reach(edges, starts, 1))


def test_paths_of_random_graphs(spark):
    for seed, n in ((2, 140),):
        edges = _random_edges(seed, 40, n)
        nodes = sorted({x for e in edges for x in e})
        starts, ends = nodes[:9], nodes[::4]
        e, s, t = _frame(spark, edges), _ids(spark, starts), _ids(spark, ends)
        want = {(a, b): sorted(p) for a in starts for b, p in _paths(edges, a).items() if b in ends and b != a}
        got = defaultdict(list)
        for r in GM.all_shortest_paths(s, t, e, "T", max_hops=None).collect():
            assert r.hops == len(r.path) - 1
            got[r.start, r.end].append(list(r.path))
        assert {k: sorted(v) for k, v in got.items()} == want
        counts = GM.shortest_path_counts(s, t, e, "T", max_hops=None).collect()
        assert {(r.start, r.end): (r.hops, int(r.n_paths)) for r in counts} == {k: (len(v[0]) - 1, len(v)) for k, v in want.items()}
        one = {(r.start, r.end): (r.hops, list(r.path)) for r in GM.shortest_path(s, t, e, "T", max_hops=None).collect()}
        assert one == {k: (len(v[0]) - 1, v[0]) for k, v in want.items()}
        near = {(r.start, r.end) for r in GM.shortest_path(s, t, e, "T", max_hops=3).collect()}
        assert near == {k for k, v in want.items() if len(v[0]) <= 4}


def test_counts_do_not_list_paths(spark):
    """A chain of diamonds has 2 ** 7 shortest paths in 28 predecessor rows; only asked ends are unrolled."""
    edges = []
    for i in range(7):
        for side in "xy":
            edges += [(f"m{i:02d}", f"{side}{i:02d}"), (f"{side}{i:02d}", f"m{i + 1:02d}")]
    e, s = _frame(spark, edges), _ids(spark, ["m00"])
    reached, levels = GM.shortest_dag(s, GM._plain_steps(e, "T", "out"), None)
    assert {r.node: int(r.n_paths) for r in reached.filter("node LIKE 'm%'").collect()} == {f"m{i:02d}": 2**i for i in range(8)}
    assert sum(x.count() for x in levels) == 4 * 7
    few = GM.all_shortest_paths(s, _ids(spark, ["m02"]), e, "T", max_hops=None).collect()
    assert sorted("".join(r.path[1::2]) for r in few) == ["x00x01", "x00y01", "y00x01", "y00y01"]
    best = GM.shortest_path(s, _ids(spark, ["m07"]), e, "T", max_hops=None).first()
    assert best.hops == 14 and all(n.startswith("x") for n in best.path[1::2])
