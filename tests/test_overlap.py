"""Set-overlap join (N18) against all pairs, with hubs, equal sets, nulls and small blocks."""

import random
from collections import defaultdict

import pytest

from tessera.operators import overlap as OV
from tessera.operators.positions import rank_in_groups


def _all_pairs(edges, percent):
    sets = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None:
            sets[a].add(b)
    classes = defaultdict(list)
    for n, s in sets.items():
        classes[frozenset(s)].append(n)
    members = {(n, len(s), min(ns), len(ns)) for s, ns in classes.items() for n in ns}
    reps = [(min(ns), s) for s, ns in classes.items()]
    pairs = {(a, b, len(s), len(t), len(s & t)) for a, s in reps for b, t in reps
             if a < b and 100 * len(s & t) >= percent * len(s | t)}
    return pairs, members


def _joined(spark, edges, percent):
    e = spark.createDataFrame([(a, b, "T") for a, b in edges], "src string, dst string, type string")
    pairs, members = OV.shared_targets(e, "T", percent=percent)
    rows = [tuple(r) for r in pairs.select("a", "b", "n_a", "n_b", "n_both").collect()]
    assert len(rows) == len(set(rows))
    return set(rows), {tuple(r) for r in members.select("node", "n", "class", "class_size").collect()}


@pytest.mark.parametrize("percent,block", [(75, 2000), (50, 2000), (50, 7), (30, 50), (100, 2000)])
def test_pairs_match_all_pairs(spark, monkeypatch, percent, block):
    monkeypatch.setattr(OV, "BLOCK", block)
    r = random.Random(percent + block)
    edges = []
    for i in range(150):
        n = r.choice([1, 1, 2, 3, 4, 8, 12])
        edges += [(f"e{i}", f"t{min(r.randrange(40), r.randrange(40))}") for _ in range(n)]
    base = [f"u{k}" for k in range(25)]
    for i in range(40):  # near copies of one large set, and whole copies
        edges += [(f"n{i}", t) for t in base if i > 30 or r.random() > 0.08]
    edges += [(f"e{i}", "hub") for i in range(0, 150, 3)] + [(None, "t1"), ("e1", None), ("e0", "t0"), ("e0", "t0")]
    assert _joined(spark, edges, percent) == _all_pairs(edges, percent)


def test_hub_of_a_third_of_the_edges(spark, monkeypatch):
    """Thousands of sets that share one hub: it is indexed for hardly any of them, and no pair is lost."""
    monkeypatch.setattr(OV, "BLOCK", 100)
    edges = [(f"e{i:04d}", t) for i in range(3000) for t in ("hub", f"x{i // 2}", f"y{i}")]
    edges += [("h0", "hub"), ("h1", "hub"), ("h2", "hub"), ("h2", "x1")]
    e = spark.createDataFrame([(a, b, "T") for a, b in edges], "src string, dst string, type string")
    pairs, members = OV.shared_targets(e, "T", percent=50)
    got = {(r.a, r.b, r.n_both) for r in pairs.collect()}
    want = {(f"e{i:04d}", f"e{i + 1:04d}", 2) for i in range(0, 3000, 2)} | {
        ("h0", "h2", 1), ("e0002", "h2", 2), ("e0003", "h2", 2)}
    assert got == want and members.filter("class = 'h0'").count() == 2


@pytest.mark.parametrize("wide,percent", [(0, 50), (1, 60), (6, 40), (20, 60), (24, 100)])
def test_wide_sets_are_not_collected(spark, monkeypatch, wide, percent):
    """Sets above WIDE go by rows, smaller ones in one row; pairs across that border are found too."""
    monkeypatch.setattr(OV, "WIDE", wide)
    r = random.Random(wide)
    edges = [(f"e{i}", f"t{min(r.randrange(30), r.randrange(30))}") for i in range(60) for _ in range(r.choice([1, 2, 4, 9, 30]))]
    base = [f"u{k}" for k in range(25)]
    edges += [(f"n{i}", t) for i in range(30) for t in base if i > 25 or r.random() > 0.15]
    edges += [("r0", "t1"), ("r0", "t2")] * 40 + [("r1", "t1"), ("r1", "t2"), ("r1", "t3")] + [(None, "t1"), ("r1", None)] * 50
    assert _joined(spark, edges, percent) == _all_pairs(edges, percent)


def test_probes_grow_with_the_edges(spark, monkeypatch):
    """A small set is looked up only under the sizes and targets that a partner of that size can share first."""
    seen = []
    dealt = OV._dealt
    monkeypatch.setattr(OV, "_dealt", lambda p, i: (seen.append((p.count(), i.count())), dealt(p, i))[1])
    edges = [(f"e{i}", f"t{i % 50}_{k}") for i in range(400) for k in range(1 + i % 7)]
    pairs, _ = _joined(spark, edges, 60)
    assert pairs == _all_pairs(edges, 60)[0]
    classes = len({frozenset(t for e, t in edges if e == f"e{i}") for i in range(400)})
    assert max(seen[0]) <= 5 * classes


def test_no_edges(spark):
    assert _joined(spark, [], 60) == (set(), set())


def test_rank_in_groups(spark):
    r = random.Random(2)
    rows = [(r.choice("abc") if i % 3 else "hot", r.randrange(50)) for i in range(2000)]
    got = rank_in_groups(spark.createDataFrame(rows, "g string, x long").repartition(7), ["g"], ["x"]).collect()
    by = defaultdict(list)
    for row in got:
        by[row.g].append((row.pos, row.x))
    for g, v in by.items():
        v.sort()
        assert [p for p, _ in v] == list(range(len(v))) and [x for _, x in v] == sorted(x for h, x in rows if h == g)
