"""Tree patterns against nested loops, and canonical records of no common schema against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.loose_records import canonical_json
from tessera.operators.patterns import Node, Rel, match_pattern


def _graph(spark, seed):
    r = random.Random(seed)
    ids = [f"{t}{i}" for t in "abc" for i in range(12)]
    edges = sorted({(r.choice(ids), r.choice(ids), r.choice("RST")) for _ in range(160)})
    n = spark.createDataFrame([(i, [i[0].upper()], {"k": i[1:]}) for i in ids], "id string, labels array<string>, props map<string,string>")
    e = spark.createDataFrame(edges + edges[:9], "src string, dst string, type string")
    return ids, edges, n, e


def test_pattern_matches_nested_loops(spark):
    ids, edges, n, e = _graph(spark, 4)
    link = lambda a, b, t: (a, b, t) in set(edges)
    a, b, c = ([x for x in ids if x[0] == t] for t in "abc")
    small = F.try_element_at("props", F.lit("k")).cast("int") < 8
    pattern = [Node("x", "A"), Node("y", "B", small), Node("z", "C"), Node("w"), Node("v", "A")]
    rels = [Rel("x", "y", "R"), Rel("y", "z", ["S", "T"], "in"), Rel("x", "w", "T", "both"), Rel("x", "v", "S", absent=True)]
    rows = [(x, y, z, w) for x in a for y in b if int(y[1:]) < 8 and link(x, y, "R") for z in c if link(z, y, "S") or link(z, y, "T")
            for w in ids if link(x, w, "T") or link(w, x, "T") if not any(link(x, v, "S") for v in a)]
    assert rows
    for returning in ([], ["z"], ["y", "w"], ["w", "z", "y"]):
        got = [tuple(r) for r in match_pattern(n, e, pattern, rels, returning).collect()]
        at = [0] + ["xyzw".index(k) for k in returning]
        assert len(got) == len(set(got)) and set(got) == {tuple(row[i] for i in at) for row in rows}


def test_absent_branch(spark):
    ids, edges, n, e = _graph(spark, 5)
    out = lambda x, t: {d for s, d, k in edges if s == x and k == t}
    got = {r.x for r in match_pattern(n, e, [Node("x"), Node("y"), Node("z", "C")], [Rel("x", "y", "R", absent=True), Rel("y", "z", "S")]).collect()}
    assert got == {x for x in ids if not any(z[0] == "c" for y in out(x, "R") for z in out(y, "S"))}


def test_pattern_must_be_a_tree(spark):
    _, _, n, e = _graph(spark, 1)
    for nodes, rels, back in (([Node("x"), Node("y")], [], []), ([Node("x"), Node("x")], [], []), ([Node("x")], [Rel("x", "q")], []),
                              ([Node("x"), Node("y")], [Rel("x", "y"), Rel("y", "x")], []),
                              ([Node("x"), Node("y")], [Rel("x", "y", absent=True)], ["y"])):
        with pytest.raises(ValueError):
            match_pattern(n, e, nodes, rels, back)


def _plain(v, top=True):
    """The canonical value: sorted lists of texts or of numbers, records in lists, lists in lists left alone."""
    if isinstance(v, dict):
        return {k: _plain(x) for k, x in sorted(v.items())}
    if isinstance(v, list):
        if all(isinstance(x, str) for x in v) or all(isinstance(x, (int, float)) for x in v):
            return sorted(v)
        return [_plain(x) if isinstance(x, dict) else x for x in v]
    return v


def _value(r, depth):
    kind = r.randrange(9 if depth else 6)
    if kind == 6:
        return {r.choice(["b", "a", 'q"', "é", "z,"]): _value(r, depth - 1) for _ in range(r.randrange(4))}
    if kind == 7:
        return [r.choice([r.randrange(50) - 20, r.random() < 0.5, r.randrange(99) / 8 + 0.0625]) for _ in range(r.randrange(6))]
    if kind == 8:
        return [_value(r, depth - 1) for _ in range(r.randrange(5))]
    return [None, True, r.randrange(1000), "text [1,2] \\ \n\"", "", ["b", "a", "é", "B"]][kind]


def test_records_without_a_schema(spark):
    r = random.Random(8)
    values = [_value(r, 4) for _ in range(400)] + [[], {}, {"a": [{"b": [3, 1], "c": {"d": [True, 0]}}]}, [2**70, 2**70 - 1, -3, 2.5]]
    df = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=i % 2 == 0), "x") for i, v in enumerate(values)], "id long, raw string, record string")
    got = {x.id: x.record for x in canonical_json(df, "raw").collect()}
    for i, v in enumerate(values):
        want = json.dumps(_plain(v), ensure_ascii=False, separators=(",", ":"), sort_keys=True)
        assert got[i] == want, (values[i], got[i], want)


def test_records_null_and_broken(spark):
    df = spark.createDataFrame([(1, None), (2, "[]")], "id long, raw string")
    assert {(r.id, r.record) for r in canonical_json(df, "raw").collect()} == {(1, None), (2, "[]")}
    assert canonical_json(df.limit(0), "raw").count() == 0
    with pytest.raises(Exception):
        canonical_json(spark.createDataFrame([(1, "{a")], "id long, raw string"), "raw").collect()
