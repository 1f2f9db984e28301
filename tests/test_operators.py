"""Operator behaviour on small hand-made tables and invariants on the driver tables."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sizes import SF_SMALL
from tessera.operators import dedup as D
from tessera.operators import graph_match as GM
from tessera.operators import result_compare as RC
from tessera.operators import sampling as SP
from tessera.operators import runs as RU
from tessera.plans import fixtures as X
from tessera.sources import corpus_io as IO


def test_s19_reader_missing_vs_null(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    path = os.path.join(d, "c.json")
    rows = [{"description": "a", "query": "MATCH (n) RETURN n"}, {"query": "q2", "source": None},
            {"description": "x"}, {"description": " d ", "query": " q ", "source": "s"}]
    with open(path, "w") as f:
        json.dump(rows, f)
    skip = IO.read_corpus(spark, path, "skip").orderBy("id").collect()
    assert [(r.id, r.description, r.query, r.source) for r in skip] == [
        (0, "a", "MATCH (n) RETURN n", "unknown"), (3, "d", "q", "s")]
    defaults = IO.read_corpus(spark, path, "defaults").orderBy("id").collect()
    assert [(r.id, r.description, r.source) for r in defaults] == [(0, "a", "Unknown"), (1, "Query 2", "Unknown"),
                                                                  (3, " d ", "s")]
    dd = IO.read_corpus(spark, path, "default_desc").orderBy("id").collect()
    assert [r.description for r in dd] == ["a", "No description provided.", " d "]
    with pytest.raises(Exception):
        IO.read_corpus(spark, path, "strict").collect()


def test_dedup_idempotent_and_keeps_first(spark):
    df = spark.createDataFrame([(3, "a  b"), (1, "a b"), (2, "c"), (5, " a b ")], "id long, query string")
    once = D.dedup(df)
    assert sorted(r.id for r in once.collect()) == [1, 2]
    assert sorted(r.id for r in D.dedup(once).collect()) == [1, 2]
    rep = D.duplicate_report(df).collect()
    assert sorted((r.keep_index, r.remove_index) for r in rep) == [(1, 3), (1, 5)]


def test_split_disjoint_cover_and_size(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "id")
    s = SP.train_test_split(df, 0.85, 42)
    c = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert c["test"] == SP.test_size(1000, 0.85) and c["train"] + c["test"] == 1000
    assert s.select("id").distinct().count() == 1000
    st = SP.train_test_split(df.withColumn("g", F.col("id") % 3), 0.85, 42, stratify="g")
    per = st.groupBy("g", "split").count().collect()
    assert sum(r["count"] for r in per) == 1000


def test_compare_set_vs_bag(spark):
    recs = spark.createDataFrame(
        [(1, "truth", '{"a":1}'), (1, "truth", '{"a":1}'), (1, "truth", '{"a":2}'), (1, "generated", '{"a":1}'),
         (1, "generated", '{"a":3}'), (2, "truth", '{"a":1}')], "case_id long, side string, record string")
    heads = spark.createDataFrame(
        [(1, "truth", True, None, 3), (1, "generated", True, None, 2), (2, "truth", True, None, 1),
         (2, "generated", False, "boom", 0), (3, "truth", True, None, 0), (3, "generated", True, None, 0)],
        "case_id long, side string, success boolean, error string, record_count long")
    c = {r.case_id: r for r in RC.compare(recs, heads).collect()}
    assert (c[1].ground_truth_count, c[1].generated_count, c[1].common_records, c[1].missing_records,
            c[1].extra_records) == (3, 2, 1, 1, 1)
    assert abs(c[1].similarity_score - 1 / 3) < 1e-12 and not c[1].strict_match
    assert c[2].either_failed and c[2].similarity_score == 0.0 and c[2].missing_records == 1
    assert c[3].strict_match and c[3].similarity_score == 1.0  # both empty


def test_s9_canonical_list_guard(spark):
    df = spark.createDataFrame([([3, 1, 2], {"b": 1, "a": 2}), ([3, None, 1], {})], "l array<int>, m map<string,int>")
    out = [r.record for r in RC.canonical_record(df, ["m", "l"]).collect()]
    assert out == ['{"l":[1,2,3],"m":{"a":2,"b":1}}', '{"l":[3,null,1],"m":{}}']


def test_s13_404_rule(spark):
    df = spark.createDataFrame([
        (1, "MATCH (n) RETURN n", 404, "nope", 1.0),
        (2, "MATCH (n) RETURN n", 200, '{"errors":[{"message":"resource not found"}]}', 1.0),
        (3, "MATCH (n {x: 404}) RETURN n", 200, '{"errors":[{"message":"resource not found"}]}', 1.0),
        (4, "MATCH (n) RETURN n", 200, "[]", 1.0), (5, "MATCH (n RETURN n", 200, "{}", 1.0)],
        "run_id long, query string, status_code int, body string, execution_time double")
    st = {r.run_id: r.run_status for r in RU.run_status(RU.classify_response(df)).collect()}
    assert st == {1: "success_no_data", 2: "failed", 3: "success_no_data", 4: "success_no_data", 5: "syntax_failed"}


def _bfs(edges, start, max_hops):
    seen, frontier, out = set(), {start}, {}
    for h in range(1, max_hops + 1):
        nxt = {d for s, d in edges if s in frontier} - seen
        for n in nxt:
            out[n] = h
        seen |= nxt
        frontier = nxt
        if not nxt:
            break
    return out


def test_s21_expand_var_matches_bfs(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "d"), ("e", "a")]
    e = spark.createDataFrame([(s, d, "T") for s, d in edges], "src string, dst string, type string").withColumn(
        "props", F.create_map().cast("map<string,string>"))
    starts = spark.createDataFrame([("a",), ("e",)], "id string")
    got = {(r.start, r.end): r.hops for r in GM.expand_var(starts, e, "T", min_hops=1, max_hops=5).collect()}
    want = {(s, n): h for s in ("a", "e") for n, h in _bfs(edges, s, 5).items()}
    assert got == want and got[("a", "a")] == 3  # start returns only through a cycle
    every = {(r.start, r.end): r.hops for r in GM.expand_var(starts, e, "T", max_hops=None).collect()}
    assert every == want
    two = {(r.start, r.end): r.hops for r in GM.expand_var(starts, e, "T", min_hops=2, max_hops=None).collect()}
    assert two[("a", "b")] == 4 and two[("a", "c")] == 2 and two[("a", "d")] == 3 and ("a", "e") not in two
    zero = {(r.start, r.end): r.hops for r in GM.expand_var(starts, e, "T", min_hops=0, max_hops=2).collect()}
    assert zero[("a", "a")] == 0 and zero[("e", "b")] == 2
    sp = {(r.start, r.end): r.path for r in GM.shortest_path(starts, spark.createDataFrame([("d",)], "id string"), e, "T",
                                                            max_hops=5).collect()}
    assert sp[("a", "d")] == ["a", "b", "c", "d"]


def _graph(spark, edges):
    e = spark.createDataFrame(edges, "src string, dst string, type string, props map<string,string>")
    ids = sorted({x for s, d, *_ in edges for x in (s, d)})
    n = spark.createDataFrame([(i, ["L"], {"k": i}) for i in ids], "id string, labels array<string>, props map<string,string>")
    return n, e


def _records(spark, n, e, start, end, types, direction="out", every=True):
    one = lambda x: spark.createDataFrame([(x,)], "id string")
    w = GM.shortest_walks(one(start), one(end), e, types, max_hops=4, direction=direction, every=every)
    return [(r.path_value.length, [x.properties["k"] for x in r.path_value.nodes],
             [(x.rel_type, x.properties) for x in r.path_value.relationships]) for r in RC.path_records(w, n).collect()]


def test_path_records_stay_apart_and_keep_their_relationships(spark):
    n, e = _graph(spark, [("a", "b", "R1", {}), ("b", "d", "R1", {}), ("a", "c", "R1", {}), ("c", "d", "R2", {"w": "1"}),
                          ("c", "d", "R1", {}), ("x", "a", "R1", {})])
    got = sorted(_records(spark, n, e, "a", "d", None), key=repr)
    assert got == sorted([(2, ["a", "b", "d"], [("R1", {}), ("R1", {})]), (2, ["a", "c", "d"], [("R1", {}), ("R1", {})]),
                          (2, ["a", "c", "d"], [("R1", {}), ("R2", {"w": "1"})])], key=repr)
    assert _records(spark, n, e, "a", "d", ["R2", "R1"], every=False) == [(2, ["a", "b", "d"], [("R1", {}), ("R1", {})])]
    assert _records(spark, n, e, "c", "d", "R2") == [(1, ["c", "d"], [("R2", {"w": "1"})])]
    assert sorted(r[1] for r in _records(spark, n, e, "d", "x", "R1", "in")) == [["d", "b", "a", "x"], ["d", "c", "a", "x"]]
    assert [r[1] for r in _records(spark, n, e, "b", "x", None, "both")] == [["b", "a", "x"]]
    assert _records(spark, n, e, "a", "a", None) == [(0, ["a"], [])]


def test_canonical_maps_of_any_value(spark):
    df = spark.createDataFrame([({"b": [2, 1], "a": [3, None]}, {"y": {"q": 1, "p": 2}}, [True, False])],
                               "m map<string,array<int>>, n map<string,map<string,int>>, f array<boolean>")
    rec = RC.canonical_record(df, ["m", "n", "f"]).first().record
    assert rec == '{"f":[false,true],"m":{"a":[3,null],"b":[1,2]},"n":{"y":{"p":2,"q":1}}}'


def test_regex_needs_the_whole_text(spark):
    df = spark.createDataFrame([("abc",), ("abc\n",), ("xabc",)], "t string")
    assert [r.t for r in df.filter(GM.regex_match("t", "a.c|x")).collect()] == ["abc"]


def test_strict_read_cannot_be_pruned(spark):
    df = spark.createDataFrame([(1, "a", "q", None), (2, None, "q", "s")], "id long, description string, query string, source string")
    strict = IO.apply_read_mode(df, "strict")
    for use in (lambda: strict.count(), lambda: strict.select("source").collect(), lambda: strict.select("query").collect()):
        with pytest.raises(Exception, match="missing required field: description"):
            use()


@pytest.mark.parametrize("name,text", [
    ("cut.json", '[{"query": "a"}, {"que'), ("one.json", '{"query": "a"}'), ("bad.jsonl", '{"id": 1, "query": "a"}\n{"id": 2,'),
    ("noid.jsonl", '{"id": 1, "query": "a"}\n{"query": "b"}')])
def test_malformed_corpora_fail(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    for mode in IO.MODES:
        with pytest.raises(Exception):
            IO.read_corpus(spark, str(tmp_path / name), mode).collect()


def test_json_lines_keep_given_ids(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"id": 7, "query": "a"}\n\n{"id": 3, "description": "d", "query": "b"}')
    got = sorted((r.id, r.description) for r in IO.read_corpus(spark, str(tmp_path / "c.jsonl"), "defaults").collect())
    assert got == [(3, "d"), (7, "Query 8")]


def test_positions_of_sparse_ids(spark):
    from tessera.operators.positions import id_buckets, with_position

    ids = [((-1) ** i * i) << 40 for i in range(500)] + [2**62 + i for i in range(50)] + [-(2**62) - i for i in range(50)] + [1, 2]
    df = spark.createDataFrame([(i,) for i in sorted(set(ids))], "id long").repartition(5)
    got = {r.id: r.pos for r in with_position(df, ["id"], id_buckets("id")).collect()}
    assert got == {x: k for k, x in enumerate(sorted(set(ids)))}


def test_stratified_total_and_samples(spark):
    df = spark.range(300).withColumn("g", F.when(F.col("id") < 100, F.col("id")).otherwise(F.col("id") % 3 + 1000).cast("long"))
    s = SP.train_test_split(df, 0.85, 42, stratify="g")
    assert s.filter("split = 'test'").count() == SP.test_size(300, 0.85) and s.count() == 300
    assert SP.sample_n(df, 17).count() == 17 and SP.sample_n(df, 900).count() == 300 and SP.sample_n(df, 0).count() == 0
    small = {r.id for r in SP.sample_n(df, 20).collect()}
    assert small <= {r.id for r in SP.sample_n(df, 50).collect()}


def test_publish_writes_a_split_from_every_task(spark, tmp_path):
    from tessera.sources import sinks as SK

    df = spark.range(0, 800, 1, 8).withColumn("split", F.when(F.col("id") % 10 == 0, "test").otherwise("train"))
    SK.publish(df, str(tmp_path / "p"))
    assert len(list((tmp_path / "p" / "split=train").glob("part-*"))) == 8
    assert spark.read.parquet(str(tmp_path / "p")).count() == 800


def test_identical_targets(spark):
    e = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "2"), ("y", "1"), ("z", "1"), ("w", "1")],
                              "src string, dst string").withColumn("type", F.lit("T")).withColumn(
        "props", F.create_map().cast("map<string,string>"))
    got = {(r.node, r.group_size, r.group_first) for r in GM.identical_targets(e, "T").collect()}
    assert got == {("x", 2, "x"), ("y", 2, "x"), ("z", 2, "w"), ("w", 2, "w")}


def test_shuffle_partitions_do_not_change_results(spark):
    from tessera.plans import registry

    registry.load_all()
    qs = registry.QUERIES
    keys = ["dup_pairs_query", "train_test_split", "compare_samples", "top_k", "failed_runs"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = {}
        for n in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            res[n] = {k: sorted(map(tuple, qs[k](spark, SF_SMALL).collect()), key=repr) for k in keys}
        assert res["1"] == res["200"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_fixture_corpus_grows_with_orders(spark):
    n_orders = X.table(spark, SF_SMALL, "orders").count()
    assert X.corpus(spark, SF_SMALL).count() == n_orders


def test_i1_path_record(spark):
    df = spark.createDataFrame([(["Nation", "Place"], {"name": "N1"}, "NEXT", {})],
                               "labels array<string>, props map<string,string>, t string, rp map<string,string>")
    node = RC.node_record(F.col("labels"), F.col("props"))
    rel = RC.rel_record(F.col("t"), F.col("rp"))
    p = df.select(RC.path_record(F.array(node, node), F.array(rel)).alias("p")).select("p.*")
    rec = RC.canonical_record(p, ["type", "length", "nodes", "relationships"]).collect()[0].record
    n = '{"labels":["Nation","Place"],"properties":{"name":"N1"},"type":"node"}'
    assert rec == '{"length":1,"nodes":[' + n + "," + n + '],"relationships":[{"properties":{},"rel_type":"NEXT",' \
                  '"type":"relationship"}],"type":"path"}'


def test_c5_user_validator_runs_in_arrow_batches(spark):
    from tessera.operators import validation as V

    df = spark.createDataFrame([(0, None, "MATCH (n) RETURN n"), (1, "d", None), (2, "x", "bad")],
                               "id long, description string, query string")

    def validator(q):
        return (q.startswith("MATCH"), [] if q.startswith("MATCH") else [f"line 1:0 no viable input '{q[:3]}'"])

    out = {r.id: r for r in V.validate_batch(df, validator).collect()}
    assert out[0].ok and out[0].description == "Query 1" and out[0].online_ok is None
    assert not out[1].ok and out[1].query == "" and out[1].errors == ["line 1:0 no viable input ''"]
    assert out[2].errors == ["line 1:0 no viable input 'bad'"]
