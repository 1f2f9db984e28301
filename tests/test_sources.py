"""JSON arrays read in pieces, and versioned folders."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import dedup as D
from tessera.sources import corpus_io as IO
from tessera.sources import sinks as SK
from tessera.sources import versions as V
from tessera.sources.json_array import array_entries


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _entries(n):
    r = random.Random(n)
    odd = ['a,b', '"', '\\', '\\"', '[', ']', '{', '}', ',', 'é日😀', '\n', ':', '],[', '\\\\",']
    some = lambda: "".join(r.choice(odd) for _ in range(r.randrange(6)))
    return [{"description": some(), "query": some() + str(i), "more": {"k" + some(): [some(), [1, {"x": some()}]]}} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 2])
def test_array_in_many_splits(spark, tmp_path, tiny_splits, indent):
    rows = _entries(80)
    path = tmp_path / "c.json"
    path.write_text("\n " + json.dumps(rows, indent=indent, ensure_ascii=bool(indent)) + " \n")
    assert spark.read.option("lineSep", ",").text(str(path)).rdd.getNumPartitions() > 20
    got = {r.id: json.loads(r.entry) for r in array_entries(spark, str(path)).collect()}
    assert got == dict(enumerate(rows))
    read = IO.read_entries(spark, str(path)).orderBy("id").collect()
    assert [(r.id, r.description, r.query) for r in read] == [(i, x["description"], x["query"]) for i, x in enumerate(rows)]


def test_array_shapes(spark, tmp_path, tiny_splits):
    for i, (text, n) in enumerate([("[]", 0), (" [ \n ] ", 0), ('[{"query": "q"}]', 1), ("[{}, {}]", 2)]):
        (tmp_path / f"{i}.json").write_text(text)
        assert IO.read_entries(spark, str(tmp_path / f"{i}.json")).count() == n
    for i, text in enumerate(['[{"query": "a"}, {"que', '{"query": "a"}', '[{"query": "a"}],[{"query": "b"}]', '[{"query": "a"}] [{"query": "b"}]',
                              '[{"query": "a"},]', '[,{"query": "a"}]', '["a", "b"]', '[{"query": "a"}}', '[{"query": "a]', 'x[{"a": 1}]', "", "[[]]"]):
        p = tmp_path / f"bad{i}.json"
        p.write_text(text)
        with pytest.raises(Exception):
            IO.read_entries(spark, str(p)).collect()


def test_report_versions(spark, tmp_path):
    d = str(tmp_path / "report")
    one = lambda x: spark.createDataFrame([(x,)], "v string")
    assert V.last_version(spark, d) is None
    SK.write_report({"a": one("a1"), "b": one("b1")}, d)
    read = lambda p: [r.v for r in V.read_part(spark, d, p).collect()]
    with pytest.raises(ValueError):
        SK.write_report({"a": one("a2")}, d)
    fails = one("x").select(F.raise_error(F.lit("stop here")).alias("v"))
    with pytest.raises(Exception, match="stop here"):
        SK.write_report({"a": one("a2"), "b": fails}, d, mode="append")
    assert (read("a"), read("b")) == (["a1"], ["b1"])  # the half-written version is not seen
    SK.write_report({"a": one("a3"), "b": one("b3")}, d, mode="overwrite")
    assert (read("a"), read("b")) == (["a3"], ["b3"])
    assert [r.v for r in V.read_part(spark, d, "a", 1).collect()] == ["a1"]
    assert V.clean(spark, d) == [1] and read("b") == ["b3"]
    assert len(list((tmp_path / "report" / "data").iterdir())) == 1
    with pytest.raises(ValueError):
        V.read_part(spark, d, "c")


def test_report_of_written_cases(spark, tmp_path):
    """A report that is a function of the cases reads them as written: they are computed once."""
    runs = spark.sparkContext.accumulator(0)
    def count(batches):
        for b in batches:
            runs.add(len(b))
            yield b
    cases = spark.createDataFrame([(i, i / 7 if i % 3 else None, ["a\n\"", None]) for i in range(20)], "id long, x double, e array<string>")
    want = [tuple(r) for r in cases.collect()]
    cases = cases.mapInPandas(count, cases.schema)
    paths = SK.write_eval(cases, lambda c: c.agg(F.count("x").alias("n"), F.sum("x").alias("x")), str(tmp_path / "e"))
    assert runs.value == 20
    assert sorted(tuple(r) for r in spark.read.schema(cases.schema).json(paths["cases"]).collect()) == want
    report = V.read_part(spark, str(tmp_path / "e"), "report").first()
    assert report.n == 13 and abs(report.x - sum(x for _, x, _ in want if x is not None)) < 1e-9


def test_eval_is_written_compressed(spark, tmp_path):
    cases = spark.range(3000).selectExpr("id", "repeat('MATCH (u:User) RETURN u ', 40) AS query", "IF(id % 3 = 0, NULL, 'é\n\"') AS e")
    paths = SK.write_eval(cases, lambda c: c.agg(F.count("e").alias("n")), str(tmp_path / "e"))
    files = [os.path.join(paths["cases"], f) for f in os.listdir(paths["cases"]) if f.startswith("part-")]
    assert files and sum(map(os.path.getsize, files)) < 3000 * 1000 / 5
    assert sorted(map(tuple, spark.read.schema(cases.schema).json(paths["cases"]).collect())) == sorted(map(tuple, cases.collect()))
    assert V.read_part(spark, str(tmp_path / "e"), "report").first().n == 2000


def test_dedup_in_place(spark, tmp_path):
    d = str(tmp_path / "corpus")
    df = spark.createDataFrame([(1, "a  b"), (2, "a b"), (3, "c")], "id long, query string")
    SK.write_corpus(df, str(tmp_path / "plain"))
    with pytest.raises(ValueError):
        SK.write_dedup(D.dedup(spark.read.parquet(str(tmp_path / "plain"))), str(tmp_path / "plain"), str(tmp_path / "plain"))
    SK.write_corpus_version(df, d)
    SK.write_dedup(D.dedup(V.read_part(spark, d, "corpus")), d, d)
    assert sorted(r.id for r in V.read_part(spark, d, "corpus").collect()) == [1, 3]
    assert V.read_part(spark, d, "corpus", 1).count() == 3
