"""The pipeline's stages: contracts, effect of decisions, and edge cases."""

import corpus_pipeline as C
from llm_data import SF, docs_of
from test_llm_operators import empty, prose

from tessera.llm.common import table


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    n = docs.count()
    for i, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        if i + 1 < len(C.STAGES):
            assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), out.schema)
        assert 0 < out.count() <= n, name
        n, docs = out.count(), out


def test_odd_rows_pass_all_stages(spark, odd):
    docs = odd
    for _, stage in C.STAGES[1:]:
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.count() > 0
        assert stage(spark, empty(odd), SF).count() == 0


def test_one_of_each_group_stays(spark):
    a, b = prose(1, 200), prose(2, 200)
    docs = docs_of(spark, [(1, a, "en", "s"), (2, a + " tail", "en", "s"), (3, a, "en", "t"), (4, b, "en", "s"), (5, b, "en", "s")])
    assert sorted(r.doc_id for r in C.near(spark, docs, SF).collect()) == [1, 4]


def test_run_chains_the_stages(spark):
    """``run`` gives the last stage's rows, for documents that the stages before it left."""
    out = C.run(spark, SF)
    ids = {r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect()}
    rows = out.collect()
    assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert 0 < len(rows) < len(ids) and {r.doc_id for r in rows} <= ids and all(0 <= r.taken <= 2 * r.size for r in rows)
