import inspect

import compare
import edges
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from skyledger.llm import queries
from test_duplicates import contamination, linked

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare.difference(spark, compare.connect(SF), SF, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"pipeline"}))
def test_query_runs_whole(spark, name):
    out = queries.QUERIES[name](spark, SF)
    if name != "op5_secret_scan":
        assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        path = str(tmp_path / str(n))
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        was = [(r.doc_id, r.text) for r in before.collect()]
        now = [(r.doc_id, r.text) for r in docs.collect()]
        if n < 4:
            assert docs.columns == before.columns
        if n == 1:
            assert sorted(i for i, _ in now) == sorted(i for i, root in linked(was, 5, 80).items() if i == root)
        if n == 2:
            assert sorted(i for i, _ in now) == sorted(r[0] for r in contamination(was, items) if not r[4])
        if n == 4:
            assert sorted(now) == sorted(was) and {"shard", "old_shard"} <= set(docs.columns)
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_pipeline_edges(spark, tmp_path):
    for k, docs in enumerate((edges.documents(spark), edges.no_documents(spark))):
        rows = docs.count()
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{k}-{n}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() <= 3 * rows and {"shard", "old_shard", "_shard"} & set(docs.columns)


def test_the_driver_gives_its_memory_back_after_each_stage(spark, monkeypatch):
    import corpus_pipeline
    from skyledger.llm import shared

    given = []
    monkeypatch.setattr(shared, "give_back", lambda: given.append("memory"))
    shared.released(spark)
    assert given == ["memory"]
    plain = lambda spark, docs, sf_dir: docs
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", plain), ("b", plain), ("c", plain)])
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert given == ["memory"] * 3
