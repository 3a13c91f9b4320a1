import re

import pytest

import corpus_pipeline
from kinmatch.llm import queries as q
from kinmatch.llm.common import written

from .helpers import clashing, documents, empty
from .test_decontam import brute
from .test_simhash import plain_components, plain_fingerprint


def test_stages_and_registration():
    import __spark_entry__ as entry

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language ID", "SimHash near-dedup", "benchmark decontamination", "packing"
    ]
    assert {"pipeline", *q.QUERIES} <= set(entry.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in q.QUERIES) == list(range(1, 11))


def test_stages_decide_as_a_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        after = written(stage(spark, docs, sf), "test-stage")
        kept = {r["doc_id"] for r in after.select("doc_id").collect()}
        if name != "packing":
            assert after.columns == docs.columns and kept <= set(before)
        if name == "toxicity":
            wrong = [i for i, t in labels.items() if i in before and (i in kept) == bool(t)]
            assert len(wrong) <= 0.05 * len(labels)
        elif name == "language ID":
            assert all(i in kept for i, t in before.items() if len(t or "") > 60 and re.search("[a-z]", t))
            assert all(any(map(str.isalpha, before[i] or "")) for i in kept)
        elif name == "SimHash near-dedup":
            label = plain_components({i: plain_fingerprint(t) for i, t in before.items()})
            assert kept == set(label.values())
        elif name == "benchmark decontamination":
            assert kept == {i for i, t in before.items() if not brute(bench, t)[1]}
        else:
            sizes = {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
            assert set(sizes) == set(before) and all(n >= 1 for n in sizes.values())
        docs = after


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_awkward_and_empty_documents(spark, sf, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs, least in ((clashing(documents(spark)), 3), (empty(spark), 0)):
        out = stage(spark, docs, sf)
        assert out.count() >= least
        if name != "packing":
            assert out.columns == docs.columns
            if least:
                assert {r["score"] for r in out.collect()} == {"x"}


@pytest.mark.parametrize("marks", [[], [(10**9, 1, 1)], [(0, 1, None)]])
def test_toxicity_keeps_all_when_nothing_is_learned(spark, tmp_path, marks):
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, str(tmp_path)).count() == docs.count()
    assert {r["toxic"] for r in q.QUERIES["op10_toxicity"](spark, str(tmp_path)).collect()} == {False}
