import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.operators import knn
from kinmatch.session import scratch_path
from kinmatch.sources.vector_index import GrowingIndex, build_index, load_index, save_index, search_index

from .test_knn import found, table


def saved(spark, items):
    path = scratch_path(spark, "index")
    save_index(build_index(items), spark, path)
    return load_index(spark, path)


def test_a_saved_index_knows_its_probes(spark):
    items = table(spark, np.random.default_rng(2).normal(size=(2_000, 24)))
    cells = saved(spark, items)
    exact = found(knn.knn_join(items, items, 5))
    hits = found(search_index(cells, items, 5, strategy="ivf"))
    near = sum(len(set(v) & set(hits[q])) for q, v in exact.items()) / (5 * len(exact))
    few = found(search_index(cells, items, 5, strategy="ivf", probes=2))
    assert cells.probes > 2 and near >= 0.9 and sum(len(set(v) & set(few[q])) for q, v in exact.items()) < near * 5 * len(exact)


@pytest.mark.parametrize("strategy", ["exact", "ivf"])
def test_unsound_vectors_cost_no_neighbours(spark, strategy):
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.8, 0.2]), (4, [float("nan"), 1.0]), (5, None), (6, [None, 1.0])]
    items = spark.createDataFrame(rows, "id bigint, vec array<float>")
    hits = found(search_index(saved(spark, items), items, 3, strategy=strategy, probes=9))
    assert {q: sorted(v) for q, v in hits.items()} == {q: [1, 2, 3] for q in (1, 2, 3)}


def test_an_empty_index(spark):
    none = spark.createDataFrame([], "id bigint, vec array<float>")
    some = spark.createDataFrame([(1, [1.0])], "id bigint, vec array<float>")
    for strategy in ("exact", "ivf"):
        hits = search_index(saved(spark, none), some, 3, strategy=strategy)
        assert hits.columns == ["q_id", "b_id", "sim", "dist", "rank"] and hits.count() == 0
        assert search_index(saved(spark, some), none, 3, strategy=strategy).count() == 0


def after(rows, version):
    return {i: v for i, v in rows.items() if v is not None}


def test_runs_splits_and_merges_answer_like_a_new_index(spark):
    rng = np.random.default_rng(4)
    make = lambda n: [[float(x) for x in v] for v in rng.normal(size=(n, 8)).astype(np.float32)]
    frame = lambda d: spark.createDataFrame(list(d.items()), "id bigint, vec array<float>").repartition(3)
    index = GrowingIndex(spark, scratch_path(spark, "growing"))
    rows = dict(enumerate(make(300)))
    at = index.create(frame(rows))

    def same(strategy="exact"):
        items = frame(rows)
        got = found(index.search(at, items, 4, strategy=strategy, probes=3 if strategy == "exact" else None))
        want = found(knn.knn_join(items, items, 4))
        if strategy == "exact":
            assert got == want
        else:
            assert sum(len(set(v) & set(got[q])) for q, v in want.items()) >= 0.9 * 4 * len(want)

    same()
    # many alike: one cell becomes overfull
    dense = {1_000 + i: [float(np.float32(x)) for x in rows[5] + 0.2 * rng.normal(size=8)] for i in range(400)}
    new = {**dense, 3: make(1)[0], 4: None}
    at = index.change(at, frame(new), frame({7: None, 3: None}))
    rows = {i: v for i, v in {**rows, **new}.items() if v is not None and i != 7}
    same()
    cells = len(index.cells(at).pivots)
    split = index.split(at, overfull=3.0, least_rows=20)
    assert split == at + 1 and index.split(at, overfull=1e9) == at
    at = split
    grown = index.cells(at)
    assert len(grown.pivots) > cells and (grown.roots != np.arange(len(grown.pivots))).sum() == len(grown.pivots) - cells
    sizes = [r["n"] for r in grown.base.groupBy("cell").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 200
    same()
    same("ivf")
    at = index.change(at, frame({7: make(1)[0], 2_000: make(1)[0]}), frame({1_001: None}))
    changed = {r["b_id"]: r["b_vec"] for r in index.cells(at).base.where("b_id IN (7, 2000)").collect()}
    rows = {**{i: v for i, v in rows.items() if i != 1_001}, **changed}
    same()
    at = index.merge(at)
    assert index.segments(at)[0] == [f"v{at}"]
    same()
    # an earlier version is still there
    assert index.cells(0).base.count() == 300


def test_an_index_needs_a_vector(spark):
    with pytest.raises(ValueError):
        GrowingIndex(spark, scratch_path(spark, "growing")).create(spark.createDataFrame([], "id bigint, vec array<float>"))
