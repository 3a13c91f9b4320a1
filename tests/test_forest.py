import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.operators import forest as f
from kinmatch.operators import knn

from .test_knn import found, table, unit


def as_base(df):
    return df.select(F.col("id").alias("b_id"), F.col("vec").alias("b_vec"))


def as_queries(df, k):
    return df.select(F.col("id").alias("q_id"), F.col("vec").alias("q_vec"), F.lit(k).alias("k"), F.lit(-2.0).alias("floor"))


def recall(near, exact):
    exact = {(q, b) for q, bs in exact.items() for b in bs}
    return len(exact & {(q, b) for q, bs in near.items() for b in bs}) / len(exact)


@pytest.fixture(scope="module")
def vectors():
    return np.random.default_rng(8).normal(size=(1_200, 16))


def test_trees_halve_their_nodes(spark, vectors):
    made = f.fit_forest(as_base(table(spark, vectors)), len(vectors), 6)
    points = knn._lifted(unit(vectors))
    leaves = made.leaves(points)
    assert made.trees == 6 and made.depth == 9
    for tree in range(6):
        sizes = np.bincount(leaves[:, tree], minlength=1 << made.depth)
        assert sizes.max() <= 8 and 2 <= np.median(sizes) <= 3


def test_nearest_leaves_are_the_nearest(spark, vectors):
    made = f.fit_forest(as_base(table(spark, vectors[:200])), 200, 3)
    points = knn._lifted(unit(vectors[:20]))
    every, price = made.nearest_leaves(points, beam=1 << made.depth)
    own = made.leaves(points)
    some, low = made.nearest_leaves(points, beam=5)
    for r in range(20):
        for t in range(3):
            assert own[r, t] in every[r, t][price[r, t] == 0]
            assert np.allclose(np.sort(low[r, t]), np.sort(price[r, t])[:5])


def test_recall_and_share_on_vectors_without_structure(spark, vectors):
    items = table(spark, vectors)
    exact = found(knn.knn_join(items, items, 5, without_self=True))
    near = found(knn.knn_join(items, items, 5, without_self=True, strategy="forest"))
    assert recall(near, exact) >= 0.9 and all(len(v) == 5 and k not in v for k, v in near.items())


def test_clustered_vectors_need_few_trees_and_rows(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(200, 32))
    items = table(spark, centres[rng.integers(0, 200, 6_000)] + 0.1 * rng.normal(size=(6_000, 32)))
    q, b = as_queries(items, 5), as_base(items)
    made, probes = f.plan_forest(q, b, 6_000, 5, without_self=True)
    leaved = f.assign_leaves(b, made)
    near = f.search_forest(q, made, leaved, probes, without_self=True, most=5)
    exact = found(knn.knn_join(items, items, 5, without_self=True))
    share = f.rows_compared(q, made, leaved, probes).agg(F.avg("rows") / 6_000).first()[0]
    assert recall(found(near), exact) >= 0.9 and share <= 0.1 and made.trees <= 16


def test_small_tiles_and_chunks_give_the_same(spark, vectors):
    items = table(spark, vectors[:600])
    q, b = as_queries(items, 4), as_base(items)
    made = f.fit_forest(b, 600, 4)
    wide = found(f.search_forest(q, made, f.assign_leaves(b, made), 40, most=4))
    narrow = found(f.search_forest(q, made, f.assign_leaves(b, made, 32), 40, most=4, tile_rows=32, chunk_rows=64))
    assert wide == narrow


def test_copies_zero_vectors_and_few_rows(spark):
    vectors = np.zeros((400, 6))
    vectors[::3] = [1, 2, 3, 4, 5, 6]
    vectors[1::3] = np.random.default_rng(0).normal(size=(133, 6))
    items = table(spark, vectors)
    near = found(knn.knn_join(items, items, 3, without_self=True, strategy="forest"))
    assert near[0] == [3, 6, 9] and near[399] == [0, 3, 6]
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0])], "id bigint, vec array<double>")
    assert found(knn.knn_join(two, two, 3, strategy="forest")) == {1: [1]}
    assert knn.knn_join(two.limit(0), two, 3, strategy="forest").count() == 0
    assert knn.knn_join(two, two.limit(0), 3, strategy="forest").count() == 0
