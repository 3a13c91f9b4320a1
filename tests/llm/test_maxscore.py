import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinmatch.llm.maxscore import Shard, scaled, search_top_k
from tests.compare import compare, connect


def brute(base, queries, k):
    out = []
    for q, v in queries:
        best = sorted((-int(np.dot(v, w)), i) for i, w in base if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@given(st.integers(0, 2**32), st.integers(0, 120), st.integers(1, 12), st.sampled_from([1, 3, 40]))
@settings(max_examples=150, deadline=None)
def test_shard_against_all_products(seed, n, dims, top):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-top, top + 1, (n, dims)) * rng.integers(0, 2, (n, dims))
    ids = rng.permutation(500)[:n]
    part = Shard(ids, vectors.astype(float))
    for query in rng.integers(-top, top + 1, (4, dims)):
        found, scores = part.search(query.astype(float), 5, int(ids[0]) if n else -1, -np.inf)
        want = brute([*zip(ids.tolist(), vectors)], [(int(ids[0]) if n else -1, query)], 5)
        assert [(i, s) for i, s in zip(found.tolist(), scores.tolist())] == [(i, s) for _, _, i, s in want]


def test_a_floor_leaves_out_only_what_cannot_compete():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-30, 31, (400, 16)).astype(float)
    part = Shard(np.arange(400), vectors)
    query = rng.integers(-30, 31, 16).astype(float)
    scores = vectors @ query
    floor = float(np.sort(scores)[-3])
    found, got = part.search(query, 5, -1, floor)
    assert got.tolist() == sorted(scores[scores >= floor].tolist(), reverse=True) and len(found) == 3


@pytest.mark.parametrize(("shard", "block"), [(1 << 13, 1 << 14), (7, 3)])
def test_search_over_shards_and_blocks(spark, shard, block):
    rng = np.random.default_rng(4)
    rows = [(i, [int(x) for x in rng.integers(-4, 5, 6)]) for i in range(90)]
    rows += [(90, [1, 2]), (91, []), (92, None), (93, [1, None, 3]), (None, [1] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>").withColumns({"score": F.lit(1), "q": F.lit(2)}).repartition(3)
    asked = df.where("vec_id % 10 = 0")
    out = sorted(tuple(r) for r in search_top_k(df, asked, shard=shard, block=block).collect())
    sound = [(i, np.array([*v, *[0] * (6 - len(v))])) for i, v in rows if i is not None and v is not None and None not in v]
    assert out == brute(sound, [(i, v) for i, v in sound if i % 10 == 0], 5)


def test_fewer_candidates_ties_and_empty_sides(spark):
    df = spark.createDataFrame([(5, [1]), (3, [1]), (0, [2]), (9, [1])], "vec_id bigint, vector array<bigint>")
    out = [tuple(r) for r in search_top_k(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    assert out == [(0, 1, 3, 2), (0, 2, 5, 2), (0, 3, 9, 2)]
    assert search_top_k(df, df.limit(0)).count() == 0 and search_top_k(df.limit(0), df).count() == 0


def test_scaling(spark):
    rows = [([0.5, -0.001],), ([float("nan")],), ([float("inf")],), (None,), ([None],), ([],)]
    df = spark.createDataFrame(rows, "v array<float>")
    assert [r["s"] for r in df.select(scaled(F.col("v")).alias("s")).collect()] == [[128, -1], None, None, None, None, []]


def test_query_against_sql(spark, sf):
    from kinmatch.llm.queries import ORACLES, QUERIES

    message, rows, _ = compare(spark, connect(sf), sf, QUERIES["op8_top_k"], ORACLES["op8_top_k"])
    assert message is None and rows == 50
