import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinmatch.operators import components as c


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


GRAPHS = {
    "random": lambda r: [(r.randrange(200), r.randrange(200)) for _ in range(120)],
    "chain": lambda r: [(i, i + 1) for i in range(64)],
    "star": lambda r: [(150, i) for i in range(150)],
    "reversed": lambda r: [(i + 1, i) for i in range(20)] + [(5, 5), (300, 300), (0, 20)],
    "empty": lambda r: [],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components_match_union_find(spark, name):
    edges = GRAPHS[name](random.Random(name))
    df = spark.createDataFrame(edges, "id1 bigint, id2 bigint")
    got = {r["id"]: r["component"] for r in c.connected_components(df).collect()}
    assert got == union_find(edges)


@pytest.fixture()
def matches(spark):
    return spark.createDataFrame(
        [(1, 2, 1, 0.9), (2, 3, 1, 0.9), (4, 5, 1, 0.9), (6, 7, 0, 0.1), (8, 9, 1, None)],
        "id1 bigint, id2 bigint, match int, prob double",
    )


def test_clusters_drop_small_ones_and_renumber(spark, matches):
    products = spark.range(1, 12)
    got = {r["id"]: r["cluster"] for r in c.cluster_matches(matches, products, 2).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1}
    assert {r["id"] for r in c.cluster_matches(matches, products, 3).collect()} == {1, 2, 3}
    assert c.cluster_matches(matches, products, 1).count() == 11


def test_every_product_gets_a_cluster(spark, matches):
    got = {r["id"]: r["fin"] for r in c.cluster_all(spark.range(1, 8), matches).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 2, 7: 3}


def average_link(scores, threshold):
    """One merge at a time: the closest pair above the threshold, smaller labels first on ties."""
    clusters = {x: [x] for pair in scores for x in pair}

    def mean(a, b):
        total = sum(scores.get((min(x, y), max(x, y)), 0.0) for x in clusters[a] for y in clusters[b])
        return round(total / (len(clusters[a]) * len(clusters[b])), 9)

    while True:
        options = [(-mean(a, b), a, b) for a in clusters for b in clusters if a < b]
        options = [o for o in options if -o[0] > threshold]
        if not options:
            return {x: k for k, members in clusters.items() if len(members) > 1 for x in members}
        _, a, b = min(options)
        clusters[a] += clusters.pop(b)


@pytest.mark.parametrize("task_links", [1 << 20, 12, 0])
@pytest.mark.parametrize("seed", range(3))
def test_average_link_matches_one_at_a_time_merging(spark, seed, task_links):
    r = random.Random(seed)
    scores = {}
    for _ in range(70):
        a, b = sorted(r.sample(range(25), 2))
        scores[a, b] = round(r.random(), 6)
    df = spark.createDataFrame([(b, a, p) for (a, b), p in scores.items()], "id1 bigint, id2 bigint, prob double")
    got = {x["id"]: x["cluster"] for x in c.average_link_clusters(df, 0.35, task_links).collect()}
    assert got == average_link(scores, 0.35)


@pytest.mark.parametrize("limit", [4, 16])
def test_components_when_a_task_holds_few_edges(spark, monkeypatch, limit):
    monkeypatch.setattr(c, "CONTRACT_EDGES", limit)
    edges = GRAPHS["random"](random.Random(9)) + [(i, i + 1) for i in range(300, 360)]
    df = spark.createDataFrame(edges, "id1 bigint, id2 bigint").repartition(6)
    got = {r["id"]: r["component"] for r in c.connected_components(df).collect()}
    assert got == union_find(edges)


def test_contraction_alone_keeps_the_components():
    import numpy as np

    edges = GRAPHS["random"](random.Random(4)) + GRAPHS["chain"](None)
    a, b = (np.array(x) for x in zip(*edges))
    member, root = c._stars(a, b)
    want = {x: r for x, r in union_find(edges).items() if x != r}
    got = list(zip(member.tolist(), root.tolist()))
    assert {x: r for x, r in got if x != r} == want
    assert {x for x, r in got if x == r} == {x for x, y in edges if x == y}


@given(st.dictionaries(st.tuples(st.integers(0, 9), st.integers(0, 9)).filter(lambda p: p[0] < p[1]), st.sampled_from([0.2, 0.4, 0.5, 0.5, 0.9, 0.77])))
@settings(max_examples=300, deadline=None)
def test_merging_in_memory_with_many_ties(scores):
    a, b = ([p[k] for p in scores] for k in (0, 1))
    found = c._merge_closest(a, b, list(scores.values()), {x: 1 for x in (*a, *b)}, 0.35)
    want = average_link(scores, 0.35)
    assert {**found, **{x: x for x in found.values()}} == want


def test_a_chain_of_falling_scores_needs_few_rounds(spark, monkeypatch):
    n, rounds = 10_000, []
    real = c.connected_components
    monkeypatch.setattr(c, "connected_components", lambda *a, **k: rounds.append(1) or real(*a, **k))
    chain = spark.range(n).select(F.col("id").alias("id1"), (F.col("id") + 1).alias("id2"), (1 - F.col("id") / (2 * n)).alias("prob"))
    got = {x["id"]: x["cluster"] for x in c.average_link_clusters(chain, 0.35).collect()}
    links = [(r["id1"], r["id2"], r["prob"]) for r in chain.collect()]
    a, b, total = (list(x) for x in zip(*links))
    found = c._merge_closest(a, b, total, {x: 1 for x in range(n + 1)}, 0.35)
    assert got == {**found, **{x: x for x in found.values()}} and len(rounds) < 20
    # two neighbours of a chain make a cluster: their mean to the next is half a score
    assert got[0] == got[1] == 0 and got[2] != 0


def test_clusters_of_odd_pairs(spark):
    rows = [(1, 1, 0.9), (1, 2, 0.5), (2, 1, 0.8), (3, 4, 0.0), (5, 6, -1.0), (7, None, 0.9), (8, 9, None)]
    df = spark.createDataFrame(rows, "id1 bigint, id2 bigint, prob double")
    assert sorted(tuple(r) for r in c.average_link_clusters(df).collect()) == [(1, 1), (2, 1)]
    assert c.average_link_clusters(df.limit(0)).count() == 0


def test_rounds_run_in_tasks_that_do_not_grow(spark, monkeypatch):
    """More edges make more tasks than the session's shuffle partitions, not larger ones."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before, seen, real = spark.conf.get(key, None), [], c.cut_lineage
    monkeypatch.setattr(c, "cut_lineage", lambda df: seen.append(int(spark.conf.get(key))) or real(df))
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] * 3, "id1 bigint, id2 bigint")
    got = {(r["id"], r["component"]) for r in c.connected_components(edges).collect()}
    assert got == {(i, 0) for i in range(51)}
    assert seen and min(seen) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(key, None) == before


def test_a_task_of_small_tasks_is_bounded(spark):
    from pyspark.sql import functions as F

    from kinmatch.session import small_tasks

    rows = spark.range(12_000_000).select(F.xxhash64("id").alias("a")).repartition("a")
    with small_tasks(spark):
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 12_000_000 and max(sizes) < 1_000_000
