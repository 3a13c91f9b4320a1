from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kinmatch.operators import state
from kinmatch.plans import queries as q
from kinmatch.schemas import MODELS, PRODUCT_CLUSTERS
from kinmatch.session import scratch_path

NOW = datetime(2024, 5, 1)
OLD = datetime(2023, 1, 1)


@pytest.fixture()
def table(spark):
    rows = [(1, 10, 10, None, 7, 1, OLD), (2, 11, 11, 5, None, 2, OLD), (3, 12, 12, 6, None, 5, OLD)]
    return spark.createDataFrame(rows, PRODUCT_CLUSTERS)


def ids(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_save_clusters_expires_and_reapplies_the_size(spark, table):
    found = spark.createDataFrame([(20, 0), (21, 0), (22, 0), (23, 1), (24, 1), (25, 1)], "id bigint, cluster bigint")
    products = spark.createDataFrame(
        [(20, None), (21, None), (22, None), (23, None), (24, None), (25, 9)], "id bigint, master_product_id bigint"
    )
    now, history = state.save_clusters(table, found, products, 3, NOW)
    assert now.columns == table.columns
    assert ids(now.where("id <= 3").na.fill(-1), "id", "cluster_id", "master_product_status_id") == [
        (1, -1, 4), (2, -1, 2), (3, -1, 5)
    ]
    assert ids(now.where("id > 3"), "id", "internal_product_id", "cluster_id", "master_product_status_id") == [
        (4, 20, 0, 1), (5, 21, 0, 1), (6, 22, 0, 1)
    ]
    assert {r["created_at"] for r in now.where("id > 3").collect()} == {NOW}
    assert ids(history, *state.HISTORY) == [(1, 1, 4), (4, 1, 1), (5, 1, 1), (6, 1, 1)]


def test_suggestions_keep_the_cluster_and_may_only_add(spark, table):
    matches = spark.createDataFrame([(30, 5, 1, 0.9), (31, 6, 0, 0.1)], "id1 bigint, id2 bigint, match int, prob double")
    now, history = state.save_suggestions(table, matches, NOW)
    assert ids(now, "id", "master_product_status_id") == [(1, 1), (2, 2), (3, 4), (4, 5)]
    assert ids(history, *state.HISTORY) == [(3, 5, 4), (4, 5, 5)]
    added, history = state.add_suggestions(table, matches, NOW)
    assert ids(added, "id", "master_product_status_id") == [(4, 5)]
    assert ids(history, *state.HISTORY) == [(4, 5, 5)]


def test_nothing_new_on_an_empty_table(spark):
    empty = spark.createDataFrame([], PRODUCT_CLUSTERS)
    none = spark.createDataFrame([], "id1 bigint, id2 bigint, match int, prob double")
    now, history = state.save_suggestions(empty, none, NOW)
    assert now.count() == 0 and history.count() == 0


def test_runs_write_only_their_own_rows(spark, table):
    path = scratch_path(spark, "runs")
    state.write_run(table, path, "1")
    state.write_run(table.where("id < 3"), path, "2")
    state.write_run(table.where("id = 1"), path, "2")
    assert state.read_run(spark, path, "1").count() == 3 and state.read_run(spark, path, "2").count() == 1
    together = state.read_runs(spark, path)
    assert ids(together, "run", "id") == [("1", 1), ("1", 2), ("1", 3), ("2", 1)]


def test_scratch_is_removed_after_its_scope(spark):
    from kinmatch.session import scratch_scope

    with scratch_scope(spark):
        path = scratch_path(spark, "scoped")
        spark.range(3).write.parquet(path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_gates_move_on(spark):
    counted = spark.createDataFrame([("a", 100), ("b", 100)], "gate string, count_now bigint")
    stored = spark.createDataFrame(
        [("a", 80, OLD), ("b", 98, OLD), ("z", 5, OLD)], "gate string, stored_count bigint, last_run timestamp"
    )
    decided = state.change_gate(counted, stored, 10)
    assert ids(state.advance_gates(decided, stored, NOW), "gate", "stored_count", "last_run") == [
        ("a", 100, NOW), ("b", 98, OLD), ("z", 5, OLD)
    ]


def test_cache_keeps_stored_pairs_and_other_models(spark):
    path = scratch_path(spark, "cache")
    cache = spark.createDataFrame(
        [(1, 2, 1, 0.9, 7), (1, 3, 0, 0.2, 8)],
        "product_source_id_1 bigint, product_source_id_2 bigint, match int, prob double, model_id bigint",
    )
    state.write_cache(cache, path)
    scored = spark.createDataFrame([(1, 2, 0, 0.1), (4, 5, 1, 0.8)], "id1 bigint, id2 bigint, match int, prob double")
    updated = state.cache_scores(cache, scored, 7)
    assert ids(updated, "product_source_id_1", "product_source_id_2", "prob") == [(1, 2, 0.9), (4, 5, 0.8)]
    state.write_cache(updated, path)
    stored = spark.read.parquet(path)
    assert ids(stored, "model_id", "prob") == [(7, 0.8), (7, 0.9), (8, 0.2)]


def test_cached_pairs_are_not_scored_again(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "id1 bigint, id2 bigint")
    cached = spark.createDataFrame([(1, 3, 1, 0.7)], "id1 bigint, id2 bigint, match int, prob double")
    left = state.without_cached(pairs, cached)
    assert ids(left, "id1", "id2") == [(1, 2), (2, 3)]
    assert state.with_cached(None, cached).count() == 1


def test_registering_a_model(spark):
    models = spark.createDataFrame(
        [(1, "a", "x/a", True, "t", OLD), (2, "b", "x/b", True, "u", OLD)], MODELS
    )
    out = state.register_model(models, "models/c", "t", NOW)
    assert ids(out, "id", "name", "in_use") == [(1, "a", False), (2, "b", True), (3, "c", True)]
    kept = state.keep_newest_in_use(out)
    assert ids(kept, "id", "in_use") == [(1, False), (2, True), (3, True)]
    first = state.register_model(spark.createDataFrame([], MODELS), "m", "t", NOW)
    assert ids(first, "id", "in_use") == [(1, True)]


def test_change_gate(spark):
    counted = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100), ("d", 100)], "gate string, count_now bigint")
    stored = spark.createDataFrame(
        [("a", 80, OLD), ("b", 98, OLD), ("c", 98, OLD)], "gate string, stored_count bigint, last_run timestamp"
    )
    newest = spark.createDataFrame([("c", NOW), ("d", NOW)], "gate string, created_at timestamp")
    out = ids(state.change_gate(counted, stored, 10, newest), "gate", "triggered", "next_count")
    assert out == [("a", True, 100), ("b", False, 98), ("c", True, 100), ("d", False, 100)]


@pytest.mark.parametrize("with_null", [False, True])
@pytest.mark.parametrize("empty", [False, True])
def test_pending_products_follow_sql(spark, with_null, empty):
    products = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id bigint")
    rows = [] if empty else [(1, 3), (2, 2)] + ([(None, 2)] if with_null else [])
    clusters = spark.createDataFrame(rows, "id bigint, master_product_status_id int")
    want = spark.sql(
        """SELECT id FROM {p} WHERE id IN (SELECT id FROM {c} WHERE master_product_status_id = 3)
           OR id NOT IN (SELECT id FROM {c})""", p=products, c=clusters,
    )
    got = q.pending_products(products, clusters)
    key = lambda df: sorted(map(str, (r["id"] for r in df.collect())))
    assert key(got) == key(want)


def test_thousands(spark):
    row = spark.range(1).select(q.thousands(F.lit(1234567.9)).alias("t")).first()
    assert row["t"] == "1,234,567"
