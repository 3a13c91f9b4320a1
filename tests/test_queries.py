"""Every registered query against its SQL counterpart on the smallest tables, and its plan."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from kinmatch.registry import ORACLES, QUERIES
from tests.compare import compare, connect

REPO = os.path.dirname(os.path.abspath(entry.__file__))

# Queries whose plan is only fixed after jobs have run inside the call.
EAGER_FREE = [n for n in QUERIES if n in (
    "labelled_products", "pending_count", "matcher_input", "oneshot_input", "mixed_union", "latest_per_tag",
    "attach_masters", "pair_names", "keep_listed", "drop_listed", "groups_min_count", "duplicated_rows",
    "first_per_key", "distinct_two_cols", "regex_sizes", "serialize_lookup", "zscore", "pos_all_orders",
    "cache_upsert", "cache_anti", "classification_report", "argmax_master", "cluster_master_map",
    "register_latest", "change_gate", "mean_pool", "pair_losses", "knn_self_topk", "block_pairs", "neg_hard",
)]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    message, rows, _ = compare(spark, con, sf, QUERIES[name], ORACLES.get(name))
    assert message is None


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", EAGER_FREE)
def test_no_nested_loop_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["category_slice"](spark, sf))
    assert "EqualTo(lang,de)" in text and "n_chars" not in text.split("ReadSchema")[1]
    text = plan(QUERIES["live_masters"](spark, sf))
    assert "p_retailprice" not in text.split("ReadSchema")[1]


def test_keep_first_is_limited_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(QUERIES["first_per_key"](spark, sf))


def test_entry_gives_the_known_clusters(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "cluster"]
    assert df.select("cluster").distinct().count() == 17


def test_components_of_a_whole_table(spark, sf):
    from tests.test_components import union_find

    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_partkey").collect()
    want = union_find([(2 * r[0], 2 * r[1] + 1) for r in lines])
    assert {r["id"]: r["component"] for r in QUERIES["components_lineitem"](spark, sf).collect()} == want


def test_workers_need_no_copy_of_the_package():
    code = (
        f"import sys; sys.path.insert(0, {REPO!r}); import __spark_entry__ as e; "
        "from pyspark.sql import SparkSession; "
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); "
        "print('rows', e.queries()['knn_self_topk'](s, '/root/testdata/sf0.001').count())"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=300)
    assert "rows 3000" in run.stdout, run.stderr[-2000:]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
