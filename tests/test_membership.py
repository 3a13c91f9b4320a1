import numpy as np
from pyspark.sql import functions as F

from kinmatch.operators.membership import _places, build_filters, may_be_stored, not_stored
from kinmatch.operators.state import read_runs, without_cached, write_run
from kinmatch.session import scratch_path

PAIRS = "id1 bigint, id2 bigint"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_places_are_spread_and_the_same_everywhere():
    h = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 20_000)
    at = _places(h, 7, 4096)
    assert at.min() >= 0 and at.max() < 4096 and np.array_equal(at, _places(h, 7, 4096))
    assert np.bincount(at.ravel(), minlength=4096).std() < 12


def test_exact_and_sparing(spark):
    n = 60_000
    stored = spark.range(n).select((F.col("id") * 3).alias("id1"), (F.col("id") % 977).alias("id2"))
    filters = build_filters(stored, part_pairs=5_000)
    assert filters.count() == 12 and filters.agg(F.sum("pairs")).first()[0] == n
    asked = spark.range(n).select(F.col("id").alias("id1"), (F.col("id") % 977).alias("id2"))
    for limit in (1 << 20, 0):
        looked = not_stored(asked, stored, filters, broadcast_pairs=limit)
        assert rows(looked.absent) == rows(without_cached(asked, stored))
        assert looked.asked == n and looked.stored == n - looked.absent.count() and looked.skipped > 0.98


def test_no_stored_pair_is_ruled_out(spark):
    stored = spark.range(30_000).select(F.col("id").alias("id1"), F.hash("id").cast("bigint").alias("id2"))
    filters = build_filters(stored, part_pairs=1_000)
    assert may_be_stored(stored, filters).count() == 30_000


def test_filters_of_several_runs(spark):
    path = scratch_path(spark, "filters")
    runs = [spark.range(k * 1_000, (k + 1) * 1_000 + 50).select(F.col("id").alias("id1"), F.lit(k).cast("bigint").alias("id2")) for k in range(3)]
    for k, run in enumerate(runs):
        write_run(build_filters(run, part_pairs=300 * (k + 1)), path, str(k))
    stored = runs[0].unionAll(runs[1]).unionAll(runs[2])
    asked = spark.range(4_000).select(F.col("id").alias("id1"), F.floor(F.col("id") / 1_000).alias("id2"))
    looked = not_stored(asked, stored, read_runs(spark, path))
    assert rows(looked.absent) == [(i, 3) for i in range(3_000, 4_000)] and looked.stored == 3_000


def test_odd_pairs_and_empty_sides(spark):
    stored = spark.createDataFrame([(1, 2), (1, 2), (None, 2), (3, None)], PAIRS)
    asked = spark.createDataFrame([(1, 2), (2, 1), (2, 1), (None, 2), (3, None)], PAIRS)
    filters = build_filters(stored)
    assert [r["pairs"] for r in filters.collect()] == [1]
    assert rows(not_stored(asked, stored, filters).absent) == rows(without_cached(asked, stored))
    nothing = stored.limit(0)
    assert build_filters(nothing).count() == 0
    looked = not_stored(asked, nothing, build_filters(nothing))
    assert rows(looked.absent) == rows(asked) and looked.maybe == 0 and looked.skipped == 1.0
    assert not_stored(nothing, stored, filters).absent.count() == 0


def test_one_offer_in_a_third_of_all_pairs(spark):
    stored = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id1"), F.col("id").alias("id2"))
    sizes = [r["pairs"] for r in build_filters(stored, part_pairs=1_000).collect()]
    assert len(sizes) == 30 and max(sizes) < 1_300
