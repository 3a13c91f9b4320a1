"""Stratified samples, stored sketches, generators in SQL and tables stored by id."""

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from kinmatch.functions.numeric import draw, drawn_below
from kinmatch.operators import colocated, sampling
from kinmatch.operators.distinct import estimate_distinct, sketch_distinct
from kinmatch.operators.generators import register_generator
from kinmatch.operators.rows import lookup_both
from kinmatch.operators.state import read_runs, write_run
from kinmatch.session import scratch_path


def test_hex_draws_compare_like_numbers(spark):
    rows = spark.range(500).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT) AS id"))
    for cut in (0, 1, 1 << 20, 0x26666666, (1 << 32) - 1, 1 << 32):
        both = rows.select((draw("id", seed=3) < cut).alias("a"), drawn_below(cut, "id", seed=3).alias("b"))
        assert both.where("a != b").isEmpty()


@pytest.mark.parametrize("held", [1 << 18, 50])
def test_exactly_n_of_each_stratum(spark, monkeypatch, held):
    monkeypatch.setattr(sampling, "HELD_ROWS", held)
    df = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 20, None).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("kind"))
    got = {}
    for r in sampling.stratified_sample(df, "kind", "id", 25, seed=5).collect():
        got.setdefault(r["kind"], set()).add(r["id"])
    drawn = sorted((r["d"], r["id"], r["kind"]) for r in df.withColumn("d", draw("id", seed=5)).collect())
    want = {}
    for _, i, kind in drawn:
        if len(want.setdefault(kind, set())) < 25:
            want[kind].add(i)
    assert got == want and len(got[None]) == 13


def test_a_hot_stratum_is_merged_in_many_tasks(spark):
    df = spark.range(20_000).select("id", F.lit("one").alias("kind")).repartition(8)
    text = sampling.stratified_sample(df, "kind", "id", 100, parts=16)._jdf.queryExecution().toString()
    assert text.count("hashpartitioning(__stratum") >= 2 or text.count("RepartitionByExpression [__stratum") >= 2
    parts = df.select(F.pmod(F.xxhash64(draw("id"), "id"), F.lit(16)).alias("p")).groupBy("p").count().collect()
    assert len(parts) == 16 and max(r["count"] for r in parts) < 1_600


def test_odd_samples(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, None)], "id bigint, kind string")
    assert sampling.stratified_sample(df, "kind", "id", 10).count() == 4
    assert sampling.stratified_sample(df, "kind", "id", 1).count() == 2
    assert sampling.stratified_sample(df.limit(0), "kind", "id", 3).columns == ["id", "kind"]
    assert sampling.stratified_sample(df.limit(0), "kind", "id", 3).count() == 0


def test_sketches_of_overlapping_runs(spark):
    path = scratch_path(spark, "sketches")
    ids = spark.range(60_000).select("id", (F.col("id") + 30_000).alias("other"), (F.col("id") % 2).alias("g"))
    for run, rule in (("1", "id < 40000"), ("2", "id >= 20000")):
        write_run(sketch_distinct(ids.where(rule), ["id", "other"], ["g"]), path, run)
    for r in estimate_distinct(read_runs(spark, path), ["g"]).collect():
        assert abs(r["n"] - 45_000) <= 900
    whole = estimate_distinct(read_runs(spark, path)).first()["n"]
    assert abs(whole - 90_000) <= 1_800


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([(None, None), (None, None)], "a bigint, b bigint")
    assert estimate_distinct(sketch_distinct(none, ["a", "b"])).first()["n"] == 0
    assert estimate_distinct(sketch_distinct(none.limit(0), ["a"])).first()["n"] == 0


def test_a_generator_sees_one_partition_in_order(spark):
    def first_and_size(rows: pa.RecordBatch) -> pa.Table:
        return pa.table({"g": rows.column("g")[:1], "first": rows.column("id")[:1], "n": pa.array([rows.num_rows], pa.int64())})

    register_generator(spark, "first_and_size", "g bigint, first bigint, n bigint", first_and_size)
    t = spark.range(50).select((49 - F.col("id")).alias("id"), (F.col("id") % 3).alias("g"))
    out = spark.sql("SELECT * FROM first_and_size(TABLE({t}) PARTITION BY g ORDER BY id)", t=t).collect()
    assert sorted((r["g"], r["n"]) for r in out) == [(0, 17), (1, 17), (2, 16)]
    lowest = {r["g"]: r["m"] for r in t.groupBy("g").agg(F.min("id").alias("m")).collect()}
    assert {r["g"]: r["first"] for r in out} == lowest


def test_a_generator_may_end_a_partition_and_take_nothing(spark):
    schema = pa.schema([("x", pa.int64())])
    register_generator(
        spark, "ends", "x bigint", lambda rows: pa.table([pc.multiply(rows.column("id"), 0)], schema=schema).slice(0, 0),
        lambda: pa.table([[7]], schema=schema),
    )
    t = spark.range(9).select("id", (F.col("id") % 2).alias("g"))
    assert [r["x"] for r in spark.sql("SELECT * FROM ends(TABLE({t}) PARTITION BY g)", t=t).collect()] == [7, 7]


def test_looked_up_rows_stay_in_their_buckets(spark):
    offers = spark.range(2_000).select("id", F.concat(F.lit("n"), "id").alias("name"))
    stored = colocated.store_by_id(offers, buckets=8)
    pairs = spark.range(3_000).select((F.col("id") % 2_100).alias("id1"), F.when(F.col("id") % 3 > 0, 7).alias("id2"))
    out = colocated.look_up_both(pairs, stored, ["name"])
    text = out._jdf.queryExecution().executedPlan().toString()
    key = lambda r: tuple(map(str, r))
    assert sorted(out.collect(), key=key) == sorted(lookup_both(pairs, offers, ["name"]).collect(), key=key)
    # the pairs are shuffled for each side, the offers never
    assert text.count("Exchange hashpartitioning") == text.count("Exchange") == 2
    assert text.count("Bucketed: true") == 2
