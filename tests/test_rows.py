from pyspark.sql import functions as F

from kinmatch.functions.numeric import add_zscore, hash_draw, softmax_positive
from kinmatch.functions.ranks import global_rank, global_running_sums
from kinmatch.operators import rows


def test_global_rank_is_a_dense_numbering(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    out = {r["v"]: r["rank"] for r in global_rank(df, "v").collect()}
    assert out == {v: v + 1 for v in range(1000)}
    down = {r["v"]: r["rank"] for r in global_rank(df, "v", descending=True).collect()}
    assert down == {v: 1000 - v for v in range(1000)}


def test_global_rank_with_one_hot_value(spark):
    df = spark.range(300).select(F.when(F.col("id") < 200, 5).otherwise(F.col("id")).alias("v"), "id")
    got = [(r["v"], r["id"]) for r in global_rank(df, "v", "id").orderBy("rank").collect()]
    assert got == sorted(got) and len(got) == 300


def test_uniform_rank_matches_the_hash_order(spark):
    df = spark.range(500).withColumn("d", hash_draw("id"))
    got = [r["d"] for r in global_rank(df, "d", "id", uniform=True).orderBy("rank").collect()]
    assert got == sorted(got) and 0 <= got[0] and got[-1] < 1


def test_running_sums(spark):
    df = spark.range(100).select(F.col("id").alias("s"), F.lit(2).alias("x"))
    got = {r["s"]: r["t"] for r in global_running_sums(df, "s", {"t": "x"}).collect()}
    assert got == {s: 2 * (100 - s) for s in range(100)}


def test_not_first_and_duplicated_groups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, None), (6, None)], "seq int, v string")
    assert sorted(r["seq"] for r in rows.not_first(df, "v", "seq").collect()) == [2, 4, 6]
    assert sorted(r["seq"] for r in rows.duplicated_groups(df, "v", "seq").collect()) == [2, 4]


def test_dense_ids_follow_first_appearance(spark):
    df = spark.createDataFrame([(0, "z"), (1, "a"), (2, "z"), (3, None), (4, "m")], "seq int, v string")
    out = rows.dense_ids(df, "v", "seq", "n").orderBy("seq").collect()
    assert [r["n"] for r in out] == [0, 1, 0, None, 2]


def test_union_skips_absent_sides(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2,)], "id int")
    assert sorted(tuple(r) for r in rows.union_all(a, None, b).collect()) == [(1, "x"), (2, None)]


def test_master_shares_and_members(spark):
    df = spark.createDataFrame(
        [(1, f"m{i % 5}", f"n{i:02}", i) for i in range(50)] + [(2, None, "solo", 50)],
        "cluster int, master_product string, name string, seq int",
    )
    shares = {(r["cluster"], r["master_product"]): r["n"] for r in rows.master_shares(df).collect()}
    assert shares == {**{(1, f"m{i}"): 10 for i in range(5)}, (2, None): 0}
    members = [tuple(r) for r in rows.cluster_members(df, "seq").orderBy("cluster", "position").collect()]
    assert members == [(1, i + 1, f"n{i:02}", 50) for i in range(50)] + [(2, 1, "solo", 1)]


def test_pairs_that_lack_a_member_are_none(spark):
    pairs = spark.createDataFrame([(None, 5), (5, None), (7, 5), (5, 7), (3, 3)], "id1 int, id2 int")
    assert sorted(map(tuple, rows.canonical_pairs(pairs).collect())) == [(3, 3), (5, 7)]


def test_zscore_of_a_constant_is_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r["x"] for r in add_zscore(df, "x").collect()] == [0.0, 0.0]


def test_softmax_does_not_overflow(spark):
    df = spark.createDataFrame([(1000.0, 1000.0), (0.0, 2000.0)], "a double, b double")
    assert [r["p"] for r in df.select(softmax_positive("a", "b").alias("p")).collect()] == [0.5, 1.0]
