import math

import pytest
from pyspark.sql import functions as F

from kinmatch.operators import metrics, sampling
from kinmatch.functions import vectors as v


def test_two_way_split_is_a_partition(spark):
    df = spark.range(5000)
    train, test = sampling.split_two(df, "id")
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    assert abs(test.count() / 5000 - 0.2) < 0.03


@pytest.mark.parametrize("ids", ["id * 1000003", "id + 9223372036854000000", "id * 2"])
def test_draws_of_strided_and_large_ids_are_even(spark, ids):
    df = spark.range(4000).selectExpr(f"{ids} AS id")
    _, test = sampling.split_two(df, "id")
    assert abs(test.count() / 4000 - 0.2) < 0.03


def test_null_keys_are_in_one_set(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (None,)], "id int")
    train, test = sampling.split_two(df, "id")
    assert train.count() + test.count() == 4


def test_three_way_split(spark):
    sizes = {r["set"]: r["count"] for r in sampling.assign_split(spark.range(9000), "id").groupBy("set").count().collect()}
    assert set(sizes) == {"train", "val", "test"} and sum(sizes.values()) == 9000
    assert abs(sizes["train"] / 9000 - 0.8) < 0.03


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_exact_split_size(spark, n):
    marked = sampling.assign_split_exact(spark.range(n), "id")
    assert marked.where("set = 'test'").count() == math.ceil(n * 0.2)


def test_samples(spark):
    df = spark.range(1000).withColumn("match", (F.col("id") % 10 == 0).cast("int"))
    assert sampling.sample_rows(df, "id", 137).distinct().count() == 137
    assert sampling.sample_rows(df, "id", 5000).count() == 1000
    assert sampling.rebalance(df, "id", 50).count() == 150
    order = [r["id"] for r in sampling.shuffle_rows(df, "id").collect()]
    assert sorted(order) == list(range(1000)) and order != sorted(order)


def test_masking(spark):
    tokens = ["[CLS]"] + [f"t{i}" for i in range(400)] + ["[SEP]", "[PAD]"]
    df = spark.createDataFrame([(11, tokens)], "id bigint, tokens array<string>")
    out = df.select(sampling.mask_tokens("tokens", "id").alias("m")).first()["m"]
    masked = [i for i, t in enumerate(out) if t["token"] == "[MASK]"]
    assert 0.08 < len(masked) / 400 < 0.22
    assert [t["label"] for t in out] == tokens
    assert all(out[i]["token"] == tokens[i] for i in (0, 401, 402))


def test_masks_of_long_rows_do_not_repeat(spark):
    tokens = [f"t{i}" for i in range(1500)]
    df = spark.createDataFrame([(1, tokens), (2, tokens), (1 << 62, tokens)], "id bigint, tokens array<string>")
    masks = [
        {i for i, t in enumerate(r["m"]) if t["token"] == "[MASK]"}
        for r in df.select(sampling.mask_tokens("tokens", "id").alias("m")).collect()
    ]
    first, second, _ = masks
    assert {i - 1000 for i in first if i >= 1000} != {i for i in second if i < 500}
    assert all(150 < len(m) < 300 for m in masks)


def test_classification_report_with_an_unpredicted_class(spark):
    rows = [(0, 0)] * 6 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] * 1 + [(2, 0)] * 1
    df = spark.createDataFrame(rows, "match int, pred int")
    out = {r["label"]: r for r in metrics.classification_report(df).collect()}
    assert out["0"]["precision"] == pytest.approx(6 / 8) and out["0"]["recall"] == pytest.approx(6 / 8)
    assert out["1"]["f1"] == pytest.approx(2 * 3 / (4 + 5))
    assert (out["2"]["precision"], out["2"]["recall"], out["2"]["support"]) == (0, 0, 1)
    assert out["accuracy"]["f1"] == pytest.approx(9 / 13)
    assert out["macro avg"]["recall"] == pytest.approx((6 / 8 + 3 / 4 + 0) / 3)
    assert out["weighted avg"]["recall"] == pytest.approx(9 / 13)


def test_threshold_sweep_against_every_cut(spark):
    rows = [((i * 37 % 50) / 50, int((i * 53 % 11) < 4 or i % 50 > 35)) for i in range(200)]
    df = spark.createDataFrame(rows, "score double, match int")
    out = metrics.threshold_sweep(df).first()
    total = sum(y for _, y in rows)
    best, average = (0.0, None), 0.0
    for cut in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(y for s, y in rows if s >= cut)
        hit = sum(1 for s, _ in rows if s >= cut)
        best = max(best, (2 * tp / (hit + total), cut))
        average += sum(y for s, y in rows if s == cut) / total * tp / hit
    assert (out["best_f1"], out["f1_threshold"]) == (pytest.approx(best[0]), best[1])
    assert out["average_precision"] == pytest.approx(average)


def test_assignment_accuracy_ignores_unlabelled(spark):
    df = spark.createDataFrame(
        [("a", "a"), ("b", "a"), (None, "a"), ("a", None)], "master_product_pred string, master_product_actual string"
    )
    row = metrics.assignment_accuracy(df).first()
    assert (row["accuracy"], row["n"]) == (pytest.approx(1 / 3), 3)


def test_pooling(spark):
    tokens = spark.createDataFrame(
        [(1, 0, 1, [1.0, 2.0]), (1, 1, 1, [3.0, 4.0]), (1, 2, 0, [9.0, 9.0]), (2, 0, 0, [5.0, 5.0])],
        "id int, pos int, mask int, vec array<float>",
    )
    pooled = {r["id"]: r["vec"] for r in v.mean_pool(tokens).collect()}
    assert pooled == {1: [2.0, 3.0], 2: [0.0, 0.0]}
    nested = tokens.groupBy("id").agg(F.collect_list(F.struct("mask", "vec")).alias("t"))
    inside = {r["id"]: r["vec"] for r in nested.select("id", v.mean_pool_nested("t", 2).alias("vec")).collect()}
    assert inside == pooled
    first = {r["id"]: r["vec"] for r in v.first_token_pool(tokens).collect()}
    assert first == {1: [1.0, 2.0], 2: [5.0, 5.0]}


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.select(
        v.dot("a", "b").alias("dot"), v.cosine("a", "b").alias("cos"), v.l2_normalize("a").alias("unit"),
        v.euclidean("a", "a").alias("self"), v.angular_distance("a", "b").alias("angle"),
        v.negative_mean_product("a", "b").alias("mean"),
    ).collect()
    assert rows[0]["dot"] == 24 and rows[0]["cos"] == pytest.approx(0.96) and rows[0]["unit"] == [0.6, 0.8]
    assert rows[0]["self"] == pytest.approx(math.sqrt(1e-7)) and rows[0]["mean"] == pytest.approx(-0.48)
    assert rows[0]["angle"] == pytest.approx(math.sqrt(0.08))
    assert rows[1]["unit"] == [0.0, 0.0] and rows[1]["cos"] == 0 and rows[1]["angle"] == pytest.approx(math.sqrt(2))
