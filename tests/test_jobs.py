from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kinmatch.operators.encode import ModelEncoder, StageEncoder, TableEncoder, TfidfEncoder, fit_tfidf, fit_word2vec
from kinmatch.operators.scoring import (
    ClassifierScorer,
    ColumnScorer,
    ModelScorer,
    edit_ratio,
    match_pairs,
    token_jaccard,
)
from kinmatch.operators.state import read_run, read_runs, write_run
from kinmatch.plans import jobs
from kinmatch.schemas import PRODUCT_CLUSTERS, SCORED_PAIRS
from kinmatch.session import scratch_path
from kinmatch.sources.files import read_csv, read_pair_text
from kinmatch.streaming import monitor

NOW = datetime(2024, 5, 1)
NAMES = ["susu coklat", "teh melati", "kopi hitam", "gula pasir"]


@pytest.fixture(scope="module")
def offers(spark):
    rows = []
    for i in range(32):
        name = f"{NAMES[i % 4]} toko {i // 4 % 2}"
        rows.append((i, name, "isi 3 pcs 200ml baru", 1000.0 + i % 4, i, 1, None if i % 8 else i % 4, NAMES[i % 4]))
    schema = ("id bigint, name string, description string, price double, outlet_id bigint, "
              "product_category_id bigint, master_product_id bigint, master_product string")
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="module")
def encoder(offers):
    return fit_tfidf(offers, "name", dims=64)


def scorer():
    return ColumnScorer(edit_ratio("sent1", "sent2"))


def none_yet(spark):
    return spark.createDataFrame([], PRODUCT_CLUSTERS)


def test_match_job_stores_one_cluster_per_name(spark, offers, encoder):
    path = scratch_path(spark, "jobs")
    options = {"top_k": 12, "threshold": 0.5, "match_threshold": 0.85}
    products = offers.drop("master_product")
    for _ in range(2):  # a repeated run replaces its own output
        jobs.run_match_job(none_yet(spark), path, "r1", products, encoder, scorer(), NOW, **options)
    saved = read_run(spark, f"{path}/master_product_clusters", "r1").collect()
    by_cluster = {}
    for r in saved:
        by_cluster.setdefault(r["cluster_id"], set()).add(r["internal_product_id"] % 4)
        assert r["internal_product_id"] % 8 and r["master_product_status_id"] == 1
    assert all(len(kinds) == 1 for kinds in by_cluster.values()) and len(by_cluster) >= 4
    assert read_runs(spark, f"{path}/master_product_status_histories").count() == len(saved)


def test_products_stored_by_id_give_the_same_matches(spark, offers, encoder):
    options = {"top_k": 12, "threshold": 0.5, "match_threshold": 0.85}
    plain, placed = (jobs.match_products(offers, encoder, scorer(), by_id=b, **options) for b in (False, True))
    key = lambda df: sorted(tuple(r) for r in df.select("id1", "id2", "match").collect())
    assert key(plain.matches) == key(placed.matches) and plain.clusters.count() == placed.clusters.count()


def test_one_shot_job_stores_suggestions(spark, offers, encoder):
    masters = spark.createDataFrame(
        [(100 + i, n, 1) for i, n in enumerate(NAMES)], "id bigint, name string, product_category_id bigint"
    )
    path = scratch_path(spark, "jobs")
    jobs.run_one_shot_job(none_yet(spark), path, "r1", offers.drop("master_product_id", "master_product"), masters,
                          encoder, scorer(), NOW, match_threshold=0.5)
    saved = read_run(spark, f"{path}/master_product_clusters", "r1").collect()
    assert {(r["internal_product_id"] % 4, r["master_product_id"] - 100) for r in saved} >= {(i, i) for i in range(4)}
    assert {r["master_product_status_id"] for r in saved} == {5}


def test_products_without_a_vector_stay(spark, offers, encoder):
    extra = offers.where("id < 3").withColumn("id", F.col("id") + 1000)
    products = offers.drop("master_product", "master_product_id").unionByName(
        extra.drop("master_product", "master_product_id")
    )
    stored = TableEncoder(encoder.transform(offers).select("id", "vec"))
    result = jobs.match_products(products, stored, scorer(), top_k=12, threshold=0.5, match_threshold=0.85)
    assert result.products.count() == 35 and result.products.where("vec IS NULL").count() == 3
    numbered = jobs.cluster_all(result.products.drop("vec", "sent"), result.matches)
    assert numbered.select("id").distinct().count() == 35


def test_cached_pairs_keep_their_score(spark, offers, encoder):
    options = {"top_k": 12, "threshold": 0.5, "match_threshold": 0.85}
    products = offers.drop("master_product", "master_product_id")
    fresh = jobs.match_products(products, encoder, scorer(), **options).matches
    cached = fresh.where("id1 % 2 = 0").withColumn("prob", F.lit(7.0))
    again = jobs.match_products(products, encoder, scorer(), cached=cached, **options).matches
    assert again.count() == fresh.count()
    assert {r["id1"] % 2 for r in again.where("prob = 7").collect()} == {0}
    assert again.where("prob < 7 AND id1 % 2 = 0").count() == 0


def test_training_on_raw_products_and_a_bound(spark, offers, encoder):
    masters = spark.createDataFrame(
        [(i, n, None, None, None, None) for i, n in enumerate(NAMES)],
        "id bigint, name string, weight double, volume double, quantity double, uom string",
    )
    raw = offers.drop("master_product").withColumn("master_product_id", F.col("id") % 4)
    named = jobs.labelled_products(raw, masters, None)
    assert named.count() == 32 and {r["master_product"] for r in named.collect()} == set(NAMES)
    bounded = jobs.labelled_products(raw, masters, 16).count()
    assert 6 <= bounded <= 26
    result = jobs.train_matcher(raw, encoder, masters=masters)
    path = scratch_path(spark, "scorer")
    result.scorer.save(path)
    again = ClassifierScorer.load(path).score(result.test).select("id1", "id2", "prob").collect()
    assert sorted(again) == sorted(result.scorer.score(result.test).select("id1", "id2", "prob").collect())


def test_training_jobs_report_on_the_held_out_part(offers, encoder):
    result = jobs.train_matcher(offers, encoder)
    labels = {r["label"] for r in result.report.collect()}
    assert {"accuracy", "macro avg", "weighted avg"} < labels
    one = jobs.train_one_shot(offers, encoder)
    assert one.train.count() > 0 and "token_jaccard" in one.test.columns


def test_training_jobs_fit_on_every_labelled_row(offers, encoder, monkeypatch):
    whole, asked = jobs.labelled_products, []

    def noted(products, masters, max_rows, **options):
        asked.append(max_rows)
        return whole(products, masters, max_rows, **options)

    monkeypatch.setattr(jobs, "labelled_products", noted)
    monkeypatch.setattr(jobs, "_fit_and_report", lambda pairs, *options: pairs)
    matcher, one = jobs.train_matcher(offers, encoder), jobs.train_one_shot(offers, encoder)
    assert jobs.train_blocker_set(offers, encoder)[0].count() == matcher.count()
    assert one.where("match = 1").count() == 32
    assert asked == [None] * 3  # no bound, whatever the size of the table


def test_blocker_evaluation(offers, encoder):
    texts, sweep = jobs.train_blocker_set(offers, encoder)
    row = sweep.first()
    assert 0.9 < row["average_precision"] <= 1 and set(texts.columns) >= {"sent1", "sent2", "match"}


def test_assign_masters(offers, encoder):
    coded = encoder.transform(offers).withColumn("master_product_id", F.col("id") % 4)
    out, accuracy = jobs.assign_masters(coded, scorer(), threshold=0.3, over_fetch=10, k=4)
    assert out.count() == 32 and accuracy.first()["accuracy"] == 1.0


def test_file_based_run(spark, offers, encoder):
    folder = scratch_path(spark, "files")
    offers.drop("master_product", "master_product_id").coalesce(1).write.option("header", True).csv(f"{folder}/in")
    jobs.match_files(spark, f"{folder}/in", f"{folder}/out", encoder, scorer(), top_k=12, threshold=0.5,
                     match_threshold=0.85)
    out = read_csv(spark, f"{folder}/out")
    assert out.count() == 32 and "fin" in out.columns


def test_training_files(spark, offers, encoder):
    folder = scratch_path(spark, "training")
    offers.coalesce(1).write.option("header", True).csv(f"{folder}/in")
    jobs.training_files(spark, f"{folder}/in", f"{folder}/out", encoder)
    sets = {s: read_pair_text(spark, f"{folder}/out/set={s}") for s in ("train", "val", "test")}
    assert sum(df.count() for df in sets.values()) == len(jobs.serialize(
        jobs.training_pairs(encoder.transform(offers)), offers).collect())
    row = sets["train"].first()
    assert row["sent1"].startswith("COL name VAL ") and row["label"] in (0, 1)


def test_empty_candidates_give_empty_scores(spark):
    none = spark.createDataFrame([], "id1 bigint, id2 bigint, sent1 string, sent2 string")
    out = match_pairs(none, scorer())
    assert out.count() == 0 and out.columns == SCORED_PAIRS.names


def test_user_models_run_per_batch(spark):
    pairs = spark.createDataFrame([(1, 2, "a", "a"), (1, 3, "a", "b")], "id1 bigint, id2 bigint, sent1 string, sent2 string")

    def predict(_model, first: pd.Series, second: pd.Series):
        same = (first == second).to_numpy()
        return np.stack([np.zeros(len(same)), np.where(same, 4.0, -4.0)], axis=1)

    out = {r["id2"]: r for r in match_pairs(pairs, ModelScorer(lambda: None, predict)).collect()}
    assert out[2]["match"] == 1 and out[3]["match"] == 0 and out[2]["prob"] == pytest.approx(1 / (1 + np.exp(-4)))
    encode = ModelEncoder(lambda: 2.0, lambda m, texts: [[m, float(len(t))] for t in texts], "sent1")
    assert encode.transform(pairs).first()["vec"] == [2.0, 1.0]


def test_encoders(spark, offers, encoder):
    coded = encoder.transform(offers).collect()
    assert all(len(r["vec"]) == 64 and np.linalg.norm(r["vec"]) == pytest.approx(1, abs=1e-5) for r in coded)
    words = fit_word2vec(offers, "name", dims=8, min_count=1).transform(offers).first()
    assert len(words["vec"]) == 8
    stored = TableEncoder(spark.createDataFrame([(1, [1.0])], "id bigint, vec array<float>"))
    assert stored.transform(offers).count() == 32 and stored.transform(offers).where("vec IS NOT NULL").count() == 1


def test_texts_that_are_null_keep_their_rows(spark, offers, encoder):
    rows = spark.createDataFrame([(1, None), (2, "susu"), (3, "zzz qqq")], "id bigint, name string")
    coded = {r["id"]: r["vec"] for r in encoder.transform(rows).collect()}
    assert coded[1] is None and len(coded[2]) == 64 and set(coded[3]) == {0.0}
    words = fit_word2vec(offers, "name", dims=8)
    assert {r["id"]: r["vec"] is None for r in words.transform(rows).collect()} == {1: True, 2: False, 3: False}
    model = ModelEncoder(lambda: None, lambda m, texts: [[float(len(t))] for t in texts], "name")
    assert {r["id"]: r["vec"] for r in model.transform(rows).collect()} == {1: None, 2: [4.0], 3: [7.0]}


def test_encoders_come_back_from_files(spark, offers, encoder):
    for fitted, kind in ((encoder, TfidfEncoder), (fit_word2vec(offers, "name", dims=4), StageEncoder)):
        path = scratch_path(spark, "encoder")
        fitted.save(path)
        again = kind.load(spark, path)
        key = lambda r: r["id"]
        assert sorted(again.transform(offers).collect(), key=key) == sorted(fitted.transform(offers).collect(), key=key)


def test_word_vectors_refuse_a_vocabulary_beyond_their_bound(offers):
    with pytest.raises(ValueError, match="max_words"):
        fit_word2vec(offers, "name", max_words=3)


def test_word_vectors_of_a_vocabulary_beyond_their_bound(spark, offers):
    words = fit_word2vec(offers, "name", dims=4, max_words=3, hashed=True)
    path = scratch_path(spark, "encoder")
    words.save(path)
    rows = offers.select("id", "name").unionAll(spark.createDataFrame([(900, None), (901, "--")], "id bigint, name string"))
    coded = {r["id"]: r["vec"] for r in StageEncoder.load(spark, path).transform(rows).collect()}
    assert coded.pop(900) is None and set(coded.pop(901)) == {0.0}
    assert all(np.linalg.norm(v) == pytest.approx(1, abs=1e-5) for v in coded.values())
    assert words.model.stages[-2].getVectors().count() <= 3
    # no word that was read is without a vector, and a vocabulary within the bound is not hashed
    assert len(fit_word2vec(offers, "name", dims=4, hashed=True).model.stages) == 3


def test_token_jaccard(spark):
    df = spark.createDataFrame([("a b c", "B c d"), ("", ""), (None, "x")], "p string, q string")
    assert [r["j"] for r in df.select(token_jaccard("p", "q").alias("j")).collect()] == [0.5, 0.0, 0.0]


def test_monitor_matches_each_arrival_once(spark, offers, encoder):
    root = scratch_path(spark, "monitor")
    masters = encoder.transform(
        spark.createDataFrame([(100 + i, n, 1) for i, n in enumerate(NAMES)],
                              "id bigint, name string, product_category_id bigint")
    )
    incoming = offers.select("id", "name", "description", "product_category_id")
    write_run(none_yet(spark), f"{root}/master_product_clusters", "start")
    sink = monitor.suggestion_sink(spark, root, masters, encoder, scorer(), "stream", match_threshold=0.5)

    def run():
        stream = monitor.new_products(spark, f"{root}/in", incoming.schema)
        monitor.start_monitor(stream, f"{root}/progress", sink).awaitTermination()
        return read_runs(spark, f"{root}/master_product_clusters").where("master_product_status_id = 5")

    incoming.where("id < 16").write.mode("append").parquet(f"{root}/in")
    first = run()
    assert first.select("internal_product_id").distinct().count() == 16
    seen = first.count()
    assert run().count() == seen
    incoming.where("id >= 8").write.mode("append").parquet(f"{root}/in")
    second = run()
    assert second.select("internal_product_id").distinct().count() == 32
    assert second.groupBy("internal_product_id", "master_product_id").count().where("count > 1").count() == 0
    # ids go on after the largest of all earlier runs, which each has noted
    assert second.select("id").distinct().count() == second.count()
    noted = {r["run"]: r["id"] for r in read_runs(spark, f"{root}/last_ids").collect()}
    assert noted == {r["run"]: r["m"] for r in second.groupBy("run").agg(F.max("id").alias("m")).collect()} and len(noted) == 2


def test_event_time_bounds_the_ids_kept(spark):
    path = scratch_path(spark, "events")
    spark.createDataFrame([(1, NOW)], "id bigint, ts timestamp").write.parquet(path)
    stream = monitor.new_products(spark, path, spark.read.parquet(path).schema, event_time="ts")
    assert stream.isStreaming
