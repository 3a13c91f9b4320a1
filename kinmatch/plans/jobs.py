"""Whole jobs: matching, one-shot matching, training, and file-based runs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import score_to_label
from ..operators.blocking import block_pairs, block_to_masters
from ..operators.colocated import store_by_id
from ..operators.components import cluster_all, cluster_matches
from ..operators.knn import knn_filtered, knn_join
from ..operators.metrics import assignment_accuracy, classification_report, threshold_sweep
from ..operators.pairs import one_shot_pairs, training_pairs
from ..operators.products import cosine_of_products, pair_products
from ..operators.rows import best_per_key, canonical_pairs, drop_missing, lookup_both
from ..operators.sampling import TEST_FRACTION, assign_split, sample_fraction, split_two
from ..operators.scoring import (
    MATCH_THRESHOLD,
    ONE_SHOT_THRESHOLD,
    TEXT_FEATURES,
    ClassifierScorer,
    PairScorer,
    add_text_features,
    match_pairs,
    train_classifier,
)
from ..operators.serialize import DEFAULT_COLUMNS, add_sentence, serialize
from ..operators.state import save_clusters, save_suggestions, with_cached, without_cached, write_run
from ..session import cut_lineage, scratch_path, scratch_scope
from ..sources.files import read_csv, write_csv, write_split_text
from .products import preprocess, product_regex

# Defaults of the match jobs.
BLOCKER_TOP_K = 100
BLOCKER_THRESHOLD = 0.25
MIN_CLUSTER_SIZE = 3
ASSIGN_OVER_FETCH = 100
ASSIGN_NEIGHBOURS = 10


def cluster_similar(
    items: DataFrame, top_k: int, max_distance: float, min_size: int = MIN_CLUSTER_SIZE,
    vec: str = "vec", **search,
) -> DataFrame:
    """Clusters of items linked to a near neighbour; ``top_k`` counts the item itself."""
    near = knn_join(items, items, top_k - 1, vec=vec, without_self=True, **search)
    close = near.where(F.round("dist", 9) < max_distance)
    links = canonical_pairs(close, "q_id", "b_id").withColumn("match", F.lit(1))
    return cluster_matches(links, items, min_size)


class MatchResult(NamedTuple):
    products: DataFrame
    candidates: DataFrame
    matches: DataFrame
    clusters: DataFrame


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stage's result to the shared folder and go on from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def match_products(
    products: DataFrame,
    encoder: Any,
    scorer: PairScorer,
    *,
    keep_columns: Sequence[str] = DEFAULT_COLUMNS,
    top_k: int = BLOCKER_TOP_K,
    threshold: float | None = BLOCKER_THRESHOLD,
    match_threshold: float = MATCH_THRESHOLD,
    min_cluster_size: int = MIN_CLUSTER_SIZE,
    strategy: str = "exact",
    order: str = "name",
    cached: DataFrame | None = None,
    by_id: bool = False,
) -> MatchResult:
    """Match job: clean, extract sizes, encode, block, score, cluster.

    ``encoder.transform`` adds ``vec`` to rows with a ``sent`` column; products without
    a vector stay and match nothing. ``cached`` are scored pairs ``(id1, id2, match,
    prob)`` of earlier runs: candidates among them are not scored again. The stages
    that others read more than once are stored in the shared folder. At large scale
    give ``strategy="ivf"`` or ``"forest"``; the exact search may have to compare all with all. ``by_id`` stores the encoded
    products in buckets of their id, so that the four look-ups of pairs' members leave them where they lie.
    """
    clean, _ = preprocess(products, order=order)
    sized = add_sentence(product_regex(clean), keep_columns)
    encoded = store_by_id(encoder.transform(sized)) if by_id else _stored(encoder.transform(sized), "encoded")
    candidates = _stored(block_pairs(encoded, top_k, threshold, strategy=strategy), "candidates")
    wanted = candidates if cached is None else without_cached(candidates, cached)
    scored = match_pairs(serialize(wanted, encoded, keep_columns), scorer, match_threshold)
    if cached is not None:
        known = cached.join(candidates, ["id1", "id2"], "left_semi").select("id1", "id2", "match", "prob")
        scored = with_cached(scored, known)
    matches = _stored(scored, "matches")
    clusters = cluster_matches(matches, encoded, min_cluster_size)
    return MatchResult(encoded, candidates, matches, clusters)


def _write_tables(table: DataFrame, history: DataFrame, path: str, run: str) -> None:
    """A run's cluster table and the history it adds, each in the run's own folder."""
    write_run(table, f"{path}/master_product_clusters", run)
    write_run(history, f"{path}/master_product_status_histories", run)


def run_match_job(
    clusters: DataFrame, path: str, run: str, products: DataFrame, encoder: Any, scorer: PairScorer,
    now: datetime, **options,
) -> None:
    """Match job with its result stored as unnamed clusters after the table ``clusters``.

    The new table is ``<path>/master_product_clusters/run=<run>``; a repeated run
    replaces its own output. What the job kept in the shared folder is removed.
    """
    size = options.get("min_cluster_size", MIN_CLUSTER_SIZE)
    with scratch_scope(products.sparkSession):
        result = match_products(products, encoder, scorer, **options)
        _write_tables(*save_clusters(clusters, result.clusters, result.products, size, now), path, run)


def match_to_masters(
    products: DataFrame,
    masters: DataFrame,
    encoder: Any,
    scorer: PairScorer,
    *,
    top_k: int = BLOCKER_TOP_K,
    threshold: float = BLOCKER_THRESHOLD,
    match_threshold: float = MATCH_THRESHOLD,
    strategy: str = "exact",
    order: str = "name",
) -> DataFrame:
    """One-shot job: scored (product, master) pairs; the encoder reads ``name``."""
    clean, _ = preprocess(products, order=order)
    sized = product_regex(clean)
    candidates = block_to_masters(
        _stored(encoder.transform(sized), "products"), _stored(encoder.transform(masters), "masters"),
        top_k, threshold, strategy=strategy,
    )
    return match_pairs(candidates, scorer, match_threshold)


def run_one_shot_job(
    clusters: DataFrame, path: str, run: str, products: DataFrame, masters: DataFrame, encoder: Any,
    scorer: PairScorer, now: datetime, **options,
) -> None:
    """One-shot job with its result stored as suggestions, as in :func:`run_match_job`."""
    with scratch_scope(products.sparkSession):
        matches = match_to_masters(products, masters, encoder, scorer, **options)
        _write_tables(*save_suggestions(clusters, matches, now), path, run)


class TrainResult(NamedTuple):
    scorer: ClassifierScorer
    report: DataFrame
    train: DataFrame
    test: DataFrame


def _fit_and_report(pairs: DataFrame, key: str, test_fraction: float, threshold: float) -> TrainResult:
    train, test = split_two(pairs, key, test_fraction)
    train, test = add_text_features(train), add_text_features(test)
    scorer = train_classifier(train, TEXT_FEATURES)
    scored = scorer.score(test).withColumn("pred", score_to_label("prob", threshold))
    return TrainResult(scorer, classification_report(scored), train, test)


def labelled_products(
    products: DataFrame, masters: DataFrame | None, max_rows: int | None, order: str = "name"
) -> DataFrame:
    """The labelled offers a training job fits on.

    With ``masters`` the products come as they are: cleaned, one row per id, named by
    their master. Without, they are taken to be so already. The jobs fit on all of them; ``max_rows``
    is for callers who want about as many, drawn by id, and hand them to a job themselves.
    """
    ready = products if masters is None else preprocess(products, masters, order)[1]
    if max_rows is None:
        return ready
    ready = _stored(ready, "ready")
    n = ready.count()
    return ready if n <= max_rows else sample_fraction(ready, "id", max_rows / n)


def train_matcher(
    products: DataFrame, encoder: Any, *, masters: DataFrame | None = None,
    keep_columns: Sequence[str] = DEFAULT_COLUMNS, test_fraction: float = TEST_FRACTION, threshold: float = 0.5,
    strategy: str = "exact",
) -> TrainResult:
    """Matcher training job: clean and label, pairs, texts, split, fit, report. The scorer can be saved."""
    encoded = _stored(encoder.transform(labelled_products(products, masters, None)), "labelled")
    pairs = training_pairs(add_sentence(encoded, keep_columns), columns=["sent"], strategy=strategy)
    texts = serialize(pairs, encoded, keep_columns)
    keyed = _stored(texts.withColumn("__key", F.concat_ws("-", "id1", "id2")), "pairs")
    return _fit_and_report(keyed, "__key", test_fraction, threshold)


def train_one_shot(
    products: DataFrame, encoder: Any, *, masters: DataFrame | None = None, test_fraction: float = TEST_FRACTION,
    threshold: float = 0.5, strategy: str = "exact",
) -> TrainResult:
    """One-shot training job: product names against master names."""
    encoded = _stored(encoder.transform(labelled_products(products, masters, None)), "labelled")
    pairs = one_shot_pairs(encoded, strategy=strategy)
    key = F.concat_ws("|", "sent1", "sent2", F.col("match").cast("string"))
    return _fit_and_report(_stored(pairs.withColumn("__key", key), "pairs"), "__key", test_fraction, threshold)


def evaluate_blocker(labelled_pairs: DataFrame, products: DataFrame) -> DataFrame:
    """Best thresholds and average precision of the vectors' cosine on labelled pairs, which are read twice."""
    lines = labelled_pairs.select(F.col("id1").alias("va"), F.col("id2").alias("vb"), "match")
    scored = pair_products(lines, products.select("id", "vec", F.lit(None).cast("int").alias("label")))
    return threshold_sweep(scored.select(F.round(cosine_of_products(), 9).alias("score"), "match"))


def train_blocker_set(
    products: DataFrame, encoder: Any, *, masters: DataFrame | None = None,
    keep_columns: Sequence[str] = DEFAULT_COLUMNS, strategy: str = "exact",
) -> tuple[DataFrame, DataFrame]:
    """Blocker training set and the evaluation of the present vectors on it."""
    encoded = _stored(encoder.transform(labelled_products(products, masters, None)), "labelled")
    pairs = _stored(training_pairs(encoded, strategy=strategy), "pairs")
    return serialize(pairs, encoded, keep_columns), evaluate_blocker(pairs, encoded)


def assign_candidates(
    products: DataFrame, *, over_fetch: int = ASSIGN_OVER_FETCH, k: int = ASSIGN_NEIGHBOURS,
    master: str = "master_product", vec: str = "vec", **search,
) -> DataFrame:
    """``(id1, id2, sent1, sent2)``: each product with the masters of its near labelled offers."""
    labelled = products.where(F.col(master).isNotNull())
    hits = knn_filtered(products, products, labelled, over_fetch, k, vec=vec, **search)
    left = products.select(F.col("id").alias("q_id"), F.col("name").alias("sent1"))
    right = labelled.select(
        F.col("id").alias("b_id"), F.col("master_product_id").alias("id2"), F.col(master).alias("sent2")
    )
    joined = hits.join(left, "q_id").join(right, "b_id")
    return drop_missing(joined, ["sent1", "sent2"]).select(
        F.col("q_id").alias("id1"), "id2", "sent1", "sent2"
    )


def assign_masters(
    products: DataFrame, scorer: PairScorer, *, threshold: float = ONE_SHOT_THRESHOLD, **options
) -> tuple[DataFrame, DataFrame]:
    """``(assignments, accuracy)``: the best accepted master of each product."""
    candidates = assign_candidates(products, **options)
    scored = match_pairs(candidates, scorer, threshold)
    best = best_per_key(scored.where(F.col("match") == 1), "id1", "prob", "id2")
    masters = products.where(F.col("master_product").isNotNull()).select(
        F.col("master_product_id").alias("master_product_pred_id"),
        F.col("master_product").alias("master_product_pred"),
    ).distinct()
    actual = products.select(
        F.col("id").alias("product_id"),
        F.col("master_product_id").alias("master_product_actual_id"),
        F.col("master_product").alias("master_product_actual"),
        "name",
        F.col("price").cast("bigint").alias("price"),
    )
    out = cut_lineage(
        best.select(F.col("id1").alias("product_id"), F.col("id2").alias("master_product_pred_id"), "prob")
        .join(masters, "master_product_pred_id", "left")
        .join(actual, "product_id", "left")
    )
    return out, assignment_accuracy(out)


def training_files(
    spark: SparkSession, products_path: str, output_path: str, encoder: Any, schema=None, *,
    keep_columns: Sequence[str] = DEFAULT_COLUMNS, strategy: str = "exact",
) -> DataFrame:
    """File-based run: labelled CSV in, ``sent1, sent2, match`` lines out, one folder per split."""
    labelled = read_csv(spark, products_path, schema).where(F.col("master_product").isNotNull())
    encoded = _stored(encoder.transform(labelled), "labelled")
    # a text is made once an offer and goes along with its pairs
    pairs = training_pairs(add_sentence(encoded, keep_columns), columns=["sent"], strategy=strategy)
    texts = serialize(pairs, encoded, keep_columns)
    keyed = texts.withColumn("__key", F.concat_ws("-", "id1", "id2"))
    line = F.concat_ws("\t", "sent1", "sent2", F.col("match").cast("string"))
    split = assign_split(keyed, "__key").select(line.alias("value"), "set")
    write_split_text(split, output_path)
    return split


def match_files(spark: SparkSession, products_path: str, output_path: str, encoder: Any, scorer: PairScorer,
                schema=None, **options) -> DataFrame:
    """File-based run: CSV in, every complete product with its cluster number out as CSV."""
    result = match_products(read_csv(spark, products_path, schema), encoder, scorer, **options)
    numbered = cluster_all(result.products.drop("vec", "sent"), result.matches)
    write_csv(numbered, output_path)
    return numbered
