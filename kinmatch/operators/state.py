"""Status-tracked tables: pure transforms, and tables written run by run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranks import global_rank
from ..schemas import (
    STATUS_ACCEPTED,
    STATUS_NOT_USED,
    STATUS_SUGGESTION,
    STATUS_UNNAMED_CLUSTER,
)
from ..session import cut_lineage
from .rows import first_per_key, groups_with, union_all

HISTORY = ("master_product_cluster_id", "previous_status_id", "current_status_id")


def status_snapshot(clusters: DataFrame, previous: int | None, current: int) -> DataFrame:
    """History rows for the clusters about to move from one status to another."""
    was = F.lit(previous).cast("int")
    return clusters.where(F.col("master_product_status_id") == was).select(
        F.col("id").alias(HISTORY[0]), was.alias(HISTORY[1]), F.lit(current).alias(HISTORY[2])
    )


def replace_status(
    clusters: DataFrame,
    new_rows: DataFrame,
    *,
    previous: int | None,
    now: datetime | Column,
    current: int = STATUS_NOT_USED,
    clear_cluster: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Expire the rows of one status (None: of none), append ``new_rows``.

    Returns ``(clusters, history)``; ``history`` holds what this step adds: one row per expired row and one
    ``(s, s)`` row per new row. New ids continue after the largest one.
    """
    is_previous = F.col("master_product_status_id") == F.lit(previous).cast("int")
    expiring = F.coalesce(is_previous, F.lit(False))
    kept = clusters.withColumns(
        {
            "cluster_id": F.when(expiring & F.lit(clear_cluster), F.lit(None)).otherwise(F.col("cluster_id")),
            "master_product_status_id": F.when(expiring, F.lit(current)).otherwise(
                F.col("master_product_status_id")
            ),
        }
    )
    appended, started = added_rows(clusters, new_rows, now)
    return kept.unionByName(appended), status_snapshot(clusters, previous, current).unionByName(started)


def added_rows(clusters: DataFrame, new_rows: DataFrame, now: datetime | Column) -> tuple[DataFrame, DataFrame]:
    """``new_rows`` as rows of the cluster table, ids continuing after the largest, and their history.

    Of ``clusters`` only the largest id is read.
    """
    stamp = now if isinstance(now, Column) else F.lit(now)
    last_id = clusters.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).scalar()
    order = [c for c in ("internal_product_id", "master_product_id", "cluster_id") if c in new_rows.columns]
    numbered = global_rank(cut_lineage(new_rows), order[0], *order[1:], out="__n")
    appended = numbered.withColumn("id", F.col("__n") + last_id).withColumn("created_at", stamp).drop("__n")
    types = {f.name: f.dataType for f in clusters.schema.fields}
    appended = appended.select(
        *[
            (F.col(c) if c in appended.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in clusters.columns
        ]
    )
    status = F.col("master_product_status_id")
    return appended, appended.select(
        F.col("id").alias(HISTORY[0]), status.alias(HISTORY[1]), status.alias(HISTORY[2])
    )


def save_clusters(
    clusters_table: DataFrame, found: DataFrame, products: DataFrame, min_cluster_size: int,
    now: datetime | Column,
) -> tuple[DataFrame, DataFrame]:
    """Store new clusters of products that have no master yet; older unnamed ones expire.

    The minimum size is applied again, after the products with a master are gone.
    """
    free = products.where(F.col("master_product_id").isNull()).select("id").distinct()
    members = first_per_key(found.join(free, "id"), "id", "cluster")
    rows = groups_with(members, "cluster", min_cluster_size).select(
        F.col("id").alias("internal_product_id"),
        F.col("cluster").alias("cluster_id"),
        F.lit(STATUS_UNNAMED_CLUSTER).alias("master_product_status_id"),
    )
    return replace_status(
        clusters_table, rows, previous=STATUS_UNNAMED_CLUSTER, now=now, clear_cluster=True
    )


def _suggested(matches: DataFrame) -> DataFrame:
    return matches.where(F.col("match") == 1).select(
        F.col("id1").alias("internal_product_id"),
        F.col("id2").alias("master_product_id"),
        F.lit(None).cast("bigint").alias("cluster_id"),
        F.lit(STATUS_SUGGESTION).alias("master_product_status_id"),
    )


def save_suggestions(
    clusters_table: DataFrame, matches: DataFrame, now: datetime | Column
) -> tuple[DataFrame, DataFrame]:
    """Store accepted (product, master) pairs as suggestions; older suggestions expire."""
    return replace_status(clusters_table, _suggested(matches), previous=STATUS_SUGGESTION, now=now)


def add_suggestions(
    clusters_table: DataFrame, matches: DataFrame, now: datetime | Column
) -> tuple[DataFrame, DataFrame]:
    """The rows that accepted pairs of new products add to the cluster table and the history; nothing expires."""
    return added_rows(clusters_table, _suggested(matches), now)


def accepted_clusters(clusters: DataFrame) -> DataFrame:
    return clusters.where(F.col("master_product_status_id") == STATUS_ACCEPTED)


def without_cached(pairs: DataFrame, cached: DataFrame) -> DataFrame:
    """Pairs that still need a score: those not in the cache."""
    return pairs.join(cached.select("id1", "id2"), ["id1", "id2"], "left_anti")


def with_cached(scored: DataFrame | None, cached: DataFrame) -> DataFrame:
    """Fresh and cached scores together; no fresh scores is fine."""
    return union_all(scored, cached)


def cache_scores(cache: DataFrame, scored: DataFrame, model_id: int) -> DataFrame:
    """The model's cache rows after adding ``scored``; a stored pair wins over a new one."""
    stored = cache.where(F.col("model_id") == model_id)
    fresh = scored.select(
        F.col("id1").alias("product_source_id_1"),
        F.col("id2").alias("product_source_id_2"),
        "match",
        "prob",
        F.lit(model_id).cast("bigint").alias("model_id"),
    )
    both = stored.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)))
    key = ["product_source_id_1", "product_source_id_2"]
    return first_per_key(both, key, "__new", F.desc("prob"), F.desc("match")).drop("__new")


def write_cache(cache: DataFrame, path: str) -> None:
    """Replace only the written model's partition."""
    cache.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "model_id"
    ).parquet(path)


def register_model(models: DataFrame, blob: str, tag: str, now: datetime | Column) -> DataFrame:
    """Append a model as the tag's only one in use; its name is the blob's last part."""
    next_id = models.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).scalar() + 1
    others = models.withColumn("in_use", F.col("in_use") & (F.col("tag") != tag))
    stamp = now if isinstance(now, Column) else F.lit(now)
    row = models.sparkSession.range(1).select(
        next_id.cast("bigint").alias("id"),
        F.lit(blob.split("/")[-1]).alias("name"),
        F.lit(blob).alias("blob"),
        F.lit(True).alias("in_use"),
        F.lit(tag).alias("tag"),
        stamp.cast("timestamp").alias("created_at"),
    )
    return others.unionByName(row)


def keep_newest_in_use(models: DataFrame) -> DataFrame:
    """Only the newest model of each tag stays in use."""
    newest = models.groupBy("tag").agg(F.max_by("id", F.struct("created_at", "id")).alias("__newest"))
    return models.join(newest, "tag").withColumn("in_use", F.col("id") == F.col("__newest")).select(
        *models.columns
    )


def change_gate(
    counted: DataFrame, stored: DataFrame, min_change: int, newest_model: DataFrame | None = None
) -> DataFrame:
    """Whether enough changed to start a run: ``(gate, count_now, stored_count, triggered, next_count)``.

    ``counted`` is ``(gate, count_now)``, ``stored`` ``(gate, stored_count, last_run)``,
    ``newest_model`` ``(gate, created_at)``. A gate without a stored count only
    stores it. The stored count moves on when the gate triggers.
    """
    state = counted.join(stored, "gate", "left")
    newer = F.lit(False)
    if newest_model is not None:
        state = state.join(newest_model, "gate", "left")
        newer = F.coalesce(F.col("created_at") > F.col("last_run"), F.lit(False))
    first = F.col("stored_count").isNull()
    grown = F.coalesce(F.col("count_now") - F.col("stored_count") > min_change, F.lit(False))
    triggered = ~first & (grown | newer)
    moved = first | triggered
    return state.select(
        "gate", "count_now", "stored_count", triggered.alias("triggered"),
        F.when(moved, F.col("count_now")).otherwise(F.col("stored_count")).alias("next_count"),
    )


def advance_gates(decided: DataFrame, stored: DataFrame, now: datetime | Column) -> DataFrame:
    """``(gate, stored_count, last_run)`` to keep after :func:`change_gate`: a triggered gate ran now."""
    stamp = now if isinstance(now, Column) else F.lit(now)
    moved = decided.join(stored.select("gate", "last_run"), "gate", "left").select(
        "gate", F.col("next_count").alias("stored_count"),
        F.when(F.col("triggered"), stamp).otherwise(F.col("last_run")).cast("timestamp").alias("last_run"),
    )
    gone = stored.join(decided.select("gate"), "gate", "left_anti").select("gate", "stored_count", "last_run")
    return moved.unionByName(gone)


def write_run(df: DataFrame, path: str, run: str) -> None:
    """Write one run's rows of a table to the run's own folder; a repeated run replaces only its own rows."""
    df.write.mode("overwrite").parquet(f"{path}/run={run}")


def read_run(spark: SparkSession, path: str, run: str) -> DataFrame:
    """A table's state as one run has written it."""
    return spark.read.parquet(f"{path}/run={run}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs' rows of a table to which runs only add, with the ``run`` they come from."""
    return spark.read.option("basePath", path).schema(_schema_with_run(spark, path)).parquet(path)


def _schema_with_run(spark: SparkSession, path: str) -> T.StructType:
    # run ids are text, also where they look like numbers
    found = spark.read.option("basePath", path).parquet(path).schema
    return T.StructType([T.StructField("run", T.StringType()) if f.name == "run" else f for f in found.fields])
