"""New-product monitor: match arriving products against the masters."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.blocking import block_to_masters
from ..operators.scoring import MATCH_THRESHOLD, PairScorer, match_pairs
from ..operators.state import add_suggestions, read_runs, write_run
from ..plans.products import product_regex
from ..session import cut_lineage


def new_products(
    spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet",
    event_time: str | None = None, delay: str = "1 day", files_per_trigger: int = 1000, **options: str,
) -> DataFrame:
    """Stream of products, one row per id.

    With an event time the ids seen are forgotten after ``delay``; without one
    they are kept for good.
    """
    source = (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
        .options(**options).load(path)
    )
    if event_time:
        return source.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["id"])
    return source.dropDuplicates(["id"])


def match_batch(
    batch: DataFrame, masters: DataFrame, encoder: Any, scorer: PairScorer, *,
    top_k: int = 100, threshold: float = 0.25, match_threshold: float = MATCH_THRESHOLD, **search,
) -> DataFrame:
    """Scored (product, master) pairs of one batch."""
    ready = product_regex(batch.na.drop(subset=["id", "name", "description"]))
    # stored once: the search reads it several times, and the stream's state should not
    encoded = cut_lineage(encoder.transform(ready))
    candidates = block_to_masters(encoded, masters, top_k, threshold, **search)
    return match_pairs(candidates, scorer, match_threshold)


def start_monitor(
    products: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Run over everything that has arrived, then stop; meant to be scheduled.

    ``on_batch`` must be repeatable per batch number, as Spark may call it again.
    """
    return (
        products.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def suggestion_sink(
    spark: SparkSession, path: str, masters: DataFrame, encoder: Any, scorer: PairScorer, run_prefix: str,
    now: datetime | Column | None = None, **options
) -> Callable[[DataFrame, int], None]:
    """Add each batch's suggestions to ``<path>/master_product_clusters`` and its history.

    The tables are written run by run. A batch writes its own rows only, under the
    run of its number, so a repeated batch replaces just these. Each notes its largest id in
    ``<path>/last_ids``; rows are read only of runs without such a note. ``now`` defaults to
    the time of the batch.
    """
    clusters, histories = f"{path}/master_product_clusters", f"{path}/master_product_status_histories"
    last_ids = f"{path}/last_ids"

    def on_batch(batch: DataFrame, number: int) -> None:
        run = f"{run_prefix}-{number}"
        matches = match_batch(batch, masters, encoder, scorer, **options)
        earlier = read_runs(spark, clusters).where(F.col("run") != run)
        if _exists(spark, last_ids):
            noted = read_runs(spark, last_ids).where(F.col("run") != run)
            runs = [r["run"] for r in noted.select("run").distinct().collect()]  # one row a batch
            earlier = earlier.where(~F.col("run").isin(runs)).unionByName(noted, allowMissingColumns=True)
        earlier = earlier.drop("run")
        added, history = add_suggestions(earlier, matches, now if now is not None else datetime.now(timezone.utc))
        stored = cut_lineage(added)
        write_run(stored, clusters, run)
        write_run(history, histories, run)
        write_run(stored.agg(F.max("id").alias("id")), last_ids, run)

    return on_batch
