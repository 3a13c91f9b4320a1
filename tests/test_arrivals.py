from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kinmatch.session import scratch_path
from kinmatch.streaming.arrivals import STATE_STORE, arrival_sink, settle_products, timers

SCHEMA = "id bigint, name string, changed timestamp, arrived timestamp"


def at(hours):
    return datetime(2024, 5, 1) + timedelta(hours=hours)


def test_products_settle_once_corrections_are_in(spark):
    root = scratch_path(spark, "arrivals")
    before = spark.conf.get(STATE_STORE, None)

    def deliver(rows):
        # no two deliveries share a folder
        folder = f"{root}/in/{abs(hash(str(rows)))}"
        spark.createDataFrame([(i, n, at(c) if c is not None else None, at(a)) for i, n, c, a in rows], SCHEMA).coalesce(1).write.parquet(folder)
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in/*")
        settled = settle_products(stream, "id", "changed", "arrived", "2 hours")
        with timers(spark):
            writer = settled.writeStream.foreachBatch(arrival_sink(root)).option("checkpointLocation", f"{root}/progress")
            writer.trigger(availableNow=True).start().awaitTermination()

    def found(name):
        return sorted((r["id"], r["name"]) for r in spark.read.parquet(f"{root}/{name}/*").collect())

    # a repeated row, a correction in the same delivery, one without a key, one without a time
    deliver([(1, "a", 0, 0), (1, "a", 0, 0), (1, "a2", 0.5, 1), (2, "b", 1, 1), (None, "x", 0, 1), (9, "y", None, 1)])
    assert found("products") == []
    # the clock moves to 2.5: only what changed by 0.5 has waited long enough
    deliver([(2, "b2", 2, 2.4), (2, "b1", 0.9, 2.5), (3, None, 2.2, 2.5)])
    assert found("products") == [(1, "a2")]
    # too late for 1 (its time is over); 4 is late at once; 2 is corrected again
    deliver([(1, "a3", 0.4, 2.7), (4, "late", 0.1, 2.8), (2, "b3", 2.5, 2.9), (5, "e", 9, 9)])
    assert found("products") == [(1, "a2"), (2, "b3"), (3, None)]
    assert found("late") == [(1, "a3"), (4, "late")]
    # a settled product may open again
    deliver([(1, "again", 10, 10), (6, "f", 20, 20)])
    assert found("products") == [(1, "a2"), (1, "again"), (2, "b3"), (3, None), (5, "e")]
    ids = [r["arrival_id"] for r in spark.read.parquet(f"{root}/products/*", f"{root}/late/*").collect()]
    assert len(ids) == len(set(ids)) == 7
    assert spark.conf.get(STATE_STORE, None) == before


def test_a_repeated_batch_replaces_its_rows(spark):
    root = scratch_path(spark, "arrivals")
    sink = arrival_sink(root)
    batch = spark.createDataFrame([(1, "settled"), (2, "late"), (3, "settled")], "id bigint, kind string")
    sink(batch, 4)
    sink(batch, 4)
    assert spark.read.parquet(f"{root}/products/*").count() == 2 and spark.read.parquet(f"{root}/late/*").count() == 1
    assert spark.read.parquet(f"{root}/products/*").where(F.shiftright("arrival_id", 46) != 4).isEmpty()


def test_waits_are_intervals(spark):
    stream = spark.readStream.format("rate").load().select(F.col("value").alias("id"), "timestamp", F.col("timestamp").alias("arrived"))
    with pytest.raises(Exception):
        settle_products(stream, "id", "timestamp", "arrived", "two hours")
