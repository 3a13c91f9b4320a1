"""Arriving products that wait for their corrections: keyed state with event-time timers."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# What became of a row: the settled version of a product, or a row that came after its product was settled.
SETTLED, LATE = "settled", "late"


class WaitForCorrections(StatefulProcessor):
    """Per product: keep the newest version; settle it once the arrival clock has passed its event time by the wait.

    A row whose time is already over when it comes is late, whatever is waiting. Equal event times go to the larger row.
    """

    def __init__(self, fields: T.StructType, out: T.StructType, time: str, wait_ms: int):
        self.fields, self.out, self.time, self.wait_ms = fields, out, time, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", self.fields)

    def _rank(self, row: tuple) -> tuple:
        at = int(pd.Timestamp(row[self.fields.names.index(self.time)]).value // 1_000_000)
        return at, tuple((x is not None, 0 if x is None else x) for x in row)

    def _rows(self, key, rows: list[tuple], kind: str) -> pd.DataFrame:
        found = pd.DataFrame(rows, columns=self.fields.names)
        found.insert(0, self.out.names[0], key[0])
        found["kind"] = kind
        return found

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        newest = tuple(self.waiting.get()) if self.waiting.exists() else None
        before = None if newest is None else self._rank(newest)
        best = before
        for part in rows:
            late = []
            for row in part[self.fields.names].itertuples(index=False, name=None):
                row = tuple(None if pd.isna(x) else x for x in row)
                rank = self._rank(row)
                if rank[0] + self.wait_ms <= now:
                    late.append(row)
                elif best is None or rank > best:
                    newest, best = row, rank
            if late:
                yield self._rows(key, late, LATE)
        if best != before:
            if before is not None:
                self.handle.deleteTimer(before[0] + self.wait_ms)
            self.handle.registerTimer(best[0] + self.wait_ms)
            self.waiting.update(newest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.waiting.exists():
            row = tuple(self.waiting.get())
            self.waiting.clear()
            yield self._rows(key, [row], SETTLED)

    def close(self) -> None:
        pass


def settle_products(
    stream: DataFrame, key: str, time: str, arrived: str, wait: str, delay: str = "0 seconds"
) -> DataFrame:
    """The stream's rows as they settle: all columns and ``kind``, "settled" or "late".

    A product (``key``) may be sent again with corrections. It is held until the watermark, which follows the
    arrival times ``arrived`` at a distance of ``delay``, has passed the event time of its newest version by ``wait``; then
    this version comes out. Repeated rows and older versions are dropped meanwhile. Rows that come
    when their own time is over come out as "late", for a side table. Arrival times must rise: Spark drops rows that arrive behind the watermark. Keys and times must not be
    NULL; such rows are left out. The state of a product is one row, so any number of corrections of one product needs no memory.
    Needs a state store that supports timers: start it inside :func:`timers`.
    """
    spark = stream.sparkSession
    start = F.lit("1970-01-01 00:00:00").cast("timestamp")
    wait_ms = spark.range(1).select(F.unix_millis(start + F.expr(f"INTERVAL {wait}")) - F.unix_millis(start)).first()[0]
    whole = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull() & F.col(arrived).isNotNull())
    fields = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema if f.name not in (key, arrived)])
    out = T.StructType([T.StructField(key, stream.schema[key].dataType), *fields.fields, T.StructField("kind", T.StringType())])
    return whole.withWatermark(arrived, delay).groupBy(key).transformWithStateInPandas(
        statefulProcessor=WaitForCorrections(fields, out, time, wait_ms), outputStructType=out, outputMode="Append", timeMode="EventTime"
    )


@contextlib.contextmanager
def timers(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state with timers needs, for streams started inside; others keep theirs."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def arrival_sink(path: str):
    """Batch writer: settled products with an id of their own to ``<path>/products``, late rows to ``<path>/late``.

    An id is made of the batch's number, the partition's (up to 2^13) and the row's place there: nothing that earlier
    batches wrote is read. A repeated batch replaces its own rows only.
    """

    def on_batch(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("arrival_id", F.shiftleft(F.lit(number).cast("bigint"), 46) + F.monotonically_increasing_id())
        batch.persist()
        for kind, name in ((SETTLED, "products"), (LATE, "late")):
            batch.where(F.col("kind") == kind).drop("kind").write.mode("overwrite").parquet(f"{path}/{name}/run={number}")
        batch.unpersist()

    return on_batch
