"""Tables stored in buckets of their id, so that looking rows up by it does not move them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def store_by_id(df: DataFrame, key: str = "id", buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Write a table in ``buckets`` of its key, sorted by it, and read it back; by default as many as shuffle partitions.

    Joins on the key with an equal number of partitions, or fewer, then leave this table where it lies and
    move the other side only. The table has a name of its own in the session's catalog, under ``path`` or the shared folder.
    """
    spark: SparkSession = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"by_id_{uuid.uuid4().hex}"
    placed = df.repartition(n, key)
    placed.write.bucketBy(n, key).sortBy(key).option("path", path or scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def look_up_both(pairs: DataFrame, stored: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    """:func:`.rows.lookup_both` against a table of :func:`store_by_id`: pairs travel to its buckets, its rows stay.

    The merge hint keeps Spark from shuffling the larger, stored side to the pairs' partitions.
    """
    out = pairs
    for side in ("1", "2"):
        t = stored.select(F.col(key).alias(f"id{side}"), *[F.col(c).alias(f"{c}{side}") for c in columns])
        out = out.join(t.hint("merge"), f"id{side}", "left")
    return out.select(*pairs.columns, *[f"{c}{s}" for s in ("1", "2") for c in columns])
