"""Global ranks and running sums without pulling all rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

MAX_BUCKETS = 512


def _cut_points(df: DataFrame, column: str, buckets: int) -> list[float]:
    """Approximate quantiles of a numeric column: at most MAX_BUCKETS numbers."""
    buckets = min(buckets, MAX_BUCKETS)
    if buckets == 1:
        return []
    probabilities = [i / buckets for i in range(1, buckets)]
    cuts = df.approxQuantile(column, probabilities, 0.2 / buckets)
    return sorted(set(cuts))


def _bucket(df: DataFrame, column: str, uniform: bool = False) -> DataFrame:
    buckets = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if uniform:
        # values over [0, 1): as many ranges as partitions, found without a look at the rows
        return df.withColumn("__bucket", F.floor(F.col(column) * buckets).cast("int"))
    cuts = _cut_points(df, column, buckets)
    if not cuts:
        return df.withColumn("__bucket", F.lit(0))
    bounds = F.array(*[F.lit(float(c)) for c in cuts])
    value = F.col(column).cast("double")
    return df.withColumn("__bucket", F.size(F.filter(bounds, lambda b: b < value)))


def global_rank(
    df: DataFrame, column: str, *ties: str, out: str = "rank", descending: bool = False,
    uniform: bool = False,
) -> DataFrame:
    """1-based position of every row by ``column`` (numeric), then ``ties``.

    Rows are cut into balanced ranges by approximate quantiles; each range is
    numbered on its own and shifted by the size of the ranges before it. The
    ranges' sizes are the only thing ordered in one task, MAX_BUCKETS rows.
    """
    ranged = _bucket(df, column, uniform)
    sizes = ranged.groupBy("__bucket").agg(F.count("*").alias("__n"))
    order = F.desc if descending else F.asc
    before = W.orderBy(order("__bucket")).rowsBetween(W.unboundedPreceding, -1)
    shift = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    inside = W.partitionBy("__bucket").orderBy(order(column), *[F.asc(t) for t in ties])
    return (
        ranged.withColumn("__rn", F.row_number().over(inside))
        .join(F.broadcast(shift), "__bucket")
        .withColumn(out, (F.col("__rn") + F.col("__shift")).cast("bigint"))
        .drop("__bucket", "__rn", "__shift")
    )


def global_running_sums(
    df: DataFrame, column: str, sums: dict[str, str], descending: bool = True
) -> DataFrame:
    """Running totals over all rows ordered by a distinct numeric ``column``.

    ``sums`` maps an output name to the column it totals. Same range scheme as
    :func:`global_rank`.
    """
    ranged = _bucket(df, column)
    order = F.desc if descending else F.asc
    totals = ranged.groupBy("__bucket").agg(*[F.sum(c).alias(f"__t_{o}") for o, c in sums.items()])
    before = W.orderBy(order("__bucket")).rowsBetween(W.unboundedPreceding, -1)
    shift = totals.select(
        "__bucket",
        *[F.coalesce(F.sum(f"__t_{o}").over(before), F.lit(0)).alias(f"__s_{o}") for o in sums],
    )
    inside = W.partitionBy("__bucket").orderBy(order(column))
    running = inside.rowsBetween(W.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(shift), "__bucket")
    for name, source in sums.items():
        out = out.withColumn(name, F.sum(source).over(running) + F.col(f"__s_{name}"))
    return out.drop("__bucket", *[f"__s_{o}" for o in sums])
