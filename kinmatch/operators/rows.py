"""Row-level table operators: keep-first, group filters, lookups, set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.ranks import global_rank
from ..session import cut_lineage


def _list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_per_key(df: DataFrame, key: str | Sequence[str], *order: Column | str) -> DataFrame:
    """One row per key, the first by ``order``; NULL keys form one group.

    Spark keeps one row per key in each map task before the shuffle (window
    group limit), so a hot key costs its reducer one row per map task.
    """
    w = W.partitionBy(*_list(key)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def latest_per_key(df: DataFrame, key: str | Sequence[str], time: str, tie: str) -> DataFrame:
    return first_per_key(df, key, F.desc(time), F.desc(tie))


def newest(df: DataFrame, n: int, time: str, tie: str) -> DataFrame:
    """The n newest rows: a top-k, not a sort of the table."""
    return df.orderBy(F.desc(time), F.desc(tie)).limit(n)


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def not_first(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Rows that are not the first of their value (a ``duplicated`` mask).

    The first position per value is aggregated and joined back; no window runs
    over a value's rows, so a hot value stays spread over many tasks.
    """
    firsts = df.groupBy(key).agg(F.min(seq).alias("__first"))
    joined = df.join(firsts, df[key].eqNullSafe(firsts[key])).drop(firsts[key])
    return joined.where(F.col(seq) > F.col("__first")).drop("__first")


def groups_with(df: DataFrame, key: str, at_least: int) -> DataFrame:
    """Rows of the groups that hold ``at_least`` rows or more."""
    big = df.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") >= at_least)
    return df.join(big.select(key), key, "left_semi")


def duplicated_groups(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Non-first rows of the values that still have more than one row after that."""
    return groups_with(not_first(df, key, seq), key, 2)


def dense_ids(df: DataFrame, value: str, seq: str, out: str) -> DataFrame:
    """0-based number of each value by first appearance; NULL values stay NULL.

    Only the distinct values are ranked, and that in ranges.
    """
    firsts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(seq).alias("__first"))
    numbered = global_rank(cut_lineage(firsts), "__first", out="__rank")
    ids = numbered.select(value, (F.col("__rank") - 1).alias(out))
    return df.join(ids, value, "left").select(*df.columns, out)


def lookup_both(pairs: DataFrame, table: DataFrame, columns: Sequence[str], key: str = "id",
                how: str = "left") -> DataFrame:
    """Attach ``columns`` of both members of each pair, suffixed 1 and 2."""
    out = pairs
    for side in ("1", "2"):
        t = table.select(F.col(key).alias(f"id{side}"), *[F.col(c).alias(f"{c}{side}") for c in columns])
        out = out.join(t, f"id{side}", how)
    return out.select(*pairs.columns, *[f"{c}{s}" for s in ("1", "2") for c in columns])


def attach_masters(products: DataFrame, masters: DataFrame) -> DataFrame:
    """Name and base name of each product's master, NULL where it has none."""
    names = masters.select(
        F.col("id").alias("master_product_id"),
        F.col("name").alias("master_product"),
        F.col("base").alias("master_product_base"),
    )
    return products.join(names, "master_product_id", "left")


def keep_listed(df: DataFrame, listed: DataFrame, key: str, listed_key: str | None = None) -> DataFrame:
    keys = listed.select(F.col(listed_key or key).alias(key))
    return df.join(keys, key, "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, key: str, listed_key: str | None = None) -> DataFrame:
    keys = listed.select(F.col(listed_key or key).alias(key))
    return df.join(keys, key, "left_anti")


def canonical_pairs(pairs: DataFrame, a: str = "id1", b: str = "id2") -> DataFrame:
    """Unordered, distinct pairs as ``id1 < id2`` (equal members allowed); a pair that lacks a member is none."""
    whole = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return whole.select(F.least(a, b).alias("id1"), F.greatest(a, b).alias("id2")).distinct()


def union_all(*frames: DataFrame | None) -> DataFrame:
    """Union by name; absent sides are skipped, absent columns become NULL."""
    present = [f for f in frames if f is not None]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), present)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.desc("count"), column)


def distinct_over(df: DataFrame, columns: Sequence[str], out: str = "n") -> DataFrame:
    """Number of distinct values found in any of the columns."""
    values = df.select(F.explode(F.array(*columns)).alias("v")).where(F.col("v").isNotNull())
    return values.distinct().agg(F.count("*").alias(out))


def best_per_key(df: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    return first_per_key(df, key, F.desc(score), F.asc(tie))


def master_counts(clusters: DataFrame, cluster: str = "cluster", master: str = "master_product") -> DataFrame:
    """Rows per (cluster, master), masters that are NULL left out."""
    labelled = clusters.where(F.col(master).isNotNull())
    return labelled.groupBy(cluster, master).agg(F.count("*").alias("n"))


def master_shares(clusters: DataFrame, cluster: str = "cluster", master: str = "master_product") -> DataFrame:
    """``(cluster, master, n)``: rows per master of every cluster; a cluster without any has one row of NULL and 0."""
    counts = master_counts(clusters, cluster, master)
    every = clusters.select(cluster).distinct()
    return every.join(counts, cluster, "left").select(cluster, master, F.coalesce("n", F.lit(0)).alias("n"))


def cluster_members(clusters: DataFrame, seq: str, cluster: str = "cluster", name: str = "name") -> DataFrame:
    """``(cluster, position, name, size)``: every member by name, then ``seq``, with its cluster's size.

    One row per member at any size: a cluster is sorted, which may spill, but never gathered into one value.
    """
    sizes = clusters.groupBy(cluster).agg(F.count("*").alias("size"))
    inside = W.partitionBy(cluster).orderBy(name, seq)
    placed = clusters.withColumn("position", F.row_number().over(inside))
    return placed.join(sizes, cluster).select(cluster, "position", name, "size")
