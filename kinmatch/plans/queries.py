"""Source queries of the jobs: labelled products, pending products, job inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import STATUS_ACCEPTED, STATUS_REMATCH


def thousands(price: Column | str) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(F.floor(price), 0)


def labelled_products(
    clusters: DataFrame, products: DataFrame, columns: Sequence[str], source: str = "id_source"
) -> DataFrame:
    """Accepted clusters with their product's columns, NULL where the product is gone."""
    accepted = clusters.where(F.col("master_product_status_id") == STATUS_ACCEPTED).select(
        F.col("product_source_id").alias("id"), F.col("master_product_id").alias("master_product")
    )
    detail = products.select(F.col(source).alias("id"), *columns)
    return accepted.join(detail, "id", "left")


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))


def pending_products(products: DataFrame, clusters: DataFrame, key: str = "id", cluster_key: str = "id") -> DataFrame:
    """Products to match again or never matched.

    ``key IN (ids to re-match) OR key NOT IN (all ids)`` with SQL's rule that a
    NULL among the ids leaves the second test unknown. The ids are reduced to one
    row each and joined; no nested-loop join.
    """
    rematch = F.coalesce(F.col("master_product_status_id") == STATUS_REMATCH, F.lit(False))
    ids = clusters.groupBy(F.col(cluster_key).alias("__id")).agg(F.max(rematch).alias("__rematch"))
    has_null = clusters.agg(
        F.coalesce(F.max(F.col(cluster_key).isNull()), F.lit(False)).alias("v")
    ).scalar()
    none_at_all = clusters.agg((F.count("*") == 0).alias("v")).scalar()
    flagged = products.join(ids.where("__id IS NOT NULL"), F.col(key) == F.col("__id"), "left")
    unseen = F.col("__id").isNull() & ~has_null & (F.col(key).isNotNull() | none_at_all)
    return flagged.where(F.coalesce("__rematch", F.lit(False)) | unseen).select(*products.columns)


def matcher_input(
    products: DataFrame, clusters: DataFrame, columns: Sequence[str],
    product_key: str = "id", cluster_key: str = "master_product_id",
) -> DataFrame:
    """Products with the master found under the configured join columns."""
    links = clusters.select(
        F.col(cluster_key).alias("__key"), F.col("master_product_id").alias("master_product")
    )
    joined = products.join(links, F.col(product_key) == F.col("__key"), "left")
    return joined.select(F.col("id_source").alias("id"), *columns, "master_product")


def one_shot_input(
    products: DataFrame, clusters: DataFrame, masters: DataFrame, columns: Sequence[str],
    product_key: str = "id", cluster_key: str = "master_product_id",
) -> DataFrame:
    """As :func:`matcher_input`, with the master's id and name."""
    linked = matcher_input(products, clusters, columns, product_key, cluster_key)
    names = masters.select(F.col("id").alias("master_product_id"), F.col("name").alias("master_product"))
    return linked.withColumnRenamed("master_product", "master_product_id").join(
        names, "master_product_id", "left"
    )


def priced_products(
    products: DataFrame, fins: DataFrame, children: DataFrame, mains: DataFrame, subs: DataFrame
) -> DataFrame:
    """Own products with master, price and both category names.

    ``fins`` is ``(product_id, master_product_id, is_removed, price)``, ``children``
    ``(parent_id, child_id)``; removed links are left out before the joins.
    """
    live = fins.where(~F.col("is_removed")).drop("is_removed")
    main = mains.select(F.col("id").alias("parent_id"), F.col("name").alias("main_category"))
    sub = subs.select(F.col("id").alias("child_id"), F.col("name").alias("sub_category"))
    categories = children.join(main, "parent_id").join(sub, "child_id")
    return (
        products.join(live, F.col("id") == F.col("product_id"))
        .join(categories, F.col("product_category_id") == F.col("child_id"))
        .select(
            "id", "master_product_id", F.col("name").cast("string").alias("name"),
            thousands("price").alias("price"), "main_category", "sub_category",
        )
    )


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()
