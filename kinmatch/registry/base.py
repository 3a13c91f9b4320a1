"""Registration helper and the stand-in tables both engines build from the given ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.numeric import DRAW_MODULUS
from ..session import use_all_cores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same query for a SQL engine."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with costly row work ahead."""
    return use_all_cores(table(spark, folder, name))


def views(spark: SparkSession, folder: str, sql: str, *names: str) -> DataFrame:
    """A stand-in's SELECT over the named tables."""
    return spark.sql(sql, **{n: table(spark, folder, n) for n in names})


def braced(sql: str, *names: str) -> str:
    """The same SELECT with its table names marked for Spark's frame arguments."""
    out = sql
    for n in names:
        out = out.replace(f"FROM {n} ", f"FROM {{{n}}} ").replace(f"JOIN {n} ", f"JOIN {{{n}}} ")
    return out


# Offers: every part, with the vector that its number comes to.
PRODUCTS = """
SELECT p.p_partkey AS id, p.p_name AS name, p.p_type AS description, p.p_retailprice AS price,
       CAST(floor(p.p_size / 10.0) AS BIGINT) AS quantity,
       CAST(length(p.p_type) AS BIGINT) AS volume,
       CASE WHEN p.p_type = 'PROMO' THEN NULL ELSE CAST(length(p.p_name) AS BIGINT) END AS weight,
       CASE WHEN p.p_type = 'LARGE' THEN NULL ELSE CAST(substr(p.p_brand, 7) AS BIGINT) END AS outlet_id,
       CAST(length(p.p_type) AS BIGINT) AS product_category_id,
       p.p_brand || ' ' || p.p_name AS master_product,
       e.label AS label, e.embedding AS vec
FROM (SELECT *, (SELECT count(*) FROM embeddings v) AS n_vectors FROM part q) p
LEFT JOIN embeddings e ON e.vec_id = p.p_partkey % p.n_vectors
"""

# Masters: the first offer of each brand and name stands for it.
MASTERS = f"""
SELECT min(id) AS id, master_product AS name, min_by(product_category_id, id) AS product_category_id,
       min_by(vec, id) AS vec
FROM ({PRODUCTS}) t WHERE master_product IS NOT NULL GROUP BY master_product
"""

# Cluster table: orders with their status as the cluster's.
CLUSTERS = """
SELECT o_orderkey AS id, o_custkey AS internal_product_id, o_custkey AS product_source_id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
            ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS master_product_id,
       CAST(floor(o_totalprice / 10000.0) AS BIGINT) AS cluster_id,
       CASE WHEN o_orderstatus = 'F' THEN 2 WHEN o_orderstatus = 'O' THEN 1
            WHEN o_orderpriority = '2-HIGH' THEN 3 ELSE 5 END AS master_product_status_id,
       o_orderdate AS created_at
FROM orders t
"""

# Offers of the cluster table's customers.
CUSTOMER_PRODUCTS = """
SELECT c_custkey AS id, c_custkey AS id_source, c_name AS name, c_mktsegment AS description,
       c_acctbal AS price, CAST(c_nationkey AS BIGINT) AS main_category,
       CASE WHEN c_acctbal > 5000 THEN CAST(c_nationkey AS BIGINT) ELSE NULL END AS master_product_id
FROM customer t
"""

def portable_draw(key: str, seed: int = 0) -> str:
    """SQL of :func:`kinmatch.functions.numeric.draw` over one key."""
    text = f"coalesce(CAST({key} AS VARCHAR), '') || ':{seed}'"
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def upto(fraction: float) -> int:
    """The draw at which a fraction ends."""
    return int(fraction * DRAW_MODULUS)


# Cosine similarity of every two vectors, for the brute-force side only.
SIMILARITY = "round(list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])), 9)"


def similarity(a: str, b: str) -> str:
    return SIMILARITY.format(a=a, b=b)


def products(spark: SparkSession, folder: str) -> DataFrame:
    return views(spark, folder, braced(PRODUCTS, "embeddings", "part"), "embeddings", "part")


def masters(spark: SparkSession, folder: str) -> DataFrame:
    return views(spark, folder, braced(MASTERS, "embeddings", "part"), "embeddings", "part")


def clusters(spark: SparkSession, folder: str) -> DataFrame:
    return views(spark, folder, braced(CLUSTERS, "orders"), "orders")


def customer_products(spark: SparkSession, folder: str) -> DataFrame:
    return views(spark, folder, braced(CUSTOMER_PRODUCTS, "customer"), "customer")
