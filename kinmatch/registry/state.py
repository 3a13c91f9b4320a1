"""Status-tracked tables, the pair cache, the model list and the change gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import state
from ..operators.membership import build_filters, not_stored
from ..session import scratch_path
from .base import CLUSTERS, CUSTOMER_PRODUCTS, clusters, customer_products, query, table

NOW = "TIMESTAMP '2024-06-01 00:00:00'"
MIN_SIZE = 20

# New clusters: customers by nation, those without a master only.
NEW_CLUSTERS = f"""
    free AS (SELECT id AS internal_product_id, main_category AS cluster_id FROM ({CUSTOMER_PRODUCTS}) c
             WHERE master_product_id IS NULL),
    sized AS (SELECT *, count(*) OVER (PARTITION BY cluster_id) AS n FROM free),
    fresh AS (SELECT (SELECT max(id) FROM ({CLUSTERS}) x)
                     + row_number() OVER (ORDER BY internal_product_id, cluster_id) AS id,
                     internal_product_id, cluster_id FROM sized WHERE n >= {MIN_SIZE})"""

# Suggestions: a customer with a good balance and the master of the nation's number.
NEW_SUGGESTIONS = f"""
    fresh AS (SELECT (SELECT max(id) FROM ({CLUSTERS}) x)
                     + row_number() OVER (ORDER BY id, main_category) AS id,
                     id AS internal_product_id, main_category AS master_product_id
              FROM ({CUSTOMER_PRODUCTS}) c WHERE price > 2500)"""


def _saved_clusters(spark, sf):
    offers = customer_products(spark, sf)
    found = offers.select("id", F.col("main_category").alias("cluster"))
    return state.save_clusters(clusters(spark, sf), found, offers, MIN_SIZE, F.expr(NOW))


def _saved_suggestions(spark, sf):
    matches = customer_products(spark, sf).select(
        F.col("id").alias("id1"), F.col("main_category").alias("id2"),
        (F.col("price") > 2500).cast("int").alias("match"),
    )
    return state.save_suggestions(clusters(spark, sf), matches, F.expr(NOW))


@query(
    "status_replace",
    f"""WITH {NEW_CLUSTERS}
        SELECT id, internal_product_id, product_source_id, master_product_id,
               CASE WHEN master_product_status_id = 1 THEN NULL ELSE cluster_id END AS cluster_id,
               CASE WHEN master_product_status_id = 1 THEN 4 ELSE master_product_status_id END AS master_product_status_id,
               created_at FROM ({CLUSTERS}) c
        UNION ALL SELECT id, internal_product_id, NULL, NULL, cluster_id, 1, {NOW} FROM fresh""",
)
def status_replace(spark, sf):
    return _saved_clusters(spark, sf)[0]


@query(
    "status_replace_history",
    f"""WITH {NEW_CLUSTERS}
        SELECT id AS master_product_cluster_id, 1 AS previous_status_id, 4 AS current_status_id
        FROM ({CLUSTERS}) c WHERE master_product_status_id = 1
        UNION ALL SELECT id, 1, 1 FROM fresh""",
)
def status_replace_history(spark, sf):
    return _saved_clusters(spark, sf)[1]


@query(
    "suggest_replace",
    f"""WITH {NEW_SUGGESTIONS}
        SELECT id, internal_product_id, product_source_id, master_product_id, cluster_id,
               CASE WHEN master_product_status_id = 5 THEN 4 ELSE master_product_status_id END AS master_product_status_id,
               created_at FROM ({CLUSTERS}) c
        UNION ALL SELECT id, internal_product_id, NULL, master_product_id, NULL, 5, {NOW} FROM fresh""",
)
def suggest_replace(spark, sf):
    return _saved_suggestions(spark, sf)[0]


@query(
    "suggest_replace_history",
    f"""WITH {NEW_SUGGESTIONS}
        SELECT id AS master_product_cluster_id, 5 AS previous_status_id, 4 AS current_status_id
        FROM ({CLUSTERS}) c WHERE master_product_status_id = 5
        UNION ALL SELECT id, 5, 5 FROM fresh""",
)
def suggest_replace_history(spark, sf):
    return _saved_suggestions(spark, sf)[1]


# Scores of (part, supplier) pairs: shipped lines are cached by line number as the model.
STORED = """SELECT l_partkey AS product_source_id_1, l_suppkey AS product_source_id_2,
                   CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS match, l_discount AS prob,
                   CAST(l_linenumber AS BIGINT) AS model_id
            FROM lineitem WHERE l_linestatus = 'F'"""


def _stored(spark, sf):
    return table(spark, sf, "lineitem").where("l_linestatus = 'F'").select(
        F.col("l_partkey").alias("product_source_id_1"), F.col("l_suppkey").alias("product_source_id_2"),
        (F.col("l_returnflag") == "A").cast("int").alias("match"), F.col("l_discount").alias("prob"),
        F.col("l_linenumber").cast("bigint").alias("model_id"),
    )


def _scored(spark, sf):
    return table(spark, sf, "lineitem").where("l_linestatus = 'O'").select(
        F.col("l_partkey").alias("id1"), F.col("l_suppkey").alias("id2"),
        (F.col("l_returnflag") == "A").cast("int").alias("match"), F.col("l_tax").alias("prob"),
    )


@query(
    "cache_upsert",
    f"""WITH both_sides AS (
          SELECT *, 0 AS fresh FROM ({STORED}) s WHERE model_id = 1
          UNION ALL SELECT l_partkey, l_suppkey, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END, l_tax, 1, 1
          FROM lineitem WHERE l_linestatus = 'O')
        SELECT product_source_id_1, product_source_id_2, match, prob, model_id FROM (
          SELECT *, row_number() OVER (PARTITION BY product_source_id_1, product_source_id_2
                                       ORDER BY fresh, prob DESC, match DESC) AS rn FROM both_sides) t WHERE rn = 1""",
)
def cache_upsert(spark, sf):
    return state.cache_scores(_stored(spark, sf), _scored(spark, sf), 1)


@query(
    "cache_anti",
    """SELECT DISTINCT o.l_partkey AS id1, o.l_suppkey AS id2 FROM lineitem o WHERE l_linestatus = 'O'
         AND NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_linestatus = 'F'
                         AND f.l_partkey = o.l_partkey AND f.l_suppkey = o.l_suppkey)""",
)
def cache_anti(spark, sf):
    cached = _stored(spark, sf).select(
        F.col("product_source_id_1").alias("id1"), F.col("product_source_id_2").alias("id2")
    )
    return state.without_cached(_scored(spark, sf).select("id1", "id2").distinct(), cached)


@query(
    "cache_filter_anti",
    """WITH asked AS (SELECT DISTINCT l_partkey AS id1, l_orderkey AS id2 FROM lineitem WHERE l_linestatus = 'O'
                      UNION SELECT l_partkey, l_orderkey FROM lineitem WHERE l_linestatus = 'F' AND l_linenumber = 1),
            stored AS (SELECT l_partkey AS id1, l_orderkey AS id2 FROM lineitem WHERE l_linestatus = 'F')
       SELECT id1, id2, TRUE AS most_skipped FROM asked a
       WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.id1 = a.id1 AND s.id2 = a.id2)""",
)
def cache_filter_anti(spark, sf):
    """Pairs that are not in the cache, by way of its filters, kept from two runs; and whether these spared the look-up for most of them."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("id1"), F.col("l_orderkey").alias("id2"), "l_linestatus", "l_linenumber"
    )
    stored, path = lines.where("l_linestatus = 'F'"), scratch_path(spark, "filters")
    for run, rule in (("1", "l_linenumber <= 2"), ("2", "l_linenumber > 2")):
        state.write_run(build_filters(stored.where(rule), part_pairs=1 << 14), path, run)
    asked = lines.where("l_linestatus = 'O' OR l_linenumber = 1").select("id1", "id2").distinct()
    looked = not_stored(asked, stored, state.read_runs(spark, path))
    return looked.absent.withColumn("most_skipped", F.lit(looked.skipped >= 0.95))


@query(
    "cache_union",
    f"""SELECT l_partkey AS id1, l_suppkey AS id2, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS match, l_tax AS prob
        FROM lineitem WHERE l_linestatus = 'O'
        UNION ALL SELECT product_source_id_1, product_source_id_2, match, prob FROM ({STORED}) s""",
)
def cache_union(spark, sf):
    cached = _stored(spark, sf).select(
        F.col("product_source_id_1").alias("id1"), F.col("product_source_id_2").alias("id2"), "match", "prob"
    )
    return state.with_cached(_scored(spark, sf), cached)


def _models(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("tag"), F.col("ts").alias("created_at"),
        F.lit(True).alias("in_use"), F.col("props").alias("blob"), F.col("props").alias("name"),
    ).select("id", "name", "blob", "in_use", "tag", "created_at")


@query(
    "register_latest",
    """SELECT event_id AS id, props AS name, props AS blob,
              event_id = first_value(event_id) OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS in_use,
              event_type AS tag, ts AS created_at FROM events""",
)
def register_latest(spark, sf):
    return state.keep_newest_in_use(_models(spark, sf))


@query(
    "register_model",
    f"""SELECT event_id AS id, props AS name, props AS blob, event_type <> 'click' AS in_use, event_type AS tag,
               ts AS created_at FROM events
        UNION ALL SELECT max(event_id) + 1, 'model7', 'models/model7', TRUE, 'click', {NOW} FROM events""",
)
def register_model(spark, sf):
    return state.register_model(_models(spark, sf), "models/model7", "click", F.expr(NOW))


@query(
    "change_gate",
    f"""WITH counted AS (SELECT c_nationkey AS gate, count(*) AS count_now FROM customer GROUP BY 1),
        stored AS (SELECT s_nationkey AS gate, 10 * count(*) AS stored_count, TIMESTAMP '2001-07-01 00:00:00' AS last_run
                   FROM supplier GROUP BY 1),
        newest AS (SELECT c_nationkey AS gate, max(o_orderdate) AS created_at FROM orders
                   JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
        joined AS (SELECT c.gate, c.count_now, s.stored_count,
                     s.stored_count IS NOT NULL AND (c.count_now - s.stored_count > 5
                       OR coalesce(n.created_at > s.last_run, FALSE)) AS triggered
                   FROM counted c LEFT JOIN stored s ON s.gate = c.gate LEFT JOIN newest n ON n.gate = c.gate)
        SELECT *, CASE WHEN stored_count IS NULL OR triggered THEN count_now ELSE stored_count END AS next_count
        FROM joined""",
)
def change_gate(spark, sf):
    return _decided(spark, sf)[0]


def _decided(spark, sf):
    customer, supplier, orders = (table(spark, sf, t) for t in ("customer", "supplier", "orders"))
    counted = customer.groupBy(F.col("c_nationkey").alias("gate")).agg(F.count("*").alias("count_now"))
    stored = supplier.groupBy(F.col("s_nationkey").alias("gate")).agg((10 * F.count("*")).alias("stored_count"))
    stored = stored.withColumn("last_run", F.expr("TIMESTAMP '2001-07-01 00:00:00'"))
    urgent = orders.where("o_orderpriority = '1-URGENT'").join(customer, F.col("c_custkey") == F.col("o_custkey"))
    newest = urgent.groupBy(F.col("c_nationkey").alias("gate")).agg(F.max("o_orderdate").alias("created_at"))
    return state.change_gate(counted, stored, 5, newest), counted, stored, newest


@query(
    "change_gate_again",
    """SELECT c_nationkey AS gate, FALSE AS triggered FROM customer GROUP BY 1""",
)
def change_gate_again(spark, sf):
    """The gates once more right after a run that stored what it counted: nothing has changed since."""
    decided, counted, stored, newest = _decided(spark, sf)
    path = scratch_path(spark, "gates")
    state.write_run(state.advance_gates(decided, stored, F.expr(NOW)), path, "1")
    again = state.change_gate(counted, state.read_run(spark, path, "1"), 5, newest)
    # a gate that had no stored count has never run; newer models start it only once it has
    return again.select("gate", F.coalesce("triggered", F.lit(False)).alias("triggered"))
