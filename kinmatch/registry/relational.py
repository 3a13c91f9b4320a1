"""Source queries, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import colocated, distinct, rows, state
from ..operators.state import read_runs, write_run
from ..plans import queries as q
from ..session import scratch_path
from .base import CLUSTERS, CUSTOMER_PRODUCTS, clusters, customer_products, query, table


@query(
    "labelled_products",
    f"""SELECT m.product_source_id AS id, m.master_product_id AS master_product, p.name, p.description,
               p.price, p.main_category
        FROM ({CLUSTERS}) m LEFT JOIN ({CUSTOMER_PRODUCTS}) p ON p.id_source = m.product_source_id
        WHERE m.master_product_status_id = 2""",
)
def labelled_products(spark, sf):
    return q.labelled_products(
        clusters(spark, sf), customer_products(spark, sf), ["name", "description", "price", "main_category"]
    )


@query("labelled_count", "SELECT count(*) AS count FROM orders WHERE o_orderstatus = 'F'")
def labelled_count(spark, sf):
    return q.count_rows(q.labelled_products(clusters(spark, sf), customer_products(spark, sf), ["name"]))


@query(
    "pending_count",
    f"""SELECT count(*) AS count FROM ({CUSTOMER_PRODUCTS}) p
        WHERE id IN (SELECT internal_product_id FROM ({CLUSTERS}) c WHERE master_product_status_id = 3)
           OR id NOT IN (SELECT internal_product_id FROM ({CLUSTERS}) c)""",
)
def pending_count(spark, sf):
    return q.count_rows(
        q.pending_products(customer_products(spark, sf), clusters(spark, sf), cluster_key="internal_product_id")
    )


@query(
    "matcher_input",
    f"""SELECT p.id_source AS id, p.name, p.description, p.price, p.main_category,
               m.master_product_id AS master_product
        FROM ({CUSTOMER_PRODUCTS}) p LEFT JOIN ({CLUSTERS}) m ON p.id = m.master_product_id""",
)
def matcher_input(spark, sf):
    return q.matcher_input(
        customer_products(spark, sf), clusters(spark, sf), ["name", "description", "price", "main_category"]
    )


@query(
    "oneshot_input",
    f"""SELECT p.id_source AS id, p.name, p.description, p.price, m.master_product_id,
               s.s_name AS master_product
        FROM ({CUSTOMER_PRODUCTS}) p LEFT JOIN ({CLUSTERS}) m ON p.id = m.master_product_id
        LEFT JOIN supplier s ON s.s_suppkey = m.master_product_id""",
)
def oneshot_input(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return q.one_shot_input(
        customer_products(spark, sf), clusters(spark, sf), suppliers, ["name", "description", "price"]
    )


@query(
    "mixed_union",
    """SELECT c.c_custkey AS id, o.o_orderkey AS master_product_id, CAST(c.c_name AS VARCHAR) AS name,
              format('{:,}', CAST(floor(o.o_totalprice) AS BIGINT)) AS price,
              r.r_name AS main_category, n2.n_name AS sub_category
       FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
       JOIN nation n ON n.n_nationkey = c.c_nationkey
       JOIN region r ON r.r_regionkey = n.n_regionkey
       JOIN nation n2 ON n2.n_nationkey = n.n_nationkey
       WHERE o.o_orderstatus = 'O'
       UNION
       SELECT s.s_suppkey, l.l_orderkey, s.s_name, format('{:,}', CAST(floor(l.l_extendedprice) AS BIGINT)),
              NULL, n.n_name
       FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
       JOIN nation n ON n.n_nationkey = s.s_nationkey WHERE l.l_returnflag = 'R'""",
)
def mixed_union(spark, sf):
    customer, orders, nation, region, supplier, lineitem = (
        table(spark, sf, t) for t in ("customer", "orders", "nation", "region", "supplier", "lineitem")
    )
    own = q.priced_products(
        customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                        F.col("c_nationkey").alias("product_category_id")),
        orders.select(F.col("o_custkey").alias("product_id"), F.col("o_orderkey").alias("master_product_id"),
                      (F.col("o_orderstatus") != "O").alias("is_removed"),
                      F.col("o_totalprice").alias("price")),
        nation.select(F.col("n_regionkey").alias("parent_id"), F.col("n_nationkey").alias("child_id")),
        region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
    )
    external = (
        lineitem.where("l_returnflag = 'R'")
        .join(supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            F.col("s_suppkey").alias("id"), F.col("l_orderkey").alias("master_product_id"),
            F.col("s_name").alias("name"), q.thousands("l_extendedprice").alias("price"),
            F.lit(None).cast("string").alias("main_category"), F.col("n_name").alias("sub_category"),
        )
    )
    return q.union_distinct(own, external)


@query(
    "latest_per_tag",
    """SELECT event_type AS tag, event_id, ts, value FROM (
         SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) rn FROM events) t
       WHERE rn = 1""",
)
def latest_per_tag(spark, sf):
    events = table(spark, sf, "events").select("event_type", "event_id", "ts", "value")
    latest = rows.latest_per_key(events, "event_type", "ts", "event_id")
    return latest.withColumnRenamed("event_type", "tag")


@query("live_masters", "SELECT p_partkey AS id, p_name AS name, p_size AS weight FROM part WHERE p_type <> 'PROMO'")
def live_masters(spark, sf):
    part = table(spark, sf, "part")
    return part.where("p_type <> 'PROMO'").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("weight")
    )


@query("category_slice", "SELECT doc_id, text, source FROM documents WHERE lang = 'de'")
def category_slice(spark, sf):
    return table(spark, sf, "documents").where("lang = 'de'").select("doc_id", "text", "source")


@query("point_lookup", "SELECT * FROM customer WHERE c_custkey = 7")
def point_lookup(spark, sf):
    return table(spark, sf, "customer").where("c_custkey = 7")


@query(
    "status_snapshot",
    f"""SELECT id AS master_product_cluster_id, 1 AS previous_status_id, 4 AS current_status_id
        FROM ({CLUSTERS}) c WHERE master_product_status_id = 1""",
)
def status_snapshot(spark, sf):
    return state.status_snapshot(clusters(spark, sf), 1, 4)


@query(
    "newest_n",
    f"""SELECT id, master_product_status_id AS status, created_at FROM ({CLUSTERS}) c
        ORDER BY created_at DESC, id DESC LIMIT 25""",
)
def newest_n(spark, sf):
    newest = rows.newest(clusters(spark, sf), 25, "created_at", "id")
    return newest.select("id", F.col("master_product_status_id").alias("status"), "created_at")


@query("accepted_clusters", f"SELECT * FROM ({CLUSTERS}) c WHERE master_product_status_id = 2")
def accepted_clusters(spark, sf):
    return state.accepted_clusters(clusters(spark, sf))


@query(
    "attach_masters",
    """SELECT l_orderkey, l_linenumber, l_partkey AS master_product_id, p_name AS master_product,
              p_brand AS master_product_base
       FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
)
def attach_masters(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("base")
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("master_product_id")
    )
    return rows.attach_masters(lines, part)


@query(
    "inner_on_id",
    """SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
)
def inner_on_id(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id")


@query(
    "pair_names",
    """SELECT l_partkey AS id1, l_suppkey AS id2, a.p_name AS name1, b.p_name AS name2
       FROM lineitem LEFT JOIN part a ON a.p_partkey = l_partkey LEFT JOIN part b ON b.p_partkey = l_suppkey""",
)
def pair_names(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    pairs = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id1"), F.col("l_suppkey").alias("id2"))
    return rows.lookup_both(pairs, part, ["name"])


@query(
    "pair_names_colocated",
    """SELECT l_partkey AS id1, l_suppkey AS id2, a.p_name AS name1, b.p_name AS name2
       FROM lineitem LEFT JOIN part a ON a.p_partkey = l_partkey LEFT JOIN part b ON b.p_partkey = l_suppkey""",
)
def pair_names_colocated(spark, sf):
    """The same against a table stored in buckets of its id, which stays where it lies."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    pairs = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id1"), F.col("l_suppkey").alias("id2"))
    return colocated.look_up_both(pairs, colocated.store_by_id(part), ["name"])


@query(
    "pair_images",
    """SELECT doc_id AS id1, doc_id + 1 AS id2, quality AS match, p1.url AS url1, p2.url AS url2
       FROM labels LEFT JOIN pages p1 ON p1.page_id = doc_id LEFT JOIN pages p2 ON p2.page_id = doc_id + 1""",
)
def pair_images(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("id"), "url")
    pairs = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id1"), (F.col("doc_id") + 1).alias("id2"), F.col("quality").alias("match")
    )
    return rows.lookup_both(pairs, pages, ["url"])


@query(
    "keep_listed",
    "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def keep_listed(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return rows.keep_listed(documents, table(spark, sf, "labels"), "doc_id")


@query(
    "drop_listed",
    "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def drop_listed(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return rows.drop_listed(documents, table(spark, sf, "labels"), "doc_id")


@query(
    "value_counts",
    "SELECT l_shipdate, count(*) AS count FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1",
)
def value_counts(spark, sf):
    return rows.value_counts(table(spark, sf, "lineitem").select("l_shipdate"), "l_shipdate")


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_values(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_type").distinct()


@query(
    "distinct_two_cols",
    "SELECT count(*) AS n FROM (SELECT l_partkey FROM lineitem UNION SELECT l_suppkey FROM lineitem) t",
)
def distinct_two_cols(spark, sf):
    return rows.distinct_over(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query(
    "distinct_over_runs",
    """SELECT l_returnflag, count(DISTINCT v) AS n, TRUE AS near FROM (
         SELECT l_returnflag, l_partkey AS v FROM lineitem UNION ALL SELECT l_returnflag, l_suppkey FROM lineitem) t GROUP BY 1""",
)
def distinct_over_runs(spark, sf):
    """Distinct values over two columns from the stored sketches of two runs that overlap, held against the exact number."""
    lines, path = table(spark, sf, "lineitem"), scratch_path(spark, "sketches")
    for run, rule in (("1", "l_linenumber <= 4"), ("2", "l_linenumber >= 3")):
        write_run(distinct.sketch_distinct(lines.where(rule), ["l_partkey", "l_suppkey"], ["l_returnflag"]), path, run)
    near = distinct.estimate_distinct(read_runs(spark, path), ["l_returnflag"], out="estimate")
    values = lines.select("l_returnflag", F.explode(F.array("l_partkey", "l_suppkey")).alias("v")).distinct()
    exact = values.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    close = F.abs(F.col("estimate") - F.col("n")) <= 0.02 * F.col("n")
    return exact.join(near, "l_returnflag").select("l_returnflag", "n", close.alias("near"))


@query(
    "groups_min_count",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
         SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 12)""",
)
def groups_min_count(spark, sf):
    return rows.groups_with(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 12)


@query(
    "duplicated_rows",
    """SELECT o_orderkey, o_custkey FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) rn FROM orders) t
       WHERE rn > 1""",
)
def duplicated_rows(spark, sf):
    return rows.not_first(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey")


@query(
    "first_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) rn FROM orders) t
       WHERE rn = 1""",
)
def first_per_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return rows.first_per_key(orders, "o_custkey", "o_orderdate", "o_orderkey").drop("o_orderdate")


@query(
    "union_all",
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
       UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""",
)
def union_all(spark, sf):
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    return rows.union_all(supplier, None, customer)
