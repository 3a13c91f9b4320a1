"""Sources and sinks: given tables written out in a format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.sampling import assign_split
from ..operators.state import read_run, read_runs, save_clusters, write_run
from ..operators.knn import knn_join
from ..session import cut_lineage, scratch_path
from ..sources import files
from ..sources.vector_index import GrowingIndex, build_index, load_index, save_index, search_index
from .base import clusters, customer_products, portable_draw, query, similarity, table, upto
from .state import MIN_SIZE, NOW
from .vectors import TOP_K, _embeddings, held_against_exact


@query("csv_round_trip", "SELECT doc_id, text, lang, n_chars FROM documents")
def csv_round_trip(spark, sf):
    """Whole texts with quotes and line breaks through CSV."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    path = scratch_path(spark, "csv")
    files.write_csv(docs, path)
    return files.read_csv(spark, path, docs.schema, multi_line=True)


@query(
    "pair_text_scan",
    """SELECT CAST(l_partkey AS VARCHAR) AS sent1, CAST(l_suppkey AS VARCHAR) AS sent2,
              CASE WHEN l_linestatus = 'O' THEN l_linenumber END AS label FROM lineitem""",
)
def pair_text_scan(spark, sf):
    """Tab-separated pairs, some without a label."""
    label = F.when(F.col("l_linestatus") == "O", F.col("l_linenumber").cast("string"))
    line = F.concat_ws("\t", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), label)
    path = scratch_path(spark, "pairs")
    table(spark, sf, "lineitem").select(line.alias("value")).write.text(path)
    return files.read_pair_text(spark, path)


@query(
    "split_text_sink",
    f"""SELECT CASE WHEN {portable_draw('o_orderkey')} < {upto(0.8)} THEN 'train'
                    WHEN {portable_draw('o_orderkey')} < {upto(0.9)} THEN 'val' ELSE 'test' END AS set,
               CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS value FROM orders""",
)
def split_text_sink(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value")
    )
    path = scratch_path(spark, "split")
    files.write_split_text(assign_split(orders, "o_orderkey"), path)
    return spark.read.text(path)


@query("orc_round_trip", "SELECT * FROM part")
def orc_round_trip(spark, sf):
    path = scratch_path(spark, "orc")
    files.write_table(table(spark, sf, "part"), "orc", path)
    return files.read_table(spark, "orc", path)


@query(
    "saved_index_search",
    f"""SELECT id, nn_id, sim, rank FROM (
          SELECT a.vec_id AS id, b.vec_id AS nn_id, {similarity('a.embedding', 'b.embedding')} AS sim,
                 CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY
                   {similarity('a.embedding', 'b.embedding')} DESC, b.vec_id) AS INTEGER) AS rank
          FROM embeddings a, embeddings b) t WHERE rank <= {TOP_K}""",
)
def saved_index_search(spark, sf):
    items, path = _embeddings(spark, sf), scratch_path(spark, "index")
    save_index(build_index(items), spark, path)
    hits = search_index(load_index(spark, path), items, TOP_K, probes=4)
    return hits.select(F.col("q_id").alias("id"), F.col("b_id").alias("nn_id"), "sim", "rank")


@query("saved_index_ivf", "SELECT vec_id AS id, TRUE AS enough, TRUE AS none_better FROM embeddings")
def saved_index_ivf(spark, sf):
    """Approximate neighbours in a saved index, which probes as many cells as it measured when it was saved.

    Per item: at least 0.9 of the exact neighbours are found over the whole table, and no hit is nearer than the exact one of its rank.
    """
    items, path = _embeddings(spark, sf), scratch_path(spark, "index")
    save_index(build_index(items), spark, path)
    near = cut_lineage(search_index(load_index(spark, path), items, TOP_K, strategy="ivf"))
    return held_against_exact(items, near, knn_join(items, items, TOP_K))


# Embeddings after three runs: all that are not in the third, changed ones with another item's vector, none of the deleted.
AFTER_RUNS = """
    SELECT a.vec_id AS id, CASE WHEN a.vec_id % 7 = 3 THEN b.embedding ELSE a.embedding END AS vec
    FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id - 1
    WHERE a.vec_id % 11 <> 5
"""


@query(
    "index_after_runs",
    f"""WITH now AS ({AFTER_RUNS})
        SELECT id, nn_id, sim, rank FROM (
          SELECT a.id, b.id AS nn_id, {similarity('a.vec', 'b.vec')} AS sim,
                 CAST(row_number() OVER (PARTITION BY a.id ORDER BY {similarity('a.vec', 'b.vec')} DESC, b.id) AS INTEGER) AS rank
          FROM now a, now b WHERE a.vec IS NOT NULL AND b.vec IS NOT NULL) t WHERE rank <= {TOP_K}""",
)
def index_after_runs(spark, sf):
    """An index begun with a third of the vectors, changed by two runs, split and merged, searched for what counts now."""
    items = _embeddings(spark, sf).select("id", "vec")
    other = items.join(items.select((F.col("id") + 1).alias("id"), F.col("vec").alias("other")), "id", "left")
    changed = other.where("id % 7 = 3").select("id", F.col("other").alias("vec"))
    index = GrowingIndex(spark, scratch_path(spark, "growing"))
    at = index.create(items.where("id % 3 = 0"))
    at = index.change(at, items.where("id % 3 = 1"), items.where("id % 11 = 5"))
    at = index.split(at, overfull=1.5, least_rows=8)
    at = index.change(at, items.where("id % 3 = 2 AND id % 7 != 3").unionAll(changed))
    at = index.change(at, items.limit(0), items.where("id % 11 = 5"))
    at = index.merge(at)
    queries = other.where("id % 11 <> 5").select("id", F.when(F.col("id") % 7 == 3, F.col("other")).otherwise(F.col("vec")).alias("vec"))
    hits = index.search(at, queries, TOP_K, probes=4)
    return hits.select(F.col("q_id").alias("id"), F.col("b_id").alias("nn_id"), "sim", "rank")


@query(
    "run_tables",
    f"""SELECT 'before' AS version, count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_unnamed FROM orders
        UNION ALL
        SELECT 'after', CAST((SELECT count(*) FROM orders) + coalesce(sum(n), 0) AS BIGINT), CAST(coalesce(sum(n), 0) AS BIGINT) FROM (
          SELECT count(*) AS n FROM customer WHERE NOT c_acctbal > 5000 GROUP BY c_nationkey HAVING count(*) >= {MIN_SIZE}) t
        UNION ALL
        SELECT 'history', CAST((SELECT count(*) FROM orders WHERE o_orderstatus = 'O') + coalesce(sum(n), 0) AS BIGINT), 0 FROM (
          SELECT count(*) AS n FROM customer WHERE NOT c_acctbal > 5000 GROUP BY c_nationkey HAVING count(*) >= {MIN_SIZE}) t""",
)
def run_tables(spark, sf):
    """A cluster table before and after a run, and the history, as their readers see them."""
    path = scratch_path(spark, "tables")
    write_run(clusters(spark, sf), f"{path}/clusters", "1")
    offers = customer_products(spark, sf)
    found = offers.select("id", F.col("main_category").alias("cluster"))
    current, history = save_clusters(read_run(spark, f"{path}/clusters", "1"), found, offers, MIN_SIZE, F.expr(NOW))
    write_run(current, f"{path}/clusters", "2")
    write_run(history, f"{path}/histories", "2")

    def seen(label, run):
        unnamed = F.count_if(F.col("master_product_status_id") == 1)
        return read_run(spark, f"{path}/clusters", run).agg(F.count("*").alias("n_rows"), unnamed.alias("n_unnamed")).select(
            F.lit(label).alias("version"), "n_rows", "n_unnamed"
        )

    lines = read_runs(spark, f"{path}/histories").agg(F.count("*").alias("n_rows"))
    noted = lines.select(F.lit("history").alias("version"), "n_rows", F.lit(0).cast("bigint").alias("n_unnamed"))
    return seen("before", "1").unionByName(seen("after", "2")).unionByName(noted)
