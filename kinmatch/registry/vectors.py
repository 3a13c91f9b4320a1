"""Vector arithmetic, neighbour search and blocking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors as v
from ..operators import blocking, knn
from ..operators.encode import fit_tfidf, fit_word2vec
from ..operators.products import cosine_of_products, euclidean_of_products, pair_products
from ..session import cut_lineage
from .base import MASTERS, PRODUCTS, masters, products, query, similarity, table, spread

TOP_K = 6
BLOCK_TOP_K = 100
BLOCK_THRESHOLD = 0.25


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")


DISTANCE = "sqrt(greatest(0.0, 2.0 - 2.0 * sim))"


def self_neighbours(source: str = PRODUCTS) -> str:
    """SQL: every ordered pair with its similarity and the neighbour's rank, the row itself being 1."""
    return f"""
    prod AS MATERIALIZED ({source}),
    sims AS (SELECT a.id AS id, b.id AS nn_id,
                    CASE WHEN a.id = b.id THEN 1.0 ELSE {similarity('a.vec', 'b.vec')} END AS sim
             FROM prod a, prod b),
    ranked AS MATERIALIZED (
      SELECT id, nn_id, sim, CASE WHEN id = nn_id THEN 0.0 ELSE {DISTANCE} END AS dist,
             CAST(row_number() OVER (PARTITION BY id ORDER BY (id = nn_id) DESC, sim DESC, nn_id) AS INTEGER) AS rank
      FROM sims)"""


EMBEDDED = "SELECT vec_id AS id, embedding AS vec, label FROM embeddings"


@query(
    "knn_self_topk",
    f"""WITH {self_neighbours(EMBEDDED)}
        SELECT id, nn_id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= {TOP_K}""",
)
def knn_self_topk(spark, sf):
    near = knn.knn_self(_embeddings(spark, sf), TOP_K)
    return near.withColumn("dist", F.round("dist", 6))


@query(
    "knn_self_pruned",
    f"""WITH {self_neighbours(EMBEDDED)}
        SELECT id, nn_id, round(dist, 6) AS dist, rank FROM ranked WHERE rank <= {TOP_K}""",
)
def knn_self_pruned(spark, sf):
    """The same answer by way of cells, tiles and bounds, with tiles small enough to need them."""
    near = knn.knn_self(_embeddings(spark, sf), TOP_K, tile_rows=128, chunk_rows=512, probes=2)
    return near.withColumn("dist", F.round("dist", 6))


@query(
    "knn_cross_topk",
    f"""SELECT id, master_id, sim, rank FROM (
          SELECT p.id, m.id AS master_id, {similarity('p.vec', 'm.vec')} AS sim,
                 CAST(row_number() OVER (PARTITION BY p.id ORDER BY {similarity('p.vec', 'm.vec')} DESC, m.id) AS INTEGER) AS rank
          FROM ({PRODUCTS}) p, ({MASTERS}) m) t WHERE rank <= {TOP_K}""",
)
def knn_cross_topk(spark, sf):
    hits = knn.knn_join(products(spark, sf), masters(spark, sf), TOP_K)
    return hits.select(F.col("q_id").alias("id"), F.col("b_id").alias("master_id"), "sim", "rank")


@query(
    "knn_by_query_vector",
    f"""SELECT master_id, id, sim, rank FROM (
          SELECT m.id AS master_id, p.id, {similarity('m.vec', 'p.vec')} AS sim,
                 CAST(row_number() OVER (PARTITION BY m.id ORDER BY {similarity('m.vec', 'p.vec')} DESC, p.id) AS INTEGER) AS rank
          FROM ({MASTERS}) m, ({PRODUCTS}) p) t WHERE rank <= 10""",
)
def knn_by_query_vector(spark, sf):
    hits = knn.knn_join(masters(spark, sf), products(spark, sf), 10)
    return hits.select(F.col("q_id").alias("master_id"), F.col("b_id").alias("id"), "sim", "rank")


@query(
    "knn_overfetch_filter",
    f"""WITH sims AS (
          SELECT a.vec_id AS id, b.vec_id AS nn_id, b.label AS label, {similarity('a.embedding', 'b.embedding')} AS sim
          FROM embeddings a, embeddings b),
        fetched AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, nn_id) AS r FROM sims),
        kept AS (SELECT id, nn_id, sim, CAST(row_number() OVER (PARTITION BY id ORDER BY sim DESC, nn_id) AS INTEGER) AS rank
                 FROM fetched WHERE r <= 100 AND label < 3)
        SELECT id, nn_id, round(sim, 6) AS sim, rank FROM kept WHERE rank <= 10""",
)
def knn_overfetch_filter(spark, sf):
    items = _embeddings(spark, sf)
    hits = knn.knn_filtered(items, items, items.where("label < 3"), 100, 10)
    return hits.select(
        F.col("q_id").alias("id"), F.col("b_id").alias("nn_id"), F.round("sim", 6).alias("sim"), "rank"
    )


def held_against_exact(items, near, exact, recall=0.9):
    """Per item: whether ``recall`` of the exact hits are found over all items, and whether no hit is nearer than the exact one of its rank."""
    true = exact.select("q_id", "rank", F.col("b_id").alias("true_id"), F.col("sim").alias("true_sim"))
    held = true.join(near, ["q_id", "rank"], "left").groupBy(F.col("q_id").alias("id")).agg(
        F.min(F.coalesce(F.col("sim") <= F.col("true_sim") + 1e-9, F.lit(True))).alias("none_better")
    )
    found = near.join(exact.select("q_id", "b_id"), ["q_id", "b_id"], "left_semi").count() / max(1, exact.count())
    return items.select("id").join(held, "id", "left").select(
        "id", F.lit(found >= recall).alias("enough"), F.coalesce("none_better", F.lit(True)).alias("none_better")
    )


@query("knn_forest", "SELECT vec_id AS id, TRUE AS enough, TRUE AS none_better FROM embeddings")
def knn_forest(spark, sf):
    """Neighbours from a forest of projection trees held against the exact ones, as for ``saved_index_ivf``."""
    items = _embeddings(spark, sf)
    near = cut_lineage(knn.knn_join(items, items, TOP_K, strategy="forest"))
    return held_against_exact(items, near, knn.knn_join(items, items, TOP_K))


@query(
    "knn_ivf",
    """SELECT vec_id AS id, TRUE AS own_first, TRUE AS enough, TRUE AS none_better FROM embeddings""",
)
def knn_ivf(spark, sf):
    """Approximate neighbours held against the exact ones, per item: itself comes first, at least 0.9 of the
    other exact neighbours are there over the whole table, and no hit is nearer than the exact one of its rank."""
    items = _embeddings(spark, sf)
    exact = knn.knn_self(items, TOP_K).select("id", "rank", F.col("nn_id").alias("true_id"), F.col("dist").alias("true_dist"))
    near = knn.knn_self(items, TOP_K, strategy="ivf", tile_rows=128)
    held = exact.join(near, ["id", "rank"], "left")
    found = near.join(exact.select("id", F.col("true_id").alias("nn_id")), ["id", "nn_id"], "left_semi")
    others = exact.where("rank > 1").count()
    recall = found.where("id != nn_id").count() / others if others else 1.0  # two numbers for the whole table
    return held.groupBy("id").agg(
        F.min(F.when(F.col("rank") == 1, F.col("id") == F.col("nn_id")).otherwise(True)).alias("own_first"),
        F.lit(recall >= 0.9).alias("enough"),
        F.min(F.coalesce(F.col("dist") >= F.col("true_dist") - 1e-9, F.lit(True))).alias("none_better"),
    )


@query(
    "neighbour_names",
    f"""WITH {self_neighbours()}
        SELECT r.id, r.rank, r.nn_id, p.name AS nn_name, round(r.dist, 6) AS dist
        FROM ranked r LEFT JOIN prod p ON p.id = r.nn_id WHERE r.rank <= 10""",
)
def neighbour_names(spark, sf):
    return blocking.list_neighbours(products(spark, sf), 10).withColumn("dist", F.round("dist", 6))


BLOCKED = f"""
    near AS (SELECT DISTINCT least(id, nn_id) AS id1, greatest(id, nn_id) AS id2 FROM ranked
             WHERE rank <= {BLOCK_TOP_K} AND id <> nn_id AND dist < 2 - 2 * {BLOCK_THRESHOLD}),
    blocked AS MATERIALIZED (
      SELECT n.id1, n.id2 FROM near n JOIN prod a ON a.id = n.id1 JOIN prod b ON b.id = n.id2
      WHERE (a.volume = b.volume OR a.weight = b.weight) AND a.quantity = b.quantity
        AND (a.outlet_id IS NULL OR b.outlet_id IS NULL OR a.outlet_id <> b.outlet_id))"""


@query("block_pairs", f"WITH {self_neighbours()}, {BLOCKED} SELECT id1, id2 FROM blocked")
def block_pairs(spark, sf):
    return blocking.block_pairs(products(spark, sf), BLOCK_TOP_K, BLOCK_THRESHOLD)


@query(
    "block_pairs_sizes_only",
    f"""WITH {self_neighbours()},
        near AS (SELECT DISTINCT least(id, nn_id) AS id1, greatest(id, nn_id) AS id2 FROM ranked
                 WHERE rank <= 50 AND id <> nn_id AND dist < 2 - 2 * 0.3)
        SELECT n.id1, n.id2 FROM near n JOIN prod a ON a.id = n.id1 JOIN prod b ON b.id = n.id2
        WHERE (a.volume = b.volume OR a.weight = b.weight) AND a.quantity = b.quantity""",
)
def block_pairs_sizes_only(spark, sf):
    return blocking.block_pairs(products(spark, sf), 50, 0.3, different=())


@query(
    "dims_equal_pairs",
    f"""SELECT l_partkey AS id1, l_suppkey AS id2 FROM lineitem JOIN ({PRODUCTS}) a ON a.id = l_partkey
        JOIN ({PRODUCTS}) b ON b.id = l_suppkey
        WHERE (a.volume = b.volume OR a.weight = b.weight) AND a.quantity = b.quantity""",
)
def dims_equal_pairs(spark, sf):
    pairs = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id1"), F.col("l_suppkey").alias("id2"))
    return blocking.dims_equal_pairs(pairs, products(spark, sf).drop("vec"))


@query(
    "oneshot_block",
    f"""WITH sims AS (SELECT p.id AS id1, m.id AS id2, p.name AS sent1, m.name AS sent2,
                   p.product_category_id AS c1, m.product_category_id AS c2, {similarity('p.vec', 'm.vec')} AS sim
            FROM ({PRODUCTS}) p, ({MASTERS}) m),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY id1 ORDER BY sim DESC, id2) AS rank FROM sims)
        SELECT id1, id2, sent1, sent2 FROM ranked
        WHERE rank <= {BLOCK_TOP_K} AND sim > 0.2 AND c1 = c2 AND sent1 IS NOT NULL AND sent2 IS NOT NULL""",
)
def oneshot_block(spark, sf):
    return blocking.block_to_masters(products(spark, sf), masters(spark, sf), BLOCK_TOP_K, 0.2)


@query(
    "mean_pool",
    """SELECT label AS id, i - 1 AS dim, round(sum(x * mask) / greatest(sum(mask), 1e-9), 6) AS x FROM (
         SELECT label, CASE WHEN embedding[1] > -0.1 THEN 1 ELSE 0 END AS mask,
                unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) t
       GROUP BY 1, 2""",
)
def mean_pool(spark, sf):
    tokens = table(spark, sf, "embeddings").select(
        F.col("label").alias("id"), F.col("embedding").alias("vec"),
        F.when(F.col("embedding")[0] > -0.1, 1).otherwise(0).alias("mask"),
    )
    pooled = v.mean_pool(tokens).select("id", F.posexplode("vec").alias("dim", "x"))
    return pooled.select("id", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("x"))


@query(
    "cls_pool",
    """SELECT id, CAST(i - 1 AS BIGINT) AS dim, round(x, 6) AS x FROM (
         SELECT label AS id, unnest(v) AS x, generate_subscripts(v, 1) AS i
         FROM (SELECT label, CAST(min_by(embedding, vec_id) AS DOUBLE[]) AS v FROM embeddings GROUP BY label) s) t""",
)
def cls_pool(spark, sf):
    tokens = _embeddings(spark, sf).select(F.col("label").alias("id"), F.col("id").alias("pos"), "vec")
    pooled = v.first_token_pool(tokens).select("id", F.posexplode(v.as_double("vec")).alias("dim", "x"))
    return pooled.select("id", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("x"))


@query(
    "l2_normalize",
    """SELECT id, CAST(i - 1 AS BIGINT) AS dim, round(CASE WHEN n > 0 THEN x / n ELSE x END, 6) AS x FROM (
         SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS p, unnest(v) AS x, generate_subscripts(v, 1) AS i,
                sqrt(list_inner_product(v, v)) AS n
         FROM (SELECT *, [l_quantity, l_discount, l_tax, 0.0::DOUBLE] AS v FROM lineitem) s) t""",
)
def l2_normalize(spark, sf):
    lines = spread(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.array("l_quantity", "l_discount", "l_tax", F.lit(0.0)).alias("vec"),
    )
    unit = lines.select("id", F.posexplode(v.l2_normalize("vec")).alias("dim", "x"))
    return unit.select("id", F.col("dim").cast("bigint").alias("dim"), F.round("x", 6).alias("x"))


# Labelled vector pairs: every line, with the vectors that its part's and supplier's numbers come to.
VECTOR_PAIRS = """
    lines AS (SELECT *, (SELECT count(*) FROM embeddings) AS n_vectors FROM lineitem),
    pairs AS (SELECT CAST(a.embedding AS DOUBLE[]) AS v1, CAST(b.embedding AS DOUBLE[]) AS v2,
                     l_partkey AS id1, l_suppkey AS id2, l_orderkey, l_linenumber,
                     CASE WHEN a.label = b.label THEN 1 ELSE 0 END AS match
              FROM lines JOIN embeddings a ON a.vec_id = l_partkey % n_vectors
              JOIN embeddings b ON b.vec_id = l_suppkey % n_vectors)"""


def vector_pairs(spark, sf):
    """The lines with the products of their two vectors."""
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    side = table(spark, sf, "embeddings")
    n = side.agg(F.count("*").alias("n")).scalar()
    lines = lines.withColumns({"va": F.col("l_partkey") % n, "vb": F.col("l_suppkey") % n})
    vectors = side.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
    return pair_products(lines, vectors).withColumn("match", (F.col("label1") == F.col("label2")).cast("int"))


@query(
    "pair_distances",
    f"""WITH {VECTOR_PAIRS}, m AS (SELECT *, list_inner_product(v1, v2) AS ip, list_cosine_similarity(v1, v2) AS c,
              list_distance(v1, v2) AS e FROM pairs)
        SELECT l_orderkey, l_linenumber, id1, id2, round(ip, 6) AS inner_product, round(c, 6) AS cosine,
               round(sqrt(greatest(e * e, 1e-7)), 3) AS euclidean,
               round(-c / len(v1), 6) AS mean_product, round(sqrt(greatest(0.0, 2 - 2 * round(c, 9))), 6) AS angular FROM m""",
)
def pair_distances(spark, sf):
    cosine = cosine_of_products()
    return vector_pairs(spark, sf).select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("id1"), F.col("l_suppkey").alias("id2"),
        F.round("dot", 6).alias("inner_product"),
        F.round(cosine, 6).alias("cosine"),
        F.round(euclidean_of_products(), 3).alias("euclidean"),
        F.round(-cosine / F.col("size1"), 6).alias("mean_product"),
        F.round(v.angular_from_cosine(F.round(cosine, 9)), 6).alias("angular"),
    )


@query(
    "pair_losses",
    f"""WITH {VECTOR_PAIRS}, m AS (SELECT match, list_cosine_similarity(v1, v2) AS c,
              sqrt(greatest(list_distance(v1, v2) * list_distance(v1, v2), 1e-7)) AS d FROM pairs)
        SELECT round(avg(match * d * d + (1 - match) * greatest(1 - d, 0) * greatest(1 - d, 0)), 6) AS contrastive_loss,
               round(avg((c - match) * (c - match)), 6) AS cosine_loss FROM m""",
)
def pair_losses(spark, sf):
    pairs = vector_pairs(spark, sf)
    losses = v.mean_losses(pairs.select(F.col("match").cast("double").alias("y"), euclidean_of_products().alias("d"), cosine_of_products().alias("c")))
    return losses.select(*[F.round(c, 6).alias(c) for c in losses.columns])


# Words of a text as both engines cut them, and the term weights over a table's texts.
TFIDF = r"""
    words AS (SELECT {id} AS id, unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')) AS term FROM {table} s),
    tf AS (SELECT id, term, count(*) AS tf FROM words GROUP BY ALL),
    idf AS (SELECT term, ln(((SELECT count({text}) FROM {table}) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY term),
    weighed AS (SELECT id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
    terms AS (SELECT id, term, w, sqrt(sum(w * w) OVER (PARTITION BY id)) AS len FROM weighed)"""


@query(
    "encode_tfidf",
    f"""WITH {TFIDF.format(id='doc_id', text='text', table='documents')}
        SELECT id AS doc_id, term, round(CASE WHEN len > 0 THEN w / len ELSE 0 END, 6) AS weight FROM terms""",
)
def encode_tfidf(spark, sf):
    docs = spread(spark, sf, "documents").select("doc_id", "text")
    terms = fit_tfidf(docs, "text", id="doc_id").terms(docs)
    return terms.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query(
    "encode_tfidf_vectors",
    """SELECT p_partkey AS id, 256 AS dims, 1.0e0 AS length FROM part WHERE p_name IS NOT NULL""",
)
def encode_tfidf_vectors(spark, sf):
    """The dense form: width and length of every vector."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    coded = fit_tfidf(part, "name").transform(part)
    length = F.sqrt(F.aggregate(v.as_double("vec"), F.lit(0.0), lambda a, x: a + x * x))
    return coded.select("id", F.size("vec").alias("dims"), F.round(length, 4).alias("length"))


@query(
    "encode_word2vec",
    r"""SELECT doc_id, 16 AS dims, CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0e0 ELSE 0.0e0 END AS length
        FROM documents WHERE text IS NOT NULL""",
)
def encode_word2vec(spark, sf):
    """Width and length of every document's vector; the learned values have no counterpart in SQL."""
    docs = spread(spark, sf, "documents").select("doc_id", "text")
    coded = fit_word2vec(docs, "text", dims=16, hashed=True).transform(docs)
    length = F.sqrt(F.aggregate(v.as_double("vec"), F.lit(0.0), lambda a, x: a + x * x))
    return coded.where("text IS NOT NULL").select("doc_id", F.size("vec").alias("dims"), F.round(length, 4).alias("length"))
