"""Whole jobs over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pairs, rows
from ..operators.encode import TableEncoder
from ..operators.metrics import classification_report
from ..operators.scoring import (
    ClassifierScorer,
    ColumnScorer,
    add_product_features,
    add_text_features,
    edit_ratio,
    train_classifier,
)
from ..plans import jobs
from ..plans.products import product_regex
from ..session import cut_lineage, scratch_path
from ..streaming import arrivals, monitor
from ..operators.state import read_runs, write_run
from ..sources import files
from .base import (
    CLUSTERS,
    MASTERS,
    PRODUCTS,
    braced,
    clusters,
    masters,
    portable_draw,
    products,
    query,
    similarity,
    table,
    upto,
    views,
)
from .clustering import COMPONENTS, MAX_DISTANCE, TOP_K
from .evaluation import rounded_sweep, sweep
from .state import NOW
from .text import SIZED, _sent, _sizes
from .training import NEGATIVES, POSITIVES
from .vectors import BLOCK_THRESHOLD, BLOCK_TOP_K, BLOCKED, EMBEDDED, _embeddings, self_neighbours

MATCH_THRESHOLD = 0.8


@query(
    "similar_item_clusters",
    f"""WITH RECURSIVE {self_neighbours(EMBEDDED)}, {COMPONENTS},
        big AS (SELECT *, count(*) OVER (PARTITION BY component) AS n FROM comp)
        SELECT id, dense_rank() OVER (ORDER BY component) - 1 AS cluster FROM big WHERE n >= 3""",
)
def similar_item_clusters(spark, sf):
    return jobs.cluster_similar(_embeddings(spark, sf), TOP_K, MAX_DISTANCE, 3)


def _offers(spark, sf):
    """Parts as offers with a pack size in their text."""
    sized = views(spark, sf, braced(SIZED, "part"), "part")
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"),
        F.when(F.col("p_type") != "LARGE", F.substring("p_brand", 7, 9).cast("bigint")).alias("outlet_id"),
        F.length("p_type").cast("bigint").alias("product_category_id"),
        F.concat_ws(" ", "p_brand", "p_name").alias("master_product"),
    )
    return sized.join(part, "id")


def _vectors(spark, sf):
    return TableEncoder(products(spark, sf).select("id", "vec"))


OFFERS = f"""
SELECT z.*, p.price, p.vec, p.outlet_id FROM ({_sizes(False, False)}) z JOIN ({PRODUCTS}) p ON p.id = z.id
"""
JOB_MATCHES = f"""
    {self_neighbours(OFFERS)}, {BLOCKED},
    texts AS (SELECT id, {_sent('name', 'price')} AS sent FROM prod),
    scored AS (SELECT b.id1, b.id2, 1 - levenshtein(s.sent, t.sent) / greatest(length(s.sent), length(t.sent)) AS prob
               FROM blocked b JOIN texts s ON s.id = b.id1 JOIN texts t ON t.id = b.id2)"""


def _scorer():
    return ColumnScorer(F.round(edit_ratio("sent1", "sent2"), 9))


@query(
    "match_job_pairs",
    f"""WITH {JOB_MATCHES} SELECT id1, id2, CAST(round(prob, 9) > {MATCH_THRESHOLD} AS INTEGER) AS match,
               round(prob, 9) AS prob FROM scored""",
)
def match_job_pairs(spark, sf):
    result = jobs.match_products(
        _offers(spark, sf), _vectors(spark, sf), _scorer(), top_k=BLOCK_TOP_K, threshold=BLOCK_THRESHOLD,
        match_threshold=MATCH_THRESHOLD,
    )
    return result.matches


@query(
    "match_job_cached",
    f"""WITH {JOB_MATCHES} SELECT id1, id2, CAST(round(prob, 9) > {MATCH_THRESHOLD} AS INTEGER) AS match,
               CASE WHEN id1 % 2 = 0 THEN 2.0 ELSE round(prob, 9) END AS prob FROM scored""",
)
def match_job_cached(spark, sf):
    """The match job with the pairs of even offers in the score cache, marked there by a score of 2."""
    kept = match_job_pairs(spark, sf).where("id1 % 2 = 0").withColumn("prob", F.lit(2.0))
    result = jobs.match_products(
        _offers(spark, sf), _vectors(spark, sf), _scorer(), top_k=BLOCK_TOP_K, threshold=BLOCK_THRESHOLD,
        match_threshold=MATCH_THRESHOLD, cached=kept,
    )
    return result.matches


@query(
    "match_job",
    f"""WITH RECURSIVE {JOB_MATCHES},
        hits AS (SELECT id1, id2 FROM scored WHERE round(prob, 9) > {MATCH_THRESHOLD}),
        both_ways AS MATERIALIZED (SELECT id1 AS a, id2 AS b FROM hits UNION SELECT id2, id1 FROM hits),
        reach(id, label) AS (SELECT a, a FROM both_ways
                             UNION SELECT w.b, r.label FROM reach r JOIN both_ways w ON w.a = r.id),
        comp AS (SELECT id, min(label) AS component FROM reach GROUP BY id),
        big AS (SELECT *, count(*) OVER (PARTITION BY component) AS n FROM comp)
        SELECT id, dense_rank() OVER (ORDER BY component) - 1 AS cluster FROM big WHERE n >= 3""",
)
def match_job(spark, sf):
    result = jobs.match_products(
        _offers(spark, sf), _vectors(spark, sf), _scorer(), top_k=BLOCK_TOP_K, threshold=BLOCK_THRESHOLD,
        match_threshold=MATCH_THRESHOLD,
    )
    return result.clusters


@query(
    "one_shot_job",
    f"""WITH sims AS (SELECT p.id AS id1, m.id AS id2, p.name AS sent1, m.name AS sent2,
                   length(t.p_type) AS c1, m.product_category_id AS c2, {similarity('p.vec', 'm.vec')} AS sim
            FROM ({OFFERS}) p JOIN part t ON t.p_partkey = p.id, ({MASTERS}) m),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY id1 ORDER BY sim DESC, id2) AS rank FROM sims),
        kept AS (SELECT id1, id2, round(1 - levenshtein(sent1, sent2) / greatest(length(sent1), length(sent2)), 9) AS prob
                 FROM ranked WHERE rank <= 100 AND sim > 0.2 AND c1 = c2)
        SELECT id1, id2, CAST(prob > 0.1 AS INTEGER) AS match, prob FROM kept""",
)
def one_shot_job(spark, sf):
    return jobs.match_to_masters(
        _offers(spark, sf), masters(spark, sf), _PresentVectors(products(spark, sf).select("id", "vec")), _scorer(),
        threshold=0.2, match_threshold=0.1,
    )


class _PresentVectors(TableEncoder):
    """Vectors that are there already stay; others are looked up."""

    def transform(self, df):
        return df if "vec" in df.columns else super().transform(df)


def _labelled(spark, sf):
    return products(spark, sf).where(F.col("master_product").isNotNull())


LABELLED = f"SELECT * FROM ({PRODUCTS}) l WHERE master_product IS NOT NULL"
CHOSEN = f"""{self_neighbours(LABELLED)}, {NEGATIVES}, {POSITIVES},
    chosen AS MATERIALIZED (SELECT DISTINCT least(id1, id2) AS id1, greatest(id1, id2) AS id2, 0 AS match FROM negatives
                            UNION ALL SELECT id1, id2, 1 FROM positives)"""
# Sizes of a report over some pairs: fitted values have no counterpart in SQL, the rows they are fitted to have.
SUPPORTS = """
    SELECT CAST(match AS VARCHAR) AS label, count(*) AS support FROM {rows} GROUP BY match
    UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM {rows})"""
IN_RANGE = "TRUE AS in_range"


def _supports(report):
    """Each line's support, and whether its rates lie between 0 and 1."""
    sound = F.lit(True)
    for c in ("precision", "recall", "f1"):
        sound = sound & F.coalesce(F.col(c).between(0, 1), F.lit(True))
    return report.select("label", "support", sound.alias("in_range"))


def _report_sql(with_items: str, rows: str) -> str:
    return f"WITH {with_items} SELECT label, support, {IN_RANGE} FROM ({SUPPORTS.format(rows=rows)}) t"


HELD_OUT = f"""{CHOSEN},
    held_out AS (SELECT * FROM chosen WHERE {portable_draw("id1 || '-' || id2")} >= {upto(0.8)})"""


@query("train_matcher_report", _report_sql(HELD_OUT, "held_out"))
def train_matcher_report(spark, sf):
    """Matcher training job: pairs, texts, split, fit, and the report on the held-out part."""
    labelled = _labelled(spark, sf)
    encoder = _PresentVectors(labelled.select("id", "vec"))
    return _supports(jobs.train_matcher(labelled, encoder).report)


ONE_SHOT_HELD_OUT = f"""{self_neighbours(LABELLED)},
    chosen AS (SELECT p.name AS sent1, o.master_product AS sent2, 0 AS match
               FROM ranked r JOIN prod p ON p.id = r.id JOIN prod o ON o.id = r.nn_id
               WHERE r.rank <= 5 AND p.name IS NOT NULL AND o.master_product <> p.master_product
               UNION ALL SELECT name, master_product, 1 FROM prod WHERE name IS NOT NULL),
    held_out AS MATERIALIZED (SELECT * FROM chosen
                              WHERE {portable_draw("sent1 || '|' || sent2 || '|' || match")} >= {upto(0.8)})"""


@query("train_one_shot_report", _report_sql(ONE_SHOT_HELD_OUT, "held_out"))
def train_one_shot_report(spark, sf):
    labelled = _labelled(spark, sf)
    return _supports(jobs.train_one_shot(labelled, _PresentVectors(labelled.select("id", "vec"))).report)


@query(
    "train_reload_score",
    f"""WITH {HELD_OUT} SELECT id1, id2, match, TRUE AS same_prob FROM held_out""",
)
def train_reload_score(spark, sf):
    """Held-out pairs scored by a trained matcher and by the same one saved and loaded again."""
    labelled = _labelled(spark, sf)
    result = jobs.train_matcher(labelled, _PresentVectors(labelled.select("id", "vec")))
    path = scratch_path(spark, "matcher")
    result.scorer.save(path)
    again = ClassifierScorer.load(path)
    scored = again.score(result.scorer.score(result.test).withColumnRenamed("prob", "first"))
    return scored.select("id1", "id2", "match", (F.col("prob") == F.col("first")).alias("same_prob"))


@query(
    "preprocess_labelled",
    f"""WITH m AS ({MASTERS})
        SELECT p.id, p.name, m.id AS master_product_id, m.name AS master_product FROM ({PRODUCTS}) p
        JOIN m ON m.name = p.master_product WHERE p.name IS NOT NULL AND p.description IS NOT NULL""",
)
def preprocess_labelled(spark, sf):
    """Raw offers and masters through the cleaning that the training jobs start with."""
    offers, known = products(spark, sf), masters(spark, sf)
    ids = known.select(F.col("id").alias("master_product_id"), F.col("name").alias("master_product"))
    raw = offers.join(ids, "master_product", "left").drop("master_product")
    uom = known.withColumns({"weight": F.lit(None).cast("double"), "volume": F.lit(None).cast("double"),
                             "quantity": F.lit(None).cast("double"), "uom": F.lit(None).cast("string")})
    ready = jobs.labelled_products(raw, uom, None)
    return ready.select("id", "name", "master_product_id", "master_product")


@query(
    "blocker_evaluation",
    f"""WITH {CHOSEN},
        scored AS (SELECT {similarity('a.vec', 'b.vec')} AS score, c.match
                   FROM chosen c JOIN prod a ON a.id = c.id1 JOIN prod b ON b.id = c.id2),
        {sweep('scored')}""",
)
def blocker_evaluation(spark, sf):
    """Best thresholds of the present vectors on the blocker's own training pairs."""
    labelled = _labelled(spark, sf)
    return rounded_sweep(jobs.train_blocker_set(labelled, _PresentVectors(labelled.select("id", "vec")))[1])


@query("pair_classifier_score", _report_sql(CHOSEN, "chosen"))
def pair_classifier_score(spark, sf):
    """A classifier over text, vector, price and size features, fitted and applied to all pairs."""
    labelled = _labelled(spark, sf)
    chosen = cut_lineage(pairs.training_pairs(labelled))
    named = rows.lookup_both(add_product_features(chosen, labelled), labelled, ["name"])
    featured = cut_lineage(add_text_features(named, "name1", "name2").drop("name1", "name2"))
    features = ("token_jaccard", "edit_ratio", "vector_cosine", "price_ratio", "same_quantity", "same_size")
    scorer = train_classifier(featured, features)
    scored = scorer.score(featured)
    return _supports(classification_report(scored.withColumn("pred", (F.col("prob") > 0.5).cast("int"))))


@query(
    "one_shot_assign",
    f"""WITH base AS ({PRODUCTS}),
        firsts AS (SELECT master_product, min(id) AS f FROM base WHERE master_product IS NOT NULL GROUP BY 1),
        ids AS (SELECT master_product, dense_rank() OVER (ORDER BY f) - 1 AS master_product_id FROM firsts),
        prod AS MATERIALIZED (SELECT b.*, i.master_product_id FROM base b
                              LEFT JOIN ids i ON i.master_product = b.master_product),
        sims AS (SELECT a.id, b.id AS nn, a.name AS sent1, b.master_product AS sent2, b.master_product_id AS id2,
                   {similarity('a.vec', 'b.vec')} AS sim FROM prod a, prod b),
        fetched AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, nn) AS r FROM sims),
        kept AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, nn) AS k FROM fetched
                 WHERE r <= 100 AND sent2 IS NOT NULL),
        scored AS (SELECT id, id2, round(1 - levenshtein(sent1, sent2) / greatest(length(sent1), length(sent2)), 9) AS prob
                   FROM kept WHERE k <= 10 AND sent1 IS NOT NULL),
        best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY prob DESC, id2) AS b FROM scored WHERE prob > 0.1)
        SELECT t.id AS product_id, t.id2 AS master_product_pred_id, t.prob, ids.master_product AS master_product_pred,
               p.master_product_id AS master_product_actual_id, p.master_product AS master_product_actual,
               p.name, CAST(trunc(p.price) AS BIGINT) AS price
        FROM best t JOIN ids ON ids.master_product_id = t.id2 JOIN prod p ON p.id = t.id WHERE t.b = 1""",
)
def one_shot_assign(spark, sf):
    """Each offer's best accepted master among its near labelled offers."""
    offers = rows.dense_ids(products(spark, sf), "master_product", "id", "master_product_id")
    return jobs.assign_masters(offers, _scorer(), threshold=0.1)[0]


@query(
    "sized_offers",
    f"""SELECT z.id, z.name, z.description, z.quantity, z.volume, z.weight, p.p_retailprice AS price
        FROM ({_sizes(False, False)}) z JOIN part p ON p.p_partkey = z.id""",
)
def sized_offers(spark, sf):
    offers = product_regex(_offers(spark, sf))
    return offers.select("id", "name", "description", "quantity", "volume", "weight", "price")


@query(
    "match_files",
    f"""WITH RECURSIVE {JOB_MATCHES},
        hits AS (SELECT id1, id2 FROM scored WHERE round(prob, 9) > {MATCH_THRESHOLD}),
        both_ways AS MATERIALIZED (SELECT id1 AS a, id2 AS b FROM hits UNION SELECT id2, id1 FROM hits),
        reach(id, label) AS (SELECT a, a FROM both_ways
                             UNION SELECT w.b, r.label FROM reach r JOIN both_ways w ON w.a = r.id),
        comp AS (SELECT id, min(label) AS component FROM reach GROUP BY id)
        SELECT p.id, p.name, dense_rank() OVER (ORDER BY coalesce(k.component, p.id)) - 1 AS fin
        FROM prod p LEFT JOIN comp k ON k.id = p.id""",
)
def match_files(spark, sf):
    """Offers written as CSV, matched by the file-based run, and its output read back."""
    path = scratch_path(spark, "files")
    offers = _offers(spark, sf)
    files.write_csv(offers, f"{path}/in")
    jobs.match_files(
        spark, f"{path}/in", f"{path}/out", _vectors(spark, sf), _scorer(), offers.schema, top_k=BLOCK_TOP_K,
        threshold=BLOCK_THRESHOLD, match_threshold=MATCH_THRESHOLD,
    )
    return files.read_csv(spark, f"{path}/out").select(
        F.col("id").cast("bigint").alias("id"), "name", F.col("fin").cast("bigint").alias("fin")
    )


@query(
    "training_files",
    f"""WITH {CHOSEN}, lines AS (
          SELECT {_sent('a.name', 'a.price')} || chr(9) || {_sent('b.name', 'b.price')} || chr(9) || CAST(match AS VARCHAR) AS value,
                 {portable_draw("c.id1 || '-' || c.id2")} AS draw
          FROM chosen c JOIN prod a ON a.id = c.id1 JOIN prod b ON b.id = c.id2)
        SELECT value, CASE WHEN draw < {upto(0.8)} THEN 'train' WHEN draw < {upto(0.9)} THEN 'val' ELSE 'test' END AS set
        FROM lines""",
)
def training_files(spark, sf):
    """Labelled offers written as CSV, the training files made of them, read back."""
    path = scratch_path(spark, "training")
    labelled = _labelled(spark, sf)
    plain = labelled.drop("vec")
    files.write_csv(plain, f"{path}/in")
    encoder = TableEncoder(labelled.select("id", "vec"))
    jobs.training_files(spark, f"{path}/in", f"{path}/out", encoder, plain.schema)
    return spark.read.text(f"{path}/out").select("value", "set")


@query(
    "stream_new_products",
    f"""WITH sims AS (SELECT p.id AS id1, m.id AS id2, p.name AS sent1, m.name AS sent2,
                   p.product_category_id AS c1, m.product_category_id AS c2, {similarity('p.vec', 'm.vec')} AS sim
            FROM ({PRODUCTS}) p, ({MASTERS}) m),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY id1 ORDER BY sim DESC, id2) AS rank FROM sims),
        kept AS (SELECT id1, id2, round(1 - levenshtein(sent1, sent2) / greatest(length(sent1), length(sent2)), 9) AS prob
                 FROM ranked WHERE rank <= 20 AND sim > 0.2 AND c1 = c2)
        SELECT (SELECT max(id) FROM ({CLUSTERS}) c) + row_number() OVER (ORDER BY id1, id2) AS id,
               id1 AS internal_product_id, id2 AS master_product_id, 5 AS master_product_status_id, {NOW} AS created_at
        FROM kept WHERE prob > 0.1""",
)
def stream_new_products(spark, sf):
    """Offers arriving as files, matched against the masters; what the sink adds to the cluster table."""
    path = scratch_path(spark, "monitor")
    offers = products(spark, sf).select("id", "name", "description", "product_category_id")
    offers.write.parquet(f"{path}/in")
    write_run(clusters(spark, sf), f"{path}/master_product_clusters", "start")
    stream = monitor.new_products(spark, f"{path}/in", offers.schema)
    sink = monitor.suggestion_sink(
        spark, path, cut_lineage(masters(spark, sf)), _vectors(spark, sf), _scorer(), "stream", F.expr(NOW),
        top_k=20, threshold=0.2, match_threshold=0.1,
    )
    monitor.start_monitor(stream, f"{path}/progress", sink).awaitTermination()
    added = read_runs(spark, f"{path}/master_product_clusters").where("run != 'start'")
    return added.select("id", "internal_product_id", "master_product_id", "master_product_status_id", "created_at")


WAIT_MS = 3 * 86_400_000


@query(
    "stream_settled",
    f"""WITH e AS (SELECT user_id, event_id, ts, value, epoch_ms(ts) AS ms, epoch_ms(ts) + (event_id % 7) * 86400000 AS arrived FROM events),
       cut AS (SELECT (min(arrived) + max(arrived)) // 2 AS t FROM e),
       d1 AS (SELECT e.* FROM e, cut WHERE arrived <= t), d2 AS (SELECT e.* FROM e, cut WHERE arrived > t),
       w1 AS (SELECT max(arrived) AS w FROM d1), w2 AS (SELECT max(arrived) AS w FROM d2),
       newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) AS r FROM d1) WHERE r = 1),
       open AS (SELECT user_id, event_id, ts, value, ms FROM newest, w1 WHERE ms + {WAIT_MS} > w
                UNION ALL SELECT user_id, event_id, ts, value, ms FROM d2, w1 WHERE ms + {WAIT_MS} > w),
       newest2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) AS r FROM open) WHERE r = 1)
       SELECT user_id, event_id, ts, value, 'settled' AS kind FROM newest, w1 WHERE ms + {WAIT_MS} <= w
       UNION ALL SELECT user_id, event_id, ts, value, 'late' FROM d2, w1 WHERE ms + {WAIT_MS} <= w
       UNION ALL SELECT user_id, event_id, ts, value, 'settled' FROM newest2, w2 WHERE ms + {WAIT_MS} <= w""",
)
def stream_settled(spark, sf):
    """Events as versions of their user's row, up to six days late, in two deliveries: what settles and what is late."""
    events = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    arrived = F.timestamp_millis(F.unix_millis("ts") + (F.col("event_id") % 7) * 86_400_000)
    rows, root = events.withColumn("arrived", arrived), scratch_path(spark, "arrivals")
    ends = rows.agg(F.min(F.unix_millis("arrived")).alias("a"), F.max(F.unix_millis("arrived")).alias("b")).first()
    middle = F.unix_millis("arrived") <= (ends["a"] + ends["b"]) // 2
    for k, delivery in enumerate((rows.where(middle), rows.where(~middle))):
        delivery.coalesce(1).write.parquet(f"{root}/in/delivery={k}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in/*")
        settled = arrivals.settle_products(stream, "user_id", "ts", "arrived", "3 days")
        writer = settled.writeStream.foreachBatch(arrivals.arrival_sink(root)).option("checkpointLocation", f"{root}/progress")
        with arrivals.timers(spark):
            writer.trigger(availableNow=True).start().awaitTermination()
    out = [spark.read.parquet(f"{root}/{name}/*").withColumn("kind", F.lit(kind)) for name, kind in (("products", "settled"), ("late", "late"))]
    return out[0].unionByName(out[1]).select("user_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", "kind")
