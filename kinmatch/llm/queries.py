"""Registered queries of the corpus operators, with SQL counterparts where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import spread, table
from .decontam import find_contamination
from .htmlmain import extract_main_text
from .langid import learn_languages, with_language
from .lexicon import with_tokens
from .licences import with_licences
from .maxscore import scaled, search_top_k
from .packing import pack
from .ppm import score_texts
from .repair import damaged, repair_conversations
from .simhash import near_duplicates
from .sketches import search_ranked
from .tokenfiles import read_tokens, write_tokens
from .toxicity import learn_toxicity, with_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def hash_is(id: str, mod: int, value: int):
    """Whether crc32 of the id as text leaves ``value``; a NULL id leaves nothing."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % mod == value, F.lit(False))


@query("op1_language")
def op1_language(spark, folder):
    docs = spread(spark, folder, "documents").select("doc_id", "text", "lang")
    network = learn_languages(docs, where=~hash_is("doc_id", 4, 2) & F.col("doc_id").isNotNull())
    found = with_language(docs.select("doc_id", "text"), network)
    return found.select("doc_id", hash_is("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query("op2_token_files")
def op2_token_files(spark, folder):
    target = scratch_path(spark, "tokens")
    write_tokens(spread(spark, folder, "documents"), target, tokenizer_path("word_bpe_49k.json"))
    return read_tokens(spark, target).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query(
    "op3_decontamination",
    f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_ITEM_WORDS}') AS w FROM documents
    ), b AS (
      SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWERED}, '{_ITEM_WORDS}') AS w
      FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
    ), windows AS (
      SELECT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
      FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
    ), sizes AS (SELECT DISTINCT k FROM windows),
    places AS (
      SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS words
      FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)
    ), found AS (
      SELECT r, p.i, p.k, item FROM places p JOIN windows USING (k, words)
    ), hits AS (
      SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM found) GROUP BY r
    ), items AS (
      SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
    """,
)
def op3_decontamination(spark, folder):
    found = find_contamination(spread(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query("op4_simhash")
def op4_simhash(spark, folder):
    return near_duplicates(spread(spark, folder, "documents"))


@query("op5_html")
def op5_html(spark, folder):
    pages = spread(spark, folder, "pages").select("page_id", "url", "html")
    found = extract_main_text(pages)
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def packed_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of these."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op6_packing")
def op6_packing(spark, folder):
    return packed_digest(pack(spread(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json")))


@query("op7_ppm")
def op7_ppm(spark, folder):
    docs = spread(spark, folder, "documents").select("doc_id", "text")
    found = score_texts(docs, ~hash_is("doc_id", 7, 2) & F.col("doc_id").isNotNull())
    return found.select(
        "doc_id", hash_is("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query(
    "op8_top_k",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    ), r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op8_top_k(spark, folder):
    vectors = spread(spark, folder, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return search_top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query("op9_licences")
def op9_licences(spark, folder):
    found = with_licences(spread(spark, folder, "documents").select("doc_id", "text"))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["licence"]))), ",")
    return found.select(
        "doc_id", names.alias("licence_names"), F.size("licences").cast("bigint").alias("n_licences"),
        F.size("sentences").cast("bigint").alias("n_sentences"), "licences",
    )


# Documents whose last probability reaches this count as toxic, if that category was learned.
TOXIC = 0.5


def is_toxic(chain):
    """Whether ``p_toxic`` calls a document toxic; a chain that has not learned the category calls none so."""
    return F.col("p_toxic") >= TOXIC if chain[-1].learned else F.lit(False)


def toxicity_chain(docs, labels):
    """Low quality, then toxic, over the columns of ``labels``."""
    return learn_toxicity(docs, labels, [1 - F.col("quality"), F.col("toxic")])


@query("op10_toxicity")
def op10_toxicity(spark, folder):
    docs = spread(spark, folder, "documents").select("doc_id", "text")
    chain = toxicity_chain(docs, table(spark, folder, "labels"))
    found = with_toxicity(docs, chain, ["p_low_quality", "p_toxic"])
    return found.select("doc_id", "p_low_quality", "p_toxic", is_toxic(chain).alias("toxic"))


@query("op11_lexicon")
def op11_lexicon(spark, folder):
    docs = spread(spark, folder, "documents").select("doc_id", "text")
    found = with_tokens(docs, tokenizer_path("word_bpe_49k.json"), decoded="decoded")
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op12_ranked",
    f"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_ITEM_WORDS}') AS t FROM documents
    ), s AS (
      SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d WHERE len(t) > 0
    ), tf AS (
      SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(t) AS t FROM d) GROUP BY r, t
    ), weights AS (
      SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, s GROUP BY t, docs
    ), asked AS (
      SELECT q, item_id, unnest(list_distinct(t)) AS t FROM (
        SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_LOWERED}, '{_ITEM_WORDS}') AS t FROM benchmark
      )
    ), scored AS (
      SELECT q, item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.t) * docs) // terms)))) AS BIGINT) AS score
      FROM asked JOIN weights USING (t) JOIN tf USING (t) JOIN d USING (r), s GROUP BY q, item_id, doc_id, r
    ), ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
)
def op12_ranked(spark, folder):
    return search_ranked(spread(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_repair")
def op13_repair(spark, folder):
    rows, there = damaged(spread(spark, folder, "conversations"))
    return repair_conversations(rows, there=there)
