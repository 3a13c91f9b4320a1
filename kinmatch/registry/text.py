"""Clean-up, extraction, serialization and numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric, text
from ..operators import rows, sampling
from ..operators import serialize as ser
from ..plans import products as prep
from .base import PRODUCTS, braced, portable_draw, products, query, spread, table, upto, views

# Parts whose description carries a pack size in the forms the extraction knows.
SIZED = """
SELECT p_partkey AS id, upper(p_name) AS name,
       CASE WHEN p_type = 'PROMO' THEN 'isi ' || CAST(p_size AS STRING) || ' pcs hemat'
            WHEN p_type = 'ECONOMY' THEN CAST(p_size AS STRING) || '0ML botol'
            WHEN p_type = 'SMALL' THEN CAST(p_size AS STRING) || ' liter kemasan'
            WHEN p_type = 'STANDARD' THEN CAST(p_size AS STRING) || ' kg karung'
            WHEN p_type = 'LARGE' THEN CAST(p_size AS STRING) || '0 gram x' || CAST(p_size AS STRING) || ' pack'
            ELSE '1 karton ' || p_brand END AS description
FROM part t
"""


def _first(pattern: str) -> str:
    return f"nullif(regexp_extract(t, '({pattern})', 1), '')"


def _digits(match: str) -> str:
    return f"CAST(regexp_extract({match}, '\\d+') AS BIGINT)"


def _sizes(litre: bool, strict: bool) -> str:
    kg = text.KILOGRAM_STRICT_PATTERN if strict else text.KILOGRAM_PATTERN
    litres = f"{_digits(_first(text.LITRE_PATTERN))} * 1000" if litre else "NULL"
    return f"""SELECT id, name, description,
        CASE WHEN {_first(text.QUANTITY_PATTERN)} IS NOT NULL THEN {_digits(_first(text.QUANTITY_PATTERN))}
             WHEN {_first(text.CARTON_PATTERN)} IS NOT NULL THEN 12 ELSE 1 END AS quantity,
        CASE WHEN {_first(text.MILLILITRE_PATTERN)} IS NOT NULL
             THEN {_digits(_first(text.MILLILITRE_PATTERN))} ELSE {litres} END AS volume,
        CASE WHEN {_first(text.GRAM_PATTERN)} IS NOT NULL THEN {_digits(_first(text.GRAM_PATTERN))}
             ELSE {_digits(_first(kg))} * 1000 END AS weight
        FROM (SELECT *, lower(name || ' ' || description) AS t FROM ({SIZED}) s) u"""


def _sized(spark, sf):
    return views(spark, sf, braced(SIZED, "part"), "part")


@query("regex_sizes", _sizes(False, False))
def regex_sizes(spark, sf):
    return prep.product_regex(_sized(spark, sf))


@query("regex_sizes_fixed", _sizes(True, True))
def regex_sizes_fixed(spark, sf):
    return prep.product_regex(_sized(spark, sf), litre_fix=True, strict_kg=True)


# The same pack-size patterns over whole document texts.
@query(
    "regex_sizes_documents",
    _sizes(False, False).replace(f"({SIZED})", "(SELECT doc_id AS id, source AS name, text AS description FROM documents)")
    .replace("SELECT id, name, description,", "SELECT id,"),
)
def regex_sizes_documents(spark, sf):
    docs = spread(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("name"), F.col("text").alias("description")
    )
    return prep.product_regex(docs).drop("name", "description")


@query(
    "preprocess_dedupe",
    """SELECT id, name, description, price FROM (
         SELECT l_orderkey AS id, l_returnflag AS name, p_name AS description, l_extendedprice AS price,
                row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey, l_suppkey) rn
         FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_type <> 'PROMO') t
       WHERE rn = 1 AND id IS NOT NULL AND name IS NOT NULL AND description IS NOT NULL""",
)
def preprocess_dedupe(spark, sf):
    part = table(spark, sf, "part").where("p_type <> 'PROMO'")
    offers = table(spark, sf, "lineitem").join(part, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("name"), F.col("p_name").alias("description"),
        F.col("l_extendedprice").alias("price"),
        F.struct("l_extendedprice", "l_partkey", "l_suppkey").alias("seq"),
    )
    clean, _ = prep.preprocess(offers, order="seq")
    return clean.drop("seq")


MASTER_UNITS = """
SELECT p_partkey AS id, CAST(floor(p_size / 10.0) AS BIGINT) AS quantity,
       CASE WHEN p_type = 'SMALL' THEN 0.0 WHEN p_type = 'PROMO' THEN NULL ELSE p_retailprice END AS volume,
       CAST(length(p_name) AS DOUBLE) AS weight,
       CASE WHEN p_type = 'SMALL' THEN 'g' ELSE 'ml' END AS uom,
       p_name || ' ' || CAST(CAST(floor(p_size / 10.0) AS BIGINT) AS STRING) || ' x ' ||
       CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING) || ' ml' AS name,
       p_type = 'MEDIUM' AS is_deleted
FROM part t
"""


@query(
    "display_unit_base",
    f"""SELECT id, name, display_unit, replace(name, display_unit, '') AS base FROM (
          SELECT *, CASE WHEN coalesce(quantity, 0) <> 0 THEN ' ' || CAST(quantity AS VARCHAR) || ' x' ELSE '' END ||
            CASE WHEN coalesce(volume, 0) <> 0 THEN ' ' || CAST(CAST(trunc(volume) AS BIGINT) AS VARCHAR) || ' ' || uom
                 WHEN coalesce(weight, 0) <> 0 THEN ' ' || CAST(CAST(trunc(weight) AS BIGINT) AS VARCHAR) || ' ' || uom
                 ELSE '' END AS display_unit
          FROM ({MASTER_UNITS}) m) u WHERE NOT is_deleted""",
)
def display_unit_base(spark, sf):
    live = views(spark, sf, braced(MASTER_UNITS, "part"), "part")
    return prep.with_base_names(live).select("id", "name", "display_unit", "base")


SKU_OFFERS = """
SELECT o_orderkey AS id, o_totalprice AS price,
       CASE WHEN o_orderstatus = 'F' THEN 'tanpa kode'
            ELSE 'kode ' || lpad(CAST(o_custkey AS STRING), 4, '0') || '/' || lpad(o_orderstatus, 1, 'x') || '/' ||
                 lpad(CAST(o_custkey AS STRING), 4, '0') || '/' || lpad('7', 19, '0') || '/05 asli' END AS description
FROM orders t
"""


def _sku_sql(min_offers: int) -> str:
    return f"""WITH found AS (
          SELECT *, regexp_extract(description, '({text.SKU_PATTERN})', 1) AS sku FROM ({SKU_OFFERS}) s),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY id) AS rn FROM found WHERE sku <> ''),
        rest AS (SELECT * FROM numbered WHERE rn > 1),
        kept AS (SELECT *, count(*) OVER (PARTITION BY sku) AS n, min(id) OVER (PARTITION BY sku) AS first FROM rest),
        labelled AS (SELECT *, dense_rank() OVER (ORDER BY first) - 1 AS master_product FROM kept WHERE n > 1)
        SELECT id, price, description, sku, master_product FROM labelled WHERE n > {min_offers}"""


@query("sku_masters", _sku_sql(prep.SKU_MIN_OFFERS))
def sku_masters(spark, sf):
    return prep.masters_from_sku(views(spark, sf, braced(SKU_OFFERS, "orders"), "orders"))


@query(
    "clean_text",
    f"""SELECT doc_id, lower(regexp_replace(regexp_replace(regexp_replace(coalesce(text, 'None'),
          '{text.ESCAPE_PATTERN}', '', 'g'), '{text.NON_WORD_PATTERN}', '', 'g'),
          '{text.OUTER_SPACE_PATTERN}', '', 'g')) AS clean FROM documents""",
)
def clean_text(spark, sf):
    return spread(spark, sf, "documents").select("doc_id", text.clean_text("text").alias("clean"))


@query(
    "filename_norm",
    r"""SELECT page_id, f AS basename,
               CASE WHEN regexp_matches(f, '^[^.]*\.jpg$') THEN f ELSE split_part(f, '.', 1) || '.jpg' END AS filename
        FROM (SELECT page_id, list_extract(string_split(url, '/'), -1) AS f FROM pages) t""",
)
def filename_norm(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", text.url_basename("url").alias("basename"))
    return pages.withColumn("filename", text.normalize_filename("basename"))


@query(
    "dense_ids",
    """SELECT o_orderkey, o_custkey, dense_rank() OVER (ORDER BY first) - 1 AS master_id FROM (
         SELECT o_orderkey, o_custkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS first FROM orders) t""",
)
def dense_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rows.dense_ids(orders, "o_custkey", "o_orderkey", "master_id")


@query(
    "zscore",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem))
                    / (SELECT stddev_pop(l_extendedprice) FROM lineitem), 6) AS z FROM lineitem""",
)
def zscore(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    scaled = numeric.add_zscore(lines, "l_extendedprice", "z")
    return scaled.select("l_orderkey", "l_linenumber", "l_partkey", F.round("z", 6).alias("z"))


@query(
    "softmax_prob",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(prob, 9) AS prob, CAST(round(prob, 9) > 0.6 AS INTEGER) AS match,
              CAST(l_tax * 20 > l_discount * 10 AS INTEGER) AS class
       FROM (SELECT *, exp(l_tax * 20 - greatest(l_tax * 20, l_discount * 10))
             / (exp(l_discount * 10 - greatest(l_tax * 20, l_discount * 10))
                + exp(l_tax * 20 - greatest(l_tax * 20, l_discount * 10))) AS prob FROM lineitem) t""",
)
def softmax_prob(spark, sf):
    logit0, logit1 = F.col("l_discount") * 10, F.col("l_tax") * 20
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(numeric.softmax_positive(logit0, logit1), 9).alias("prob"),
        numeric.argmax_class(logit0, logit1).alias("class"),
    ).withColumn("match", numeric.score_to_label("prob", 0.6))


@query(
    "renamed_cast",
    """SELECT CAST(o_orderkey AS VARCHAR) AS product_id, CAST(trunc(o_totalprice) AS BIGINT) AS price,
              CAST(NULL AS INTEGER) AS cluster_id, 5 AS master_product_status_id FROM orders""",
)
def renamed_cast(spark, sf):
    return (
        table(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "product_id", "o_totalprice": "price"})
        .select(
            F.col("product_id").cast("string"), F.col("price").cast("bigint"),
            F.lit(None).cast("int").alias("cluster_id"), F.lit(5).alias("master_product_status_id"),
        )
    )


def _sent(name: str, price: str) -> str:
    return (
        f"'COL name VAL ' || coalesce({name}, 'nan') || ' COL price VAL ' || "
        f"coalesce(CAST({price} AS VARCHAR), 'nan')"
    )


@query("serialize_products", f"SELECT id, {_sent('name', 'price')} AS sent FROM ({PRODUCTS}) p")
def serialize_products(spark, sf):
    return ser.serialize(products=products(spark, sf))


PRICED_PAIRS = """
SELECT l_orderkey AS id1, l_partkey AS id2, l_returnflag AS name1, l_extendedprice AS price1,
       p_name AS name2, p_retailprice AS price2, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS match
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
"""


@query(
    "serialize_pairs",
    f"""SELECT {_sent('name1', 'price1')} AS sent1, {_sent('name2', 'price2')} AS sent2, match, id1, id2
        FROM ({PRICED_PAIRS}) p""",
)
def serialize_pairs(spark, sf):
    pairs = views(spark, sf, braced(PRICED_PAIRS, "lineitem", "part"), "lineitem", "part")
    return ser.serialize(matches=pairs)


@query(
    "serialize_lookup",
    f"""SELECT {_sent('a.p_name', 'a.p_retailprice')} AS sent1, {_sent('b.p_name', 'b.p_retailprice')} AS sent2,
               l_partkey AS id1, l_suppkey AS id2
        FROM lineitem JOIN part a ON a.p_partkey = l_partkey JOIN part b ON b.p_partkey = l_suppkey""",
)
def serialize_lookup(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")
    )
    pairs = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id1"), F.col("l_suppkey").alias("id2"))
    return ser.serialize(matches=pairs, products=part)


@query(
    "mlm_mask",
    f"""SELECT doc_id, len(tokens) AS n_tokens,
               len(list_filter(masked, lambda t: t = '[MASK]')) AS n_masked,
               array_to_string(masked, ' ') AS masked_text
        FROM (SELECT doc_id, tokens, list_transform(tokens, lambda t, i:
                CASE WHEN {portable_draw("CAST(doc_id AS VARCHAR) || ':' || CAST(i - 1 AS VARCHAR)")}
                          < {int(sampling.MASK_RATE * numeric.DRAW_MODULUS)}
                     THEN '[MASK]' ELSE t END) AS masked
              FROM (SELECT doc_id, string_split(text, ' ') AS tokens FROM documents) s) u""",
)
def mlm_mask(spark, sf):
    docs = spread(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("tokens"))
    masked = docs.withColumn("m", sampling.mask_tokens("tokens", "doc_id"))
    return masked.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.size(F.filter("m", lambda t: t["token"] == sampling.MASK_TOKEN)).cast("bigint").alias("n_masked"),
        F.array_join(F.transform("m", lambda t: t["token"]), " ").alias("masked_text"),
    )


@query(
    "split_two",
    f"""SELECT o_orderkey, CASE WHEN {portable_draw('o_orderkey')} < {upto(0.8)} THEN 'train' ELSE 'test' END AS set
        FROM orders""",
)
def split_two(spark, sf):
    train, test = sampling.split_two(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("set", F.lit("train")).unionByName(test.withColumn("set", F.lit("test")))


@query(
    "split_three",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN {portable_draw('l_orderkey')} < {upto(0.8)} THEN 'train'
               WHEN {portable_draw('l_orderkey')} < {upto(0.9)} THEN 'val' ELSE 'test' END AS set FROM lineitem""",
)
def split_three(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return sampling.assign_split(lines, "l_orderkey")


@query(
    "split_exact",
    f"""SELECT o_orderkey, CASE WHEN r <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS set FROM (
          SELECT o_orderkey, count(*) OVER () AS n, row_number() OVER (ORDER BY {portable_draw('o_orderkey')}, o_orderkey) AS r
          FROM orders) t""",
)
def split_exact(spark, sf):
    return sampling.assign_split_exact(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "sample_balanced",
    f"""SELECT doc_id, quality AS match FROM labels WHERE quality = 1
        UNION ALL SELECT doc_id, quality FROM labels WHERE {portable_draw('doc_id')} < {upto(0.25)}""",
)
def sample_balanced(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("match"))
    return sampling.rebalance_fraction(labels, "doc_id", 0.25)


@query(
    "sample_rows",
    f"""SELECT o_orderkey FROM orders ORDER BY {portable_draw('o_orderkey')}, o_orderkey LIMIT 1000""",
)
def sample_rows(spark, sf):
    return sampling.sample_rows(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 1000)


@query(
    "stratified_sample",
    f"""SELECT o_orderpriority, o_orderkey FROM (
          SELECT o_orderpriority, o_orderkey, row_number() OVER (
                   PARTITION BY o_orderpriority ORDER BY {portable_draw('o_orderkey')}, o_orderkey) AS nth FROM orders) t
        WHERE nth <= 150""",
)
def stratified_sample(spark, sf):
    """Exactly as many rows of each priority."""
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return sampling.stratified_sample(orders, "o_orderpriority", "o_orderkey", 150)


@query(
    "rebalance_rows",
    f"""SELECT doc_id, quality AS match FROM labels WHERE quality = 1
        UNION ALL SELECT * FROM (SELECT doc_id, quality FROM labels ORDER BY {portable_draw('doc_id')}, doc_id LIMIT 100) t""",
)
def rebalance_rows(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("match"))
    return sampling.rebalance(labels, "doc_id", 100)


@query(
    "shuffle_rows",
    f"""SELECT doc_id, row_number() OVER (ORDER BY {portable_draw('doc_id')}, doc_id) AS place FROM labels""",
)
def shuffle_rows(spark, sf):
    """The shuffled order as a number."""
    from pyspark.sql import Window as W

    shuffled = sampling.shuffle_rows(table(spark, sf, "labels").select("doc_id"), "doc_id")
    numbered = shuffled.withColumn("seq", F.monotonically_increasing_id())
    return numbered.select("doc_id", F.row_number().over(W.orderBy("seq")).cast("bigint").alias("place"))
