"""SimHash near-duplicates by a Gray-order hierarchical index over the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import with_columns, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# Children of a node of the index.
FAN = 16
# Distinct fingerprints of a shard, and fingerprints searched in it by one task.
SHARD = 1 << 17
QUERIES = 1 << 16
# Upper nodes a shard shows to the routing step.
TOPS = 64
# Fingerprints searched in one step; bounds the frontier.
STEP = 1 << 11

# One byte of a hash as eight byte-wide counters.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _fingerprint(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have."""
    counts = np.zeros((8, 8), np.int64)
    raw = hashes.view(np.uint8).reshape(-1, 8)
    for part in range(0, len(raw), 255):  # a byte-wide counter holds 255
        sums = _SPREAD[raw[part: part + 255]].sum(axis=0, dtype=np.uint64)
        counts += sums.view(np.uint8).reshape(8, 8)
    return int(np.packbits((2 * counts > len(raw)).ravel(), bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of a text with A-Z lower-cased; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends + 1 - sizes)[: len(words) - shingle + 1].tolist()
    hashes = [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    return _fingerprint(np.array(hashes, "<u8"))


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """All rows with the 64 bits of their SimHash as a bigint; NULL and empty texts have 0."""

    def make():
        def work(batch: pa.RecordBatch) -> list:
            prints = [fingerprint(t or "", shingle) for t in batch.column("__in_0").to_pylist()]
            return [pa.array(np.array(prints, np.uint64).view(np.int64))]

        return work

    return with_columns(docs, [text], f"{out} bigint", make)


def gray_rank(c: Column) -> Column:
    """Place of a 64-bit word in the binary-reflected Gray sequence, as a bigint that sorts like it."""
    for shift in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, shift))
    return c.bitwiseXOR(F.lit(-(1 << 63)))  # unsigned order as signed


def _gray_rank(x: np.ndarray) -> np.ndarray:
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayTree:
    """Fingerprints in Gray order under nodes that hold the bits all below them share.

    Neighbours in Gray order differ in few bits, so a run of them shares many, and
    not only leading ones. Each level groups ``FAN`` nodes; a node's mask are the
    bits in which its children agree. A child keeps only the bits its parent does
    not hold, and a search adds up the differences on the way down, leaving a whole
    group as soon as they exceed the radius.
    """

    def __init__(self, masks: np.ndarray, patterns: np.ndarray):
        """``masks`` and ``patterns`` of the leaves, in Gray order; all bits for single fingerprints."""
        self.levels = [(masks, patterns)]
        while len(self.levels[-1][0]) > 1:
            m, p = self.levels[-1]
            first = np.arange(0, len(m), FAN)
            differ = p ^ np.repeat(p[first], FAN)[: len(p)]
            shared = np.bitwise_and.reduceat(m & ~differ, first)
            self.levels.append((shared, p[first] & shared))
        # bits of each node that its parent does not hold
        self.own = []
        for k, (m, _) in enumerate(self.levels):
            above = self.levels[k + 1][0] if k + 1 < len(self.levels) else np.zeros(1, np.uint64)
            self.own.append(m & ~np.repeat(above, FAN)[: len(m)])

    def search(self, prints: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(query, leaf)`` pairs whose shared bits differ in at most ``radius`` places, in steps."""
        for part in range(0, len(prints), STEP):
            q = prints[part: part + STEP]
            query, node = np.arange(len(q)), np.zeros(len(q), np.int64)
            spent = np.zeros(len(q), np.int64)
            for k in range(len(self.levels) - 1, -1, -1):
                pattern, own = self.levels[k][1], self.own[k]
                if k < len(self.levels) - 1:
                    query, spent = np.repeat(query, FAN), np.repeat(spent, FAN)
                    node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    there = node < len(pattern)
                    query, node, spent = query[there], node[there], spent[there]
                spent = spent + np.bitwise_count((q[query] ^ pattern[node]) & own[node])
                near = spent <= radius
                query, node, spent = query[near], node[near], spent[near]
            yield query + part, node


def _tree(prints: np.ndarray) -> tuple[GrayTree, np.ndarray]:
    """The tree over some fingerprints, and their order in it."""
    order = np.argsort(_gray_rank(prints), kind="stable")
    return GrayTree(np.full(len(prints), ~np.uint64(0)), prints[order]), order


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as one link from each node to the smallest node it hangs together with."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a):]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        if np.array_equal(low, high):
            break
        np.minimum.at(parent, high, low)
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
    moved = parent != np.arange(len(nodes))
    return nodes[moved], nodes[parent[moved]]


def near_links(classes: DataFrame, max_bits: int = MAX_BITS, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """Links ``(id1, id2)`` that join the distinct ``(fp, rep)`` within ``max_bits`` bits of each other.

    The fingerprints are cut into shards of consecutive Gray rank. Each shard shows the
    shared bits of at most ``TOPS`` runs; a tree over these sends every fingerprint to
    the shards it may have a neighbour in. A task then builds the tree of a shard and
    searches a block of fingerprints in it. Of the links it finds it returns a
    spanning forest: the same connected components with fewer rows than it read.
    """
    spark = classes.sparkSession
    classes = written(classes.select("fp", "rep"), "simhash-classes")
    shards = max(1, -(-classes.count() // shard))
    # ranges of Gray rank; the sampling for them reads the stored classes only
    ranked = classes.withColumn("rank", gray_rank(F.col("fp"))).repartitionByRange(shards, "rank")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        k = TaskContext.get().partitionId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(batch.num_rows, k, np.int32)), batch.column(0), batch.column(1)], names=["shard", "fp", "rep"]
            )

    base = written(ranked.select("fp", "rep").mapInArrow(number, schema="shard int, fp bigint, rep bigint"), "simhash-shards")

    # runs of about equal rank width within a shard, their shared bits by aggregation
    span = base.withColumn("rank", gray_rank(F.col("fp"))).groupBy("shard").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    run = F.floor((F.col("rank").cast("double") - F.col("lo").cast("double")) * TOPS / (F.col("hi").cast("double") - F.col("lo").cast("double") + 1))
    tops = (
        base.withColumn("rank", gray_rank(F.col("fp"))).join(F.broadcast(span), "shard")
        .groupBy("shard", F.least(run, F.lit(TOPS - 1)).alias("run"))
        .agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("any"), F.min("rank").alias("rank"))
    )
    found = tops.orderBy("rank").toPandas()  # at most TOPS rows a shard
    ones, any_ = (found[c].to_numpy(np.int64).view(np.uint64) for c in ("ones", "any"))
    upper = spark.sparkContext.broadcast((GrayTree(~(ones ^ any_), ones), found["shard"].to_numpy(np.int32)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, shard_of = upper.value
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            reps = batch.column(1).to_numpy()
            for query, leaf in tree.search(prints, max_bits):
                pairs = np.unique(query * np.int64(len(shard_of) + shards) + shard_of[leaf])
                q, s = pairs // (len(shard_of) + shards), pairs % (len(shard_of) + shards)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.astype(np.int32)), pa.array(prints[q].view(np.int64)), pa.array(reps[q])],
                    names=["shard", "fp", "rep"],
                )

    routed = written(base.select("fp", "rep").mapInArrow(route, schema="shard int, fp bigint, rep bigint"), "simhash-routed")
    # blocks of fingerprints per shard, so that no task gets more than it can hold
    blocks = routed.groupBy("shard").agg(F.ceil(F.count("*") / queries).cast("int").alias("blocks"))
    asked = routed.join(F.broadcast(blocks), "shard").select(
        "shard", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"), "fp", "rep", F.lit(True).alias("asks")
    )
    held = base.join(F.broadcast(blocks), "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "fp", "rep", F.lit(False).alias("asks")
    )

    def link(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy(bool)
        prints, reps = group["fp"].to_numpy(np.int64).view(np.uint64), group["rep"].to_numpy(np.int64)
        tree, order = _tree(prints[~asks])
        held_reps = reps[~asks][order]
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for query, leaf in tree.search(prints[asks], max_bits):
            x, y = reps[asks][query], held_reps[leaf]
            other = x != y
            a, b = _forest(np.concatenate([a, x[other]]), np.concatenate([b, y[other]]))
        return pd.DataFrame({"id1": a, "id2": b})

    return asked.unionAll(held).groupBy("shard", "block").applyInPandas(link, schema="id1 bigint, id2 bigint")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``(id, fingerprint, component_id)`` per row: documents linked by at most ``max_bits`` differing bits.

    ``fingerprint`` has 16 lowercase hex digits, ``component_id`` is the smallest id
    reachable. Documents with one fingerprint are a class, stood for by its smallest
    id; classes are linked by :func:`near_links` and joined to components. A class of
    any size is one row from the first aggregation on.

    A text with fewer words than a shingle is hashed whole; NULL and empty texts share
    fingerprint 0 and link like any other. Rows with a NULL id get their fingerprint and
    the component of their class, NULL if all of its ids are; repeated rows are kept. Other columns are dropped.
    """
    source = docs.select(docs[id].cast("bigint").alias("__id"), docs[text].alias("__text"))
    prints = written(with_fingerprint(source, "__text", "fp", shingle).select("__id", "fp"), "simhash-prints")
    classes = prints.groupBy("fp").agg(F.min("__id").alias("rep"))
    links = near_links(classes.where("rep IS NOT NULL"), max_bits)
    components = connected_components(links)
    # every class with its component; then each document by its fingerprint
    labelled = classes.join(components, F.col("rep") == F.col("id"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(labelled, "fp").select(
        F.col("__id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest id, the columns of ``docs`` unchanged.

    Of rows that share this id, one stays. Rows with a NULL id, which no group can name, all stay.
    """
    groups = near_duplicates(docs, id, text, **options)
    keep = groups.where(F.col(id) == F.col("component_id")).select(F.col(id).alias("__keep")).distinct()
    chosen = docs.join(keep, docs[id].cast("bigint") == F.col("__keep"), "left_semi")
    return chosen.dropDuplicates([id]).unionAll(docs.where(docs[id].isNull()))
