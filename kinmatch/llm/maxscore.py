"""Exact top-k search by inner product with MaxScore over signed postings."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 5
# Vectors of a shard; queries that travel to the executors at once.
SHARD = 1 << 13
QUERIES = 1 << 14
# Vectors scored in full before the first bound is known.
WARM = 64


class Shard:
    """Postings of some integer vectors.

    A term is a dimension with a sign: its postings are the vectors whose component
    has that sign, with the component as weight. Of a query's two terms of a dimension
    one can only raise a score, the other only lower it.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.postings = []
        for d in range(vectors.shape[1]):
            column = self.vectors[:, d]
            for sign in (1, -1):
                where = np.flatnonzero(column * sign > 0)
                weight = column[where]
                self.postings.append((where, weight, np.abs(weight).max() if len(where) else 0))

    def search(self, query: np.ndarray, k: int, skip: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best vectors that can still reach ``floor``.

        Raising terms are sorted by the most they can add. Those whose bounds together
        stay below the ``k``-th best score are non-essential: a vector in none of the
        other postings cannot get in. The essential postings are traversed, then the
        remaining terms are probed by falling bound for vectors that can still compete.
        """
        n = len(self.ids)
        mine = self.ids == skip
        dims = np.flatnonzero(query)
        raising = [(2 * d if query[d] > 0 else 2 * d + 1) for d in dims]
        bounds = np.array([self.postings[t][2] * abs(query[d]) for t, d in zip(raising, dims)])
        # a first bound from vectors scored in full: the last known floor or the k-th of a few
        warm = self.vectors[:WARM] @ query
        warm = warm[~mine[:WARM]]
        if len(warm) >= k:
            floor = max(floor, np.partition(warm, len(warm) - k)[len(warm) - k])
        rising = np.argsort(bounds, kind="stable")
        reach = np.cumsum(bounds[rising])
        # with a floor of 0 or less a vector in no posting may still get in: then all are candidates
        optional = int(np.searchsorted(reach, floor, side="left")) if floor > 0 else 0
        partial = np.zeros(n)
        seen = np.zeros(n, bool) if floor > 0 else np.ones(n, bool)
        for j in rising[optional:]:
            where, weight, _ = self.postings[raising[j]]
            partial[where] += weight * query[dims[j]]
            seen[where] = True
        seen &= ~mine
        open_ = np.flatnonzero(seen)
        score = partial[open_]
        left = reach[optional - 1] if optional else 0.0
        near = score + left >= floor
        open_, score = open_[near], score[near]
        for j in rising[:optional][::-1]:
            # the raising half of the dimension; the lowering half follows for all
            part = self.vectors[open_, dims[j]] * query[dims[j]]
            score = score + np.maximum(part, 0)
            left -= bounds[j]
            near = score + left >= floor
            open_, score = open_[near], score[near]
        for d in dims:
            # lowering terms have bound 0: non-essential always
            score = score + np.minimum(self.vectors[open_, d] * query[d], 0)
            near = score >= floor
            open_, score = open_[near], score[near]
        best = np.lexsort((self.ids[open_], -score))[:k]
        return self.ids[open_[best]], score[best]


def _queries(vectors: DataFrame, blocks: int) -> Iterator[tuple[np.ndarray, list]]:
    for b in range(blocks):
        rows = vectors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else vectors
        found = rows.toArrow()
        yield found.column("id").to_numpy(), found.column("v").to_pylist()


def _padded(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def search_top_k(
    base: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "vector", k: int = K,
    shard: int = SHARD, block: int = QUERIES,
) -> DataFrame:
    """``(query_id, rank, id, score)``: for each query the ``k`` highest integer inner products.

    Both sides hold an integer id and an array of whole numbers; a query's own id is no
    candidate. Ties go to the smaller id. Every task turns batches of its vectors into
    shards of postings and answers all queries on them; the best of all shards are
    merged per query. Queries travel to the executors in blocks of ``block``.

    Arrays that are NULL or hold NULL take no part; a shorter array has no terms in its
    missing dimensions. Rows that share an id are one query each of a different vector,
    and candidates each. An empty side gives no row. Products must stay below 2**53 per score.
    """
    spark = base.sparkSession
    usable = F.col("v").isNotNull() & F.col("id").isNotNull() & ~F.exists("v", lambda x: x.isNull())
    double = F.col(vector).cast("array<double>").alias("v")
    asked = queries.select(F.col(id).cast("bigint").alias("id"), double).where(usable).distinct()
    held = base.select(F.col(id).cast("bigint").alias("id"), double).where(usable)
    blocks = max(1, math.ceil(asked.count() / block))
    answers = None
    for ids, rows in _queries(asked, blocks):
        shared = spark.sparkContext.broadcast((ids, rows))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, rows = shared.value
            width = max(map(len, rows), default=0)
            asked_vectors = _padded(rows, width)
            floors = np.full((len(ids), k), -np.inf)
            held_ids, held_rows, size = [], [], 0

            def answer():
                vectors = _padded([r[:width] for r in held_rows], width)
                part = Shard(np.array(held_ids, np.int64), vectors)
                out: list[list] = [[], [], [], []]
                for q, (name, asked) in enumerate(zip(ids.tolist(), asked_vectors)):
                    found, scores = part.search(asked, k, name, floors[q, 0])
                    floors[q] = np.sort(np.concatenate([floors[q], scores]))[-k:]
                    out[0] += [q] * len(found)
                    out[1] += [name] * len(found)
                    out[2] += found.tolist()
                    out[3] += scores.astype(np.int64).tolist()
                return pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(out, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["q", "query_id", "id", "score"],
                )

            for batch in batches:
                held_ids += batch.column(0).to_pylist()
                held_rows += batch.column(1).to_pylist()
                while len(held_ids) >= shard:
                    rest = held_ids[shard:], held_rows[shard:]
                    held_ids, held_rows = held_ids[:shard], held_rows[:shard]
                    yield answer()
                    held_ids, held_rows = rest
            if held_ids:
                yield answer()

        # q tells apart the vectors of one id
        found = held.mapInArrow(run, schema="q int, query_id bigint, id bigint, score bigint")
        answers = found if answers is None else answers.unionAll(found)
    # the k best of each partition before the shuffle, then of all
    order = W.partitionBy("query_id", "q").orderBy(F.desc("score"), "id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    result_id = id if id not in ("query_id", "rank", "score") else "id"
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(result_id), "score")


def scaled(vector: Column, scale: int = 256) -> Column:
    """Components as floor(scale * x); NULL if the vector is NULL or has a component that is NULL or not finite."""
    x = vector.cast("array<double>")
    sound = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(sound, F.transform(x, lambda c: F.floor(c * scale)))
