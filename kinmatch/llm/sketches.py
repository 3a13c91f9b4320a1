"""Ranked lexical search with hashed max-sketches.

Every document's term impacts are folded into two short rows of cells, a term into
one cell of each by hash; a cell keeps the largest impact. The smaller of a query term's two
cells is never below its impact, so one batched look-up of the terms of all items gives an upper
bound of every document for every item. Documents are then scored exactly by falling
bound, until the bound falls below the k-th best score.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

K = 10
# Cells of each of the two rows of a sketch, and the unit of their 16-bit impacts, which are rounded up.
WIDTH = 1024
UNIT = 16
# Bytes of text sketched together, bounds held at once, and bytes of items that go to the executors at once.
STEP_BYTES = 1 << 24
BOUNDS = 1 << 21
BLOCK_BYTES = 1 << 22
# Documents scored first for an item; each further round takes twice as many.
FIRST_ROUND = 32
# The terms' bytes: digits, letters, and all of characters beyond ASCII; A-Z are lower-cased.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class Postings:
    """Terms of some texts: ``terms``, distinct; and by text, then term: ``text``, ``term`` and ``tf``. ``n`` are terms per text."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("")
        _, offsets, data = texts.buffers()
        off = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
        raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        off = off - off[0]
        inside = _TERM[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[off] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:-1]
        begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.n = np.diff(np.searchsorted(begin, off)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(_LOWER[raw[inside]])])
        found = found.dictionary_encode()
        self.terms = found.dictionary
        size = max(1, len(self.terms))
        pair, self.tf = np.unique(np.repeat(np.arange(len(self.n)), self.n) * size + found.indices.to_numpy(), return_counts=True)
        self.text, self.term = pair // size, pair % size


def _steps(texts: pa.Array) -> Iterator[pa.Array]:
    """Row ranges of about STEP_BYTES bytes of text."""
    size = pc.binary_length(texts).fill_null(0).to_numpy()
    block = np.cumsum(size) // STEP_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield a, texts.slice(a, b - a)


class Items:
    """A block of items: their distinct terms, and which item holds which."""

    def __init__(self, texts: list[str]):
        found = Postings(pa.array(texts, pa.string()))
        self.terms = found.terms
        self.n = len(texts)
        self.item, self.term = found.text, found.term
        codes = [zlib.crc32(t) for t in found.terms.to_pylist()]
        self.cells = _cells(np.array(codes, np.int64), WIDTH)

    def weighted(self, df: np.ndarray, documents: int) -> np.ndarray:
        """The weight of each term as a (term, item) matrix; zero where the item lacks the term."""
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.float64)
        out = np.zeros((len(self.terms), self.n))
        out[self.term, self.item] = weight[self.term]
        return out


def _cells(codes: np.ndarray, width: int) -> np.ndarray:
    """A term's cell in each of the two rows, from separate bits of its code."""
    return np.stack([codes % width, (codes >> 16) % width])


class Shard:
    """Sketches and exact impacts of some texts, for the items of a block."""

    def __init__(self, found: Postings, items: Items, documents: int, length: int, width: int = WIDTH):
        # m in whole numbers of any size
        m = np.array([10 + 90 * n * documents // length for n in found.n.tolist()], np.int64)
        impact = 1_000_000_000 * found.tf // (1000 * found.tf + 8 * m[found.text])
        codes = np.array([zlib.crc32(t) for t in found.terms.to_pylist()], np.int64)
        rising = np.argsort(impact, kind="stable")
        # of several values for one cell the last, largest, stays
        self.sketch = np.zeros((2, len(found.n), width), np.uint16)
        for row, cell in zip(self.sketch, _cells(codes, width)):
            row[found.text[rising], cell[found.term[rising]]] = -(-impact[rising] // UNIT)
        asked = pc.index_in(found.terms, items.terms).fill_null(-1).to_numpy()[found.term]
        mine = asked >= 0
        self.term, self.impact = asked[mine], impact[mine]
        self.begin = np.searchsorted(found.text[mine], np.arange(len(found.n) + 1))
        self.items = items

    def bounds(self, weights: np.ndarray, first: int, last: int) -> np.ndarray:
        """Upper bounds of these texts for all items; whole numbers below 2**53, so exact."""
        one, two = self.items.cells
        most = np.minimum(self.sketch[0, first:last][:, one], self.sketch[1, first:last][:, two])
        return (most.astype(np.float64) * UNIT) @ weights

    def scores(self, texts: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of texts for one item."""
        size = self.begin[texts + 1] - self.begin[texts]
        at = np.arange(int(size.sum())) + np.repeat(self.begin[texts] - np.cumsum(size) + size, size)
        ends = np.concatenate([[0], np.cumsum(weight[self.term[at]].astype(np.int64) * self.impact[at])])
        last = np.cumsum(size)
        return ends[last] - ends[last - size]

    def search(self, weights: np.ndarray, ids: list, k: int, floors: np.ndarray) -> tuple[list, list, list]:
        """Items, ids and scores of each item's ``k`` best texts that reach its floor; raises the floors.

        ``ids`` decide between equal scores, NULL last. Counts what it scores in ``self.scored``.
        """
        out: tuple[list, list, list] = ([], [], [])
        self.scored = 0
        rows = max(1, BOUNDS // max(1, weights.shape[1], weights.shape[0]))
        for first in range(0, len(ids), rows):
            last = min(first + rows, len(ids))
            bounds = self.bounds(weights, first, last)
            for item in np.flatnonzero((bounds >= floors).any(axis=0)).tolist():
                self._best(item, bounds[:, item], first, weights[:, item], ids, k, floors, out)
        return out

    def _best(self, item, bound, first, weight, ids, k, floors, out) -> None:
        open_ = np.flatnonzero(bound >= floors[item])
        open_ = open_[np.argsort(-bound[open_], kind="stable")]
        best: list[tuple] = []
        at, size = 0, FIRST_ROUND
        while at < len(open_) and bound[open_[at]] >= floors[item]:
            some = open_[at : at + size] + first
            at, size = at + size, 2 * size
            score = self.scores(some, weight)
            self.scored += len(some)
            good = score >= floors[item]
            best += [(-s, ids[t] is None, ids[t]) for t, s in zip(some[good].tolist(), score[good].tolist())]
            best = sorted(best, key=lambda x: x if x[2] is not None else (*x[:2], 0))[:k]
            if len(best) == k:
                floors[item] = max(floors[item], -best[-1][0])
        out[0].extend([item] * len(best))
        out[1].extend(x[2] for x in best)
        out[2].extend(-x[0] for x in best)


def _statistics(docs: DataFrame, shared: Broadcast) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and in how many documents each of the items' terms occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        # the items' terms, then documents and terms
        sums = np.zeros(len(items.terms) + 2, np.int64)
        for batch in batches:
            for _, texts in _steps(batch.column(0)):
                found = Postings(texts)
                asked = pc.index_in(found.terms, items.terms).fill_null(-1).to_numpy()[found.term]
                sums[:-2] += np.bincount(asked[asked >= 0], minlength=len(items.terms))
                sums[-2:] += [np.count_nonzero(found.n), found.n.sum()]
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(sums[some])], names=["k", "n"])

    counted = docs.select("__text").mapInArrow(count, schema="k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(len(shared.value.terms) + 2, np.int64)
    sums[counted["k"].to_numpy()] = counted["n"].to_numpy()
    return int(sums[-2]), int(sums[-1]), sums[:-2]


def _blocks(items: DataFrame, limit: int) -> Iterator[list]:
    """The items in blocks of about ``limit`` bytes, each collected on its own."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + int(total) // limit
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else items
        found = rows.collect()
        if found:
            yield found


def search_ranked(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    k: int = K, width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` highest-scoring documents of each item.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. With N documents
    that hold a term, L terms in all, n terms of a document, and df documents that hold
    a term, which occurs tf times in this one, its weight is floor(1000 ln((2N+2) / (2df+1))), m is
    10 + 90nN div L, and a document's score is the sum of weight * (10^9 tf div (1000 tf + 8m)) over the item's distinct terms.

    Two passes over the documents for each block of ``block_bytes`` of items: one counts, adding up within
    tasks; in the other every task sketches its documents shard by shard and answers all items of the block.
    The best of all tasks are merged by item, so what is shuffled does not grow with the documents. Nothing is
    left out of the search: ``width`` changes how many documents are scored exactly, not the result.

    Ranks are unique, equal scores by ascending id, NULL last. A score is above 0; items without terms or
    matches give no row. NULL texts have no terms; repeated documents are each found, repeated
    items are each answered, an item id may be NULL; an empty side gives no row. Other columns are dropped.
    """
    spark = docs.sparkSession
    id_type, item_type = docs.schema[id].dataType, items.schema[item_id].dataType
    held = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    answers, total = [], asked.count()
    for rows in _blocks(asked, block_bytes):
        shared = spark.sparkContext.broadcast(Items([r["text"] for r in rows]))
        documents, length, df = _statistics(held, shared)
        if not documents:
            break

        def run(batches: Iterator[pa.RecordBatch], shared=shared, documents=documents, length=length, df=df) -> Iterator[pa.RecordBatch]:
            items: Items = shared.value
            if width != WIDTH:
                items.cells = _cells(np.array([zlib.crc32(t) for t in items.terms.to_pylist()], np.int64), width)
            weights, floors = items.weighted(df, documents), np.ones(items.n)
            for batch in batches:
                names = batch.column(0).to_pylist()
                for first, texts in _steps(batch.column(1)):
                    part = Shard(Postings(texts), items, documents, length, width)
                    item, found, score = part.search(weights, names[first : first + len(texts)], k, floors)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item, pa.int32()), pa.array(found, batch.column(0).type), pa.array(score, pa.int64())],
                        names=["n", "__id", "score"],
                    )

        found = held.mapInArrow(run, schema=f"n int, __id {id_type.simpleString()}, score bigint")
        order = W.partitionBy("n").orderBy(F.desc("score"), F.asc_nulls_last("__id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(n, r["item"]) for n, r in enumerate(rows)], f"n int, item {item_type.simpleString()}")
        answer = ranked.join(F.broadcast(names), "n").select(
            F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("__id").alias(id), "score"
        )
        answers.append(answer if len(rows) == total else written(answer, "ranked"))
    schema = f"{item_id} {item_type.simpleString()}, rank int, {id} {id_type.simpleString()}, score bigint"
    out = answers[0] if answers else spark.createDataFrame([], schema)
    for more in answers[1:]:
        out = out.unionAll(more)
    return out
