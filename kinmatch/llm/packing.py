"""Cost-balanced packing of tokenized documents into training sequences."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker
from .ragged import step_ranges
from .tokens import SpacePrefixEncoder

CAPACITY = 2048
# Tokens that a task packs together; bounds its memory, changes no row count.
BLOCK_TOKENS = 1 << 20


def sequence_sizes(total: int, capacity: int = CAPACITY) -> list[int]:
    """Sizes of the sequences for ``total`` tokens: full ones, the rest in powers of two.

    Sequences that are a power of two long need no padding, so nothing is padded.
    """
    full, rest = divmod(total, capacity)
    return [capacity] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class _Open:
    """Open sequences by remaining room: the cheapest of those with at least some room, in a few steps.

    A heap of (cost, sequence) for every room, under a tree whose nodes hold the cheapest below them.
    """

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.heaps: list[list] = [[] for _ in range(self.width)]
        self.best: list = [(math.inf, -1, 0)] * (2 * self.width)

    def _renew(self, room: int) -> None:
        heap, at, best = self.heaps[room], room + self.width, self.best
        best[at] = (*heap[0], room) if heap else (math.inf, -1, 0)
        while at > 1:
            at >>= 1
            best[at] = min(best[2 * at], best[2 * at + 1])

    def add(self, cost: float, sequence: int, room: int) -> None:
        heapq.heappush(self.heaps[room], (cost, sequence))
        self._renew(room)

    def take(self, room: int) -> tuple[float, int] | None:
        """Remove the cheapest sequence with at least this room; ties to the earlier one."""
        found, low, high = self.best[0], room + self.width, 2 * self.width
        while low < high:
            if low & 1:
                found, low = min(found, self.best[low]), low + 1
            low, high = low >> 1, high >> 1
        if found[1] < 0:
            return None
        heapq.heappop(self.heaps[found[2]])
        self._renew(found[2])
        return found[:2]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Assign documents of these lengths: ``(document, start, length, sequence, offset)`` per piece.

    A piece of n tokens costs n + n^2 / capacity (linear layers and attention).
    Documents are taken by falling length, ties in given order, each to the cheapest
    open sequence that has room for all of it; only when none has, it is cut to fill the
    cheapest of all. Whole sequences' worth of a long document is cut off first.
    """
    pieces, out, sequence = [], [], 0
    for i, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            out.append((i, k * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            pieces.append((n % capacity, i, whole * capacity))
    pieces.sort(key=lambda p: (-p[0], p[1]))
    room = sequence_sizes(sum(p[0] for p in pieces), capacity)
    size, open_ = list(room), _Open(capacity)
    for k, free in enumerate(room):
        open_.add(0.0, k, free)
    for n, i, start in pieces:
        while n:
            cost, k = open_.take(n) or open_.take(1)
            part = min(n, room[k])
            out.append((i, start, part, sequence + k, size[k] - room[k]))
            room[k] -= part
            if room[k]:
                open_.add(cost + part + part * part / capacity, k, room[k])
            start, n = start + part, n - part
    return out


def pack(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", end_id: int = 1,
    capacity: int = CAPACITY, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    ``tokenizer`` is the path of a byte-level tokenizer file. One row per piece:
    the id column, ``start`` (its document's tokens before it), ``length``,
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and ``ids``, the
    tokens as little-endian unsigned 32-bit integers. Every token with the end id
    after each document lies in exactly one piece. Each task packs blocks of its own
    rows, so nothing is shuffled; a sequence id holds the partition in its high half.

    A NULL or empty text is its end id alone; a NULL id stays NULL; repeated rows are
    packed each; a document longer than a block is a block of its own; an empty table
    gives no row. Other columns are dropped.
    """
    id_type = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_worker(("bytes", tokenizer), lambda: SpacePrefixEncoder(tokenizer))
        end = np.asarray([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 32
        names, held, tokens = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            lengths = [len(x) // 4 for x in held]
            rows = pack_lengths(lengths, capacity)
            doc, start, length, seq, offset = map(list, zip(*rows))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in doc], type=id_arrow),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array([lengths[i] for i in doc], pa.int64()),
                    pa.array([sequence + s for s in seq], pa.int64()), pa.array(offset, pa.int64()),
                    pa.array([held[i][4 * s: 4 * (s + n)] for i, s, n in zip(doc, start, length)], pa.binary()),
                ],
                names=["__id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )
            sequence += max(seq) + 1
            return out

        id_arrow = None
        for batch in batches:
            id_arrow = batch.column(0).type
            texts = batch.column(1)
            for first, last in step_ranges(texts, encode.step):
                found, counts = encode(texts.slice(first, last - first))
                raw, ends = found.astype("<u4").tobytes(), 4 * np.cumsum(counts)
                some = batch.column(0).slice(first, last - first).to_pylist()
                for name, a, b in zip(some, (ends - 4 * counts).tolist(), ends.tolist()):
                    names.append(name)
                    held.append(raw[a:b] + end)
                    tokens += len(held[-1]) // 4
                    if tokens >= block_tokens:
                        yield flush()
                        names, held, tokens = [], [], 0
        if held:
            yield flush()

    schema = (
        f"__id {id_type}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    )
    packed = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text")).mapInArrow(run, schema=schema)
    return packed.withColumnRenamed("__id", id)
