"""Bloom filters over stored pairs, cut into parts: most new pairs need not meet the stored ones at all.

A pair's 64-bit hash names its part and its bits there. The filters of a run are small rows,
one per part; they are made by one aggregation over hashes and are read again by
every later run. Candidates travel to the filters' parts, and only those that
may be stored are looked up among the stored pairs themselves.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Pairs of a part, on average, and the share of absent pairs that a filter lets through.
PART_PAIRS = 1 << 20
FALSE_SHARE = 0.01
# Pairs that may be stored go to all tasks up to this many (16 bytes each); more are joined by shuffle.
BROADCAST_PAIRS = 1 << 20

FILTERS = "parts int, part int, hashes int, pairs bigint, bits binary"


class Looked(NamedTuple):
    """Pairs that are not stored, and how many were asked about, may be and are stored."""

    absent: DataFrame
    asked: int
    maybe: int
    stored: int

    @property
    def skipped(self) -> float:
        """Share of the absent pairs that no stored pair was read for."""
        absent = self.asked - self.stored
        return (self.asked - self.maybe) / absent if absent else 1.0


def _hash(a: str, b: str) -> Column:
    return F.xxhash64(F.col(a).cast("bigint"), F.col(b).cast("bigint"))


def _places(hashed: np.ndarray, hashes: int, size: int) -> np.ndarray:
    """(row, hash): the bits of each 64-bit hash, by double hashing of its mixed halves."""
    mixed = hashed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    low, high = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(hashes, dtype=np.uint64)[None, :] * high[:, None]) % np.uint64(size)).astype(np.int64)


def build_filters(pairs: DataFrame, a: str = "id1", b: str = "id2", *, part_pairs: int = PART_PAIRS, false_share: float = FALSE_SHARE) -> DataFrame:
    """One row per part of the distinct pairs: ``(parts, part, hashes, pairs, bits)``.

    Hashes, not pairs, are shuffled, once; a part's size is bounded by the number of parts, whatever
    the pairs, as repeats are dropped before. Pairs with a NULL member are in no filter. No pairs, no rows.
    """
    hashed = cut_lineage(pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(_hash(a, b).alias("h")).distinct())
    parts = max(1, math.ceil(hashed.count() / part_pairs))
    hashes = max(1, round(-math.log2(false_share)))

    def fill(rows: pa.Table) -> pa.Table:
        h = rows["h"].to_numpy()
        # 1.44 bits a pair for each hash, in whole bytes
        size = max(64, -(-int(len(h) * hashes / math.log(2)) // 8) * 8)
        bits = np.zeros(size, bool)
        for begin in range(0, len(h), 1 << 18):
            bits[_places(h[begin : begin + (1 << 18)], hashes, size).ravel()] = True
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({
            "parts": pa.array([parts], pa.int32()), "part": rows["part"][:1].combine_chunks(), "hashes": pa.array([hashes], pa.int32()),
            "pairs": pa.array([len(h)], pa.int64()), "bits": pa.array([packed], pa.binary()),
        })

    part = F.pmod("h", F.lit(parts)).cast("int").alias("part")
    return hashed.select("h", part).groupBy("part").applyInArrow(fill, schema=FILTERS)


def may_be_stored(pairs: DataFrame, filters: DataFrame, a: str = "id1", b: str = "id2") -> DataFrame:
    """The pairs ``(a, b)`` that some filter does not rule out; never one too few.

    ``filters`` are the rows of any number of :func:`build_filters`, each with parts of its own. A pair goes once to
    each number of parts there is. Pairs with a NULL member are stored nowhere.
    """
    whole = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b, _hash(a, b).alias("h"))
    kinds = [r["parts"] for r in filters.select("parts").distinct().collect()]  # a few numbers
    if not kinds:
        return whole.select(a, b).limit(0)
    each = whole.withColumn("parts", F.explode(F.array(*[F.lit(k) for k in kinds])))
    placed = each.withColumn("part", F.pmod("h", "parts").cast("int"))

    def probe(rows: pa.Table, held: pa.Table) -> pa.Table:
        h, found = rows["h"].to_numpy(), np.zeros(rows.num_rows, bool)
        for hashes, bits in zip(held["hashes"].to_pylist(), held["bits"]):
            packed = np.frombuffer(bits.as_buffer(), np.uint8)
            for begin in range(0, len(h), 1 << 18):
                at = _places(h[begin : begin + (1 << 18)], hashes, 8 * len(packed))
                found[begin : begin + (1 << 18)] |= ((packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
        return rows.select([a, b]).filter(pa.array(found))

    types = {f.name: f.dataType.simpleString() for f in pairs.schema}
    out = placed.groupBy("parts", "part").cogroup(filters.groupBy("parts", "part")).applyInArrow(
        probe, schema=f"`{a}` {types[a]}, `{b}` {types[b]}"
    )
    return out if len(kinds) == 1 else out.distinct()


def not_stored(
    pairs: DataFrame, stored: DataFrame, filters: DataFrame, a: str = "id1", b: str = "id2", *, broadcast_pairs: int = BROADCAST_PAIRS
) -> Looked:
    """The pairs that are not among the stored ones, exactly, as a left anti join gives them.

    ``filters`` cover the stored pairs at least. Pairs that they rule out are not stored. The others are
    looked up: up to ``broadcast_pairs`` of them travel to the stored pairs, which then stay where they are.
    Repeated pairs, and pairs with a NULL member, stay as they are.
    """
    asked = cut_lineage(pairs)
    maybe = cut_lineage(may_be_stored(asked.select(a, b).distinct(), filters, a, b))
    n_maybe = maybe.count()
    small = n_maybe <= broadcast_pairs
    found = cut_lineage(stored.select(a, b).join(F.broadcast(maybe) if small else maybe, [a, b], "left_semi").distinct())
    absent = asked.join(found, [a, b], "left_anti")
    return Looked(absent, asked.select(a, b).na.drop().distinct().count(), n_maybe, found.count())
