"""Reproducible splits, samples and token masking: all draws are hashes of keys."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numeric import DRAW_MODULUS, draw, drawn_below
from ..functions.ranks import global_rank

# Default split sizes, masking rate and special tokens.
TEST_FRACTION = 0.2
THREE_WAY = {"train": 0.8, "val": 0.1, "test": 0.1}
MASK_RATE = 0.15
MASK_TOKEN = "[MASK]"
SPECIAL_TOKENS = ("[CLS]", "[SEP]", "[PAD]")


# Rows that a task holds before it keeps each stratum's first, and parts in which a stratum is merged.
HELD_ROWS = 1 << 18
SAMPLE_PARTS = 64


def _cut(fraction: float) -> int:
    return int(fraction * DRAW_MODULUS)


def _unit_draw(key: str, seed: int) -> Column:
    """The draw as a number in [0, 1)."""
    return draw(key, seed=seed) / F.lit(float(DRAW_MODULUS))


def assign_split(
    df: DataFrame, key: str, fractions: Mapping[str, float] = THREE_WAY, seed: int = 0, out: str = "set"
) -> DataFrame:
    """Name each row's set by the draw of its key; no shuffle, sizes approximate. NULL keys share one draw."""
    total = sum(fractions.values())
    names = list(fractions)
    choice, upto = None, 0.0
    for name in names[:-1]:
        upto += fractions[name] / total
        test = drawn_below(_cut(upto), key, seed=seed)
        choice = F.when(test, name) if choice is None else choice.when(test, name)
    last = F.lit(names[-1])
    return df.withColumn(out, last if choice is None else choice.otherwise(last))


def split_two(df: DataFrame, key: str, test_fraction: float = TEST_FRACTION, seed: int = 0):
    """``(train, test)`` by :func:`assign_split`."""
    train = drawn_below(_cut(1.0 - test_fraction), key, seed=seed)
    return df.where(train), df.where(~train)


def assign_split_exact(
    df: DataFrame, key: str, test_fraction: float = TEST_FRACTION, seed: int = 0, out: str = "set"
) -> DataFrame:
    """Exactly ``ceil(n * test_fraction)`` test rows: the first ones by draw, then key."""
    drawn = df.withColumn("__draw", _unit_draw(key, seed))
    ranked = global_rank(drawn, "__draw", key, out="__rank", uniform=True)
    wanted = F.ceil(df.agg(F.count("*").alias("n")).scalar() * F.lit(test_fraction))
    side = F.when(F.col("__rank") <= wanted, "test").otherwise("train")
    return ranked.withColumn(out, side).drop("__draw", "__rank")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """The first ``n`` rows by draw, then key, ranked in ranges so that ``n`` may be large."""
    drawn = df.withColumn("__draw", _unit_draw(key, seed))
    ranked = global_rank(drawn, "__draw", key, out="__rank", uniform=True)
    return ranked.where(F.col("__rank") <= n).drop("__draw", "__rank")


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    return df.where(drawn_below(_cut(fraction), key, seed=seed))


def _least_of_each(rows: pa.Table, n: int) -> pa.Table:
    """The first ``n`` rows of each stratum by draw, then key."""
    ordered = rows.sort_by([("__stratum", "ascending"), ("__draw", "ascending"), ("__key", "ascending")])
    code = ordered["__stratum"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    first = np.flatnonzero(np.concatenate([[True], np.diff(code) != 0])) if len(code) else np.zeros(0, np.int64)
    nth = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
    return ordered.filter(pa.array(nth < n))


def stratified_sample(df: DataFrame, stratum: str, key: str, n: int, seed: int = 0, parts: int = SAMPLE_PARTS) -> DataFrame:
    """Exactly ``n`` rows of every value of ``stratum``, or all it has: the first by draw of ``key``, then key.

    One pass: each task keeps at most ``n`` rows of a stratum; what tasks have kept is merged in ``parts`` parts of
    each stratum, then by stratum, so a stratum's final task sees at most ``n * parts`` rows, however many it has. NULL is a stratum.
    Rows alike in key are taken in any order.
    """
    names = [f.name for f in df.schema]
    drawn = df.select(
        *[F.col(c) for c in names], F.col(stratum).cast("string").alias("__stratum"), draw(key, seed=seed).alias("__draw"),
        F.col(key).alias("__key"),
    )

    def keep(batches):
        held, size = [], 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= HELD_ROWS:
                held = [_least_of_each(pa.concat_tables(held), n)]
                size = held[0].num_rows
                if size > HELD_ROWS // 2:
                    # many strata: pass them on
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from _least_of_each(pa.concat_tables(held), n).to_batches()

    kept = drawn.mapInArrow(keep, schema=drawn.schema)
    merged = kept.repartition("__stratum", F.pmod(F.xxhash64("__draw", "__key"), F.lit(parts))).mapInArrow(keep, schema=drawn.schema)
    last = merged.repartition("__stratum").sortWithinPartitions("__stratum", "__draw", "__key")
    nth = F.row_number().over(W.partitionBy("__stratum").orderBy("__draw", "__key"))
    return last.withColumn("__nth", nth).where(F.col("__nth") <= n).select(*names)


def shuffle_rows(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    return df.orderBy(draw(key, seed=seed), key)


def rebalance(df: DataFrame, key: str, n: int, label: str = "match", seed: int = 0) -> DataFrame:
    """All positive rows together with ``n`` rows sampled from the whole table."""
    return df.where(F.col(label) == 1).unionByName(sample_rows(df, key, n, seed))


def rebalance_fraction(
    df: DataFrame, key: str, fraction: float, label: str = "match", seed: int = 0
) -> DataFrame:
    """All positive rows together with a hash-drawn share of the whole table."""
    return df.where(F.col(label) == 1).unionByName(sample_fraction(df, key, fraction, seed))


def mask_tokens(tokens: Column | str, key: Column | str, rate: float = MASK_RATE, seed: int = 0) -> Column:
    """``array<struct<token, label>>``: drawn tokens become the mask token, labels stay.

    The draw of a token depends on the row's key and the token's position.
    Special tokens are never masked.
    """
    items = F.col(tokens) if isinstance(tokens, str) else tokens
    row = F.col(key) if isinstance(key, str) else key

    def mask(token: Column, pos: Column) -> Column:
        drawn = drawn_below(_cut(rate), row, pos, seed=seed) & ~token.isin(*SPECIAL_TOKENS)
        return F.struct(F.when(drawn, F.lit(MASK_TOKEN)).otherwise(token).alias("token"), token.alias("label"))

    return F.transform(items, mask)
