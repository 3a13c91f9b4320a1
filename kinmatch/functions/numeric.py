"""Scores, z-scores and reproducible hash draws as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def score_to_label(prob: Column | str, threshold: float) -> Column:
    """1 when the score is strictly above the threshold, else 0."""
    return (_col(prob) > F.lit(threshold)).cast("int")


def softmax_positive(logit0: Column | str, logit1: Column | str) -> Column:
    """Probability of the second of two classes, shifted by the larger logit."""
    a, b = _col(logit0), _col(logit1)
    top = F.greatest(a, b)
    return F.exp(b - top) / (F.exp(a - top) + F.exp(b - top))


def argmax_class(logit0: Column | str, logit1: Column | str) -> Column:
    return F.when(_col(logit1) > _col(logit0), 1).otherwise(0)


def add_zscore(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Standard score with the population deviation; a constant column becomes 0.

    Mean and deviation enter as scalar subqueries: literals at run time, no join.
    """
    stats = df.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s"))
    mean, dev = stats.select("m").scalar(), stats.select("s").scalar()
    z = (F.col(column) - mean) / F.when(dev == 0, F.lit(1.0)).otherwise(dev)
    return df.withColumn(out or column, z)


# Draws are whole numbers below 2**32: the first hex digits of an MD5 sum.
DRAW_DIGITS = 8
DRAW_MODULUS = 1 << 4 * DRAW_DIGITS


def draw(*keys: Column | str, seed: int = 0) -> Column:
    """Uniform draw in [0, DRAW_MODULUS) fixed by the keys and the seed, the same in any engine.

    Keys are taken as text, joined by ``:`` with the seed last; a NULL key counts as empty.
    """
    text = F.concat_ws(":", *[F.coalesce(_col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, DRAW_DIGITS), 16, 10).cast("bigint")


def drawn_below(cut: int, *keys: Column | str, seed: int = 0) -> Column:
    """Whether :func:`draw` of the keys is below ``cut``; hex digits compare like the numbers they spell."""
    if cut >= DRAW_MODULUS:
        return F.lit(True)
    text = F.concat_ws(":", *[F.coalesce(_col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.substring(F.md5(text), 1, DRAW_DIGITS) < F.lit(f"{max(0, cut):0{DRAW_DIGITS}x}")


def hash_draw(*keys: Column | str, seed: int = 0) -> Column:
    """Uniform draw in [0, 1) from a 64-bit hash of any columns."""
    h = F.xxhash64(*[_col(k) for k in keys], F.lit(seed))
    return F.shiftrightunsigned(h, 11) / F.lit(float(2**53))
