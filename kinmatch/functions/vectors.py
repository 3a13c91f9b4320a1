"""Column expressions over vectors stored as arrays of numbers."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Floor of the pooled mask sum and of the squared distance.
MASK_FLOOR = 1e-9
SQUARED_DISTANCE_FLOOR = 1e-7
# Weight of a masked token in a mean: far below the rounding of one seen token.
MASKED_WEIGHT = 1e-100
# Similarities are rounded before they are ranked, so that the summation order
# of one engine or one task cannot change which neighbour wins a tie.
SIMILARITY_DIGITS = 9


def as_double(v: Column | str) -> Column:
    return (F.col(v) if isinstance(v, str) else v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    squares = F.transform(as_double(a), lambda x: x * x)
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def l2_normalize(a: Column | str) -> Column:
    """Unit vector; the zero vector stays zero."""
    length = norm(a)
    return F.transform(as_double(a), lambda x: F.when(length > 0, x / length).otherwise(x))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale).otherwise(F.lit(0.0))


def angular_from_cosine(cos: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) - F.lit(2.0) * cos))


def angular_distance(a: Column | str, b: Column | str) -> Column:
    return angular_from_cosine(cosine(a, b))


def euclidean(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance whose square is kept off zero."""
    squares = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    total = F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(total, F.lit(SQUARED_DISTANCE_FLOOR)))


def negative_mean_product(a: Column | str, b: Column | str) -> Column:
    """Minus the mean of the element products of the two unit vectors."""
    return -cosine(a, b) / F.size(as_double(a))


def contrastive_term(label: Column | str, distance: Column | str, margin: float = 1.0) -> Column:
    y = F.col(label) if isinstance(label, str) else label
    d = F.col(distance) if isinstance(distance, str) else distance
    gap = F.greatest(F.lit(margin) - d, F.lit(0.0))
    return y * d * d + (F.lit(1) - y) * gap * gap


def cosine_loss_term(label: Column | str, cos: Column | str) -> Column:
    y = F.col(label) if isinstance(label, str) else label
    c = F.col(cos) if isinstance(cos, str) else cos
    return (c - y) * (c - y)


def pair_losses(
    pairs: DataFrame, a: str = "vec1", b: str = "vec2", label: str = "match", margin: float = 1.0
) -> DataFrame:
    """One row: contrastive loss and cosine-similarity loss over labelled vector pairs."""
    return mean_losses(pairs.select(F.col(label).cast("double").alias("y"), euclidean(a, b).alias("d"), cosine(a, b).alias("c")), margin)


def mean_losses(terms: DataFrame, margin: float = 1.0) -> DataFrame:
    """The losses over ``(y, d, c)``: label, Euclidean distance and cosine of each pair."""
    return terms.agg(
        F.avg(contrastive_term("y", "d", margin)).alias("contrastive_loss"),
        F.avg(cosine_loss_term("y", "c")).alias("cosine_loss"),
    )


def mean_pool(tokens: DataFrame, key: str = "id", vec: str = "vec", mask: str = "mask") -> DataFrame:
    """Masked mean of token vectors, long rows in, one ``(key, vec)`` out.

    Vectors are summed on the map side, one partial sum per key and task, however
    many tokens a key has. A key whose tokens are all masked gets a zero vector:
    masked tokens count as zero vectors of a vanishing weight.
    """
    seen = F.coalesce(F.col(mask).cast("double"), F.lit(0.0))
    point = F.transform(as_double(vec), lambda x: F.when(seen > 0, x).otherwise(F.lit(0.0)))
    weighted = tokens.select(
        key, array_to_vector(point).alias("__v"), F.greatest(seen, F.lit(MASKED_WEIGHT)).alias("__w")
    )
    mean = Summarizer.mean(F.col("__v"), F.col("__w"))
    return weighted.groupBy(key).agg(vector_to_array(mean).alias("vec"))


def mean_pool_nested(tokens: Column | str, dims: int) -> Column:
    """Masked mean inside one row, over ``array<struct<mask, vec>>``."""
    items = F.col(tokens) if isinstance(tokens, str) else tokens
    zero = F.array_repeat(F.lit(0.0), dims)
    total = F.aggregate(
        items,
        zero,
        lambda acc, t: F.zip_with(acc, as_double(t["vec"]), lambda x, y: x + y * t["mask"]),
    )
    count = F.aggregate(items, F.lit(0.0), lambda acc, t: acc + t["mask"].cast("double"))
    return F.transform(total, lambda x: x / F.greatest(count, F.lit(MASK_FLOOR)))


def first_token_pool(
    tokens: DataFrame, key: str = "id", pos: str = "pos", vec: str = "vec"
) -> DataFrame:
    """Vector of each key's first token."""
    return tokens.groupBy(key).agg(F.min_by(vec, pos).alias("vec"))
