"""Candidate pairs: neighbours within a distance that also agree on attributes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import require_columns
from .knn import knn_join, knn_self
from .rows import canonical_pairs, lookup_both

# Attribute rule of the blocker.
EITHER_COLUMNS = ("volume", "weight")
SAME_COLUMNS = ("quantity",)
DIFFERENT_COLUMNS = ("outlet_id",)


def within_distance(dist: Column | str, threshold: float | None) -> Column:
    """``dist < 2 - 2 * threshold``; always true when the threshold is 0 or None."""
    d = F.col(dist) if isinstance(dist, str) else dist
    return d < F.lit(2.0 - 2.0 * threshold) if threshold else F.lit(True)


def _equal(column: str) -> Column:
    return F.coalesce(F.col(f"{column}1") == F.col(f"{column}2"), F.lit(False))


def _different(column: str) -> Column:
    """True when either side is NULL, as a missing value differs from everything."""
    return F.coalesce(F.col(f"{column}1") != F.col(f"{column}2"), F.lit(True))


def attributes_agree(
    either: Sequence[str] = EITHER_COLUMNS,
    same: Sequence[str] = SAME_COLUMNS,
    different: Sequence[str] = DIFFERENT_COLUMNS,
) -> Column:
    """Any of ``either`` equal, all of ``same`` equal, all of ``different`` not equal.

    A predicate over columns suffixed 1 and 2; NULL equals nothing.
    """
    tests = [_equal(c) for c in same] + [_different(c) for c in different]
    if either:
        tests.append(reduce(Column.__or__, [_equal(c) for c in either]))
    return reduce(Column.__and__, tests, F.lit(True))


def dims_equal_pairs(
    pairs: DataFrame, products: DataFrame,
    either: Sequence[str] = EITHER_COLUMNS, same: Sequence[str] = SAME_COLUMNS,
) -> DataFrame:
    """Pairs whose members agree on the sizes, whatever their outlet."""
    sided = lookup_both(pairs, products, [*either, *same], how="inner")
    return sided.where(attributes_agree(either, same, ())).select(*pairs.columns)


def block_pairs(
    products: DataFrame,
    top_k: int = 100,
    threshold: float | None = 0.25,
    *,
    vec: str = "vec",
    either: Sequence[str] = EITHER_COLUMNS,
    same: Sequence[str] = SAME_COLUMNS,
    different: Sequence[str] = DIFFERENT_COLUMNS,
    **search,
) -> DataFrame:
    """Distinct canonical candidate pairs ``id1 < id2``.

    The attribute rule runs on the neighbours already found (``top_k`` counts
    the row itself), never on all pairs of the table.
    """
    columns = [*either, *same, *different]
    require_columns(products, ["id", vec, *columns], "block_pairs")
    near = knn_join(products, products, top_k - 1, vec=vec, without_self=True, **search)
    # a pair found from both ends is looked up once
    pairs = canonical_pairs(near.where(within_distance("dist", threshold)), "q_id", "b_id")
    sided = lookup_both(pairs, products, columns, how="inner")
    return sided.where(attributes_agree(either, same, different)).select("id1", "id2")


def block_to_masters(
    products: DataFrame,
    masters: DataFrame,
    top_k: int = 100,
    threshold: float = 0.25,
    *,
    vec: str = "vec",
    category: str = "product_category_id",
    **search,
) -> DataFrame:
    """Candidate (product, master) pairs of the same category, with both names.

    The category test follows the top-k, so a product may end up with fewer.
    """
    for df, side in ((products, "products"), (masters, "masters")):
        require_columns(df, ["id", "name", vec, category], f"block_to_masters {side}")
    hits = knn_join(products, masters, top_k, vec=vec, **search).where(F.col("sim") > threshold)
    left = products.select(
        F.col("id").alias("id1"), F.col("name").alias("sent1"), F.col(category).alias("__c1")
    )
    right = masters.select(
        F.col("id").alias("id2"), F.col("name").alias("sent2"), F.col(category).alias("__c2")
    )
    # an id that a table lists more than once gives its pairs once
    return (
        hits.select(F.col("q_id").alias("id1"), F.col("b_id").alias("id2"))
        .join(left, "id1")
        .join(right, "id2")
        .where(F.col("__c1") == F.col("__c2"))
        .na.drop(subset=["sent1", "sent2"])
        .select("id1", "id2", "sent1", "sent2")
        .dropDuplicates(["id1", "id2"])
    )


def list_neighbours(products: DataFrame, top_k: int = 100, *, vec: str = "vec", **search) -> DataFrame:
    """Neighbours of every product with their names and distances."""
    near = knn_self(products, top_k, vec=vec, **search)
    names = products.select(F.col("id").alias("nn_id"), F.col("name").alias("nn_name"))
    return near.join(names, "nn_id", "left").select("id", "rank", "nn_id", "nn_name", "dist")
