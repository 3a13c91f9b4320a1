"""Product preparation shared by all jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    base_name,
    display_unit,
    extract_quantity,
    extract_sku,
    extract_volume,
    extract_weight,
    name_description,
)
from ..operators.rows import (
    attach_masters,
    dense_ids,
    drop_missing,
    duplicated_groups,
    first_per_key,
    groups_with,
)
from ..schemas import require_columns
from ..session import cut_lineage

# Fixed value: a SKU has to mark more than this many offers to name a master.
SKU_MIN_OFFERS = 8


def with_base_names(masters: DataFrame) -> DataFrame:
    """Live masters with their display unit and the name without it."""
    live = masters.where(~F.col("is_deleted")) if "is_deleted" in masters.columns else masters
    units = live.withColumn("display_unit", display_unit())
    return units.withColumn("base", base_name("name", "display_unit"))


def preprocess(
    products: DataFrame, masters: DataFrame | None = None, order: Column | str = "name"
) -> tuple[DataFrame, DataFrame]:
    """``(products, labelled)``: one row per id, complete, with the master's names.

    ``order`` decides which of several rows with one id is the first. Without a
    master column the labelled output is empty.
    """
    require_columns(products, ["id", "name", "description"], "preprocess")
    clean = drop_missing(first_per_key(products, "id", order), ["id", "name", "description"])
    if "master_product_id" not in products.columns or masters is None:
        return clean, clean.limit(0)
    named = attach_masters(clean, with_base_names(masters).select("id", "name", "base"))
    return named, named.where(F.col("master_product").isNotNull())


def product_regex(products: DataFrame, litre_fix: bool = False, strict_kg: bool = False) -> DataFrame:
    """Add quantity, volume (ml) and weight (g) read from name and description."""
    require_columns(products, ["name", "description"], "product_regex")
    text = products.withColumn("__text", name_description("name", "description"))
    return text.withColumns(
        {
            "quantity": extract_quantity("__text"),
            "volume": extract_volume("__text", litre_fix),
            "weight": extract_weight("__text", strict_kg),
        }
    ).drop("__text")


def masters_from_sku(products: DataFrame, seq: str = "id", min_offers: int = SKU_MIN_OFFERS) -> DataFrame:
    """Label offers by the SKU in their description.

    The first offer of each SKU is left out, as are SKUs with one offer left; the
    others are numbered by first appearance, and those with more than
    ``min_offers`` offers stay.
    """
    # stored once: the steps below read the rows with a SKU several times
    found = cut_lineage(
        products.withColumn("sku", extract_sku("description")).where(F.col("sku").isNotNull())
    )
    repeated = cut_lineage(duplicated_groups(found, "sku", seq))
    # numbered by every repeated SKU's first remaining offer
    numbered = dense_ids(repeated, "sku", seq, "master_product")
    return groups_with(numbered, "sku", min_offers + 1)
