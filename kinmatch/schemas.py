"""Table schemas, status codes and the column check used at operator entry."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(), "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema from ``name TYPE, …``, without a running session."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PRODUCTS = _struct(
    "id BIGINT, name STRING, description STRING, price DOUBLE, weight BIGINT, volume BIGINT, "
    "quantity INT, uom STRING, outlet_id BIGINT, product_category_id BIGINT, "
    "main_category STRING, sub_category STRING, master_product_id BIGINT, master_product STRING"
)
MASTER_PRODUCTS = _struct(
    "id BIGINT, name STRING, description STRING, weight DOUBLE, volume DOUBLE, quantity DOUBLE, "
    "uom STRING, is_deleted BOOLEAN, product_category_id BIGINT"
)
PAIRS = _struct("id1 BIGINT, id2 BIGINT")
LABELLED_PAIRS = _struct("id1 BIGINT, id2 BIGINT, match INT")
SCORED_PAIRS = _struct("id1 BIGINT, id2 BIGINT, match INT, prob DOUBLE")
CLUSTERS = _struct("id BIGINT, cluster BIGINT")
PRODUCT_CLUSTERS = _struct(
    "id BIGINT, internal_product_id BIGINT, product_source_id BIGINT, master_product_id BIGINT, "
    "cluster_id BIGINT, master_product_status_id INT, created_at TIMESTAMP"
)
STATUS_HISTORIES = _struct(
    "master_product_cluster_id BIGINT, previous_status_id INT, current_status_id INT"
)
MATCHES_CACHE = _struct(
    "product_source_id_1 BIGINT, product_source_id_2 BIGINT, match INT, prob DOUBLE, model_id BIGINT"
)
MODELS = _struct(
    "id BIGINT, name STRING, blob STRING, in_use BOOLEAN, tag STRING, created_at TIMESTAMP"
)

# Status codes of the cluster table.
STATUS_UNNAMED_CLUSTER = 1
STATUS_ACCEPTED = 2
STATUS_REMATCH = 3
STATUS_NOT_USED = 4
STATUS_SUGGESTION = 5


def require_columns(df: DataFrame, columns: Iterable[str], operator: str) -> None:
    """Fail early, naming the operator, when an input lacks a column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{operator}: missing column(s) {missing}; input has {df.columns}")
