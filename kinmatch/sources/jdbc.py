"""SQL database source and sink through Spark's JDBC connector."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

# Environment variable that may hold the connection string.
ENDPOINT_VARIABLE = "KINMATCH_JDBC_URL"


def endpoint(url: str | None = None) -> str:
    """The given JDBC URL, else the one in the environment."""
    url = url or os.environ.get(ENDPOINT_VARIABLE)
    if not url:
        raise ValueError(f"give a JDBC url or set {ENDPOINT_VARIABLE}")
    return url if url.startswith("jdbc:") else f"jdbc:{url}"


def query_options(query: str, url: str | None = None, *, partition_column: str | None = None,
                  lower: int | None = None, upper: int | None = None, partitions: int | None = None,
                  fetch_rows: int = 10_000) -> dict[str, str]:
    """Reader options of a query. With a partition column the query is read in parallel ranges."""
    options = {"url": endpoint(url), "fetchsize": str(fetch_rows)}
    if partition_column is None:
        return {**options, "query": query}
    if lower is None or upper is None or partitions is None:
        raise ValueError("a partitioned read needs lower, upper and partitions")
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_query(spark: SparkSession, query: str, url: str | None = None, **partitioning) -> DataFrame:
    reader: DataFrameReader = spark.read.format("jdbc")
    return reader.options(**query_options(query, url, **partitioning)).load()


def save_table(df: DataFrame, table: str, url: str | None = None, if_exists: str = "append",
               batch_rows: int = 10_000) -> None:
    """Write a frame to a database table: ``append``, ``replace`` or ``fail``."""
    modes = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}
    if if_exists not in modes:
        raise ValueError(f"if_exists must be one of {sorted(modes)}")
    options = {"url": endpoint(url), "dbtable": table, "batchsize": str(batch_rows)}
    df.write.format("jdbc").mode(modes[if_exists]).options(**options).save()
