"""User-defined generators of rows, callable from SQL over a partitioned table."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf


def register_generator(
    spark: SparkSession, name: str, returns: str, each: Callable[[pa.RecordBatch], pa.Table],
    last: Callable[[], pa.Table] | None = None,
) -> None:
    """Make a function over Arrow batches a table function: ``SELECT * FROM name(TABLE(t) PARTITION BY p ORDER BY o)``.

    ``each`` gets the rows of one partition batch by batch, in order, and returns rows of the
    schema ``returns`` for each of them, as many as it likes; ``last`` may add rows at a partition's end. So a
    partition of any size is never held whole. Both are functions without memory: each partition is on its own.
    """

    class Generator:
        def eval(self, rows: pa.RecordBatch):
            yield each(rows)

        def terminate(self):
            if last is not None:
                yield last()

    spark.udtf.register(name, arrow_udtf(Generator, returnType=returns))
