"""Helpers shared by the corpus operators: row-wise Arrow columns and stored stages."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ..session import scratch_path, use_all_cores


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with costly row work ahead; only one of few partitions is dealt out."""
    return use_all_cores(table(spark, folder, name))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a stage as Parquet to the shared folder and read it back.

    What comes after does not compute the stage again, also when executors are lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def single_threaded() -> None:
    """One task is one core: native libraries must not start threads of their own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def per_worker(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once per Python process: later tasks of the same worker find it again.

    Functions travel to the workers whole, with globals of their own; only a module of the process outlives a task.
    """
    kept = sys.modules.setdefault("_kinmatch_kept", types.ModuleType("_kinmatch_kept"))
    found = kept.__dict__.setdefault("found", {})
    if key not in found:
        found.clear()  # one at a time bounds the memory
        found[key] = make()
    return found[key]


def with_columns(
    df: DataFrame, inputs: list[str], schema: str, make: Callable[[], Callable[[pa.RecordBatch], list]]
) -> DataFrame:
    """Add columns computed from ``inputs`` by a function over Arrow batches.

    ``make`` runs once per task and returns the function, which gives one list or
    array per column of ``schema``. Other columns pass through as they are; columns
    of the same names are replaced. No shuffle: a row stays where it is.
    """
    added = StructType.fromDDL(schema)
    clash = {n.lower() for n in added.names}
    kept = [c for c in df.columns if c.lower() not in clash]
    # inputs travel beside the kept columns under names of their own
    source = df.select(*[df[c] for c in kept], *[df[c].alias(f"__in_{i}") for i, c in enumerate(inputs)])
    fields = StructType([*source.schema.fields[: len(kept)], *added.fields])

    types = [to_arrow_type(f.dataType) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            new = [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(work(batch), types)]
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=fields.names)

    return source.mapInArrow(run, schema=fields)


def _at(folder: str):
    from pyarrow import fs

    named = "://" in folder or folder.startswith("file:")
    return fs.FileSystem.from_uri(folder) if named else (fs.LocalFileSystem(), folder)


def make_folder(folder: str) -> None:
    system, root = _at(folder)
    system.create_dir(root, recursive=True)


def put_file(folder: str, name: str, data: bytes) -> None:
    """Write one file under a shared folder, visible under its name only when whole."""
    system, root = _at(folder)
    with system.open_output_stream(f"{root}/{name}.part") as out:
        out.write(data)
    system.move(f"{root}/{name}.part", f"{root}/{name}")


def get_file(folder: str, name: str) -> bytes:
    system, root = _at(folder)
    with system.open_input_stream(f"{root}/{name}") as source:
        return source.read()


def drop_file(folder: str, name: str) -> None:
    system, root = _at(folder)
    system.delete_file(f"{root}/{name}")
