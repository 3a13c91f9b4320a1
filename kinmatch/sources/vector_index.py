"""A saved vector index: the pivots and the base vectors sorted by cell, as Parquet; and one that grows by runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numeric import hash_draw
from ..operators.knn import (
    MAX_PIVOTS, NO_FLOOR, RECALL, Cells, _lifted, _matrix, _nearest_cells, _route, _steps, assign_cells, knn_in_cells, pick_pivots,
    probes_for_recall, sound,
)
from ..session import cut_lineage

# Folders that the cells of an index are written to; a probe reads only those it needs.
GROUPS = 256
# Neighbours for which an index measures how many cells must be probed.
MEASURED_K = 10
# A cell is split once it holds this many times as many rows as cells hold on average, and at least as many rows.
OVERFULL, LEAST_ROWS = 4.0, 64


def _group(cell: Column | str = "cell") -> Column:
    return F.pmod(F.col(cell) if isinstance(cell, str) else cell, F.lit(GROUPS)).cast("int")


def _base(items: DataFrame, id: str, vec: str) -> DataFrame:
    return items.where(sound(vec) & F.col(id).isNotNull()).select(F.col(id).cast("bigint").alias("b_id"), F.col(vec).alias("b_vec"))


def _as_queries(base: DataFrame, k: int) -> DataFrame:
    return base.select(F.col("b_id").alias("q_id"), F.col("b_vec").alias("q_vec"), F.lit(k).alias("k"), F.lit(NO_FLOOR).alias("floor"))


def build_index(items: DataFrame, *, id: str = "id", vec: str = "vec") -> Cells:
    """Pick pivots and assign every vector to its cell.

    Vectors that are NULL or hold a NULL, NaN or infinite component are left out. An empty table gives an index without cells.
    """
    base = _base(items, id, vec)
    pivots = pick_pivots(base, base.count())
    return Cells(pivots, assign_cells(base, pivots))


def save_index(cells: Cells, spark: SparkSession, path: str, *, k: int = MEASURED_K, recall: float = RECALL) -> None:
    """Vectors in one folder per group of cells, sorted by cell within it, and the probes that ``recall`` needs.

    These are measured with a sample of the index's own vectors and their ``k`` nearest others.
    """
    by_cell = cells.base.repartitionByRange("cell", "b_id").sortWithinPartitions("cell", "b_id")
    by_cell.withColumn("cell_group", _group()).write.mode("overwrite").partitionBy("cell_group").parquet(f"{path}/vectors")
    stored = _stored_vectors(spark, f"{path}/vectors", cells.base.schema["b_vec"].dataType.simpleString())
    probes = probes_for_recall(_as_queries(stored, k), Cells(cells.pivots, stored), k, without_self=True, recall=recall)
    _write_cells(spark, path, cells.pivots, cells.roots, probes)


def _write_cells(spark: SparkSession, path: str, pivots: np.ndarray, roots: np.ndarray | None, probes: int) -> None:
    roots = np.arange(len(pivots)) if roots is None else roots
    table = pa.table({
        "cell": pa.array(np.arange(len(pivots)), pa.int32()), "pivot": pa.array(list(pivots), pa.list_(pa.float64())),
        "root": pa.array(roots, pa.int32()), "probes": pa.array(np.full(len(pivots), probes), pa.int32()),
    })
    spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")


def _read_cells(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray, int | None]:
    rows = spark.read.parquet(f"{path}/pivots").orderBy("cell").toArrow()
    pivots = np.array(rows["pivot"].to_pylist() or np.zeros((0, 1)), dtype=np.float64)
    return pivots, rows["root"].to_numpy(), rows["probes"][0].as_py() if rows.num_rows else None


def _stored_vectors(spark: SparkSession, path: str, vec: str) -> DataFrame:
    return spark.read.schema(f"b_id bigint, b_vec {vec}, cell int, pivot_dist double, cell_group int").parquet(path)


def load_index(spark: SparkSession, path: str) -> Cells:
    pivots, roots, probes = _read_cells(spark, path)
    found = spark.read.parquet(f"{path}/vectors") if len(pivots) else _stored_vectors(spark, f"{path}/vectors", "array<float>")
    return Cells(pivots, found, roots, probes)


def search_index(cells: Cells, queries: DataFrame, k: int, *, id: str = "id", vec: str = "vec", **options) -> DataFrame:
    """Neighbours of the queries in a saved index, as :func:`kinmatch.operators.knn.knn_join` gives them.

    An ``ivf`` search probes as many cells as were measured when the index was saved, unless ``probes`` says
    otherwise, and reads only the folders of the cells that its queries probe. Vectors that are not sound have no neighbours.
    """
    q = _as_queries(_base(queries, id, vec), k)
    if options.get("strategy") == "ivf" and len(cells.pivots):
        options["probes"] = options.get("probes") or cells.probes or 8
        if "cell_group" in cells.base.columns:
            probed = _route(q, len(cells.pivots), _nearest_cells(cells.pivots, options["probes"]))
            groups = [r["g"] for r in probed.select(_group().alias("g")).distinct().collect()]  # at most GROUPS
            cells = Cells(cells.pivots, cells.base.where(F.col("cell_group").isin(groups)), cells.roots, cells.probes)
    return knn_in_cells(q, cells, most=k, **options)


def _assign_in_families(base: DataFrame, pivots: np.ndarray, roots: np.ndarray) -> DataFrame:
    """The nearest root of every row, then the nearest of this root and the cells split from it."""
    first = np.unique(roots)

    def assign(batches):
        for batch in batches:
            points = _lifted(_matrix(batch.column("b_vec")))
            for rows in _steps(len(points), len(pivots)):
                sim = points[rows] @ pivots.T
                root = first[sim[:, first].argmax(axis=1)]
                cell = np.where(roots[None, :] == root[:, None], sim, -np.inf).argmax(axis=1)
                part = batch.slice(rows.start, rows.stop - rows.start)
                near = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * sim[np.arange(len(cell)), cell]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("b_id"), part.column("b_vec"), pa.array(cell, pa.int32()), pa.array(near, pa.float64())],
                    names=["b_id", "b_vec", "cell", "pivot_dist"],
                )

    vec = base.schema["b_vec"].dataType.simpleString()
    return base.select("b_id", "b_vec").mapInArrow(assign, schema=f"b_id bigint, b_vec {vec}, cell int, pivot_dist double")


class GrowingIndex:
    """A saved index to which runs add, replace and delete vectors.

    Every run is a segment of its own: the vectors that it brings, with their cells, and the
    ids that it brings or deletes. A vector counts unless a later segment names its id. What runs
    name is small beside the index, so these ids are joined against all rows; :meth:`merge` writes
    all that counts into one segment again. Cells that have become too large are split by :meth:`split`
    into parts around new pivots, and their rows alone are written anew. Every change ends with a new
    version in ``<path>/versions``, a list of segments; until then readers see the one before, and a change that failed may be repeated.
    """

    def __init__(self, spark: SparkSession, path: str, vec: str = "array<float>"):
        self.spark, self.path, self.vec = spark, path, vec

    # ---- versions: (segment, place in their order, folder of the cells); a few rows

    def _write_version(self, version: int, segments: list[str], cells: str) -> None:
        rows = [(s, n, cells) for n, s in enumerate(segments)]
        frame = self.spark.createDataFrame(rows, "segment string, nth int, cells string")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/version={version}")

    def segments(self, version: int) -> tuple[list[str], str]:
        rows = self.spark.read.parquet(f"{self.path}/versions/version={version}").orderBy("nth").collect()
        return [r["segment"] for r in rows], rows[0]["cells"]

    def _write_segment(self, name: str, rows: DataFrame, named: DataFrame) -> None:
        by_cell = rows.select("b_id", "b_vec", "cell", "pivot_dist").repartitionByRange("cell", "b_id").sortWithinPartitions("cell", "b_id")
        by_cell.withColumn("cell_group", _group()).write.mode("overwrite").partitionBy("cell_group").parquet(f"{self.path}/segments/{name}/vectors")
        named.select(F.col("b_id")).distinct().write.mode("overwrite").parquet(f"{self.path}/segments/{name}/named")

    def cells(self, version: int) -> Cells:
        """The vectors that count after a version, with their cells."""
        segments, folder = self.segments(version)
        pivots, roots, probes = _read_cells(self.spark, f"{self.path}/cells/{folder}")
        rows = named = None
        for n, name in enumerate(segments):
            part = _stored_vectors(self.spark, f"{self.path}/segments/{name}/vectors", self.vec).withColumn("nth", F.lit(n))
            rows = part if rows is None else rows.unionAll(part)
            if n:
                ids = self.spark.read.schema("b_id bigint").parquet(f"{self.path}/segments/{name}/named").withColumn("nth", F.lit(n))
                named = ids if named is None else named.unionAll(ids)
        if named is not None:
            # the last segment that names an id
            last = named.groupBy("b_id").agg(F.max("nth").alias("last"))
            rows = rows.join(last, "b_id", "left").where("last IS NULL OR nth >= last").drop("last")
        return Cells(pivots, rows.drop("nth"), roots, probes)

    def create(self, items: DataFrame, *, id: str = "id", vec: str = "vec") -> int:
        """Version 0: pivots from these vectors, and all of them. An empty table cannot start an index."""
        base = _base(items, id, vec).dropDuplicates(["b_id"])
        base = cut_lineage(base)
        pivots = pick_pivots(base, base.count())
        if not len(pivots):
            raise ValueError("an index needs at least one vector")
        self._write_segment("v0", assign_cells(base, pivots), base)
        _write_cells(self.spark, f"{self.path}/cells/v0", pivots, None, 0)
        self._write_version(0, ["v0"], "v0")
        self._measure(0, "v0")
        return 0

    def _measure(self, version: int, folder: str) -> None:
        """Note how many probes the present vectors need; kept in memory until written, as it replaces what it reads."""
        found = self.cells(version)
        probes = probes_for_recall(_as_queries(found.base, MEASURED_K), found, MEASURED_K, without_self=True)
        _write_cells(self.spark, f"{self.path}/cells/{folder}", found.pivots, found.roots, probes)

    def change(self, version: int, items: DataFrame, deleted: DataFrame | None = None, *, id: str = "id", vec: str = "vec") -> int:
        """The next version: vectors that come or take the place of those with their id, and ids that go.

        An id in both comes. Rows whose vector is not sound delete theirs. Of rows that share an id one is kept.
        """
        segments, folder = self.segments(version)
        pivots, roots, _ = _read_cells(self.spark, f"{self.path}/cells/{folder}")
        ids = items.where(F.col(id).isNotNull()).select(F.col(id).cast("bigint").alias("b_id"))
        if deleted is not None:
            ids = ids.unionAll(deleted.where(F.col(id).isNotNull()).select(F.col(id).cast("bigint").alias("b_id")))
        base = cut_lineage(_base(items, id, vec).groupBy("b_id").agg(F.min("b_vec").alias("b_vec")))
        name = f"v{version + 1}"
        self._write_segment(name, _assign_in_families(base, pivots, roots), ids)
        self._write_version(version + 1, [*segments, name], folder)
        return version + 1

    def split(self, version: int, overfull: float = OVERFULL, least_rows: int = LEAST_ROWS) -> int:
        """The next version, with cells of more than ``overfull`` times the average rows parted around new pivots.

        Only the rows of these cells are assigned again; they come as a segment of their own. The number of
        probes is measured anew. Without such a cell the version stays.
        """
        found = self.cells(version)
        sizes = {r["cell"]: r["n"] for r in found.base.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row per cell
        average = sum(sizes.values()) / max(1, len(found.pivots))
        large = sorted(c for c, n in sizes.items() if n > max(least_rows, overfull * average))
        if not large:
            return version
        rows = cut_lineage(found.base.where(F.col("cell").isin(large)))
        # a large cell gets about one pivot more for each average cell that it holds, while there is room for pivots
        wanted, room = [], MAX_PIVOTS - len(found.pivots)
        for cell in large:
            wanted.append((cell, min(room, max(1, round(sizes[cell] / max(1.0, average))))))
            room -= wanted[-1][1]
        numbers = self.spark.createDataFrame(wanted, "cell int, wanted int")
        nth = F.row_number().over(W.partitionBy("cell").orderBy(hash_draw("b_vec"), "b_vec"))
        drawn = rows.select("cell", "b_vec").distinct().withColumn("nth", nth).where(F.col("nth") <= max(n for _, n in wanted))
        new = drawn.join(F.broadcast(numbers), "cell").where("nth <= wanted").orderBy("cell", "nth").toArrow()  # at most MAX_PIVOTS
        pivots = np.concatenate([found.pivots, _lifted(_matrix(new["b_vec"]))])
        roots = np.concatenate([found.roots, found.roots[new["cell"].to_numpy()]])
        segments, name = self.segments(version)[0], f"v{version + 1}"
        again = _assign_in_families(rows.select("b_id", "b_vec"), pivots, roots)
        self._write_segment(name, again, rows)
        _write_cells(self.spark, f"{self.path}/cells/{name}", pivots, roots, 0)
        self._write_version(version + 1, [*segments, name], name)
        self._measure(version + 1, name)
        return version + 1

    def merge(self, version: int) -> int:
        """The next version: all that counts as one segment."""
        found, name = self.cells(version), f"v{version + 1}"
        self._write_segment(name, found.base, found.base)
        self._write_version(version + 1, [name], self.segments(version)[1])
        return version + 1

    def search(self, version: int, queries: DataFrame, k: int, **options) -> DataFrame:
        """As :func:`search_index`; an ``ivf`` search reads only the folders of the cells that it probes."""
        return search_index(self.cells(version), queries, k, **options)
