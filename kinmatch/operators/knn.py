"""k-nearest-neighbour joins over vectors: exact with pruning, or probing a few cells.

Base vectors are assigned to the nearest of a bounded number of pivots (cells).
Queries near the same pivots form chunks of bounded size. A chunk's task holds its
queries and their best ``k`` so far, and base rows stream past it, nearest cells
first; rows of a cell that the triangle inequality rules out against a query's k-th
best are not compared with it. A base row is sent once to a chunk, however many of
the chunk's queries ask for its cell, and a chunk gives each query's best ``k`` only.
Rows that are copies of one vector are searched as one and parted again at the end.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numeric import hash_draw
from ..functions.vectors import SIMILARITY_DIGITS, angular_from_cosine
from ..session import cut_lineage, scratch_path

TILE_ROWS = 32_768
CHUNK_ROWS = 32_768
MIN_CHUNK_ROWS = 128
MAX_PIVOTS = 16_384
MAX_PIVOT_BYTES = 64 << 20
# Numbers held at once by a product of two matrices inside a task.
BLOCK_CELLS = 1 << 20
# Base rows that stream past one chunk in one task, about; more are dealt to several tasks.
STREAM_ROWS = 1 << 21
# Rows to one vector from which on copies are searched as one.
COPIED = 1.5
# Hits that are waiting to be cut to the best k, beside these.
WAITING_HITS = 1 << 20
# Error of a similarity in single precision, for each component.
SINGLE_ERROR = 1.2e-7
# Hits that a block of queries and base rows may find: queries times their largest k.
BLOCK_HITS = 1 << 22
# Slack of the pruning test, well above rounding error and the ranking digits.
BOUND_SLACK = 1e-4
# Cells probed first by the exact search.
PROBES = 8
# Share of a sample's true neighbours that the probes of an ivf search must reach; some more than the 0.9 it is to reach on all.
RECALL = 0.95
# Queries of that sample at least and at most, and neighbours of all of them together.
SAMPLE = (32, 256, 1 << 14)
# Below every similarity: nothing found yet.
NO_FLOOR = -2.0

_HITS = "q_id bigint, b_id bigint, sim double, k int"
_HITS_ARROW = pa.schema(
    [("q_id", pa.int64()), ("b_id", pa.int64()), ("sim", pa.float64()), ("k", pa.int32())]
)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column to a 2-d array of unit rows; zero rows stay zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    m = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
    length = np.sqrt(np.einsum("ij,ij->i", m, m))
    return m / np.where(length > 0, length, 1.0)[:, None]


def _lifted(m: np.ndarray) -> np.ndarray:
    """One more coordinate, 1 for zero rows, so that every row is a unit vector.

    Used for cells and bounds only: a zero row is then at a right angle to every
    other row, which is what cosine 0 means.
    """
    zero = (np.einsum("ij,ij->i", m, m) < 0.5).astype(np.float64)
    return np.hstack([m, zero[:, None]])


def _distance(sim: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * sim))


def _steps(rows: int, width: int, of: int = BLOCK_CELLS):
    """Row ranges whose products with ``width`` columns stay within ``of`` numbers."""
    step = max(1, of // max(1, width))
    return (slice(i, min(i + step, rows)) for i in range(0, rows, step))


def _top_of_row(cost: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of each row's ``k`` cheapest finite cells, ties by column."""
    kth = min(int(k.max()), cost.shape[1])
    limit = np.partition(cost, kth - 1, axis=1)[:, kth - 1]
    row, col = np.nonzero((cost <= limit[:, None]) & np.isfinite(cost))
    by = np.lexsort((col, cost[row, col], row))
    row, col = row[by], col[by]
    starts = np.searchsorted(row, np.arange(len(cost)))
    keep = np.arange(len(row)) - starts[row] < k[row]
    return row[keep], col[keep]


class _Chunk:
    """Queries of one chunk with the best base rows that they have met so far.

    Products are made in single precision; those that may be among a query's best ``k``
    are computed again in double precision. ``sight`` says which cells a query looks into.
    A base row may stand for ``n`` rows: those count before which there are fewer than ``k``.
    """

    def __init__(self, without_self: bool, sight=None):
        self.without_self, self.sight, self.asked, self.ready = without_self, sight, [], False

    def ask(self, rows) -> None:
        self.asked.append((rows.column("q_id").to_numpy(zero_copy_only=False), rows.column("k").to_numpy(), _matrix(rows.column("q_vec"))))

    def _start(self) -> None:
        self.q_id, self.k, self.points = (np.concatenate(x) for x in zip(*self.asked))
        self.asked, self.ready = [], True
        self.single = self.points.astype(np.float32)
        self.slack = (self.points.shape[1] + 4) * SINGLE_ERROR + 10.0**-SIMILARITY_DIGITS
        self.floor = np.full(len(self.q_id), -np.inf)
        self.room = int(self.k.sum())
        self.waiting, self.n_waiting = [], 0
        self.lifted = _lifted(self.points) if self.sight else None
        self.near = self.sight.start(self.lifted) if self.sight else None

    def meet(self, rows) -> None:
        """Compare base rows with the queries that look into their cells."""
        if not rows.num_rows or not self.asked and not self.ready:
            return
        if not self.ready:
            self._start()
        b_id, base = rows.column("b_id").to_numpy(zero_copy_only=False), _matrix(rows.column("b_vec"))
        n_rows = rows.column("n").to_numpy().astype(np.int32) if "n" in rows.schema.names else np.ones(len(b_id), np.int32)
        everyone = np.arange(len(self.q_id))
        if self.sight is None:
            return self._compare(everyone, b_id, base, n_rows)
        cells, of_row = np.unique(rows.column("cell").to_numpy(), return_inverse=True)
        for some in _steps(len(cells), len(everyone)):
            here = np.flatnonzero((of_row >= some.start) & (of_row < some.stop))
            seen = self.sight.cells(self.lifted, self.near, cells[some], self.floor)
            if not self.sight.strict and seen.mean() > 0.5:
                self._compare(everyone, b_id[here], base[here], n_rows[here])
                continue
            for n in np.flatnonzero(seen.any(axis=0)):
                rows_of_cell = here[of_row[here] == n + some.start]
                self._compare(np.flatnonzero(seen[:, n]), b_id[rows_of_cell], base[rows_of_cell], n_rows[rows_of_cell])

    def _compare(self, who: np.ndarray, b_id: np.ndarray, base: np.ndarray, n: np.ndarray) -> None:
        single = base.astype(np.float32)
        for some in _steps(len(b_id), 1, of=2048):
            for part in _steps(len(who), some.stop - some.start):
                self._compare_block(who[part], b_id[some], base[some], single[some], n[some])

    def _compare_block(self, who: np.ndarray, b_id: np.ndarray, base: np.ndarray, single: np.ndarray, n: np.ndarray) -> None:
        sim = self.single[who] @ single.T
        floor = self.floor[who]
        # the query's own row may be one of its best; rows that stand for several reach k sooner
        best = -(-int(self.k[who].max()) // int(n.min())) + 1
        new = np.flatnonzero(np.isinf(floor))
        if len(new) and best < len(b_id):
            floor[new] = np.partition(sim[new], len(b_id) - best, axis=1)[:, len(b_id) - best] - 2 * self.slack
        row, col = np.nonzero(sim >= (floor - self.slack).astype(np.float32)[:, None])
        for some in _steps(len(row), base.shape[1]):
            asking, met = who[row[some]], col[some]
            exact = np.round(np.einsum("ij,ij->i", self.points[asking], base[met]), SIMILARITY_DIGITS) + 0.0
            good = exact >= self.floor[asking]
            if self.without_self:
                good &= self.q_id[asking] != b_id[met]
            self.waiting.append((asking[good].astype(np.int32), b_id[met[good]], exact[good], n[met[good]]))
            self.n_waiting += int(good.sum())
            if self.n_waiting > 2 * self.room + WAITING_HITS:
                self._cut()

    def _cut(self) -> None:
        """Keep each query's best ``k``; with as many, the last of them is its floor."""
        row, b_id, sim, n = (np.concatenate(x) for x in zip(*self.waiting))
        by = np.lexsort((b_id, -sim, row))
        row, b_id, sim, n = row[by], b_id[by], sim[by], n[by]
        starts = np.searchsorted(row, np.arange(len(self.q_id)))
        place = np.arange(len(row)) - starts[row]
        before = np.cumsum(n, dtype=np.int64) - n
        first = np.concatenate([[True], (np.diff(row) != 0) | (np.diff(sim) != 0)])[: len(row)]
        ahead = before[np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))] - before[starts[row]]
        keep = (place < self.k[row]) & (ahead < self.k[row])
        row, b_id, sim, n = row[keep], b_id[keep], sim[keep], n[keep]
        full = np.flatnonzero(np.bincount(row, n, len(self.q_id)) >= self.k)
        self.floor[full] = sim[np.searchsorted(row, full, side="right") - 1]
        self.waiting, self.n_waiting, self.room = [(row, b_id, sim, n)], len(row), min(self.room, max(len(row), len(self.q_id)))

    def hits(self):
        if not self.ready or not self.n_waiting:
            return
        self._cut()
        row, b_id, sim, _ = self.waiting[0]
        for some in _steps(len(row), 1, of=1 << 16):
            of = row[some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.q_id[of], pa.int64()), pa.array(b_id[some], pa.int64()), pa.array(sim[some]), pa.array(self.k[of], pa.int32())],
                schema=_HITS_ARROW,
            )


def _nearest_in_block(without_self: bool):
    """Per-block kernel: each query's best k base rows of one tile."""

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(without_self)
        for table, take in ((left, chunk.ask), (right, chunk.meet)):
            for batch in table.to_batches():
                take(batch)
        return pa.Table.from_batches(chunk.hits(), schema=_HITS_ARROW)

    return kernel


def _farthest_in_block():
    """Per-block kernel: each query's k least similar base rows of one tile."""

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _HITS_ARROW.empty_table()
        q_id, k = left["q_id"].to_numpy(), left["k"].to_numpy()
        floor, queries = left["floor"].to_numpy(), _matrix(left["q_vec"])
        b_id = right["b_id"].to_numpy()
        order = np.argsort(b_id, kind="stable")
        b_id, base = b_id[order], _matrix(right["b_vec"])[order]
        parts = []
        for rows in _steps(len(q_id), len(b_id)):
            sim = np.round(queries[rows] @ base.T, SIMILARITY_DIGITS) + 0.0
            row, col = _top_of_row(np.where(sim < floor[rows, None], np.inf, sim), k[rows])
            parts.append(
                pa.table(
                    [q_id[rows][row], b_id[col], sim[row, col], k[rows][row]], schema=_HITS_ARROW
                )
            )
        return pa.concat_tables(parts)

    return kernel


def best_in_cells(
    queries: DataFrame,
    base: DataFrame,
    *,
    few_cells: bool = False,
    tile_rows: int = TILE_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    kernel,
) -> DataFrame:
    """What ``kernel`` finds per (query, cell, tile).

    ``queries`` is ``(q_id, q_vec, k, floor, cell)`` and may list a query under
    several cells. ``base`` is ``(b_id, b_vec, cell)``. A cell of any size, for instance
    one that holds a third of all rows, is spread over tiles x chunks blocks.
    """
    tiles = base.groupBy("cell").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("n_tiles"))
    # a block finds at most its queries times min(k, tile) hits: large k, fewer queries
    rows = F.greatest(F.lit(1.0), F.least(F.lit(float(chunk_rows)), BLOCK_HITS / F.least(F.max("k"), F.lit(tile_rows))))
    chunks = queries.groupBy("cell").agg(F.ceil(F.count("*") / rows).cast("int").alias("n_chunks"))
    grid = tiles.join(chunks, "cell")
    # with at most MAX_PIVOTS cells the vectors need not be shuffled just to learn the grid
    grid = F.broadcast(grid) if few_cells else grid

    def spread(df: DataFrame, key: str, own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        return (
            df.join(grid, "cell")
            .withColumn(own, F.pmod(F.xxhash64(key), F.col(n_own)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1)))
            .drop("n_tiles", "n_chunks")
        )

    left = spread(queries, "q_id", "chunk", "n_chunks", "tile", "n_tiles")
    right = spread(base, "b_id", "tile", "n_tiles", "chunk", "n_chunks")
    return _search_blocks(left, right, ["cell", "chunk", "tile"], kernel)


def _search_blocks(left: DataFrame, right: DataFrame, block: list[str], kernel) -> DataFrame:
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(kernel, schema=_HITS)


def _best_in_one_tile(
    queries: DataFrame, base: DataFrame, query_rows: int, chunk_rows: int, without_self: bool, most: int
) -> DataFrame:
    """Hits in a base that fits one tile: it goes along with every chunk of the queries."""
    # a few chunks per core even out how the hash deals them to the tasks
    wanted = 4 * queries.sparkSession.sparkContext.defaultParallelism
    rows = max(MIN_CHUNK_ROWS, min(chunk_rows, -(-query_rows // wanted)))
    rows = max(1, min(rows, BLOCK_HITS // max(1, most)))
    chunks = max(1, -(-query_rows // rows))
    left = queries.withColumn("chunk", F.pmod(F.xxhash64("q_id"), F.lit(chunks)).cast("int"))
    right = base.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return _search_blocks(left, right, ["chunk"], _nearest_in_block(without_self))


def rank_hits(hits: DataFrame, farthest: bool = False, most: int | None = None) -> DataFrame:
    """Final order per query: similarity, then the smaller id; first ``k`` kept.

    ``most``, the largest ``k``, lets Spark cut each task's rows before the shuffle.
    """
    direction = F.asc if farthest else F.desc
    w = W.partitionBy("q_id").orderBy(direction("sim"), F.asc("b_id"))
    ranked = hits.withColumn("rank", F.row_number().over(w))
    ranked = ranked if most is None else ranked.where(F.col("rank") <= most)
    return ranked.where(F.col("rank") <= F.col("k"))


@dataclass
class Cells:
    """Pivots (bounded, on the driver) and the base rows with their cell.

    ``roots`` names for each cell the one that it was split from, or itself: only the
    members of a root and its parts together are nearest to the root's pivot.
    """

    pivots: np.ndarray
    base: DataFrame  # b_id, b_vec, cell, pivot_dist
    roots: np.ndarray | None = None
    probes: int | None = None  # as many as a measured recall needs

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest member-to-pivot distance per cell; one row per pivot."""
        return self.sizes()[:2]

    def sizes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bounds, and the number of members per cell."""
        low = np.full(len(self.pivots), np.inf)
        high = np.full(len(self.pivots), -np.inf)
        members = np.zeros(len(self.pivots), np.int64)
        stats = self.base.groupBy("cell").agg(F.min("pivot_dist"), F.max("pivot_dist"), F.count("*"))
        for cell, lo, hi, n in stats.toLocalIterator():
            low[cell], high[cell], members[cell] = lo, hi, n
        return low, high, members


def pick_pivots(base: DataFrame, rows: int) -> np.ndarray:
    """A bounded, reproducible sample of distinct base vectors, as unit rows.

    About the square root of the number of rows, up to MAX_PIVOTS and
    MAX_PIVOT_BYTES. A vector is drawn by its hash, so copies are drawn together
    and count once.
    """
    first = base.select("b_vec").first()
    if first is None:
        return np.zeros((0, 1))
    dims = len(first["b_vec"]) + 1
    wanted = min(math.ceil(math.sqrt(rows)), MAX_PIVOTS, max(1, MAX_PIVOT_BYTES // (8 * dims)))
    draws = base.select("b_vec", hash_draw("b_vec").alias("h"))
    # pass on a small share of the rows to the sort; all of them if that share is empty
    for share in (8.0 * wanted / rows, 1.0):
        drawn = draws.where(F.col("h") < share).distinct().orderBy("h", "b_vec").limit(wanted)
        table = drawn.select("b_vec").toArrow()
        if table.num_rows:
            return _lifted(_matrix(table["b_vec"]))
    raise ValueError("no base vectors")


def assign_cells(base: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Nearest pivot of every base row, with the distance to it; ``n`` stays where there is one."""
    more = [c for c in base.columns if c == "n"]

    def assign(batches):
        for batch in batches:
            points = _lifted(_matrix(batch.column("b_vec")))
            for rows in _steps(len(points), len(pivots)):
                sim = points[rows] @ pivots.T
                cell = sim.argmax(axis=1)
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("b_id"),
                        part.column("b_vec"),
                        pa.array(cell, pa.int32()),
                        pa.array(_distance(sim[np.arange(len(cell)), cell]), pa.float64()),
                        *[part.column(c) for c in more],
                    ],
                    names=["b_id", "b_vec", "cell", "pivot_dist", *more],
                )

    vec = base.schema["b_vec"].dataType.simpleString()
    schema = ", ".join([f"b_id bigint, b_vec {vec}, cell int, pivot_dist double", *[f"{c} int" for c in more]])
    return base.select("b_id", "b_vec", *[F.col(c).cast("int") for c in more]).mapInArrow(assign, schema=schema)


def _route(queries: DataFrame, width: int, cells_of) -> DataFrame:
    """Copy each query to the cells that ``cells_of(points, batch)`` marks in a boolean grid."""

    def route(batches):
        for batch in batches:
            points = _lifted(_matrix(batch.column("q_vec")))
            for rows in _steps(len(points), width):
                part = batch.slice(rows.start, rows.stop - rows.start)
                row, cell = np.nonzero(cells_of(points[rows], part))
                for some in _steps(len(row), points.shape[1]):
                    picked = part.select(["q_id", "q_vec", "k", "floor"]).take(pa.array(row[some]))
                    yield pa.RecordBatch.from_arrays(
                        [*picked.columns, pa.array(cell[some], pa.int32())],
                        names=["q_id", "q_vec", "k", "floor", "cell"],
                    )

    vec = queries.schema["q_vec"].dataType.simpleString()
    schema = f"q_id bigint, q_vec {vec}, k int, floor double, cell int"
    return queries.mapInArrow(route, schema=schema)


def _nearest_cells(pivots: np.ndarray, probes: int):
    """Marks each query's ``probes`` nearest pivots."""
    probes = min(probes, len(pivots))

    def cells_of(q: np.ndarray, _batch) -> np.ndarray:
        near = np.argpartition(-(q @ pivots.T), probes - 1, axis=1)[:, :probes]
        grid = np.zeros((len(q), len(pivots)), dtype=bool)
        np.put_along_axis(grid, near, True, axis=1)
        return grid

    return cells_of


def sample_neighbours(
    queries: DataFrame, base: DataFrame, most: int, *, without_self: bool = False
) -> tuple[np.ndarray, pa.Table]:
    """A sample of the queries, chosen by a hash of their ids, as unit rows, and their true neighbours.

    The table has the sample's row number as ``q_id``, and ``b_id`` with the columns that ``base`` has
    beside ``b_vec``. One pass over the base: each task compares its rows with the sample and keeps ``most`` for each of its queries.
    """
    least, upto, hits = SAMPLE
    rows = max(least, min(upto, hits // max(1, most)))
    sample = queries.orderBy(F.xxhash64("q_id"), "q_id").limit(rows).toArrow()
    extra = "cell" in base.columns
    if not sample.num_rows or most < 1:
        return np.zeros((0, 0)), pa.table({"q_id": pa.array([], pa.int64()), "b_id": pa.array([], pa.int64())})
    points, ids, ks = _matrix(sample["q_vec"]), sample["q_id"].to_numpy(), sample["k"].to_numpy()
    shared = queries.sparkSession.sparkContext.broadcast((points, ids, ks))

    def best(batches):
        q, own, k = shared.value
        sims, found, where = np.zeros((len(q), 0)), np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0), np.int32)
        for batch in batches:
            points = _matrix(batch.column("b_vec"))
            b_id, cell = batch.column("b_id").to_numpy(), batch.column("cell").to_numpy()
            for part in _steps(len(b_id), len(q)):
                sim = np.round(q @ points[part].T, SIMILARITY_DIGITS) + 0.0
                if without_self:
                    sim[own[:, None] == b_id[None, part]] = -np.inf
                sims = np.hstack([sims, sim])
                found = np.hstack([found, np.broadcast_to(b_id[part], sim.shape)])
                where = np.hstack([where, np.broadcast_to(cell[part], sim.shape)])
                if sims.shape[1] > most:
                    top = np.argpartition(-sims, most - 1, axis=1)[:, :most]
                    sims, found, where = (np.take_along_axis(x, top, axis=1) for x in (sims, found, where))
        row, col = np.nonzero(np.isfinite(sims))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row, pa.int64()), pa.array(found[row, col], pa.int64()), pa.array(sims[row, col], pa.float64()),
                pa.array(k[row], pa.int32()), pa.array(where[row, col], pa.int32()),
            ],
            names=["q_id", "b_id", "sim", "k", "cell"],
        )

    with_cell = base.select("b_id", "b_vec", "cell" if extra else F.lit(0).alias("cell"))
    true = rank_hits(with_cell.mapInArrow(best, schema=f"{_HITS}, cell int"), most=most)
    return points, true.select("q_id", "b_id", "cell").toArrow()  # at most the sample's neighbours


def probes_for_recall(
    queries: DataFrame, cells: Cells, most: int, *, without_self: bool = False, recall: float = RECALL
) -> int:
    """How many nearest cells hold ``recall`` of the true neighbours of a sample of the queries."""
    points, true = sample_neighbours(queries, cells.base, most, without_self=without_self)
    if not true.num_rows:
        return 1
    row, cell = true["q_id"].to_numpy(), true["cell"].to_numpy()
    near = _lifted(points) @ cells.pivots.T
    # sorted: the cells that must be probed for each neighbour
    needed = np.sort([int((near[r] >= near[r, c]).sum()) for r, c in zip(row, cell)])
    return int(needed[math.ceil(recall * len(needed)) - 1])


def _unsettled_cells(pivots: np.ndarray, low: np.ndarray, high: np.ndarray, probes: int, roots: np.ndarray | None = None):
    """Marks the unprobed cells that may still hold a row as similar as ``floor``, by :class:`_Bounds`."""
    probed, bounds = _nearest_cells(pivots, probes), _Bounds(pivots, low, high, roots)

    def cells_of(q: np.ndarray, batch) -> np.ndarray:
        seen = bounds.cells(q, bounds.start(q), np.arange(len(pivots)), np.asarray(batch.column("floor")))
        return seen & np.isfinite(high)[None, :] & ~probed(q, batch)

    return cells_of


# Rows of one vector that are ranked together; Spark's window limit holds up to 1,000.
COPIES_AT_ONCE = 1_000


def _first_copies(base: DataFrame, copies: int) -> DataFrame:
    """At most ``copies`` rows, smallest ids first, of each set of equal vectors.

    Exact for a top-k by (similarity, id) with k below ``copies``: a further copy
    can never come before the ones kept. Many copies are ranked in two levels: those
    of each block of ids first, the blocks being as many as keep a block's own limit
    effective, then what is left of all blocks of a vector.
    """

    def first(rows: DataFrame, *keys: str) -> DataFrame:
        w = W.partitionBy(*keys).orderBy("b_id")
        return rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= copies).drop("__rn")

    if copies > COPIES_AT_ONCE:
        blocks = -(-copies // COPIES_AT_ONCE) * 16
        base = first(base.withColumn("__block", F.pmod(F.xxhash64("b_id"), F.lit(blocks))), "b_vec", "__block").drop("__block")
    return first(base, "b_vec")


def sound(vec: str) -> Column:
    """Vectors without a component that is missing or not a number; others have no neighbours."""
    x = F.col(vec)
    return x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int | Column,
    *,
    query_id: str = "id",
    base_id: str = "id",
    vec: str = "vec",
    strategy: str = "exact",
    probes: int | None = None,
    without_self: bool = False,
    tile_rows: int = TILE_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The ``k`` most cosine-similar base rows of every query row.

    Returns ``(q_id, b_id, sim, dist, rank)``, ranked by similarity (9 digits),
    then base id; ``dist`` is the angular distance. ``k`` may be a column of the
    queries. Both inputs are read more than once; store them first where they are
    costly, such as fresh from an encoder. ``strategy="exact"`` gives the true neighbours; ``"ivf"`` stops
    after each query's ``probes`` nearest cells and may miss some, at any size of the base; without
    ``probes`` it takes as many as :func:`probes_for_recall` measures. ``"forest"`` deals the queries to
    ``probes`` leaves of random projection trees (:mod:`.forest`), both measured where ``probes`` is not given. Vectors
    that are NULL or hold a NULL, NaN or infinite component take no part.
    """
    options = {"vec": vec, "strategy": strategy, "probes": probes, "without_self": without_self, "tile_rows": tile_rows, "chunk_rows": chunk_rows}
    shared, search = _prepared(queries, base, k, query_id, base_id, **options)
    return search() if shared is None else shared().hits()


def shared_lists(
    queries: DataFrame, base: DataFrame, k: int | Column, *, query_id: str = "id", base_id: str = "id", vec: str = "vec",
    strategy: str = "exact", probes: int | None = None, without_self: bool = False, tile_rows: int = TILE_ROWS, chunk_rows: int = CHUNK_ROWS,
    columns: Sequence[str] = (),
) -> SharedLists | None:
    """The search of :func:`knn_join` as lists that copies of a vector share, their rows with ``columns`` of the base; None where it searches row by row."""
    options = {"vec": vec, "strategy": strategy, "probes": probes, "without_self": without_self, "tile_rows": tile_rows, "chunk_rows": chunk_rows}
    shared, _ = _prepared(queries, base, k, query_id, base_id, columns=columns, **options)
    return None if shared is None else shared()


def _prepared(
    queries: DataFrame, base: DataFrame, k: int | Column, query_id: str, base_id: str, *, vec: str, strategy: str, probes: int | None,
    without_self: bool, tile_rows: int, chunk_rows: int, columns: Sequence[str] = (),
):
    """The search by shared lists, where copies are many and ids unique, and the one row by row; neither has run."""
    if strategy not in ("exact", "ivf", "forest"):
        raise ValueError(f"knn_join: unknown strategy {strategy!r}")
    k_column = F.lit(k) if isinstance(k, int) else k
    q = queries.where(sound(vec)).select(
        F.col(query_id).cast("bigint").alias("q_id"),
        F.col(vec).alias("q_vec"),
        k_column.cast("int").alias("k"),
        F.lit(NO_FLOOR).alias("floor"),
    ).where("k > 0")
    b = base.where(sound(vec)).select(
        F.col(base_id).cast("bigint").alias("b_id"), F.col(vec).alias("b_vec"), *columns
    )
    rows, unique, vectors = _census(b, "b_id", "b_vec")
    most = k if isinstance(k, int) else q.agg(F.max("k")).first()[0] or 0
    same = queries is base and isinstance(k, int)
    query_rows, query_unique, query_vectors = (rows, unique, vectors) if same else _census(q, "q_id", "q_vec")
    options = {"without_self": without_self, "tile_rows": tile_rows, "chunk_rows": chunk_rows}
    shared = None
    if strategy == "exact" and unique and query_unique and (rows > COPIED * vectors or query_rows > COPIED * query_vectors):

        def search(one_q: DataFrame, one_b: DataFrame) -> DataFrame:
            alone = options | {"without_self": False}
            return _search(one_q, one_b, one_b.count(), one_q.count(), most + int(without_self), "exact", probes, ranked=False, **alone)

        shared = lambda: _by_vector(q, b, most, without_self, search, columns)
    return shared, lambda: _search(q, b.select("b_id", "b_vec"), rows, query_rows, most, strategy, probes, **options)


def _census(df: DataFrame, id: str, vec: str) -> tuple[int, bool, int]:
    """Rows, whether their ids are unique, and about how many vectors there are."""
    found = df.agg(F.count("*"), F.count_distinct(F.col(id)), F.approx_count_distinct(F.xxhash64(vec), 0.02)).first()
    return found[0], found[1] == found[0], found[2]


def _search(
    q: DataFrame, b: DataFrame, rows: int, query_rows: int, most: int, strategy: str, probes: int | None, *,
    without_self: bool, tile_rows: int, chunk_rows: int, ranked: bool = True,
) -> DataFrame:
    if strategy == "exact" and rows <= tile_rows or not rows:
        hits = _best_in_one_tile(q, b, query_rows, chunk_rows, without_self, most)
        return _finish(hits, most) if ranked else hits
    options = {"without_self": without_self, "tile_rows": tile_rows, "chunk_rows": chunk_rows, "most": most}
    b = cut_lineage(_first_copies(b, most + 1))
    if strategy == "forest":
        from . import forest as trees

        planned, needed = trees.plan_forest(q, b, rows, most, without_self=without_self)
        return trees.search_forest(q, planned, trees.assign_leaves(b, planned, tile_rows), probes or needed, **options)
    pivots = pick_pivots(b, rows)
    cells = Cells(pivots, cut_lineage(assign_cells(b, pivots)))
    if probes is None:
        probes = probes_for_recall(q, cells, most, without_self=without_self) if strategy == "ivf" else PROBES
    return knn_in_cells(q, cells, strategy=strategy, probes=probes, ranked=ranked, **options)


class _Bounds:
    """Which cells may hold a row as similar as a query's floor.

    A cell is ruled out by the distances of its members to their pivot, or by the
    plane half-way between its root's pivot and the query's nearest root.
    """

    strict = False

    def __init__(self, pivots: np.ndarray, low: np.ndarray, high: np.ndarray, roots: np.ndarray | None):
        self.pivots, self.low, self.high = pivots, low, high
        self.roots = np.arange(len(pivots)) if roots is None else roots

    def start(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each query's nearest root, and the distance to it."""
        first = np.unique(self.roots)
        near = np.concatenate([(lifted[r] @ self.pivots[first].T).argmax(axis=1) for r in _steps(len(lifted), len(first))])
        root = first[near]
        return root, _distance(np.einsum("ij,ij->i", lifted, self.pivots[root]))

    def cells(self, lifted: np.ndarray, near, cells: np.ndarray, floor: np.ndarray) -> np.ndarray:
        limit = _distance(np.maximum(floor, NO_FLOOR))[:, None] + BOUND_SLACK
        root, nearest = near
        dist = _distance(lifted @ self.pivots[cells].T)
        ring = np.maximum(dist - self.high[cells], self.low[cells] - dist)
        own = self.pivots[self.roots[cells]]
        across = _distance(self.pivots[root] @ own.T)
        to_root = _distance(lifted @ own.T)
        plane = np.where(across > 0, (to_root**2 - nearest[:, None] ** 2) / np.where(across > 0, 2 * across, 1), 0)
        return np.maximum(ring, plane) <= limit


class _Probes:
    """Each query's nearest cells, as many as are probed."""

    strict = True

    def __init__(self, pivots: np.ndarray, probes: int):
        self.pivots, self.probes = pivots, min(probes, len(pivots))

    def start(self, lifted: np.ndarray) -> np.ndarray:
        n = len(self.pivots) - self.probes
        return np.concatenate([
            np.partition(lifted[r] @ self.pivots.T, n, axis=1)[:, n] for r in _steps(len(lifted), len(self.pivots))
        ])

    def cells(self, lifted: np.ndarray, near: np.ndarray, cells: np.ndarray, floor: np.ndarray) -> np.ndarray:
        return lifted @ self.pivots[cells].T >= near[:, None] - 1e-12


def _floors(lifted: np.ndarray, k: np.ndarray, pivots: np.ndarray, high: np.ndarray, members: np.ndarray) -> np.ndarray:
    """A similarity that each query's k-th best reaches: that of the far side of a cell with more than ``k`` members."""
    dist = _distance(lifted @ pivots.T) + np.where(members > 0, high, np.inf)
    far = np.where(members[None, :] > k[:, None], dist, np.inf).min(axis=1) + BOUND_SLACK
    return np.where(far < 2.0, 1.0 - far**2 / 2.0, -np.inf)


def _in_line(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which near ones come together: halved along their widest direction, again and again."""
    line, todo = [], [np.arange(len(pivots))]
    while todo:
        some = todo.pop()
        if len(some) <= 2:
            line.extend(some)
            continue
        points = pivots[some]
        one = points[(points @ points[0]).argmin()]
        other = points[(points @ one).argmin()]
        by = some[np.argsort(points @ (one - other), kind="stable")]
        todo += [by[len(by) // 2 :], by[: len(by) // 2]]
    return np.array(line, dtype=np.int64)


def _deal_queries(queries: DataFrame, cells: Cells, rows: int) -> tuple[DataFrame, int]:
    """The queries with the number of their chunk, about ``rows`` to one; queries near the same pivots together."""
    pivots = cells.pivots

    def locate(batches):
        for batch in batches:
            points = _lifted(_matrix(batch.column("q_vec")))
            near = [(points[r] @ pivots.T).argmax(axis=1) for r in _steps(len(points), len(pivots))]
            cell = np.concatenate(near) if near else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=["q_id", "q_vec", "k", "near"])

    vec = queries.schema["q_vec"].dataType.simpleString()
    located = queries.select("q_id", "q_vec", "k").mapInArrow(locate, schema=f"q_id bigint, q_vec {vec}, k int, near int")
    located = cut_lineage(located)
    asked = {r["near"]: r["n"] for r in located.groupBy("near").agg(F.count("*").alias("n")).collect()}  # one row per cell
    deal, before = [], 0
    for cell in _in_line(pivots).tolist():
        n = asked.get(cell, 0)
        if n:
            deal.append((cell, before // rows, (before + n - 1) // rows - before // rows + 1))
            before += n
    if not deal:
        return located.withColumn("chunk", F.lit(0)), 0
    places = queries.sparkSession.createDataFrame(deal, "near int, first int, pieces int")
    chunk = (F.col("first") + F.pmod(F.xxhash64("q_id"), F.col("pieces"))).cast("int")
    return located.join(F.broadcast(places), "near").select("q_id", "q_vec", "k", chunk.alias("chunk")), deal[-1][1] + deal[-1][2]


def _wanted_cells(queries: DataFrame, cells: Cells, sight, high: np.ndarray, members: np.ndarray) -> DataFrame:
    """``(chunk, cell, nth)``: the cells that a chunk's queries look into, the nearest to one of them first."""
    pivots, every = cells.pivots, np.arange(len(cells.pivots))

    def wanted(batches):
        for batch in batches:
            points, chunk, k = _lifted(_matrix(batch.column("q_vec"))), batch.column("chunk").to_numpy(), batch.column("k").to_numpy()
            for of in np.unique(chunk):
                least = np.full(len(every), np.inf)
                mine = np.flatnonzero(chunk == of)
                for rows in _steps(len(mine), len(every)):
                    some = points[mine[rows]]
                    floor = np.zeros(len(some)) if sight.strict else _floors(some, k[mine[rows]], pivots, high, members)
                    seen = sight.cells(some, sight.start(some), every, floor) & (members > 0)
                    dist = np.where(seen, _distance(some @ pivots.T), np.inf)
                    least = np.minimum(least, dist.min(axis=0))
                near = np.flatnonzero(np.isfinite(least))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(near), of), pa.int32()), pa.array(near, pa.int32()), pa.array(least[near])],
                    names=["chunk", "cell", "nth"],
                )

    found = queries.select("q_vec", "k", "chunk").mapInArrow(wanted, schema="chunk int, cell int, nth double")
    return found.groupBy("chunk", "cell").agg(F.min("nth").alias("nth"))


def _stream_past(without_self: bool, sight):
    """Blocks of rows sorted by block, queries first: the hits of each block's queries among its base rows."""

    def search(batches):
        now, chunk = None, None
        for batch in batches:
            block, side = batch.column("block").to_numpy(), batch.column("side").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], np.diff(block) != 0])) if len(block) else []
            for start, stop in zip(starts, [*starts[1:], len(block)]):
                if block[start] != now:
                    if chunk is not None:
                        yield from chunk.hits()
                    now, chunk = block[start], _Chunk(without_self, sight)
                asks = int((side[start:stop] == 0).sum())
                rows = batch.slice(start, stop - start).rename_columns(["block", "side", "nth", "cell", "k", "id", "vec"])
                if asks:
                    chunk.ask(rows.slice(0, asks).rename_columns(["block", "side", "nth", "cell", "k", "q_id", "q_vec"]))
                chunk.meet(rows.slice(asks).rename_columns(["block", "side", "nth", "cell", "n", "b_id", "b_vec"]))
        if chunk is not None:
            yield from chunk.hits()

    return search


def _rows_of_chunk(queries: int, cores: int, chunk_rows: int, most: int) -> int:
    """Queries of a chunk: a few chunks per core, each with bounded rows and hits.

    Every chunk meets the base once. So ``chunk_rows`` below CHUNK_ROWS gives way where it
    would make more than 16 chunks a core: with a fixed size the rows sent would grow with the square of the input.
    """
    rows = min(chunk_rows, max(MIN_CHUNK_ROWS, -(-queries // (4 * cores))))
    rows = max(rows, min(CHUNK_ROWS, -(-queries // (16 * cores))))
    return max(1, min(rows, BLOCK_HITS // max(1, most)))


def knn_in_cells(
    queries: DataFrame, cells: Cells, *, strategy: str = "exact", probes: int = PROBES, most: int | None = None,
    without_self: bool = False, tile_rows: int = TILE_ROWS, chunk_rows: int = CHUNK_ROWS, ranked: bool = True,
) -> DataFrame:
    """The search over an existing assignment; ``queries`` is ``(q_id, q_vec, k, floor)``, ``most`` the largest ``k``.

    ``exact`` looks into every cell that the bounds leave open, ``ivf`` into each query's ``probes`` nearest ones.
    Not ``ranked``, the hits come as the tasks give them, and some more than ``k`` where a chunk has several tasks.
    """
    if not len(cells.pivots):
        empty = queries.limit(0).selectExpr("q_id", "CAST(NULL AS BIGINT) AS b_id", "CAST(0 AS DOUBLE) AS sim", "k")
        return _finish(empty, most) if ranked else empty
    low, high, members = cells.sizes()
    wide = most if most is not None else queries.agg(F.max("k")).first()[0] or 1
    cores, n_queries, n_base = queries.sparkSession.sparkContext.defaultParallelism, queries.count(), int(members.sum())
    rows = _rows_of_chunk(n_queries, cores, chunk_rows, wide)
    dealt, chunks = _deal_queries(queries, cells, rows)
    sight = _Probes(cells.pivots, probes) if strategy == "ivf" else _Bounds(cells.pivots, low, high, cells.roots)
    # few chunks, or a large base: its rows are dealt to several tasks a chunk
    parts = max(1, -(-n_base // max(tile_rows, STREAM_ROWS)), min(-(-2 * cores // max(1, chunks)), -(-n_base // tile_rows)))
    chunk = F.col("chunk") * parts
    left = dealt.select(
        F.explode(F.sequence(chunk, chunk + (parts - 1))).alias("block"), F.lit(0).alias("side"), F.lit(0.0).alias("nth"),
        F.lit(-1).alias("cell"), "k", F.col("q_id").alias("id"), F.col("q_vec").alias("vec"),
    )
    wanted = _wanted_cells(dealt, cells, sight, high, members)
    part = F.pmod(F.xxhash64("b_id"), F.lit(parts)).cast("int")
    rows_of = F.col("n") if "n" in cells.base.columns else F.lit(1).alias("n")
    right = cells.base.select("b_id", "b_vec", "cell", rows_of).join(wanted, "cell").select(
        (chunk + part).alias("block"), F.lit(1).alias("side"), "nth", "cell", F.col("n").alias("k"),
        F.col("b_id").alias("id"), F.col("b_vec").alias("vec"),
    )
    both = left.unionAll(right).repartitionById(max(1, chunks * parts), "block").sortWithinPartitions("block", "side", "nth", "cell")
    hits = both.mapInArrow(_stream_past(without_self, sight), schema=_HITS)
    return _finish(hits, most) if ranked else hits


@dataclass
class SharedLists:
    """Neighbours of vectors, one list for all queries that have the vector; a query leaves itself out of it."""

    asking: DataFrame  # q_id, k, class, own: the query's own place in the list, if it has one and is to be left out
    lists: DataFrame  # class, b_id, sim, rank, and the columns asked for

    def given(self, asking: DataFrame, lists: DataFrame) -> DataFrame:
        """Each query's rows with all columns of both sides, which may have more than those above; a join by ``class`` only."""
        place = F.col("rank") - F.coalesce((F.col("own") < F.col("rank")).cast("int"), F.lit(0))
        return asking.join(lists, "class").where("own IS NULL OR rank != own").withColumn("rank", place).where("rank <= k")

    def hits(self) -> DataFrame:
        given = self.given(self.asking, self.lists)
        return given.select("q_id", "b_id", "sim", angular_from_cosine(F.col("sim")).alias("dist"), "rank")

    def last(self) -> DataFrame:
        """``(q_id, last_sim, last_id)``: the ``k``-th row of each query, NULL where it has fewer."""
        asked = self.asking.select("q_id", "class", (F.col("k") + F.coalesce((F.col("own") <= F.col("k")).cast("int"), F.lit(0))).alias("rank"))
        ends = self.lists.select("class", "rank", F.col("sim").alias("last_sim"), F.col("b_id").alias("last_id"))
        return asked.join(ends, ["class", "rank"], "left").select("q_id", "last_sim", "last_id")


def _by_vector(q: DataFrame, b: DataFrame, most: int, without_self: bool, search, columns: Sequence[str] = ()) -> SharedLists:
    """The search with one query and one base row a vector, and its rows given back to all copies; ids are unique.

    Copies of a vector share one list of ``k + 1`` rows, of which each leaves out itself. Of the vectors found
    for a list, those count before which there are fewer than ``k + 1`` rows; the search stops there.
    """
    classes = cut_lineage(
        q.groupBy("q_vec").agg((F.max("k") + int(without_self)).alias("k")).withColumn("q_id", F.monotonically_increasing_id())
    )
    same = W.partitionBy("b_vec")
    members = cut_lineage(
        _first_copies(b, most + 1).withColumns({"rep": F.min("b_id").over(same), "n": F.count("*").over(same)})
    )
    near = search(classes.withColumn("floor", F.lit(NO_FLOOR)), members.where("b_id = rep").select("b_id", "b_vec", F.col("n").cast("int").alias("n")))
    found = near.select("q_id", F.col("b_id").alias("rep"), "sim").join(members.select("rep", "n").distinct(), "rep")
    ahead = F.sum("n").over(W.partitionBy("q_id").orderBy(F.desc("sim"))) - F.sum("n").over(W.partitionBy("q_id", "sim"))
    reps = members.where("b_id = rep").select(F.col("b_vec").alias("q_vec"), F.col("rep").alias("own_rep"))
    reps = cut_lineage(classes.join(reps, "q_vec", "left").select("q_id", "k", "own_rep"))
    found = found.withColumn("ahead", ahead).join(reps, "q_id").where("ahead < k")
    # rows that have the list's own vector: a query finds itself among these
    found = found.withColumn("mine", F.coalesce(F.col("rep") == F.col("own_rep"), F.lit(False)))
    hits = found.join(members.select("rep", "b_id", *columns), "rep").select("q_id", "b_id", "sim", "k", "mine", *columns)
    # columns that repeat or ascend: as Parquet a fraction of a checkpoint's size
    path = scratch_path(q.sparkSession, "lists")
    rank_hits(hits, most=most + 1).select(F.col("q_id").alias("class"), "b_id", "sim", "rank", "mine", *columns).write.parquet(path)
    lists = q.sparkSession.read.parquet(path)
    asking = q.join(classes.select(F.col("q_id").alias("class"), "q_vec"), "q_vec").select("q_id", "k", "class")
    if not without_self:
        return SharedLists(asking.withColumn("own", F.lit(None).cast("int")), lists.drop("mine"))
    asking = cut_lineage(asking)
    own = lists.where("mine").select("class", F.col("b_id").alias("q_id"), F.col("rank").alias("own"))
    # base rows that have a query's id but another vector, where queries and base differ
    selves = asking.join(members.select(F.col("b_id").alias("q_id"), "rep"), "q_id")
    others = selves.join(reps.select(F.col("q_id").alias("class"), "own_rep"), "class").where("own_rep IS NULL OR own_rep != rep")
    if not others.isEmpty():
        every = lists.where("NOT mine").select("class", F.col("b_id").alias("q_id"), F.col("rank").alias("own"))
        own = own.unionAll(every.join(others.select("class", "q_id"), ["class", "q_id"], "left_semi"))
    return SharedLists(asking.join(own, ["class", "q_id"], "left"), lists.drop("mine"))


def _finish(hits: DataFrame, most: int | None = None) -> DataFrame:
    return rank_hits(hits, most=most).select(
        "q_id", "b_id", "sim", angular_from_cosine(F.col("sim")).alias("dist"), "rank"
    )


def knn_self(
    items: DataFrame, k: int | Column, *, id: str = "id", vec: str = "vec", **options
) -> DataFrame:
    """Neighbours within one table, each row being its own first neighbour.

    ``(id, nn_id, dist, rank)``; ``k`` counts the row itself, so there are at
    most ``k - 1`` others.
    """
    others = knn_join(items, items, k - 1, query_id=id, base_id=id, vec=vec, without_self=True, **options)
    own = items.where(sound(vec)).select(
        F.col(id).cast("bigint").alias("id"),
        F.col(id).cast("bigint").alias("nn_id"),
        F.lit(0.0).alias("dist"),
        F.lit(1).alias("rank"),
    )
    return own.unionByName(
        others.select(
            F.col("q_id").alias("id"), F.col("b_id").alias("nn_id"), "dist", (F.col("rank") + 1).alias("rank")
        )
    )


def knn_filtered(
    queries: DataFrame, base: DataFrame, wanted: DataFrame, over_fetch: int, k: int, **options
) -> DataFrame:
    """Fetch ``over_fetch`` neighbours, keep those whose id is in ``wanted``, then the first ``k``."""
    hits = knn_join(queries, base, over_fetch, **options)
    kept = hits.join(wanted.select(F.col("id").alias("b_id")), "b_id", "left_semi").drop("rank")
    return rank_hits(kept.withColumn("k", F.lit(k)), most=k).drop("k")


def farthest_in_group(
    items: DataFrame, group: str, *, id: str = "id", vec: str = "vec",
    tile_rows: int = TILE_ROWS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Each row's most distant row of the same group: ``(id, far_id, dist)``.

    A row alone in its group is paired with itself. Of equal vectors in a group
    only the smallest id can be chosen, so copies are left out of the base side.
    """
    rows = items.where(F.col(group).isNotNull() & sound(vec))
    q = rows.select(
        F.col(id).cast("bigint").alias("q_id"), F.col(vec).alias("q_vec"),
        F.lit(1).alias("k"), F.lit(NO_FLOOR).alias("floor"), F.col(group).alias("cell"),
    )
    b = rows.groupBy(F.col(group).alias("cell"), F.col(vec).alias("b_vec")).agg(
        F.min(F.col(id).cast("bigint")).alias("b_id")
    )
    hits = best_in_cells(
        q, b.select("b_id", "b_vec", "cell"), tile_rows=tile_rows, chunk_rows=chunk_rows, kernel=_farthest_in_block()
    )
    return rank_hits(hits, farthest=True, most=1).select(
        F.col("q_id").alias("id"),
        F.col("b_id").alias("far_id"),
        angular_from_cosine(F.col("sim")).alias("dist"),
    )
