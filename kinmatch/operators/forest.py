"""Approximate neighbours by a forest of random projection trees.

A tree cuts the vectors in two at every level, by the side of a random hyperplane that
halves each node; its leaves are small. A query descends every tree and is dealt to the
leaves that lie nearest, counted over all trees together: the penalty of a leaf is the sum of
squared distances to the planes that it lies beyond. What it meets there is compared, the best of each
tree are kept, and the best of all trees are its neighbours.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numeric import hash_draw
from ..functions.vectors import SIMILARITY_DIGITS, angular_from_cosine
from ..session import cut_lineage
from .knn import (
    _HITS_ARROW, CHUNK_ROWS, MAX_PIVOTS, TILE_ROWS, _lifted, _matrix, _steps, _top_of_row, best_in_cells, sample_neighbours,
)

# Numbers of trees to choose from, and the share of the base that a query should be compared with at most.
TREES = (4, 8, 16, 32, 64)
SHARE = 0.2
# Share of a sample's true neighbours that the probed leaves must hold; some more than the 0.9 to reach on all.
FOREST_RECALL = 0.92
# Rows that a leaf should have, and levels of a tree at most.
LEAF_ROWS = 3
MAX_DEPTH = 14
# Vectors that the planes' offsets are taken from.
FIT_ROWS = 1 << 16
# Leaves looked at in each tree at most, the nearest ones.
BEAM = 64
# Numbers held at once by a step of routing, and by the similarities of a block.
ROUTE_CELLS = 1 << 22
BLOCK_CELLS = 1 << 22


@dataclass
class Forest:
    """Planes of all trees, small enough for every task."""

    directions: np.ndarray  # tree, level, dimension
    offsets: np.ndarray  # tree, inner node by level
    rows: int  # of the base they were made for

    @property
    def trees(self) -> int:
        return self.directions.shape[0]

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    def first(self, trees: int) -> Forest:
        return Forest(self.directions[:trees], self.offsets[:trees], self.rows)

    def heights(self, points: np.ndarray) -> np.ndarray:
        """(row, tree, level): how far each point lies along each plane's direction."""
        flat = points @ self.directions.reshape(-1, points.shape[1]).T.astype(np.float64)
        return flat.reshape(len(points), self.trees, self.depth)

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """(row, tree): the leaf of each point."""
        height, trees = self.heights(points), np.arange(self.trees)[None, :]
        node = np.zeros(height.shape[:2], np.int64)
        for level in range(self.depth):
            node = 2 * node + (height[:, :, level] >= self.offsets[trees, (1 << level) - 1 + node])
        return node

    def nearest_leaves(self, points: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(row, tree, beam) twice: each tree's leaves of least penalty, not in order, and these penalties.

        A node's penalty is that of its best leaf, so the best nodes of a level hold the best leaves.
        """
        height, trees = self.heights(points), np.arange(self.trees)[None, :, None]
        node = np.zeros((len(points), self.trees, 1), np.int32)
        penalty, offsets = np.zeros(node.shape, np.float32), self.offsets.astype(np.float32)
        height = height.astype(np.float32)
        for level in range(self.depth):
            over = height[:, :, level, None] - offsets[trees, (1 << level) - 1 + node]
            node = np.concatenate([2 * node, 2 * node + 1], axis=2)
            beyond = np.where(np.isfinite(over), over * over, np.inf).astype(np.float32)
            penalty = np.concatenate([penalty + np.where(over > 0, beyond, 0), penalty + np.where(over < 0, beyond, 0)], axis=2)
            if node.shape[2] > beam:
                best = np.argpartition(penalty, beam - 1, axis=2)[:, :, :beam]
                node, penalty = np.take_along_axis(node, best, 2), np.take_along_axis(penalty, best, 2)
        return node, penalty

    def point_steps(self, n: int):
        """Row ranges whose routing stays within ROUTE_CELLS."""
        return _steps(n, max(1, ROUTE_CELLS // (4 * self.trees * max(2 * BEAM, self.depth))), of=1)


def _boughs(forest: Forest, tile_rows: int) -> int:
    """By how many bits a leaf is shortened to its bough, whose rows about fill a tile."""
    return min(forest.depth, max(0, int(math.log2(max(1.0, tile_rows * (1 << forest.depth) / max(1, forest.rows))))))


def fit_forest(base: DataFrame, rows: int, trees: int = TREES[-1], leaf_rows: int = LEAF_ROWS, seed: int = 0) -> Forest:
    """Planes of ``trees`` trees for base vectors ``b_vec``, level by level, in one task per tree.

    Directions are random; the offsets that halve the nodes come from at most FIT_ROWS distinct vectors
    drawn by hash. ``rows`` of the base decide on the depth.
    """
    spark = base.sparkSession
    draws = base.select("b_vec", hash_draw("b_vec", seed=seed).alias("h"))
    drawn = draws.where(F.col("h") < max(1.0, 2.0 * FIT_ROWS) / max(1, rows)).distinct().orderBy("h", "b_vec").limit(FIT_ROWS)
    sample = _lifted(_matrix(drawn.select("b_vec").toArrow()["b_vec"]))
    depth = min(MAX_DEPTH, max(1, round(math.log2(max(2.0, min(rows, 4 * len(sample)) / leaf_rows)))))
    directions = np.random.default_rng(seed).normal(size=(trees, depth, sample.shape[1])).astype(np.float32)
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    shared = spark.sparkContext.broadcast((sample, directions))

    def fit(batches):
        points, planes = shared.value
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                node, offsets = np.zeros(len(points), np.int64), []
                for level in range(depth):
                    height = points @ planes[tree, level].astype(np.float64)
                    order = np.lexsort((height, node))
                    size = np.bincount(node, minlength=1 << level)
                    middle = np.cumsum(size) - size + size // 2
                    # a node without sample rows sends all to its lower side
                    cut = np.where(size > 0, height[order[np.minimum(middle, max(0, len(points) - 1))]] if len(points) else 0.0, np.inf)
                    offsets += cut.tolist()
                    node = 2 * node + (height >= cut[node])
                yield pa.RecordBatch.from_arrays([pa.array([tree]), pa.array([offsets])], names=["tree", "offsets"])

    found = spark.range(trees, numPartitions=trees).mapInArrow(fit, schema="tree bigint, offsets array<double>").toArrow().sort_by("tree")
    return Forest(directions, np.array(found["offsets"].to_pylist(), np.float64).reshape(trees, -1), rows)


def assign_leaves(base: DataFrame, forest: Forest, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Every base row once per tree, with its leaf and the cell (tree and bough) that holds this leaf."""
    shift = _boughs(forest, tile_rows)
    per_tree = 1 << (forest.depth - shift)
    vec = base.schema["b_vec"].dataType.simpleString()

    def assign(batches):
        for batch in batches:
            points = _lifted(_matrix(batch.column("b_vec")))
            for rows in forest.point_steps(len(points)):
                leaf = forest.leaves(points[rows])
                part = batch.slice(rows.start, rows.stop - rows.start)
                for tree in range(forest.trees):
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("b_id"), part.column("b_vec"),
                            pa.array(tree * per_tree + (leaf[:, tree] >> shift), pa.int32()), pa.array(leaf[:, tree], pa.int32()),
                        ],
                        names=["b_id", "b_vec", "cell", "leaf"],
                    )

    return base.select("b_id", "b_vec").mapInArrow(assign, schema=f"b_id bigint, b_vec {vec}, cell int, leaf int")


def _chosen_leaves(forest: Forest, points: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, tree, leaf)`` of each point's ``probes`` nearest leaves of all trees."""
    # twice as many leaves of each tree as it gives on average
    node, penalty = forest.nearest_leaves(points, min(BEAM, max(8, -(-2 * probes // forest.trees))))
    beam = node.shape[2]
    flat = penalty.reshape(len(points), -1)
    probes = min(probes, flat.shape[1])
    best = np.argpartition(flat, probes - 1, axis=1)[:, :probes]
    row = np.repeat(np.arange(len(points)), probes)
    best = best.ravel()
    return row, best // beam, node.reshape(len(points), -1)[row, best]


def route_queries(queries: DataFrame, forest: Forest, probes: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Queries copied to the cells of their nearest leaves, with the leaves to look into there."""
    shift = _boughs(forest, tile_rows)
    per_tree = 1 << (forest.depth - shift)
    vec = queries.schema["q_vec"].dataType.simpleString()

    def route(batches):
        for batch in batches:
            points = _lifted(_matrix(batch.column("q_vec")))
            for rows in forest.point_steps(len(points)):
                row, tree, leaf = _chosen_leaves(forest, points[rows], probes)
                cell = tree * per_tree + (leaf >> shift)
                order = np.lexsort((leaf, cell, row))
                row, cell, leaf = row[order], cell[order], leaf[order]
                first = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(cell) != 0)]))
                ends = np.concatenate([first, [len(row)]]).astype(np.int32)
                part = batch.slice(rows.start, rows.stop - rows.start)
                picked = part.select(["q_id", "q_vec", "k", "floor"]).take(pa.array(row[first]))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(cell[first], pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(leaf, pa.int32()))],
                    names=["q_id", "q_vec", "k", "floor", "cell", "leaves"],
                )

    schema = f"q_id bigint, q_vec {vec}, k int, floor double, cell int, leaves array<int>"
    return queries.mapInArrow(route, schema=schema)


def _best_in_leaves(without_self: bool):
    """Per-block kernel: each query's best k base rows of the leaves it names."""

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _HITS_ARROW.empty_table()
        b_id, leaf = right["b_id"].to_numpy(), right["leaf"].to_numpy()
        order = np.lexsort((b_id, leaf))
        b_id, leaf, base = b_id[order], leaf[order], _matrix(right["b_vec"])[order]
        q_id, k, vectors = left["q_id"].to_numpy(), left["k"].to_numpy(), _matrix(left["q_vec"])
        lists = left["leaves"].combine_chunks()
        wanted, of_query = lists.flatten().to_numpy(), np.repeat(np.arange(len(q_id)), np.diff(lists.offsets.to_numpy()))
        size = np.searchsorted(leaf, wanted, "right") - np.searchsorted(leaf, wanted, "left")
        met = np.bincount(of_query, size, len(q_id)).astype(np.int64)
        parts = []
        for rows in _steps(len(q_id), max(1, int(met.max())), of=BLOCK_CELLS):
            n, width = rows.stop - rows.start, max(1, int(met[rows].max()))
            cost, who, filled = np.full((n, width), np.inf), np.zeros((n, width), np.int64), np.zeros(n, np.int64)
            mine = (of_query >= rows.start) & (of_query < rows.stop) & (size > 0)
            by_leaf = np.flatnonzero(mine)[np.argsort(wanted[mine], kind="stable")]
            for some in np.split(by_leaf, np.flatnonzero(np.diff(wanted[by_leaf])) + 1) if len(by_leaf) else []:
                low = np.searchsorted(leaf, wanted[some[0]], "left")
                here = slice(low, low + size[some[0]])
                asking = of_query[some]
                sim = np.round(vectors[asking] @ base[here].T, SIMILARITY_DIGITS) + 0.0
                if without_self:
                    sim[q_id[asking][:, None] == b_id[None, here]] = -np.inf
                at = asking - rows.start
                place = filled[at][:, None] + np.arange(sim.shape[1])
                cost[at[:, None], place], who[at[:, None], place] = -sim, b_id[None, here]
                filled[at] += sim.shape[1]
            row, col = _top_of_row(cost, k[rows])
            parts.append(pa.table([q_id[rows][row], who[row, col], -cost[row, col], k[rows][row]], schema=_HITS_ARROW))
        return pa.concat_tables(parts)

    return kernel


def _needed_probes(forest: Forest, points: np.ndarray, row: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """How many leaves must be probed until the one of each true neighbour comes, ascending; infinite if none does."""
    needed = []
    for part in forest.point_steps(len(points)):
        node, penalty = forest.nearest_leaves(points[part])
        flat = np.sort(penalty.reshape(len(node), -1), axis=1)
        for r in range(part.start, part.stop):
            for leaves in forest.leaves(vectors[row == r]):
                there = penalty[r - part.start][node[r - part.start] == leaves[:, None]]
                needed.append(np.searchsorted(flat[r - part.start], there.min(), "right") if len(there) else np.inf)
    return np.sort(np.array(needed, np.float64))


def plan_forest(
    queries: DataFrame, base: DataFrame, rows: int, most: int, *, without_self: bool = False, recall: float = FOREST_RECALL,
    trees: tuple[int, ...] = TREES, seed: int = 0,
) -> tuple[Forest, int]:
    """The planes and the number of leaves to probe that hold ``recall`` of the true neighbours of a sample.

    Of the numbers of trees it takes the least for which that many leaves hold at most SHARE of the base rows, or
    that with the fewest rows. The sample are up to 256 queries chosen by a hash, compared with all base rows once.
    """
    forest = fit_forest(base, rows, max(trees), seed=seed)
    points, true = sample_neighbours(queries, base, most, without_self=without_self)
    if not len(points) or not true.num_rows:
        return forest.first(min(trees)), 1
    of_id = base.join(
        F.broadcast(queries.sparkSession.createDataFrame(pa.table({"b_id": true["b_id"]})).distinct()), "b_id", "left_semi"
    ).select("b_id", "b_vec").toArrow()  # the sample's neighbours
    ids = of_id["b_id"].to_numpy()
    by_id = np.argsort(ids)
    vectors = _lifted(_matrix(of_id["b_vec"]))[by_id[np.searchsorted(ids[by_id], true["b_id"].to_numpy())]]
    row, reached = true["q_id"].to_numpy(), []
    for n in sorted(trees):
        part = forest.first(n)
        needed = _needed_probes(part, _lifted(points), row, vectors)
        probes = needed[math.ceil(recall * len(needed)) - 1]
        if not np.isinf(probes):
            reached.append((probes / (1 << part.depth), n, int(probes)))
            if reached[-1][0] <= SHARE:
                return part, int(probes)
    if not reached:
        return forest, forest.trees * min(BEAM, 1 << forest.depth)
    _, n, probes = min(reached)
    return forest.first(n), probes


def search_forest(
    queries: DataFrame, forest: Forest, leaved: DataFrame, probes: int, *, without_self: bool = False, most: int | None = None,
    tile_rows: int = TILE_ROWS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(q_id, b_id, sim, dist, rank)`` of queries ``(q_id, q_vec, k, floor)`` among the rows of :func:`assign_leaves`."""
    cells = forest.trees << (forest.depth - _boughs(forest, tile_rows))
    # both are counted by cell before they meet
    routed, leaved = cut_lineage(route_queries(queries, forest, probes, tile_rows)), cut_lineage(leaved)
    hits = best_in_cells(
        routed, leaved, few_cells=cells <= MAX_PIVOTS,
        tile_rows=2 * tile_rows, chunk_rows=chunk_rows, kernel=_best_in_leaves(without_self),
    )
    # several trees may find the same row: it takes one place
    place = F.dense_rank().over(W.partitionBy("q_id").orderBy(F.desc("sim"), F.asc("b_id")))
    ranked = hits.withColumn("rank", place)
    ranked = ranked if most is None else ranked.where(F.col("rank") <= most)
    ranked = ranked.where(F.col("rank") <= F.col("k")).dropDuplicates(["q_id", "rank"])
    return ranked.select("q_id", "b_id", "sim", angular_from_cosine(F.col("sim")).alias("dist"), "rank")


def rows_compared(queries: DataFrame, forest: Forest, leaved: DataFrame, probes: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(q_id, rows)``: how many base rows each query is compared with, a row counted once per tree that shows it."""
    shift = _boughs(forest, tile_rows)
    per_tree = 1 << (forest.depth - shift)
    tree = F.floor(F.col("cell") / per_tree)
    sizes = leaved.groupBy(tree.alias("tree"), "leaf").agg(F.count("*").alias("n"))
    routed = route_queries(queries, forest, probes, tile_rows).select("q_id", tree.alias("tree"), F.explode("leaves").alias("leaf"))
    return routed.join(sizes, ["tree", "leaf"], "left").groupBy("q_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
