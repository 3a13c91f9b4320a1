"""Clusters of accepted pairs: connected components and average-link merging."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import score_to_label
from ..functions.ranks import global_rank
from ..session import cut_lineage, small_tasks
from .rows import groups_with

# Smallest cluster kept, score limit of the hierarchical variant.
MIN_CLUSTER_SIZE = 3
HIERARCHICAL_THRESHOLD = 0.35

# Links of a component up to which one task does all its merges, and links that a task takes at a time.
TASK_LINKS = 1 << 20
SOLVED_LINKS = 1 << 18
# Edges one task holds while contracting its partition.
CONTRACT_EDGES = 1 << 21


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every node's larger neighbours to its smallest neighbour (or itself)."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    joined = both.where(F.col("b") > F.col("a")).join(lowest, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect every node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = down.groupBy("a").agg(F.min("b").alias("m"))
    ends = F.explode(F.array("a", "b")).alias("a")
    linked = down.join(lowest, "a").select(ends, F.col("m").alias("b"))
    return linked.where(F.col("a") != F.col("b")).distinct()


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of some edges with the smallest node it hangs together with, roots left out.

    Loops stay as they are: they may be all that is known of a node.
    """
    nodes, numbers = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = numbers[: len(a)], numbers[len(a):]
    parent = np.arange(len(nodes))
    while True:
        low = np.minimum(parent[left], parent[right])
        high = np.maximum(parent[left], parent[right])
        if np.array_equal(low, high):
            break
        np.minimum.at(parent, high, low)
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
    member, loops = parent != np.arange(len(nodes)), np.unique(a[a == b])
    return np.concatenate([nodes[member], loops]), np.concatenate([nodes[parent[member]], loops])


def _contract(edges: DataFrame) -> DataFrame:
    """Replace the edges of each partition by stars: a combine before the next shuffle.

    A task holds at most CONTRACT_EDGES edges at a time and passes its stars on when
    they no longer shrink to half of that.
    """

    def contract(batches):
        held, size = [], 0
        for batch in batches:
            held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            size += batch.num_rows
            if size >= CONTRACT_EDGES:
                held = [_stars(*map(np.concatenate, zip(*held)))]
                size = len(held[0][0])
                if size > CONTRACT_EDGES // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["a", "b"])
                    held, size = [], 0
        if held:
            stars = _stars(*map(np.concatenate, zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in stars], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(contract, schema="a bigint, b bigint")


def _is_settled(edges: DataFrame) -> bool:
    """Whether the edges form stars: one edge per member, no centre being a member.

    Steps never join or part components, so each star is then one component.
    """
    roles = F.array(
        F.struct(F.col("a").alias("id"), F.lit(1).alias("links"), F.lit(0).alias("centre")),
        F.struct(F.col("b").alias("id"), F.lit(0).alias("links"), F.lit(1).alias("centre")),
    )
    nodes = edges.select(F.inline(roles)).groupBy("id").agg(
        F.sum("links").alias("links"), F.max("centre").alias("centre")
    )
    return nodes.where("links > 1 OR links = 1 AND centre = 1").isEmpty()


def connected_components(edges: DataFrame, a: str = "id1", b: str = "id2") -> DataFrame:
    """``(id, component)`` for every node of an edge; the label is the smallest id.

    Alternating large-star and small-star steps (Kiveris et al., 2014), which end
    after O(log^2 n) rounds. Each step aggregates a minimum per node with map-side
    combine and joins it back, so no node's neighbours are gathered; edges that meet in
    one partition are contracted before they are shuffled again; adaptive
    skew-join handling splits the hub of a very large component. A reliable
    checkpoint ends each round. Tasks keep their size as edges grow, see :func:`small_tasks`.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).cast("bigint").alias("a"), F.least(a, b).cast("bigint").alias("b")
    )
    with small_tasks(edges.sparkSession):
        # a member is in one star of a task's: dealt by it, no task gets many of them, and equal edges meet
        start = cut_lineage(_contract(_contract(pairs).repartition("a")))
        loops, current = start.where("a = b").select(F.col("a").alias("id")), start.where("a != b")
        while not _is_settled(current):
            current = cut_lineage(_contract(_small_star(_large_star(current))))
    # every edge now points from a member to its component's smallest id
    members = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    linked = members.unionAll(roots)
    alone = loops.distinct().join(linked, "id", "left_anti").select("id", F.col("id").alias("component"))
    return linked.unionAll(alone)


def accepted(matches: DataFrame) -> DataFrame:
    """Pairs marked as a match; rows with a missing value are dropped first."""
    return matches.na.drop().where(F.col("match") == 1).select("id1", "id2")


def number_clusters(labelled: DataFrame, label: str = "component", out: str = "cluster") -> DataFrame:
    """Replace cluster labels by 0..n-1 in label order; only distinct labels are ranked."""
    ranked = global_rank(labelled.select(label).distinct(), label, out="__rank")
    ids = ranked.select(label, (F.col("__rank") - 1).alias(out))
    return labelled.join(ids, label).select("id", out)


def cluster_matches(
    matches: DataFrame, products: DataFrame, min_cluster_size: int = MIN_CLUSTER_SIZE,
    renumber: bool = True,
) -> DataFrame:
    """``(id, cluster)`` of the components that have at least ``min_cluster_size`` products."""
    known = products.select(F.col("id").cast("bigint").alias("id")).distinct()
    components = connected_components(accepted(matches)).join(known, "id", "left_semi")
    if min_cluster_size <= 1:
        components = known.join(components, "id", "left").withColumn(
            "component", F.coalesce("component", "id")
        )
    kept = groups_with(components, "component", min_cluster_size)
    if not renumber:
        return kept.select("id", F.col("component").alias("cluster"))
    return number_clusters(cut_lineage(kept))


def cluster_all(products: DataFrame, matches: DataFrame, out: str = "fin") -> DataFrame:
    """Every product with its cluster number, products without a match included."""
    components = connected_components(accepted(matches))
    labelled = products.join(components, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    ranked = global_rank(labelled.select("component").distinct(), "component", out="__rank")
    ids = ranked.select("component", (F.col("__rank") - 1).alias(out))
    return labelled.join(ids, "component").select(*products.columns, out)


def _means(links: DataFrame) -> Column:
    return F.round(F.col("total") / (F.col("na") * F.col("nb")), 9)


def _merge_closest(a, b, total, size: dict, threshold: float) -> dict[int, int]:
    """Average-link merging of clusters in memory, one pair at a time: the new label of every cluster that gets one.

    A pair's mean never rises through other merges, so the queue may hold means of earlier times:
    a pair that comes up with another mean than its present one goes back into the queue.
    """
    near: dict[int, dict[int, float]] = {}
    for x, y, t in zip(a, b, total):
        near.setdefault(x, {})[y] = t
        near.setdefault(y, {})[x] = t
    label = {x: x for x in near}
    parts = {x: [x] for x in near}

    def entry(x: int, y: int) -> tuple:
        mean = round(near[x][y] / (size[x] * size[y]), 9)
        lo, hi = sorted((label[x], label[y]))
        return (-mean, lo, hi, x, y)

    queue = [e for x, y in zip(a, b) if -(e := entry(x, y))[0] > threshold]
    heapq.heapify(queue)
    while queue:
        top = heapq.heappop(queue)
        x, y = top[3:]
        if y not in near.get(x, ()):
            continue
        now = entry(x, y)
        if now != top:
            if -now[0] > threshold:
                heapq.heappush(queue, now)
            continue
        # the one with fewer neighbours goes into the other
        if len(near[x]) < len(near[y]):
            x, y = y, x
        del near[x][y], near[y][x]
        size[x] += size.pop(y)
        label[x] = min(label[x], label.pop(y))
        parts[x] += parts.pop(y)
        for z, t in near.pop(y).items():
            del near[z][y]
            near[x][z] = near[z][x] = near[x].get(z, 0.0) + t
            moved = entry(x, z)
            if -moved[0] > threshold:
                heapq.heappush(queue, moved)
    return {old: label[x] for x, olds in parts.items() for old in olds if old != label[x]}


def _solve_in_tasks(links: DataFrame, threshold: float) -> DataFrame:
    """``(old, new)`` labels of all merges in components that each fit into a task, several of them at a time."""

    def solve(batches):
        held, now, size = [], None, 0

        def flush():
            a, b, total, na, nb = (np.concatenate(x).tolist() for x in zip(*held))
            found = _merge_closest(a, b, total, {**dict(zip(a, na)), **dict(zip(b, nb))}, threshold)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["old", "new"]
            )

        for batch in batches:
            component = batch.column("component").to_numpy()
            columns = [batch.column(c).to_numpy() for c in ("a", "b", "total", "na", "nb")]
            # whole components only: cut before each first row of one
            cuts = [0, *(np.flatnonzero(np.diff(component)) + 1).tolist(), len(component)]
            for first, last in zip(cuts, cuts[1:]):
                if last == first:
                    continue
                if size >= SOLVED_LINKS and component[first] != now:
                    yield flush()
                    held, size = [], 0
                now, size = component[first], size + last - first
                held.append([c[first:last] for c in columns])
        if held:
            yield flush()

    together = links.repartition("component").sortWithinPartitions("component", "a", "b")
    return together.select("component", "a", "b", "total", "na", "nb").mapInArrow(solve, schema="old bigint, new bigint")


def _merge_mutual(links: DataFrame, threshold: float) -> DataFrame:
    """``(old, new)`` labels of one round of merges: every two clusters that are one another's closest."""
    sided = links.select("a", "b", _means(links).alias("mean")).where(F.col("mean") > threshold)
    both = sided.unionAll(sided.select(F.col("b").alias("a"), F.col("a").alias("b"), "mean"))
    # closest cluster; equal means go to the pair with the smaller (low, high) labels,
    # one order for both ends, so the best pair overall is always mutual
    order = F.struct(F.col("mean"), (-F.least("a", "b")).alias("lo"), (-F.greatest("a", "b")).alias("hi"))
    best = both.groupBy("a").agg(F.max_by("b", order).alias("b"))
    back = best.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return best.join(back, ["a", "b"]).where("a < b").select(F.col("b").alias("old"), F.col("a").alias("new"))


def _relinked(links: DataFrame, merges: DataFrame) -> DataFrame:
    """Links between the clusters after a round of merges, each of which joins two clusters."""
    ends = links.select(F.inline(F.array(
        F.struct(F.col("a").alias("old"), F.col("na").alias("n")), F.struct(F.col("b").alias("old"), F.col("nb").alias("n"))
    )))
    old_sizes = ends.groupBy("old").agg(F.first("n").alias("n"))
    moved_sizes = old_sizes.join(merges, "old", "left")
    sizes = moved_sizes.groupBy(F.coalesce("new", "old").alias("c")).agg(F.sum("n").alias("n"))
    moved = links
    for side in ("a", "b"):
        m = merges.select(F.col("old").alias(side), F.col("new").alias(f"new_{side}"))
        moved = moved.join(m, side, "left").withColumn(side, F.coalesce(f"new_{side}", side)).drop(f"new_{side}")
    regrouped = (
        moved.where("a != b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .agg(F.sum("total").alias("total"))
    )
    for side in ("a", "b"):
        regrouped = regrouped.join(sizes.select(F.col("c").alias(side), F.col("n").alias(f"n{side}")), side)
    return regrouped.select("a", "b", "total", "na", "nb")


def average_link_clusters(
    scored: DataFrame, threshold: float = HIERARCHICAL_THRESHOLD, task_links: int = TASK_LINKS
) -> DataFrame:
    """``(id, cluster)`` by average-link merging of scored pairs, clusters of two or more.

    Two clusters are as close as the mean score over all their member pairs, a
    missing pair counting 0; the closest two above the threshold are merged until none are. Merges never
    cross the components of the links above the threshold. So components of at most ``task_links``
    links are solved as a whole inside a task, and leave the loop. Only larger ones go through rounds of
    joins over the cluster graph, in which all pairs of clusters that are one another's closest
    merge at once; as average link is reducible, these are the same merges. Before each round links that no
    merge can bring above the threshold any more drop out, which may part a component into ones that fit.
    The label is the smallest id. Pairs of a row with itself and scores of 0 or less take no part; of repeated pairs the best counts.
    """
    pairs = scored.where((F.col("prob") > 0) & (F.col("id1") != F.col("id2")))
    links = cut_lineage(
        pairs.groupBy(F.least("id1", "id2").cast("bigint").alias("a"), F.greatest("id1", "id2").cast("bigint").alias("b"))
        .agg(F.max("prob").cast("double").alias("total"))
        .select("a", "b", "total", F.lit(1).cast("bigint").alias("na"), F.lit(1).cast("bigint").alias("nb"))
    )
    # the label that each id, or the label it had, has got; later rounds look up the labels of earlier ones
    rounds: list[DataFrame] = []
    while True:
        close = links.where(_means(links) > threshold)
        found = connected_components(close, "a", "b")
        side = lambda k: found.select(F.col("id").alias(k), F.col("component").alias(f"c{k}"))
        inside = links.join(side("a"), "a").join(side("b"), "b").where("ca = cb").withColumnRenamed("ca", "component").drop("cb")
        sizes = inside.groupBy("component").agg(F.count("*").alias("links"))
        sized = cut_lineage(inside.join(sizes, "component"))
        merges = _solve_in_tasks(sized.where(F.col("links") <= task_links), threshold)
        rest = sized.where(F.col("links") > task_links).select("a", "b", "total", "na", "nb")
        if rest.isEmpty():
            rounds.append(cut_lineage(merges))
            break
        mutual = cut_lineage(_merge_mutual(rest, threshold))
        rounds.append(cut_lineage(merges.unionAll(mutual)))
        links = cut_lineage(_relinked(rest, mutual))
    labels = rounds[-1].select(F.col("old").alias("id"), F.col("new").alias("cluster"))
    for earlier in rounds[-2::-1]:
        later = labels.select(F.col("id").alias("new"), F.col("cluster").alias("last"))
        here = earlier.join(later, "new", "left").select(F.col("old").alias("id"), F.coalesce("last", "new").alias("cluster"))
        labels = cut_lineage(here.unionAll(labels))
    named = labels.select(F.col("cluster").alias("id"), "cluster").distinct()
    return labels.unionAll(named)


def threshold_edges(scored: DataFrame, threshold: float) -> DataFrame:
    """Scored pairs as labelled pairs, ``match`` = 1 above the threshold."""
    return scored.withColumn("match", score_to_label("prob", threshold))
