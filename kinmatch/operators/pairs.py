"""Training pairs: hard negatives, positives, one-shot and master-anchored sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.numeric import draw
from ..session import cut_lineage
from .knn import farthest_in_group, knn_join, shared_lists
from .rows import canonical_pairs, first_per_key, lookup_both, union_all

# Neighbours per group member, draws per group, one-shot neighbours.
HARD_NEGATIVE_FACTOR = 1.5
RANDOM_PAIRS_PER_MASTER = 100
ONE_SHOT_NEIGHBOURS = 5
MASTER_NEIGHBOURS = 10

PAIR_BLOCK_ROWS = 2_000


def _other_master(own: str, other: str) -> Column:
    """True for another master and for a neighbour without one."""
    return F.coalesce(F.col(own) != F.col(other), F.lit(True))


def _with_group_size(products: DataFrame, master: str) -> DataFrame:
    sizes = products.where(F.col(master).isNotNull()).groupBy(master).agg(F.count("*").alias("__n"))
    return products.join(sizes, master, "left")


def _neighbours_asked() -> Column:
    """The number of neighbours that an offer looks at, itself left out."""
    return F.bround(F.lit(HARD_NEGATIVE_FACTOR) * F.col("__n"), 0).cast("int") - 1


def _unique_ids(products: DataFrame) -> bool:
    rows, ids = products.agg(F.count("*"), F.count_distinct("id")).first()
    return rows == ids


def _shared_negatives(products: DataFrame, columns: Sequence[str], master: str, vec: str, distinct: bool, search: dict) -> DataFrame | None:
    """Hard negatives from neighbour lists that copies of a vector share, for unique ids; None where there are no such lists.

    ``(id1, id2)`` and both members' ``columns``, suffixed 1 and 2. What a member has goes to its list before a list is
    given to its queries, so the pairs themselves, many more than either, are not shuffled. With ``distinct`` a pair is
    canonical and comes once: where both members have found each other, that with the smaller id gives it.
    """
    # ids are unique, so a master's smallest one stands for it
    sizes = products.where(F.col(master).isNotNull()).groupBy(master).agg(
        F.count("*").alias("__n"), F.min(F.col("id").cast("bigint")).alias("__master")
    )
    sized = products.join(sizes, master, "left")
    carried = ["__master", *columns]
    base = sized.select("id", vec, *[F.col(c).alias(f"{c}_b") for c in carried])
    offers = sized.where(F.col(master).isNotNull())
    shared = shared_lists(
        offers, base, _neighbours_asked(), vec=vec, without_self=True, columns=[f"{c}_b" for c in carried], **search
    )
    if shared is None:
        return None
    shared.asking = cut_lineage(shared.asking)
    own = offers.select(F.col("id").cast("bigint").alias("q_id"), *[F.col(c).alias(f"{c}_q") for c in carried])
    lists = shared.lists
    if distinct:
        last = shared.last().select(F.col("q_id").alias("b_id"), "last_sim", "last_id", F.lit(True).alias("asks"))
        lists = lists.join(last, "b_id", "left")
    given = shared.given(shared.asking.join(own, "q_id"), lists).where(_other_master("__master_q", "__master_b"))
    if not distinct:
        return given.select(
            F.col("b_id").alias("id1"), F.col("q_id").alias("id2"),
            *[F.col(f"{c}{of}").alias(f"{c}{s}") for s, of in (("1", "_b"), ("2", "_q")) for c in columns],
        )
    # whether the neighbour has found the offer as well: the offer comes no later than the neighbour's last one
    last, sim = F.col("last_sim"), F.col("sim")
    reached = last.isNull() | (sim > last) | ((sim == last) & (F.col("q_id") <= F.col("last_id")))
    both = F.coalesce("asks", F.lit(False)) & reached
    first = F.col("q_id") < F.col("b_id")
    of = lambda c, one, other: F.when(first, F.col(f"{c}{one}")).otherwise(F.col(f"{c}{other}"))
    return given.where(first | ~both).select(
        F.least("q_id", "b_id").alias("id1"), F.greatest("q_id", "b_id").alias("id2"),
        *[of(c, "_q", "_b").alias(f"{c}1") for c in columns], *[of(c, "_b", "_q").alias(f"{c}2") for c in columns],
    )


def hard_negatives(products: DataFrame, *, master: str = "master_product", vec: str = "vec",
                   **search) -> DataFrame:
    """``(id1, id2)`` = (neighbour of another master, labelled offer).

    An offer looks at as many neighbours as 1.5 times its master's offers,
    itself included. Unlabelled neighbours count; unlabelled offers ask nothing.
    """
    shared = _shared_negatives(products, [], master, vec, False, search) if _unique_ids(products) else None
    return _searched_negatives(products, master, vec, search) if shared is None else shared


def _searched_negatives(products: DataFrame, master: str, vec: str, search: dict) -> DataFrame:
    """Hard negatives row by row, whatever the ids."""
    sized = _with_group_size(products, master)
    offers = sized.where(F.col(master).isNotNull())
    hits = knn_join(offers, products, _neighbours_asked(), vec=vec, without_self=True, **search)
    labels = products.select("id", master)
    own = labels.select(F.col("id").alias("q_id"), F.col(master).alias("__own"))
    other = labels.select(F.col("id").alias("b_id"), F.col(master).alias("__other"))
    return (
        hits.join(own, "q_id")
        .join(other, "b_id")
        .where(_other_master("__own", "__other"))
        .select(F.col("b_id").alias("id1"), F.col("q_id").alias("id2"))
    )


def all_positives(products: DataFrame, *, master: str = "master_product", seq: str = "id",
                  block_rows: int = PAIR_BLOCK_ROWS, columns: Sequence[str] = ()) -> DataFrame:
    """Every pair of offers of one master, ``id1`` before ``id2`` in ``seq`` order, with both members' ``columns``, suffixed 1 and 2.

    The result itself is quadratic in the size of a master. A large master is cut
    into blocks and the work goes out by pair of blocks, so that no task ever
    joins more than ``block_rows`` with ``block_rows``.
    """
    sizes = products.where(F.col(master).isNotNull()).groupBy(master).agg(
        F.ceil(F.count("*") / block_rows).cast("int").alias("__blocks")
    )
    rows = products.select(F.col("id"), F.col(seq).alias("__seq"), master, *[F.col(c).alias(f"__own_{c}") for c in columns]).join(sizes, master)
    rows = rows.withColumn("__own", F.pmod(F.xxhash64("id"), F.col("__blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    left = rows.select(
        master, F.col("__own").alias("__l"), every.alias("__r"),
        F.col("id").alias("id1"), F.col("__seq").alias("__s1"), *[F.col(f"__own_{c}").alias(f"{c}1") for c in columns],
    )
    right = rows.select(
        master, every.alias("__l"), F.col("__own").alias("__r"),
        F.col("id").alias("id2"), F.col("__seq").alias("__s2"), *[F.col(f"__own_{c}").alias(f"{c}2") for c in columns],
    )
    return left.join(right, [master, "__l", "__r"]).where("__s1 < __s2").select(
        "id1", "id2", *[f"{c}{s}" for s in ("1", "2") for c in columns]
    )


def hard_positives(products: DataFrame, *, master: str = "master_product", vec: str = "vec",
                   **blocks) -> DataFrame:
    """Each offer with the farthest offer of its master; alone, with itself."""
    far = farthest_in_group(products, master, vec=vec, **blocks)
    return far.select(F.col("id").alias("id1"), F.col("far_id").alias("id2"))


def random_positives(products: DataFrame, *, master: str = "master_product",
                     draws: int = RANDOM_PAIRS_PER_MASTER, seed: int = 0) -> DataFrame:
    """``draws`` pairs of two different offers per master, repeats possible.

    A draw picks two different positions by hash; the members at these positions
    come from an equi-join. Masters with one offer give no pair.
    """
    labelled = products.where(F.col(master).isNotNull()).select("id", master)
    ranked = _rank_in_group(labelled, master)
    sizes = labelled.groupBy(master).agg(F.count("*").alias("__n")).where("__n >= 2")
    picks = sizes.select(
        master, "__n", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw")
    )
    first = draw(master, "draw", F.lit(1), seed=seed) % F.col("__n")
    step = draw(master, "draw", F.lit(2), seed=seed) % (F.col("__n") - 1)
    picks = picks.withColumn("__a", first)
    picks = picks.withColumn("__b", F.pmod(F.col("__a") + 1 + step, F.col("__n")))
    for side, slot in (("id1", "__a"), ("id2", "__b")):
        member = ranked.select(master, F.col("__slot").alias(slot), F.col("id").alias(side))
        picks = picks.join(member, [master, slot])
    return picks.select(master, "draw", "id1", "id2")


def _rank_in_group(rows: DataFrame, group: str, block_rows: int = 100_000) -> DataFrame:
    """0-based position of each id within its group, large groups ranked by blocks.

    Positions are only a numbering: they follow a hash, not the id.
    """
    sizes = rows.groupBy(group).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("__blocks"))
    cut = rows.join(sizes, group).withColumn(
        "__block", F.pmod(F.xxhash64("id"), F.col("__blocks")).cast("int")
    )
    # by block too: the join's partitioning alone would keep a group in one task
    cut = cut.repartition(group, "__block")
    counts = cut.groupBy(group, "__block").agg(F.count("*").alias("__n"))
    before = W.partitionBy(group).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select(
        group, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift")
    )
    inside = W.partitionBy(group, "__block").orderBy("id")
    return (
        cut.withColumn("__rn", F.row_number().over(inside))
        .join(shifts, [group, "__block"])
        .select("id", group, (F.col("__rn") - 1 + F.col("__shift")).alias("__slot"))
    )


def training_pairs_named(products: DataFrame, *, master: str = "master_product", vec: str = "vec",
                         **search) -> DataFrame:
    """Negatives, hard positives (both with names), then all positives (names NULL).

    Duplicates of an ordered ``(id1, id2)`` keep the earliest of the three sets. With unique ids only a hard positive
    is among all positives as well: there it is left out by its first member's farthest offer, which goes along.
    """
    shared = _shared_negatives(products, ["name"], master, vec, False, search) if _unique_ids(products) else None
    if shared is not None:
        far = cut_lineage(hard_positives(products, master=master, vec=vec))
        known = products.join(far.select(F.col("id1").alias("id"), F.col("id2").alias("__far")), "id", "left")
        rest = all_positives(known, master=master, columns=["__far"]).where("__far1 IS NULL OR id2 != __far1")
        return union_all(
            shared.withColumn("match", F.lit(0)), lookup_both(far, products, ["name"]).withColumn("match", F.lit(1)),
            rest.select("id1", "id2", F.lit(1).alias("match")),
        ).select("id1", "name1", "name2", "id2", "match")
    negatives = hard_negatives(products, master=master, vec=vec, **search)
    positives = hard_positives(products, master=master, vec=vec)
    named = union_all(
        negatives.select("id1", "id2", F.lit(0).alias("match"), F.lit(0).alias("__set")),
        positives.select("id1", "id2", F.lit(1).alias("match"), F.lit(1).alias("__set")),
    )
    named = lookup_both(named, products, ["name"])
    rest = all_positives(products, master=master).select(
        "id1", "id2", F.lit(1).alias("match"), F.lit(2).alias("__set")
    )
    pairs = union_all(named, rest)
    return first_per_key(pairs, ["id1", "id2"], "__set").select("id1", "name1", "name2", "id2", "match")


def training_pairs(products: DataFrame, *, master: str = "master_product", vec: str = "vec",
                   columns: Sequence[str] = (), **search) -> DataFrame:
    """Distinct canonical pairs: hard negatives labelled 0, all positives labelled 1; with both members' ``columns``, suffixed 1 and 2.

    With unique ids positives are distinct as they come, and so are negatives from shared lists (:func:`_shared_negatives`).
    """
    unique = _unique_ids(products)
    negatives = _shared_negatives(products, columns, master, vec, True, search) if unique else None
    if negatives is None:
        negatives = canonical_pairs(_searched_negatives(products, master, vec, search))
        negatives = lookup_both(negatives, products, columns, how="inner") if columns else negatives
    if unique:
        positives = all_positives(products, master=master, columns=columns)
    else:
        positives = canonical_pairs(all_positives(products, master=master))
        positives = lookup_both(positives, products, columns, how="inner") if columns else positives
    pairs = union_all(
        negatives.withColumn("match", F.lit(0)), positives.withColumn("match", F.lit(1))
    )
    return pairs.select("id1", "id2", "match", *[f"{c}{s}" for s in ("1", "2") for c in columns])


def one_shot_pairs(products: DataFrame, *, neighbours: int = ONE_SHOT_NEIGHBOURS,
                   master: str = "master_product", vec: str = "vec", **search) -> DataFrame:
    """``(sent1, sent2, match)``: names against masters of near offers (0) and the own one (1).

    ``neighbours`` counts the offer itself. Rows with a missing text are dropped,
    repeats are kept.
    """
    near = knn_join(products, products, neighbours - 1, vec=vec, without_self=True, **search)
    own = products.select(
        F.col("id").alias("q_id"), F.col("name").alias("sent1"), F.col(master).alias("__own")
    )
    other = products.select(F.col("id").alias("b_id"), F.col(master).alias("sent2"))
    negatives = (
        near.join(own, "q_id").join(other, "b_id")
        .where(_other_master("__own", "sent2"))
        .select("sent1", "sent2", F.lit(0).alias("match"))
    )
    positives = products.select(
        F.col("name").alias("sent1"), F.col(master).alias("sent2"), F.lit(1).alias("match")
    )
    return negatives.unionByName(positives).na.drop()


def master_anchored_pairs(masters: DataFrame, products: DataFrame, *,
                          neighbours: int = MASTER_NEIGHBOURS, vec: str = "vec",
                          **search) -> DataFrame:
    """Per master: near products of other masters (0) and its own products (1)."""
    hits = knn_join(masters, products, neighbours, vec=vec, **search)
    names = masters.select(F.col("id").alias("q_id"), F.col("name").alias("sent2"))
    offers = products.select(
        F.col("id").alias("b_id"), F.col("name").alias("sent1"), F.col("master_product_id").alias("__own")
    )
    negatives = (
        hits.join(names, "q_id").join(offers, "b_id")
        .where(_other_master("__own", "q_id"))
        .select("sent1", "sent2", F.lit(0).alias("match"))
    )
    own = masters.select(F.col("id").alias("master_product_id"), F.col("name").alias("sent2"))
    positives = products.select("master_product_id", F.col("name").alias("sent1")).join(
        own, "master_product_id"
    )
    return negatives.unionByName(positives.select("sent1", "sent2", F.lit(1).alias("match")))
