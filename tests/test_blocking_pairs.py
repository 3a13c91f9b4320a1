from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.operators import blocking, pairs


@pytest.fixture(scope="module")
def offers(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        vec = [float(x) for x in rng.normal(size=8)]
        master = None if i % 7 == 0 else f"m{i % 6}"
        rows.append((i, f"name {i}", vec, i % 2, i % 3, None if i % 4 == 0 else i % 5, None if i % 9 == 0 else i % 4, master))
    schema = ("id bigint, name string, vec array<float>, quantity int, volume int, weight int, "
              "outlet_id int, master_product string")
    return spark.createDataFrame(rows, schema).cache()


def neighbours(offers, k):
    rows = offers.orderBy("id").collect()
    m = np.array([r["vec"] for r in rows], dtype=np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    sim = np.round(m @ m.T, 9)
    out = {}
    for i in range(len(rows)):
        others = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-sim[i, j], j))
        out[i] = [i, *others][: k[i] if isinstance(k, dict) else k]
    return rows, sim, out


def test_block_pairs_matches_a_row_by_row_check(offers):
    rows, sim, near = neighbours(offers, 20)
    want = set()
    for i, ids in near.items():
        for j in ids:
            a, b = rows[i], rows[j]
            dist = np.sqrt(max(0.0, 2 - 2 * sim[i, j]))
            either = any(a[c] is not None and a[c] == b[c] for c in ("volume", "weight"))
            apart = a["outlet_id"] is None or b["outlet_id"] is None or a["outlet_id"] != b["outlet_id"]
            if i != j and dist < 1.4 and either and a["quantity"] == b["quantity"] and apart:
                want.add((min(i, j), max(i, j)))
    got = [(r["id1"], r["id2"]) for r in blocking.block_pairs(offers, 20, 0.3).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_threshold_zero_or_none_is_off(offers):
    loose = blocking.block_pairs(offers, 20, None).count()
    assert loose == blocking.block_pairs(offers, 20, 0).count() > blocking.block_pairs(offers, 20, 0.5).count()


def test_null_rules_of_the_attribute_test(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, None, None, 5, 5, None, 3), (2, 1, 1, None, None, 5, 6, 1, 2), (3, None, None, 2, 2, 1, 2, 1, 2),
         (4, 1, 1, 2, 2, 1, 2, 3, 3)],
        "i int, quantity1 int, quantity2 int, volume1 int, volume2 int, weight1 int, weight2 int, "
        "outlet_id1 int, outlet_id2 int",
    )
    assert [r["i"] for r in df.where(blocking.attributes_agree()).collect()] == [1]


def test_missing_columns_are_named(offers):
    with pytest.raises(ValueError, match="outlet_id"):
        blocking.block_pairs(offers.drop("outlet_id"), 5)


def test_hard_negatives(offers):
    counts = {}
    for r in offers.collect():
        counts[r["master_product"]] = counts.get(r["master_product"], 0) + 1
    rows, _, _ = neighbours(offers, 1)
    k = {r["id"]: round(1.5 * counts[r["master_product"]]) for r in rows}
    rows, _, near = neighbours(offers, k)
    want = [
        (j, i) for i, ids in near.items() for j in ids
        if rows[i]["master_product"] and rows[j]["master_product"] != rows[i]["master_product"]
    ]
    got = [(r["id1"], r["id2"]) for r in pairs.hard_negatives(offers).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("block_rows", [3, 1000])
def test_all_positives_with_and_without_blocks(offers, block_rows):
    groups = {}
    for r in offers.collect():
        if r["master_product"]:
            groups.setdefault(r["master_product"], []).append(r["id"])
    want = {p for ids in groups.values() for p in combinations(sorted(ids), 2)}
    got = [(r["id1"], r["id2"]) for r in pairs.all_positives(offers, block_rows=block_rows).collect()]
    assert len(got) == len(want) and set(got) == want


def test_random_positives_are_reproducible(offers):
    masters = {r["id"]: r["master_product"] for r in offers.collect()}
    first = sorted(map(tuple, pairs.random_positives(offers, draws=30).collect()))
    again = sorted(map(tuple, pairs.random_positives(offers.repartition(7), draws=30).collect()))
    assert first == again and len(first) == 30 * 6
    assert all(a != b and masters[a] == masters[b] == m for m, _, a, b in first)
    assert first != sorted(map(tuple, pairs.random_positives(offers, draws=30, seed=1).collect()))


def test_rank_in_group_by_blocks(offers):
    labelled = offers.where("master_product IS NOT NULL").select("id", "master_product")
    out = pairs._rank_in_group(labelled, "master_product", block_rows=2).collect()
    slots = {}
    for r in out:
        slots.setdefault(r["master_product"], []).append(r["__slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_training_pairs_are_canonical(offers):
    rows = pairs.training_pairs(offers).collect()
    assert all(r["id1"] < r["id2"] for r in rows)
    assert len({(r["id1"], r["id2"], r["match"]) for r in rows}) == len(rows)


def test_named_training_pairs_prefer_the_first_set(offers):
    rows = pairs.training_pairs_named(offers).collect()
    assert len({(r["id1"], r["id2"]) for r in rows}) == len(rows)
    assert all(r["name1"] is not None for r in rows if r["match"] == 0)
    assert any(r["name1"] is None for r in rows if r["match"] == 1)


def test_one_shot_pairs_drop_missing_texts(offers):
    rows = pairs.one_shot_pairs(offers).collect()
    assert all(r["sent1"] and r["sent2"] for r in rows)
    labelled = offers.where("master_product IS NOT NULL").count()
    assert sum(r["match"] for r in rows) == labelled


def test_block_to_masters_checks_the_category_after_top_k(spark, offers):
    products = offers.withColumn("product_category_id", F.col("id") % 2)
    masters = offers.where("id < 10").withColumn("product_category_id", F.col("id") % 2)
    rows = blocking.block_to_masters(products, masters, 4, -1.0).collect()
    assert all(r["id1"] % 2 == r["id2"] % 2 for r in rows)
    assert 0 < len(rows) < 60 * 4


def test_pairs_of_copied_vectors_are_not_shuffled(spark):
    """Lists shared by copies of a vector give the pairs that the search row by row gives, ties and zero vectors too."""
    rng = np.random.default_rng(3)
    rows = [
        (i * 7 % 150, f"n{i % 5}", None if i % 37 == 5 else [float(x) for x in rng.integers(-1, 2, size=3)],
         None if i % 11 == 0 else f"m{rng.integers(0, 5)}")
        for i in range(150)
    ]
    copied = spark.createDataFrame(rows, "id bigint, name string, vec array<float>, master_product string").cache()
    want = [tuple(r) for r in pairs._searched_negatives(copied, "master_product", "vec", {}).collect()]
    assert len(want) > 500
    assert sorted(tuple(r) for r in pairs.hard_negatives(copied).collect()) == sorted(want)
    names = {r["id"]: r["name"] for r in copied.collect()}
    positives = [tuple(r) for r in pairs.all_positives(copied).collect()]
    both = pairs.training_pairs(copied, columns=["name"])
    once = [(a, b, 0) for a, b in {(min(p), max(p)) for p in want}] + [(a, b, 1) for a, b in positives]
    assert sorted(tuple(r) for r in both.collect()) == sorted((a, b, m, names[a], names[b]) for a, b, m in once)
    named = pairs.training_pairs_named(copied)
    far = [tuple(r) for r in pairs.hard_positives(copied).collect()]
    first = [(a, names[a], names[b], b, 0) for a, b in want] + [(a, names[a], names[b], b, 1) for a, b in far]
    first += [(a, None, None, b, 1) for a, b in set(positives) - set(far)]
    assert sorted(map(str, map(tuple, named.collect()))) == sorted(map(str, first))
    # pairs are not made distinct, nor ranked: both would shuffle every one of them
    for df in (both, named):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate [id1" not in plan and "windowspecdefinition(id1" not in plan


def test_repeated_ids_make_pairs_as_before(spark):
    rows = [(i % 20, f"n{i}", [float(i % 4), 1.0], f"m{i % 3}") for i in range(40)]
    twice = spark.createDataFrame(rows, "id bigint, name string, vec array<float>, master_product string").cache()
    found = pairs.training_pairs(twice).collect()
    assert len(found) == len({tuple(r) for r in found}) and all(r["id1"] <= r["id2"] for r in found)
