import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.operators import knn
from kinmatch.session import scratch_path
from kinmatch.sources.vector_index import build_index, load_index, save_index, search_index


def table(spark, vectors, first=0):
    rows = [(first + i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id bigint, vec array<float>").repartition(4)


def unit(m):
    m = np.asarray(m, dtype=np.float32).astype(np.float64)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n > 0, n, 1)


def brute(queries, base, k, without_self=False):
    sim = np.round(unit(queries) @ unit(base).T, 9) + 0.0
    out = {}
    for q in range(len(sim)):
        ids = [b for b in range(sim.shape[1]) if not (without_self and b == q)]
        ids.sort(key=lambda b: (-sim[q, b], b))
        out[q] = ids[: k[q] if hasattr(k, "__len__") else k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("q_id", "rank").collect():
        out.setdefault(r["q_id"], []).append(r["b_id"])
    return out


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    return centres[rng.integers(0, 12, 600)] + 0.15 * rng.normal(size=(600, 16))


@pytest.mark.parametrize("tile_rows", [10_000, 50])
def test_exact_matches_brute_force(spark, clustered, tile_rows):
    items = table(spark, clustered)
    got = found(knn.knn_join(items, items, 7, without_self=True, tile_rows=tile_rows, chunk_rows=64, probes=2))
    assert got == brute(clustered, clustered, 7, without_self=True)


def test_a_third_of_all_rows_are_copies(spark, clustered):
    vectors = np.array(clustered)
    vectors[::3] = vectors[0]
    items = table(spark, vectors)
    got = found(knn.knn_join(items, items, 5, without_self=True, tile_rows=40, chunk_rows=64, probes=2))
    assert got == brute(vectors, vectors, 5, without_self=True)


def test_zero_vectors_are_at_right_angles(spark, clustered):
    vectors = np.array(clustered[:200])
    vectors[[3, 50, 51]] = 0
    items = table(spark, vectors)
    got = found(knn.knn_join(items, items, 4, without_self=True, tile_rows=30, probes=1))
    assert got == brute(vectors, vectors, 4, without_self=True)


def test_k_per_query(spark, clustered):
    items = table(spark, clustered[:150]).withColumn("k", (F.col("id") % 5).cast("int"))
    got = found(knn.knn_join(items, items, F.col("k"), tile_rows=20, probes=2))
    want = brute(clustered[:150], clustered[:150], [i % 5 for i in range(150)])
    assert got == {q: ids for q, ids in want.items() if ids}


def test_two_tables_and_missing_vectors(spark, clustered):
    base = table(spark, clustered[100:]).unionByName(
        spark.createDataFrame([(9999, None)], "id bigint, vec array<float>")
    )
    got = found(knn.knn_join(table(spark, clustered[:100]), base, 3))
    assert got == brute(clustered[:100], clustered[100:], 3)


def test_small_base_gives_fewer_neighbours(spark):
    items = table(spark, [[1, 0], [0, 1]])
    assert found(knn.knn_join(items, items, 5)) == {0: [0, 1], 1: [1, 0]}


def test_probing_few_cells_finds_nearly_all_in_clustered_data(spark, clustered):
    items = table(spark, clustered)
    near = knn.knn_join(items, items, 10, strategy="ivf", tile_rows=50, probes=8)
    got, want = found(near), brute(clustered, clustered, 10)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_pruning_leaves_most_cells_closed(spark, clustered):
    cells = build_index(table(spark, clustered))
    low, high = cells.bounds()
    marks = knn._unsettled_cells(cells.pivots, low, high, 2)
    points = knn._lifted(unit(clustered))
    floor = np.sort(points @ points.T, axis=1)[:, -6]

    class Batch:
        def column(self, _name):
            return floor

    assert marks(points, Batch()).mean() < 0.5


def test_self_neighbours_start_with_the_row(spark, clustered):
    rows = knn.knn_self(table(spark, clustered[:40]), 3).collect()
    assert len(rows) == 120
    assert all(r["nn_id"] == r["id"] and r["dist"] == 0 for r in rows if r["rank"] == 1)


def test_filter_after_over_fetch(spark, clustered):
    items = table(spark, clustered[:80])
    wanted = items.where("id % 4 = 0")
    got = found(knn.knn_filtered(items, items, wanted, 20, 3))
    want = {q: [b for b in ids if b % 4 == 0][:3] for q, ids in brute(clustered[:80], clustered[:80], 20).items()}
    assert got == {q: ids for q, ids in want.items() if ids}


def test_farthest_in_group(spark, clustered):
    vectors = np.array(clustered[:90])
    vectors[10:30] = vectors[10]
    groups = [i % 4 if i < 88 else i for i in range(90)]
    items = table(spark, vectors).join(
        spark.createDataFrame(list(enumerate(groups)), "id bigint, g int"), "id"
    )
    got = {r["id"]: r["far_id"] for r in knn.farthest_in_group(items, "g", tile_rows=5, chunk_rows=7).collect()}
    sim = np.round(unit(vectors) @ unit(vectors).T, 9)
    for i in range(90):
        peers = [j for j in range(90) if groups[j] == groups[i]]
        assert got[i] == min(peers, key=lambda j: (sim[i, j], j))


def test_saved_index_gives_the_same_answer(spark, clustered):
    items, path = table(spark, clustered), scratch_path(spark, "index")
    save_index(build_index(items), spark, path)
    got = found(search_index(load_index(spark, path), items, 4, probes=2))
    assert got == brute(clustered, clustered, 4)


def test_unknown_strategy(spark, clustered):
    items = table(spark, clustered[:5])
    with pytest.raises(ValueError, match="strategy"):
        knn.knn_join(items, items, 1, strategy="guess")


def test_ivf_means_the_same_at_every_size(spark):
    rng = np.random.default_rng(5)
    items = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(100, 8)))], "id bigint, vec array<float>"
    )
    exact = knn.knn_self(items, 6).collect()
    near = knn.knn_self(items, 6, strategy="ivf", probes=2).collect()
    found = {(r["id"], r["nn_id"]) for r in near}
    assert 0.2 < len(found & {(r["id"], r["nn_id"]) for r in exact}) / len(exact) < 1


def test_vectors_that_are_not_numbers_take_no_part(spark):
    items = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [float("nan"), 1.0]), (4, None), (5, [float("inf"), 0.0])],
        "id bigint, vec array<double>",
    )
    hits = {(r["q_id"], r["b_id"]) for r in knn.knn_join(items, items, 3, without_self=True).collect()}
    assert hits == {(1, 2), (2, 1)}


def test_more_copies_than_the_window_limit(spark):
    same = spark.range(5000).select("id", F.array(F.lit(1.0), F.lit(0.5)).alias("b_vec"))
    kept = knn._first_copies(same.withColumnRenamed("id", "b_id"), 1600)
    assert sorted(r["b_id"] for r in kept.collect()) == list(range(1600))


def test_a_literal_k_is_cut_before_the_shuffle(spark):
    items = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(20)], "id bigint, vec array<double>")
    text = knn.knn_join(items, items, 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in text


def test_a_large_master_asks_for_many_neighbours(spark):
    from kinmatch.operators.pairs import hard_negatives

    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(300, 4))
    rows = [(i, [float(x) for x in v], "big" if i < 200 else None) for i, v in enumerate(vectors)]
    offers = spark.createDataFrame(rows, "id bigint, vec array<float>, master_product string")
    got = {tuple(r) for r in hard_negatives(offers).collect()}
    assert {b for _, b in got} <= set(range(200)) and {a for a, _ in got} <= set(range(200, 300))
    assert len(got) == 200 * 100


def test_a_probe_of_a_saved_index_reads_few_folders(spark):
    rng = np.random.default_rng(9)
    items = table(spark, rng.normal(size=(900, 6)))
    path = scratch_path(spark, "grouped")
    save_index(build_index(items), spark, path)
    cells = load_index(spark, path)
    hits = search_index(cells, items.where("id = 3"), 5, strategy="ivf", probes=2)
    text = hits._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell_group" in text and hits.where("rank = 1 AND b_id = 3").count() == 1


def test_repeated_ids_give_their_pairs_once(spark):
    from kinmatch.operators.blocking import block_to_masters

    rows = [(1, "a", [1.0, 0.0], 7), (1, "a", [1.0, 0.0], 7), (2, "b", [0.0, 1.0], 7)]
    df = spark.createDataFrame(rows, "id bigint, name string, vec array<double>, product_category_id int")
    pairs = [(r["id1"], r["id2"]) for r in block_to_masters(df, df, 3, 0.25).collect()]
    assert sorted(pairs) == [(1, 1), (2, 2)]


def test_ivf_probes_as_many_cells_as_recall_needs(spark):
    # without structure, 8 of 55 cells miss more than a tenth of the neighbours
    rng = np.random.default_rng(5)
    items = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(3000, 16)))], "id bigint, vec array<float>"
    )
    exact = {(r["q_id"], r["b_id"]) for r in knn.knn_join(items, items, 5, without_self=True).collect()}

    def recall(**options):
        near = knn.knn_join(items, items, 5, without_self=True, strategy="ivf", **options).collect()
        return len(exact & {(r["q_id"], r["b_id"]) for r in near}) / len(exact)

    assert recall(probes=8) < 0.9 <= recall()


def test_copies_are_searched_as_one_vector(spark, clustered, monkeypatch):
    asked, search = [], knn._search

    def noted(q, b, rows, query_rows, *args, **options):
        asked.append((rows, query_rows))
        return search(q, b, rows, query_rows, *args, **options)

    monkeypatch.setattr(knn, "_search", noted)
    vectors = np.array(clustered[:40])[np.random.default_rng(2).integers(0, 40, 400)]
    items = table(spark, vectors)
    for own in (True, False):
        got = found(knn.knn_join(items, items, 15, without_self=own))
        assert got == brute(vectors, vectors, 15, without_self=own)
    k = [i % 23 for i in range(400)]
    got = found(knn.knn_join(items.withColumn("k", (F.col("id") % 23).cast("int")), items, F.col("k"), without_self=True, tile_rows=10))
    assert got == {q: ids for q, ids in brute(vectors, vectors, k, without_self=True).items() if ids}
    assert asked == [(40, 40)] * 3


def test_routed_batches_are_bounded():
    import pyarrow as pa

    class Queries:
        schema = {"q_vec": type("Field", (), {"dataType": type("Type", (), {"simpleString": lambda self: "array<float>"})()})}

        def mapInArrow(self, route, schema):
            return route

    vectors = np.random.default_rng(1).normal(size=(400, 256)).astype(np.float32)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(400)), pa.array(list(vectors)), pa.array(np.ones(400, np.int32)), pa.array(np.zeros(400))],
        names=["q_id", "q_vec", "k", "floor"],
    )
    route = knn._route(Queries(), 64, lambda points, part: np.ones((len(points), 64), dtype=bool))
    sizes = [out.num_rows for out in route([batch])]
    assert sum(sizes) == 400 * 64 and max(sizes) * 256 <= knn.BLOCK_CELLS


def test_a_base_row_goes_to_few_chunks_however_many_queries_ask(spark):
    # without structure every query looks into nearly every cell
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(900, 16))
    items = table(spark, vectors)
    near = knn.knn_join(items, items, 3, without_self=True, tile_rows=100, chunk_rows=450)
    assert found(near) == brute(vectors, vectors, 3, without_self=True)
    cells = build_index(items)
    low, high, members = cells.sizes()
    q = items.selectExpr("id AS q_id", "vec AS q_vec", "3 AS k")
    dealt, chunks = knn._deal_queries(q, cells, 450)
    wanted = knn._wanted_cells(dealt, cells, knn._Bounds(cells.pivots, low, high, None), high, members)
    assert chunks <= 3 and dealt.count() == 900 and wanted.count() <= chunks * len(cells.pivots)


def test_chunks_of_a_fixed_size_do_not_multiply():
    """Every chunk meets the base once, so their number is not to grow with the queries."""
    chunks = [-(-n // knn._rows_of_chunk(n, 12, 512, 5)) for n in (100_000, 1_000_000, 6_000_000)]
    assert max(chunks) <= 16 * 12
    # as asked for where that makes few chunks; bounded rows and hits at any size
    assert knn._rows_of_chunk(20_000, 8, 512, 5) == 512
    assert knn._rows_of_chunk(2_000, 8, 512, 5) == knn.MIN_CHUNK_ROWS
    assert knn._rows_of_chunk(10**9, 8, 512, 5) == knn.CHUNK_ROWS
    assert knn._rows_of_chunk(10**9, 8, 512, knn.BLOCK_HITS) == 1


def test_small_chunks_that_give_way_find_the_same(spark):
    rng = np.random.default_rng(3)
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3_000, 6)))], "id bigint, vec array<double>")
    sized = lambda n: {(r["q_id"], r["b_id"], r["sim"]) for r in knn.knn_join(
        items, items, 3, without_self=True, tile_rows=400, chunk_rows=n, probes=2).collect()}
    assert sized(4) == sized(3_000)
