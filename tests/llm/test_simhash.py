import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinmatch.llm import simhash
from kinmatch.llm.simhash import GrayTree, fingerprint, gray_rank, keep_one, near_duplicates, near_links

from .helpers import ROWS, clashing, documents, empty


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i: i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable over links of at most two bits, by comparing all."""
    ids = list(prints)
    label = {i: i for i in ids}
    links = [(a, b) for a in ids for b in ids if (prints[a] ^ prints[b]).bit_count() <= 2]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return label


@given(st.lists(st.sampled_from(["a", "B", "cd", "É", " ", "\n", "\x0b", " ", "\x1c"]), max_size=700).map(" ".join))
@settings(max_examples=60, deadline=None)
def test_fingerprint_bit_by_bit(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_gray_rank_is_the_place_in_the_sequence(spark):
    # the k-th word of the sequence is k ^ (k >> 1)
    ks = [0, 1, 2, 3, 1000, 2**62, 2**63, 2**64 - 1]
    words = [(k, np.array(k ^ (k >> 1), np.uint64).view(np.int64).item()) for k in ks]
    df = spark.createDataFrame([(str(k), w) for k, w in words], "k string, w bigint")
    got = {int(r["k"]): r["r"] for r in df.select("k", gray_rank(F.col("w")).alias("r")).collect()}
    assert all(got[k] == k - 2**63 for k in ks)
    assert simhash._gray_rank(np.array([k ^ (k >> 1) for k in ks], np.uint64)).tolist() == ks


@given(st.integers(0, 2**32), st.integers(1, 400), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_tree_finds_all_within_the_radius(seed, n, radius):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 5, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (n, 3)).astype(np.uint64))
    prints = np.unique(centres[rng.integers(0, 5, n)] ^ np.bitwise_xor.reduce(flips, axis=1))
    tree, order = simhash._tree(prints)
    got = {(int(q), int(order[leaf])) for qs, leaves in tree.search(prints, radius) for q, leaf in zip(qs, leaves)}
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    assert got == set(zip(*map(lambda x: x.tolist(), np.nonzero(near))))


def test_groups_are_left_before_their_leaves_are_seen():
    rng = np.random.default_rng(1)
    prints = np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    tree, _ = simhash._tree(prints)
    assert isinstance(tree, GrayTree) and len(tree.levels) >= 4
    # nearly all children of the root hold bits that all fingerprints below them share
    assert (np.bitwise_count(tree.levels[-2][0]) > 0).all()


@pytest.mark.parametrize(("shard", "queries"), [(1 << 17, 1 << 16), (50, 40)])
def test_links_join_the_same_components(spark, shard, queries):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    prints = {i: int(centres[i % 12]) ^ sum(1 << int(b) for b in set(rng.integers(0, 12, 3))) for i in range(300)}
    first = {}
    for i, p in prints.items():
        first.setdefault(p, i)
    rows = [(np.array(p, np.uint64).view(np.int64).item(), i) for p, i in first.items()]
    links = near_links(spark.createDataFrame(rows, "fp bigint, rep bigint"), shard=shard, queries=queries).collect()
    label = plain_components({i: p for p, i in first.items()})
    mine = {i: i for i in first.values()}
    for _ in range(300):
        for r in links:
            mine[r["id1"]] = mine[r["id2"]] = min(mine[r["id1"]], mine[r["id2"]])
    assert mine == label


def test_awkward_documents(spark):
    near = "one two three four five six seven eight nine ten eleven twelve"
    rows = [*ROWS, (20, near, None, None, None), (21, near, None, None, None), (22, near.upper(), None, None, None),
            (23, near + " ", None, None, None), (None, None, None, None, None)]
    docs = clashing(documents(spark, rows))
    out = near_duplicates(docs).collect()
    assert len(out) == len(rows)
    prints = {}
    for i, text, *_ in rows:
        if i is not None:
            prints[i] = plain_fingerprint(text)
    label = plain_components(prints)
    for r in out:
        if r["doc_id"] is not None:
            assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == label[r["doc_id"]]
    assert label[1] == label[2] == label[3] == 1 and label[23] == 20
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted(set(label.values())) and kept.where("doc_id IS NULL").count() == 2


def test_no_documents(spark):
    assert near_duplicates(empty(spark)).count() == 0 and keep_one(empty(spark)).count() == 0


def test_query_against_all_pairs(spark, sf):
    from kinmatch.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = {d["doc_id"]: plain_fingerprint(d["text"]) for d in docs if len(d["text"] or "") < 4000}
    out = {r["doc_id"]: r for r in QUERIES["op4_simhash"](spark, sf).collect()}
    assert len(out) == len(docs)
    assert all(out[i]["fingerprint"] == f"{p:016x}" for i, p in prints.items())
    whole = {i: int(r["fingerprint"], 16) for i, r in out.items()}
    assert {i: r["component_id"] for i, r in out.items()} == plain_components(whole)
