import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinmatch.llm.queries import ORACLES, QUERIES
from kinmatch.llm.sketches import Items, Postings, Shard, search_ranked
from tests.compare import compare, connect

from .helpers import LONG, clashing, documents, empty

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(CAPITALS) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    """Every document scored for every item."""
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, length = sum(1 for c in counts if c), sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for name, text in items:
        scored = []
        for (doc, _), c in zip(docs, counts):
            m = 10 + 90 * c.total() * n_docs // length if length else 0
            score = 0
            for t in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(name, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


some_text = st.lists(st.sampled_from(["a", "B", "cc", "Éé", "d1", "e", "日", "f-g", "\n", ".", "zz"]), max_size=14).map(" ".join)


@given(st.text(max_size=40) | some_text)
@settings(max_examples=300, deadline=None)
def test_terms(text):
    found = Postings(pa.array([None, text, "x"]))
    names = [t.decode() for t in found.terms.to_pylist()]
    mine = found.text == 1
    assert Counter(dict(zip([names[k] for k in found.term[mine]], found.tf[mine].tolist()))) == Counter(terms(text))
    assert found.n.tolist() == [0, len(terms(text)), 1]


@given(st.lists(some_text, min_size=1, max_size=30), st.lists(some_text, min_size=1, max_size=4), st.sampled_from([1, 2, 8, 1024]))
@settings(max_examples=200, deadline=None)
def test_shard_against_all_scores(docs, asked, width):
    found, items = Postings(pa.array(docs)), Items(asked)
    n_docs, length = int(np.count_nonzero(found.n)), int(found.n.sum())
    if not n_docs:
        return
    df = np.array([sum(t.decode() in terms(d) for d in docs) for t in items.terms.to_pylist()])
    import kinmatch.llm.sketches as module

    items.cells = module._cells(np.array([module.zlib.crc32(t) for t in items.terms.to_pylist()], np.int64), width)
    part = Shard(found, items, n_docs, length, width)
    weights = items.weighted(df, n_docs)
    bounds = part.bounds(weights, 0, len(docs))
    every = np.arange(len(docs))
    for i in range(len(asked)):
        assert (bounds[:, i] >= part.scores(every, weights[:, i])).all()
    item, ids, score = part.search(weights, [*range(len(docs))], 3, np.ones(len(asked)))
    got = {}
    for i, d, s in zip(item, ids, score):
        got.setdefault(i, []).append((i, len(got.get(i, [])) + 1, d, s))
    want = brute([*enumerate(docs)], [*enumerate(asked)], 3)
    assert sorted((r for rows in got.values() for r in rows), key=repr) == want


def test_bounds_spare_exact_scores():
    rng = np.random.default_rng(1)
    docs = [" ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 5_000) for _ in range(2_000)]
    items = Items([docs[7], docs[1_500]])
    found = Postings(pa.array(docs))
    part = Shard(found, items, 2_000, int(found.n.sum()))
    df = np.array([np.count_nonzero(found.term == k) for k in range(len(found.terms))])
    names = {t: k for k, t in enumerate(found.terms.to_pylist())}
    weights = items.weighted(np.array([df[names[t]] for t in items.terms.to_pylist()]), 2_000)
    item, ids, _ = part.search(weights, [*range(2_000)], 1, np.ones(2))
    # the last of an item's rows is its best of all blocks
    assert ids[item.index(0)] == 7 and 1_500 in ids and part.scored < 400


@pytest.mark.parametrize(("block", "width"), [(1 << 22, 1024), (60, 4)])
def test_rows_of_every_kind(spark, block, width):
    docs = clashing(documents(spark))
    asked = [(1, "the cat AND the dog"), (1, "the cat AND the dog"), (2, None), (3, " .. "), (None, "katze hund"), (4, "wörds 日本語"),
             (5, LONG[:3_000]), (6, "unheard"), (7, "in English, a text")]
    items = clashing(spark.createDataFrame(asked, "item_id bigint, text string"))
    out = sorted((tuple(r) for r in search_ranked(docs, items, width=width, block_bytes=block, k=3).collect()), key=repr)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert out == brute(rows, [a for a in asked if a[1] is not None], 3)


def test_empty_sides(spark):
    items = spark.createDataFrame([(1, "cat")], "item_id bigint, text string")
    assert search_ranked(empty(spark), items).count() == 0
    assert search_ranked(documents(spark), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert search_ranked(documents(spark), items.limit(0)).count() == 0


def test_query_against_sql(spark, sf):
    message, rows, _ = compare(spark, connect(sf), sf, QUERIES["op12_ranked"], ORACLES["op12_ranked"])
    assert message is None and rows >= 100
