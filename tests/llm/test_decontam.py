import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinmatch.llm import decontam
from kinmatch.llm.decontam import Benchmark, decontaminate, find_contamination, search_texts, suffix_array
from tests.compare import compare, connect

from .helpers import clashing, documents, empty

ITEM = "the quick brown fox jumps over the lazy dog and then it sleeps"
ITEMS = [(1, ITEM), (2, "only three words"), (3, None), (None, ITEM), (4, "?! --"), (5, ITEM), (6, "mat")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(items, text, window=10):
    w = words(text)
    hit, found = set(), set()
    for item, body in items:
        b = words(body)
        if item is None or body is None or not b:
            continue
        n = min(window, len(b))
        grams = {tuple(b[i: i + n]) for i in range(len(b) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i: i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), hit, sorted(found)


@given(
    st.lists(st.lists(st.sampled_from("ab"), max_size=9).map(" ".join), min_size=1, max_size=5),
    st.lists(st.lists(st.sampled_from("abcA"), max_size=30).map(" ".join), min_size=1, max_size=5),
)
@settings(max_examples=200, deadline=None)
def test_windows_against_all_places(bodies, texts):
    items = list(enumerate(bodies))
    bench = Benchmark([str(i) for i, _ in items], bodies, 3)
    for text, (n, spans, found, longest) in zip(texts, search_texts(bench, texts)):
        want_n, want_hit, want_items = brute(items, text, 3)
        assert n == want_n and {k for a, b in spans for k in range(a, b)} == want_hit
        assert sorted(bench.item_ids[i] for i in found) == want_items
        if longest:
            item, at, size = longest
            body, w = words(bodies[item]), words(text)
            assert any(body[i: i + size] == w[at: at + size] for i in range(len(body)))
            assert all(b[i: i + size + 1] != w[j: j + size + 1] or len(w) < j + size + 1 or len(b) < i + size + 1
                       for b in map(words, bodies) for i in range(len(b)) for j in range(len(w)) if size >= min(3, len(b)))


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
def test_suffix_array_orders_suffixes(values, depth):
    import numpy as np

    tokens = np.array(values, np.int32)
    ends = lambda i: next((j for j in range(i, len(values)) if values[j] == 0), len(values))
    suffix = lambda i: values[i: ends(i)][:depth]
    order = suffix_array(tokens, depth).tolist()
    assert sorted(order) == [i for i, v in enumerate(values) if v]
    assert [suffix(i) for i in order] == sorted(suffix(i) for i in order)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontam.Words, "_hashes", lambda self: self.length.astype("uint64"))
    bench = Benchmark(["1"], ["aaa bb c"], 3)
    assert [len(f[2]) for f in search_texts(bench, ["aaa bb c", "xxx bb c", "aaa yy c"])] == [1, 0, 0]


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_awkward_documents(spark, block):
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    rows = [(i, t, None, None, None) for i, t in enumerate(
        [None, "", "THE quick, brown fox jumps over the lazy dog and then!", f"x {ITEM} y {ITEM}", "a mat", "only three words",
         ITEM.replace("lazy", "lazier"), "only three  Words mat", ITEM])] + [(8, ITEM, None, None, None)]
    docs = clashing(documents(spark, rows))
    out = find_contamination(docs, bench, block_bytes=block).collect()
    assert len(out) == len(rows)
    for r in out:
        n, hit, items = brute(ITEMS, r["text"])
        assert r["n_words"] == n and {k for s in r["spans"] for k in range(s["start"], s["end"])} == hit
        assert r["items"] == items and (r["longest"] is None) == (not items)
    whole = next(r for r in out if r["doc_id"] == 3)["longest"]
    assert (whole["item"], whole["word"], whole["length"]) == ("1", 1, 13)
    clean = decontaminate(docs, bench, block_bytes=block)
    assert clean.columns == docs.columns and {r["spans"] for r in clean.collect()} == {"x"}
    assert sorted(r["doc_id"] for r in clean.collect()) == [0, 1, 6]


def test_items_without_an_id_are_removed_too(spark):
    bench = spark.createDataFrame([(None, "four words of it"), (1, ITEM)], "item_id int, text string")
    docs = documents(spark, [(k, t, None, None, None) for k, t in enumerate(["four words of it here", f"x {ITEM}", "none"])])
    assert [r["doc_id"] for r in decontaminate(docs, bench).collect()] == [2]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    assert find_contamination(documents(spark), none).where("size(spans) > 0").count() == 0
    assert decontaminate(empty(spark), none).count() == 0


def test_query_against_sql(spark, sf):
    from kinmatch.llm.queries import ORACLES, QUERIES

    message, rows, _ = compare(spark, connect(sf), sf, QUERIES["op3_decontamination"], ORACLES["op3_decontamination"])
    assert message is None and rows
