import numpy as np
import pytest

from kinmatch.llm import langid
from kinmatch.llm.langid import Network, document_probabilities, learn_languages, train, with_language

from .helpers import ROWS, clashing, documents, empty


def test_gradients_through_time():
    rng = np.random.default_rng(0)
    network = Network.fresh(["a", "b", "c"], 3, 1)
    for k in ("w", "u", "out", "bias"):
        setattr(network, k, getattr(network, k).astype(np.float64))
    spans, lengths, targets = rng.integers(0, 256, (7, 5)), np.array([7, 3, 5, 1, 6]), np.array([0, 1, 2, 1, 0])
    gradients, _ = network.gradients(spans, lengths, targets)
    for name, g in zip(("w", "u", "out", "bias"), gradients):
        values = getattr(network, name)
        for i in np.argsort(-np.abs(g).ravel())[:5]:
            at = np.unravel_index(i, values.shape)
            kept, loss = values[at], []
            for step in (1e-2, -1e-2):
                values[at] = kept + step
                loss.append(network.gradients(spans, lengths, targets)[1])
            values[at] = kept
            assert (loss[0] - loss[1]) / 2e-2 == pytest.approx(g[at], rel=0.05, abs=2e-4)


def test_spans_do_not_see_what_fills_them_up():
    network = Network.fresh(["a", "b"], 4, 2)
    texts = [b"short", b"a" * 300, b"", b"xy"]
    together = document_probabilities(network, texts)
    for k, t in enumerate(texts):
        assert document_probabilities(network, [t])[0] == pytest.approx(together[k], abs=1e-5)
    assert together[2] == pytest.approx([0.5, 0.5]) and together.sum(axis=1) == pytest.approx(np.ones(4), abs=1e-5)


def test_every_byte_counts():
    network = train([b"aaaa bbbb aabb"] * 40 + [b"xxyy yyxx xyxy"] * 40, ["l"] * 40 + ["r"] * 40, passes=2)
    p = document_probabilities(network, [b"ab " * 500, b"xy " * 500, b"ab " * 500 + b"xy " * 1500])
    assert p[0, 0] > 0.9 and p[1, 1] > 0.9 and 0.5 < p[2, 1] < 0.95


def test_awkward_documents(spark):
    docs = clashing(documents(spark))
    network = learn_languages(docs)
    assert network.labels == ["de", "en"]
    out = with_language(docs, network)
    assert set(out.columns) == set(docs.columns) and out.count() == len(ROWS)
    for r in out.collect():
        assert 0 <= r["score"] <= 1
        lettered = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == (not lettered) and (r["score"] > 0) == lettered
    same = [(r["lang_pred"], r["score"]) for r in out.collect() if r["doc_id"] == 4]
    assert same[0] == same[1]


def test_nothing_to_learn_from(spark):
    network = learn_languages(empty(spark))
    assert network.labels == [] and with_language(empty(spark), network).count() == 0
    assert {r["lang_pred"] for r in with_language(documents(spark), network).collect()} == {"und"}


def test_sample_is_bounded(spark, sf, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "train", lambda texts, labels, hidden: seen.append(texts) or Network.fresh(["a"], 2, 0))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    learn_languages(docs, max_rows=40)
    assert len(seen[0]) <= 70 * langid.SPANS_PER_ROW and max(map(len, seen[0])) <= langid.SPAN


def test_copies_and_rare_labels_in_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "train", lambda texts, labels, hidden: seen.append(labels) or Network.fresh(["a"], 2, 0))
    # copies of one text per label are drawn together; a label of three rows among thousands
    rows = [("hot " + "ab"[i % 2], "en") for i in range(2000)] + [(f"text {i}", "en") for i in range(1000)]
    rows += [(f"Text {i}", "de") for i in range(1000)] + [(f"mot {i}", "fr") for i in range(3)] + [("text 1", "fr")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    learn_languages(docs, max_rows=60)
    # each short text is a piece, and its later parts are others
    per_label = {name: seen[0].count(name) for name in set(seen[0])}
    assert set(per_label) == {"de", "en", "fr"} and per_label["fr"] == 4 * langid.SPANS_PER_ROW
    assert len(seen[0]) == 60 * langid.SPANS_PER_ROW


def test_rows_per_label():
    assert [langid.rows_per_label(c, 60) for c in ([1000, 1002, 4], [10, 20], [60], [61], [5] * 100, [])] == [28, 50, 60, 60, 1, 1]


def test_query_is_right_on_held_out_documents(spark):
    from kinmatch.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    docs = {d["doc_id"]: d for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op1_language"](spark, sf).collect()
    assert len(out) == len(docs)
    held = [r for r in out if r["held_out"] and docs[r["doc_id"]]["lang"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert 0.15 < len(held) / len(out) < 0.35 and right / len(held) > 0.95
