import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.llm import toxicity
from kinmatch.llm.toxicity import Linear, fit_chain, learn_toxicity, text_features, with_toxicity, word_features

from .helpers import ROWS, clashing, documents, empty

BAD = ["scumbag", "moronic"]


def labelled(n=400, seed=0):
    rng = np.random.default_rng(seed)
    common = [f"word{i}" for i in range(60)]
    texts, targets = [], []
    for k in range(n):
        words = list(rng.choice(common, 30))
        toxic, low = k % 4 == 0, k % 3 == 0
        if toxic:
            words[5] = BAD[k % 2]
        if low:
            words = [w + "***" for w in words]
        texts.append(" ".join(words))
        targets.append((int(low), int(toxic)))
    return texts, np.array(targets)


def chain_of(texts, targets):
    features = [sorted(text_features(t)) for t in texts]
    return fit_chain(np.array([f for r in features for f in r], np.int64), np.array([len(r) for r in features]), targets)


def test_features_of_a_word():
    assert word_features("scumbag,") == word_features("Scumbag") and len(word_features("SCUMBAG")) == len(word_features("scumbag")) + 1
    assert word_features("***") and word_features("a***") != word_features("a")


def test_chain_learns_both_categories():
    chain = chain_of(*labelled())
    assert [len(m.earlier) for m in chain] == [0, 1] and all(w > 0 for m in chain for w in m.weights.values())
    score = toxicity._Scorer(chain)
    texts, targets = labelled(seed=1)
    p = np.array([score(t) for t in texts])
    assert ((p >= 0.5) == targets).mean(axis=0).min() > 0.98
    # what is innocent does not outvote
    assert score(" ".join(f"word{i % 60}" for i in range(50_000)) + " scumbag")[1] > 0.5


def test_later_models_see_out_of_fold_predictions(monkeypatch):
    seen = []
    fit = toxicity._Sample.fit
    monkeypatch.setattr(toxicity._Sample, "fit", lambda self, t, e, of: seen.append((e.copy(), of.copy())) or fit(self, t, e, of))
    rng = np.random.default_rng(3)
    # labels that are noise: a model that has seen a row would know its label, one that has not cannot
    texts = [f"a{k} b{k} c{k} a{k}x b{k}y" * 1 for k in range(60) for _ in range(1)]
    targets = rng.integers(0, 2, (60, 2))
    chain_of(texts, targets)
    last = seen[1 + toxicity.FOLDS][0]
    assert last.shape == (60, 1) and seen[1][1].sum() == 40
    assert abs(np.corrcoef(last[:, 0], targets[:, 0])[0, 1]) < 0.5 or np.isnan(np.corrcoef(last[:, 0], targets[:, 0])[0, 1])


def test_earlier_probabilities_enter():
    model = Linear({1: 2.0}, -1.0, [4.0])
    assert model.probability(2.0, [1.0]) == pytest.approx(1 / (1 + np.exp(-3))) and model.probability(0, [0.5]) < 0.3


def test_awkward_documents(spark):
    texts, targets = labelled(80)
    rows = [(100 + k, t, None, None, None) for k, t in enumerate(texts)]
    docs = clashing(documents(spark, [*ROWS, *rows]))
    marks = [(100 + k, int(a), int(b)) for k, (a, b) in enumerate(targets)]
    marks += [(100, int(targets[0][0]), int(targets[0][1])), (None, 1, 1), (1, 1, 1), (0, None, 1), (999, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id bigint, low int, toxic int")
    chain = learn_toxicity(docs, labels, ["low", F.col("toxic")])
    out = with_toxicity(docs, chain, ["p_low_quality", "p_toxic"])
    assert set(out.columns) == set(docs.columns) and out.count() == len(ROWS) + 80
    p = {r["doc_id"]: r["p_toxic"] for r in out.collect()}
    assert all(0 <= x <= 1 for x in p.values()) and p[1] == p[2]
    right = sum((p[100 + k] >= 0.5) == bool(t) for k, (_, t) in enumerate(targets))
    assert right >= 76


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id bigint, low int, toxic int")
    chain = learn_toxicity(empty(spark), none, ["low", "toxic"])
    assert {r["p_toxic"] for r in with_toxicity(documents(spark), chain, ["p_low", "p_toxic"]).collect()} == {0.5}
    assert with_toxicity(empty(spark), chain, ["p_low", "p_toxic"]).count() == 0


def test_a_category_is_learned_without_the_others(spark):
    texts, targets = labelled(200)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    marks = [(k, None, int(t[1])) for k, t in enumerate(targets)]
    chain = learn_toxicity(docs, spark.createDataFrame(marks, "doc_id bigint, low int, toxic int"), ["low", "toxic"])
    assert [m.learned for m in chain] == [False, True]
    out = with_toxicity(docs, chain, ["p_low", "p_toxic"]).collect()
    assert {r["p_low"] for r in out} == {0.5}
    assert np.mean([(r["p_toxic"] >= 0.5) == bool(targets[r["doc_id"]][1]) for r in out]) > 0.98


def test_a_row_counts_for_the_categories_it_has():
    texts, targets = labelled()
    holes = targets.astype(float)
    holes[::3, 0] = np.nan
    holes[1::5, 1] = np.nan
    chain = chain_of(texts, holes)
    score = toxicity._Scorer(chain)
    p = np.array([score(t) for t in labelled(seed=1)[0]])
    assert chain[0].learned and ((p[:, 1] >= 0.5) == targets[:, 1]).mean() > 0.98


def test_bound_on_the_labelled_rows(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(toxicity, "fit_chain", lambda f, s, t: sizes.append(len(s)) or [])
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(500)], "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    learn_toxicity(docs, labels, ["toxic"], max_rows=100)
    assert 60 < sizes[0] < 150


def test_query_finds_labelled_toxic_documents(spark):
    from kinmatch.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    out = {r["doc_id"]: r for r in QUERIES["op10_toxicity"](spark, sf).collect()}
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    marks = spark.read.parquet(f"{sf}/labels.parquet").collect()
    right = sum(out[m["doc_id"]]["toxic"] == bool(m["toxic"]) for m in marks if m["doc_id"] in out)
    assert right / len(marks) > 0.95
