"""Toxicity by classifier chains of sparse linear models."""

from __future__ import annotations

import dataclasses
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_columns

# Labelled rows a chain is fitted to at most.
MAX_ROWS = 10_000
FOLDS = 3
# Rows of a training sample that must have a feature.
LEAST_ROWS = 5
STEPS = 100
RATE = 1.0
SPARSITY = 1e-4
PREFIXES = (4, 5, 6)
# Words a worker remembers before it starts anew.
REMEMBERED = 150_000
# Features looked up in one step of preparing a sample.
STEP = 1 << 20

_CORE = re.compile(r"^(\W*)(.*?)(\W*)$", re.S).match


def word_features(word: str) -> list[int]:
    """What a word says, as signed 32-bit hashes: itself in lower case, its beginnings, the marks around it, capitals."""
    before, core, after = _CORE(word).groups()
    lowered = core.lower()
    found = [f"w{lowered}"] if core else []
    found += [f"p{lowered[:n]}" for n in PREFIXES if len(lowered) > n]
    found += [f"m{x[:3]}" for x in (before, after) if len(x) > 1]
    if len(core) > 1 and core.isupper():
        found.append("u")
    return [zlib.crc32(f.encode("utf-8", "replace")) - (1 << 31) for f in found]


def text_features(text: str) -> set[int]:
    """Features of all distinct words of a whole text; each counts once."""
    found: set[int] = set()
    for word in set(text.split()):
        found.update(word_features(word))
    return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclasses.dataclass
class Linear:
    """Logistic regression over present features and the probabilities of earlier categories.

    A feature can only speak for its category: weights are not negative, so what is
    innocent in a long text does not outvote what is not.
    """

    weights: dict[int, float]
    bias: float
    earlier: list[float]
    learned: bool = True  # whether any row was there to fit it to

    def probability(self, present: float, earlier: list[float]) -> float:
        x = self.bias + present + sum(w * (p - 0.5) for w, p in zip(self.earlier, earlier))
        return float(_sigmoid(np.float64(x)))


class _Sample:
    """Rows of features, end to end, without features too rare to be learned."""

    def __init__(self, features: np.ndarray, sizes: np.ndarray):
        features = features.astype(np.int32)
        self.rows = len(sizes)
        names, counts = np.unique(features, return_counts=True)
        self.names = names[counts >= LEAST_ROWS]
        ends = np.cumsum(sizes)
        row, number = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for part in range(0, len(features) if len(self.names) else 0, STEP):
            mine = features[part: part + STEP]
            at = np.minimum(np.searchsorted(self.names, mine), len(self.names) - 1)
            there = np.flatnonzero(self.names[at] == mine)
            row.append(np.searchsorted(ends, part + there, side="right").astype(np.int32))
            number.append(at[there].astype(np.int32))
        self.row, self.number = np.concatenate(row), np.concatenate(number)

    def fit(self, target: np.ndarray, earlier: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """Weights of 0 or more by full-batch Adagrad with an L1 penalty, which leaves most of them at 0."""
        inside = of[self.row]
        row, number = self.row[inside], self.number[inside]
        n = max(1, int(of.sum()))
        rate = np.clip(target[of].mean() if of.any() else 0.5, 1e-3, 1 - 1e-3)
        w, e, bias = np.zeros(len(self.names)), np.zeros(earlier.shape[1]), float(np.log(rate / (1 - rate)))
        sw, se, sb = np.full(len(w), 1e-8), np.full(len(e), 1e-8), 1e-8
        for _ in range(STEPS):
            x = bias + np.bincount(row, w[number], self.rows) + (earlier - 0.5) @ e
            wrong = (_sigmoid(x) - target) * of / n
            gw, ge, gb = np.bincount(number, wrong[row], len(w)), (earlier - 0.5).T @ wrong, wrong.sum()
            sw, se, sb = sw + gw * gw, se + ge * ge, sb + gb * gb
            step = RATE / np.sqrt(sw)
            w = np.maximum(w - step * (gw + SPARSITY), 0)
            e = e - RATE / np.sqrt(se) * ge
            bias -= RATE / np.sqrt(sb) * gb
        return w, bias, e

    def predict(self, model: tuple[np.ndarray, float, np.ndarray], earlier: np.ndarray) -> np.ndarray:
        w, bias, e = model
        return _sigmoid(bias + np.bincount(self.row, w[self.number], self.rows) + (earlier - 0.5) @ e)


def fit_chain(features: np.ndarray, sizes: np.ndarray, targets: np.ndarray, folds: int = FOLDS) -> list[Linear]:
    """One model per column of ``targets``, in order; ``features`` are those of all rows, ``sizes`` how many each has.

    Later models see the earlier categories' probabilities. In training these are
    out-of-fold: each row's come from models that have not seen the row, as those of
    a new document will. A NaN target leaves its row out of that category's model only; a
    category without any target is not learned and gives 0.5.
    """
    sample = _Sample(features, sizes)
    n = len(sizes)
    fold = np.arange(n) % folds
    earlier = np.zeros((n, 0))
    chain = []
    for target in targets.T.astype(float):
        given = ~np.isnan(target)
        if not given.any():
            chain.append(Linear({}, 0.0, [0.0] * earlier.shape[1], learned=False))
            earlier = np.column_stack([earlier, np.full(n, 0.5)])
            continue
        target = np.where(given, target, 0.0)
        w, bias, e = sample.fit(target, earlier, given)
        there = np.flatnonzero(w)
        chain.append(Linear(dict(zip(sample.names[there].tolist(), w[there].tolist())), bias, e.tolist()))
        out = np.zeros(n)
        for k in range(folds):
            away = fold == k
            out[away] = sample.predict(sample.fit(target, earlier, given & ~away), earlier)[away]
        earlier = np.column_stack([earlier, out])
    return chain


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, categories: list[Column | str], id: str = "doc_id", text: str = "text",
    max_rows: int = MAX_ROWS,
) -> list[Linear]:
    """Fit a chain for the 0/1 ``categories`` of ``labels`` to at most about ``max_rows`` labelled rows.

    The rows are chosen by a hash of their id; only their features travel to the
    driver. Rows with a NULL id or text, or no category at all, are left out; a row is left out of
    the fit of a category that is NULL. Of rows that share id and labels one is used. A
    category without rows is not ``learned`` and gives 0.5.
    """
    names = [f"c{k}" for k in range(len(categories))]
    columns = [(F.col(c) if isinstance(c, str) else c).cast("int").alias(n) for c, n in zip(categories, names)]
    marked = labels.select(F.col(id).cast("bigint").alias("__id"), *columns)
    marked = marked.na.drop(subset=["__id"]).na.drop("all", subset=names).distinct()
    n = marked.count()
    if n > max_rows:
        marked = marked.where(F.pmod(F.xxhash64("__id"), F.lit(n)) < max_rows)
    # at most about max_rows rows of a few integers
    source = docs.where(docs[text].isNotNull()).select(F.col(id).cast("bigint").alias("__id"), F.col(text).alias("__text"))
    joined = source.join(F.broadcast(marked), "__id")

    def make() -> Callable:
        def work(batch: pa.RecordBatch) -> list:
            return [[sorted(text_features(t)) for t in batch.column("__in_0").to_pylist()]]

        return work

    found = with_columns(joined, ["__text"], "features array<int>", make).select("__id", *names, "features")
    rows = found.dropDuplicates(["__id", *names]).orderBy("__id", *names).toArrow()
    if not rows.num_rows:
        return [Linear({}, 0.0, [0.0] * k, learned=False) for k in range(len(names))]
    # NULL becomes NaN
    targets = np.column_stack([rows.column(n).to_numpy().astype(float) for n in names])
    lists = rows.column("features")
    del rows
    sizes = np.concatenate([c.value_lengths().to_numpy() for c in lists.chunks])
    features = np.concatenate([c.flatten().to_numpy() for c in lists.chunks])
    del lists
    return fit_chain(features, sizes, targets)


class _Scorer:
    """Sums of a chain's weights over the features of whole texts, with a memory of words."""

    def __init__(self, chain: list[Linear]):
        self.chain = chain
        self.known = set().union(*[m.weights for m in chain])
        self.words: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> list[float]:
        words, telling = self.words, set()
        for word in set(text.split()):
            features = words.get(word)
            if features is None:
                features = words[word] = tuple(f for f in word_features(word) if f in self.known)
            if features:
                telling.update(features)
        if len(words) > REMEMBERED:
            words.clear()
        out: list[float] = []
        for model in self.chain:
            # in sorted order, so that equal texts have equal sums
            out.append(model.probability(sum(model.weights.get(f, 0.0) for f in sorted(telling)), out))
        return out


def with_toxicity(docs: DataFrame, chain: list[Linear], names: list[str], text: str = "text") -> DataFrame:
    """All rows with one probability column per category of the chain.

    Whole texts are read; a NULL or empty text has no feature and gets each model's
    value without any. Equal texts get equal values; columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def make() -> Callable:
        score = _Scorer(shared.value)

        def work(batch: pa.RecordBatch) -> list:
            found = [score(t or "") for t in batch.column("__in_0").to_pylist()]
            return [list(x) for x in zip(*found)] if found else [[] for _ in names]

        return work

    return with_columns(docs, [text], ", ".join(f"{n} double" for n in names), make)
