import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmatch.llm import ppm

from .helpers import ROWS, clashing, documents, empty


class Plain:
    """The model counted and scored symbol by symbol."""

    def __init__(self, texts, order=ppm.ORDER):
        self.order, self.contexts = order, [defaultdict(Counter) for _ in range(order + 1)]
        self.words, self.n = Counter(), 0
        for text in texts:
            words = ppm.words_of(text)
            self.words.update(words)
            self.words[None] += 1
            self.n += len(words) + 1
            data = self.laid(words)
            for k in range(order, len(data)):
                for o in range(order + 1):
                    self.contexts[o][data[k - o: k]][data[k]] += 1

    def laid(self, words):
        return bytes([ppm.START]) * self.order + b" ".join(words) + bytes([ppm.END])

    def symbol(self, context, symbol):
        out, barred = 0.0, set()
        for o in range(self.order, -1, -1):
            seen = self.contexts[o].get(context[self.order - o:])
            if seen is None:
                continue
            free = {s: c for s, c in seen.items() if s not in barred}
            if free:
                whole = sum(free.values()) + len(free)
                if symbol in free:
                    return out + math.log10(free[symbol] / whole)
                out += math.log10(len(free) / whole)
            barred |= set(seen)
        return out - math.log10(ppm.SYMBOLS - len(barred))

    def score(self, text):
        data = self.laid(ppm.words_of(text))
        return sum(self.symbol(data[k - self.order: k], data[k]) for k in range(self.order, len(data)))

    def base(self, text):
        v = len(self.words)
        return sum(math.log10((self.words[w] + 1) / (self.n + v + 1)) for w in [*ppm.words_of(text), None])


def check(rows, docs, learns):
    """Rows of ``score_texts`` against the plain model, by id."""
    plain = Plain([t or "" for i, t in docs if learns(i)])
    texts = {i: t or "" for i, t in docs}
    for r in rows:
        text = texts[r["doc_id"]]
        tokens = [*ppm.words_of(text), None]
        assert r["n_tokens"] == len(tokens) and r["train_tokens"] == plain.n
        assert r["n_known"] == sum(plain.words[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(plain.base(text), rel=1e-9)
        assert r["score"] == pytest.approx(plain.score(text), rel=1e-9)


def test_probabilities_of_all_symbols_add_up():
    plain = Plain(["abab abc", "b a", "cab"])
    codes, _ = ppm._grams([ppm.words_of(t) for t in ("abab abc", "b a", "cab")])
    names, counts = ppm._tally(codes)
    trie = ppm.Trie(names, counts, ppm.ORDER)
    for context in (b"\xfe\xfe\xfe\xfe\xfe", b"\xfeabab"[-5:], b"zzzzz", b"xyzca"):
        start = sum(c << (8 * (5 - k)) for k, c in enumerate(context))
        grams = np.array([start + s for s in range(256) if s != ppm.START], np.int64)
        values = trie.log10(grams)
        assert (10**values).sum() == pytest.approx(1)
        assert values == pytest.approx([plain.symbol(context, int(g & 255)) for g in grams])


def test_table_finds_what_it_holds():
    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(0, 1 << 48, 5000))
    table = ppm._Table(codes, np.arange(len(codes)) * 1.5)
    wanted = np.concatenate([codes[::-1], rng.integers(0, 1 << 48, 500)])
    values, there = table.get(wanted)
    assert there.tolist() == np.isin(wanted, codes).tolist()
    assert values[: len(codes)].tolist() == (np.arange(len(codes)) * 1.5)[::-1].tolist()
    assert not ppm._Table(codes[:0], np.zeros(0)).get(wanted)[1].any()


@pytest.mark.parametrize(("words", "grams", "step"), [(1 << 17, 1 << 19, 1 << 19), (5, 40, 60), (0, 0, 1)])
def test_awkward_documents(spark, monkeypatch, words, grams, step):
    monkeypatch.setattr(ppm, "HOT_WORDS", words)
    monkeypatch.setattr(ppm, "HOT_GRAMS", grams)
    monkeypatch.setattr(ppm, "STEP", step)
    rows = [(*r[:1], (r[1] or "")[:600] if r[1] else r[1], *r[2:]) for r in ROWS]
    out = ppm.score_texts(clashing(documents(spark, rows)), F.col("doc_id") % 2 == 0).collect()
    assert len(out) == len(rows)
    # repeated rows are counted each
    check(out, [(r[0], r[1]) for r in rows], lambda i: i is not None and i % 2 == 0)


def test_no_training_rows_and_no_rows(spark):
    out = ppm.score_texts(documents(spark), F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in out)
    assert [r["score"] for r in out if r["doc_id"] == 2] == [pytest.approx(-math.log10(ppm.SYMBOLS))]
    assert ppm.score_texts(empty(spark), F.lit(True)).count() == 0


def test_query_against_the_plain_model(spark, sf):
    from kinmatch.llm.queries import QUERIES

    docs = [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = QUERIES["op7_ppm"](spark, sf).collect()
    assert len(out) == len(docs)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    assert all(r["held_out"] == held(r["doc_id"]) for r in out)
    short = [r for r in out if r["n_tokens"] < 150][:60]
    check(short, docs, lambda i: not held(i))
