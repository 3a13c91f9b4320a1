import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kinmatch.llm.packing import pack, pack_lengths, sequence_sizes
from kinmatch.llm.tokens import SpaceDroppingEncoder, SpacePrefixEncoder

from .helpers import ROWS, clashing, documents, empty

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ENCODERS = {BYTES: SpacePrefixEncoder(BYTES), WORDS: SpaceDroppingEncoder(WORDS)}
LIBRARY = {path: Tokenizer.from_file(path) for path in ENCODERS}
PARTS = ["a", "B", "é", " ", "  ", "\n", "\t", ",", "'s", "1", "<|", "|>", "endoftext", "<|endoftext|>", "Σ", "ΑΣ", "́", "İ",
         " ", "\x1c", "\x85", "…", "word***", "日", "\r\n", "x "]


def ids(encoded):
    return np.frombuffer(encoded, "<u4").tolist()


@pytest.mark.parametrize("path", [BYTES, WORDS])
@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), st.text(max_size=40)))
def test_words_together_are_the_whole_text(path, text):
    text = text.encode("utf-8", "ignore").decode()
    texts = [None, text, "a", text + "b"]
    found, counts = ENCODERS[path](pa.array(texts))
    parts = [x.tolist() for x in np.split(found, np.cumsum(counts)[:-1])]
    assert parts == [LIBRARY[path].encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_a_full_memory_changes_nothing(path, monkeypatch):
    encode = type(ENCODERS[path])(path)
    monkeypatch.setattr(encode, "remembered", 5)
    for k in range(8):
        text = " ".join(f"w{i} ord" for i in range(k, 12))
        assert encode(pa.array([text]))[0].tolist() == LIBRARY[path].encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(0, 200), max_size=60))
@settings(max_examples=200, deadline=None)
def test_every_token_lies_in_one_piece(lengths):
    seen = [np.zeros(n, int) for n in lengths]
    used: dict = {}
    for doc, start, length, sequence, offset in pack_lengths(lengths, 64):
        seen[doc][start: start + length] += 1
        used.setdefault(sequence, []).append((offset, length))
    assert all((s == 1).all() for s in seen)
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 64 and (at == 64 or at & (at - 1) == 0)


@given(st.lists(st.integers(1, 90), max_size=50))
@settings(max_examples=200, deadline=None)
def test_each_goes_to_the_cheapest_with_room(lengths):
    """The rule by a look at all open sequences for every piece."""
    capacity, want, sequence, pieces = 64, [], 0, []
    for i, n in enumerate(lengths):
        want += [(i, 64 * k, 64, sequence + k, 0) for k in range(n // 64)]
        sequence += n // 64
        pieces += [(n % 64, i, n - n % 64)] if n % 64 else []
    sizes = sequence_sizes(sum(p[0] for p in pieces), capacity)
    used, cost = [0] * len(sizes), [0.0] * len(sizes)
    for n, i, start in sorted(pieces, key=lambda p: (-p[0], p[1])):
        while n:
            free = [k for k in range(len(sizes)) if sizes[k] > used[k]]
            k = min([k for k in free if sizes[k] - used[k] >= n] or free, key=lambda k: (cost[k], k))
            part = min(n, sizes[k] - used[k])
            want.append((i, start, part, sequence + k, used[k]))
            used[k], cost[k] = used[k] + part, cost[k] + part + part * part / capacity
            start, n = start + part, n - part
    assert pack_lengths(lengths, capacity) == want


def test_sequence_sizes():
    assert sequence_sizes(0) == [] and sequence_sizes(2048) == [2048] and sequence_sizes(2048 + 7) == [2048, 4, 2, 1]


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 900, 2000).tolist()
    cost: dict = {}
    for _, _, n, s, _ in pack_lengths(lengths):
        cost[s] = cost.get(s, 0) + n + n * n / 2048
    full = [c for c in cost.values() if c > 2048]
    assert np.std(full) / np.mean(full) < 0.06


def expected(rows):
    t = Tokenizer.from_file(BYTES)
    return [(i, [*t.encode(x or "", add_special_tokens=False).ids, 1]) for i, x, *_ in rows]


@pytest.mark.parametrize("block", [1, 5000, 1 << 20])
def test_pieces_of_awkward_documents(spark, block):
    out = pack(clashing(documents(spark)), BYTES, block_tokens=block).collect()
    tokens = sum(len(x) for _, x in expected(ROWS))
    assert sum(r["length"] for r in out) == tokens and all(len(r["ids"]) == 4 * r["length"] for r in out)
    by_doc = {}
    for r in out:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc, want in expected(ROWS):
        pieces = sorted(by_doc[doc], key=lambda r: r["start"])
        if doc == 4:  # two rows with one id
            assert sum(r["length"] for r in pieces) == 2 * len(want)
            continue
        assert [i for r in pieces for i in ids(r["ids"])] == want
        assert {r["doc_tokens"] for r in pieces} == {len(want)}
    where = {}
    for r in out:
        where.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in where.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= 2048


def test_no_documents(spark):
    assert pack(empty(spark), BYTES).count() == 0


def test_query_gives_the_checksums(spark, sf):
    from kinmatch.llm.queries import QUERIES

    rows = {(r["doc_id"], r["start"]): r for r in QUERIES["op6_packing"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20).collect()
    t = Tokenizer.from_file(BYTES)
    for d in docs:
        want = np.array([*t.encode(d["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        while at < len(want):
            r = rows[(d["doc_id"], at)]
            assert zlib.crc32(want[at: at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
