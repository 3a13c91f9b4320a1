import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kinmatch.llm.tokenfiles import TokenFile, encode_file, read_tokens, write_tokens
from kinmatch.session import scratch_path

from .helpers import ROWS, clashing, documents, empty

WORDS = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=900), st.sampled_from([4, 128, 256]))
@settings(max_examples=150, deadline=None)
def test_blocks_come_back(values, block):
    ids = np.array(values, np.uint32)
    file = TokenFile(encode_file([7, 9], [len(ids) // 3, len(ids) - len(ids) // 3], ids, block))
    assert file.read().tolist() == values and file.names.tolist() == [7, 9]
    for first in (0, len(ids) // 2, len(ids)):
        assert file.read(first, min(50, len(ids) - first)).tolist() == values[first: first + 50]


def test_a_few_large_values_do_not_widen_their_block():
    ids = np.arange(25_600, dtype=np.uint32) % 16
    ids[::64] = 49_000
    assert len(encode_file([1], [len(ids)], ids)) < len(ids) * 4 / 8 + 400 * 6 + 3000


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        TokenFile(b"ABCD" + bytes(40))


@pytest.mark.parametrize("file_tokens", [10, 1 << 22])
def test_awkward_documents_come_back_in_order(spark, file_tokens):
    path = scratch_path(spark, "tokens")
    write_tokens(clashing(documents(spark)), path, WORDS, file_tokens=file_tokens)
    out = sorted(read_tokens(spark, path).collect(), key=lambda r: r["start"])
    t = Tokenizer.from_file(WORDS)
    want = [(i, [*t.encode(x or "", add_special_tokens=False).ids, 2]) for i, x, *_ in ROWS]
    want.sort(key=lambda w: (w[0] is not None, w[0]))
    assert [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in out] == want
    at = 0
    for r in out:
        assert r["start"] == at
        at += len(r["ids"]) // 4


def test_files_that_no_manifest_lists_are_not_read(spark):
    path = scratch_path(spark, "tokens")
    write_tokens(documents(spark), path, WORDS)
    folder = path.removeprefix("file:")
    with open(f"{folder}/orphan.pfor", "wb") as f:
        f.write(encode_file([99], [1], np.array([5], np.uint32)))
    assert 99 not in {r["doc_id"] for r in read_tokens(spark, path).collect()}


def test_no_documents(spark):
    path = scratch_path(spark, "tokens")
    write_tokens(empty(spark), path, WORDS)
    assert read_tokens(spark, path).count() == 0


def test_query_against_the_library(spark, sf):
    from kinmatch.llm.queries import QUERIES

    rows = {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, sf).collect()}
    t, start = Tokenizer.from_file(WORDS), 0
    for d in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*t.encode(d["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        r = rows[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
