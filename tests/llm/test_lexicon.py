import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kinmatch.llm.common import table
from kinmatch.llm.lexicon import Bpe, Encoder, count_words, frequent_words, with_decoded, with_tokens
from kinmatch.llm.queries import QUERIES, tokenizer_path
from kinmatch.llm.transducer import Transducer, compile_words

from .helpers import LONG, clashing, documents, empty

PATH = tokenizer_path("word_bpe_49k.json")
bpe = Bpe(PATH)
library = Tokenizer.from_file(PATH)
nothing = Transducer(compile_words([]))


def encoded(*texts):
    ids, counts = Encoder(bpe, nothing)(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


words = st.dictionaries(
    st.binary(max_size=6) | st.sampled_from([b"walking", b"talking", b"king", b"walk"]),
    st.lists(st.integers(0, 9), max_size=4).map(tuple), max_size=40,
)


@given(words, st.lists(st.binary(max_size=7), max_size=20))
@settings(max_examples=300, deadline=None)
def test_automaton_is_the_mapping_it_was_built_from(mapping, others):
    built = Transducer(compile_words(sorted(mapping.items())))
    asked = [*mapping, *others]
    known, ends, ids = built.look_up(pa.array(asked, pa.binary()))
    parts = np.split(ids, ends[:-1]) if asked else []
    for word, there, found in zip(asked, known, parts):
        assert bool(there) == (word in mapping)
        assert tuple(found) == (mapping[word] if there else ())


def test_suffixes_are_shared():
    stems = [f"{a}{b}".encode() for a in "bcdfg" for b in "aeiou"]
    data = compile_words(sorted((s + b"keiten", (k,)) for k, s in enumerate(stems)))
    # the ending once, not once a stem
    assert len(Transducer(data).final) < 2 * len(stems) + 8


def test_words_must_ascend():
    with pytest.raises(ValueError):
        compile_words([(b"b", ()), (b"a", ())])


texts = st.text(st.sampled_from("aaeinstßÄéİΣσ'́ \n\t\x1c\x85.!<|>7½日ǅ​") | st.characters(codec="utf-8"), max_size=60)


@given(st.lists(texts, min_size=1, max_size=4))
@settings(max_examples=600, deadline=None)
def test_any_texts_like_the_library(texts):
    for text, ids in zip(texts, encoded(*texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_each_latin_character_like_the_library():
    for c in map(chr, range(0x250)):
        text = f"a{c}b {c}{c}. {c}1"
        assert encoded(text)[0] == library.encode(text, add_special_tokens=False).ids, hex(ord(c))


def test_special_tokens_and_long_words():
    rng = random.Random(3)
    long_word = "".join(rng.choice("aeinrst") for _ in range(5_000))
    texts = ("a<|endoftext|>b <|startoftext|><|ENDOFTEXT|>", long_word, "x" * 3_000, "", "ab" * 400, LONG[:5_000], "it's I'LL")
    for text, ids in zip(texts, encoded(*texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_both_ways_of_merging_agree():
    rng = random.Random(5)
    for n in range(1, 60):
        word = bytes(rng.choice(b"aeinrsthoul") for _ in range(n))
        ids = [*map(bpe.inner.__getitem__, word[:-1]), bpe.last[word[-1]]]
        assert bpe._merge_long(ids[:]) == bpe._merge_short(ids[:])


def test_frequent_words_keep_all_of_a_count(spark):
    rows = [(f"w{i}".encode(), n) for i, n in enumerate([9, 9, 5, 5, 5, 2, 1])] + [(b"x" * 200, 50)]
    counted = spark.createDataFrame(rows, "word binary, n bigint")
    chosen = lambda most: sorted(r["n"] for r in frequent_words(counted, most).collect())
    assert chosen(1) == [] and chosen(4) == [9, 9] and chosen(5) == [5, 5, 5, 9, 9] and chosen(99) == [2, 5, 5, 5, 9, 9]


def test_counts_are_of_all_words(spark):
    docs = spark.createDataFrame([("A b b.",), ("b <|endoftext|>B",), (None,)], "text string").repartition(2)
    assert {bytes(r["word"]): r["n"] for r in count_words(docs, PATH).collect()} == {b"a": 1, b"b": 4, b".": 1}


def test_rows_of_every_kind(spark):
    docs = clashing(documents(spark))
    out = with_decoded(with_tokens(docs, PATH), PATH).collect()
    assert len(out) == docs.count()
    for r in out:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False) and r["score"] == "x"
    assert with_tokens(empty(spark), PATH).count() == 0


def test_query_against_the_library(spark, sf):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    out = QUERIES["op11_lexicon"](spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
