"""Byte-pair encoding through a lexicon of frequent words, and decoding.

The words of the whole corpus are counted by Spark; the frequent ones are compiled
with their ids into a minimal acyclic transducer (:mod:`.transducer`), which goes to every
executor as one file and is mapped into memory there. Words that it does not accept
are merged by the tokenizer's own rules, so every text gets exactly its ids.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import make_folder, put_file, single_threaded, with_columns, written
from .ragged import as_lists, bytes_of, list_sizes, run_sums, step_ranges
from .transducer import Transducer, compile_words

# Words of the lexicon at most, and bytes of one; bounds the driver's work and the file.
MAX_WORDS = 1 << 18
MAX_WORD_BYTES = 128
# Symbols up to which a word is merged by scanning; longer ones use a heap.
SCANNED = 64
# Texts of characters below this only are lower-cased and cut here, all others by the library;
# no byte of theirs in UTF-8 is larger than the last one.
_LATIN, _LAST_LEAD = 0x180, 0xC5
# White space between chunks; rarer kinds stay inside one.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32]] = True
# Marks of chunks that are special tokens or whole words; no chunk holds one of them otherwise.
_SPECIAL, _WORD = "\r", "\n"


def byte_letters() -> list[str]:
    """How byte-level tokenizers spell each byte: printable ones as themselves, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Bpe:
    """A byte-level tokenizer with word ends that lower-cases and drops white space, read from its file.

    Encoding has three parts: :meth:`chunks` and :meth:`words_of` cut texts into special tokens and
    words, a lexicon or :meth:`merge` gives the ids of a word; :meth:`decode` gives the text of ids.
    """

    def __init__(self, path: str):
        single_threaded()
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")]
        if model["type"] != "BPE" or any(odd) or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or (
            [c["type"] for c in cut] != ["Split", "ByteLevel"] or cut[0]["behavior"] != "Removed" or not cut[0]["invert"]
        ):
            raise ValueError(f"{path}: not a lower-casing byte-pair tokenizer with word ends")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: its special tokens match in other ways than by their text")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        pattern = cut[0]["pattern"]["Regex"]
        library = Tokenizer.from_file(path)
        self.model = library.model
        self._normalize = library.normalizer.normalize_str
        self._split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self._find = re.compile(self._latin(pattern)).findall
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + end] for x in letters]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a] * self.size + vocab[b]] = (rank, vocab[a + b])
        names = [""] * self.size
        for name, i in [*vocab.items(), *self.special.items()]:
            names[i] = name
        self._tokens = pa.array(names)

    @staticmethod
    def _latin(pattern: str) -> str:
        """The tokenizer's pattern with its classes spelled out for the characters below U+0180."""
        kinds = {c: unicodedata.category(chr(c))[0] for c in range(_LATIN)}
        of = lambda kind: "".join(f"\\u{c:04x}" for c, k in kinds.items() if k == kind)
        # white space as Unicode has it, which is less than Python's
        space = "\\u0009-\\u000d\\u0020\\u0085\\u00a0"
        return pattern.replace(r"\p{L}", of("L")).replace(r"\p{N}", of("N")).replace(r"\s", space)

    def _rare_chunks(self, text: str) -> list[str]:
        """A text with special tokens or rare characters: its words, each after a mark that says what it is."""
        out = []
        for k, part in enumerate(self.special_cut.split(text) if self.special_cut else [text]):
            if k % 2:
                out.append(_SPECIAL + part)
            else:
                out += [_WORD + word for word, _ in self._split(self._normalize(part))]
        return out

    def chunks(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``(distinct, codes, counts)``: the lower-cased stretches between white space of all texts.

        ``codes`` point into ``distinct``, text by text, ``counts`` of them for each. No
        word reaches beyond a chunk; :meth:`words_of` cuts it further.
        """
        texts = texts.fill_null("")
        n = len(texts)
        rare = pc.or_(pc.match_substring(texts, "İ"), self._has_special(texts)).to_numpy(zero_copy_only=False).copy()
        data, off = bytes_of(texts)
        rare[np.searchsorted(off, np.flatnonzero(data > _LAST_LEAD), side="right") - 1] = True
        data, off = bytes_of(pc.utf8_lower(texts))
        inside = ~_BLANK[data]
        for k in np.flatnonzero(rare):
            inside[off[k] : off[k + 1]] = False
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:-1]
        begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        counts = np.diff(np.searchsorted(begin, off))
        ends = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
        found = pa.StringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(data[inside])).dictionary_encode()
        distinct, codes = found.dictionary.to_pylist(), found.indices.to_numpy()
        if rare.any():
            known = {}
            several = {k: self._rare_chunks(texts[k].as_py()) for k in np.flatnonzero(rare).tolist()}
            usual = np.repeat(np.arange(n), counts)
            own = [known.setdefault(c, len(distinct) + len(known)) for some in several.values() for c in some]
            row = np.concatenate([usual, np.repeat([*several], [len(x) for x in several.values()])])
            order = np.argsort(row, kind="stable")
            codes, counts = np.concatenate([codes, np.asarray(own, np.int64)])[order], np.bincount(row.astype(np.int64), minlength=n)
            distinct += known
        return distinct, codes, counts

    def _has_special(self, texts: pa.Array) -> pa.Array:
        masks = [pc.match_substring(texts, name) for name in self.special]
        return reduce(pc.or_, masks) if masks else pa.array(np.zeros(len(texts), bool))

    def words_of(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``(distinct, codes, counts)``: the words of all chunks; a special token is a word after its mark."""
        numbers: dict[str, int] = {}
        number = numbers.setdefault
        codes, counts = [], np.ones(len(chunks), np.int64)
        for k, chunk in enumerate(chunks):
            if chunk.isalpha() or chunk[0] == _SPECIAL:
                codes.append(number(chunk, len(numbers)))
            elif chunk[0] == _WORD:
                codes.append(number(chunk[1:], len(numbers)))
            else:
                words = self._find(chunk)
                counts[k] = len(words)
                for word in words:
                    codes.append(number(word, len(numbers)))
        return [*numbers], np.asarray(codes, np.int64), counts

    def ordered_words(self, chunk: str) -> list[str]:
        """The words of one chunk, in order and with repeats."""
        if chunk[0] == _SPECIAL:
            return [chunk]
        return [chunk[1:]] if chunk[0] == _WORD else self._find(chunk)

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word: the pair of lowest rank is merged, the leftmost first, until none is left."""
        if not word:
            return ()
        ids = [*map(self.inner.__getitem__, word[:-1]), self.last[word[-1]]]
        return tuple(self._merge_long(ids) if len(ids) > SCANNED else self._merge_short(ids))

    def _merge_short(self, ids: list[int]) -> list[int]:
        size, merges, none = self.size, self.merges, (1 << 30, 0)
        found = [merges.get(a * size + b, none) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is none:
                break
            i = found.index(best)
            ids[i : i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = merges.get(ids[i - 1] * size + ids[i], none)
            if i < len(found):
                found[i] = merges.get(ids[i] * size + ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        size, merges, n = self.size, self.merges, len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(*merges[a * size + b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a * size + b in merges]
        queue = [(rank, i, new) for rank, new, i in queue]
        heapq.heapify(queue)
        while queue:
            rank, i, new = heapq.heappop(queue)
            j = after[i]
            # a pair that one of its symbols has left is out of date
            if ids[i] < 0 or j < 0 or merges.get(ids[i] * size + ids[j]) != (rank, new):
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (pair := merges.get(ids[a] * size + ids[b])):
                    heapq.heappush(queue, (pair[0], a, pair[1]))
        return [x for x in ids if x >= 0]

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The text of each run of ``counts`` ids: its tokens joined by blanks, special tokens too.

        That is what the library does for a tokenizer without a decoder.
        """
        return pc.binary_join(as_lists(counts, self._tokens.take(pa.array(ids))), " ")

    def decode(self, ids: Sequence[int]) -> str:
        return self.decode_all(np.asarray(ids, np.int64), np.array([len(ids)]))[0].as_py()


class Encoder:
    """Ids of many texts at once: each distinct word of them is looked up in the lexicon or merged."""

    def __init__(self, bpe: Bpe, lexicon: Transducer):
        self.bpe, self.lexicon = bpe, lexicon
        self.merged = 0  # words that the lexicon did not hold

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)`` of all texts, one after another."""
        parts = [self._step(texts.slice(a, b - a)) for a, b in step_ranges(texts)]
        ids, counts = zip(*parts) if parts else ([], [])
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *counts])

    def _step(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        chunks, in_text, counts = self.bpe.chunks(texts)
        words, in_chunk, sizes = self.bpe.words_of(chunks)
        # ids of words to ids of chunks to ids of texts
        of_word = self._ids_of(words)
        of_chunk = as_lists(run_sums(list_sizes(of_word)[in_chunk], sizes), of_word.take(pa.array(in_chunk)).flatten())
        return of_chunk.take(pa.array(in_text)).flatten().to_numpy(), run_sums(list_sizes(of_chunk)[in_text], counts)

    def _ids_of(self, words: list[str]) -> pa.ListArray:
        known, ends, ids = self.lexicon.look_up(pa.array(words, pa.string()))
        sizes = np.diff(ends, prepend=0)
        merged, special = [], self.bpe.special
        for k in np.flatnonzero(~known).tolist():
            word = words[k]
            new = (special[word[1:]],) if word[:1] == _SPECIAL else self.bpe.merge(word.encode())
            merged += new
            sizes[k] = len(new)
        self.merged += int((~known).sum())
        out = np.zeros(int(sizes.sum()), np.uint32)
        looked_up = np.repeat(known, sizes)
        out[looked_up], out[~looked_up] = ids, merged
        return as_lists(sizes, pa.array(out))


def count_words(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``(word, n)``: how often each word of the tokenizer occurs in all texts, added up within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(tokenizer)
        for batch in batches:
            texts = batch.column(0)
            for begin, end in step_ranges(texts):
                chunks, in_text, _ = bpe.chunks(texts.slice(begin, end - begin))
                words, in_chunk, sizes = bpe.words_of(chunks)
                n = np.repeat(np.bincount(in_text, minlength=len(chunks)), sizes)
                n = np.bincount(in_chunk, n, len(words)).astype(np.int64)
                usual = pa.array([w[:1] != _SPECIAL for w in words], pa.bool_())
                found = pa.RecordBatch.from_arrays([pa.array(words, pa.string()).cast(pa.binary()), pa.array(n)], names=["word", "n"])
                yield found.filter(usual)

    counted = docs.select(F.col(text).alias("__text")).mapInArrow(run, schema="word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counted: DataFrame, most: int = MAX_WORDS) -> DataFrame:
    """All words at least as frequent as some least count, which is as low as lets at most ``most`` through.

    Counts are told apart in 64 steps a doubling; words that occur once, or are longer than MAX_WORD_BYTES, are left out.
    """
    usable = counted.where((F.col("n") > 1) & (F.octet_length("word") <= MAX_WORD_BYTES))
    stepped = usable.withColumn("step", F.floor(F.log2("n") * 64).cast("int"))
    # at most 64 rows a doubling
    sizes = stepped.groupBy("step").agg(F.count("*").alias("words"))
    above = W.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    least = sizes.withColumn("sum", F.sum("words").over(above)).where(F.col("sum") <= most).agg(F.min("step")).first()[0]
    return stepped.where(F.lit(False) if least is None else F.col("step") >= least).drop("step")


def learn_lexicon(docs: DataFrame, tokenizer: str, text: str = "text", most: int = MAX_WORDS) -> str:
    """Compile the frequent words of all texts; returns the name under which executors find the file.

    The counts are stored once in the shared folder; merging the chosen words is done by tasks, and the driver,
    which gets at most ``most`` words, builds the automaton.
    """
    spark = docs.sparkSession
    chosen = frequent_words(written(count_words(docs, tokenizer, text), "word-counts"), most)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(tokenizer)
        for batch in batches:
            words = batch.column(0)
            ids = [bpe.merge(w) for w in words.to_pylist()]
            yield pa.RecordBatch.from_arrays([words, pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])

    merged = chosen.select("word").mapInArrow(merge, schema="word binary, ids array<int>").toArrow().sort_by("word")
    data = compile_words(zip(merged["word"].to_pylist(), map(tuple, merged["ids"].to_pylist())))
    folder, name = scratch_path(spark, "lexicon"), f"lexicon-{uuid.uuid4().hex}.matf"
    make_folder(folder)
    put_file(folder, name, data)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def with_tokens(
    docs: DataFrame, tokenizer: str, lexicon: str | None = None, text: str = "text", ids: str = "ids",
    decoded: str | None = None,
) -> DataFrame:
    """Add ``ids``, each text's token ids without special ones around it, and ``decoded``, the text that decoding these gives.

    ``tokenizer`` is the path of a lower-casing byte-pair tokenizer with word ends,
    ``lexicon`` a name from :func:`learn_lexicon` (NULL: learn one from these texts). The
    result does not depend on the lexicon, only the time does. No shuffle of rows.

    A NULL text is an empty one and has no ids. Strings of special tokens inside a text are these tokens.
    Repeated rows are encoded each; an empty table stays empty; columns named like an added one are replaced.
    """
    name = lexicon or learn_lexicon(docs, tokenizer, text)

    def make():
        bpe = Bpe(tokenizer)
        encode = Encoder(bpe, Transducer.mapped(SparkFiles.get(name)))

        def work(batch: pa.RecordBatch) -> list:
            found, counts = encode(batch.column("__in_0"))
            lists = as_lists(counts, pa.array(found.astype(np.int32)))
            return [lists, bpe.decode_all(found, counts)] if decoded else [lists]

        return work

    return with_columns(docs, [text], f"{ids} array<int>" + (f", {decoded} string" if decoded else ""), make)


def with_decoded(df: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text that the ids of each row decode to; a NULL list gives NULL."""

    def make():
        bpe = Bpe(tokenizer)
        return lambda batch: [[None if x is None else bpe.decode(x) for x in batch.column("__in_0").to_pylist()]]

    return with_columns(df, [ids], f"{decoded} string", make)
