"""Benchmark decontamination by suffix arrays over the training texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_columns, written

WINDOW = 10
# Bytes of benchmark text that travel to the executors at once; more goes in further blocks.
BLOCK_BYTES = 32 << 20
# Blocks searched in one pass; each is a Python worker of its own. Then the rows are stored in between.
BLOCKS_AT_ONCE = 2
# Pairs of a benchmark position and a document position extended in one step.
STEP = 1 << 20
# Characters of a shard; a longer text is a shard of its own.
SHARD = 1 << 22

# Characters of a word: digits, letters and everything beyond ASCII, A-Z being lower-cased first.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
# Odd multiplier of the word hash; equal words have equal hashes, the rest is compared byte by byte.
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts laid end to end: where each begins, its length, hash and text."""

    def __init__(self, texts: list[str]):
        # a blank ends every text, so no word spans two
        data = (" ".join(texts) + " ").encode("utf-8", "replace").translate(_LOWER)
        self.data = np.frombuffer(data, np.uint8)
        sizes = np.array([len(t.encode("utf-8", "replace")) if not t.isascii() else len(t) for t in texts], np.int64)
        inside = _IS_WORD[self.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([[0], edges])
        self.start, self.end = edges[0::2], edges[1::2]
        self.length = self.end - self.start
        text_end = np.cumsum(sizes + 1)
        # the text of a word, and the first word of each text
        self.first = np.searchsorted(self.start, np.concatenate([[0], text_end]))
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """A 64-bit hash per word, by byte position within the word."""
        out = self.length.astype(np.uint64) * _MULTIPLIER
        left = np.arange(len(out))
        at = 0
        while len(left):
            # words longer than ``at``; most words leave soon
            byte = self.data[self.start[left] + at].astype(np.uint64)
            out[left] = (out[left] ^ byte) * _MULTIPLIER
            out[left] ^= out[left] >> np.uint64(29)
            at += 1
            left = left[self.length[left] > at]
        return out

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()


class Benchmark:
    """The words of the items as numbers from 1 on, and the windows to look for."""

    def __init__(self, item_ids: list, texts: list[str], window: int):
        words = Words(texts)
        spelled = [words.text(i) for i in range(len(words.start))]
        self.vocabulary = sorted(set(spelled))
        number = {w: i + 1 for i, w in enumerate(self.vocabulary)}
        tokens = np.array([number[w] for w in spelled], np.int32)
        hash_of = np.zeros(len(self.vocabulary), np.uint64)
        hash_of[tokens - 1] = words.hash
        order = np.argsort(hash_of)
        self.hashes, self.numbers = hash_of[order], (order + 1).astype(np.int32)
        self.item_ids = item_ids
        sizes = np.diff(words.first)
        # a 0 after each item ends its suffixes
        self.tokens = np.zeros(len(tokens) + len(sizes), np.int32)
        item_of_token = np.repeat(np.arange(len(sizes)), sizes)
        self.tokens[np.arange(len(tokens)) + item_of_token] = tokens
        item_start = words.first[:-1] + np.arange(len(sizes))
        width = np.minimum(sizes, window)
        count = np.where(sizes > 0, sizes - width + 1, 0)
        self.item = np.repeat(np.arange(len(sizes)), count)
        nth = np.arange(len(self.item)) - np.repeat(np.cumsum(count) - count, count)
        self.at = item_start[self.item] + nth
        self.width = width[self.item]
        self.shortest = int(self.width.min()) if len(self.width) else 0
        self.longest = int(sizes.max()) if len(sizes) else 0

    def numbered(self, words: Words) -> np.ndarray:
        """The number of each word, 0 for words that no item has."""
        out = np.zeros(len(words.hash), np.int32)
        if not len(self.hashes):
            return out
        place = np.minimum(np.searchsorted(self.hashes, words.hash), len(self.hashes) - 1)
        same = self.hashes[place] == words.hash
        out[same] = self.numbers[place[same]]
        return out

    def spelled_alike(self, words: Words, index: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Whether the words at ``index`` really are those of these numbers."""
        if not hasattr(self, "_joined"):
            self._joined = np.frombuffer(b"".join(self.vocabulary), np.uint8)
            ends = np.cumsum([len(w) for w in self.vocabulary])
            self._begin = ends - [len(w) for w in self.vocabulary]
            self._size = np.array([len(w) for w in self.vocabulary], np.int64)
        alike = self._size[numbers - 1] == words.length[index]
        left, at = np.flatnonzero(alike), 0
        while len(left):
            mine = words.data[words.start[index[left]] + at]
            equal = mine == self._joined[self._begin[numbers[left] - 1] + at]
            alike[left[~equal]] = False
            at += 1
            left = left[equal]
            left = left[words.length[index[left]] > at]
        return alike


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the non-zero tokens in the order of their suffixes, by the first ``depth`` tokens at least.

    Ranks of the first 1, 2, 4, ... tokens, each from the one before; 0 ends a suffix.
    """
    rank = tokens.astype(np.int64)
    span = 1
    while span < depth and len(rank):
        after = np.zeros_like(rank)
        after[:-span or None] = rank[span:]
        rank = np.where(rank > 0, np.unique(rank * (len(tokens) + rank.max() + 1) + after, return_inverse=True)[1] + 1, 0)
        span *= 2
    order = np.argsort(rank, kind="stable")
    return order[np.searchsorted(rank[order], 1):]


def _narrow(tokens, suffixes, low, high, depth, wanted, upper: bool) -> np.ndarray:
    """Binary search, for all intervals at once, of the bound of ``wanted`` as the token at ``depth``."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        at = np.minimum(suffixes[middle] + depth, len(tokens) - 1)
        found = tokens[at]
        right = found <= wanted[open_] if upper else found < wanted[open_]
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]


def find_windows(bench: Benchmark, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(window, position, length)``: every occurrence of a window, with how far it matches on.

    ``tokens`` are numbered training words with zeros between what must not be
    joined. The suffixes of all windows are searched together, token by token.
    """
    empty = np.zeros(0, np.int64)
    if not len(tokens) or not len(bench.at):
        return empty, empty, empty
    suffixes = suffix_array(tokens, max(int(bench.width.max()), 1))
    if not len(suffixes):
        return empty, empty, empty
    low = np.zeros(len(bench.at), np.int64)
    high = np.full(len(bench.at), len(suffixes), np.int64)
    alive = np.arange(len(bench.at))
    for depth in range(int(bench.width.max())):
        alive = alive[(low[alive] < high[alive]) & (bench.width[alive] > depth)]
        if not len(alive):
            break
        wanted = bench.tokens[bench.at[alive] + depth]
        a = _narrow(tokens, suffixes, low[alive], high[alive], depth, wanted, False)
        b = _narrow(tokens, suffixes, a, high[alive], depth, wanted, True)
        low[alive], high[alive] = a, b
    count = np.maximum(high - low, 0)
    window = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    position = suffixes[low[window] + nth]
    length = bench.width[window].astype(np.int64)
    for part in range(0, len(window), STEP):
        going = np.arange(part, min(part + STEP, len(window)))
        while len(going):
            mine = bench.at[window[going]] + length[going]
            theirs = position[going] + length[going]
            on = (mine < len(bench.tokens)) & (theirs < len(tokens))
            going, mine, theirs = going[on], mine[on], theirs[on]
            same = (bench.tokens[mine] == tokens[theirs]) & (bench.tokens[mine] > 0)
            going = going[same]
            length[going] += 1
    return window, position, length


def _long_runs(numbers: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """Words in runs of at least ``least`` benchmark words within one text; no window lies elsewhere."""
    known = numbers > 0
    breaks = np.zeros(len(numbers) + 1, bool)
    breaks[first] = True
    begin = np.flatnonzero(known & (breaks[:-1] | ~np.concatenate([[False], known[:-1]])))
    end = np.flatnonzero(known & (breaks[1:] | ~np.concatenate([known[1:], [False]]))) + 1
    keep = end - begin >= least
    begin, size = begin[keep], (end - begin)[keep]
    offset = np.cumsum(size) - size
    return np.arange(size.sum()) - np.repeat(offset, size) + np.repeat(begin, size)


def search_texts(bench: Benchmark, texts: list[str]) -> list[tuple[int, list, list, tuple | None]]:
    """Per text: words, hit spans ``(first, end)``, item numbers, and the longest match ``(item, word, length)``."""
    words = Words(texts)
    n_words = np.diff(words.first)
    out = [(int(n), [], [], None) for n in n_words]
    if not bench.shortest or not len(words.start):
        return out
    numbers = bench.numbered(words)
    kept = _long_runs(numbers, words.first, bench.shortest)
    true = bench.spelled_alike(words, kept, numbers[kept])
    if not true.all():
        numbers[kept[~true]] = 0
        kept = kept[true]
    if not len(kept):
        return out
    text_of = np.searchsorted(words.first, kept, side="right") - 1
    # the kept runs end to end, a zero wherever the words do not follow one another
    gap = np.concatenate([[False], (np.diff(kept) != 1) | (np.diff(text_of) != 0)])
    place = np.arange(len(kept)) + np.cumsum(gap)
    tokens = np.zeros(place[-1] + 2, np.int32)
    tokens[place] = numbers[kept]
    word_at = np.zeros(len(tokens), np.int64)
    word_at[place] = kept
    window, position, length = find_windows(bench, tokens)
    if not len(window):
        return out
    word = word_at[position]
    text = np.searchsorted(words.first, word, side="right") - 1
    # hit words: the union of all windows
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, word, 1)
    np.add.at(change, word + bench.width[window], -1)
    hit = np.cumsum(change[:-1]) > 0
    breaks = np.zeros(len(hit) + 1, bool)
    breaks[words.first] = True
    begin = np.flatnonzero(hit & (breaks[:-1] | ~np.concatenate([[False], hit[:-1]])))
    end = np.flatnonzero(hit & (breaks[1:] | ~np.concatenate([hit[1:], [False]]))) + 1
    spans: dict[int, list] = {}
    for t, a, b in zip((np.searchsorted(words.first, begin, side="right") - 1).tolist(), begin.tolist(), end.tolist()):
        spans.setdefault(t, []).append((a - int(words.first[t]), b - int(words.first[t])))
    pairs = np.unique(text * len(bench.item_ids) + bench.item[window])
    items: dict[int, list] = {}
    for t, i in zip((pairs // len(bench.item_ids)).tolist(), (pairs % len(bench.item_ids)).tolist()):
        items.setdefault(t, []).append(i)
    order = np.lexsort((bench.item[window], word, -length, text))
    longest = order[np.concatenate([[True], np.diff(text[order]) != 0])]
    for k in longest.tolist():
        t = int(text[k])
        best = (int(bench.item[window[k]]), int(word[k] - words.first[t]), int(length[k]))
        out[t] = (out[t][0], spans[t], items[t], best)
    return out


def search_in_shards(bench: Benchmark, texts: list[str]) -> list[tuple[int, list, list, tuple | None]]:
    """:func:`search_texts` over texts of any total size, one shard after another."""
    out, held, size = [], [], 0
    for text in texts:
        if held and size + len(text) > SHARD:
            out += search_texts(bench, held)
            held, size = [], 0
        held.append(text)
        size += len(text)
    return out + (search_texts(bench, held) if held else [])


def _joined(a: list, b: list) -> list:
    """The union of two lists of spans."""
    out: list = []
    for span in sorted([*a, *b]):
        if out and span[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], span[1]))
        else:
            out.append(tuple(span))
    return out


SCHEMA = (
    "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>, "
    "longest struct<item: string, word: bigint, length: bigint>"
)


def _blocks(bench: DataFrame, id: str, text: str, limit: int) -> Iterator[tuple[list, list]]:
    """The items with text in blocks of about ``limit`` bytes, each collected on its own."""
    items = bench.select(F.col(id).cast("string").alias("i"), F.col(text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = 1 + int(total) // limit
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else items
        found = sorted((r.i, r.t) for r in rows.collect())
        yield [r[0] for r in found], [r[1] for r in found]


def find_contamination(
    docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """All rows with where benchmark items occur in them.

    Adds ``n_words``; ``spans``, the word ranges covered by occurrences of windows of
    ``window`` consecutive item words (an item of fewer words is one window); ``items``,
    the ids, as strings, of items with an occurring window; and ``longest``, the longest
    verbatim match that starts with a window: item, first word and words (ties: the
    earlier place, the smaller id).

    Rows are taken in shards of SHARD characters: a shard's words are numbered by the benchmark's
    vocabulary, runs too short for a window are left out, and a suffix array over the
    rest is searched for all suffixes of all items at once. Nothing is shuffled. The
    benchmark travels to the executors in blocks of ``block_bytes``, one pass over a
    batch for each.

    A NULL or empty text has no words; items with NULL id or text, or no words, are
    skipped; repeated rows are each searched; without items nothing is hit. Columns
    named like an added one are replaced.
    """
    spark = docs.sparkSession
    added = docs
    for k, (ids, texts) in enumerate(_blocks(bench, item_id, item_text, block_bytes)):
        if k and k % BLOCKS_AT_ONCE == 0:
            added = written(added, "contamination")
        shared = spark.sparkContext.broadcast(Benchmark(ids, texts, window))
        first = added is docs

        def make(shared=shared, first=first):
            def work(batch: pa.RecordBatch) -> list:
                b: Benchmark = shared.value
                found = search_in_shards(b, [t or "" for t in batch.column("__in_0").to_pylist()])
                spans = [s for _, s, _, _ in found]
                items = [sorted({b.item_ids[i] for i in x}) for _, _, x, _ in found]
                longest = [
                    None if x is None else {"item": b.item_ids[x[0]], "word": x[1], "length": x[2]} for *_, x in found
                ]
                if not first:
                    spans0, items0, longest0 = (batch.column(f"__in_{k}").to_pylist() for k in (1, 2, 3))
                    spans = [_joined([(s["start"], s["end"]) for s in a], b) for a, b in zip(spans0, spans)]
                    items = [sorted({*a, *b}) for a, b in zip(items0, items)]
                    longest = [
                        min((y for y in (p, q) if y), key=lambda y: (-y["length"], y["word"], y["item"]), default=None)
                        for p, q in zip(longest0, longest)
                    ]
                as_structs = [[{"start": a, "end": z} for a, z in s] for s in spans]
                return [[n for n, *_ in found], as_structs, items, longest]

            return work

        inputs = [text] if first else [text, "spans", "items", "longest"]
        added = with_columns(added, inputs, SCHEMA, make)
    return added


def decontaminate(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """The rows without any occurrence of a benchmark window, with the columns of ``docs``.

    Items with a NULL id count too, as only their words matter here. Columns of ``docs`` named like those
    of :func:`find_contamination` come back as they were.
    """
    item = options.get("item_id", "item_id")
    bench = bench.withColumn(item, F.coalesce(F.col(item).cast("string"), F.lit("")))
    text = options.pop("text", "text")
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), docs[text].alias("__text"))
    clean = find_contamination(packed, bench, text="__text", **options).where(F.size("spans") == 0)
    return clean.select("__row.*")
