"""Language-model scoring by prediction by partial matching, beside a unigram word model.

A text is its words with A-Z lower-cased, joined by single blanks, and an end symbol.
Each byte is predicted from the ORDER bytes before it by a context trie with escape
method C and symbol exclusion: a context that has seen n symbols, d of them
different, gives a symbol seen c times c / (n + d) and escapes with d / (n + d) to its
suffix, where symbols it has seen itself count no more. Below the empty context all
symbols left are equally likely.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import written

ORDER = 5
# Bytes that no UTF-8 text has: what stands before a text, and its end.
START, END = 0xFE, 0xFF
# Symbols that can be predicted: all bytes but START.
SYMBOLS = 255
# Most frequent words and contexts whose values every task holds; the rest are joined.
HOT_WORDS = 1 << 17
HOT_GRAMS = 1 << 19
# Positions counted or scored in one step; distinct words a task counts before it passes them on.
STEP = 1 << 19
HELD = 1 << 18
# A context that lower orders are found from: all contexts that share it are one task's.
SHARED = 3

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words between the ASCII white space characters, A-Z lower-cased."""
    return text.encode("utf-8", "replace").translate(_LOWER).split()


def _grams(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Per position of the texts its context and symbol as one number, and how many each text has.

    The lowest byte is the symbol, the ORDER bytes above it are the context, nearest first.
    """
    lead = bytes([START]) * ORDER
    laid = [lead + b" ".join(w) + bytes([END]) for w in texts]
    data = np.frombuffer(b"".join(laid), np.uint8)
    sizes = np.array([len(x) for x in laid], np.int64)
    codes = data[ORDER:].astype(np.uint64)
    for k in range(1, ORDER + 1):
        codes |= data[ORDER - k: len(data) - k].astype(np.uint64) << np.uint64(8 * k)
    # positions that fall into the lead of the next text are none
    begins = np.cumsum(sizes) - sizes
    there = np.ones(len(codes), bool)
    for k in range(ORDER):
        at = begins[1:] - ORDER + k
        there[at] = False
    return codes[there].view(np.int64), sizes - ORDER


def _counted(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their weights (rows are counts)."""
    names, inverse = np.unique(codes, return_inverse=True)
    return names, np.column_stack([np.bincount(inverse, w, len(names)).astype(np.int64) for w in weights.T])


def _tally(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how often each occurs; sorting whole numbers is the fast way."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.append(first, len(codes)))


def _key(codes: np.ndarray) -> list[bytes]:
    """Codes as join keys: a mark that no word begins with, then the bytes."""
    raw = codes.astype(">i8").view(np.uint8).reshape(-1, 8)
    marked = np.concatenate([np.full((len(raw), 1), 0xFF, np.uint8), raw[:, 8 - ORDER - 1:]], axis=1).tobytes()
    width = ORDER + 2
    return [marked[i: i + width] for i in range(0, len(marked), width)]


def _codes(keys: np.ndarray | list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, ORDER + 2)[:, 1:]
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - ORDER - 1:] = raw
    return wide.view(">i8").ravel().astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple[list, list[str]]]:
    """Rows in blocks of about ``size`` characters: the other columns' values and the texts."""
    rows, texts, held = [], [], 0
    for batch in batches:
        others = [batch.column(i).to_pylist() for i in range(batch.num_columns) if i != column]
        for k, text in enumerate(batch.column(column).to_pylist()):
            rows.append(tuple(o[k] for o in others))
            texts.append(text or "")
            held += len(texts[-1])
            if held >= size:
                yield rows, texts
                rows, texts, held = [], [], 0
    if texts:
        yield rows, texts


def count_corpus(docs: DataFrame) -> DataFrame:
    """``(key, trained, total)`` for words and for contexts with their symbol, over ``(learn, text)``.

    ``trained`` counts occurrences in rows with ``learn``, ``total`` in all. Words are
    counted in training rows only. Each task adds up what it reads before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        grams, counts = np.zeros(0, np.int64), np.zeros((0, 2), np.int64)

        def out(keys: list[bytes], both: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(both[:, 0]), pa.array(both[:, 1])], names=["key", "trained", "total"]
            )

        for rows, texts in _blocks(batches, 1, STEP):
            split = [words_of(t) for t in texts]
            learn = np.array([r[0] for r in rows], bool)
            for w, is_training in zip(split, learn):
                if is_training:
                    words.update(w)
            codes, sizes = _grams(split)
            of_training = np.repeat(learn, sizes)
            parts = []
            for flag in (True, False):
                names, n = _tally(codes[of_training == flag])
                parts.append((names, np.column_stack([n if flag else np.zeros_like(n), n])))
            names = np.concatenate([grams, parts[0][0], parts[1][0]])
            grams, counts = _counted(names, np.concatenate([counts, parts[0][1], parts[1][1]]))
            if len(words) > HELD:
                n = np.fromiter(words.values(), np.int64, len(words))
                yield out(list(words), np.column_stack([n, n]))
                words.clear()
            if len(grams) > HELD:
                yield out(_key(grams), counts)
                grams, counts = np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
        if words:
            n = np.fromiter(words.values(), np.int64, len(words))
            yield out(list(words), np.column_stack([n, n]))
        if len(grams):
            yield out(_key(grams), counts)

    counted = docs.select("learn", "text").mapInArrow(count, schema="key binary, trained bigint, total bigint")
    return counted.groupBy("key").agg(F.sum("trained").alias("trained"), F.sum("total").alias("total"))


class Trie:
    """Counts of symbols after contexts of the orders up to ``order``, as sorted codes per order.

    ``grams`` and ``counts`` hold the highest order; each lower one sums over the
    farthest byte. ``lowest`` may hold orders counted elsewhere, lowest first.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int, lowest: list | None = None):
        self.lowest = lowest or []
        seen = counts > 0
        codes, n = grams[seen], counts[seen]
        levels = []
        for k in range(order, len(self.lowest) - 1, -1):
            codes, sums = _counted(codes & ((1 << (8 * (k + 1))) - 1), n[:, None])
            n = sums[:, 0]
            levels.append((codes, n))
        self.levels = [*self.lowest, *levels[::-1]]
        # contexts of each order: code, symbols seen, different symbols
        self.contexts = []
        for codes, n in self.levels:
            names, first = np.unique(codes >> 8, return_index=True)
            different = np.diff(np.append(first, len(codes)))
            total = np.add.reduceat(n, first) if len(codes) else np.zeros(0, np.int64)
            self.contexts.append((names, total, different))

    @staticmethod
    def _find(sorted_codes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_codes):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(sorted_codes, wanted), len(sorted_codes) - 1)
        return at, sorted_codes[at] == wanted

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 of each symbol's probability after its context, over all orders with escapes and exclusion."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        order = len(self.levels) - 1
        # of each gram: symbols excluded, and their occurrences at the order at hand
        barred = np.zeros(len(grams), np.int64)
        for k in range(order, -1, -1):
            if not len(left):
                return out
            wanted = grams[left] & ((1 << (8 * (k + 1))) - 1)
            codes, n = self.levels[k]
            names, total, different = self.contexts[k]
            at, known = self._find(names, wanted >> 8)
            # occurrences here of symbols that the longer context has seen
            excluded = self._excluded(k, grams[left], barred[left] > 0) if k < order else np.zeros(len(left), np.int64)
            free = np.where(known, total[at] - excluded if len(names) else 0, 0)
            kinds = np.where(known, different[at] - barred[left] if len(names) else 0, 0)
            place, there = self._find(codes, wanted)
            hit = known & there
            usable = known & (kinds > 0)
            whole = np.where(usable, free + kinds, 1)
            if len(codes):
                out[left[hit]] += np.log10(n[place[hit]] / whole[hit])
            out[left[~hit & usable]] += np.log10(kinds[~hit & usable] / whole[~hit & usable])
            barred[left] = np.where(known, different[at] if len(names) else 0, barred[left])
            left = left[~hit]
        out[left] -= np.log10(np.maximum(SYMBOLS - barred[left], 1))
        return out

    def _excluded(self, k: int, grams: np.ndarray, any_barred: np.ndarray) -> np.ndarray:
        """At order ``k``: occurrences of the symbols that the context of order ``k + 1`` has seen."""
        if not hasattr(self, "_sums"):
            self._sums = {}
        if k not in self._sums:
            longer, _ = self.levels[k + 1]
            codes, n = self.levels[k]
            at, known = self._find(codes, longer & ((1 << (8 * (k + 1))) - 1))
            names, first = np.unique(longer >> 8, return_index=True)
            counts = np.where(known, n[at], 0) if len(codes) else np.zeros(len(longer), np.int64)
            self._sums[k] = names, np.add.reduceat(counts, first) if len(longer) else counts
        names, sums = self._sums[k]
        at, known = self._find(names, (grams & ((1 << (8 * (k + 2))) - 1)) >> 8)
        return np.where(known & any_barred, sums[at] if len(names) else 0, 0)


def gram_scores(counts: DataFrame) -> DataFrame:
    """``(key, value, total)``: log10 probability of every context and symbol that occurs in any text.

    Contexts that share their last SHARED bytes meet in one partition, where all
    orders above that are summed; at most 256**3 rows share them. Orders below come
    from the counts of the last SHARED bytes of all contexts, at most 256**SHARED numbers, which every task holds.
    """
    grams = counts.where(F.substring("key", 1, 1) == F.lit(bytes([0xFF])))
    tail = F.substring("key", ORDER + 2 - (SHARED - 1), SHARED)
    low = (
        grams.where("trained > 0").groupBy(tail.alias("tail")).agg(F.sum("trained").alias("n"))
        .toArrow()
    )
    raw = np.frombuffer(b"".join(low.column("tail").to_pylist()), np.uint8).reshape(-1, SHARED).astype(np.int64)
    codes = sum((raw[:, SHARED - 1 - k] << (8 * k) for k in range(SHARED)), np.zeros(len(raw), np.int64))
    n = low.column("n").to_numpy()
    lowest = Trie(codes, n, SHARED - 1).levels if len(codes) else [(np.zeros(0, np.int64),) * 2] * SHARED
    shared = counts.sparkSession.sparkContext.broadcast(lowest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, trained, total = [], [], []
        for batch in batches:
            keys += batch.column(0).to_pylist()
            trained.append(batch.column(1).to_numpy())
            total.append(batch.column(2).to_numpy())
        if not keys:
            return
        codes = _codes(keys)
        values = Trie(codes, np.concatenate(trained), ORDER, shared.value).log10(codes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(values), pa.array(np.concatenate(total))], names=["key", "value", "total"]
        )

    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    context = F.substring("key", ORDER + 2 - SHARED, SHARED)
    return grams.repartition(partitions, context).mapInArrow(score, schema="key binary, value double, total bigint")


def _hot(table: DataFrame, count: str, limit: int) -> tuple[DataFrame, int]:
    """The rows whose count lies above the least bound that at most ``limit`` rows reach, and the bound.

    The bound comes from the numbers of rows by order of magnitude, at most a few hundred.
    """
    size = F.floor(F.log2(F.col(count).cast("double")) * 8).cast("int")
    rows = table.where(F.col(count) > 0).groupBy(size.alias("s")).agg(F.count("*").alias("n"), F.min(count).alias("least")).collect()
    taken, bound = 0, 1 << 62
    for row in sorted(rows, key=lambda r: -r["s"]):
        taken += row["n"]
        if taken > limit:
            break
        bound = row["least"]
    return table.where(F.col(count) >= bound), bound


class _Table:
    """Values by number, found by hashing whole arrays at once."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * max(len(codes), 1) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.codes = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits)
        left, slot = np.arange(len(codes)), self._slot(codes)
        while len(left):
            free = self.codes[slot] == -1
            # of several codes with one free slot the last one written has it
            self.codes[slot[free]] = codes[left[free]]
            mine = self.codes[slot] == codes[left]
            self.values[slot[mine]] = values[left[mine]]
            left, slot = left[~mine], (slot[~mine] + 1) & self.mask

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which codes are there at all."""
        slot = self._slot(codes)
        found = self.codes[slot]
        there = found == codes
        out = self.values[slot]
        left = np.flatnonzero(~there & (found != -1))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            found = self.codes[slot]
            same = found == codes[left]
            out[left[same]] = self.values[slot[same]]
            there[left[same]] = True
            on = ~same & (found != -1)
            left, slot = left[on], slot[on]
        return np.where(there, out, 0.0), there


def score_texts(docs: DataFrame, learn: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's id with its scores under models learned from the rows where ``learn`` is true.

    ``n_tokens`` (words and one end), ``n_known`` (tokens seen in training),
    ``train_tokens`` (all training tokens), ``base_score`` (log10 of the add-one unigram
    model) and ``score`` (log10 of the PPM model's probability of the tokens).

    Counts of words and contexts are gathered over the whole corpus. The most frequent
    ones, HOT_WORDS and HOT_GRAMS at most, travel to every task, which adds up what it
    can; each rarer word or context of a text is a row that is joined to its count. So
    no join has a frequent key. Row values are added per row, not per id.

    A NULL or empty text is the end alone. A NULL ``learn`` counts as false; NULL ids
    stay NULL; repeated rows are scored each. Without training rows every symbol and token is unknown.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id].dataType.simpleString()
    id_arrow = to_arrow_type(docs.schema[id].dataType)
    source = docs.select(docs[id].alias("__id"), F.coalesce(learn, F.lit(False)).alias("learn"), docs[text].alias("text"))
    counts = written(count_corpus(source), "ppm-counts")
    is_gram = F.substring("key", 1, 1) == F.lit(bytes([0xFF]))
    words = counts.where(~is_gram).select("key", "trained")
    trained_texts = source.where("learn").count()
    stats = words.agg(F.coalesce(F.sum("trained"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # every training text has one end; the end is one more kind of token
    n_train = stats["n"] + trained_texts
    kinds = stats["v"] + (1 if trained_texts else 0)
    grams = written(gram_scores(counts), "ppm-grams")
    hot_words, word_bound = _hot(words, "trained", HOT_WORDS)
    hot_grams, gram_bound = _hot(grams, "total", HOT_GRAMS)
    found = hot_words.toArrow()
    hot = dict(zip(found.column("key").to_pylist(), np.log10(found.column("trained").to_numpy() + 1.0).tolist()))
    found = hot_grams.select("key", "value").toArrow()
    keys = found.column("key").to_pylist()
    shared = spark.sparkContext.broadcast((hot, _codes(keys) if keys else np.zeros(0, np.int64), found.column("value").to_numpy()))
    end_value = float(np.log10(trained_texts + 1.0))
    fixed = float(np.log10(n_train + (kinds + 1.0)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, codes, values = shared.value
        table = _Table(codes, values)
        row = TaskContext.get().partitionId() << 40
        for rows, texts in _blocks(batches, 1, STEP):
            split = [words_of(t) for t in texts]
            codes, sizes = _grams(split)
            value, there = table.get(codes)
            ends = np.cumsum(sizes)
            ppm = np.add.reduceat(value, ends - sizes)
            out_key: list[bytes] = []
            out_row: list[int] = []
            out_times: list[int] = []
            base, n_known = [], []
            for k, own in enumerate(split):
                got = list(map(known.get, own))
                rare = Counter([w for w, g in zip(own, got) if g is None])
                base.append(sum([g for g in got if g is not None]) + end_value)
                n_known.append(len(own) - rare.total() + (1 if trained_texts else 0))
                out_key += rare
                out_row += [row + k] * len(rare)
                out_times += rare.values()
            away = np.flatnonzero(~there)
            if len(away):
                of = np.searchsorted(ends, away, side="right")
                order = np.lexsort((codes[away], of))
                of, missed = of[order], codes[away][order]
                first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (missed[1:] != missed[:-1])]))
                out_key += _key(missed[first])
                out_row += (row + of[first]).tolist()
                out_times += np.diff(np.append(first, len(missed))).tolist()
            n, m = len(texts), len(out_key)
            # a row per text with what is known already, under a key that nothing joins; then the rest
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b" %d" % (row + k) for k in range(n)] + out_key, pa.binary()),
                    pa.array(list(range(row, row + n)) + out_row, pa.int64()),
                    pa.array([0] * n + out_times, pa.int64()),
                    pa.array([r[0] for r in rows] + [None] * m, type=id_arrow),
                    pa.array([len(w) + 1 for w in split] + [None] * m, pa.int64()),
                    pa.array(n_known + [None] * m, pa.int64()),
                    pa.array(base + [None] * m, pa.float64()),
                    pa.array(ppm.tolist() + [None] * m, pa.float64()),
                ],
                names=["key", "row", "times", "id", "n_tokens", "n_known", "base", "ppm"],
            )
            row += n

    parts = source.select("__id", "text").mapInArrow(
        score,
        schema=f"key binary, row bigint, times bigint, id {id_type}, n_tokens bigint, n_known bigint, base double, ppm double",
    )
    # rarer words and contexts: their counts and values
    rarer = words.where(F.col("trained") < word_bound).select(
        "key", F.log10(F.col("trained") + 1.0).alias("value")
    ).unionAll(grams.where(F.col("total") < gram_bound).select("key", "value"))
    joined = parts.join(rarer, "key", "left")
    gram_row = F.substring("key", 1, 1) == F.lit(bytes([0xFF]))
    gained = F.coalesce(F.col("value") * F.col("times"), F.lit(0.0))
    added = joined.groupBy("row").agg(
        F.max("id").alias("id"), F.max("n_tokens").alias("n_tokens"),
        (F.coalesce(F.max("n_known"), F.lit(0)) + F.coalesce(F.sum(F.when(~gram_row & F.col("value").isNotNull(), F.col("times"))), F.lit(0))).alias("n_known"),
        (F.coalesce(F.max("base"), F.lit(0.0)) + F.sum(F.when(gram_row, 0.0).otherwise(gained))).alias("base"),
        (F.max("ppm") + F.sum(F.when(gram_row, gained).otherwise(0.0))).alias("score"),
    )
    return added.select(
        F.col("id").alias(id), "n_tokens", "n_known", F.lit(n_train).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * fixed).alias("base_score"), "score",
    )
