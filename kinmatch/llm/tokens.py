"""Tokenizing with a memory: each distinct stretch of the texts is encoded once per worker.

Texts are cut where no pattern of the tokenizer reaches across, all texts of a step at
once; the distinct stretches are looked up in a memory that outlives the task, and
only new ones are encoded.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa

from .common import single_threaded
from .lexicon import Bpe, byte_letters
from .ragged import as_lists, bytes_of, list_sizes, run_sums, step_ranges

# Characters of a word up to which the library merges it.
LONG = 200
# These letters, and the marks after them, are one word each to the tokenizer's pattern.
_PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#$%&|()\"+=/-]*)").fullmatch
# Texts with a byte above this in UTF-8 are not cut: their white space may be of rarer kinds.
_LAST_LEAD = 0xC5


# White space in ASCII, and what counts as such in places.
_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_LETTERS = dict(enumerate(byte_letters()))


def _spelled(text: str) -> str:
    """The bytes of a text as byte-level tokenizers spell them."""
    return text.encode().decode("latin-1").translate(_LETTERS)


class _Remembering:
    """Encodes arrays of texts by their distinct stretches.

    ``number`` gives the place of a known stretch, in the order in which they came;
    ``used`` says in how many steps each has occurred. Once there are more than ``remembered``, those of the most
    steps stay; ``step`` are the bytes of text whose stretches are looked up together.
    """

    remembered, step = 800_000, 1 << 23

    def __init__(self):
        self.number: dict[str, int] = {}
        self.ids, self.ends, self.used = array("I"), array("q", [0]), np.zeros(0, np.int32)

    def _forget(self) -> None:
        keep = self.remembered * 3 // 4
        least = max(2, int(np.partition(self.used, -(keep))[-keep]) + 1) if keep else 1 << 30
        kept = self.used >= least
        known = as_lists(np.diff(np.array(self.ends)), pa.array(np.array(self.ids, np.uint32))).filter(pa.array(kept))
        self.number = {s: k for k, s in enumerate(s for s, stays in zip(self.number, kept.tolist()) if stays)}
        self.ids = array("I", known.flatten().to_numpy().tobytes())
        self.ends = array("q", np.concatenate([[0], np.cumsum(list_sizes(known))]).astype(np.int64).tobytes())
        self.used = np.ones(len(self.number), np.int32)

    def _cut(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``(distinct, codes, counts)``: the stretches of all texts; codes text by text, counts for each."""
        raise NotImplementedError

    def _encode(self, stretch: str) -> list[int]:
        raise NotImplementedError

    def _ids_of(self, stretch: str) -> array:
        at = self._known(stretch)
        return self.ids[self.ends[at] : self.ends[at + 1]]

    def _known(self, stretch: str) -> int:
        at = self.number.get(stretch)
        if at is None:
            new = self._encode(stretch)
            self.ids.extend(new)
            self.ends.append(len(self.ids))
            at = self.number[stretch] = len(self.ends) - 2
        return at

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has. NULL is an empty text."""
        texts = texts.fill_null("")
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a, b in step_ranges(texts, self.step):
            stretches, codes, size = self._cut(texts.slice(a, b - a))
            at = np.fromiter(map(self._known, stretches), np.int64, len(stretches))
            known = as_lists(np.diff(np.array(self.ends)), pa.array(np.array(self.ids, np.uint32))).take(pa.array(at))
            ids.append(known.take(pa.array(codes)).flatten().to_numpy())
            counts.append(run_sums(list_sizes(known)[codes], size))
            self.used[at[at < len(self.used)]] += 1
            self.used = np.concatenate([self.used, np.ones(len(self.number) - len(self.used), np.int32)])
            if len(self.number) > self.remembered:
                self._forget()
        return np.concatenate(ids), np.concatenate(counts)


class SpaceDroppingEncoder(_Remembering):
    """For lower-casing tokenizers that drop white space: what lies between it is independent."""

    def __init__(self, path: str):
        super().__init__()
        self.bpe = Bpe(path)
        self.size, self.model = self.bpe.size, self.bpe.model

    def _cut(self, texts):
        return self.bpe.chunks(texts)

    def _encode(self, stretch):
        if stretch.isalpha():
            return self._word(stretch)
        ids: list[int] = []
        for word in self.bpe.ordered_words(stretch):
            if word.isalpha() and word != stretch:
                ids += self._ids_of(word)
            else:
                ids += [self.bpe.special[word[1:]]] if word[0] == "\r" else self._word(word)
        return ids

    def _word(self, word):
        if len(word) > LONG:
            return self.bpe.merge(word.encode())
        return [t.id for t in self.model.tokenize(word if word.isascii() and word.isalpha() else _spelled(word))]


class SpacePrefixEncoder(_Remembering):
    """For byte-level tokenizers whose words carry the blank before them.

    A text is cut before a single blank, and around a single line end, that stand
    between two characters that are not white space: no pattern of such a tokenizer reaches over
    these places. Longer runs of white space stay with their neighbours. It remembers less, as the
    pipeline's last stage has workers that have grown in the stages before.
    """

    remembered, step = 160_000, 1 << 21

    def __init__(self, path: str):
        super().__init__()
        single_threaded()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.blank = self.tokenizer.model, _spelled(" ")
        self.size = self.tokenizer.get_vocab_size()

    def _cut(self, texts):
        data, off = bytes_of(texts)
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True
        # white space by its last byte and by its first: rarer kinds count where they might be
        plain, second = _WHITE[data], (data == 0x85) | (data == 0xA0)
        second[1:] &= data[:-1] == 0xC2
        second[:1] = False
        ends_white = plain | second
        begins_white = plain
        begins_white[:-1] |= second[1:]
        alone = np.zeros(len(data), bool)
        if len(data) > 2:
            alone[1:-1] = ~ends_white[:-2] & ~begins_white[2:] & ~edge[1:-2] & ~edge[2:-1]
        rare = np.zeros(len(texts) + 1, bool)
        rare[np.searchsorted(off, np.flatnonzero(data > _LAST_LEAD), side="right") - 1] = True
        whole = np.repeat(rare[:-1], np.diff(off))
        begin = alone & (data == 32)
        line = alone & (data == 10)
        begin |= line
        begin[1:] |= line[:-1]
        begin = (begin & ~whole) | edge[:-1]
        at = np.flatnonzero(begin)
        found = pa.StringArray.from_buffers(
            len(at), pa.py_buffer(np.concatenate([at, [len(data)]]).astype(np.int32)), pa.py_buffer(data)
        ).dictionary_encode()
        return found.dictionary.to_pylist(), found.indices.to_numpy(), np.diff(np.searchsorted(at, off))

    def _encode(self, stretch):
        plain = _PLAIN(stretch)
        if not plain:
            return self.tokenizer.encode(stretch, add_special_tokens=False).ids
        word, marks = plain.groups()
        if marks:
            return self._ids_of(word) + self._ids_of(marks)
        spelled = word.replace(" ", self.blank)
        return [t.id for t in self.model.tokenize(spelled if word.isascii() else _spelled(word))]
