"""A minimal acyclic transducer: words to sequences of ids, with shared prefixes and suffixes.

The automaton is built word by word in byte order. States whose word can no longer
grow are looked up among the states so far and shared if they accept the same rest with
the same outputs. An id sequence is put on the arcs as early as its words agree on it, so
that the rests of many words become equal. A file of it holds, little-endian::

    magic "MATF" | arcs u32 | states u32 | outputs u32 | pool u32
    arc key u64[arcs] (state * 256 + byte, ascending) | arc target u32[arcs] | arc output u32[arcs]
    final output u32[states], 0: no word ends here
    start u32[outputs + 1] of each output in the pool | pool u32[pool] of ids

Output number 0 stands for none, 1 for the empty sequence.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

MAGIC = b"MATF"
_HEAD = "<4sIIII"


def _common(a: tuple, b: tuple) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


class _State:
    """A state of the word last added: arcs are byte -> [target, output]."""

    __slots__ = ("arcs", "final")

    def __init__(self):
        self.arcs: dict[int, list] = {}
        self.final: tuple | None = None


class _Builder:
    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.path = [_State()]
        self.last: bytes | None = None

    def _frozen(self, state: _State) -> int:
        """The number of a finished state; equal ones are one."""
        key = (state.final, tuple((byte, target, out) for byte, (target, out) in state.arcs.items()))
        return self.known.setdefault(key, len(self.known))

    def _freeze_beyond(self, depth: int) -> None:
        for i in range(len(self.path) - 1, depth, -1):
            self.path[i - 1].arcs[self.last[i - 1]][0] = self._frozen(self.path.pop())

    def add(self, word: bytes, out: tuple) -> None:
        if self.last is not None and self.last >= word:
            raise ValueError("words must ascend")
        shared = _common(self.last or b"", word)
        self._freeze_beyond(shared)
        for i in range(shared):
            arc = self.path[i].arcs[word[i]]
            keep = _common(arc[1], out)
            rest, arc[1], out = arc[1][keep:], arc[1][:keep], out[keep:]
            if rest:
                below = self.path[i + 1]
                for next_arc in below.arcs.values():
                    next_arc[1] = rest + next_arc[1]
                if below.final is not None:
                    below.final = rest + below.final
        for byte in word[shared:]:
            self.path[-1].arcs[byte] = [None, out]
            self.path.append(_State())
            out = ()
        self.path[-1].final = out
        self.last = word

    def finish(self) -> bytes:
        self._freeze_beyond(0)
        root = self._frozen(self.path[0])
        outputs: dict[tuple, int] = {(): 1}
        key, target, arc_out = [], [], []
        finals = np.zeros(len(self.known), "<u4")
        # the root becomes state 0, changing places with the first one
        number = lambda s: 0 if s == root else root if s == 0 else s
        for (final, arcs), state in self.known.items():
            at = number(state)
            if final is not None:
                finals[at] = outputs.setdefault(final, len(outputs) + 1)
            for byte, to, out in arcs:
                key.append(at << 8 | byte)
                target.append(number(to))
                arc_out.append(outputs.setdefault(out, len(outputs) + 1))
        key = np.asarray(key, "<u8")
        order = np.argsort(key)
        sequences = [(), *outputs]
        start = np.concatenate([[0], np.cumsum([len(s) for s in sequences])]).astype("<u4")
        pool = np.fromiter((i for s in sequences for i in s), "<u4", int(start[-1]))
        head = struct.pack(_HEAD, MAGIC, len(key), len(finals), len(sequences), len(pool))
        parts = [key[order], np.asarray(target, "<u4")[order], np.asarray(arc_out, "<u4")[order], finals, start, pool]
        return head + b"".join(p.tobytes() for p in parts)


def compile_words(words: Iterable[tuple[bytes, tuple]]) -> bytes:
    """The file of an automaton for distinct words in ascending byte order, each with its ids."""
    builder = _Builder()
    for word, ids in words:
        builder.add(word, tuple(ids))
    return builder.finish()


class Transducer:
    """Reader of an automaton, from bytes or from a file that is mapped into memory."""

    def __init__(self, data):
        magic, arcs, states, outputs, pool = struct.unpack_from(_HEAD, data)
        if magic != MAGIC:
            raise ValueError("not an automaton")
        at = struct.calcsize(_HEAD)
        found = []
        for kind, count in (("<u8", arcs), ("<u4", arcs), ("<u4", arcs), ("<u4", states), ("<u4", outputs + 1), ("<u4", pool)):
            found.append(np.frombuffer(data, kind, count, at))
            at += found[-1].nbytes
        self.key, self.target, self.out, self.final, self.start, self.pool = found

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        """All processes of a machine share the pages of one file."""
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(known, ends, ids)``: whether each word is accepted, and the ids of all, word by word, up to ``ends``.

        ``words`` is an array of strings or bytes without NULL. All go through the automaton side by side, one byte at a time.
        """
        n = len(words)
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1] if n else np.zeros(1, np.int32)
        data = np.frombuffer(words.buffers()[2], np.uint8) if n and offsets[-1] else np.zeros(0, np.uint8)
        begin, size = offsets[:-1].astype(np.int64), np.diff(offsets)
        state = np.zeros(n, np.uint64)
        known = np.zeros(n, bool)
        of_word, outputs = [], []
        going, depth = np.arange(n), 0
        while len(going):
            done = size[going] == depth
            ended = going[done]
            final = self.final[state[ended].astype(np.int64)]
            known[ended] = final > 0
            of_word.append(ended)
            outputs.append(final)
            going = going[~done]
            if not len(going) or not len(self.key):
                break
            wanted = state[going] << np.uint64(8) | data[begin[going] + depth]
            arc = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            there = self.key[arc] == wanted
            going, arc = going[there], arc[there]
            state[going] = self.target[arc]
            of_word.append(going)
            outputs.append(self.out[arc])
            depth += 1
        word, output = np.concatenate([[], *of_word]).astype(np.int64), np.concatenate([[], *outputs]).astype(np.int64)
        some = known[word] & (output > 1)
        word, output = word[some], output[some]
        order = np.argsort(word, kind="stable")
        word, output = word[order], output[order]
        first, length = self.start[output].astype(np.int64), np.diff(self.start)[output].astype(np.int64)
        ends = np.cumsum(np.bincount(word, length, n)).astype(np.int64)
        places = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(first, length)
        return known, ends, self.pool[places]
