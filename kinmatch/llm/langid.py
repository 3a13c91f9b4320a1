"""Language identification with a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_columns

UNDETERMINED = "und"
HIDDEN = 8
# Bytes the network reads at once; its state starts anew after them.
SPAN = 128
# Spans read together in one step.
WIDE = 2048
# Training: labelled rows used at most, spans of each, passes, spans of a step.
MAX_ROWS = 4000
SPANS_PER_ROW = 4
PASSES = 6
BATCH = 256
RATE = 0.01
SEED = 7


def _soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): the network's bounded activation, cheaper than tanh."""
    d = np.abs(x)
    d += 1
    return np.divide(x, d, out=d)


def _soft_slope(y: np.ndarray) -> np.ndarray:
    """Slope of the activation by its value."""
    return np.square(1 - np.abs(y))


@dataclasses.dataclass
class Network:
    """Two gated recurrent layers, one in each direction, and a label at every position.

    With byte ``x`` and state ``h``: gate ``z = (1 + soft(Wz[x] + Uz h)) / 2``, candidate
    ``c = soft(Wc[x] + Uc (z * h))``, new state ``h + z * (c - h)``: one gate both resets
    and updates, as in minimal gated units. A label's logits are linear in both states.
    """

    labels: list[str]
    w: np.ndarray  # direction, gate and candidate rows, byte
    u: np.ndarray  # direction, gate or candidate, hidden, hidden
    out: np.ndarray  # label, both states
    bias: np.ndarray

    @classmethod
    def fresh(cls, labels: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        return cls(
            labels,
            rng.normal(0, 0.5, (2, 2 * hidden, 256)).astype(np.float32),
            rng.normal(0, 0.5 / np.sqrt(hidden), (2, 2, hidden, hidden)).astype(np.float32),
            rng.normal(0, 0.3, (len(labels), 2 * hidden)).astype(np.float32),
            np.zeros(len(labels), np.float32),
        )

    def states(self, spans: np.ndarray, lengths: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """States of both directions, (direction, step, hidden, span), in reading order of each.

        ``spans`` is (step, span); the backward direction reads each span from its own
        end. Steps after the end of a span hold nothing of meaning.
        """
        steps, wide = spans.shape
        hidden = self.u.shape[2]
        back = lengths[None, :] - 1 - np.arange(steps)[:, None]
        reverse = np.take_along_axis(spans, np.maximum(back, 0), axis=0)
        states = np.zeros((2, steps + 1, hidden, wide), np.float32)
        kept = {"gate": [], "candidate": []}
        for d, bytes_ in enumerate((spans, reverse)):
            w, (uz, uc) = self.w[d], self.u[d]
            gates, candidates = [], []
            for t in range(steps):
                h = states[d, t]
                x = w[:, bytes_[t]]
                z = uz @ h
                z += x[:hidden]
                z = _soft(z)
                z += 1
                z *= 0.5
                c = uc @ (z * h)
                c += x[hidden:]
                c = _soft(c)
                new = states[d, t + 1]
                np.subtract(c, h, out=new)
                new *= z
                new += h
                if keep:
                    gates.append(z)
                    candidates.append(c)
            kept["gate"].append(gates)
            kept["candidate"].append(candidates)
        kept["reverse"] = reverse
        return states, kept

    def _logits(self, states: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits (label, step, span) and the states they come from, both directions at one position."""
        steps = states.shape[1] - 1
        # the backward state at a position is that of its step from the end
        back = np.maximum(lengths[None, :] - 1 - np.arange(steps)[:, None], 0)
        behind = np.take_along_axis(states[1, 1:], back[:, None, :], axis=0)
        both = np.concatenate([states[0, 1:], behind], axis=1)
        return np.tensordot(self.out, both, axes=(1, 1)) + self.bias[:, None, None], both

    def probabilities(self, spans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sum over the positions of each span of the label probabilities, (label, span)."""
        states, _ = self.states(spans, lengths)
        p, _ = self._logits(states, lengths)
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        p *= np.arange(spans.shape[0])[:, None] < lengths
        return p.sum(axis=1)

    def gradients(self, spans: np.ndarray, lengths: np.ndarray, targets: np.ndarray) -> tuple[list[np.ndarray], float]:
        """Backpropagation through time of the mean cross-entropy over all positions."""
        steps, wide = spans.shape
        hidden = self.u.shape[2]
        states, kept = self.states(spans, lengths, keep=True)
        p, both = self._logits(states, lengths)
        p = np.exp(p - p.max(axis=0))
        p /= p.sum(axis=0)
        there = (np.arange(steps)[:, None] < lengths) / float(lengths.sum())
        own = p[targets, :, np.arange(wide)].T
        loss = float(-(np.log(own + 1e-9) * there).sum())
        p[targets, :, np.arange(wide)] -= 1
        p *= there.astype(np.float32)
        g_out = np.tensordot(p, both, axes=([1, 2], [0, 2]))
        g_bias = p.sum(axis=(1, 2))
        g_both = np.tensordot(self.out, p, axes=(0, 0)).transpose(1, 0, 2)
        back = np.maximum(lengths[None, :] - 1 - np.arange(steps)[:, None], 0)
        g_back = np.zeros((steps, hidden, wide), np.float32)
        # each position has a step of its own; those past the end have gradient 0
        np.add.at(g_back, (back[:, None, :], np.arange(hidden)[None, :, None], np.arange(wide)[None, None, :]), g_both[:, hidden:])
        g_w, g_u = np.zeros_like(self.w), np.zeros_like(self.u)
        for d, (bytes_, g_states) in enumerate(((spans, g_both[:, :hidden]), (kept["reverse"], g_back))):
            uz, uc = self.u[d]
            g_h = np.zeros((hidden, wide), np.float32)
            for t in range(steps - 1, -1, -1):
                h, z, c = states[d, t], kept["gate"][d][t], kept["candidate"][d][t]
                g_h = g_h + g_states[t]
                g_c = g_h * z * _soft_slope(c)
                g_zh = uc.T @ g_c
                g_z = (g_h * (c - h) + g_zh * h) * 0.5 * _soft_slope(2 * z - 1)
                g_u[d, 1] += g_c @ (z * h).T
                g_u[d, 0] += g_z @ h.T
                rows = np.concatenate([g_z, g_c])
                for k in range(2 * hidden):
                    g_w[d, k] += np.bincount(bytes_[t], rows[k], 256)
                g_h = g_h * (1 - z) + g_zh * z + uz.T @ g_z
        return [g_w, g_u, g_out, g_bias], loss


def _cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of some texts as spans: ``(begin, length, text)`` per span over the joined bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    count = -(-sizes // SPAN)
    text = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = (np.cumsum(sizes) - sizes)[text] + nth * SPAN
    return begin, np.minimum(SPAN, sizes[text] - nth * SPAN), text


def _grid(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Spans as columns of bytes, short ones filled up with what follows."""
    return data[np.minimum(begin[None, :] + np.arange(length.max())[:, None], len(data) - 1)]


def document_probabilities(network: Network, texts: list[bytes]) -> np.ndarray:
    """Mean label probabilities over all positions of each text; equal for an empty text."""
    total = np.zeros((len(texts), len(network.labels)))
    data = np.frombuffer(b"".join(texts) or b" ", np.uint8)
    begin, length, text = _cut(texts)
    order = np.argsort(length, kind="stable")  # spans of one length together: little filling
    for part in range(0, len(order), WIDE):
        of = order[part: part + WIDE]
        p = network.probabilities(_grid(data, begin[of], length[of]), length[of])
        np.add.at(total, text[of], p.T)
    sizes = total.sum(axis=1, keepdims=True)
    return np.where(sizes > 0, total / np.where(sizes > 0, sizes, 1), 1 / len(network.labels))


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, passes: int = PASSES, seed: int = SEED) -> Network:
    """Fit a network to labelled spans by Adam on gradients through time."""
    names = sorted(set(labels))
    target = np.array([names.index(x) for x in labels])
    network = Network.fresh(names, hidden, seed)
    if len(names) < 2 or not any(texts):
        return network
    rng = np.random.default_rng(seed)
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin, length, text = _cut(texts)
    # spans of rarer labels are drawn more often, so that each label counts the same
    share = np.bincount(target[text], minlength=len(names))[target[text]]
    steps = max(60, passes * len(begin) // BATCH)
    weights = [network.w, network.u, network.out, network.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        of = rng.choice(len(begin), BATCH, p=(1 / share) / (1 / share).sum())
        gradients, _ = network.gradients(_grid(data, begin[of], length[of]), length[of], target[text[of]])
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        scale = max(1.0, np.sqrt(sum(float((g * g).sum()) for g in gradients)))
        for w, g, a, b in zip(weights, gradients, first, second):
            g = g / scale
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return network


def rows_per_label(counts: list[int], limit: int) -> int:
    """The largest number of rows that each label may give, as far as it has them, within ``limit``; 1 at least."""
    left, most = limit, 1
    for k, n in enumerate(sorted(counts)):
        most = max(1, left // (len(counts) - k))
        if n > most:
            return most
        left -= n
    return most


def learn_languages(
    docs: DataFrame, text: str = "text", label: str = "lang", where: Column | None = None, max_rows: int = MAX_ROWS,
    hidden: int = HIDDEN,
) -> Network:
    """Train on at most ``max_rows`` labelled texts, as many of each label as it has or the bound allows.

    Copies of a text under one label count once, and those with the first hashes are taken, so
    each label is learned at any size (beyond ``max_rows`` labels, from one text each).
    From each text a few spans, spread evenly over the whole, travel to the driver: that bounds
    what is collected by a little over ``max_rows`` * SPANS_PER_ROW * SPAN characters. ``where``
    restricts the rows. Rows with a NULL label or text are left out. Without any row the network
    knows no label.
    """
    rows = docs.where(docs[label].isNotNull() & docs[text].isNotNull())
    rows = (rows if where is None else rows.where(where)).select(F.col(text).alias("t"), F.col(label).alias("l"))
    rows = rows.withColumn("h", F.xxhash64("t"))
    # copies go before the shuffle: first in each task, then by (label, hash)
    counts = [(r["l"], r["n"]) for r in rows.groupBy("l").agg(F.countDistinct("h").alias("n")).collect()]
    if not counts:
        return Network.fresh([], hidden, SEED)
    most = rows_per_label([n for _, n in counts], max_rows)
    # hashes below a bound of the label's own: somewhat more than needed, cut exactly below
    bounds = [(name, min(1.0, (1.2 * most + 50) / n)) for name, n in counts]
    bounds = docs.sparkSession.createDataFrame(bounds, "l string, share double")
    drawn = rows.join(F.broadcast(bounds), "l").where(F.pmod("h", F.lit(1 << 40)) / float(1 << 40) < F.col("share"))
    at = [F.floor(F.char_length("t") * k / SPANS_PER_ROW).cast("int") for k in range(SPANS_PER_ROW)]
    pieces = F.transform(F.array(*at), lambda k: F.substring(F.col("t"), k + 1, F.lit(SPAN)))
    drawn = drawn.select("l", "h", F.array_distinct(pieces).alias("p")).groupBy("l", "h").agg(F.min("p").alias("p"))
    found = drawn.orderBy("l", F.pmod("h", F.lit(1 << 40)), "h").toArrow()
    texts, labels, taken = [], [], {}
    for parts, name in zip(found.column("p").to_pylist(), found.column("l").to_pylist()):
        taken[name] = taken.get(name, 0) + 1
        for part in parts if taken[name] <= most else []:
            if part:
                texts.append(part.encode("utf-8", "replace")[:SPAN])
                labels.append(name)
    if not texts:
        return Network.fresh([], hidden, SEED)
    return train(texts, labels, hidden)


def with_language(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """All rows with ``lang_pred`` and ``score``, the mean probability of that label over all bytes.

    Every byte of every text is read. A text that is NULL or has no letter is ``und``
    with score 0; so is every text if the network knows no label. Ties go to the first
    label in order. Scores have six digits. Repeated rows get the same answer; columns
    of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def make() -> Callable:
        def work(batch: pa.RecordBatch) -> list:
            known: Network = shared.value
            texts = [t or "" for t in batch.column("__in_0").to_pylist()]
            lettered = [any(map(str.isalpha, t)) for t in texts]
            if not known.labels:
                return [[UNDETERMINED] * len(texts), [0.0] * len(texts)]
            p = document_probabilities(known, [t.encode("utf-8", "replace") if a else b"" for t, a in zip(texts, lettered)])
            best = p.argmax(axis=1)
            names = [known.labels[k] if a else UNDETERMINED for k, a in zip(best.tolist(), lettered)]
            # digits beyond the sixth depend on what else was in the batch
            scores = [min(1.0, round(float(s), 6)) if a else 0.0 for s, a in zip(p.max(axis=1), lettered)]
            return [names, scores]

        return work

    return with_columns(docs, [text], "lang_pred string, score double", make)
