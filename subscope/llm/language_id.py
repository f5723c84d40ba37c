"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network reads a window of bytes in both directions, gives every position a distribution over the
languages it has learnt, and a document the mean over its positions. It is trained here, in numpy, by
backpropagation through time on a bounded sample of labelled windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscope.llm.spans import WHITE, Texts, by_bytes, texts_of
from subscope.llm.stage import stored
from subscope.settings import small_batches

UNDETERMINED = "und"
WINDOW = 128  # bytes read with one state; a text is as many windows as it takes
TOGETHER = 1024  # windows stepped through together

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[np.r_[ord("A") : ord("Z") + 1, ord("a") : ord("z") + 1]] = True
_COUNTS = np.ones(256, np.float32)  # positions that a document's mean is over
_COUNTS[list(WHITE)] = 0


@dataclass(frozen=True)
class Training:
    """The sample and how it is learnt from.

    sample: labelled rows drawn at most, about (a row is drawn by its hash), shared evenly by the
    languages; each gives windows of ``window`` bytes from one stretch of ``stretch`` characters.
    languages: as many of the most frequent are learnt.
    """

    sample: int = 4000
    languages: int = 256
    stretch: int = 600
    window: int = 64
    hidden: int = 16
    batch: int = 128
    steps: int = 400
    rate: float = 0.01
    seed: int = 7


@dataclass
class Network:
    """Weights of both directions (0 forward, 1 backward) and of the label of a position."""

    languages: list[str]
    table: list[np.ndarray]  # what a byte adds to the gates: 256 x 3 hidden
    state: list[np.ndarray]  # what the state adds: hidden x 3 hidden
    out: list[np.ndarray]  # hidden x languages
    bias: np.ndarray

    @classmethod
    def random(cls, languages: list[str], hidden: int, rng: np.random.Generator) -> Network:
        def draw(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)

        n = len(languages)
        return cls(
            languages, [draw(256, 3 * hidden) for _ in range(2)], [draw(hidden, 3 * hidden) for _ in range(2)],
            [draw(hidden, n) for _ in range(2)], np.zeros(n, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.table, *self.state, *self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _step(gates: np.ndarray, state: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of a gated unit: how much is kept, how much is seen, the candidate, the new state."""
    k = state.shape[1]
    held = state @ weights
    both = _sigmoid(gates[:, : 2 * k] + held[:, : 2 * k])
    keep, see = both[:, :k], both[:, k:]
    new = np.tanh(gates[:, 2 * k :] + see * held[:, 2 * k :])
    return keep, see, held[:, 2 * k :], new, new + keep * (state - new)


def gradients(net: Network, data: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions of windows ``data`` (steps x windows), and its gradients."""
    steps, n = data.shape
    k = net.state[0].shape[0]
    kept: list[list[tuple]] = [[], []]
    states = np.zeros((2, steps, n, k), np.float32)
    orders = [range(steps), range(steps - 1, -1, -1)]
    for d in (0, 1):
        h = np.zeros((n, k), np.float32)
        for t in orders[d]:
            *inner, new = _step(net.table[d][data[t]], h, net.state[d])
            kept[d].append((t, h, *inner))
            h = states[d, t] = new
    p = _softmax(states[0] @ net.out[0] + states[1] @ net.out[1] + net.bias)
    loss = -float(np.log(p[:, np.arange(n), label] + 1e-9).mean())
    dy = p
    dy[:, np.arange(n), label] -= 1
    dy /= steps * n
    flat = dy.reshape(steps * n, -1)
    one_hot = np.zeros((steps * n, 256), np.float32)
    one_hot[np.arange(steps * n), data.reshape(-1)] = 1
    d_table, d_state, d_out = [], [], []
    for d in (0, 1):
        d_out.append(states[d].reshape(steps * n, k).T @ flat)
        back = dy @ net.out[d].T
        d_gates = np.zeros((steps, n, 3 * k), np.float32)
        d_u = np.zeros_like(net.state[d])
        dh = np.zeros((n, k), np.float32)
        for t, h, keep, see, held, new in reversed(kept[d]):
            dh = dh + back[t]
            d_new = dh * (1 - keep) * (1 - new * new)
            d_keep = dh * (h - new) * keep * (1 - keep)
            d_see = d_new * held * see * (1 - see)
            through = np.concatenate([d_keep, d_see, d_new * see], 1)
            d_gates[t] = np.concatenate([d_keep, d_see, d_new], 1)
            d_u += h.T @ through
            dh = dh * keep + through @ net.state[d].T
        d_state.append(d_u)
        d_table.append(one_hot.T @ d_gates.reshape(steps * n, -1))
    return loss, [*d_table, *d_state, *d_out, flat.sum(0)]


def train(texts: list[bytes], labels: list[str], how: Training = Training()) -> Network:
    """A network that has learnt ``texts``; languages are drawn evenly, whatever their shares."""
    rng = np.random.default_rng(how.seed)
    net = Network.random(sorted(set(labels)), how.hidden, rng)
    windows: list[list[bytes]] = [[] for _ in net.languages]
    for text, label in zip(texts, labels, strict=True):
        at = net.languages.index(label)
        windows[at] += [text[i : i + how.window] for i in range(0, len(text) - how.window + 1, how.window)]
        if 0 < len(text) < how.window:
            windows[at].append(text.ljust(how.window))
    have = [i for i, w in enumerate(windows) if w]
    if not have:
        return net
    data = [np.frombuffer(b"".join(w), np.uint8).reshape(-1, how.window) for w in windows]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, how.steps + 1):
        label = rng.choice(have, how.batch)
        batch = np.stack([data[i][rng.integers(len(data[i]))] for i in label]).T
        _, grads = gradients(net, np.ascontiguousarray(batch), label)
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        rate = how.rate * min(1.0, 2 * (1 - step / (how.steps + 1)))
        for p, g, m, v in zip(net.parameters(), grads, first, second, strict=True):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


class _Reader:
    """Steps of one direction for many windows, a column each, without new memory at every step."""

    def __init__(self, net: Network, direction: int, windows: int):
        k = net.state[direction].shape[0]
        self.k = k
        # a sigmoid is a hyperbolic tangent of half its argument, so gates come out of one call
        half = np.ones((3 * k, 1), np.float32)
        half[: 2 * k] = 0.5
        self.table = np.ascontiguousarray(net.table[direction].T * half)
        self.weights = np.ascontiguousarray(net.state[direction].T * half)
        self.out = np.ascontiguousarray(net.out[direction].T)
        self.held = np.empty((3 * k, windows), np.float32)
        self.gates = np.empty((3 * k, windows), np.float32)
        self.state = np.zeros((k, windows), np.float32)

    def step(self, data: np.ndarray) -> np.ndarray:
        """What the state says of each language once it has read a byte of each window."""
        k, held, gates, h = self.k, self.held, self.gates, self.state
        np.matmul(self.weights, h, out=held)
        np.take(self.table, data, axis=1, out=gates, mode="clip")
        both, new = gates[: 2 * k], gates[2 * k :]
        both += held[: 2 * k]
        np.tanh(both, out=both)
        both *= 0.5
        both += 0.5
        seen = held[2 * k :]
        seen *= both[k:]
        new += seen
        np.tanh(new, out=new)
        h -= new
        h *= both[:k]
        h += new
        return self.out @ h


def pooled(net: Network, texts: Texts) -> np.ndarray:
    """Each text's mean distribution over its positions; zeros for a text without any."""
    length = np.diff(texts.offsets)
    n = -(-length // WINDOW)
    owner = np.repeat(np.arange(len(length)), n)
    start = texts.offsets[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    size = np.minimum(texts.offsets[owner + 1] - start, WINDOW)
    order = np.argsort(-size, kind="stable")
    m = len(net.languages)
    sums, weight = np.zeros((len(length), m)), np.zeros(len(length))
    for at in range(0, len(order), TOGETHER):
        these = order[at : at + TOGETHER]
        steps, least = int(size[these[0]]), int(size[these[-1]])
        place = start[these] + np.arange(steps)[:, None]
        data = texts.data[np.minimum(place, len(texts.data) - 1)].astype(np.intp)
        ahead, back = (_Reader(net, d, len(these)) for d in (0, 1))
        logits = np.empty((steps, m, len(these)), np.float32)
        for t in range(steps):
            logits[t] = ahead.step(data[t])
        logits += net.bias[:, None]
        for t in range(steps - 1, -1, -1):
            logits[t] += back.step(data[t])
            if t >= least:  # windows that have ended have no state yet
                back.state *= t < size[these]
        # logits are bounded by the weights, so their exponentials are finite
        np.exp(logits, out=logits)
        counts = _COUNTS[data]
        counts[np.arange(steps)[:, None] >= size[these]] = 0
        logits *= (counts / logits.sum(1))[:, None, :]
        np.add.at(sums, owner[these], logits.sum(0).T)
        np.add.at(weight, owner[these], counts.sum(0))
    return sums / np.maximum(weight, 1)[:, None]


def _has_letter(column: pa.Array, texts: Texts) -> np.ndarray:
    ascii_letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[texts.data])])
    found = np.diff(ascii_letters[texts.offsets]) > 0
    rest = np.flatnonzero(~found & (np.diff(texts.offsets) > 0))
    for i, text in zip(rest.tolist(), column.take(pa.array(rest)).to_pylist()):
        found[i] = any(c.isalpha() for c in text)
    return found


def learn(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", how: Training = Training()
) -> Network:
    """A network from the rows of ``docs`` that have a text and a language.

    Of the distinct texts of each language those with the lowest hashes are drawn, at most ``how.sample``
    divided by the number of languages, and only their stretches reach the driver. Languages beyond the
    ``how.languages`` most frequent are not learnt.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text is not null and lang is not null and length(text) > 0"
    ).withColumn("hash", F.xxhash64("text"))
    texts = stored(rows.select("lang", "hash").distinct())
    known = stored(texts.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(how.languages))
    each = max(1, how.sample // max(1, known.count()))
    draw = F.pmod("hash", F.lit(1 << 30))
    # twice as many as are wanted and some, to be ranked
    share = F.least(F.lit(1.0), (2 * each + 20) / F.col("count")) * (1 << 30)
    drawn = texts.join(known, "lang").where(draw < share)
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(draw, "hash")))
    chosen = stored(ranked.where(F.col("rank") <= each).select("lang", "hash"))
    spare = F.greatest(F.length("text") - how.stretch, F.lit(0)) + 1
    begin = (1 + F.pmod(F.xxhash64("text", F.lit(1)), spare)).cast("int")
    drawn = rows.join(F.broadcast(chosen), ["lang", "hash"]).select(
        "lang", "hash", F.substring("text", begin, F.lit(how.stretch)).alias("text")
    ).groupBy("lang", "hash").agg(F.min("text").alias("text")).select("lang", "text").collect()
    drawn.sort()
    return train([r["text"].encode() for r in drawn], [r["lang"] for r in drawn], how)


def predict(docs: DataFrame, net: Network, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score``: the likeliest language and its mean probability, over the whole text.

    Null texts and texts without a letter are ``und`` with score 0, and so is all if nothing was learnt.
    Repeated rows and null keys come through one by one, an empty table gives no rows. Only the two
    columns named are read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in by_bytes(batches, limit=4 << 20):
            texts = texts_of(batch.column("text"))
            known = _has_letter(batch.column("text"), texts) & bool(held.languages)
            mean = pooled(held, texts) if held.languages else np.zeros((len(texts), 1))
            best = mean.argmax(1)
            names = np.array([*held.languages, UNDETERMINED], object)[np.where(known, best, -1)]
            score = np.where(known, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(names, pa.string()), pa.array(score)],
                names=["key", "lang_pred", "score"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(label, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)
