"""Language of a text, by a bidirectional gated recurrent network over its bytes.

Two GRUs read a window of bytes, one from each end. At every byte the two
states give probabilities of the languages, and a document's probabilities are
the mean over all its bytes. The network is trained in numpy by backpropagation
through time, with the document's language as the label of each of its bytes.

Long texts are read in windows of ``WINDOW`` bytes that start afresh, so memory
does not grow with a text and windows of many texts go through the network
together. The last window of a text overlaps the one before, whose bytes count
once; a text shorter than a window is padded with spaces, which do not count.

Training uses a bounded sample: ``TEXTS_PER_LANG`` labelled texts of each of the
``MAX_LANGUAGES`` languages with the most, those drawn by a hash of their id, and ``WINDOWS_PER_TEXT``
windows of each. The sample is drawn by Spark and fits the driver; prediction
reads every byte of every text.

Defined cases: ``und`` with score 0 for a text that is null or has no letter,
and for every text when no labelled row exists; repeated rows are predicted
alike; rows without doc_id are predicted, and train when they are labelled; a
language with few rows is learned from those; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverbrook.llm.common import NO_ID, TEXTS_AT_ONCE, give_back, keep_by_text

UNKNOWN = "und"
#: Bound of the training sample.
TEXTS_PER_LANG = 400
MAX_LANGUAGES = 1000
WINDOWS_PER_TEXT = 8
#: Bytes of a training window and of a window that is predicted.
TRAIN_WINDOW = 48
WINDOW = 128
#: Units of each direction.
UNITS = 8
STEPS = 160
BATCH = 256
RATE = 0.02
#: Learned languages for which a least score is given.
SCORED_LANGUAGES = 4
#: Windows that go through the network together.
WINDOWS_AT_ONCE = 2048

_PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass
class Direction:
    """One GRU. Units run along the first axis, windows along the second.

    z = s(input_z[byte] + Uz h), r = s(input_r[byte] + Ur h),
    n = tanh(input_n[byte] + Un (r * h)), h' = h + z * (n - h)
    """

    inputs: np.ndarray  # (3 * units, 256): z, r, n
    gates: np.ndarray  # (2 * units, units): z, r
    new: np.ndarray  # (units, units)

    @classmethod
    def random(cls, rng: np.random.Generator, units: int) -> Direction:
        def draw(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        spread = units**-0.5
        return cls(draw(3 * units, 256, scale=0.5), draw(2 * units, units, scale=spread), draw(units, units, scale=spread))

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.gates, self.new]

    def states(self, data: np.ndarray) -> np.ndarray:
        """(bytes, units, windows): the state after each byte of (bytes, windows)."""
        units = len(self.new)
        # s(x) = (tanh(x / 2) + 1) / 2: the halves go into the weights.
        scale = np.concatenate([np.full(2 * units, 0.5), np.ones(units)]).astype(np.float32)[:, None]
        inputs, gates = self.inputs * scale, self.gates * scale[: 2 * units]
        steps, count = data.shape
        out = np.empty((steps, units, count), np.float32)
        h = np.zeros((units, count), np.float32)
        x = np.empty((3 * units, count), np.float32)
        g = np.empty((2 * units, count), np.float32)
        n = np.empty((units, count), np.float32)
        for t in range(steps):
            np.take(inputs, data[t], axis=1, out=x, mode="clip")
            np.matmul(gates, h, out=g)
            g += x[: 2 * units]
            np.tanh(g, out=g)
            g += 1
            g *= 0.5
            z, r = g[:units], g[units:]
            r *= h
            np.matmul(self.new, r, out=n)
            n += x[2 * units :]
            np.tanh(n, out=n)
            n -= h
            n *= z
            h = np.add(h, n, out=out[t])
        return out

    def gradients(self, data: np.ndarray, out: np.ndarray, d_out: np.ndarray) -> list[np.ndarray]:
        """Backpropagation through time: gradients of the weights from those of the states."""
        units, (steps, count) = len(self.new), data.shape
        d_inputs, d_gates, d_new = (np.zeros_like(w) for w in self.weights())
        d_h = np.zeros((units, count), np.float32)
        zero = np.zeros((units, count), np.float32)
        for t in range(steps - 1, -1, -1):
            h = out[t - 1] if t else zero
            x = self.inputs[:, data[t]]
            g = 0.5 * np.tanh(0.5 * (self.gates @ h + x[: 2 * units])) + 0.5
            z, r = g[:units], g[units:]
            n = np.tanh(self.new @ (r * h) + x[2 * units :])
            d_h = d_h + d_out[t]
            d_z = d_h * (n - h) * z * (1 - z)
            d_n = d_h * z * (1 - n * n)
            d_rh = self.new.T @ d_n
            d_r = d_rh * h * r * (1 - r)
            d_zr = np.concatenate([d_z, d_r])
            d_x = np.concatenate([d_zr, d_n])
            d_new += d_n @ (r * h).T
            d_gates += d_zr @ h.T
            for u in range(3 * units):
                d_inputs[u] += np.bincount(data[t], d_x[u], 256)
            d_h = d_h * (1 - z) + d_rh * r + self.gates.T @ d_zr
        return [d_inputs, d_gates, d_new]


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray  # (languages, 2 * units)
    bias: np.ndarray

    @classmethod
    def random(cls, languages: list[str], units: int, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        output = rng.normal(0, 0.3, (len(languages), 2 * units)).astype(np.float32)
        bias = np.zeros((len(languages), 1), np.float32)
        return cls(languages, Direction.random(rng, units), Direction.random(rng, units), output, bias)

    def weights(self) -> list[np.ndarray]:
        return [*self.forward.weights(), *self.backward.weights(), self.output, self.bias]

    def states(self, data: np.ndarray) -> np.ndarray:
        """(bytes, 2 * units, windows): both directions at every byte."""
        ahead, back = self.forward.states(data), self.backward.states(data[::-1])[::-1]
        return np.concatenate([ahead, back], axis=1)

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """(bytes, languages, windows)"""
        scores = np.matmul(self.output, states)
        scores += self.bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss per byte of (bytes, windows) with a label per window, and its gradients."""
        units = len(self.forward.new)
        states = self.states(data)
        p = self.probabilities(states)
        every = np.arange(len(labels))
        loss = float(-np.log(p[:, labels, every] + 1e-9).mean())
        p[:, labels, every] -= 1
        p /= data.size
        d_output = np.einsum("tlw,tuw->lu", p, states, optimize=True)
        d_bias = p.sum(axis=(0, 2))[:, None]
        d_states = np.matmul(self.output.T, p)
        d_ahead = self.forward.gradients(data, states[:, :units], d_states[:, :units])
        d_back = self.backward.gradients(data[::-1], states[::-1, units:], d_states[::-1, units:])
        return loss, [*d_ahead, *d_back, d_output, d_bias]


def train(
    windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS, units: int = UNITS
) -> Network:
    """Train on (windows, bytes) with Adam; every language is drawn equally often."""
    network = Network.random(languages, units)
    rng = np.random.default_rng(1)
    members = [np.flatnonzero(labels == k) for k in range(len(languages))]
    first = [np.zeros_like(w) for w in network.weights()]
    second = [np.zeros_like(w) for w in network.weights()]
    for step in range(1, steps + 1):
        picked = np.array([rng.choice(members[k]) for k in rng.integers(0, len(languages), BATCH)])
        data = np.ascontiguousarray(windows[picked].T).astype(np.intp)
        _, gradients = network.gradients(data, labels[picked])
        size = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for w, g, m, v in zip(network.weights(), gradients, first, second, strict=True):
            g = g * min(1.0, 1.0 / (size + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return network


def _windows(length: int, size: int) -> list[tuple[int, int]]:
    """(start, bytes already counted by the window before) of the windows over a text."""
    if length <= size:
        return [(0, 0)]
    starts = [(at, 0) for at in range(0, length - size + 1, size)]
    rest = length % size
    return [*starts, (length - size, size - rest)] if rest else starts


def pooled(network: Network, texts: list[bytes]) -> np.ndarray:
    """(texts, languages): the mean of the probabilities at all bytes of each text."""
    total = np.zeros((len(texts), len(network.languages)))
    held: list[tuple[int, int, int, np.ndarray]] = []  # text, first and end byte that count, bytes

    def run() -> None:
        data = np.stack([w for *_, w in held], axis=1).astype(np.intp)
        p = network.probabilities(network.states(data))
        place = np.arange(WINDOW)[:, None]
        counts = (place >= np.array([a for _, a, _, _ in held])) & (place < np.array([b for _, _, b, _ in held]))
        sums = np.einsum("tlw,tw->wl", p, counts.astype(np.float32), optimize=True)
        np.add.at(total, np.array([n for n, *_ in held]), sums)
        held.clear()

    for number, text in enumerate(texts):
        raw = np.frombuffer(text, np.uint8)
        for start, counted in _windows(len(raw), WINDOW):
            window = raw[start : start + WINDOW]
            end = len(window)
            if end < WINDOW:
                window = np.concatenate([window, np.full(WINDOW - end, 32, np.uint8)])
            held.append((number, counted, end, window))
            if len(held) == WINDOWS_AT_ONCE:
                run()
    if held:
        run()
    return total / np.maximum(1, [len(t) for t in texts])[:, None]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def classify(network: Network | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text; a few megabytes go through the network at a time."""
    found = [(UNKNOWN, 0.0)] * len(texts)
    if network is None:
        return found
    held: list[int] = []
    raw: list[bytes] = []
    size = 0

    def run() -> None:
        for i, row in zip(held, pooled(network, raw), strict=True):
            best = int(row.argmax())
            found[i] = network.languages[best], min(1.0, float(row[best]))
        held.clear()
        raw.clear()

    for i, text in enumerate(texts):
        if text and has_letter(text):
            held.append(i)
            raw.append(text.encode("utf-8", "surrogatepass"))
            size += len(raw[-1])
            if size > 4_000_000:
                run()
                size = 0
    if held:
        run()
    return found


def _predictor(network: Network | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column("text"), []
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                found += classify(network, texts.slice(at, TEXTS_AT_ONCE).to_pylist())
            langs, scores = [lang for lang, _ in found], [score for _, score in found]
            columns = [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(columns, ["doc_id", "held_out", "lang_pred", "score"])
        give_back()

    return predict


def held_out(doc_id: Column) -> Column:
    """The quarter of the documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, texts_per_lang: int = TEXTS_PER_LANG) -> DataFrame:
    """(lang, text): a bounded number of labelled texts of each language."""
    labelled = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("lang", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")
    # Drawn by a hash first, about twice as many as needed, so that a language of
    # any size sends few rows to the task that ranks them. The counts have a row
    # per language and are limited, so they may be sent to every task.
    counts = labelled.groupBy("lang").agg(F.count("*").alias("rows"))
    counts = counts.orderBy(F.desc("rows"), "lang").limit(MAX_LANGUAGES)
    # Shares are compared, as doubles: a product of hash and count leaves a long at 2^23 rows.
    share = F.pmod(F.xxhash64("doc"), F.lit(2**40)).cast("double") / F.lit(2.0**40)
    drawn = share < F.lit(2.0 * texts_per_lang) / F.col("rows")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc"), "doc", F.xxhash64("text"))
    ranked = labelled.join(F.broadcast(counts), "lang").filter(drawn).withColumn("nth", F.row_number().over(order))
    return ranked.filter(F.col("nth") <= texts_per_lang).select("lang", "text")


def learn(docs: DataFrame) -> Network | None:
    """A network trained on the sample; None when there is nothing to learn from."""
    sample = sorted((r["lang"], r["text"]) for r in training_sample(docs).collect())
    sample = [(lang, text) for lang, text in sample if has_letter(text)]
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    rng = np.random.default_rng(2)
    windows, labels = [], []
    for lang, text in sample:
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if len(raw) < TRAIN_WINDOW:
            raw = np.concatenate([raw, np.full(TRAIN_WINDOW - len(raw), 32, np.uint8)])
        for at in rng.integers(0, len(raw) - TRAIN_WINDOW + 1, WINDOWS_PER_TEXT):
            windows.append(raw[at : at + TRAIN_WINDOW])
            labels.append(languages.index(lang))
    return train(np.stack(windows), np.array(labels), languages)


def predict_languages(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score (the pooled probability) of every row."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(_predictor(network), _PREDICTED)


def language_id(docs: DataFrame) -> DataFrame:
    return predict_languages(docs, learn(docs))


def documents_in_known_languages(docs: DataFrame, network: Network | None, min_score: float) -> DataFrame:
    """The rows, with all their columns, whose language is known with at least ``min_score``.

    ``min_score`` holds for up to ``SCORED_LANGUAGES`` learned languages and falls
    in proportion beyond, as an even choice does. Where no language was learned
    nothing is known against a text: all rows with a letter stay.
    """
    if network is not None:
        min_score *= min(1.0, SCORED_LANGUAGES / len(network.languages))

    def known(texts: list[str | None]) -> list[bool]:
        if network is None:
            return [has_letter(text or "") for text in texts]
        return [lang != UNKNOWN and score >= min_score for lang, score in classify(network, texts)]

    return keep_by_text(docs, lambda: known)
