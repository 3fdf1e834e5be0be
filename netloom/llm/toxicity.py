"""Toxicity of texts: a bidirectional gated recurrent network with attention pooling, written and trained in numpy.

A word enters as an embedding of itself (hashed) beside the mean embedding of its byte trigrams (hashed), so unseen inflections
are read by their characters. The network reads windows of ``WINDOW`` words that overlap by half; a text's score is that of
its most toxic window. Whole texts are scored, in tasks; the weights have a fixed size and are broadcast.

The network is fitted in one task on a bounded sample of labelled rows, of which the driver gets the weights only: at most ``max_rows`` rows of each label, chosen by a hash of the
id, of at most ``max_chars`` code points. A label holds for a whole text, so fitting alternates between scoring all windows and
learning from the highest-scoring ones of each text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from netloom.llm.columns import column, whole_text
from netloom.llm.words import _LOWER, _hash_spans, _raw, _spans, small_batches

WINDOW, STRIDE = 32, 16
WORDS_LOG2, CHARS_LOG2 = 18, 13
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 8, 8, 8, 8
_F = np.float32
_WINDOWS_AT_ONCE = 4096

_EDGE = np.zeros(256, dtype=bool)
_EDGE[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


@dataclass
class Batch:
    """Words of some texts: distinct words, and each text's sequence of them (0 is padding)."""

    buckets: np.ndarray  # word bucket per distinct word
    grams: np.ndarray  # trigram buckets of all distinct words in a row
    grams_at: np.ndarray  # where each distinct word's trigrams begin; every word has one at least
    words: np.ndarray  # index of each word, from 1
    rows_at: np.ndarray  # where each text's words begin


def read_words(texts: pa.Array) -> Batch:
    data, at = _raw(texts)
    empty = np.zeros(0, dtype=np.int64)
    if not len(data):
        return Batch(empty, empty, empty, empty, np.zeros(len(texts) + 1, dtype=np.int64))
    low = _LOWER[data]
    starts, ends = _spans(low, at)
    rows_at = np.searchsorted(starts, at)
    for _ in range(4):  # punctuation at the ends of a word is not part of it
        starts = starts + (_EDGE[low[starts]] & (ends - starts > 1))
        ends = ends - (_EDGE[low[ends - 1]] & (ends - starts > 1))
    if not len(starts):
        return Batch(empty, empty, empty, empty, rows_at)
    # Positions where words end before the next one starts keep the order that the hashing needs.
    hashes = _hash_spans(low, starts, ends)
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = starts[first], ends[first]
    lengths = ends - starts
    grams_at = np.concatenate([[0], np.cumsum(lengths)])
    place = np.repeat(starts - grams_at[:-1], lengths) + np.arange(grams_at[-1])
    here = low[place].astype(np.uint32)
    before, after = np.zeros_like(here), np.zeros_like(here)
    before[1:], after[:-1] = here[:-1], here[1:]
    before[grams_at[:-1]] = 0
    after[grams_at[1:] - 1] = 0
    code = (before * np.uint32(65599) + here) * np.uint32(65599) + after
    grams = (code * np.uint32(2654435761)) >> np.uint32(32 - CHARS_LOG2)
    return Batch(
        (hashes[first] >> np.uint64(64 - WORDS_LOG2)).astype(np.int64), grams.astype(np.int64), grams_at[:-1],
        inverse.reshape(-1) + 1, rows_at,
    )


def windows_of(rows_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and length of all windows; a text without words has none."""
    lengths = np.diff(rows_at)
    number = np.where(lengths > 0, np.maximum(1, -(-(lengths - STRIDE) // STRIDE)), 0)
    text = np.repeat(np.arange(len(lengths)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    first = rows_at[:-1][text] + nth * STRIDE
    return text, first, np.minimum(WINDOW, rows_at[1:][text] - first)


def window_words(words: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(windows, WINDOW) word indices, padded with 0 behind the end."""
    place = first[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    return np.where(inside, words[np.minimum(place, max(len(words) - 1, 0))], 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return _F(1) / (_F(1) + np.exp(-x))


class Network:
    """Weights, scores and gradients. All arrays are float32 and of fixed size."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        width = WORD_DIM + CHAR_DIM

        def random(*shape, scale=None):
            return (rng.standard_normal(shape) * (scale or shape[0] ** -0.5)).astype(_F)

        self.w = {
            "words": random(1 << WORDS_LOG2, WORD_DIM, scale=0.1), "chars": random(1 << CHARS_LOG2, CHAR_DIM, scale=0.3),
            "attend": random(2 * HIDDEN, ATTEND), "query": random(ATTEND), "out": random(2 * HIDDEN), "bias": np.zeros(1, _F),
        }
        self.slope, self.shift = 1.0, 0.0  # from a text's highest logit to the logit of its label
        for side in "fb":
            self.w |= {
                f"in_{side}": random(width, 3 * HIDDEN), f"own_{side}": random(HIDDEN, 3 * HIDDEN),
                f"bias_{side}": np.concatenate([np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(_F),
            }

    def stored(self) -> pa.RecordBatch:
        """Rows (name, shape, data) from which ``restored`` makes the same network."""
        rows = {**self.w, "scale": np.array([self.slope, self.shift])}
        return pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array([v.shape for v in rows.values()], pa.list_(pa.int64())), pa.array([v.tobytes() for v in rows.values()], pa.binary())],
            names=["name", "shape", "data"],
        )

    @classmethod
    def restored(cls, rows: pa.Table) -> Network:
        net = cls.__new__(cls)
        found = {r["name"]: (r["shape"], r["data"]) for r in rows.to_pylist()}
        net.slope, net.shift = np.frombuffer(found.pop("scale")[1]).tolist()
        net.w = {name: np.frombuffer(data, dtype=_F).reshape(shape) for name, (shape, data) in found.items()}
        return net

    def inputs(self, b: Batch) -> np.ndarray:
        """Vectors of the distinct words, behind one of zeros for padding."""
        out = np.zeros((len(b.buckets) + 1, WORD_DIM + CHAR_DIM), dtype=_F)
        if len(b.buckets):
            number = np.diff(np.append(b.grams_at, len(b.grams))).astype(_F)
            out[1:, :WORD_DIM] = self.w["words"][b.buckets]
            out[1:, WORD_DIM:] = np.add.reduceat(self.w["chars"][b.grams], b.grams_at) / number[:, None]
        return out

    def _read(self, side: str, gates: np.ndarray, idx: np.ndarray, keep: list | None) -> np.ndarray:
        """States (WINDOW, windows, HIDDEN) of one direction; ``keep`` gets what the gradient needs."""
        own, h = self.w[f"own_{side}"], np.zeros((len(idx), HIDDEN), dtype=_F)
        states = np.empty((WINDOW, len(idx), HIDDEN), dtype=_F)
        for t in range(WINDOW) if side == "f" else reversed(range(WINDOW)):
            x, u = gates[idx[:, t]], h @ own
            zr = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            there = (idx[:, t] > 0)[:, None]
            if keep is not None:
                keep.append((t, h, z, r, n, u[:, 2 * HIDDEN :], there))
            h = np.where(there, new, h)
            states[t] = h
        return states

    def forward(self, vectors: np.ndarray, idx: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window."""
        states = []
        for side in "fb":
            gates = vectors @ self.w[f"in_{side}"] + self.w[f"bias_{side}"]
            steps = None if keep is None else keep.setdefault(side, [])
            states.append(self._read(side, gates, idx, steps))
        h = np.concatenate(states, axis=2)
        look = np.tanh(h @ self.w["attend"])
        weight = np.where(idx.T > 0, look @ self.w["query"], _F(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tw,twh->wh", weight, h)
        if keep is not None:
            keep.update(h=h, look=look, weight=weight, pooled=pooled)
        return pooled @ self.w["out"] + self.w["bias"]

    def gradients(self, b: Batch, vectors: np.ndarray, idx: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy."""
        keep: dict = {}
        p = _sigmoid(self.forward(vectors, idx, keep))
        d_logit = ((p - wanted) / len(wanted)).astype(_F)
        g = {"out": keep["pooled"].T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.w["out"]
        h, look, weight = keep["h"], keep["look"], keep["weight"]
        d_h = weight[:, :, None] * d_pooled
        d_weight = np.einsum("twh,wh->tw", h, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_look = d_score[:, :, None] * self.w["query"] * (1 - look * look)
        g["query"] = np.einsum("tw,twa->a", d_score, look)
        g["attend"] = np.einsum("twh,twa->ha", h, d_look)
        d_h += d_look @ self.w["attend"].T
        d_vectors = np.zeros_like(vectors)
        for n, side in enumerate("fb"):
            own = self.w[f"own_{side}"]
            d_gates = np.zeros((len(vectors), 3 * HIDDEN), dtype=_F)
            g_own, carried = np.zeros_like(own), np.zeros((len(idx), HIDDEN), dtype=_F)
            for t, before, z, r, new, u, there in reversed(keep[side]):
                d = carried + d_h[t, :, n * HIDDEN : (n + 1) * HIDDEN]
                inside = np.where(there, d, _F(0))
                d_n = inside * (1 - z) * (1 - new * new)
                d_z = inside * (before - new) * z * (1 - z)
                d_r = d_n * u * r * (1 - r)
                d_own = np.concatenate([d_z, d_r, d_n * r], axis=1)
                g_own += before.T @ d_own
                carried = np.where(there, inside * z, d) + d_own @ own.T
                np.add.at(d_gates, idx[:, t], np.concatenate([d_z, d_r, d_n], axis=1))
            g[f"own_{side}"] = g_own
            g[f"in_{side}"] = vectors.T @ d_gates
            g[f"bias_{side}"] = d_gates[1:].sum(axis=0)
            d_vectors += d_gates @ self.w[f"in_{side}"].T
        number = np.diff(np.append(b.grams_at, len(b.grams)))
        each = np.repeat(d_vectors[1:, WORD_DIM:] / number[:, None].astype(_F), number, axis=0)
        # Of the two tables only the rows in use: (rows, gradients).
        for table, at, values in (("words", b.buckets, d_vectors[1:, :WORD_DIM]), ("chars", b.grams, each)):
            rows, inverse = np.unique(at, return_inverse=True)
            total = np.zeros((len(rows), values.shape[1]), dtype=_F)
            np.add.at(total, inverse.reshape(-1), values)
            g[table] = (rows, total)
        return g

    def window_logits(self, b: Batch, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        vectors, out = self.inputs(b), np.empty(len(first), dtype=_F)
        for at in range(0, len(first), _WINDOWS_AT_ONCE):
            part = slice(at, at + _WINDOWS_AT_ONCE)
            out[part] = self.forward(vectors, window_words(b.words, first[part], length[part]))
        return out

    def text_scores(self, texts: pa.Array) -> np.ndarray:
        """Score of each text: its most toxic window's; 0, but for rounding, without words."""
        b = read_words(texts)
        text, first, length = windows_of(b.rows_at)
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, text, self.window_logits(b, first, length).astype(np.float64))
        return 1 / (1 + np.exp(-np.clip(self.slope * out + self.shift, -50, 50)))

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, prior: float, steps: int = 400) -> None:
        """Fit the slope and shift on texts that were not learned from, weighted to the share ``prior`` of label 1."""
        share = labels.mean()
        weight = np.where(labels > 0, prior / share, (1 - prior) / (1 - share))
        weight /= weight.sum()
        slope, shift = 0.0, 0.0  # of the logarithm of the slope, so that the order of scores stays
        pull = 0.3 / labels.sum()  # few positives say little about the shift
        for _ in range(steps):
            x = np.exp(slope) * logits
            off = weight * (1 / (1 + np.exp(-np.clip(x + shift, -50, 50))) - labels)
            slope -= 0.1 * ((off * x).sum() / (1 + np.abs(x).mean()) + pull * slope)
            shift -= 0.5 * (off.sum() + pull * shift)
        self.slope, self.shift = float(np.exp(slope)), float(shift)


def fit(texts: list[str], toxic: list[int], prior: float | None = None, epochs: int = 12, seed: int = 7) -> Network | None:
    """Fit a network; without rows of both labels there is none, and all texts score 0.

    ``prior``: the share of label 1 among all labelled rows, if the rows given have another. Every sixth row serves for calibration only.
    """
    labels = np.array(toxic, dtype=_F)
    if not len(labels) or labels.min() == labels.max():
        return None
    rng, net = np.random.default_rng(seed), Network(seed)
    b = read_words(pa.array(texts, pa.large_string()))
    text, first, length = windows_of(b.rows_at)
    if not len(text):
        return None
    aside = np.arange(len(labels)) % 6 == 5
    learn_from = ~aside[text]
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.w.items()}
    step = 0
    epochs = max(epochs, min(60, 6000 // len(labels)))
    for epoch in range(epochs):
        if epoch < max(2, epochs // 4):
            # At first any window may be the toxic one: some of each text.
            rank = rng.random(len(text))
            most = 6
        else:
            rank = -net.window_logits(b, first, length)
            rank = np.where(rng.random(len(text)) < 0.03, -1e9, rank)  # and a few others
            most = 3
        order = np.lexsort((rank, text))
        nth = np.arange(len(order)) - np.searchsorted(text[order], text[order], side="left")
        # A toxic text has few toxic windows, a clean one none: the positives are its top, the negatives any of the others' tops.
        limit = np.where(labels[text[order]] > 0, most if epoch < max(2, epochs // 4) else 1, most)
        chosen = rng.permutation(order[(nth < limit) & learn_from[order]])
        for at in range(0, len(chosen), 128):
            part = chosen[at : at + 128]
            idx = window_words(b.words, first[part], length[part])
            used, inverse = np.unique(idx, return_inverse=True)
            used = used[used > 0] - 1
            idx = inverse.reshape(idx.shape) + (0 if (idx == 0).any() else 1)
            ends = np.append(b.grams_at, len(b.grams))
            sizes = ends[used + 1] - ends[used]
            local_at = np.cumsum(sizes) - sizes
            grams = b.grams[np.repeat(ends[used] - local_at, sizes) + np.arange(sizes.sum())]
            local = Batch(b.buckets[used], grams, local_at, b.words, b.rows_at)
            vectors = net.inputs(local)
            vectors[1:] *= rng.random((len(vectors) - 1, 1)) > 0.05  # now and then a word is hidden
            grads = net.gradients(local, vectors, idx, labels[text[part]])
            step += 1
            rate = 0.01 * min(1.0, 4 * (1 - epoch / epochs) + 0.1)
            for k, grad in grads.items():
                rows, grad = grad if isinstance(grad, tuple) else (slice(None), grad)
                m, v = moment[k]
                m[rows] += 0.1 * (grad - m[rows])
                v[rows] += 0.01 * (grad * grad - v[rows])
                net.w[k][rows] -= (rate * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.99**step)) + 1e-6)).astype(_F)
    best = np.full(len(labels), -np.inf)
    np.maximum.at(best, text, net.window_logits(b, first, length))
    checked = aside & np.isfinite(best)
    if 0 < labels[checked].sum() < checked.sum():
        net.calibrate(best[checked].astype(np.float64), labels[checked].astype(np.float64), prior or float(labels.mean()))
    return net


def training_side(id_col: Column) -> Column:
    """Whether a row's label may be learned from; the others are held out."""
    return F.crc32(id_col.cast("string")) % 3 != 1


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = 2000, max_chars: int = 20_000,
) -> Network | None:
    """A network fitted on the labelled texts of ``docs``: of each label, those of the ``max_rows`` smallest id hashes.

    Rows of ``labels`` with a null id, or a label other than 0 and 1, are ignored, and so are texts longer than ``max_chars``.
    """
    known = labels.select(column(labels, id_col).alias("id"), column(labels, label_col).alias("label"))
    known = known.where(F.col("id").isNotNull() & training_side(F.col("id")))
    known = known.where("label in (0, 1)").groupBy("id").agg(F.max("label").alias("label")).withColumn("order", F.xxhash64("id"))
    prior = known.agg(F.avg("label")).first()[0]
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy("order", "id").limit(max_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    text = whole_text(docs, text_col)
    rows = (
        docs.select(column(docs, id_col).alias("id"), text.alias("text")).where(F.char_length("text") <= max_chars)
        .join(F.broadcast(chosen), "id")  # at most 2 * max_rows rows of three numbers
        .orderBy("order", "id", "text").limit(2 * max_rows).select("text", "label")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            toxic += batch.column(1).to_pylist()
        network = fit(texts, toxic, prior)
        if network is not None:
            yield network.stored()

    # A cut after an order is one partition in that order.
    stored = rows.mapInArrow(run, "name string, shape array<bigint>, data binary").toArrow()
    return Network.restored(stored) if len(stored) else None


def _in_small_groups(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with some megabytes of text in column ``at``."""
    sizes = np.cumsum([len(x) for x in batch.column(at).cast(pa.large_binary()).to_pylist()]) if len(batch) else []
    start = 0
    while start < len(batch):
        base = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, base + (1 << 20), side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _scores(network: Network | None, texts: pa.Array) -> np.ndarray:
    if network is None:
        return np.zeros(len(texts))
    return np.round(np.clip(network.text_scores(texts), 0, 1), 6)


def score_texts(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, score) of every row of ``docs``; null and empty texts, and texts of white space only, score 0.

    Rows are scored one by one, so repeated rows and null ids need no care, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _in_small_groups(batch, 1):
                score = pa.array(_scores(shared.value, part.column(1)), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), score], names=["id", "score"])

    rows = docs.select(column(docs, id_col).alias("id"), whole_text(docs, text_col).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).select(F.col("id").alias(id_col), "score")


def drop_toxic(docs: DataFrame, network: Network | None, text_col: str = "text", least: float = 0.7) -> DataFrame:
    """Rows of ``docs`` that score below ``least``, with all their columns, in one pass without a shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    shared, at = spark.sparkContext.broadcast(network), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).fill_null("")
            batch = batch.append_column("_scored", texts)
            for part in _in_small_groups(batch, batch.num_columns - 1):
                low = _scores(shared.value, part.column(part.num_columns - 1)) < least
                yield part.filter(pa.array(low)).select(list(range(part.num_columns - 1)))

    names = [f"c{n}" for n in range(len(docs.columns))]
    inner = docs.toDF(*names)
    return inner.mapInArrow(run, inner.schema).toDF(*docs.columns)
