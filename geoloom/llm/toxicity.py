"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

Input of a word is its hashed embedding and the mean of the embeddings of its character 3- and 4-grams, edges marked.
Two gated recurrent units read a window of words forwards and backwards; attention over their states pools the
window, and a logistic unit scores it. Every text is scored in all its overlapping windows, half a window apart, up
to its last word; the highest window gives the text's score.

Labels belong to texts, so training learns from the window of each text that scores highest at that moment (multiple
instances), by Adam with gradients through all steps. Embeddings start with one coordinate at the log odds of their
word or character run among the training texts. The training texts are a bounded sample, see
:func:`geoloom.llm.labelled.sample`.

Defined results: null, empty and wordless texts get the score of a window without words, as do short windows' missing
words none; long texts count whole; without labels, or with one class only, all scores are the share of label 1
(0 without labels); documents without an id and repeated rows are scored each for themselves; empty tables give
empty results; columns called like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from geoloom.llm import arrowtext as at
from geoloom.llm.common import added_to
from geoloom.llm.labelled import sample

PER_CLASS, MOST_BYTES = 1500, 8 << 10
WINDOW, STRIDE = 32, 16
WORD_ROWS, CHAR_ROWS, EMBEDDING, HIDDEN = 1 << 13, 1 << 13, 8, 12
STEPS, BATCH, RATE = 240, 32, 0.01
SLICE_BYTES, CHUNK = 1 << 20, 4096
SEED = 7

_WORD = at.NOT_ALNUM


class Words:
    """Distinct words of some texts, their input rows, and each text's windows."""

    def __init__(self, data: np.ndarray, places: np.ndarray):
        data = at.LOWER[data]
        starts, ends, first = at.word_places(data, places, _WORD)
        hashes = at.byte_hashes(data, starts, ends)
        codes, distinct = pd.factorize(hashes)
        one = np.zeros(len(distinct), dtype=np.int64)
        one[codes[::-1]] = np.arange(len(codes))[::-1]
        self.codes = codes.astype(np.int64)
        self.word_row = (distinct % np.uint64(WORD_ROWS)).astype(np.int64)
        self._grams(data, starts[one], ends[one])
        n = np.diff(first)
        counts = np.maximum(1, -(-np.maximum(n - WINDOW, 0) // STRIDE) + 1)
        self.text = np.repeat(np.arange(len(n)), counts)
        turn = np.arange(len(self.text)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = first[:-1][self.text] + turn * STRIDE
        self.length = np.clip(first[1:][self.text] - begin, 0, WINDOW)
        at_ = np.minimum(begin[:, None] + np.arange(WINDOW), max(0, len(codes) - 1))
        # Distinct word of each place; places behind a window's end are masked later.
        self.slots = self.codes[at_] if len(codes) else np.zeros((len(self.text), WINDOW), np.int64)
        self.n_texts = len(n)

    def _grams(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Rows of the character runs of each distinct word, end to end, and where each word's begin."""
        length = ends - starts
        spread = np.zeros(int(length.sum()) + 2 * len(length), dtype=np.uint32)
        to = np.cumsum(length + 2) - (length + 2)
        spread[to], spread[to + length + 1] = 1, 2
        spread[at.ragged(to + 1, length)] = data[at.ragged(starts, length)]
        three = at.ragged(to, length)  # a word of n letters has n runs of three and n - 1 of four
        four = at.ragged(to, np.maximum(length - 1, 0))
        code3 = spread[three] | spread[three + 1] << np.uint32(8) | spread[three + 2] << np.uint32(16)
        code4 = spread[four] | spread[four + 1] << np.uint32(8) | spread[four + 2] << np.uint32(16) | spread[four + 3] << np.uint32(24)
        codes = at.mix(np.concatenate([code3, code4]).astype(np.uint64) + (np.uint64(1) << np.uint64(40)))
        owner = np.concatenate([np.repeat(np.arange(len(length)), length), np.repeat(np.arange(len(length)), np.maximum(length - 1, 0))])
        order = np.argsort(owner, kind="stable")
        self.gram_row = (codes[order] % np.uint64(CHAR_ROWS)).astype(np.int64)
        self.gram_owner = owner[order]
        self.n_grams = np.bincount(owner, minlength=len(length))
        self.gram_first = np.cumsum(self.n_grams) - self.n_grams


def words_of(texts: pa.Array) -> Words:
    return Words(*at.buffers(texts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    def __init__(self, rng: np.random.Generator):
        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        d, h = 2 * EMBEDDING, HIDDEN
        self.p = {"word": normal(WORD_ROWS, EMBEDDING, scale=0.05), "char": normal(CHAR_ROWS, EMBEDDING, scale=0.05)}
        for way in ("f", "b"):
            self.p[f"w{way}"] = normal(d, 3 * h, scale=0.3)
            self.p[f"u{way}"] = normal(h, 3 * h, scale=0.3)
            self.p[f"c{way}"] = np.zeros(3 * h, np.float32)
        self.p |= {"attend": normal(2 * h, h, scale=0.3), "query": normal(h, scale=0.3), "out": normal(2 * h, scale=0.3), "bias": np.zeros(1, np.float32)}

    def inputs(self, words: Words) -> np.ndarray:
        """Input row of each distinct word."""
        x = np.zeros((len(words.word_row), 2 * EMBEDDING), dtype=np.float32)
        x[:, :EMBEDDING] = self.p["word"][words.word_row]
        have = words.n_grams > 0
        if have.any():
            sums = np.add.reduceat(self.p["char"][words.gram_row], words.gram_first[have], axis=0)
            x[have, EMBEDDING:] = sums / words.n_grams[have, None]
        return x

    def _read(self, way: str, gates: np.ndarray, slots: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States at all steps (windows, steps, hidden); ``gates``: input part of each distinct word's gates."""
        h, u = HIDDEN, self.p[f"u{way}"]
        state = np.zeros((len(slots), h), dtype=np.float32)
        out = np.empty((len(slots), slots.shape[1], h), dtype=np.float32)
        steps = range(slots.shape[1]) if way == "f" else range(slots.shape[1] - 1, -1, -1)
        for t in steps:
            g = gates[slots[:, t]]
            rec = state @ u
            both = g[:, : 2 * h] + rec[:, : 2 * h]
            both = 1 / (1 + np.exp(-both))
            z, r = both[:, :h], both[:, h:]
            new = np.tanh(g[:, 2 * h :] + r * rec[:, 2 * h :])
            m = mask[:, t, None]
            if keep is not None:
                keep.append((t, state, z, r, new, rec[:, 2 * h :]))
            state = state + m * (1 - z) * (new - state)
            out[:, t] = state
        return out

    def forward(self, words: Words, which: np.ndarray, x: np.ndarray, saved: dict | None = None) -> np.ndarray:
        """Logits of the given windows."""
        slots, p = words.slots[which], self.p
        mask = (np.arange(WINDOW) < words.length[which, None]).astype(np.float32)
        logits = np.empty(len(which), dtype=np.float32)
        gates = {way: x @ p[f"w{way}"] + p[f"c{way}"] for way in "fb"} if len(x) else {way: np.zeros((1, 3 * HIDDEN), np.float32) for way in "fb"}
        for low in range(0, len(which), CHUNK):
            s = slice(low, low + CHUNK)
            kept = {way: [] if saved is not None else None for way in "fb"}
            states = np.concatenate([self._read(way, gates[way], slots[s], mask[s], kept[way]) for way in "fb"], axis=2)
            score = np.tanh(states @ p["attend"])
            energy = score @ p["query"] + (mask[s] - 1) * 1e4
            weight = np.exp(energy - energy.max(axis=1, keepdims=True))
            weight /= weight.sum(axis=1, keepdims=True)
            pooled = (weight[:, :, None] * states).sum(axis=1)
            logits[s] = pooled @ p["out"] + p["bias"][0]
            if saved is not None:
                saved |= {"kept": kept, "states": states, "score": score, "weight": weight, "pooled": pooled, "slots": slots[s], "mask": mask[s]}
        return logits

    def gradients(self, words: Words, which: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of at most ``CHUNK`` windows."""
        p, h, x, s = self.p, HIDDEN, self.inputs(words), {}
        logits = self.forward(words, which, x, s)
        d_logit = ((_sigmoid(logits) - y) / len(y)).astype(np.float32)
        grad = {"bias": d_logit.sum(keepdims=True), "out": s["pooled"].T @ d_logit}
        d_pooled = d_logit[:, None] * p["out"]
        d_weight = (s["states"] * d_pooled[:, None]).sum(axis=2)
        d_states = s["weight"][:, :, None] * d_pooled[:, None]
        d_energy = s["weight"] * (d_weight - (s["weight"] * d_weight).sum(axis=1, keepdims=True))
        grad["query"] = np.einsum("bt,bth->h", d_energy, s["score"])
        d_score = d_energy[:, :, None] * p["query"] * (1 - s["score"] ** 2)
        grad["attend"] = np.einsum("bti,bth->ih", s["states"], d_score)
        d_states += d_score @ p["attend"].T
        d_x = np.zeros_like(x)
        for i, way in enumerate("fb"):
            own, u = d_states[:, :, i * h : (i + 1) * h], p[f"u{way}"]
            d_gates = np.zeros((len(x), 3 * h), dtype=np.float32)
            d_u, d_next = np.zeros_like(u), np.zeros((len(which), h), np.float32)
            for t, state, z, r, new, rec in reversed(s["kept"][way]):
                d = d_next + own[:, t]
                m = s["mask"][:, t, None]
                d_new = d * m * (1 - z) * (1 - new**2)
                d_z = d * m * (state - new) * z * (1 - z)
                d_r = d_new * rec * r * (1 - r)
                d_rec = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(d_gates, s["slots"][:, t], np.concatenate([d_z, d_r, d_new], axis=1))
                d_u += state.T @ d_rec
                d_next = d * (1 - m * (1 - z)) + d_rec @ u.T
            grad[f"u{way}"], grad[f"w{way}"], grad[f"c{way}"] = d_u, x.T @ d_gates, d_gates.sum(axis=0)
            d_x += d_gates @ p[f"w{way}"].T
        grad["word"] = np.zeros_like(p["word"])
        np.add.at(grad["word"], words.word_row, d_x[:, :EMBEDDING])
        grad["char"] = np.zeros_like(p["char"])
        share = d_x[:, EMBEDDING:] / np.maximum(words.n_grams, 1)[:, None]
        np.add.at(grad["char"], words.gram_row, share[words.gram_owner])
        return grad


class Model:
    """A trained network, or a constant."""

    def __init__(self, texts: list[str], labels: list[int]):
        self.prior = float(np.mean(labels)) if labels else 0.0
        self.net = None
        if not 0 < self.prior < 1:
            return
        rng = np.random.default_rng(SEED)
        y = np.array(labels, dtype=np.float32)
        self.net = Network(rng)
        self._start(texts, y)
        moment = {k: np.zeros_like(v) for k, v in self.net.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.net.p.items()}
        step = 0
        while step < STEPS:
            order = rng.permutation(len(texts))
            for low in range(0, len(order), BATCH):
                rows = order[low : low + BATCH]
                words = words_of(pa.array([texts[k] for k in rows], pa.string()))
                logits = self.net.forward(words, np.arange(len(words.text)), self.net.inputs(words))
                top = self._tops(words, logits)
                grad, step = self.net.gradients(words, top, y[rows]), step + 1
                for k, g in grad.items():
                    moment[k] += 0.1 * (g - moment[k])
                    square[k] += 0.01 * (g * g - square[k])
                    self.net.p[k] -= RATE * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)

    def _start(self, texts: list[str], y: np.ndarray) -> None:
        """First coordinate of each embedding: log odds that a text with the row is labelled."""
        words = words_of(pa.array(texts, pa.string()))
        text = np.repeat(words.text, WINDOW).reshape(-1, WINDOW)
        inside = np.arange(WINDOW) < words.length[:, None]
        pairs = np.unique(text[inside] * len(words.word_row) + words.slots[inside])
        owner, code = pairs // len(words.word_row), pairs % len(words.word_row)
        for name, rows, texts_of in (
            ("word", words.word_row[code], owner),
            ("char", words.gram_row[at.ragged(words.gram_first[code], words.n_grams[code])], np.repeat(owner, words.n_grams[code])),
        ):
            size = len(self.net.p[name])
            both = np.unique(texts_of * size + rows)
            bad = np.bincount(both % size, weights=y[both // size], minlength=size)
            all_ = np.bincount(both % size, minlength=size)
            odds = np.log((bad + 0.5) / (all_ - bad + 0.5) * ((1 - y).sum() + 1) / (y.sum() + 1))
            self.net.p[name][:, 0] = np.clip(odds, -4, 4) * np.minimum(all_ / 5, 1) / 2

    @staticmethod
    def _tops(words: Words, logits: np.ndarray) -> np.ndarray:
        """Highest window of each text."""
        order = np.lexsort((logits, words.text))
        last = np.append(words.text[order][1:] != words.text[order][:-1], True)
        return order[last]

    def score(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.full(len(places) - 1, self.prior)
        words = Words(data, places)
        logits = self.net.forward(words, np.arange(len(words.text)), self.net.inputs(words))
        return _sigmoid(logits[self._tops(words, logits)].astype(np.float64))


def fit(documents: DataFrame, labels: DataFrame, usable, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    return Model(*sample(documents, labels, label, usable, PER_CLASS, MOST_BYTES, doc_id, text))


def score_documents(documents: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Documents with their score."""
    keep, schema = added_to(documents, T.StructType([T.StructField(score, T.DoubleType())]))
    sent = documents.sparkSession.sparkContext.broadcast(model)
    positions, column = [documents.columns.index(c) for c in keep], documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            data, places = at.buffers(batch.column(column))
            scores = [own.score(data[places[a] : places[b]], places[a : b + 1] - places[a]) for a, b in at.pieces(places, SLICE_BYTES)]
            fields = [*(batch.schema.field(i) for i in positions), pa.field(score, pa.float64())]
            columns = [*(batch.column(i) for i in positions), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return documents.mapInArrow(run, schema)
