"""Quality scores by nearest-neighbour voting among labelled documents in a latent semantic space.

Terms of a document are its hashed byte trigrams and the shapes of its words (case, symbols, length, the same word
again, a line again). Term frequencies are dampened and weighted by how rare the term is among the labelled
documents; a truncated singular value decomposition of these spans the latent space. The labelled vectors, at most
``2 * PER_CLASS`` of ``RANK`` numbers, are broadcast. Every document's cosine with every one of them is computed, in
blocks, and the ``NEIGHBOURS`` largest vote with their label, weighted by a power of the similarity.

The labelled documents are a bounded sample (see :func:`geoloom.llm.labelled.sample`), equally many of each class.

Defined results: null, empty and otherwise termless texts get the share of label 1 in the sample, as do all if only
one class, or no label (then 0.5), is known; long texts count whole; documents without an id and repeated rows are
scored each for themselves; empty tables give empty results; columns called like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from geoloom.llm import arrowtext as at
from geoloom.llm.common import added_to
from geoloom.llm.labelled import sample

PER_CLASS, MOST_BYTES = 2500, 16 << 10
TRIGRAMS, RANK, NEIGHBOURS, POWER = 4096, 48, 25, 4
SLICE_BYTES, BLOCK = 1 << 20, 512
SEED = 20240601

_LENGTHS = 24
_SHAPES = _LENGTHS + 8
TERMS = TRIGRAMS + _SHAPES
#: How much the word shapes count against the trigrams.
SHAPE_WEIGHT = 3.0

_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_ALNUM = at.NOT_ALNUM | _UPPER
_NEWLINE = np.ones(256, dtype=bool)
_NEWLINE[10] = False


def _per_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, weights=values, minlength=n)


def frequencies(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Square roots of the relative term frequencies, one row a text."""
    n = len(places) - 1
    out = np.zeros((n, TERMS), dtype=np.float32)
    if not len(data):
        return out
    code = data.astype(np.uint32)
    hashed = (code[:-2] * np.uint32(0x9E3779B1) ^ code[1:-1] * np.uint32(0x85EBCA77) ^ code[2:] * np.uint32(0xC2B2AE3D)) if len(code) > 2 else code[:0]
    hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(20)
    text = np.repeat(np.arange(n), np.diff(places))
    inside = text[: len(hashed)] == text[len(text) - len(hashed) :]
    counts = np.bincount(text[: len(hashed)][inside] * TRIGRAMS + hashed[inside], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
    out[:, :TRIGRAMS] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))

    starts, ends, first = at.word_places(data, places, at.WHITE_SPACE)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(n), n_words)
    length = np.minimum(ends - starts, _LENGTHS - 1)
    shapes = np.zeros((n, _SHAPES))
    shapes[:, :_LENGTHS] = np.bincount(owner * _LENGTHS + length, minlength=n * _LENGTHS).reshape(n, _LENGTHS)
    words = at.byte_hashes(data, starts, ends)
    for k, distance in enumerate((1, 2)):
        same = np.zeros(len(words))
        same[distance:] = (words[distance:] == words[:-distance]) & (owner[distance:] == owner[:-distance])
        shapes[:, _LENGTHS + k] = _per_text(same, owner, n)
    # Runs of eight words that occur again in the text.
    runs = at.pair(at.run_hashes(words, 8), owner[: max(0, len(words) - 7)].astype(np.uint64))
    within = owner[: len(runs)] == owner[len(owner) - len(runs) :]
    order = np.argsort(runs[within], kind="stable")
    ordered = runs[within][order]
    again = np.zeros(len(ordered))
    again[order[1:]] = ordered[1:] == ordered[:-1]
    shapes[:, _LENGTHS + 2] = _per_text(again, owner[: len(runs)][within], n)
    for k, table in ((3, _UPPER), (4, ~_ALNUM & at.WHITE_SPACE)):
        have = np.concatenate([[0], np.cumsum(table[data])])
        shapes[:, _LENGTHS + k] = _per_text((have[ends] - have[starts]) / np.maximum(ends - starts, 1), owner, n)
    line_starts, line_ends, line_first = at.word_places(data, places, _NEWLINE)
    lines = at.pair(at.byte_hashes(data, line_starts, line_ends), np.repeat(np.arange(n), np.diff(line_first)).astype(np.uint64))
    order = np.argsort(lines, kind="stable")
    again = np.zeros(len(lines))
    again[order[1:]] = lines[order][1:] == lines[order][:-1]
    line_owner = np.repeat(np.arange(n), np.diff(line_first))
    shapes[:, _LENGTHS + 5] = _per_text(again * (line_ends - line_starts), line_owner, n) / 6
    shapes /= np.maximum(n_words, 1)[:, None]
    out[:, TRIGRAMS:] = SHAPE_WEIGHT * np.sqrt(shapes)
    return out


class Neighbours:
    """The latent space and the labelled vectors in it."""

    def __init__(self, texts: list[str], labels: list[int]):
        y = np.array(labels, dtype=np.float32)
        self.prior = float(y.mean()) if len(y) else 0.5
        self.vectors = None
        if not 0 < self.prior < 1:
            return
        rows = self._rows(pa.array(texts, pa.string()))
        self.weight = (1 + np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0)))).astype(np.float32)
        rows *= self.weight
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
        # Randomised range finder with two power steps, then the small decomposition.
        rank = min(RANK, *rows.shape)
        start = np.random.default_rng(SEED).standard_normal((rows.shape[1], min(rank + 16, rows.shape[0])), dtype=np.float32)
        basis = np.linalg.qr(rows @ start)[0]
        for _ in range(2):
            basis = np.linalg.qr(rows @ np.linalg.qr(rows.T @ basis)[0])[0]
        self.terms = np.ascontiguousarray(np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:rank].T)
        vectors = rows @ self.terms
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        self.vectors, self.labels = np.ascontiguousarray(vectors.T), y

    @staticmethod
    def _rows(texts: pa.Array) -> np.ndarray:
        data, places = at.buffers(texts)
        parts = [frequencies(data[places[a] : places[b]], places[a : b + 1] - places[a]) for a, b in at.pieces(places, SLICE_BYTES)]
        return np.concatenate(parts) if parts else np.zeros((0, TERMS), np.float32)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Score of each row of term frequencies."""
        out = np.full(len(rows), self.prior)
        if self.vectors is None:
            return out
        k = min(NEIGHBOURS, self.vectors.shape[1])
        for low in range(0, len(rows), BLOCK):
            block = rows[low : low + BLOCK] * self.weight @ self.terms
            norm = np.linalg.norm(block, axis=1)
            cosine = (block / np.maximum(norm, 1e-9)[:, None]) @ self.vectors
            near = np.argpartition(cosine, -k, axis=1)[:, -k:]
            vote = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(np.float64) ** POWER
            total = vote.sum(axis=1)
            good = (vote * self.labels[near]).sum(axis=1)
            known = (norm > 1e-9) & (total > 0)
            out[low : low + BLOCK][known] = np.clip(good[known] / total[known], 0, 1)
        return out


def fit(documents: DataFrame, labels: DataFrame, usable, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Neighbours:
    return Neighbours(*sample(documents, labels, label, usable, PER_CLASS, MOST_BYTES, doc_id, text))


def score_documents(documents: DataFrame, model: Neighbours, text: str = "text", score: str = "score") -> DataFrame:
    """Documents with their score."""
    keep, schema = added_to(documents, T.StructType([T.StructField(score, T.DoubleType())]))
    sent = documents.sparkSession.sparkContext.broadcast(model)
    positions, column = [documents.columns.index(c) for c in keep], documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            data, places = at.buffers(batch.column(column))
            scores = [own.score(frequencies(data[places[a] : places[b]], places[a : b + 1] - places[a])) for a, b in at.pieces(places, SLICE_BYTES)]
            fields = [*(batch.schema.field(i) for i in positions), pa.field(score, pa.float64())]
            columns = [*(batch.column(i) for i in positions), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return documents.mapInArrow(run, schema)


