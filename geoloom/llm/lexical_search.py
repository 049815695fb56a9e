"""Ranked lexical search with bit-sliced Bloom signatures: the best documents of every query, exact.

Signatures. A document's terms go into a Bloom filter, each once for every power of two that its occurrences reach, so
that the filter tells presence and an upper bound of the occurrences. Documents of one filter width share a block, kept
as bit slices: row j holds bit j of all its documents. The bitmap of documents that may have a term is the AND of a few
slices; it may have a document too many, never one too few.

Search. The weights of the terms take one count over all documents, made in the pass that builds the signatures. A
document's score is bounded from above by the weighted sums of its slices. The documents of the highest bounds are scored
exactly first; the last of a query's best ``top`` is a score that its result reaches. Every document whose bound is
not below that is then scored exactly, from its whole text; the others are proven not to be in the result.

Nothing but narrow rows is shuffled: tasks send their ``top`` best a query. Which documents are scored is told by a
bitmap of bounded size; a full one lets more documents be scored, results do not change. Queries go in packets of
bounded size, one at a time. A group of copies is one signature a row and cannot make any other row dearer.

Terms are compared by 64-bit hashes, which cannot clash for terms of equal length up to eight bytes.

Defined results: a null text has no terms; a query without terms, or none of whose terms occurs, has no rows; each row
of the queries is a query, repeated or null ids included; repeated documents are ranked each; documents without an id
come last among equal scores; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm import arrowtext as at
from geoloom.llm.bitmaps import Bitmap
from geoloom.llm.common import written

_U = np.uint64
TOP = 50
#: Slices a term and level sets, and bits a filter has for each at least.
HASHES, BITS = 3, 8
#: Widest filter in powers of two; a document of more terms has a fuller one, which only raises its bounds.
MOST_BITS = 20
#: Bits of one block: its documents times their width.
BLOCK_BITS = 1 << 22
#: Bytes of text that are taken apart at a time, but for a longer text.
PIECE_BYTES = 4 << 20
#: Queries and distinct terms of one packet; a query of more terms is one of its own.
PACKET_QUERIES, PACKET_TERMS = 2048, 65_536
#: Terms whose contributions to a block stand in memory together.
TERM_STEP = 2048

_TERM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

_INDEX = T.StructType(
    [
        T.StructField("width", T.IntegerType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("slices", T.BinaryType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_terms", T.LongType()),
        T.StructField("df", T.ArrayType(T.LongType())),
    ]
)
_INDEX_ARROW = pa.schema(
    [
        ("width", pa.int32()),
        ("keys", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("slices", pa.binary()),
        ("n_docs", pa.int64()),
        ("n_terms", pa.int64()),
        ("df", pa.list_(pa.int64())),
    ]
)


# --- terms of documents


def _terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, hash of every term, number of each row's first term) of a few texts at a time."""
    data, places = at.buffers(texts)
    for low, high in at.pieces(places, PIECE_BYTES):
        own = at.LOWER[data[places[low] : places[high]]]
        starts, ends, first = at.word_places(own, places[low : high + 1] - places[low], at.NOT_ALNUM)
        yield low, high, at.byte_hashes(own, starts, ends), first


def _counted(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and occurrences of every pair of a document and a term, in order of the documents."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes, distinct = pd.factorize(hashes)
    docs = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs, tf = np.unique(docs * len(distinct) + codes, return_counts=True)
    return pairs // len(distinct), distinct[pairs % len(distinct)], tf


def _slots(terms: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The slices, one row a hash, that a term sets at a level."""
    x = at.mix(terms + _U(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1))
    return np.stack([(x >> _U(k * MOST_BITS)).astype(np.int64) & ((1 << bits) - 1) for k in range(HASHES)])


# --- signatures


class _Blocks:
    """Documents of a task, gathered by the width of their filters until a block is full."""

    def __init__(self):
        self.open: dict[int, list] = {}

    def add(self, keys: np.ndarray, lengths: np.ndarray, docs: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> Iterator[dict]:
        levels = np.frexp(tf.astype(np.float64))[1]  # 1 for one occurrence, 2 from two on, 3 from four on
        set_by = np.bincount(docs, weights=levels, minlength=len(keys)).astype(np.int64)
        widths = np.clip(np.ceil(np.log2(np.maximum(set_by * BITS, 64))), 6, MOST_BITS).astype(np.int64)
        for bits in np.unique(widths[set_by > 0]).tolist():
            own = np.flatnonzero((widths == bits) & (set_by > 0))
            number = np.full(len(keys), -1)
            number[own] = np.arange(len(own))
            mine = np.flatnonzero(number[docs] >= 0)
            most = max(8, BLOCK_BITS >> bits)
            for low in range(0, len(own), most):
                some = mine[(number[docs[mine]] >= low) & (number[docs[mine]] < low + most)]
                rows = own[low : low + most]
                part = (keys[rows], lengths[rows], number[docs[some]] - low, terms[some], levels[some])
                parts = self.open.setdefault(bits, [])
                if sum(len(p[0]) for p in parts) + len(rows) > most:
                    yield self._block(bits, parts)
                    parts = self.open[bits] = []
                parts.append(part)

    def rest(self) -> Iterator[dict]:
        for bits, parts in self.open.items():
            yield self._block(bits, parts)

    @staticmethod
    def _block(bits: int, parts: list) -> dict:
        shift = np.cumsum([0] + [len(p[0]) for p in parts])
        docs = np.concatenate([p[2] + s for p, s in zip(parts, shift, strict=False)])
        terms, levels = (np.concatenate([p[k] for p in parts]) for k in (3, 4))
        table = np.zeros((1 << bits, -(-int(shift[-1]) // 8) * 8), dtype=bool)
        level = 0
        while len(docs):
            for slot in _slots(terms, level, bits):
                table[slot, docs] = True
            level += 1
            more = levels > level
            docs, terms, levels = docs[more], terms[more], levels[more]
        keys, lengths = (np.concatenate([p[k] for p in parts]).tolist() for k in (0, 1))
        return {"width": bits, "keys": keys, "lengths": lengths, "slices": np.packbits(table, axis=1).tobytes()}


def _indexed(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray, signatures: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of signatures of a task's documents (_key, _text), and one row with its counts."""
    n_docs = n_terms = 0
    df = np.zeros(len(vocabulary), dtype=np.int64)
    blocks = _Blocks()

    def out(row: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([row], schema=_INDEX_ARROW)

    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for low, high, hashes, first in _terms(batch.column(1)):
            lengths = np.diff(first)
            docs, terms, tf = _counted(hashes, first)
            n_docs, n_terms = n_docs + int((lengths > 0).sum()), n_terms + len(hashes)
            places = np.minimum(np.searchsorted(vocabulary, terms), max(len(vocabulary) - 1, 0))
            if len(vocabulary):
                df += np.bincount(places[vocabulary[places] == terms], minlength=len(df))
            if signatures:
                for row in blocks.add(keys[low:high], lengths, docs, terms, tf):
                    yield out(row)
    for row in blocks.rest():
        yield out(row)
    yield out({"n_docs": n_docs, "n_terms": n_terms, "df": df.tolist()})


# --- queries


class Packet:
    """Some queries: their distinct terms, and for each query the numbers of its terms."""

    def __init__(self, queries: list[tuple[object, list[str]]]):
        self.ids = [i for i, _ in queries]
        words = sorted({w for _, own in queries for w in own})
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(x) for x in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        hashes = at.byte_hashes(data, ends - [len(x) for x in raw], ends) if raw else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.vocabulary = hashes[order]
        place = {words[k]: n for n, k in enumerate(order.tolist())}
        self.terms = [np.array(sorted(place[w] for w in own), dtype=np.int64) for _, own in queries]

    def weigh(self, n_docs: int, n_terms: int, df: list[int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df], dtype=np.int64)

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        return 50 + 50 * lengths.astype(np.int64) * self.n_docs // self.n_terms

    def gain(self, terms: np.ndarray, tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """What each term with its occurrences adds to the score of a document of that norm."""
        return self.weights[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * norms))


def _packets(queries: DataFrame, query_id: str, text: str) -> Iterator[Packet]:
    some: list[tuple[object, list[str]]] = []
    seen: set[str] = set()
    for row in queries.select(F.col(query_id).alias("i"), F.col(text).alias("t")).toLocalIterator():
        own = sorted(set(_TERM.findall((row.t or "").translate(_LOWER))))
        if some and (len(some) == PACKET_QUERIES or len(seen) + len(own) > PACKET_TERMS):
            yield Packet(some)
            some, seen = [], set()
        some.append((row.i, own))
        seen.update(own)
    if some:
        yield Packet(some)


# --- upper bounds


def _bounds(row: dict, packet: Packet) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a block's documents, and an upper bound of the score of each (column) for each query (row)."""
    bits, keys = row["width"], np.array(row["keys"], dtype=np.int64)
    n = len(keys)
    norms = packet.norms(np.array(row["lengths"], dtype=np.int64))
    slices = np.frombuffer(row["slices"], np.uint8).reshape(1 << bits, -1)
    total = np.zeros((len(packet.ids), n), dtype=np.int64)
    for low in range(0, len(packet.vocabulary), TERM_STEP):
        high = min(low + TERM_STEP, len(packet.vocabulary))
        terms = packet.vocabulary[low:high]
        reached = np.zeros((high - low, n), dtype=np.uint8)
        asked, maybe, level = np.arange(high - low), None, 0
        while len(asked):
            slots = _slots(terms[asked], level, bits)
            now = np.bitwise_and.reduce(slices[slots], axis=0)
            maybe = now if maybe is None else maybe & now  # who has fewer occurrences has not more
            left = np.flatnonzero(maybe.any(axis=1))
            asked, maybe, level = asked[left], maybe[left], level + 1
            reached[asked] += np.unpackbits(maybe, axis=1, count=n)
        gains = np.zeros((high - low, n), dtype=np.int64)
        which, doc = np.nonzero(reached)
        most = (1 << reached[which, doc].astype(np.int64)) - 1
        gains[which, doc] = packet.gain(which + low, most, norms[doc])
        for k, own in enumerate(packet.terms):
            a, b = np.searchsorted(own, (low, high))
            if a < b:
                total[k] += np.add.reduce(gains[own[a:b] - low], axis=0)
    return keys, total


class _Best:
    """The best rows of each query seen by a task: highest value first, then smallest id."""

    def __init__(self, queries: int, top: int):
        self.top = top
        self.rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(queries)]
        self.least = np.ones(queries, dtype=np.int64)

    def offer(self, query: int, values: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = np.flatnonzero(values >= self.least[query])
        if not len(good):
            return
        old = self.rows[query]
        values, ids, no_id = (np.concatenate([a, b[good]]) for a, b in zip(old, (values, ids, no_id), strict=True))
        order = np.lexsort((ids, no_id, -values))[: self.top]
        self.rows[query] = (values[order], ids[order], no_id[order])
        if len(order) == self.top:
            self.least[query] = values[order[-1]]

    def batches(self) -> Iterator[pa.RecordBatch]:
        for k, (values, ids, no_id) in enumerate(self.rows):
            if len(values):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), k, np.int32)), pa.array(ids, mask=no_id), pa.array(values)], names=["query", "id", "value"]
                )


_BEST = "query int, id long, value long"


def _highest_bounds(batches: Iterator[pa.RecordBatch], packet: Packet, top: int) -> Iterator[pa.RecordBatch]:
    best = _Best(len(packet.ids), top)
    for batch in batches:
        for row in batch.to_pylist():
            keys, bounds = _bounds(row, packet)
            for k in np.flatnonzero(bounds.max(axis=1) >= best.least):
                best.offer(k, bounds[k], keys, np.zeros(len(keys), bool))
    yield from best.batches()


def _not_excluded(batches: Iterator[pa.RecordBatch], packet: Packet, reached: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Keys of the documents whose bound is not below the score that some query's result reaches."""
    for batch in batches:
        for row in batch.to_pylist():
            keys, bounds = _bounds(row, packet)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(keys[(bounds >= reached[:, None]).any(axis=0)]))], names=["_key"])


# --- exact scores


def _scored(batches: Iterator[pa.RecordBatch], packet: Packet, top: int, reached: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The task's best documents (doc_id, _text) of each query, scored from their whole texts."""
    best = _Best(len(packet.ids), top)
    best.least = np.maximum(best.least, reached)
    sizes = np.bincount(np.concatenate([*packet.terms, np.zeros(0, np.int64)]), minlength=len(packet.vocabulary))
    asking = np.repeat(np.arange(len(packet.terms)), [len(x) for x in packet.terms])
    asking = asking[np.argsort(np.concatenate([*packet.terms, np.zeros(0, np.int64)]), kind="stable")]  # queries by term
    begin = np.cumsum(sizes) - sizes
    for batch in batches:
        no_id = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        for low, high, hashes, first in _terms(batch.column(1)):
            places = np.minimum(np.searchsorted(packet.vocabulary, hashes), len(packet.vocabulary) - 1)
            known = np.flatnonzero(packet.vocabulary[places] == hashes)
            docs = np.searchsorted(first, known, side="right") - 1
            pairs, tf = np.unique(docs * len(packet.vocabulary) + places[known], return_counts=True)
            docs, terms = pairs // len(packet.vocabulary), pairs % len(packet.vocabulary)
            gains = packet.gain(terms, tf, packet.norms(np.diff(first))[docs])
            times = sizes[terms]
            who = asking[at.ragged(begin[terms], times)]
            cells, back = np.unique(who * (high - low) + np.repeat(docs, times), return_inverse=True)
            totals = np.zeros(len(cells), dtype=np.int64)
            np.add.at(totals, back, np.repeat(gains, times))
            edges = np.searchsorted(cells, np.arange(len(packet.ids) + 1) * (high - low))
            for k in np.flatnonzero(np.diff(edges)):
                rows = cells[edges[k] : edges[k + 1]] % (high - low) + low
                best.offer(k, totals[edges[k] : edges[k + 1]], ids[rows], no_id[rows])
    yield from best.batches()


def _ranked(best: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("value"), F.col("id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _score_those(documents: DataFrame, keys: DataFrame, packet: Packet, top: int, reached: np.ndarray) -> DataFrame:
    """The best documents among those of the keys (a few others may be scored too), exactly scored."""
    keys = written(keys.select("_key"), "search-keys")
    some = Bitmap(keys, "_key", keys.count()).maybe(documents, "_key").select("_id", "_text")
    return _ranked(some.mapInArrow(partial(_scored, packet=packet, top=top, reached=reached), _BEST), top)


def search(documents: DataFrame, queries: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """(query id, rank, doc_id, score): the ``top`` documents of the highest scores above 0 of each query."""
    spark = documents.sparkSession
    own = documents.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text")).withColumn("_key", F.xxhash64("_id"))
    id_type = queries.schema[query_id].dataType
    found, blocks = None, None
    for packet in _packets(queries, query_id, query_text):
        made = partial(_indexed, vocabulary=packet.vocabulary, signatures=blocks is None)
        rows = written(own.select("_key", "_text").mapInArrow(made, _INDEX), "signatures")
        counts = rows.filter("df is not null")
        n_docs, n_terms = counts.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        df = dict(counts.select(F.posexplode("df")).groupBy("pos").agg(F.sum("col")).collect())
        blocks = rows.filter("width is not null").select("width", "keys", "lengths", "slices") if blocks is None else blocks
        if not n_terms or not len(packet.vocabulary):
            continue
        packet.weigh(n_docs, n_terms, [df[k] for k in range(len(packet.vocabulary))])
        nothing = np.ones(len(packet.ids), dtype=np.int64)
        highest = _ranked(blocks.mapInArrow(partial(_highest_bounds, packet=packet, top=top), _BEST), top)
        first = _score_those(own, highest.select(F.col("id").alias("_key")).distinct(), packet, top, nothing)
        last = {r.query: r.value for r in first.filter(F.col("rank") == top).collect()}
        reached = np.array([last.get(k, 1) for k in range(len(packet.ids))], dtype=np.int64)
        keys = blocks.mapInArrow(partial(_not_excluded, packet=packet, reached=reached), "_key long")
        best = _score_those(own, keys, packet, top, reached)
        names = spark.createDataFrame([(k, i) for k, i in enumerate(packet.ids)], T.StructType([T.StructField("query", T.IntegerType()), T.StructField(query_id, id_type)]))
        named = best.join(F.broadcast(names), "query").select(query_id, "rank", F.col("id").alias("doc_id"), F.col("value").alias("score"))
        named = written(named, "search-result")
        found = named if found is None else found.unionAll(named)
    if found is None:
        return spark.createDataFrame([], T.StructType([T.StructField(query_id, id_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return found
