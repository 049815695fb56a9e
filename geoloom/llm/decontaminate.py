"""Benchmark decontamination by suffix arrays over the training documents.

Every shard of documents (a bounded number of words of one task's rows, whole documents) gets a suffix array over
its words, sorted to the depth of the longest benchmark item. Every suffix of every item is looked up in it by
binary search. Matches of at least ``window`` words (or of the whole item, if that is shorter) are hits; each is
extended to its longest verbatim length. Nothing is shuffled. The benchmark travels in packets, of which at most
``ROUND_BYTES`` are with the tasks at a time: a larger benchmark takes more rounds, each a pass over the documents that
adds to the matches of the one before.

Words are compared by 64-bit hashes, which cannot clash for words of equal length up to eight bytes; longer words
clash with a probability of the order of 2**-64 a pair.

Defined results: null and empty texts have no words and no hits; an item without words matches nothing; items
without an id cause hits but are not listed; repeated ids are listed once; rows that repeat are each judged for
themselves; empty tables give empty results. Columns of the result that a document column is called alike replace
that column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from geoloom.llm import arrowtext as at
from geoloom.llm.common import added_to, set_aside, written

WINDOW = 10
#: Words of one suffix array; ranks and places of 21 bits each fit a 64-bit sort key. A longer document has its own.
SHARD_WORDS = 1 << 20
#: Characters of benchmark text in one packet, and in the packets of one round.
PACKET_BYTES, ROUND_BYTES = 8 << 20, 64 << 20

MATCH = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("item_start", T.LongType()),
        T.StructField("doc_start", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)
ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("matches", T.ArrayType(MATCH)),
    ]
)


class SuffixArray:
    """Suffixes of a word sequence that holds several documents, sorted by their first ``depth`` words.

    A suffix ends with its document.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray, depth: int):
        n = len(words)
        codes, self.vocabulary = pd.factorize(words)
        self.words = codes.astype(np.int64) + 1
        ends = np.repeat(first[1:], np.diff(first))
        self.begins, self.ends, self.depth = np.repeat(first[:-1], np.diff(first)), ends, depth
        bits = max(1, int(n).bit_length())
        if 3 * bits <= 63:
            self.order = self._packed(depth, bits)
        else:
            self.order = self._plain(depth)

    def _after(self, rank: np.ndarray, at_: np.ndarray, k: int) -> np.ndarray:
        """Rank of the suffix k words on; 0 behind the document's end."""
        to = at_ + k
        inside = to < self.ends[at_]
        return np.where(inside, rank[np.minimum(to, len(rank) - 1)], 0)

    def _packed(self, depth: int, bits: int) -> np.ndarray:
        n = len(self.words)
        mask = (1 << bits) - 1
        rank, order = self.words.copy(), np.arange(n, dtype=np.int64)
        tied = order
        k = 1
        group = np.zeros(n, dtype=np.int64)  # place in the order at which the tied suffix' group begins
        initial = True
        while len(tied) and k < depth or initial:
            second = self._after(rank, tied, k)
            head = rank[tied]
            keys = np.sort((head << (2 * bits)) | (second << bits) | tied)
            rows, heads = keys & mask, keys >> (2 * bits)
            both = keys >> bits
            place = np.arange(len(keys), dtype=np.int64)
            new_head = np.ones(len(keys), dtype=bool)
            new_head[1:] = both[1:] != both[:-1]
            if initial:
                base = place
            else:
                outer = np.ones(len(keys), dtype=bool)
                outer[1:] = heads[1:] != heads[:-1]
                base = group[rows] + place - np.maximum.accumulate(np.where(outer, place, 0))
            lead = np.maximum.accumulate(np.where(new_head, place, 0))
            starts = base[lead]
            order[base] = rows
            group[rows] = starts
            rank[rows] = starts + 1
            same = np.zeros(len(keys), dtype=bool)
            same[1:] |= ~new_head[1:]
            same[:-1] |= ~new_head[1:]
            tied = np.sort(rows[same])
            k, initial = k * 2, False
        return order

    def _plain(self, depth: int) -> np.ndarray:
        """For a document of so many words that keys cannot be packed."""
        n = len(self.words)
        rank, every, k = self.words.copy(), np.arange(n, dtype=np.int64), 1
        while True:
            second = self._after(rank, every, k)
            order = np.lexsort((second, rank))
            new = np.ones(n, dtype=bool)
            new[1:] = (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1])
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(new)
            k *= 2
            if k >= depth or new.all():
                return order

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Codes of other words; -1 for those that do not occur here."""
        found = pd.Index(self.vocabulary).get_indexer(hashes)
        return np.where(found < 0, -1, found + 1)

    def search(self, test: np.ndarray, at_: np.ndarray, lengths: np.ndarray, upper: bool) -> np.ndarray:
        """For each test suffix at ``at_`` cut to ``lengths`` words: place of the first suffix that is not below it
        (``upper``: of the first that is above it and does not begin with it)."""
        low = np.zeros(len(at_), dtype=np.int64)
        high = np.full(len(at_), len(self.order), dtype=np.int64)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            place = self.order[middle]
            right = np.full(len(open_), upper)
            equal, d = np.arange(len(open_)), 0
            while len(equal):
                equal = equal[lengths[open_[equal]] > d]
                to = place[equal] + d
                inside = to < self.ends[place[equal]]
                have = np.where(inside, self.words[np.minimum(to, len(self.words) - 1)], 0)
                want = test[at_[open_[equal]] + d]
                right[equal[have < want]] = True
                right[equal[have > want]] = False
                equal, d = equal[have == want], d + 1
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
            open_ = open_[low[open_] < high[open_]]
        return low

    def extend(self, test: np.ndarray, at_: np.ndarray, stop: np.ndarray, places: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Longest common length of test suffixes and suffixes here that share ``known`` words already."""
        length = known.copy()
        open_ = np.arange(len(at_))
        while len(open_):
            q, p = at_[open_] + length[open_], places[open_] + length[open_]
            more = (q < stop[open_]) & (p < self.ends[places[open_]])
            open_, q, p = open_[more], q[more], p[more]
            same = test[q] == self.words[p]
            open_ = open_[same]
            length[open_] += 1
        return length


def _packet(rows: list[tuple]) -> dict:
    data, places = at.buffers(pa.array([r[1] for r in rows], pa.string()))
    data = at.LOWER[data]
    starts, ends, first = at.word_places(data, places, at.NOT_ALNUM)
    return {"ids": [r[0] for r in rows], "hashes": at.byte_hashes(data, starts, ends), "first": first}


def _packets(benchmark: DataFrame, item_id: str, text: str, most: int) -> Iterator[dict]:
    """Items in packets of bounded size; the driver holds one packet, and one partition's rows, at a time."""
    rows, size = [], 0
    for row in benchmark.select(benchmark[item_id].cast("string"), benchmark[text]).toLocalIterator():
        if row[1] is None:
            continue
        rows.append((row[0], row[1]))
        size += len(row[1])
        if size >= most:
            yield _packet(rows)
            rows, size = [], 0
    if rows:
        yield _packet(rows)


def _rounds(packets: Iterator[dict], packet_bytes: int, round_bytes: int) -> Iterator[list[dict]]:
    """Packets of one round after the other; the last may be empty."""
    most, held = max(1, round_bytes // packet_bytes), []
    for packet in packets:
        if len(held) == most:
            yield held
            held = []
        held.append(packet)
    yield held


def _covered(matches: list[tuple]) -> int:
    """Words that lie in any of the matches. A match holds nothing but words of windows."""
    total, end = 0, 0
    for _, _, start, length in sorted(matches, key=lambda m: m[2]):
        total += max(0, start + length - max(start, end))
        end = max(end, start + length)
    return total


def _together(row: tuple, before: tuple) -> tuple:
    """A document's row of one round and that of the rounds before."""
    items = sorted({*row[3], *before[3]})
    earlier = [(m["item_id"], m["item_start"], m["doc_start"], m["length"]) for m in before[4]]
    matches = sorted([*row[4], *earlier], key=lambda m: (m[2], m[1], m[0] or ""))
    return row[0], _covered(matches), len(items), items, matches


def _occurrences(array: SuffixArray, packet: dict, window: int) -> tuple[np.ndarray, ...]:
    """Item, start in the item, place, matched words and longest length of every occurrence of a window."""
    test, first = array.codes(packet["hashes"]), packet["first"]
    item = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = np.arange(len(test)) - first[:-1][item]
    need = np.minimum(np.diff(first)[item], window)
    left = first[1:][item] - np.arange(len(test))
    # A suffix with an unknown word in its first words cannot match.
    unknown = np.concatenate([[0], np.cumsum(test < 0)])
    query = np.flatnonzero(left >= need)
    query = query[unknown[query + need[query]] == unknown[query]]
    low = array.search(test, query, need[query], upper=False)
    high = array.search(test, query, need[query], upper=True)
    query, low, n = query[high > low], low[high > low], (high - low)[high > low]
    q = np.repeat(query, n)
    places = array.order[at.ragged(low, n)]
    longest = array.extend(test, q, first[1:][item[q]], places, need[q])
    left_same = (start[q] > 0) & (places > array.begins[places])
    before = np.maximum(places - 1, 0)
    left_same &= test[np.maximum(q - 1, 0)] == array.words[before]
    return item[q], start[q], places, need[q], longest, ~left_same


def _shard(hashes: np.ndarray, first: np.ndarray, packets, window: int) -> list[tuple]:
    """(words, hit words, items, matches) of every document of a shard."""
    n_docs, n_words = len(first) - 1, np.diff(first)
    hit = np.zeros(len(hashes) + 1, dtype=np.int64)
    listed: list[set] = [set() for _ in range(n_docs)]
    matches: list[list] = [[] for _ in range(n_docs)]
    array = None
    doc = np.repeat(np.arange(n_docs), n_words)
    for packet in packets if len(hashes) else ():
        packet = packet.value
        depth = int(np.diff(packet["first"]).max(initial=1))
        if array is None or depth > array.depth:
            array = SuffixArray(hashes, first, depth)
        item, start, place, need, longest, maximal = _occurrences(array, packet, window)
        hit += np.bincount(place, minlength=len(hit)) - np.bincount(place + need, minlength=len(hit))
        ids = packet["ids"]
        for key in np.unique(doc[place] * len(ids) + item):
            name = ids[int(key) % len(ids)]
            if name is not None:
                listed[int(key) // len(ids)].add(name)
        for k in np.flatnonzero(maximal):
            d = int(doc[place[k]])
            matches[d].append((ids[item[k]], int(start[k]), int(place[k] - first[d]), int(longest[k])))
    covered = np.concatenate([[0], np.cumsum(np.cumsum(hit)[:-1] > 0)])
    hits = covered[first[1:]] - covered[first[:-1]]
    return [(int(n_words[d]), int(hits[d]), len(listed[d]), sorted(listed[d]), sorted(matches[d], key=lambda m: (m[2], m[1], m[0] or ""))) for d in range(n_docs)]


def _scan(packets, window: int, column: str, keep: list[str], added: pa.Schema, most: int, further: bool):
    """``further``: the batches have the result columns of the rounds before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []

        def flush():
            hashes = np.concatenate([h for _, h, _ in held])
            ends = np.concatenate([np.diff(f) for _, _, f in held])
            rows = _shard(hashes, np.concatenate([[0], np.cumsum(ends)]), packets, window)
            done = 0
            for batch, _, first in held:
                own = rows[done : done + len(first) - 1]
                done += len(own)
                if further:
                    before = zip(*(batch.column(name).to_pylist() for name in added.names), strict=True)
                    own = [_together(row, b) for row, b in zip(own, before, strict=True)]
                columns = [pa.array([r[i] for r in own], field.type) for i, field in enumerate(added)]
                fields = [batch.schema.field(name) for name in keep] + list(added)
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + columns, schema=pa.schema(fields))
            held.clear()

        size = 0
        for batch in batches:
            data, places = at.buffers(batch.column(column))
            for low, high in at.pieces(places, 4 * most):
                part = at.LOWER[data[places[low] : places[high]]]
                starts, ends, first = at.word_places(part, places[low : high + 1] - places[low], at.NOT_ALNUM)
                if size and size + len(starts) > most:
                    yield from flush()
                    size = 0
                held.append((batch.slice(low, high - low), at.byte_hashes(part, starts, ends), first))
                size += len(starts)
        if held:
            yield from flush()

    return run


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    packet_bytes: int = PACKET_BYTES,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """Documents with ``n_words``, ``n_hit`` (words inside a matched window), ``n_items``, ``items`` (ids, sorted as
    strings) and ``matches`` (longest verbatim matches: item, start in the item, start in the document, words)."""
    spark = documents.sparkSession
    keep, schema = added_to(documents, ADDED)
    found, sent = None, []
    for packets in _rounds(_packets(benchmark, item_id, item_text, packet_bytes), packet_bytes, round_bytes):
        if found is not None:  # what the round before sent goes before this one sends
            found = written(found, "contamination-round")
            for one in sent:
                one.destroy()
        sent = [spark.sparkContext.broadcast(p) for p in packets]
        run = _scan(sent, window, text, keep, to_arrow_schema(ADDED), shard_words, found is not None)
        found = (documents if found is None else found).mapInArrow(run, schema)
    return found


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents without a single word in a benchmark window; their columns are unchanged."""
    aside, back = set_aside(documents, ADDED.names)
    return back(find_contamination(aside, benchmark, **options).filter("n_hit = 0").drop(*ADDED.names))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.selectExpr(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "sha2(array_join(items, ','), 256) as items_sha256",
        "n_hit > 0 as contaminated",
    )


