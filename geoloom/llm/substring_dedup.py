"""Substring de-duplication: words inside a window that an earlier document has too are removed.

1. Sketch. Every window is counted under its anchor, the smallest hash among its ``GRAM``-word runs, once a document.
   Equal windows have equal anchors, so an anchor's count is never below a window's. Each task counts its anchors into
   a count-min sketch; the partial sketches are shuffled by block of cells and added up, saturating at two. Of the
   merged sketch only one bit a cell travels on (two or more, or not), at most ``MAX_CELLS / 8`` bytes a row.
2. Windows whose estimate is one are in one document only and are left out. The others are grouped exactly, by 96
   bits of hash of their words. Of the documents with a window in one slice of a task, only the smallest has to be
   compared with the rest of the table; in all others the window goes already. So a window that a third of all
   documents share sends one row a slice into the shuffle.
3. The words covered by a window with a smaller document are removed. Documents that lose nothing, told apart by a
   bitmap of bounded size, are not shuffled.

The sketch only saves work: were it full, all windows would be grouped, and the result would be the same.

Defined results: null and empty texts have no words; texts of fewer words than a window keep all; a document without
an id neither removes nor loses words; rows of equal id are one document, so they never remove each other's words;
empty tables give empty results; columns called like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from geoloom.llm import arrowtext as at
from geoloom.llm.bitmaps import Bitmap
from geoloom.llm.common import added_to, written

WINDOW = 50
GRAM = 20
DEPTH = 4
#: Cells of a row of the sketch: a power of two that follows the number of anchors between these bounds.
MIN_CELLS, MAX_CELLS = 1 << 16, 1 << 26
BLOCK = 1 << 16
#: Text bytes handled together, and a text's average bytes per anchor, from which the width is set.
SLICE_BYTES, BYTES_PER_ANCHOR = 4 << 20, 64

ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()),
    ]
)


def _anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """Smallest of each ``span`` consecutive hashes."""
    low, size = grams, 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    extra = span - size
    return np.minimum(low[: len(low) - extra], low[extra:]) if extra else low


class _Windows:
    """Windows of the texts of a slice."""

    def __init__(self, data: np.ndarray, places: np.ndarray, window: int):
        gram = min(GRAM, window)
        self.starts, self.ends, self.first = at.word_places(data, places, at.WHITE_SPACE)
        self.words = at.byte_hashes(data, self.starts, self.ends)
        n = np.diff(self.first)
        self.counts = np.maximum(n - window + 1, 0)
        # Windows that lie in one text; they are numbered by their first word.
        self.at = at.ragged(self.first[:-1], self.counts)
        self.doc = np.repeat(np.arange(len(n)), self.counts)
        grams = at.run_hashes(self.words, gram)
        least = _anchors(grams, window - gram + 1) if len(grams) >= window - gram + 1 else grams[:0]
        self.anchor = least[self.at]

    def hashes(self, window: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the words of each given window."""
        a = at.run_hashes(self.words, window)[which]
        b = at.run_hashes(at.mix(self.words ^ np.uint64(0x5851F42D4C957F2D)), window)[which]
        return a, b


def _slices(batch: pa.RecordBatch, column: int, window: int) -> Iterator[tuple[int, int, _Windows]]:
    data, places = at.buffers(batch.column(column))
    for low, high in at.pieces(places, SLICE_BYTES):
        yield low, high, _Windows(data[places[low] : places[high]], places[low : high + 1] - places[low], window)


def _cells(anchor: np.ndarray, row: int, width: int) -> np.ndarray:
    return (at.mix(anchor ^ np.uint64(row * 0x9E3779B9 + 1)) & np.uint64(width - 1)).astype(np.int64)


def _partial_sketches(width: int, window: int):
    block = min(BLOCK, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has_id = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for low, _, own in _slices(batch, 1, window):
                # One count a document and anchor: neighbours share theirs, so runs go first.
                turn = np.ones(len(own.anchor), dtype=bool)
                turn[1:] = (own.anchor[1:] != own.anchor[:-1]) | (own.doc[1:] != own.doc[:-1])
                turn &= has_id[low + own.doc]
                if not turn.any():
                    continue
                anchor, doc = own.anchor[turn], own.doc[turn]
                order = np.lexsort((anchor, doc))
                anchor, doc = anchor[order], doc[order]
                anchor = anchor[np.append(True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))]
                slots, lists = [], []
                for row in range(DEPTH):
                    cells = np.sort(_cells(anchor, row, width))
                    cuts = np.searchsorted(cells, np.arange(0, width + 1, block))
                    for k in np.flatnonzero(np.diff(cuts)):
                        slots.append(row * (width // block) + int(k))
                        lists.append((cells[cuts[k] : cuts[k + 1]] - int(k) * block).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(lists, pa.binary())], names=["slot", "cells"])

    return run


def _merge(block: int):
    """Adds up the partial sketches of the blocks of a task; a cell stays at two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                count = sums.setdefault(slot, np.zeros(block, np.uint8))
                own = np.bincount(np.frombuffer(cells, "<u2"), minlength=block)
                np.minimum(own + count, 2, out=own)
                count[:] = own
        if sums:
            bits = [np.packbits(sums[s] >= 2).tobytes() for s in sums]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], names=["slot", "bits"])

    return run


def _repeated(bits: np.ndarray, width: int, anchor: np.ndarray) -> np.ndarray:
    """Which anchors are estimated to be in two documents or more."""
    found = np.ones(len(anchor), dtype=bool)
    for row in range(DEPTH):
        cell = _cells(anchor, row, width) + row * width
        found &= (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return found


FOUND = "w1 long, w2 int, doc_id long, mark int, place int, n int, late boolean"
_FOUND_NAMES = [c.split()[0] for c in FOUND.split(", ")]


def _group(a: np.ndarray, b: np.ndarray, ids: np.ndarray, mark: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Columns of ``FOUND`` of a slice's windows: equal windows that follow one another in a text are one row of
    ``n``; ``late`` if a smaller document of the slice has the window."""
    order = np.lexsort((place, mark, ids, b, a))
    a, b, ids, mark, place = a[order], b[order], ids[order], mark[order], place[order]
    window = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    run = np.append(True, window[1:] | (ids[1:] != ids[:-1]) | (mark[1:] != mark[:-1]) | (place[1:] != place[:-1] + 1))
    smallest = ids[np.maximum.accumulate(np.where(window, np.arange(len(a)), 0))]
    rows = np.flatnonzero(run)
    late = (ids > smallest)[rows]
    a = a[rows].copy()
    # Rows that are settled need no partner: they are spread evenly.
    a[late] = at.pair(a[late], at.pair(ids[rows][late].view(np.uint64), place[rows][late].astype(np.uint64)))
    return [a.view(np.int64), b[rows], ids[rows], mark[rows], place[rows], np.diff(np.append(rows, len(order))).astype(np.int32), late]


def _candidates(bits, width: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = bits.value
        for batch in batches:
            ids = batch.column(0)
            has_id = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            mark = batch.column(2).to_numpy()
            for low, _, own in _slices(batch, 1, window):
                which = np.flatnonzero(_repeated(sketch, width, own.anchor) & has_id[low + own.doc])
                if not len(which):
                    continue
                a, b = own.hashes(window, own.at[which])
                doc = own.doc[which]
                place = (own.at[which] - own.first[doc]).astype(np.int32)
                columns = _group(a, (b >> np.uint64(32)).astype(np.uint32).view(np.int32), ids[low + doc], mark[low + doc], place)
                for k in range(0, len(columns[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 100_000]) for c in columns], names=_FOUND_NAMES)

    return run


def _cut(column: int, keep: list[int], added: pa.Schema, window: int, fields: pa.Schema):
    """Removes the words covered by the runs of windows (first place, number) listed in the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = at.buffers(batch.column(column))
            lists = batch.column(batch.num_columns - 1)
            for low, high in at.pieces(places, SLICE_BYTES):
                part = data[places[low] : places[high]]
                starts, ends, first = at.word_places(part, places[low : high + 1] - places[low], at.WHITE_SPACE)
                change = np.zeros(len(starts) + 1, dtype=np.int64)
                for k in range(low, high):
                    if lists[k].is_valid:
                        runs = lists[k].values
                        at_ = runs.field(0).to_numpy().astype(np.int64) + first[k - low]
                        np.add.at(change, at_, 1)
                        np.add.at(change, at_ + runs.field(1).to_numpy() - 1 + window, -1)
                stay = np.cumsum(change)[:-1] == 0
                n = np.diff(first)
                kept = np.concatenate([[0], np.cumsum(stay)])
                n_kept = kept[first[1:]] - kept[first[:-1]]
                # Kept words with one space behind each; the last space of a text goes.
                s, length = starts[stay], (ends - starts)[stay]
                out = np.full(int(length.sum()) + len(s), ord(" "), dtype=np.uint8)
                to = np.cumsum(length + 1) - (length + 1)
                out[at.ragged(to, length)] = part[at.ragged(s, length)]
                stops = np.concatenate([[0], np.cumsum(length + 1)])[np.concatenate([[0], np.cumsum(n_kept)])]
                texts = [out[a : max(a, b - 1)].tobytes() for a, b in zip(stops[:-1], stops[1:], strict=True)]
                columns = [pa.array(n, pa.int64()), pa.array(n - n_kept, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([rows.column(i) for i in keep] + columns, schema=pa.schema([*(fields.field(i) for i in keep), *added]))

    return run


def sketch_width(documents: DataFrame, text: str) -> int:
    size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    cells = MIN_CELLS
    while cells < MAX_CELLS and cells < 2 * size // BYTES_PER_ANCHOR:
        cells *= 2
    return cells


def remove_repeated_windows(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Documents with ``n_words``, ``n_removed`` and ``kept_text``."""
    spark = documents.sparkSession
    width = sketch_width(documents, text)
    block = min(BLOCK, width)
    mark = F.hash(text)  # tells rows of one id with other texts apart
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), mark.alias("mark"))
    partial = rows.select("doc_id", "text").mapInArrow(_partial_sketches(width, window), "slot int, cells binary")
    merged = partial.repartition("slot").mapInArrow(_merge(block), "slot int, bits binary")
    bits = np.zeros(DEPTH * width // 8, dtype=np.uint8)
    for slot, own in merged.collect():  # DEPTH * MAX_CELLS bits at most
        bits[slot * block // 8 : (slot + 1) * block // 8] = np.frombuffer(own, np.uint8)
    sent = spark.sparkContext.broadcast(bits)
    found = rows.mapInArrow(_candidates(sent, width, window), FOUND)
    smallest = F.min("doc_id").over(Window.partitionBy("w1", "w2"))
    late = found.withColumn("_smallest", smallest).filter("late or doc_id > _smallest")
    late = late.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("place", "n")).alias("_runs"))
    late = written(late.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"}), "late-windows")

    losing = Bitmap(late.select(F.xxhash64("_id", "_mark").alias("_key")), "_key", late.count())
    keyed = documents.select("*", F.col(doc_id).cast("long").alias("_doc"), mark.alias("_own"))
    keyed = losing.marked(keyed.withColumn("_key", F.xxhash64("_doc", "_own")), "_key", "_hit")
    columns = [*documents.columns, "_runs"]
    joined = keyed.filter("_hit").join(late, (F.col("_doc") == F.col("_id")) & (F.col("_own") == F.col("_mark")), "left")
    none = F.lit(None).cast(late.schema["_runs"].dataType)
    every = joined.select(*columns).unionAll(keyed.filter("not _hit").withColumn("_runs", none).select(*columns))
    keep, schema = added_to(documents, ADDED)
    positions = [documents.columns.index(c) for c in keep]
    run = _cut(documents.columns.index(text), positions, to_arrow_schema(ADDED), window, to_arrow_schema(documents.schema))
    return every.mapInArrow(run, schema)
