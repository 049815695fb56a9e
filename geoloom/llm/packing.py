"""Cost-balanced packing of documents into training sequences.

The cost of a piece of n tokens is estimated as ``n + quadratic * n * n``: dense layers and attention inside the
piece. Each task packs its own documents in groups of a bounded number of tokens. Whole sequences are cut off
documents that are longer than a sequence; what is left and the shorter documents go, in descending order of
cost, each to the lowest-cost sequence that has room for it. If none has, the piece is cut: the lowest-cost
sequences with any room are filled. A group opens no more sequences than its tokens need, so that all but one are
full; that one is split into sequences whose lengths are powers of two, which need no padding.

Nothing is shuffled: ids are made where the text is read, and a group's lengths decide. Sequence numbers are unique
(task, group, sequence) and repeat exactly when a task is run again on the same rows.

Defined results: a null or empty text is one piece that holds the end id; documents that repeat are packed each for
itself; a document without an id is packed; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import tokens

CAPACITY = 1024
QUADRATIC = 1 / 4096
#: Tokens of a group: its ids are held until it is packed.
GROUP_TOKENS = 2 << 20

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " sequence_length long, sequence_cost double, ids array<int>"
)


def cost(n: int, quadratic: float) -> float:
    return n + quadratic * n * n


class _Open:
    """Sequences with room, by room; each room's lowest cost at hand."""

    def __init__(self, capacity: int):
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
        self.lowest = np.full(capacity + 1, np.inf)

    def put(self, room: int, price: float, sequence: int) -> None:
        if room:
            heapq.heappush(self.heaps[room], (price, sequence))
            self.lowest[room] = self.heaps[room][0][0]

    def take(self, least: int) -> tuple[int, float, int] | None:
        """Room, cost and number of the lowest-cost sequence with at least that room."""
        if least >= len(self.lowest):
            return None
        room = least + int(np.argmin(self.lowest[least:]))
        if not self.heaps[room]:
            return None
        price, sequence = heapq.heappop(self.heaps[room])
        self.lowest[room] = self.heaps[room][0][0] if self.heaps[room] else np.inf
        return room, price, sequence


def powers(n: int) -> list[int]:
    """Powers of two that add up to n, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def pack(lengths: np.ndarray, capacity: int = CAPACITY, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one group."""
    pieces, sequences, rest = [], 0, []
    for doc, n in enumerate(lengths.tolist()):
        start = 0
        while n - start >= capacity:
            pieces.append((doc, start, capacity, sequences, 0))
            sequences, start = sequences + 1, start + capacity
        if n > start:
            rest.append((n - start, doc, start))
    rest.sort(key=lambda r: (-r[0], r[1]))
    total = sum(r[0] for r in rest)
    full, left = divmod(total, capacity)
    rooms = [capacity] * full + powers(left)
    open_, filled = _Open(capacity), [0] * len(rooms)
    for k, room in enumerate(rooms):
        open_.put(room, 0.0, k)
    for n, doc, start in rest:
        while n:
            room, price, k = open_.take(n) or open_.take(1)
            part = min(n, room)
            pieces.append((doc, start, part, sequences + k, filled[k]))
            filled[k] += part
            open_.put(room - part, price + cost(part, quadratic), k)
            n, start = n - part, start + part
    return pieces


def _rows(ids: list, docs: list[np.ndarray], first: int, capacity: int, quadratic: float) -> tuple[pa.RecordBatch, int]:
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    pieces = pack(lengths, capacity, quadratic)
    n_sequences = 1 + max((p[3] for p in pieces), default=-1)
    size, price = [0] * n_sequences, [0.0] * n_sequences
    for _, _, n, k, _ in pieces:
        size[k] += n
        price[k] += cost(n, quadratic)
    doc, start, n, sequence, offset = (list(x) for x in zip(*pieces, strict=True)) if pieces else ([],) * 5
    parts = [docs[d][s : s + m].astype("<u4") for d, s, m in zip(doc, start, n, strict=True)]
    columns = [
        pa.array([ids[d] for d in doc], pa.int64()),
        pa.array(start, pa.int64()),
        pa.array(n, pa.int64()),
        pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
        pa.array(lengths[doc] if doc else [], pa.int64()),
        pa.array([first + k for k in sequence], pa.int64()),
        pa.array(offset, pa.int64()),
        pa.array([size[k] for k in sequence], pa.int64()),
        pa.array([price[k] for k in sequence], pa.float64()),
        pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(n)]) if n else [0], pa.int32()),
            pa.array(np.concatenate(parts).astype(np.int32) if parts else [], pa.int32()),
        ),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PIECES.split(", ")]), n_sequences


def pack_documents(
    documents: DataFrame,
    vocabulary: str,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    quadratic: float = QUADRATIC,
    group_tokens: int = GROUP_TOKENS,
    with_ids: bool = True,
) -> DataFrame:
    """One row a piece: its document, place in it, ids (unless ``with_ids`` is false), sequence and place in that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        ids, docs, held = [], [], 0

        def flush():
            batch, n = _rows(ids, docs, first, capacity, quadratic)
            step = 5000 if with_ids else max(1, batch.num_rows)
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                yield part if with_ids else part.drop_columns(["ids"])
            ids.clear()
            docs.clear()
            return n

        for batch in batches:
            own = batch.column(0).to_pylist()
            for k, tokens_ in tokens.token_ids(batch.column(1), vocabulary, end_id):
                ids.append(own[k])
                docs.append(tokens_)
                held += len(tokens_)
                if held >= group_tokens:
                    first += yield from flush()
                    held = 0
        if docs:
            yield from flush()

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, PIECES if with_ids else PIECES.removesuffix(", ids array<int>"))
