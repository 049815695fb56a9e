"""SimHash near-duplicates by pivot distance tables.

A fingerprint's row of the table holds its Hamming distances to reference fingerprints (pivots). By the triangle
inequality two fingerprints that differ in at most ``BITS`` bits differ by at most ``BITS`` in every coordinate.

The pivots are a base and, for each of five bit ranges, versions of the base that differ from it in that range
alone. So the distance to a version, less that to the base, depends on one range only. Of two fingerprints that
differ in two bits at most, three ranges or more are equal, and so are the coordinates that belong to them: the ten
choices of three ranges give ten join keys made of pivot distances, under one of which every linked pair meets. The
rows of a key come sorted by their distance to the base; pairs further apart than ``BITS`` there are never looked
at, the others are discarded by the largest coordinate difference, and what survives is verified bit by bit.

Only distinct fingerprints take part, so copies meet once. Rows of one key agree in 38 bits or more, hence such a
group of distinct fingerprints is bounded. From a group a spanning forest of its links leaves the task, not all pairs.

Defined results: a text with fewer words than a shingle is one shingle; null and empty texts have fingerprint zero and
are linked like any other; rows of one id are one document; a document without an id is not linked and has a null
component; empty tables give empty results; columns called like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm import arrowtext as at
from geoloom.llm.common import added_to, written
from geoloom.llm.components import one_of_each, roots

BITS = 2
SHINGLE = 3
SEED = 42
SLICE_BYTES = 2 << 20

_WIDTHS = (13, 13, 13, 13, 12)
_VERSIONS = 16


class Pivots:
    """A base and its versions by bit range (of ``widths`` bits), and the keys of all choices but ``bits`` ranges."""

    def __init__(self, widths: tuple[int, ...], bits: int):
        self.base = at.mix(np.array([1], dtype=np.uint64))[0]
        versions, low = [], 0
        for g, width in enumerate(widths):
            pattern = at.mix(np.arange(_VERSIONS, dtype=np.uint64) + np.uint64(1000 * (g + 1)))
            pattern = (pattern & np.uint64((1 << width) - 1) | np.uint64(1)) << np.uint64(low)
            versions.append(self.base ^ pattern)
            low += width
        self.versions = np.array(versions)
        self.choices = np.array(list(combinations(range(len(widths)), len(widths) - bits)))

    def distances(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the table: distance to the base, and to each range's versions."""
        to_base = np.bitwise_count(prints ^ self.base).astype(np.int8)
        return to_base, np.bitwise_count(prints[:, None, None] ^ self.versions[None]).astype(np.int8)

    def keys(self, prints: np.ndarray) -> Iterator[np.ndarray]:
        """Keys of the fingerprints, for one choice of ranges after the other."""
        to_base, table = self.distances(prints)
        relative = (table - to_base[:, None, None]).astype(np.uint8)
        words = np.ascontiguousarray(relative).reshape(len(prints), len(self.versions), -1).view(np.uint64)
        ranges = at.pair(words[:, :, 0], words[:, :, 1])
        for c, choice in enumerate(self.choices):
            key = np.full(len(prints), c, dtype=np.uint64)
            for g in choice:
                key = at.pair(key, ranges[:, g])
            yield key


PIVOTS = Pivots(_WIDTHS, BITS)


def shingle_hashes(data: np.ndarray, places: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, and how many each text has."""
    data = at.LOWER[data]
    starts, ends, first = at.word_places(data, places, at.WHITE_SPACE)
    # Words with one space behind each, so that a shingle is one range of bytes.
    length = ends - starts
    to = np.cumsum(length + 1) - (length + 1)
    out = np.full(int(length.sum()) + len(length), ord(" "), dtype=np.uint8)
    out[at.ragged(to, length)] = data[at.ragged(starts, length)]
    n = np.diff(first)
    size = np.minimum(n, shingle)
    counts = np.where(n > 0, n - size + 1, 0)
    begin = at.ragged(first[:-1], counts)
    last = begin + np.repeat(size, counts) - 1
    view, digest = memoryview(out.tobytes()), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(view[a:b], SEED) for a, b in zip(to[begin].tolist(), (to + length)[last].tolist(), strict=True)),
        np.uint64,
        len(begin),
    )
    return hashes, counts


def fingerprints(data: np.ndarray, places: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """One fingerprint a text."""
    return majorities(*shingle_hashes(data, places, shingle))


def majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint of each text's hashes: the bits that over half of them have."""
    result = np.zeros(len(counts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, (np.cumsum(counts) - counts)[some], axis=0, dtype=np.int64)
        result[some] = np.packbits(2 * ones > counts[some][:, None], axis=1).view(">u8").ravel()
    return result


def _fingerprint_batches(column: int, keep: list[int], shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = at.buffers(batch.column(column))
            for low, high in at.pieces(places, SLICE_BYTES):
                prints = fingerprints(data[places[low] : places[high]], places[low : high + 1] - places[low], shingle)
                rows = batch.slice(low, high - low)
                fields = [*(rows.schema.field(i) for i in keep), pa.field("_print", pa.int64())]
                columns = [*(rows.column(i) for i in keep), pa.array(prints.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return run


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ten rows (key, fingerprint, document) for each fingerprint."""
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for key in PIVOTS.keys(prints):
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0), batch.column(1)], names=["key", "print", "doc_id"])


def close_pairs(key: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of one key that differ in at most ``BITS`` bits."""
    to_base, table = PIVOTS.distances(prints)
    order = np.lexsort((to_base, key))
    key, prints, to_base, table = key[order], prints[order], to_base[order], table[order].reshape(len(order), -1)
    alive, step, left, right = np.arange(len(key)), 1, [], []
    while True:
        alive = alive[alive + step < len(key)]
        other = alive + step
        # Sorted by both: a row that fails here fails with all later ones.
        alive = alive[(key[other] == key[alive]) & (to_base[other] - to_base[alive] <= BITS)]
        if not len(alive):
            break
        for low in range(0, len(alive), 1 << 16):
            a = alive[low : low + (1 << 16)]
            b = a + step
            near = np.abs(table[a] - table[b]).max(axis=1) <= BITS
            a, b = a[near], b[near]
            same = np.bitwise_count(prints[a] ^ prints[b]) <= BITS
            left.append(order[a[same]])
            right.append(order[b[same]])
        step += 1
    return np.concatenate(left or [order[:0]]), np.concatenate(right or [order[:0]])


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Numbers of links that connect what all of them connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    return kept


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the rows of a task, which come sorted by key."""

    def found(held: list[np.ndarray]) -> pa.RecordBatch:
        key, prints, docs = (np.concatenate(x) for x in zip(*held, strict=True))
        a, b = close_pairs(key, prints.view(np.uint64))
        a, b = docs[a], docs[b]
        kept = _forest(a, b)
        return pa.RecordBatch.from_arrays([pa.array(a[kept], pa.int64()), pa.array(b[kept], pa.int64())], names=["a", "b"])

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = tuple(batch.column(i).to_numpy() for i in range(3))
        cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last key may go on in the next batch
        if cut:
            held.append(tuple(x[:cut] for x in rows))
            yield found(held)
            held = []
        held.append(tuple(x[cut:] for x in rows))
    if held:
        yield found(held)


def _with_prints(documents: DataFrame, text: str, keep: list[str], shingle: int) -> DataFrame:
    positions = [documents.columns.index(c) for c in keep]
    schema = T.StructType([*(documents.schema[i] for i in positions), T.StructField("_print", T.LongType())])
    return documents.mapInArrow(_fingerprint_batches(documents.columns.index(text), positions, shingle), schema)


def component_table(prints: DataFrame) -> DataFrame:
    """(_print, component_id) of every fingerprint; ``prints``: doc_id, _print."""
    distinct = prints.filter("doc_id is not null").groupBy("_print").agg(F.min("doc_id").alias("doc_id"))
    distinct = written(distinct, "prints")
    keyed = distinct.select("_print", "doc_id").mapInArrow(_keyed, "key long, print long, doc_id long")
    links = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_links, "a long, b long")
    linked = roots(links)
    found = distinct.join(linked, distinct["doc_id"] == linked["node"], "left")
    return found.select("_print", F.coalesce("root", "doc_id").alias("component_id"))


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, carry: list[str] | None = None
) -> DataFrame:
    """Documents with ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id of their group.

    ``carry``: the columns of the result besides these (all, if not given); the text is read once in any case.
    """
    added = T.StructType([T.StructField("fingerprint", T.StringType()), T.StructField("component_id", T.LongType())])
    keep = [c for c in added_to(documents, added)[0] if carry is None or c in carry]
    prints = written(_with_prints(documents.withColumn("_id", F.col(doc_id).cast("long")), text, [*keep, "_id"], shingle), "fingerprints")
    table = component_table(prints.select(F.col("_id").alias("doc_id"), "_print"))
    found = prints.join(table.withColumnRenamed("_print", "_p"), F.col("_print") == F.col("_p"), "left")
    component = F.when(F.col("_id").isNotNull(), F.col("component_id"))
    return found.select(*keep, F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"), component.alias("component_id"))


def drop_near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near-duplicates, of those with an id; the columns are unchanged.

    Groups are of fingerprints, not of ids: the row with the smallest (id, hash of the text) stays, and one of equal
    rows. Rows without an id are not linked and all stay.
    """
    own = documents.filter(F.col(doc_id).isNotNull())
    keyed = own.select(F.col(doc_id).cast("long").alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("text"))
    prints = written(_with_prints(keyed, "text", ["_id", "_hash"], shingle), "fingerprints")
    groups = component_table(prints.select(F.col("_print").alias("doc_id"), "_print")).toDF("node", "root")
    return one_of_each(own, prints, groups, doc_id, text).unionAll(documents.filter(F.col(doc_id).isNull()))
