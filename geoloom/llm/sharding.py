"""Sharding by histogram sort: shards of near equal bytes, with one exchange of the documents.

Documents are ordered by the hash of their text, then by a hash of id and text, so equal texts are neighbours. For
every boundary between shards the exact bytes below candidate keys are counted over all partitions (4096 candidates
across the key interval in which the boundary lies), the interval shrinks to the candidate pair around the target,
and so on until a candidate is within ``tolerance`` of a shard's share, or one document is left to cut. So a group
of equal texts is cut only if none of its ends is near enough. What comes to the driver is at most 4096 sums a
boundary and turn.

Places inside a shard are counted in buckets of bounded size, whose sizes are added up first; no shard has to pass
through one task.

Defined results: null and empty texts count one byte; documents without an id and repeated rows are ordinary rows
(repeated ones lie side by side); empty tables give empty results; columns called like a result column are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.common import written

SHARDS = 8
TOLERANCE = 0.005
#: Rows of a bucket, and buckets of a shard at most.
BUCKET_ROWS, MAX_BUCKETS = 4096, 1 << 15

_DIGIT = 12
_BITS = 128
_SIGN = -(1 << 63)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _prefix(length: int) -> tuple[Column, Column]:
    """The first ``length`` bits of the 128-bit key (_k, _t), as two longs."""
    if length == 0:
        return F.lit(0).cast("long"), F.lit(0).cast("long")
    if length <= 64:
        return F.shiftrightunsigned("_k", 64 - length), F.lit(0).cast("long")
    return F.col("_k"), F.shiftrightunsigned("_t", _BITS - length)


def _literals(prefix: int, length: int) -> tuple[int, int]:
    if length <= 64:
        return _signed(prefix), 0
    return _signed(prefix >> (length - 64)), _signed(prefix & ((1 << (length - 64)) - 1))


def _digit(length: int, width: int) -> Column:
    """The ``width`` bits behind the first ``length``; a digit never spans both halves."""
    column, left = ("_k", 64 - length) if length < 64 else ("_t", _BITS - length)
    return F.shiftrightunsigned(column, left - width).bitwiseAND((1 << width) - 1)


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[int]:
    """Keys (of 128 bits) at which shards 1, 2, ... begin. ``keys``: _k, _t, _size."""
    total = keys.agg(F.sum("_size")).first()[0] or 0
    share = total / shards
    found: dict[int, int] = {}
    # Boundary -> first bits of the interval it lies in, and bytes before that interval.
    active = {j: (0, 0) for j in range(1, shards)} if total else {}
    length = 0
    while active:
        width = min(_DIGIT, 64 - length if length < 64 else _BITS - length)
        prefixes = sorted({p for p, _ in active.values()})
        a, b = _prefix(length)
        group = F.lit(None).cast("int")
        for i, p in enumerate(prefixes):
            x, y = _literals(p, length)
            group = F.when((a == x) & (b == y), i).otherwise(group)
        sums = keys.withColumn("_group", group).filter("_group is not null")
        sums = sums.groupBy("_group", _digit(length, width).alias("_digit")).agg(F.sum("_size"), F.count("*"))
        counts: dict[int, list] = {}
        for g, digit, size, n in sorted(sums.collect()):
            counts.setdefault(g, []).append((digit, size, n))
        length += width
        after = {}
        for j, (prefix, below) in active.items():
            target = share * j
            for digit, size, n in counts[prefixes.index(prefix)]:
                key = (prefix << width) | digit
                if below + size >= target or digit == counts[prefixes.index(prefix)][-1][0]:
                    under, over = target - below, below + size - target
                    if min(under, over) <= tolerance * share or n == 1 or length == _BITS:
                        found[j] = (key if under <= over else key + 1) << (_BITS - length)
                    else:
                        after[j] = (key, below)
                    break
                below += size
        active = after
    return [found[j] for j in sorted(found)]


def _keys(text: str, doc_id: str) -> list[Column]:
    return [F.xxhash64(text).alias("_k"), F.xxhash64(F.col(doc_id), F.col(text)).alias("_t")]


def _shard(cuts: list[int]) -> Column:
    """Number of splitters at or below the key."""
    k, t = F.col("_k").bitwiseXOR(_SIGN), F.col("_t").bitwiseXOR(_SIGN)
    terms = []
    for cut in cuts:
        if cut >= 1 << _BITS:
            continue
        high, low = _signed((cut >> 64) ^ (1 << 63)), _signed((cut & ((1 << 64) - 1)) ^ (1 << 63))
        terms.append(((k > high) | ((k == high) & (t >= low))).cast("int"))
    return reduce(lambda x, y: x + y, terms, F.lit(0))


def size_in_bytes(text: str) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_documents(
    documents: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents with ``size`` (bytes and one), ``shard`` and ``slot`` (from 0 without gaps in each shard)."""
    keyed = documents.select("*", *_keys(text, doc_id), size_in_bytes(text).alias("_size"))
    keys = written(keyed.select("_k", "_t", "_size"), "shard-keys")
    shard = _shard(splitters(keys, shards, tolerance))
    per_shard = keys.count() / max(1, shards)
    buckets = int(min(MAX_BUCKETS, max(1, per_shard // BUCKET_ROWS)))
    bucket = F.pmod(F.col("_t"), F.lit(buckets))
    sizes = keys.select(shard.alias("_s"), bucket.alias("_b")).groupBy("_s", "_b").count()
    # One row a shard and bucket, at most shards * MAX_BUCKETS.
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_s", "_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_shard", "_bucket").orderBy("_k", "_t")
    placed = keyed.withColumns({"_shard": shard, "_bucket": bucket}).withColumn("_row", F.row_number().over(inside) - 1)
    joined = placed.join(F.broadcast(offsets), (F.col("_shard") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    own = [documents[c] for c in documents.columns if c.lower() not in ("size", "shard", "slot")]
    added = [F.col("_size").alias("size"), F.col("_shard").alias("shard"), (F.col("_before") + F.col("_row")).alias("slot")]
    return joined.select(*own, *added)
