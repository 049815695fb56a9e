"""Words of whole Arrow text columns as numpy arrays, without a Python object per word.

Texts of a batch lie end to end in one byte buffer; a word is a pair of places in it. No word spans two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64


def _table(stops: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for low, high in stops:
        table[low : high + 1] = False
    return table


# The bytes that end a word, first and last of each range.
WHITE_SPACE = _table([(0x20, 0x20), (0x09, 0x0D)])
NOT_ALNUM = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the n + 1 places where they begin; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    places = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def pieces(places: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of at most ``most`` bytes together; a longer text is alone."""
    low, n = 0, len(places) - 1
    while low < n:
        high = int(np.searchsorted(places, places[low] + most, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def word_places(data: np.ndarray, places: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text (n + 1 entries) the number of its first word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(places), np.int64)
    is_word = inside[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[places] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    np.logical_not(is_word[:-1], out=before[1:])
    starts = np.flatnonzero(is_word & (before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    np.logical_not(is_word[1:], out=after[:-1])
    ends = np.flatnonzero(is_word & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, places)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(a * _U(0x9E3779B97F4A7C15) + (b ^ (b >> _U(29))) * _U(0xD6E8FEB86659FD93) + _U(0x632BE59BD9B4E019))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes at a time; ranges of one length up to eight bytes never clash."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    lengths = ends - starts
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)

    def lane(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return lanes[at] & masks[np.minimum(left, 8)]

    salt = mix(np.array([seed + 1], dtype=np.uint64))[0]
    out = mix(lane(starts, lengths) ^ (lengths.astype(np.uint64) * _U(0xA0761D6478BD642F)) ^ salt)
    rest = np.flatnonzero(lengths > 8)
    k = 8
    while len(rest):
        out[rest] = pair(out[rest], lane(starts[rest] + k, lengths[rest] - k))
        k += 8
        rest = rest[lengths[rest] > k]
    return out


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` consecutive entries (len - length + 1 of them), built from runs of doubling length."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    result, done, power, size = None, 0, words, 1
    left = length
    while left:
        if left & 1:
            part = power[done : done + n]
            result = mix(part.copy()) if result is None else pair(result, part)
            done += size
        left >>= 1
        if left:
            power, size = pair(power[:-size], power[size:]), size * 2
    return result


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places starts[i] .. starts[i] + lengths[i] - 1 of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)


def strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Arrow texts of the given byte ranges, copied out in order."""
    joined = data[ragged(starts, lengths)]
    places = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=places[1:])
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(places), pa.py_buffer(joined)])
