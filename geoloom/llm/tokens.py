"""Token ids of whole text columns by the ``tokenizers`` library, each distinct piece of text encoded once.

Byte-pair merges never cross the places where the pre-tokenizer splits. A text is cut at places where both known
pre-tokenizers always split, whatever stands further left or right: before white space that follows a printable
character, and between a letter and punctuation (but not at an apostrophe, which may begin a contraction). Equal
pieces get equal ids, so a piece is looked up in a bounded cache and encoded on a miss. Any other pre-tokenizer
gets whole texts.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from geoloom.llm import arrowtext as at

# The splitting patterns for which the cuts below are safe.
_KNOWN_PATTERNS = {
    "byte level": "ByteLevel with its own regular expression",
    "words": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
_PUNCTUATION = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'

#: Entries of the cache of one Python worker; it is emptied when full.
CACHE_ENTRIES = 400_000
#: Bytes of text that are cut and encoded together.
SLICE_BYTES = 3 << 20

_SPACE = ~at.WHITE_SPACE
_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
_PRINT = np.zeros(256, dtype=bool)
_PRINT[0x21:0x7F] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(_PUNCTUATION)] = True
# Second bytes of the Latin-1 letters, all but the multiplication and division signs.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False

_LETTERS_ONLY = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\Z")
_MARKS_ONLY = re.compile(rb" ?[!-&(-/:-@\[-`{-~]+\Z")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for letters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Encoder:
    """Ids of texts as one flat array; made once a worker and vocabulary by :func:`encoder`."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        steps = split.get("pretokenizers", [split])
        patterns = [(s.get("pattern") or {}).get("Regex") for s in steps]
        self.words = steps[0].get("type") == "Split" and patterns[0] == _KNOWN_PATTERNS["words"] and steps[0].get("invert")
        byte_level = len(steps) == 1 and split.get("type") == "ByteLevel" and split.get("use_regex")
        self.cut = bool(self.words or byte_level and not split.get("add_prefix_space") and not spec.get("normalizer"))
        self.size = self.tokenizer.get_vocab_size()
        self.letters = _byte_letters()
        self.cache: dict[bytes, bytes] = {}

    def _encode(self, piece: bytes) -> bytes:
        if _LETTERS_ONLY.match(piece) or _MARKS_ONLY.match(piece):
            # One pre-token: normalised and spelled as the pre-tokenizer would, it goes straight to the merges.
            if self.words:
                piece = piece.lstrip(b" ").decode().lower().encode()
            ids = [t.id for t in self.tokenizer.model.tokenize(piece.decode("latin-1").translate(self.letters))]
        else:
            ids = self.tokenizer.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _starts(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """First bytes of the pieces; every text begins one."""
        at_ = np.zeros(len(data), dtype=bool)
        if self.cut:
            space = _SPACE[data]
            latin = np.zeros(len(data), dtype=bool)
            latin[1:] = _LATIN[data[1:]] & (data[:-1] == 0xC3)
            at_[1:] = space[1:] & (_PRINT[data[:-1]] | latin[:-1])
            if b"<|" not in data.tobytes():  # a special token's text must stay in one piece
                at_[1:] |= _MARK[data[1:]] & (_LETTER[data[:-1]] | latin[:-1])
        starts = places[:-1]
        at_[starts[starts < len(data)]] = True
        return np.flatnonzero(at_)

    def encode(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the n + 1 places where a text's ids begin."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(places), np.int64)
        starts = self._starts(data, places)
        bounds = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        cache, found = self.cache, []
        for piece in pieces.dictionary.to_pylist():
            ids = cache.get(piece)
            if ids is None:
                ids = self._encode(piece)
                if len(piece) <= 64:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[piece] = ids
            found.append(ids)
        sizes = np.fromiter((len(x) >> 2 for x in found), np.int64, len(found))
        flat = np.frombuffer(b"".join(found), "<u4")
        first = np.cumsum(sizes) - sizes
        codes = pieces.indices.to_numpy()
        ids = flat[at.ragged(first[codes], sizes[codes])]
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        return ids, ends[np.searchsorted(starts, places)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_ids(column: pa.Array, path: str, end_id: int):
    """(number of the text in the column, its ids with ``end_id`` behind them), text by text."""
    data, places = at.buffers(column)
    own = encoder(path)
    for low, high in at.pieces(places, SLICE_BYTES):
        part, begin = data[places[low] : places[high]], places[low : high + 1] - places[low]
        ids, first = own.encode(part, begin)
        for k in range(high - low):
            yield low + k, np.append(ids[first[k] : first[k + 1]], np.uint32(end_id))
