"""Words of many texts at once: byte tables, word bounds and 64-bit word hashes in numpy.

Texts are taken as UTF-8 bytes. ``bytes.lower`` lowers A-Z alone, so positions stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes hashed at once; a longer word makes a longer block
CHUNK = 4 << 20  # bytes of texts handled at once; a longer text makes a chunk of its own

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words ``[^\\x20\\x09-\\x0D]+``.
UNSPACED = ~_BLANK
#: Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``: digits, letters a-z and all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, BLOCK + 4096)
        ups = np.full(n, _BASE, np.uint64)
        downs = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        ups[0] = downs[0] = 1
        _powers[:] = [np.multiply.accumulate(ups), np.multiply.accumulate(downs)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective scrambling of 64-bit values, one such map for each seed."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold about ``most`` bytes together."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def word_bounds(block: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes."""
    inside = np.zeros(len(block) + 2, np.int8)
    inside[1:-1] = table[block]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hash_words(data: bytes, table: np.ndarray = UNSPACED) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of ``data``; blocks end between words, so memory is bounded."""
    starts, hashes, at = [], [], 0
    gap = re.compile(b"[" + b"".join(re.escape(bytes([i])) for i in range(256) if not table[i]) + b"]")
    while at < len(data):
        end = at + BLOCK
        if end < len(data):
            found = gap.search(data, end)
            end = found.start() if found else len(data)
        block = np.frombuffer(data, np.uint8, min(end, len(data)) - at, at)
        first, last = word_bounds(block, table)
        up, down = _powers_to(len(block))
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up[: len(block)], out=sums[1:])
        starts.append(first + at)
        hashes.append(mix((sums[last] - sums[first]) * down[first], 1))
        at = end
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def hash_texts(texts: list[bytes], table: np.ndarray = UNSPACED) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of lower-cased texts in one array, and the bounds of each text in it."""
    data = b"\n".join(texts).lower()
    starts, hashes = hash_words(data, table)
    ends = np.cumsum([len(x) + 1 for x in texts]) if texts else np.empty(0, np.int64)
    return hashes, np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64)


def text_hash(text: bytes, table: np.ndarray = UNSPACED) -> int:
    """Hash of one word."""
    return int(hash_words(text.lower(), table)[1][0])
