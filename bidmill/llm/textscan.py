"""Words and their hashes for a whole Arrow batch of texts at once (numpy).

Bytes 0x20 and 0x09-0x0D separate words; every other byte, including all bytes
of longer UTF-8 sequences, belongs to one. A span's hash is a polynomial over
its bytes taken from prefix sums modulo 2**64, so hashing costs the same for
any window length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 2 ** 64, size=256, dtype=np.uint64)
_POWERS_STEP = 1 << 16   # a worker keeps its powers: no more than its blocks ask for
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASE_BYTES, _BASE_WORDS = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base is odd)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // _POWERS_STEP) * _POWERS_STEP
        both = []
        for b in (base, pow(base, -1, 2 ** 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        have = _POWERS[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Split a string column into runs of whole rows of about ``limit`` bytes:
    (first row, bytes, offsets of rows + 1). A longer text is a run of its own."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, where, data = column.buffers()
    off = np.frombuffer(where, dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(off, off[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, raw[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each row's first word (rows + 1)."""
    inside = ~_IS_SPACE[buf]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = off[:-1] < off[1:]
    first, last = off[:-1][filled], off[1:][filled] - 1
    begin[first], end[last] = inside[first], inside[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, off)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(_BASE_BYTES, len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * power[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def run_hashes(items: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive items, by its first item."""
    n = len(items)
    if n < length:
        return np.empty(0, dtype=np.uint64)
    power, inverse = _powers(_BASE_WORDS, n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(items * power[:-1], out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * inverse[:n - length + 1])


def lowered(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of start, start+1, ... (count values) for each pair."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total, dtype=np.int64) + shift
