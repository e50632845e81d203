"""Whole batches of texts as flat arrays of bytes and words, for the operators that run numpy inside tasks.

A batch is cut into pieces of a few megabytes, so that memory does not depend on how many
rows Arrow delivers; a piece always holds whole texts. Hashes are polynomial over random
byte values and mixed afterwards; all of them are the same in every task and every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_RANDOM = np.random.RandomState(20240229)
BYTE_VALUE = _RANDOM.randint(1, 2**62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(4) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 5
BASE_INVERSE = pow(BASE, -1, 2**64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words of `[^\x20\x09-\x0D]+`: whatever is not ASCII white space.
SOLID = ~_SPACE
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, lower-case letters and all beyond ASCII.
PLAIN = np.zeros(256, bool)
PLAIN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of an ordered pair of names."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ np.uint64(0xA0761D6478BD642F)) * np.uint64(0xE7037ED1A0B428DB))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls unless a single long text asks for very many."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 2 * PIECE_BYTES:
            _powers[base] = have
    return have[:n]


def pieces(table: pa.RecordBatch, *columns: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes in the columns (text if none is named), one whole row at least."""
    if table.num_rows == 0:
        return
    ends = np.cumsum(sum(sizes(table.column(c)) for c in columns or ("text",)))
    at = 0
    while at < table.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield table.slice(at, to - at)
        at = to


def sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of every text; 0 for null."""
    return np.diff(offsets(texts))


def offsets(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)])


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins (one more entry at the end)."""
    starts = offsets(texts)
    filled = texts.fill_null("") if texts.null_count else texts
    wide = filled.cast(pa.large_binary())
    first = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset] if len(wide) else 0
    data = wide.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[first : first + starts[-1]], starts


class Words:
    """The words of a piece: where each starts and ends in ``bytes``, and the first word of every text."""

    def __init__(self, texts: pa.Array, kind: np.ndarray, lower: bool = False):
        raw, at = flat(texts)
        self.bytes = LOWER[raw] if lower else raw
        self.text_at = at
        n = len(raw)
        inside = np.zeros(n + 1, bool)
        inside[:n] = kind[self.bytes]
        first = np.zeros(n + 1, bool)
        first[at] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | first[1:]
        ends = inside[:-1] & (~inside[1:] | first[1:])
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.at = np.searchsorted(self.starts, at)
        self.counts = np.diff(self.at)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        n = len(self.bytes)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[self.bytes] * powers(BASE, n), out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * powers(BASE_INVERSE, n + 1)[self.starts] + (self.ends - self.starts).astype(np.uint64))

    def text_of(self) -> np.ndarray:
        """The index of the text of every word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Name of the ``size`` words that start at every place; the last ``size - 1`` places have none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n]
    for k in range(1, size):
        out = pair(out, hashes[k : n + k])
    return out
