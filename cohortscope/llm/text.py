"""Words and hashes of many texts at once, on the bytes of an Arrow column.

Texts are read in blocks of bounded size, so memory follows the block or the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
#: A word is a run of bytes other than the space and \t \n \v \f \r.
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """`n` odd 64-bit numbers that depend on the seed only."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) | np.uint64(1)


_BYTE_VALUES = constants(256, 7)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER_VALUES = _BYTE_VALUES[_LOWER]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    base = np.full(n + 1, _ODD, dtype=np.uint64)
    inverse = np.full(n + 1, pow(_ODD, -1, 1 << 64), dtype=np.uint64)
    base[0] = inverse[0] = 1
    return np.multiply.accumulate(base), np.multiply.accumulate(inverse)


@dataclass
class Block:
    """Consecutive texts of a column: their bytes, and where each text begins and ends in them."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def texts(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.offsets[:-1], self.offsets[1:], strict=True)]

    def prefix_sums(self, lower: bool = False) -> np.ndarray:
        """Sums over all prefixes of the bytes, from which `span_hashes` takes the hash of any span."""
        values = (_LOWER_VALUES if lower else _BYTE_VALUES)[self.data]
        values *= _powers(_size(len(values)))[0][: len(values)]
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values, out=sums[1:])
        return sums


def _size(n: int) -> int:
    """The power of two that holds `n`: few sizes, so that the tables of powers are reused."""
    return 1 << max(18, int(n).bit_length())


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from `starts` to `ends`; equal bytes have equal hashes."""
    inverse = _powers(_size(len(sums)))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts (null: empty) in blocks of about `limit` bytes, one text at least."""
    column = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, len(column))
        yield Block(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of words before it (one entry more)."""
    inside = _IS_WORD[block.data]
    if not len(inside):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(block) + 1, dtype=np.int64)
    before, after = np.zeros(len(inside), dtype=bool), np.zeros(len(inside), dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    bounds = block.offsets
    before[bounds[bounds < len(inside)]] = False
    after[bounds[bounds > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)
