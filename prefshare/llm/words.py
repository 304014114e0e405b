"""Words of a column of texts as byte ranges and 64-bit hashes, without a Python
object for each word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes hashed at once; bounds the temporary arrays.
WINDOW = 1 << 20
_STEP = 0x9E3779B97F4A7C15
_INVERSE = pow(_STEP, -1, 1 << 64)
_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | 1

# ASCII white space: the space and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_STEP, _INVERSE)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _powers[i] = np.multiply.accumulate(row)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Word i is ``data[starts[i]:ends[i]]``; text k has the words
    ``bounds[k]:bounds[k + 1]`` and the bytes ``offsets[k]:offsets[k + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()

    def hashes(self) -> np.ndarray:
        """Polynomial hashes over random byte values, modulo 2**64."""
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(out):
            base = self.starts[at]
            upto = int(np.searchsorted(self.ends, base + WINDOW, "right"))
            upto = max(upto, at + 1)
            piece = self.data[base : self.ends[upto - 1]]
            power, inverse = _tables(len(piece) + 1)
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_VALUES[piece] * power[: len(piece)], out=sums[1:])
            s, e = self.starts[at:upto] - base, self.ends[at:upto] - base
            out[at:upto] = (sums[e] - sums[s]) * inverse[s]
            at = upto
        return out


def words_of(texts: pa.Array, lower: bool = False, tails: bool = False) -> Words:
    """Words between ASCII white space of a large_string column without nulls.

    ``lower`` folds A to Z. ``tails`` makes a full stop or comma that ends a
    word after an ASCII letter a word of its own.
    """
    buffers, n = texts.buffers(), len(texts)
    offsets = np.zeros(1, np.int64)
    if n:
        offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.zeros(0, np.uint8)
    if n and buffers[2] is not None:
        data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    after = border[1:].copy()
    after[:-1] |= space[1:]
    before = border[:-1].copy()
    before[1:] |= space[:-1]
    if tails:
        tail = ((data == 44) | (data == 46)) & after & ~border[:-1]
        tail[1:] &= _LETTER[data[:-1]]
        before |= tail
        after[:-1] |= tail[1:]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets), offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
