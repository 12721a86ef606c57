"""Vectorised words and hashes of Arrow text columns. A word is a maximal run of bytes other than space and 0x09-0x0D."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
#: Bytes that are hashed together.
_BLOCK = 1 << 18
_STEP, _WIDE = np.uint64(0x9E3779B97F4A7C13), np.uint64(0xD6E8FEB86659FD93)
#: Another base for hashes of windows.
WIDE_TOO = np.uint64(0xA24BAED4963EE407)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.full(_BLOCK, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


_POWER, _INVERSE = _powers(int(_STEP)), _powers(pow(int(_STEP), -1, 1 << 64))


def _long_word(data: np.ndarray) -> np.uint64:
    total = 0
    for i in range(0, len(data), _BLOCK):
        part = _BYTE[data[i : i + _BLOCK]]
        part *= _POWER[: len(part)]
        total += int(part.sum(dtype=np.uint64)) * pow(int(_STEP), i, 1 << 64)
    return np.uint64(total % (1 << 64))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the n + 1 offsets of the texts; null is empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    off = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None else np.empty(0, np.uint8)
    return data, off - off[0]


class Words:
    """The words of some texts: ``starts``/``ends`` into ``data``; text i has words ``first[i]`` to ``first[i + 1]``."""

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        data, off = buffer(column)
        self.data = _LOWER[data] if lower else data
        solid = ~_SPACE[data]
        begin, end = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        end[:-1] &= ~solid[1:]
        edge = off[:-1][off[1:] > off[:-1]]  # a word never runs over the edge of a text
        begin[edge] = solid[edge]
        edge = off[1:][off[1:] > off[:-1]] - 1
        end[edge] = solid[edge]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, off)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial of its bytes, from prefix sums over blocks that stay in the cache."""
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(out):
            base = int(self.starts[at])
            stop = int(np.searchsorted(self.ends, base + _BLOCK, "right"))
            if stop == at:  # one word longer than a block
                out[at] = _long_word(self.data[base : self.ends[at]])
                at += 1
                continue
            part = _BYTE[self.data[base : self.ends[stop - 1]]]
            part *= _POWER[: len(part)]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part, out=sums[1:])
            begin = self.starts[at:stop] - base
            out[at:stop] = (sums[self.ends[at:stop] - base] - sums[begin]) * _INVERSE[begin]
            at = stop
        return mix(out ^ (self.ends - self.starts).astype(np.uint64))

    def windows(self, hashes: np.ndarray, k: int, seed: int = 0, base: np.uint64 = _WIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text and first word of all windows of k words that lie in one text. Hashes of other bases are independent."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        out = np.full(n, np.uint64(seed))
        for j in range(k):
            out *= base
            out += hashes[j : j + n]
        text = np.repeat(np.arange(len(self.counts)), self.counts)[:n]
        keep = np.flatnonzero(np.arange(n) + k <= self.first[text + 1])
        return mix(out[keep]), text[keep], keep
