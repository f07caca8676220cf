"""Hashing of words, lines and byte strings of many texts at once, with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=U) * U(2) + U(1)
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (the splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 2 * len(_powers["up"]))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * kind().itemsize)
    offsets = offsets.astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Prefix:
    """Hashes of any byte ranges from sums over prefixes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, U)
        terms = _BYTE[data]
        terms *= self.up[:n]
        np.cumsum(terms, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = self.sums[end] - self.sums[start]
        h *= self.down[start]
        return mix(h)

    def rolling(self, width: int) -> np.ndarray:
        """Hash of the ``width`` bytes from every position on."""
        h = self.sums[width:] - self.sums[:-width]
        h *= self.down[: len(h)]
        return mix(h)


class Words:
    """Words of all texts of a slice: where they are, their document and their hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, prefix: Prefix | None = None):
        n = len(data)
        word = ~SPACE[data]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        begins[inner] = word[inner]
        ends[inner - 1] = word[inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)  # of each text, and one past the last
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.hash = (prefix or Prefix(data)).of(self.start, self.end)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of words that begin a window of ``width`` words, and its hash."""
        n = len(self.hash) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        h = np.zeros(n, U)
        for k in range(width):
            h *= U(0xD6E8FEB86659FD93)
            h += self.hash[k : n + k]
        at = np.flatnonzero(self.doc[:n] == self.doc[width - 1 :])
        return at, mix(h[at])


def repeated(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries share group and value with another one, and which with an earlier one."""
    both, later = np.zeros(len(value), bool), np.zeros(len(value), bool)
    if len(value) < 2:
        return both, later
    key = mix(value ^ (group.astype(U) * U(0xC2B2AE3D27D4EB4F)))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later[order[1:]] = same
    both[order[1:]] = same
    both[order[:-1]] |= same
    return both, later


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices ``start[0]..start[0]+length[0]-1, start[1]..`` one after another."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(start - (ends - length), length)
