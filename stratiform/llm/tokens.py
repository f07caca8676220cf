"""Token ids of whole texts, encoding every distinct piece of text once per worker.

A text is cut where its tokenizer starts a new piece in any case; a piece's ids then
don't depend on what is around it.  Pieces repeat far more often than texts, so the
tokenizers library sees each distinct one once and ids are gathered with numpy.
Texts that hold a special token's string are given to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from stratiform.llm.textbits import SPACE, Prefix, U, flat, ragged

# A worker forgets its pieces beyond this many, to bound its memory.
PIECES_KEPT = 1_500_000

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True
# First bytes of characters that are surely no white space.
_SOLID = np.zeros(256, bool)
_SOLID[33:127] = True
_SOLID[0xC3:0xE0] = True


class Encoder:
    """``ids(texts)`` with one tokenizer file; one per Python worker.

    ``joins_space``: a piece takes the space before it, as byte-level tokenizers do.
    Otherwise white space only separates.
    """

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kind = self.tokenizer.pre_tokenizer
        self.joins_space = "ByteLevel" in str(type(kind).__name__)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _forget(self) -> None:
        self.keys = np.zeros(0, U)
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.store = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        ids = [x.ids for x in encoded]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(length.sum())
        if self.used + total > len(self.store):
            self.store = np.concatenate([self.store[: self.used], np.zeros(max(total, self.used) + total, np.uint32)])
        self.store[self.used : self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        begin = self.used + np.cumsum(length) - length
        self.used += total
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, begin)
        self.length = np.insert(self.length, at, length)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        cut[1:n] |= _LETTER[data[:-1]] & _PUNCT[data[1:]]
        if self.joins_space:
            cut[: n - 1] |= (data[:-1] == 32) & _SOLID[data[1:]]
            if n > 2:
                alone = (data[1:-1] == 10) & _SOLID[data[:-2]] & _SOLID[data[2:]]
                cut[1 : n - 1] |= alone
                cut[2:n] |= alone
            start = np.flatnonzero(cut)
            start = start[start < n]
            return start, np.append(start[1:], n)
        space = SPACE[data]
        cut[1:n] |= space[:-1]
        start = np.flatnonzero(cut[:n] & ~space)
        stop = cut.copy()
        stop[:n] |= space
        stops = np.flatnonzero(stop)
        return start, stops[np.searchsorted(stops, start, "right")]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has; null counts as empty."""
        data, offsets = flat(texts)
        n, docs = len(data), len(offsets) - 1
        if not n:
            return np.zeros(0, np.uint32), np.zeros(docs, np.int64)
        raw = data.tobytes()
        if any(s in raw for s in self.specials):
            return self._with_specials(texts)
        start, end = self._pieces(data, offsets)
        keys, where, back = np.unique(Prefix(data).of(start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > PIECES_KEPT:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            new = where[~known]
            self._learn(keys[~known], [raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist())])
            at = np.searchsorted(self.keys, keys)
        length = self.length[at][back]
        ids = self.store[ragged(self.begin[at][back], length)]
        sums = np.concatenate([[0], np.cumsum(length)])
        return ids, np.diff(sums[np.searchsorted(start, offsets)])

    def _with_specials(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """One text at a time; those with a special token's string go to the library whole."""
        ids, counts = [], []
        for i, text in enumerate(texts.to_pylist()):
            if text and any(s in text.encode() for s in self.specials):
                own = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                own, _ = self.ids(texts.slice(i, 1))
            ids.append(own)
            counts.append(len(own))
        return np.concatenate(ids), np.array(counts, np.int64)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every text's ids."""
    return np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32), counts + 1
