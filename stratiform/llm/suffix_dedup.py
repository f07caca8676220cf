"""Repeated passages by suffix arrays and longest-previous-factor arrays.

A byte goes when it lies in a string of ``length`` bytes that also starts earlier.  For
one text this is what a longest-previous-factor array tells: in suffix order, the
nearest suffixes above and below that start earlier in the text give the longest match
that starts earlier.

A corpus has no one suffix array, so suffixes are dealt to many.  A string of ``length``
bytes is dealt by one of its short substrings, the one of smallest hash (winnowing);
equal strings pick the same one and meet in one array.  Only suffixes whose substring
occurs twice are looked at.  Every task first builds the array of its own suffixes and
passes on those without an earlier match, so that of a passage with any number of
copies a task sends one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import keyed_texts, partitions_for, slices, small_batches, staged
from stratiform.llm.textbits import Prefix, U, flat, mix, ragged

LENGTH = 100
GRAM = 32  # bytes of the substrings that strings are dealt by

_ANCHOR = np.dtype([("gram", "u8"), ("doc", "i8"), ("low", "i4"), ("high", "i4"), ("at", "i4"), ("again", "u1")])
_RANGE = np.dtype([("low", "i4"), ("high", "i4"), ("at", "i4")])
_SPAN = np.dtype([("low", "i4"), ("high", "i4")])
_FACTOR = np.dtype([("doc", "i8"), ("low", "i4"), ("bytes", "i4"), ("array", "i4")])

# Anchors are sorted and sent in lots of this many.
LOT = 300_000

# Suffixes take some ten numbers each; texts are worked on in slices of this size.
SLICE = 512 * 1024

# A partition's suffixes are dealt to this many arrays, built one after another.
ARRAYS = 16


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of strings that are dealt by the same substring.

    Returns for each run its substring's hash, the text, the first and the last start
    of its strings and the substring's start, all relative to the text.
    """
    none = tuple(np.zeros(0, k) for k in (U, np.int64, np.int64, np.int64, np.int64))
    if len(data) < length:
        return none
    gram = Prefix(data).rolling(GRAM)
    bits = U(max(28, len(data).bit_length()))
    # Position in the low bits: of equal hashes the first one counts.
    least = ((gram >> bits) << bits) | np.arange(len(gram), dtype=U)
    span, width = length - GRAM + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        rest = span - width
        least = np.minimum(least[:-rest], least[rest:])
    pick = (least & ((U(1) << bits) - U(1))).astype(np.int64)
    per_text = np.maximum(0, np.diff(offsets) - length + 1)
    start = ragged(offsets[:-1], per_text)
    if not len(start):
        return none
    text = np.repeat(np.arange(len(per_text)), per_text)
    pick = pick[start]
    new = np.flatnonzero((pick[1:] != pick[:-1]) | (text[1:] != text[:-1])) + 1
    first = np.concatenate([[0], new])
    last = np.append(new, len(start)) - 1
    text = text[first]
    base = offsets[text]
    return gram[pick[first]], text, start[first] - base, start[last] - base, pick[first] - base


def _word(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position on, as numbers in the order of the bytes."""
    word = np.zeros(len(at), U)
    for k in range(8):
        word = (word << U(8)) | data[at + k].astype(U)
    return word


def _differs_at(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many leading bytes two different words share."""
    bits = (x ^ y).view(np.int64)
    out = np.zeros(len(bits), np.int64)
    for k in range(7):
        out += (bits >> (56 - 8 * k)) == 0  # an arithmetic shift: any set bit stays set
    return out


def suffix_order(data: np.ndarray, start: np.ndarray, prints: np.ndarray, position: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``length`` bytes, then of their positions.

    Also returns, for every one but the first, how many bytes it shares with the one
    before it, ``length`` at most.  ``prints`` are hashes of ``length`` bytes; suffixes
    with equal ones are equal that far, so only one of them is sorted by its bytes:
    eight at a time, and only as long as it is tied with a neighbour.
    """
    n = len(start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    by_print = np.argsort(prints)
    new = np.concatenate([[True], prints[by_print][1:] != prints[by_print][:-1]])
    group = np.empty(n, np.int64)
    group[by_print] = np.cumsum(new) - 1
    own = start[by_print[new]]  # one suffix of each group
    m = len(own)
    order = np.argsort(_word(data, own))
    shared = np.zeros(m, np.int64)  # with the one before; counts up while they are tied
    tied = np.ones(m, bool)
    tied[0] = False
    for at in range(0, length, 8):
        # The last step overlaps the one before: it must not read past the suffix.
        at = min(at, length - 8)
        run = np.cumsum(~tied)
        some = np.flatnonzero(tied | np.append(tied[1:], False)) if at else np.arange(m)
        if not len(some):
            break
        word = _word(data, own[order[some]] + at)
        if at:
            inner = np.lexsort((word, run[some]))
            order[some], word = order[some[inner]], word[inner]
        differs = np.zeros(len(some), bool)
        differs[1:] = (word[1:] != word[:-1]) & tied[some[1:]]
        where = np.flatnonzero(differs)
        shared[some[where]] = at + _differs_at(word[where], word[where - 1])
        tied[some[where]] = False
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    place = place[group]
    rank = np.empty(n, np.int64)
    rank[np.argsort(position)] = np.arange(n)
    sort = np.argsort(place * n + rank)
    lcp = np.full(n, length, np.int64)
    first = np.concatenate([[True], place[sort][1:] != place[sort][:-1]])
    lcp[first] = shared
    return sort, lcp


def _nearest_smaller(position: np.ndarray, lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the nearest before it with a smaller position, and what they share.

    Pointers start at the neighbour and jump on by the pointer of where they are, as all
    between have larger positions.  One that shares fewer than ``least`` bytes stops: -1.
    """
    n = len(position)
    at = np.arange(n) - 1
    share = lcp.copy()
    at[share < least] = -1
    live = np.flatnonzero(at >= 0)
    live = live[position[at[live]] > position[live]]
    while len(live):
        near = at[live]
        share[live] = np.minimum(share[live], share[near])
        at[live] = np.where(share[live] < least, -1, at[near])
        live = live[at[live] >= 0]
        live = live[position[at[live]] > position[live]]
    share[at < 0] = 0
    return at, share


def previous_factors(
    data: np.ndarray, start: np.ndarray, prints: np.ndarray, position: np.ndarray, length: int, least: int | None = None
) -> np.ndarray:
    """The longest previous factor of each suffix, ``length`` at most.

    That is the most bytes that it shares with a suffix of smaller position, which is
    the nearest one before or after it in suffix order.  Factors below ``least``
    (``length`` unless given) count as 0 and are not searched for.
    """
    least = length if least is None else least
    out = np.zeros(len(start), np.int64)
    order, lcp = suffix_order(data, start, prints, position, length)
    # Of equal suffixes all but the first have the one before them.
    out[order] = np.where(lcp >= length, length, 0)
    lead = np.flatnonzero(lcp < length)
    if least < length and len(lead):
        own, between = position[order[lead]], lcp[lead].copy()
        between[0] = -1
        _, above = _nearest_smaller(own, between, least)
        turned = np.append(between[1:], -1)[::-1]
        _, below = _nearest_smaller(own[::-1], turned, least)
        out[order[lead]] = np.maximum(above, below[::-1])
    return out


def _covered(data: np.ndarray, prefix: Prefix, start: np.ndarray, position: np.ndarray, length: int) -> np.ndarray:
    return previous_factors(data, start, prefix.of(start, start + length), position, length) >= length


def _runs(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of every run of consecutive values within a group."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero((values[1:] != values[:-1] + 1) | (group[1:] != group[:-1])) + 1
    return np.concatenate([[0], cut]), np.append(cut, len(values)) - 1


def _by_doc(doc: np.ndarray, rows: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows of documents, packed into one value for each partition of documents.

    These partitions are numbered from -1 downwards and pass the matching untouched.
    """
    to = (mix(doc.astype(np.int64).view(U)) % U(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    to, doc, rows = to[order], doc[order].astype(np.int64), rows[order]
    cut = np.flatnonzero(to[1:] != to[:-1]) + 1
    edges = [0, *cut.tolist(), len(to)] if len(to) else [0]
    blobs = [np.int64(b - a).tobytes() + doc[a:b].tobytes() + rows[a:b].tobytes() for a, b in zip(edges, edges[1:])]
    return _rows(-1 - to[edges[:-1]], blobs)


def _rows(part: np.ndarray, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(blobs, pa.binary())], ["part", "blob"])


_ROWS = "part long, blob binary"


def _gather(kind: np.dtype):
    """What ``_by_doc`` packed, as one row for each document."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, rows = [], []
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                n = int(np.frombuffer(blob, np.int64, 1)[0])
                docs.append(np.frombuffer(blob, np.int64, n, 8))
                rows.append(np.frombuffer(blob, kind, n, 8 + 8 * n))
        if not docs:
            return
        doc, row = np.concatenate(docs), np.concatenate(rows)
        order = np.argsort(doc, kind="stable")
        doc, row = doc[order], row[order]
        cut = np.flatnonzero(doc[1:] != doc[:-1]) + 1
        own = doc[np.concatenate([[0], cut])]
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([x.tobytes() for x in np.split(row, cut)], pa.binary())], ["doc_id", "found"])

    return gather


def _send_anchors(parts: int, length: int):
    """Substrings of a task's texts, each once in a lot; ranges of those it has twice."""

    def lot(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        a = np.concatenate(found)
        a = a[np.lexsort((a["low"], a["doc"], a["gram"]))]
        new = np.concatenate([[True], a["gram"][1:] != a["gram"][:-1]])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(a)))
        twice = np.repeat(count > 1, count)
        if twice.any():
            hit = np.empty(int(twice.sum()), _RANGE)
            for c in _RANGE.names:
                hit[c] = a[c][twice]
            yield _by_doc(a["doc"][twice], hit, parts)
        a = a[first]
        a["again"] = count > 1
        part = (mix(a["gram"]) % U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        a, part = a[order], part[order]
        cut = np.flatnonzero(part[1:] != part[:-1]) + 1
        yield _rows(part[np.concatenate([[0], cut])], [x.tobytes() for x in np.split(a, cut)])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for whole in batches:
            for batch in slices(whole, size=SLICE):
                gram, text, low, high, at = anchors(*flat(batch.column("text")), length)
                if len(gram):
                    a = np.zeros(len(gram), _ANCHOR)
                    a["gram"], a["low"], a["high"], a["at"] = gram, low, high, at
                    a["doc"] = batch.column("doc_id").to_numpy()[text]
                    found.append(a)
                if sum(map(len, found)) >= LOT:
                    yield from lot(found)
                    found = []
        if found:
            yield from lot(found)

    return send


def _match_anchors(parts: int):
    """Ranges of substrings that several lots hold."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = []
        for batch in batches:
            own = batch.column("part").to_numpy()
            if (own < 0).any():
                yield batch.filter(pa.array(own < 0))
            blobs += batch.filter(pa.array(own >= 0)).column("blob").to_pylist()
        if not blobs:
            return
        a = np.frombuffer(b"".join(blobs), _ANCHOR)
        order = np.argsort(a["gram"], kind="stable")
        gram = a["gram"][order]
        same = gram[1:] == gram[:-1]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        a = a[order[shared]]
        a = a[a["again"] == 0]
        hit = np.empty(len(a), _RANGE)
        for c in _RANGE.names:
            hit[c] = a[c]
        yield _by_doc(a["doc"], hit, parts)

    return match


def _send_suffixes(parts: int, length: int):
    """Suffixes with an earlier match among those of the slice; the others, to be dealt."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[np.ndarray] = []
        found: list[np.ndarray] = []
        for whole in batches:
            for batch in slices(whole, size=SLICE):
                data, offsets = flat(batch.column("text"))
                ranges = [np.unique(np.frombuffer(x, _RANGE)) for x in batch.column("hits").to_pylist()]
                text = np.repeat(np.arange(len(ranges)), list(map(len, ranges)))
                if not len(text):
                    continue
                r = np.concatenate(ranges)
                doc = batch.column("doc_id").to_numpy()
                n = (r["high"] - r["low"]).astype(np.int64) + 1
                of = np.repeat(np.arange(len(r)), n)
                inner = ragged(r["low"].astype(np.int64), n)
                start = offsets[text[of]] + inner
                rank = np.empty(len(doc), np.int64)
                rank[np.argsort(doc, kind="stable")] = np.arange(len(doc))
                prefix = Prefix(data)
                longest = int(np.diff(offsets).max()) + 1
                covered = _covered(data, prefix, start, rank[text[of]] * longest + inner, length)
                first, last = _runs(inner[covered], of[covered])
                spans = np.empty(len(first), _SPAN)
                spans["low"], spans["high"] = inner[covered][first], inner[covered][last]
                docs.append(doc[text[of[covered][first]]])
                found.append(spans)
                if sum(map(len, found)) >= LOT:
                    yield _by_doc(np.concatenate(docs), np.concatenate(found), parts)
                    docs, found = [], []
                # What is left: stretches of suffixes of one substring, with their bytes.
                of, inner = of[~covered], inner[~covered]
                first, last = _runs(inner, of)
                if not len(first):
                    continue
                own = of[first]
                f = np.empty(len(first), _FACTOR)
                f["doc"], f["low"], f["bytes"] = doc[text[own]], inner[first], inner[last] - inner[first] + length
                gram_at = offsets[text[own]] + r["at"][own]
                cell = mix(prefix.of(gram_at, gram_at + GRAM)) % U(parts * ARRAYS)
                f["array"] = cell // U(parts)
                part = (cell % U(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                f, part = f[order], part[order]
                begin = (offsets[text[own]] + inner[first])[order]
                cut = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
                blobs = []
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    body = data[ragged(begin[a:b], f["bytes"][a:b].astype(np.int64))]
                    blobs.append(np.int64(b - a).tobytes() + f[a:b].tobytes() + body.tobytes())
                yield _rows(part[cut[:-1]], blobs)
        if found:
            yield _by_doc(np.concatenate(docs), np.concatenate(found), parts)

    return send


def _match_suffixes(parts: int, length: int):
    """Suffixes of a partition with an earlier match."""

    def array(f: np.ndarray, data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = f["bytes"].astype(np.int64)
        data = data[ragged(begin, size)]
        n = size - length + 1
        of = np.repeat(np.arange(len(f)), n)
        start = ragged(np.cumsum(size) - size, n)
        inner = start - (np.cumsum(size) - size)[of] + f["low"][of]
        _, rank = np.unique(f["doc"], return_inverse=True)
        covered = _covered(data, Prefix(data), start, rank[of] * (int(inner.max()) + 1) + inner, length)
        of, inner = of[covered], inner[covered]
        first, last = _runs(inner, of)
        spans = np.empty(len(first), _SPAN)
        spans["low"], spans["high"] = inner[first], inner[last]
        return f["doc"][of[first]], spans

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, bodies = [], []
        for batch in batches:
            own = batch.column("part").to_numpy()
            if (own < 0).any():
                yield batch.filter(pa.array(own < 0))
            for blob in batch.filter(pa.array(own >= 0)).column("blob").to_pylist():
                n = int(np.frombuffer(blob, np.int64, 1)[0])
                factors.append(np.frombuffer(blob, _FACTOR, n, 8))
                bodies.append(np.frombuffer(blob, np.uint8, offset=8 + n * _FACTOR.itemsize))
        if not factors:
            return
        f, data = np.concatenate(factors), np.concatenate(bodies)
        del factors, bodies
        begin = np.cumsum(f["bytes"].astype(np.int64)) - f["bytes"]
        of_array = [own for k in range(ARRAYS) if len(own := np.flatnonzero(f["array"] == k))]
        docs, spans = zip(*(array(f[own], data, begin[own]) for own in of_array))
        yield _by_doc(np.concatenate(docs), np.concatenate(spans), parts)

    return match


def _removal(length: int):
    schema = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, size=SLICE):
                data, offsets = flat(batch.column("text"))
                out: list[list] = [[] for _ in schema[1:]]
                for i, found in enumerate(batch.column("spans").to_pylist()):
                    text = data[offsets[i] : offsets[i + 1]]
                    edge = np.zeros(len(text) + 1, np.int64)
                    if found:
                        s = np.frombuffer(found, "i4").reshape(-1, 2).astype(np.int64)
                        np.add.at(edge, s[:, 0], 1)
                        np.add.at(edge, s[:, 1] + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    kept = text[~gone].tobytes()
                    spans = int(np.sum(gone[1:] & ~gone[:-1])) + int(len(gone) and gone[0])
                    for column, value in zip(out, (len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)):
                        column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))], schema)

    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of ``docs``.

    ``kept`` are the bytes of the UTF-8 text that stay, one after another.  Matches may
    overlap, also with themselves, and are judged on the input.  Rows are in order of
    ``doc_id``; those without one come before all others, and rows that repeat one stand
    side by side, by their texts.  A null text counts as empty; texts shorter than
    ``length`` stay.  Other columns are ignored.
    """
    # From here on doc_id is the key of a row, and own_id what its id was.
    texts = keyed_texts(docs).select(F.col("key").alias("doc_id"), F.col("doc_id").alias("own_id"), "text")
    small_batches(docs.sparkSession)
    parts = partitions_for(docs, 8 * 1024 * 1024)
    # Every task gets one part of the matching and one of the documents.
    own = F.pmod("part", F.lit(parts)).cast("int")
    hits = (
        texts.mapInArrow(_send_anchors(parts, length), _ROWS)
        .repartitionById(parts, own)
        .mapInArrow(_match_anchors(parts), _ROWS)
        .repartitionById(parts, own)
        .mapInArrow(_gather(_RANGE), "doc_id long, found binary")
        .withColumnRenamed("found", "hits")
    )
    joined = staged(texts.join(hits, "doc_id", "left"), "texts-with-hits")
    spans = (
        joined.where("hits is not null")
        .mapInArrow(_send_suffixes(parts, length), _ROWS)
        .repartitionById(parts, own)
        .mapInArrow(_match_suffixes(parts, length), _ROWS)
        .repartitionById(parts, own)
        .mapInArrow(_gather(_SPAN), "doc_id long, found binary")
        .withColumnRenamed("found", "spans")
    )
    columns = f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    clean = joined.where("hits is null").select(F.col("own_id").alias("doc_id"), "text", F.lit(None).cast("binary").alias("spans"))
    touched = joined.where("hits is not null").select("doc_id", "own_id", "text").join(spans, "doc_id", "left")
    return touched.select(F.col("own_id").alias("doc_id"), "text", "spans").unionAll(clean).mapInArrow(_removal(length), columns)
