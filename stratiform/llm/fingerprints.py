"""Document fingerprints: one-permutation MinHash, with built-in functions only.

Word shingles are hashed once.  The high part of a hash names one of ``bins`` bins, and
each bin keeps the smallest low part.  An empty bin borrows from others in an order
that only depends on the bin (optimal densification), so two documents with the same
full bins borrow alike.  Of each bin the low ``bits`` bits are stored, packed; agreement
by chance is taken out of the likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import keyed_texts, let, numbered, staged

SHINGLE_WORDS = 5
BINS, BITS = 256, 4
# Borrowing tries this many bins one by one before it ranks all full ones.
TRIES = 6

_EMPTY = (1 << 32) - 1


def words(text: Column) -> Column:
    """Runs of anything but the six ASCII white-space characters; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    # Only the ends can be empty.
    return let(
        parts,
        lambda p: F.slice(
            p,
            F.when(p[0] == "", 2).otherwise(1),
            F.greatest(F.lit(0), F.size(p) - (p[0] == "").cast("int") - ((F.element_at(p, -1) == "") & (F.size(p) > 1)).cast("int")),
        ),
    )


def _hashes(own: Column, width: int) -> Column:
    """A 40-bit hash, bin first, for every shingle; fewer words than one shingle are one."""
    low = F.lit((1 << 40) - 1)
    several = F.transform(
        F.sequence(F.lit(1), F.size(own) - width + 1), lambda i: F.xxhash64(F.slice(own, i, F.lit(width))).bitwiseAND(low)
    )
    none = F.array().cast("array<bigint>")
    return F.when(F.size(own) >= width, several).when(F.size(own) > 0, F.array(F.xxhash64(own).bitwiseAND(low))).otherwise(none)


def _minima(hashes: Column) -> Column:
    """The smallest low part for each bin, ``_EMPTY`` where it has none.

    Every bin also gets a filler that is larger than any low part; after one sort of
    plain numbers the first entry of a bin is its minimum.
    """
    fillers = F.lit([(b << 32) | _EMPTY for b in range(BINS)])
    ordered = F.sort_array(F.concat(hashes, fillers))
    first = lambda o: F.filter(o, lambda x, i: (i == 0) | (F.shiftright(x, 32) != F.shiftright(F.get(o, i - 1), 32)))
    return let(ordered, lambda o: F.transform(first(o), lambda x: x.bitwiseAND(F.lit(_EMPTY))))


def _densified(minima: Column) -> Column:
    """Fill empty bins.  Try ``t`` of bin ``b`` looks at a bin that is a hash of both."""
    probe = lambda b, t: F.pmod(F.xxhash64(b, F.lit(t)), F.lit(BINS)).cast("int")

    def fill(m: Column) -> Column:
        full = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.get(m, b) != _EMPTY)

        def one(x: Column, b: Column, present: Column) -> Column:
            seen = [F.nullif(F.get(m, probe(b, t)), F.lit(_EMPTY)) for t in range(TRIES)]
            nearest = F.array_min(F.transform(present, lambda f: F.struct(F.xxhash64(b, f, F.lit("rank")).alias("rank"), F.get(m, f).alias("value"))))
            return F.when(x != _EMPTY, x).otherwise(F.coalesce(*seen, nearest["value"]))

        return F.when(F.exists(m, lambda x: x == _EMPTY), let(full, lambda p: F.transform(m, lambda x, b: one(x, b, p)))).otherwise(m)

    return let(minima, fill)


def fingerprint(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """The packed low bits of all bins as lower-case hex; null for a text without words.

    Case matters, order of shingles does not.
    """
    def pack(m: Column) -> Column:
        # The bin is hashed in, so that values borrowed by many bins agree by chance in
        # each bin for itself.
        digits = F.transform(m, lambda x, b: F.lower(F.hex(F.xxhash64(x, b).bitwiseAND(F.lit((1 << BITS) - 1)))))
        return F.array_join(digits, "")

    dense = let(words(text), lambda w: F.when(F.size(w) > 0, _densified(_minima(_hashes(w, width)))))
    return let(dense, lambda m: F.when(m.isNotNull(), pack(m)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles: agreement of bins, less what chance gives.

    Two texts without words are alike (1), one without words is unlike any other (0).
    """
    per_part = 8  # hex digits that fit a positive long with room to spare

    def same(total: Column, k: Column) -> Column:
        x, y = (F.conv(F.substring(c, k * per_part + 1, F.lit(per_part)), 16, 10).cast("long") for c in (a, b))

        def count(d: Column) -> Column:
            d = d.bitwiseOR(F.shiftright(d, 1))
            d = d.bitwiseOR(F.shiftright(d, 2)).bitwiseAND(F.lit(0x11111111))
            return total + per_part - F.bit_count(d)

        return let(x.bitwiseXOR(y), count)

    agree = F.aggregate(F.sequence(F.lit(0), F.lit(BINS // per_part - 1)), F.lit(0), same)
    chance = 2.0**-BITS
    share = (agree / F.lit(float(BINS)) - chance) / (1 - chance)
    return (
        F.when(a.isNull() & b.isNull(), F.lit(1.0))
        .when(a.isNull() | b.isNull(), F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))
    )


def neighbours(ids: DataFrame) -> DataFrame:
    """``ids(key, ..)`` with ``next_key``: the next smaller key of each, cyclically.

    Keys are numbered by ranges; the next smaller one has the number before, and the
    smallest is followed by the largest.
    """
    numbers = staged(numbered(ids, [F.col("key")], "nth"), "numbers")
    before = F.when(F.col("nth") > 1, F.col("nth") - 1).otherwise(F.lit(numbers.count()))
    other = numbers.select(F.col("nth").alias("_before"), F.col("key").alias("next_key"))
    return numbers.withColumn("_before", before.cast("long")).join(other, "_before").select(*ids.columns, "next_key")


def with_edits(texts: DataFrame) -> DataFrame:
    """(key, doc_id, text, next_key, edited): each text, and it with its last third replaced.

    The last third of the code points gives way to the first as many of the next text
    (descending ``key``, the smallest one followed by the largest).  Texts are shuffled
    once; only the beginnings travel again.
    """
    ids = staged(texts.select("key", "doc_id", F.length("text").alias("n_chars")), "ids")
    near = staged(neighbours(ids), "neighbours")
    texts = texts.select("key", "text")  # the same columns in both joins, which share one shuffle
    # What a text lends: as many characters as the one before it in the order asks for.
    asked = near.select(F.col("next_key").alias("key"), F.col("key").alias("by"), (F.floor(F.col("n_chars") / 3)).cast("int").alias("chars"))
    lent = texts.join(asked, "key").select(F.col("by").alias("key"), F.substring("text", F.lit(1), F.col("chars")).alias("lent"))
    n = F.length("text")
    keep = (n - F.floor(n / 3)).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), keep), "lent").alias("edited")
    return texts.join(lent, "key").select("key", "text", edited).join(near.select("key", "doc_id", "next_key"), "key")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: fingerprints of its text and of its edited text.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  A null text counts as empty.  Rows without ``doc_id`` come
    last in the descending order; rows that repeat one stand side by side, by their
    texts.  Other columns are ignored.  An only row is its own neighbour.
    """
    done = staged(
        with_edits(keyed_texts(docs)).select(
            "key",
            "doc_id",
            F.length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            fingerprint(F.col("text")).alias("fingerprint"),
            fingerprint(F.col("edited")).alias("edited_fingerprint"),
            "next_key",
        ),
        "fingerprints",
    )
    other = done.select(F.col("key").alias("next_key"), F.col("fingerprint").alias("_next"))
    near = done.join(other, "next_key")
    return near.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )
