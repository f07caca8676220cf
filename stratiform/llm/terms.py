"""Terms of texts for search and resampling, as UTF-8 bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

# Maximal runs of ASCII digits and letters and of everything beyond ASCII.  On UTF-8
# bytes of lower-cased text this is the same as on its characters.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: bytes | None) -> list[bytes]:
    """Terms of one text, in order, with repeats; only A-Z are lowered, null has none."""
    return TERM.findall(text.lower()) if text else []


def each_text(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of every text of an Arrow column, one at a time."""
    for value in column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary()):
        yield value.as_py()
