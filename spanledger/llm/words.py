"""Words of whole texts, cut from the bytes of Arrow columns.

A word is a run of ASCII digits, letters (A-Z in lower case) and bytes beyond
ASCII, that is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STEP = 4_000_000

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_WORD = (_BYTES >= 128) | ((_LOWER >= 97) & (_LOWER <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57))


def words(text: Column) -> Column:
    """The words as an array column; NULL has none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def runs(texts: pa.Array, limit: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes, or one row."""
    begin, held = 0, 0
    for i, w in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > begin and held + w > limit:
            yield begin, i
            begin, held = i, 0
        held += w
    if len(texts) > begin:
        yield begin, len(texts)


def split(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All words of the texts in their order, and the index at which those of each text begin (one more at the end)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    kept, starts, offsets, at, held = [], [], [], 0, 0
    while at < len(data):
        end = min(at + STEP, len(data))
        while end < len(data) and _IN_WORD[data[end]]:  # on to the end of the word
            outside = np.flatnonzero(~_IN_WORD[data[end : end + STEP]])
            end = end + int(outside[0]) if len(outside) else min(end + STEP, len(data))
        inside = _IN_WORD[data[at:end]]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        first = bounds[np.searchsorted(bounds, at) : np.searchsorted(bounds, end)] - at
        start[first] |= inside[first]
        kept.append(_LOWER[data[at:end][inside]])
        where = np.flatnonzero(start)
        offsets.append(np.cumsum(inside, dtype=np.int64)[where] - 1 + held)
        starts.append(where + at)
        held += len(kept[-1])
        at = end
    flat = np.concatenate([*kept, np.zeros(0, np.uint8)])
    cuts = np.concatenate([*offsets, [len(flat)]]).astype(np.int64)
    found = np.concatenate([*starts, np.zeros(0, np.int64)])
    column = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(flat.tobytes()))
    return column, np.searchsorted(found, bounds)


def hashes(column: pa.LargeStringArray) -> np.ndarray:
    """A 64-bit hash of each word; each distinct word is hashed once."""
    coded = column.dictionary_encode()
    values = coded.dictionary.cast(pa.large_binary()).to_pylist()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in values), np.uint64, len(values))
    return table[coded.indices.to_numpy()]
