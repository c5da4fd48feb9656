"""Words between ASCII white space, ``[^\\x20\\x09-\\x0D]+``, cut from the bytes of Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTES = np.arange(256)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))

# Classes of bytes and the pairs of neighbours to cut between: white space from all else, and for ``CLASSES`` also
# letters, digits and marks of ASCII from each other, but never an apostrophe from the letter after it or a mark beside it.
_OTHER, _LETTER, _DIGIT, _MARK, _APOSTROPHE, _WHITE = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[39] = _APOSTROPHE
_CLASS[_SPACE] = _WHITE
WORDS = np.array([[a == _WHITE or b == _WHITE for b in range(6)] for a in range(6)])
_TIED = {(_APOSTROPHE, _LETTER), (_APOSTROPHE, _MARK), (_MARK, _APOSTROPHE)}
CLASSES = WORDS | np.array([[a != b and _OTHER not in (a, b) and (a, b) not in _TIED for b in range(6)] for a in range(6)])


def split(texts: pa.Array, cuts: np.ndarray = WORDS) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All words of the texts in their order, and the index at which those of each text begin (one more at the end).

    With ``CLASSES`` words are cut further: between an ASCII letter, digit or mark and one of another of these classes.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    kinds = _CLASS[data]
    inside = kinds != _WHITE
    edge = np.ones(len(data) + 1, bool)  # before a byte, and at the end
    edge[1:-1] = cuts.ravel()[kinds[:-1] * 6 + kinds[1:]]
    edge[bounds] = True
    starts = np.flatnonzero(inside & edge[:-1])
    ends = np.flatnonzero(inside & edge[1:]) + 1
    offsets = np.concatenate([[0], (ends - starts).cumsum()]).astype(np.int64)
    flat = data[inside].tobytes()
    column = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(flat))
    return column, np.searchsorted(starts, bounds)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of all given ranges, one range after the other."""
    ends = lengths.cumsum()
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
