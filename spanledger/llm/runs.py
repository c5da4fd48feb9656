"""Periodic runs of words: stretches that repeat a block of words two times or more.

A run of period q is a stretch of at least two q words in which words q apart
are equal and which no neighbouring word extends; q is its smallest period. It
ends with exactly one branching square: the last two blocks, after which the
repetition breaks. Its two halves begin suffixes that share q words and no
more, so they lie in different children of the interval of depth q of the
suffix array.

The suffix array of all texts of a batch is built by doubling, each text apart
from the others, and only the suffixes whose order is open are sorted again.
The longest common prefixes come from the ranks of the doubling rounds. Each
of them splits its interval in two; from the smaller part, every suffix i asks
the inverse array whether i + depth or i - depth lies in the other part. Such
squares are rotated to the left while the words agree, which merges all
squares of a run into it. No tree is built.

A run of at least ``LEAST`` words holds a sequence of ``LEAST`` / 2 words that
occurs twice in its text, and its last square begins at most that many words
behind one. So texts without such a repeated sequence are skipped, and the
intervals are those of suffixes near one. Hashes that agree by chance only
keep a suffix that could have been left out.

Defined results: a NULL or empty text, or one of fewer than ``LEAST`` words,
has no runs. Repeated rows and NULL keys are kept row by row. A task holds one
batch of texts, or one text: about 100 bytes a word, and for the texts with
repeated sequences 4 more for each doubling round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm import white, words
from spanledger.llm.batches import map_batches

LEAST = 12
RUN, PAIRS = 4_000_000, 1_000_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _repeated(ids: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Whether a sequence of ``size`` words begins at a word and occurs again in its text."""
    n = len(ids)
    out = np.zeros(n, bool)
    if n < size:
        return out
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _FACTOR
    mixed ^= mixed >> np.uint64(29)
    hashed = (text[: n - size + 1].astype(np.uint64) + np.uint64(1)) * _FACTOR
    for k in range(size):
        hashed = (hashed ^ (hashed >> np.uint64(31))) * _FACTOR + mixed[k : n - size + 1 + k]
    whole = text[: n - size + 1] == text[size - 1 :]
    order = np.sort(hashed[whole])
    twice = order[1:][order[1:] == order[:-1]]
    if len(twice):
        at = np.minimum(np.searchsorted(twice, hashed), len(twice) - 1)
        out[: n - size + 1] = whole & (twice[at] == hashed)
    return out


def _suffixes(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and the ranks of all positions by their first 1, 2, 4, … words (equal sequences share a rank)."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    ranks = np.empty(n, np.int32)

    def heads(at: np.ndarray, new: np.ndarray) -> np.ndarray:
        return at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]

    new = np.ones(n, bool)
    new[1:] = ids[order][1:] != ids[order][:-1]
    ranks[order] = heads(np.arange(n), new)
    levels, width = [ranks.copy()], 1
    unsettled = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(unsettled):
        held = order[unsettled]
        first, second = ranks[held], ranks[np.minimum(held + width, n - 1)]
        by = np.argsort(first.astype(np.int64) * n + second, kind="stable")
        held, first, second = held[by], first[by], second[by]
        order[unsettled] = held
        new = np.ones(len(held), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        ranks[held] = heads(unsettled, new)
        levels.append(ranks.copy())
        width *= 2
        unsettled = unsettled[~(new & np.append(new[1:], True))]
    return order, levels


def _common(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many words the suffixes at ``a`` and ``b`` share; the last position is a word of its own."""
    shared = np.zeros(len(a), np.int64)
    last = len(levels[0]) - 1
    for level in range(len(levels) - 1, -1, -1):
        ranks = levels[level]
        same = ranks[np.minimum(a + shared, last)] == ranks[np.minimum(b + shared, last)]
        shared[same] += 1 << level
    return shared


def _intervals(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each split of the sorted suffixes, where the interval of at least its depth begins and where its right part ends.

    The right part ends before the next split that is as deep or less, so a pair of suffixes is told apart by one split alone.
    """
    values = common.tolist()
    n = len(values)
    begin, end = [0] * n, [n] * n
    open_: list[int] = []
    for k, depth in enumerate(values):
        while open_ and values[open_[-1]] >= depth:
            end[open_.pop()] = k
        begin[k] = open_[-1] if open_ else 0
        open_.append(k)
    return np.array(begin, np.int64), np.array(end, np.int64)


def _squares(ids: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and half length of every branching square whose halves both begin in ``near``."""
    order, levels = _suffixes(ids)
    sub = order[near[order]].astype(np.int64)
    common = np.zeros(len(sub), np.int64)
    common[1:] = _common(sub[:-1], sub[1:], levels)
    begin, end = _intervals(common)
    inverse = np.full(len(ids), -1, np.int64)
    inverse[sub] = np.arange(len(sub))
    splits = np.flatnonzero(common)
    left_is_smaller = splits - begin[splits] <= end[splits] - splits
    start = np.where(left_is_smaller, begin[splits], splits)
    size = np.where(left_is_smaller, splits - begin[splits], end[splits] - splits)
    low = np.where(left_is_smaller, splits, begin[splits])
    high = np.where(left_is_smaller, end[splits], splits)
    depth = common[splits]
    firsts, halves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    pieces = np.searchsorted(size.cumsum(), np.arange(PAIRS, int(size.sum()), PAIRS))
    for part in np.split(np.arange(len(splits)), np.unique(pieces)):
        i = sub[white.spread(start[part], size[part])]
        d, lo, hi = (np.repeat(x[part], size[part]) for x in (depth, low, high))
        for other in (i + d, i - d):
            at = np.where((other >= 0) & (other < len(ids)), inverse[np.clip(other, 0, len(ids) - 1)], -1)
            found = (at >= lo) & (at < hi)
            firsts.append(np.minimum(i, other)[found])
            halves.append(d[found])
    return np.concatenate(firsts), np.concatenate(halves)


def _begin(ids: np.ndarray, start: int, period: int) -> int:
    """The first word of the run of a square: rotated to the left while the words agree."""
    step = 64
    while start > 0:
        low = max(start - step, 0)
        other = np.flatnonzero(ids[low:start] != ids[low + period : start + period])
        if len(other):
            return low + int(other[-1]) + 1
        start, step = low, step * 2
    return start


def periodic_runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs of at least ``least`` words: text, start, length, period, ordered by these but the length.

    ``ids`` are the words of all texts, equal for equal words; those of text t are ``bounds[t]`` to ``bounds[t + 1]``.
    """
    size = -(-least // 2)
    repeated = _repeated(ids, bounds, size)
    sums = np.concatenate([[0], repeated.cumsum()])
    texts = np.flatnonzero(sums[bounds[1:]] > sums[bounds[:-1]])
    if not len(texts):
        return np.zeros((0, 4), np.int64)
    lengths = bounds[texts + 1] - bounds[texts]
    # Words of these texts, each text followed by a word of its own.
    origin = np.insert(white.spread(bounds[texts], lengths), lengths.cumsum(), -1)
    of = np.repeat(np.arange(len(texts)), lengths + 1)
    most = int(ids.max()) + 1
    own = np.where(origin < 0, most, ids[origin]) + of * np.int64(most + 1)
    begins = np.concatenate([[0], (lengths + 1).cumsum()])[:-1]
    marked = np.where(origin < 0, False, repeated[origin])
    near = marked.copy()
    for k in range(1, size + 1):
        near[k:] |= marked[:-k]
    first, half = _squares(own, near & (origin >= 0))
    for k in range(least):  # a short square must rotate far enough
        short = np.flatnonzero(2 * half + k < least)
        agrees = own[first[short] - 1 - k] == own[first[short] - 1 - k + half[short]]
        keep = np.ones(len(first), bool)
        keep[short[~agrees]] = False
        first, half = first[keep], half[keep]
    found: list[tuple[int, int, int, int]] = []
    end, of_end = -1, []
    by = np.lexsort((half, first + 2 * half))
    for start, period in zip(first[by].tolist(), half[by].tolist(), strict=True):
        if start + 2 * period != end:
            end, of_end = start + 2 * period, []
        if any(period % p == 0 and b <= start for b, p in of_end):
            continue  # several blocks of a shorter period
        begin = _begin(own, start, period)
        of_end.append((begin, period))
        text = int(of[begin])
        found.append((int(texts[text]), begin - int(begins[text]), end - begin, period))
    return np.array(sorted(found, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)


def _joined(column: pa.LargeStringArray, bounds: np.ndarray) -> pa.Array:
    """The words of each text with one space between them."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    gap = np.ones(len(column), np.int64)
    gap[bounds[1:][np.diff(bounds) > 0] - 1] = 0
    ends = (np.diff(offsets) + gap).cumsum()
    at = np.concatenate([[0], ends])[bounds].astype(np.int64)
    out = np.full(at[-1], 32, np.uint8)
    letter = np.ones(at[-1], bool)
    letter[ends[gap == 1] - 1] = False
    out[letter] = data
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(at), pa.py_buffer(out.tobytes())).cast(pa.string())


def find(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Per row: ``key``, ``n_words``, ``runs`` (start and length in words, period; by start, then period), and ``collapsed``:
    the words, one space between them, without those that lie in a run behind its first block."""
    kind = df.schema[key].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in rows:
            for a, b in words.runs(whole.column(1), RUN):
                batch = whole.slice(a, b - a)
                column, bounds = white.split(batch.column(1))
                found = periodic_runs(column.dictionary_encode().indices.to_numpy(), bounds, least)
                keep = np.ones(len(column), bool)
                for t, start, length, period in found.tolist():
                    keep[bounds[t] + start + period : bounds[t] + start + length] = False
                kept = np.concatenate([[0], keep.cumsum()])[bounds]
                collapsed = _joined(column if keep.all() else column.filter(pa.array(keep)), kept)
                fields = [pa.array(found[:, i].copy()) for i in (1, 2, 3)]
                at = np.searchsorted(found[:, 0], np.arange(len(batch) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds)), lists, collapsed], ["key", "n_words", "runs", "collapsed"])

    schema = f"key {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return map_batches(df.select(F.col(f"`{key}`"), F.col(f"`{text}`")), batches, schema).withColumnRenamed("key", key)
