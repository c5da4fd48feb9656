"""Best-fit packing of token sequences by bin completion.

Every text is encoded and closed by an end id; what is longer than a sequence
is cut into whole sequences and a rest. How the pieces are packed depends on
nothing but how many pieces there are of each length, so the search runs on
that histogram, which has at most ``capacity`` entries whatever the data's
size. Its result is a list of fillings (lengths with multiplicities) and how
often each is used. Pieces then find their places apart from each other: a
piece is the n-th of its length, and the plan says which copy of which filling
holds the n-th piece of a length, and where.

The search is a branch and bound over fillings. Best fit decreasing gives the
first incumbent. Then, around the largest length left, the undominated
fillings of what remains of its sequence are tried, tightest first; a branch
ends when the waste it has made can no longer beat the incumbent. A filling is
used as often as the counts allow, or once. The search ends with a proof (the
bound on the number of sequences is met, or no branch is left) or after
``NODES`` steps, with the best packing found.

The n-th piece of a length: tasks number their own pieces of each length as
they write them, and the tasks' counts are summed up per length. So a length
that many pieces share is never brought to one task.

Defined results: a NULL or empty text is the end id alone; repeated rows are
packed each on its own; an empty table gives no rows. Keys may be NULL. A
task holds one batch of texts and one number per length.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanledger.llm import white
from spanledger.llm.batches import map_batches
from spanledger.session import stored

CAPACITY, END_ID, NODES, CHOICES = 4096, 1, 200_000, 64
_TOGETHER = 400  # words in a line
_NUMBERS = np.int64(1) << 40  # more pieces of one length than there can be

#: Lengths with their multiplicities, longest first, and how many sequences are filled this way.
Filling = tuple[tuple[tuple[int, int], ...], int]


@cache
def _tokenizer(path: str):
    """The tokenizer (special strings in a text are ordinary text), the same without its steps before the merges, and whether each
    id ends a word."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer, merges = Tokenizer.from_file(path), Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = merges.encode_special_tokens = True
    if tokenizer.normalizer.normalize_str("A") != "a":
        raise ValueError("the tokenizer must read text in lower case")
    merges.normalizer, merges.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, i in tokenizer.get_vocab().items():
        ends[i] = token.endswith("</w>")
    return tokenizer, merges, ends


def _flat(coded: list) -> tuple[np.ndarray, np.ndarray]:
    """All ids of encodings one after the other, and how many each has."""
    arrays = [np.array(e.ids, np.int32) for e in coded]
    return np.concatenate([*arrays, np.zeros(0, np.int32)]), np.fromiter(map(len, arrays), np.int64, len(arrays))


def _together(word: list[str], which: np.ndarray, tokenizer, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of letters alone, many to a line: the ids, which words they are of, and where those of each begin and end.

    Each such word gives ids of which only the last ends a word; a line with another number of such ends is left out.
    """
    lines = [which[k : k + _TOGETHER] for k in range(0, len(which), _TOGETHER)]
    ids, sizes = _flat(tokenizer.encode_batch_fast([" ".join([word[i] for i in x.tolist()]) for x in lines], add_special_tokens=False))
    last, at = np.concatenate([[0], ends[ids].cumsum()]), np.concatenate([[0], sizes.cumsum()]).astype(np.int64)
    good = np.diff(last[at]) == np.fromiter(map(len, lines), np.int64, len(lines))
    ids = ids[np.repeat(good, sizes)]
    close = np.flatnonzero(ends[ids]) + 1
    kept = np.concatenate([*[x for x, ok in zip(lines, good, strict=True) if ok], np.zeros(0, np.int64)]).astype(np.int64)
    return ids, kept, np.concatenate([[0], close])[:-1].astype(np.int64), close


def _ids_of(distinct: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, and where those of each word begin among them and how many they are.

    Words of ASCII letters need the merges alone, other words of letters the whole tokenizer; all else is encoded word by word.
    """
    tokenizer, merges, ends = _tokenizer(path)
    word = distinct.to_pylist()
    letters = pc.utf8_is_alpha(distinct).to_numpy(zero_copy_only=False)
    ascii_ = pc.string_is_ascii(distinct).to_numpy(zero_copy_only=False)
    start, length, single = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64), np.ones(len(word), bool)
    found, held = [], 0
    for which, model in ((letters & ascii_, merges), (letters & ~ascii_, tokenizer)):
        ids, kept, begin, end = _together(word, np.flatnonzero(which), model, ends)
        start[kept], length[kept], single[kept] = held + begin, end - begin, False
        found.append(ids)
        held += len(ids)
    rest = np.flatnonzero(single)
    ids, sizes = _flat(tokenizer.encode_batch_fast([word[i] for i in rest.tolist()], add_special_tokens=False))
    start[rest], length[rest] = held + sizes.cumsum() - sizes, sizes
    return np.concatenate([*found, ids]), start, length


def encode_column(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of whole texts, and where those of each text begin and end.

    No token of this kind of tokenizer goes across white space, nor across the other places where ``white.CLASSES`` cuts,
    so each distinct word of the batch is encoded once.
    """
    cut, bounds = white.split(pc.ascii_lower(texts), white.CLASSES)
    coded = cut.dictionary_encode()
    flat, start, length = _ids_of(coded.dictionary, path)
    at = coded.indices.to_numpy()
    ends = np.concatenate([[0], length[at].cumsum()]).astype(np.int64)
    return flat[white.spread(start[at], length[at])], ends[bounds]


def pieces(df: DataFrame, path: str, key: str, text: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """The pieces of every text: ``key``, ``piece``, ``start``, ``length``, ``ids`` (if asked), ``ids_crc32``, and the number
    ``nth`` among those of this length that the task ``part`` has made."""
    kind = df.schema[key].dataType.simpleString()
    shown = ["ids"] if with_ids else []

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in rows:
            ids, bounds = encode_column(batch.column(1), path)
            ids = np.insert(ids, bounds[1:], end_id).astype(np.uint32)
            begin = bounds[:-1] + np.arange(len(batch))
            whole = np.diff(bounds) + 1
            per_text = -(-whole // capacity)
            of = np.repeat(np.arange(len(batch)), per_text)
            piece = white.spread(np.zeros(len(batch), np.int64), per_text)
            start = piece * capacity
            length = np.minimum(whole[of] - start, capacity)
            order = np.argsort(length, kind="stable")
            sorted_lengths = length[order]
            nth = np.empty(len(of), np.int64)
            nth[order] = seen[sorted_lengths] + np.arange(len(of)) - np.searchsorted(sorted_lengths, sorted_lengths)
            seen += np.bincount(length, minlength=capacity + 1)
            crc = [zlib.crc32(ids[a : a + n].astype("<u4").tobytes()) for a, n in zip((begin[of] + start).tolist(), length.tolist(), strict=True)]
            columns = [batch.column(0).take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length)]
            if with_ids:  # pieces lie in the order of the ids
                at = np.concatenate([[0], length.cumsum()]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32))))
            columns += [pa.array(crc, pa.int64()), pa.array(np.full(len(of), part, np.int32)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "piece", "start", "length", *shown, "ids_crc32", "part", "nth"])

    lists = "ids array<int>, " if with_ids else ""
    schema = f"key {kind}, piece int, start bigint, length bigint, {lists}ids_crc32 bigint, part int, nth bigint"
    return map_batches(df.select(F.col(f"`{key}`"), F.col(f"`{text}`")), batches, schema)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """A number of sequences that no packing goes below.

    By the sum, by how many pieces over a half, a third and so on fit together, and by the gaps beside those over a half.
    """
    lengths = np.array(sorted(counts), np.int64)
    number = np.array([counts[n] for n in lengths.tolist()], np.int64)
    if not len(lengths):
        return 0
    held = (lengths * number).cumsum()
    many = number.cumsum()
    best = -(-int(held[-1]) // capacity)

    def below(x: int, sums: np.ndarray) -> int:
        i = int(np.searchsorted(lengths, x))
        return int(sums[i - 1]) if i else 0

    for k in range(1, min(capacity, 64)):  # at most k pieces over capacity / (k + 1) share a sequence
        best = max(best, -(-(int(many[-1]) - below(capacity // (k + 1) + 1, many)) // k))
    for small in [0, *(n for n in lengths.tolist() if 2 * n <= capacity)]:
        # Lengths over capacity - small stand alone; those over a half need one each; the rest down to small fill the gaps.
        alone = int(many[-1]) - below(capacity - small + 1, many)
        half = int(many[-1]) - alone - below(capacity // 2 + 1, many)
        room = half * capacity - (below(capacity - small + 1, held) - below(capacity // 2 + 1, held))
        rest = below(capacity // 2 + 1, held) - below(small, held)
        best = max(best, alone + half + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best fit decreasing, all equal sequences at once: the next length goes to the tightest sequence that holds it."""
    open_: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    rooms: list[int] = []  # ascending

    def put(room: int, filling: tuple, copies: int) -> None:
        if room not in open_:
            open_[room] = []
            rooms.insert(int(np.searchsorted(rooms, room)), room)
        open_[room].append((filling, copies))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = int(np.searchsorted(rooms, length))
            if i == len(rooms):
                each = min(capacity // length, left)
                put(capacity - each * length, ((length, each),), left // each)
                left -= left // each * each
                continue
            room = rooms[i]
            filling, copies = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[i]
            each = min(room // length, left)
            used = min(copies, left // each)
            put(room - each * length, (*filling, (length, each)), used)
            if copies > used:
                put(room, filling, copies - used)
            left -= used * each
    return [x for groups in open_.values() for x in groups]


Counts = tuple[tuple[int, int], ...]


def _dominated(filling: Counts, slack: int, left: dict[int, int]) -> bool:
    """Whether a length that is left could stand for one or two pieces of the filling and waste no more.

    Of two that fill the same room, the one with a single longer piece in place of shorter ones leaves more to choose from.
    """
    held = dict(filling)
    spare = {x for x in left if left[x] > held.get(x, 0)}
    pairs = {a + b for a in held for b in held if a < b or (a == b and held[a] > 1)}
    return any(x in spare for x in pairs) or any(x in spare for n in {*held, *pairs} for x in range(n + 1, n + slack + 1))


def _fillings(left: dict[int, int], room: int, waste: int, steps: list[int]) -> tuple[list[Counts], bool]:
    """Undominated fillings of ``room`` that waste at most ``waste``, tightest first, and whether these are all of them.

    ``steps`` counts down; at most ``CHOICES`` are listed, those with the longest pieces.
    """
    lengths = sorted((n for n, c in left.items() if c and n <= room), reverse=True)
    suffix = np.array([n * left[n] for n in lengths], np.int64)[::-1].cumsum()[::-1].tolist()
    steps[0] -= len(lengths) // 16
    found: list[tuple[int, Counts]] = []
    stack: list[tuple[int, int, Counts, int]] = [(0, room, (), -1)]  # next length, free, held, how many of it (-1: the most)
    while stack and steps[0] > 0 and len(found) < CHOICES:
        steps[0] -= 1
        i, free, held, k = stack.pop()
        while i < len(lengths) and lengths[i] > free:
            i, k = i + 1, -1
        if i == len(lengths):
            if free <= waste:
                steps[0] -= len(left) // 64
                if not _dominated(held, free, left):
                    found.append((free, held))
            continue
        if free - suffix[i] > waste:
            continue
        n = lengths[i]
        k = min(left[n], free // n) if k < 0 else k
        if k:
            stack.append((i, free, held, k - 1))
        stack.append((i + 1, free - k * n, (*held, (n, k)) if k else held, -1))
    return [held for _, held in sorted(found, key=lambda f: f[0])], not stack


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> tuple[list[Filling], int]:
    """A packing of so many pieces of each length, and the bound on the number of sequences (equal: proven least)."""
    counts = {int(n): int(c) for n, c in counts.items() if c > 0}
    best = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    size = sum(c for _, c in best)
    total = sum(n * c for n, c in counts.items())
    steps, complete = [nodes], [True]
    left, used, spare = dict(counts), [], [(size - 1) * capacity - total]
    # Each frame: the choices that are left around its largest length, and what the present choice took.
    frames: list[list] = []

    def choices() -> list[Filling]:
        largest = max(n for n, c in left.items() if c)
        left[largest] -= 1
        found, every = _fillings(left, capacity - largest, spare[0], steps)
        left[largest] += 1
        complete[0] &= every
        out = []
        for rest in found:
            filling = tuple((Counter(dict(rest)) + Counter([largest])).items())
            many = min(left[n] // k for n, k in filling)
            waste = capacity - sum(n * k for n, k in filling)
            many = min(many, spare[0] // waste) if waste else many
            out += [(filling, m) for m in dict.fromkeys((many, 1)) if m > 0]
        return out[::-1]

    def take(filling: Counts, copies: int, sign: int) -> None:
        for n, k in filling:
            left[n] -= sign * k * copies
        spare[0] -= sign * copies * (capacity - sum(n * k for n, k in filling))

    proven = size == bound
    if not proven:
        frames.append([choices(), None])
    while frames and steps[0] > 0 and not proven:
        steps[0] -= 1
        frame = frames[-1]
        if frame[1]:
            take(*frame[1], -1)
            used.pop()
            frame[1] = None
        if not frame[0] or spare[0] < 0:
            frames.pop()
            continue
        frame[1] = frame[0].pop()
        take(*frame[1], 1)
        used.append(frame[1])
        if spare[0] < 0:
            continue
        if any(left.values()):
            frames.append([choices(), None])
            continue
        best = list(used)
        better = sum(c for _, c in best)
        spare[0] -= (size - better) * capacity
        size = better
        proven = size == bound
    if not frames and complete[0] and steps[0] > 0:
        bound = size  # no branch is left
    return best, bound


def _places(plan: list[Filling], capacity: int) -> tuple[np.ndarray, ...]:
    """Per length and filling, ordered by length and first number: these two, multiplicity, first sequence, offset."""
    rows, first, seen = [], 0, Counter()
    for filling, copies in plan:
        offset = 0
        for length, each in filling:
            rows.append((length, seen[length], each, first, offset))
            seen[length] += each * copies
            offset += each * length
        first += copies
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(table[:, i].copy() for i in range(5))


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Every piece with the sequence that holds it and its place there: ``key``, ``piece``, ``start``, ``length``, ``ids`` (if asked),
    ``ids_crc32``, ``sequence_id``, ``offset``."""
    spark = df.sparkSession
    made = stored(pieces(df, path, key, text, capacity, end_id, with_ids))
    per_task = made.groupBy("part", "length").agg((F.max("nth") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    per_task = stored(per_task.select("part", "length", "n", F.coalesce(before, F.lit(0)).alias("before")))
    histogram = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    places = spark.sparkContext.broadcast(_places(bin_completion(histogram, capacity)[0], capacity))
    numbered = made.join(per_task.drop("n"), ["part", "length"]).withColumn("nth", F.col("nth") + F.col("before"))
    columns = ["key", "piece", "start", "length", *(["ids"] if with_ids else []), "ids_crc32"]

    def placed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, each, sequence, offset = places.value
        starts = lengths * _NUMBERS + firsts
        for batch in rows:
            length, nth = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "nth"))
            at = np.searchsorted(starts, length * _NUMBERS + nth, "right") - 1
            k = nth - firsts[at]
            found = [pa.array(sequence[at] + k // each[at]), pa.array(offset[at] + k % each[at] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {made.schema[c].dataType.simpleString()}" for c in columns) + ", sequence_id bigint, offset bigint"
    return map_batches(numbered.select(*columns, "nth"), placed, schema).withColumnRenamed("key", key)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of every sequence of at most ``capacity`` ids, from pieces with their ids: ``sequence_id``, ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
