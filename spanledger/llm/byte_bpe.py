"""Byte-level BPE encoding and decoding over Arrow batches.

A public rank file is turned into a model of the tokenizers library: every
byte has a printable character, and every way to build a token from two others
is a merge, in the order of the ranks. Texts are cut where white space follows
a character that is none: no match of the pattern goes across such a place, so
equal stretches have equal ids and each distinct stretch of a batch is encoded
once; a worker keeps the ids of short ones between batches. Ties between overlapping merges of one token are settled by the library
of the rank file, which encodes the distinct stretches again as an exact check.

Defined results: NULL text is an empty text and has no ids; ids decode to the
bytes of the text, also where a token ends inside a character.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from spanledger.llm import words
from spanledger.llm.batches import held, map_batches

SLICE, RUN = 4_000, 1_500_000
SEEN, SEEN_LENGTH = 100_000, 40


def byte_characters() -> dict[int, str]:
    """A printable character for each byte: itself where it is printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(rest)) for b in range(256)}


@held
def _model(path: str, pattern: str):
    """The tokenizers model, the exact encoder, and the bytes and decimals of each id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    shown = byte_characters()
    word = {t: "".join(shown[b] for b in t) for t in ranks}
    merges = [
        (word[t[:j]], word[t[j:]])
        for t in sorted(ranks, key=ranks.__getitem__)
        for j in range(1, len(t))
        if t[:j] in ranks and t[j:] in ranks
    ]
    model = Tokenizer(models.BPE({w: ranks[t] for t, w in word.items()}, merges, ignore_merges=True))
    model.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    exact = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        table[i] = t
    return model, exact, pa.array(table, pa.large_binary()), pa.array([f"{i}," for i in range(len(table))], pa.large_string())


@held
def _seen(path: str, pattern: str) -> dict[str, list[int]]:
    """Ids of the first ``SEEN`` short stretches that a worker has met, kept between batches."""
    return {}


def _stretches(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The stretches of all texts, and how many each text has."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    own = data[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    space = ((own >= 9) & (own <= 13)) | (own == 32)
    # The bytes that can end white space beyond ASCII, so that no run of white space is cut in two.
    wide = np.isin(own, np.array([*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF], np.uint8))
    lead = np.zeros(len(own), bool)
    lead[1:] |= own[:-1] == 0xC2
    lead[2:] |= (own[:-2] >= 0xE1) & (own[:-2] <= 0xE3)
    start = np.zeros(len(own) + 1, bool)
    start[1:-1] = space[1:] & ~(space | (wide & lead) | ((own >= 28) & (own <= 31)))[:-1]
    start[bounds] = True
    cuts = np.flatnonzero(start)
    counts = np.diff(np.searchsorted(cuts, bounds))
    return pa.LargeStringArray.from_buffers(max(len(cuts) - 1, 0), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(own.tobytes())), counts


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of all given ranges, one range after the other."""
    ends = lengths.cumsum()
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def encode_column(text: pa.Array, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of texts, and where those of each text begin and end."""
    model, exact, _, _ = _model(path, pattern)
    stretches, counts = _stretches(text)
    coded = stretches.dictionary_encode()
    seen = _seen(path, pattern)
    ids: list[list[int]] = []
    for k in range(0, len(coded.dictionary), SLICE):
        distinct = coded.dictionary[k : k + SLICE].to_pylist()
        known = [seen.get(x) for x in distinct]
        new = [x for x, i in zip(distinct, known, strict=True) if i is None]
        found = [e.ids for e in model.encode_batch_fast(new, add_special_tokens=False)]
        fresh = [b if a != b else a for a, b in zip(found, map(exact.encode_ordinary, new), strict=True)]
        rest = iter(fresh)
        ids += [next(rest) if i is None else i for i in known]
        room = SEEN - len(seen)
        seen.update([(x, i) for x, i in zip(new, fresh, strict=True) if len(x) <= SEEN_LENGTH][: max(room, 0)])
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for x in ids for i in x), np.int32, int(lengths.sum()))
    at = coded.indices.to_numpy()
    all_ids = flat[_spread((lengths.cumsum() - lengths)[at], lengths[at])]
    ends = np.concatenate([[0], lengths[at].cumsum()]) if len(at) else np.zeros(1, np.int64)
    return all_ids, ends[np.concatenate([[0], counts.cumsum()]).astype(np.int64)]


def _joined(table: pa.Array, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The entries of all ids in one buffer, and where each begins."""
    taken = table.take(pa.array(ids))
    return memoryview(taken.buffers()[2] or b""), np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1]


def decode_column(ids: np.ndarray, bounds: np.ndarray, path: str, pattern: str) -> list[memoryview]:
    """The bytes of each list of ids. A character may be split between lists, so these are bytes, not text."""
    data, at = _joined(_model(path, pattern)[2], ids)
    return [data[at[a] : at[b]] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _cut_offsets(data: memoryview, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one character of tokens of so many bytes each; pieces of one character share it."""
    character = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
    ends = lengths.cumsum()
    return character[ends - lengths], character[ends - 1] + 1


def _runs(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``RUN`` bytes of text (second column), or one text."""
    for batch in rows:
        for a, b in words.runs(batch.column(1), RUN):
            yield batch.slice(a, b - a)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every text with the characters each covers: ``key``, ids, first and end (``array<int>``)."""
    kind = df.schema[key].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _model(path, pattern)[2]
        width = np.diff(np.frombuffer(table.buffers()[1], np.int64)[: len(table) + 1])
        for batch in _runs(rows):
            ids, bounds = encode_column(batch.column(1), path, pattern)
            first, end = np.zeros(len(ids), np.int32), np.zeros(len(ids), np.int32)
            for data, a, b in zip(decode_column(ids, bounds, path, pattern), bounds[:-1], bounds[1:], strict=True):
                if b > a:
                    first[a:b], end[a:b] = _cut_offsets(data, width[ids[a:b]])
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v, pa.int32())) for v in (ids, first, end)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], [key, "ids", "first", "end"])

    return map_batches(df.select(key, text), batches, f"`{key}` {kind}, ids array<int>, first array<int>, end array<int>")


def decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The text of every list of ids; bytes that are no whole character become U+FFFD. NULL ids are none."""
    kind = df.schema[key].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lists = pc.fill_null(batch.column(1), [])
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], pc.list_value_length(lists).to_numpy().cumsum()]).astype(np.int64)
            texts = [str(x, "utf-8", "replace") for x in decode_column(flat, bounds, path, pattern)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    return map_batches(df.select(key, ids), batches, f"`{key}` {kind}, text string")


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, count and SHA-256 of the ids, SHA-256 of the bytes they decode to."""
    kind = df.schema[key].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(rows):
            ids, bounds = encode_column(batch.column(1), path, pattern)
            listed, at = _joined(_model(path, pattern)[3], ids)
            spans = list(zip(bounds[:-1], bounds[1:], strict=True))
            of_ids = [hashlib.sha256(listed[at[a] : max(at[a], at[b] - 1)]).hexdigest() for a, b in spans]
            of_text = [hashlib.sha256(x).hexdigest() for x in decode_column(ids, bounds, path, pattern)]
            columns = [batch.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(df.select(key, text), batches, schema)
