"""Benchmark decontamination on a distributed positional inverted index.

Documents are cut into blocks. For each block and term the index stores one row
with the positions of the term, counted through the block, and for each block
one row with its documents and their lengths. A phrase is looked up by its
rarest term (by a count over all blocks), joined on the term; within a block
the lists of its other terms, rarest first, are shifted by their offsets and
intersected. What is left are the exact places of the phrase. With a slop, the
terms must follow each other in order with at most so many words between.

The index can be restricted to the terms that the phrases hold; they are sent
along with the tasks only up to ``MOST_TERMS`` terms, beyond that all terms are
stored. Defined results: NULL or empty text has no words, phrases without words
match nothing, repeated rows are documents of their own, repeated phrases match
alike. No task holds more than one block, whose size is bounded, or one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm import words
from spanledger.llm.batches import map_batches
from spanledger.llm.prefilter import without
from spanledger.session import stored

WINDOW = 10
BLOCK_BYTES = 4_000_000
MOST_TERMS = 500_000
INDEX = "block bigint, term string, n bigint, positions binary, keys array<string>, sizes array<int>"
_FIELDS = pa.schema(
    [("block", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("positions", pa.binary()), ("keys", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32()))]
)


def build(docs: DataFrame, key: Column, terms: list[str] | None = None) -> DataFrame:
    """The index of ``docs`` (texts in ``text``, known by ``key`` as a string), stored; of ``terms`` only, if given."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        wanted = None if terms is None else pa.array(terms, pa.large_string())
        for batch in rows:
            for a, b in words.runs(batch.column(1), BLOCK_BYTES):
                yield from _block(block, batch.column(0)[a:b], batch.column(1)[a:b], wanted)
                block += 1

    index = map_batches(docs.select(key.cast("string").alias("key"), "text"), batches, INDEX)
    return stored(index)


def _block(block: int, keys: pa.Array, texts: pa.Array, wanted: pa.Array | None) -> Iterator[pa.RecordBatch]:
    found, bounds = words.split(texts)
    coded = found.dictionary_encode()
    codes, terms = coded.indices.to_numpy(), coded.dictionary
    place = np.arange(len(codes), dtype=np.int32)
    if wanted is not None:
        keep = pc.is_in(terms, value_set=wanted).to_numpy(zero_copy_only=False)
        renumbered = np.cumsum(keep) - 1
        place = place[keep[codes]]
        codes = renumbered[codes[place]]
        terms = terms.filter(pa.array(keep))
    counts = np.bincount(codes, minlength=len(terms)).astype(np.int64)
    lists = place[np.argsort(codes, kind="stable")]
    ends = counts.cumsum()
    none = pa.nulls(1, pa.string())
    sizes = pa.array([np.diff(bounds).astype(np.int32)], pa.list_(pa.int32()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([block]), none, pa.array([len(keys)], pa.int64()), pa.nulls(1, pa.binary()), pa.array([keys.to_pylist()], pa.list_(pa.string())), sizes],
        schema=_FIELDS,
    )
    for k in range(0, len(terms), 20_000):
        part = slice(k, min(k + 20_000, len(terms)))
        n = part.stop - part.start
        first = ends[k] - counts[k]
        offsets = np.concatenate([[0], (ends[part] - first) * 4]).astype(np.int32)
        data = lists[first : ends[part.stop - 1]].tobytes()
        positions = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        columns = [pa.array(np.full(n, block)), terms[part.start : part.stop].cast(pa.string()), pa.array(counts[part]), positions]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, _FIELDS.field(4).type), pa.nulls(n, _FIELDS.field(5).type)], schema=_FIELDS)


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Each distinct window (``phrase``) of ``size`` words of the items, with the ids of its items.

    An item with fewer words, but not none, is one window.
    """
    w = F.col("_w")
    listed = items.select("item_id", words.words(F.col("text")).alias("_w")).where(F.size(w) > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
    each = listed.select("item_id", F.explode(F.transform(starts, lambda i: F.slice(w, i + 1, size))).alias("phrase"))
    return each.groupBy("phrase").agg(F.collect_set("item_id").alias("items"))


def terms_of(phrases: DataFrame) -> list[str] | None:
    """The distinct terms of the phrases, or None if there are more than ``MOST_TERMS``."""
    distinct = phrases.select(F.explode("phrase").alias("term")).distinct()
    found = distinct.limit(MOST_TERMS + 1).collect()
    return None if len(found) > MOST_TERMS else sorted(r["term"] for r in found)


def by_rarity(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """The phrases whose terms all occur, each term with its offset, the rarest first."""
    counts = index.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("df"))
    listed = phrases.withColumn("_p", F.xxhash64("phrase"))
    terms = listed.select("phrase", "_p", F.posexplode("phrase").alias("at", "term")).join(counts, "term")
    ranked = terms.groupBy("_p", "phrase").agg(F.array_sort(F.collect_list(F.struct("df", "term", "at"))).alias("lists"))
    whole = ranked.where(F.size("lists") == F.size("phrase"))
    return whole.join(phrases, "phrase").drop("_p")


def _postings(part: pa.Table) -> tuple[dict[str, np.ndarray], list, np.ndarray]:
    """Positions of each term of a block, the keys of its documents, and where each document begins."""
    lists: dict[str, np.ndarray] = {}
    keys, sizes = [], []
    for r in part.select(["term", "positions", "keys", "sizes"]).to_pylist():
        if r["term"] is None:
            keys, sizes = r["keys"], r["sizes"]
        else:
            lists[r["term"]] = np.frombuffer(r["positions"], np.int32)
    return lists, keys, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)


def _exact(lists: dict[str, np.ndarray], ranked: list[dict]) -> np.ndarray:
    """Places where a phrase begins: lists intersected after a shift by their offsets, the rarest first."""
    empty = np.zeros(0, np.int32)
    places = lists.get(ranked[0]["term"], empty) - ranked[0]["at"]
    for x in ranked[1:]:
        if not len(places):
            break
        other = lists.get(x["term"], empty)
        k = np.searchsorted(other, places + x["at"])
        hit = k < len(other)
        hit[hit] = other[k[hit]] == places[hit] + x["at"]
        places = places[hit]
    return places


def _near(lists: dict[str, np.ndarray], ranked: list[dict], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last places where the terms follow each other with at most ``slop`` words between."""
    ordered = [lists.get(x["term"], np.zeros(0, np.int32)) for x in sorted(ranked, key=lambda x: x["at"])]
    first = last = ordered[0]
    for other in ordered[1:]:
        k = np.searchsorted(other, last, "right")
        hit = k < len(other)
        first, last = first[hit], other[k[hit]]
    close = last - first - (len(ordered) - 1) <= slop
    return first[close], last[close]


def _within(starts: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches that do not cross the end of a document, and the document of each."""
    ok = first >= 0
    first, last = first[ok], last[ok]
    doc = np.searchsorted(starts, first, "right") - 1
    ok = last < starts[doc + 1]
    return doc[ok], first[ok], last[ok]


def _by_block(index: DataFrame, ranked: DataFrame, function, schema: str) -> DataFrame:
    """``function(phrases, postings)`` for each block; a block gets the phrases whose rarest term it holds."""
    keys = index.where(F.col("term").isNotNull()).select(F.col("block").alias("asked_block"), F.col("term").alias("rarest"))
    asked = ranked.withColumn("rarest", F.col("lists")[0]["term"]).join(keys, "rarest").drop("rarest", "phrase")
    return asked.groupBy("asked_block").cogroup(index.groupBy("block")).applyInArrow(function, schema)


def matches(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """Every match of the phrases (``phrase_id bigint``, ``phrase array<string>``): document, first and last word.

    With a slop, each place of the first term gives its nearest match.
    """
    ranked = by_rarity(index, phrases)
    names = pa.schema([("phrase_id", pa.int64()), ("key", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())])

    def block(asked: pa.Table, part: pa.Table) -> pa.Table:
        lists, keys, starts = _postings(part)
        out: list[tuple] = []
        for r in asked.to_pylist():
            if slop:
                first, last = _near(lists, r["lists"], slop)
            else:
                first = _exact(lists, r["lists"])
                last = first + len(r["lists"]) - 1
            doc, first, last = _within(starts, first, last)
            out += [(r["phrase_id"], keys[d], int(a - starts[d]), int(b - starts[d])) for d, a, b in zip(doc, first, last, strict=True)]
        return pa.Table.from_arrays([pa.array([x[k] for x in out], names.field(k).type) for k in range(4)], schema=names)

    return _by_block(index, ranked, block, "phrase_id bigint, key string, first_word bigint, last_word bigint")


def contamination(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """Per document: its words, those inside any match, and the items (``items`` of the phrases) that occur."""
    ranked = by_rarity(index, phrases)
    names = pa.schema(
        [("key", pa.string()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("items", pa.list_(pa.int64()))]
    )

    def block(asked: pa.Table, part: pa.Table) -> pa.Table:
        lists, keys, starts = _postings(part)
        change = np.zeros(int(starts[-1]) + 1, np.int32)
        items: dict[int, set] = {}
        for r in asked.select(["lists", "items"]).to_pylist():
            first = _exact(lists, r["lists"])
            doc, first, last = _within(starts, first, first + len(r["lists"]) - 1)
            np.add.at(change, first, 1)
            np.add.at(change, last + 1, -1)
            for d in np.unique(doc).tolist():
                items.setdefault(d, set()).update(r["items"])
        hit = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1]) > 0)])
        named = [sorted(items.get(d, ()), key=str) for d in range(len(keys))]
        digests = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in named]
        columns = [keys, np.diff(starts), hit[starts[1:]] - hit[starts[:-1]], list(map(len, named)), digests, named]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, names, strict=True)], schema=names)

    schema = "key string, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, items array<bigint>"
    return _by_block(index, ranked, block, schema)


def contaminated_documents(docs: DataFrame, items: DataFrame, key: Column, size: int = WINDOW) -> DataFrame:
    """``contamination`` of the documents by the windows of the items, with ``contaminated``."""
    phrases = stored(windows(items, size))
    index = build(docs, key, terms_of(phrases))
    return contamination(index, phrases).withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows whose text holds no window of the items, in all their columns. The text alone decides."""
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    found = contaminated_documents(docs, items, digest, size).where("contaminated")
    name = "_digest" + "_" * max(map(len, docs.columns))
    held = stored(found.select(F.col("key").alias(name)).distinct())
    return without(docs, digest, held).select(*[F.col(f"`{c}`") for c in docs.columns])
