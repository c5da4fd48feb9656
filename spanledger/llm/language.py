"""Language identification by cross-parsing entropy.

For each language a bounded sample of labelled text becomes a suffix automaton,
which knows every string that occurs in the sample. A text is parsed from left
to right into the longest phrases that occur in the sample of a language; the
language that needs the fewest phrases per character wins. Long texts are
parsed in stretches of ``STRETCH`` characters side by side, all of them, so a
phrase ends at the end of a stretch, for every language alike.

Defined results: NULL text and text without a letter is ``und`` with score 0;
ties go to the language that sorts first; without labelled text all is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.llm.batches import held, map_batches

SAMPLE_ROWS, SAMPLE_CHARS = 32, 1_000
STRETCH, SHARP = 512, 60.0
SYMBOLS = 48


@dataclass(frozen=True)
class Samples:
    """Text of each language, sorted by language."""

    languages: tuple[str, ...]
    texts: tuple[str, ...]


def sample(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Samples:
    """At most ``rows`` stretches of ``chars`` characters per language, from rows that satisfy ``learn``.

    The rows and the places in them follow from a hash. A window keeps the first rows of each
    language, reduced within each task before they move.
    """
    ok = learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    mark = F.xxhash64(F.col("doc_id"), F.lit("language"))
    room = F.greatest(F.length("text") - F.lit(chars), F.lit(0)) + 1
    piece = F.substring(F.col("text"), F.pmod(mark, room).cast("int") + 1, F.lit(chars))
    narrow = docs.where(ok).select(F.col("lang").alias("l"), mark.alias("m"), piece.alias("p"))
    first = Window.partitionBy("l").orderBy("m", "p")
    chosen = narrow.withColumn("r", F.row_number().over(first)).where(F.col("r") <= rows).collect()
    texts: dict[str, list[tuple]] = {}
    for x in chosen:
        texts.setdefault(x["l"], []).append((x["m"], x["p"]))
    languages = sorted(texts)
    return Samples(tuple(languages), tuple("\n".join(p for _, p in sorted(texts[n])) for n in languages))


def _automaton(codes: list[int]) -> np.ndarray:
    """Transitions of the suffix automaton of ``codes``; -1 where a string does not occur."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    table = np.full((len(following), SYMBOLS), -1, np.int32)
    for state, moves in enumerate(following):
        for c, to in moves.items():
            table[state, c] = to
    return table


def _parser(codes: list[int]) -> np.ndarray:
    """One table: the state after a symbol, doubled, plus 1 where the symbol begins a phrase.

    The last state is that before a text and after a symbol that does not occur.
    """
    table = _automaton(codes)
    begun = np.where(table[0] >= 0, table[0], len(table)) * 2 + 1
    return np.vstack([np.where(table >= 0, table * 2, begun[None, :]), begun]).astype(np.int32).reshape(-1)


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@held
def _trained(samples: Samples) -> tuple[np.ndarray, list[np.ndarray]]:
    """Symbol of each code point (0 no letter, 1 a rare letter) and the parsers of all languages."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in samples.texts]
    found, counts = np.unique(np.concatenate([*points, np.zeros(0, np.uint32)]), return_counts=True)
    own = _letters()[found]
    found, counts = found[own], counts[own]
    frequent = found[np.argsort(-counts, kind="stable")][: SYMBOLS - 2]
    symbol = _letters().astype(np.uint8)
    symbol[frequent] = np.arange(2, 2 + len(frequent))
    return symbol, [_parser(symbol[p].tolist()) for p in points]


def phrases(texts: list[str], samples: Samples) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases that each text (row) needs with each language (column), its characters, and whether it has a letter."""
    symbol, parsers = _trained(samples)
    codes = [symbol[np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32)] for t in texts]
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    lettered = np.fromiter((bool(c.any()) for c in codes), bool, len(codes))
    pieces = (sizes + STRETCH - 1) // STRETCH
    owner = np.repeat(np.arange(len(codes)), pieces)
    flat = np.concatenate([*codes, np.zeros(0, np.uint8)])
    begin = np.repeat(sizes.cumsum() - sizes, pieces) + STRETCH * (np.arange(len(owner)) - np.repeat(pieces.cumsum() - pieces, pieces))
    length = np.minimum(np.repeat(sizes.cumsum(), pieces) - begin, STRETCH)
    order = np.argsort(-length, kind="stable")
    begin, length, owner = begin[order], length[order], owner[order]
    active = np.searchsorted(-length, -np.arange(STRETCH), "left")  # stretches longer than each place
    need = np.zeros((len(owner), len(parsers)), np.int64)
    state = [np.full(len(owner), len(p) // SYMBOLS - 1, np.int32) for p in parsers]
    for place in range(STRETCH):
        n = int(active[place])
        if not n:
            break
        now = flat[begin[:n] + place]
        for k, parser in enumerate(parsers):
            moved = parser[state[k][:n] * SYMBOLS + now]
            need[:n, k] += moved & 1
            state[k][:n] = moved >> 1
    total = np.zeros((len(codes), len(parsers)), np.int64)
    np.add.at(total, owner, need)
    return total, sizes, lettered


def predict(texts: list[str], samples: Samples) -> tuple[list[str], list[float]]:
    if not samples.languages:
        return ["und"] * len(texts), [0.0] * len(texts)
    total, sizes, lettered = phrases(texts, samples)
    rates = total / np.maximum(sizes, 1)[:, None]
    best = rates.argmin(1)
    likely = np.exp(-SHARP * (rates - rates.min(1, keepdims=True)))
    score = 1 / likely.sum(1)
    names = [samples.languages[k] if ok else "und" for k, ok in zip(best, lettered, strict=True)]
    return names, [float(s) if ok else 0.0 for s, ok in zip(score, lettered, strict=True)]


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of a column of at most about two million bytes, or one text."""
    widths = pc.fill_null(pc.binary_length(column), 0).to_numpy()
    begin, held = 0, 0
    for i, w in enumerate(widths):
        if held and held + w > 2_000_000:
            yield begin, [x or "" for x in column[begin:i].to_pylist()]
            begin, held = i, 0
        held += int(w)
    yield begin, [x or "" for x in column[begin:].to_pylist()]


def identify(df: DataFrame, samples: Samples, text: str = "text", into: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """All columns of ``df`` with the language and its score in the columns ``into``, which replace others of these names."""
    kept = [c for c in df.columns if c not in into]
    at = kept.index(text)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            names: list[str] = []
            scores: list[float] = []
            for _, texts in _texts(batch.column(at)):
                a, b = predict(texts, samples)
                names, scores = names + a, scores + b
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *into])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    return map_batches(df.select(*kept), batches, f"{fields}, `{into[0]}` string, `{into[1]}` double")


def known_language(df: DataFrame, samples: Samples) -> DataFrame:
    """The rows whose text is in a language at all (not ``und``), in their columns."""
    into = ("_language", "_likelihood")
    kept = [F.col(f"`{c}`") for c in df.columns]
    free = tuple(n + "_" * max(1, *map(len, df.columns)) for n in into)
    return identify(df, samples, into=free).where(F.col(free[0]) != "und").select(*kept)
