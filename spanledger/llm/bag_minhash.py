"""MinHash near-duplicates of weighted sets: BagMinHash signatures, bands, exact verification.

A text is the multiset of its runs of five words (a shorter text, but not an
empty one, is one run). Its similarity to another is the weighted Jaccard
index: the sum of the lesser counts over the sum of the greater ones.

The weights of a run, ``[0, count)``, are cut into the dyadic intervals
``[0, 1), [1, 2), [2, 4), ...``; each interval of each run has a Poisson
process of its own, whose points are hashed from the run, the interval and the
point's number: a time, a slot and a weight. Points beyond the count are
skipped, and a slot keeps its earliest point. Two texts agree in a slot with
the probability of their similarity. Points later than a bound that follows
from the total weight cannot be the earliest and are never made.

Equal texts are put together first. Of the others, those that agree in a band
are candidates. First each meets the likeliest of the members drawn by a hash,
one a bucket; this joins large groups of like texts into one part. Then, across
the parts that these links leave, all pairs of a small bucket meet, which is a
bounded number a member. What larger buckets still hold in different parts is
compared pair by pair, block against block, within tasks: by a longer signature,
and where that allows the similarity by the counts of all runs of both texts. A
task gives only links that join two parts, so what leaves it is at most a link a
member, however many pairs it has looked at. None is left out; a pair within a
part needs no test. Classes are the connected components of the verified links.

Defined results: NULL text counts as empty; texts without words are copies of
each other only if equal; a class is named by its least non-NULL id; one row of
each class is kept, that of the least id (of equal rows any one).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.llm import words
from spanledger.llm.batches import map_batches
from spanledger.llm.prefilter import flagged, without
from spanledger.llm.white import spread
from spanledger.session import stored

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 32, 6
SLOTS = BANDS * ROWS
# Members of a small bucket; members and runs of a block of a larger one.
SMALL, BLOCK, BLOCK_RUNS = 16, 512, 400_000
# Below the mean of the share of equal bytes at SIMILAR by 4.5 standard deviations.
LEAST_EQUAL = int(SLOTS * (SIMILAR + (1 - SIMILAR) / 256) - 4.5 * (SLOTS * SIMILAR * (1 - SIMILAR)) ** 0.5)
# The same for the share of equal low bits.
LEAST_BITS = int(SLOTS * (1 + SIMILAR) / 2 - 4.5 * (SLOTS * (1 + SIMILAR) / 2 * (1 - SIMILAR) / 2) ** 0.5)
# Slots of the longer signature of members of large buckets, and the same for its bits (about similarity 0.74).
LONG = 2048
LEAST_LONG = int(LONG * (1 + SIMILAR) / 2 - 4.5 * (LONG * (1 + SIMILAR) / 2 * (1 - SIMILAR) / 2) ** 0.5)
WORDS = SLOTS // 64
BATCH = 1_000_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits look random."""
    x = x + _A
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct runs of each text: owner (ascending), hash and count."""
    column, bounds = words.split(texts)
    h = words.hashes(column)
    n = np.diff(bounds)
    k = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), k)
    first = np.repeat(bounds[:-1], k) + np.arange(int(k.sum())) - np.repeat(k.cumsum() - k, k)
    end = np.minimum(first + SHINGLE, np.repeat(bounds[1:], k))
    run = np.zeros(len(first), np.uint64)
    for j in range(SHINGLE):
        inside = first + j < end
        run[inside] = mix(run[inside] ^ h[(first + j)[inside]])
    order = np.lexsort((run, owner))
    owner, run = owner[order], run[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], run[at], np.diff(np.append(at, len(run)))


def _points(owner: np.ndarray, run: np.ndarray, count: np.ndarray, bound: np.ndarray, times: np.ndarray, marks: np.ndarray) -> None:
    """Put the earliest point of each slot before the texts' bounds into ``times`` and ``marks`` (one row a text)."""
    level, cells, slots = 0, [], times.shape[1]
    left = np.arange(len(run))
    while len(left):
        low = 0 if level == 0 else 1 << (level - 1)
        left = left[count[left] > low]
        cells.append((left, np.full(len(left), level)))
        level += 1
    of = np.concatenate([c for c, _ in cells])
    level_of = np.concatenate([x for _, x in cells])
    low = np.where(level_of == 0, 0, 2.0 ** (level_of - 1))
    width = np.maximum(low, 1.0)
    seed = mix(run[of] ^ (level_of.astype(np.uint64) * _C))
    own, most = owner[of], count[of]
    time, latest = np.zeros(len(of)), bound[own]
    flat_times, flat_marks = times.reshape(-1), marks.reshape(-1)
    number = 0
    while len(own):
        number += 1
        here = mix(seed + np.uint64(number * int(_B) % 2**64))
        time = time - np.log(_unit(here)) / (slots * width)
        keep = time < latest
        seed, own, most, time, latest, low, width = (x[keep] for x in (seed, own, most, time, latest, low, width))
        other = mix(here[keep] ^ _A)
        inside = low + width * _unit(mix(other)) < most
        slot = own[inside] * slots + (other[inside] % np.uint64(slots)).astype(np.int64)
        when, mark = time[inside], other[inside] >> np.uint64(8)
        # Within a round a slot may be met more than once: the least time, then its mark.
        np.minimum.at(flat_times, slot, when)
        first = flat_times[slot] == when
        flat_marks[slot[first]] = mark[first]


def signatures(owner: np.ndarray, run: np.ndarray, count: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` marks for each of ``n`` texts; all zero for a text without runs."""
    total = np.bincount(owner, count, n)
    marks = np.zeros((n, slots), np.uint64)
    times = np.full((n, slots), np.inf)
    todo = np.flatnonzero(total > 0)
    reach = np.log(slots) + 3.0
    while len(todo):
        part = np.isin(owner, todo)
        bound = reach / np.maximum(total, 1)
        _points(owner[part], run[part], count[part], bound, times, marks)
        todo = todo[np.isinf(times[todo]).any(1)]
        times[todo] = np.inf
        reach *= 2
    return marks


def bands(marks: np.ndarray) -> np.ndarray:
    """One key for each band of each text."""
    rows = marks.reshape(len(marks), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for j in range(ROWS):
        key = mix(key ^ rows[:, :, j])
    return key.view(np.int64)


def similarity(texts_a: list[str], texts_b: list[str]) -> np.ndarray:
    """The weighted Jaccard index of each pair; 0 where a text has no words. Each distinct text is cut into runs once."""
    place = {t: i for i, t in enumerate(dict.fromkeys([*texts_a, *texts_b]))}
    owner, run, count = shingles(pa.array(list(place), pa.large_string()))
    at = np.searchsorted(owner, np.arange(len(place) + 1))
    out = np.zeros(len(texts_a))
    for i, (a, b) in enumerate(zip(texts_a, texts_b, strict=True)):
        x, y = (slice(at[place[t]], at[place[t] + 1]) for t in (a, b))
        # Runs of a text are sorted and distinct.
        k = np.searchsorted(run[y], run[x])
        k[k == y.stop - y.start] = 0
        same = run[y][k] == run[x] if y.stop > y.start else np.zeros(x.stop - x.start, bool)
        less = int(np.minimum(count[x][same], count[y][k[same]]).sum())
        whole = int(count[x].sum() + count[y].sum()) - less
        out[i] = less / whole if whole else 0.0
    return out


def digest(text: Column) -> Column:
    """128 bits that stand for a whole text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


SIGNATURE = "digest binary, weight bigint, keys array<bigint>, bits array<bigint>, sketch binary"


def sign(docs: DataFrame) -> DataFrame:
    """One row per distinct text that has words: digest, runs, band keys, and a bit and a byte of each slot."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, b in words.runs(batch.column(1), BATCH):
                names, texts = batch.column(0)[a:b], batch.column(1)[a:b]
                first = pa.array(np.unique(names.to_numpy(zero_copy_only=False).astype("S16"), return_index=True)[1])
                names, texts = names.take(first), texts.take(first)
                owner, run, count = shingles(texts)
                total = np.bincount(owner, count, len(texts)).astype(np.int64)
                marks = signatures(owner, run, count, len(texts))
                some = np.flatnonzero(total > 0)
                keys = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(some) + 1) * BANDS, pa.int32()), pa.array(bands(marks[some]).reshape(-1), pa.int64())
                )
                packed = np.packbits((marks[some] & np.uint64(1)).astype(np.uint8), axis=1).reshape(-1).view(np.int64)
                bits = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * WORDS, pa.int32()), pa.array(packed, pa.int64()))
                sketch = pa.array([x.tobytes() for x in (marks[some] & np.uint64(255)).astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(some)).cast(pa.binary()), pa.array(total[some], pa.int64()), keys, bits, sketch],
                    ["digest", "weight", "keys", "bits", "sketch"],
                )

    return map_batches(docs.select(digest(F.col("text")).alias("digest"), F.coalesce("text", F.lit("")).alias("text")), batches, SIGNATURE)


def buckets(signed: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one, stored: bucket, node, weight, bits, size ``n``, ``blocks`` and a ``pivot`` drawn by a hash."""
    each = signed.select("node", "weight", *[F.col("bits")[k].alias(f"b{k}") for k in range(WORDS)], F.explode("keys").alias("bucket"))
    drawn = F.min(F.struct(F.xxhash64("node", "bucket").alias("h"), "node", "weight", *BIT_NAMES)).alias("pivot")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("weight") / BLOCK_RUNS)).cast("int").alias("blocks")
    sizes = stored(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), blocks, drawn).where(F.col("n") > 1))
    return stored(each.join(sizes.hint("merge"), "bucket"))


BIT_NAMES = [f"b{k}" for k in range(WORDS)]


def _equal(other: str) -> Column:
    """Equal low bits of a row's slots and those of another node, whose columns are named with a mark."""
    return reduce(lambda a, b: a - b, [F.bit_count(F.col(b).bitwiseXOR(F.col(f"{other}{b}"))) for b in BIT_NAMES], F.lit(SLOTS))


def _near(node: str, other: str) -> Column:
    """Two different nodes whose weights and bits allow the similarity."""
    weights = F.least("weight", f"{other}weight") >= SIMILAR * F.greatest("weight", f"{other}weight")
    return (F.col(node) != F.col(f"{other}{node}")) & weights & (_equal(other) >= LEAST_BITS)


def _ordered(other: str) -> list[Column]:
    return [F.least("node", f"{other}node").alias("a"), F.greatest("node", f"{other}node").alias("b"), _equal(other).alias("equal")]


def with_pivots(members: DataFrame) -> DataFrame:
    """Candidates (``a``, ``b``, ``equal``): each member of a bucket with the bucket's pivot, stored."""
    return stored(members.where(_near("node", "pivot.")).select(*_ordered("pivot.")).distinct())


def in_parts(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of the buckets that hold several of the ``parts`` (node, least), each with its own, stored."""
    held = members.drop("pivot", "least").join(parts.hint("merge"), "node", "left")
    held = stored(held.withColumn("least", F.coalesce("least", "node")))
    several = held.groupBy("bucket").agg(F.min("least").alias("l"), F.max("least").alias("m")).where("l <> m").select("bucket")
    return stored(held.join(stored(several).hint("merge"), "bucket"))


def across_parts(held: DataFrame, signed: DataFrame) -> DataFrame:
    """Candidates between members of a small bucket that lie in different parts, stored: each pair of a bucket once."""
    small = held.where(F.col("n") <= SMALL)
    return _by_sketch(_meeting(small, small, F.col("node") < F.col("_node")).select("a", "b").distinct(), signed)


def fine(texts: DataFrame) -> DataFrame:
    """Of texts (node, text): ``node``, a bit of each slot of the longer signature (``long``), and the hashes (``runs``, ascending)
    and counts of all runs, stored."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for a, b in words.runs(batch.column(1), BATCH):
                for k in range(a, b, BLOCK):
                    part = batch.slice(k, min(b - k, BLOCK))
                    owner, run, count = shingles(part.column(1))
                    marks = signatures(owner, run, count, part.num_rows, LONG)
                    # The lowest bits of a mark follow from its slot.
                    packed = np.packbits((marks >> np.uint64(32) & np.uint64(1)).astype(np.uint8), axis=1)
                    at = np.searchsorted(owner, np.arange(part.num_rows + 1)).tolist()
                    spans = [slice(i, j) for i, j in zip(at[:-1], at[1:], strict=True)]
                    columns = [[x.tobytes() for x in packed], [run[i].tobytes() for i in spans], [count[i].astype(np.int32).tobytes() for i in spans]]
                    yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.binary()) for x in columns)], ["node", "long", "runs", "counts"])

    return stored(map_batches(texts.select("node", "text"), batches, "node bigint, long binary, runs binary, counts binary"))


def across_blocks(held: DataFrame, signed: DataFrame, finer: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) that join parts, found among all pairs of members of a bucket that lie in different parts; stored.

    A bucket's members are dealt into blocks of some hundred members and runs, and every two blocks meet in a
    group of their own, so no task holds a whole bucket. A pair is tested in the first bucket it shares. Parts
    that a group has joined count as one part in it from there on.
    """
    own = held.select("bucket", "node", "weight", "least", "blocks")
    own = own.withColumn("block", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int"))
    met = own.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("bucket", "node", "weight", "least", "block", F.least("block", "j").alias("lo"), F.greatest("block", "j").alias("hi"))
    marks = stored(finer.join(signed.select("node", "keys").hint("merge"), "node"))
    every = met.join(marks.hint("merge"), "node")

    def compare(table: pa.Table) -> pa.Table:
        node, weight, least, block, bucket = (table[c].to_numpy() for c in ("node", "weight", "least", "block", "bucket"))
        keys = table["keys"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        long = np.frombuffer(b"".join(table["long"].to_pylist()), np.uint64).reshape(-1, LONG // 64)
        held = table["runs"].to_pylist()
        size = np.fromiter(map(len, held), np.int64, len(held)) // 8
        run, count = np.frombuffer(b"".join(held), np.uint64), np.frombuffer(b"".join(table["counts"].to_pylist()), np.int32)
        at = size.cumsum() - size
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        x, y = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        part = np.unique(least, return_inverse=True)[1]
        found = []
        for k in range(0, len(x) if len(y) else 0, 16):
            i = x[k : k + 16, None]
            light, heavy = np.minimum(weight[i], weight[y]), np.maximum(weight[i], weight[y])
            may = (part[i] != part[y]) & (light >= SIMILAR * heavy) & ((lo != hi) | (node[i] < node[y]))
            p, q = np.nonzero(may)
            p, q = i[p, 0], y[q]
            near = LONG - np.bitwise_count(long[p] ^ long[q]).sum(1, dtype=np.int64) >= LEAST_LONG
            p, q = p[near], q[near]
            first = keys[p, (keys[p] == keys[q]).argmax(1)] == bucket[p]
            p, q = p[first], q[first]
            for one in np.unique(p).tolist():
                others = q[p == one]
                others = others[part[others] != part[one]]
                if not len(others):
                    continue
                mine, my = run[at[one] : at[one] + size[one]], count[at[one] : at[one] + size[one]]
                index = spread(at[others], size[others])
                place = np.minimum(np.searchsorted(mine, run[index]), len(mine) - 1)
                both = np.where(mine[place] == run[index], np.minimum(my[place], count[index]), 0)
                less = np.add.reduceat(both, size[others].cumsum() - size[others])
                for other in others[less / (weight[one] + weight[others] - less) >= SIMILAR].tolist():
                    if part[other] != part[one]:
                        part[part == part[other]] = part[one]
                        found.append((min(node[one], node[other]), max(node[one], node[other])))
        out = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": out[:, 0], "b": out[:, 1]})

    return stored(every.groupBy("bucket", "lo", "hi").applyInArrow(compare, "a bigint, b bigint"))


def _meeting(members: DataFrame, others: DataFrame, which: Column) -> DataFrame:
    """Candidates between members and others of a bucket that lie in different parts."""
    other = others.select(*[F.col(c).alias(f"_{c}") for c in ("bucket", "node", "weight", "least", *BIT_NAMES)])
    same = (F.col("bucket") == F.col("_bucket")) & (F.col("least") != F.col("_least")) & which
    return members.join(other.hint("merge"), same & _near("node", "_")).select(*_ordered("_"))


def _by_sketch(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs whose sketches allow the similarity, stored."""
    left = signed.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = signed.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))

    @F.pandas_udf("int")
    def equal(x, y):
        import pandas as pd

        return pd.Series([int((np.frombuffer(p, np.uint8) == np.frombuffer(q, np.uint8)).sum()) for p, q in zip(x, y, strict=True)], dtype="int32")

    joined = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return stored(joined.where(equal("sa", "sb") >= LEAST_EQUAL).select("a", "b"))


def texts_of(pairs: DataFrame, signed: DataFrame, docs: DataFrame) -> DataFrame:
    """Whole texts (``node``, ``text``) of the nodes in the pairs, stored; texts of other nodes don't move."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    named = stored(signed.select("node", "digest").join(nodes.hint("merge"), "node"))
    every = docs.select(digest(F.col("text")).alias("digest"), "text")
    some = flagged(every, F.col("digest"), named.select("digest"), "maybe").where("maybe").drop("maybe")
    return stored(some.join(named.hint("merge"), "digest").groupBy("node").agg(F.first("text").alias("text")))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of nodes whose whole texts are similar, stored. ``texts``: node, text."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    @F.pandas_udf("double")
    def compare(x, y):
        import pandas as pd

        return pd.Series(similarity(list(x), list(y)))

    joined = pairs.select("a", "b").join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return stored(joined.select("a", "b", compare("ta", "tb").alias("similarity")).where(F.col("similarity") >= SIMILAR))


def components(links: DataFrame) -> DataFrame:
    """The least node (``least``) of the connected component of every node in the links (``a``, ``b``), stored.

    Each round takes the least label among the neighbours, then the label of that label. Labels only
    become less, so an unchanged sum ends it.
    """
    edges = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("least")))
    total = None
    while total != (total := labels.agg(F.sum(F.col("least").cast("decimal(38,0)"))).first()[0]):
        near = edges.join(labels.select(F.col("node").alias("b"), "least"), "b").select(F.col("a").alias("node"), "least")
        best = stored(near.union(labels.select("node", "least")).groupBy("node").agg(F.min("least").alias("least")))
        jump = best.select(F.col("node").alias("least"), F.col("least").alias("further"))
        labels = stored(best.join(jump, "least").select("node", F.least("least", "further").alias("least")))
    return labels


def classes(docs: DataFrame) -> DataFrame:
    """Digest and component of every text that is linked to another one, stored: ``digest``, ``least``."""
    unique = sign(docs).dropDuplicates(["digest"])
    signed = stored(unique.withColumn("node", F.monotonically_increasing_id()))
    members = buckets(signed)
    # First the best candidate of every node, then what small buckets hold across the parts this gives, then
    # what larger ones do: each step leaves fewer pairs to the next.
    best = likeliest(with_pivots(members))
    links = verified(best, texts_of(best, signed, docs))
    parts = components(links)
    held = in_parts(members, parts)
    rest = stored(across_parts(held, signed).join(best, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        links = links.unionByName(verified(rest, texts_of(rest, signed, docs)))
        parts = components(links)
    large = held.where(F.col("n") > SMALL)
    held = large if large.isEmpty() else in_parts(large, parts)
    if not held.isEmpty():
        nodes = stored(held.select("node").distinct())
        finer = fine(texts_of(nodes.select(F.col("node").alias("a"), F.col("node").alias("b")), signed, docs))
        parts = components(links.select("a", "b").unionByName(across_blocks(held, signed, finer)))
    return stored(signed.select("node", "digest").join(parts.hint("merge"), "node").select("digest", "least"))


def likeliest(near: DataFrame) -> DataFrame:
    """Of the candidates (``a``, ``b``, ``equal``) the best one of every node, stored."""
    ends = near.select("a", "b", "equal", F.explode(F.array("a", "b")).alias("node"))
    best = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("equal", -F.col("a"), -F.col("b"))).alias("p"))
    return stored(best.select("p.a", "p.b").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row's ``doc_id`` and text digest with its class: ``class_id``, ``class_digest`` of the row that stays."""
    found = classes(docs)
    keyed = docs.select("doc_id", digest(F.col("text")).alias("digest"))
    exact = keyed.groupBy("digest").agg(F.min("doc_id").alias("own"), F.count(F.lit(1)).alias("copies"))
    texts = stored(exact.join(found.hint("merge"), "digest", "left"))
    # A class of one text is named by that text, a linked one by its component.
    name = F.coalesce(F.col("least").cast("string"), F.hex("digest"))
    whole = texts.groupBy(name.alias("name")).agg(
        F.min("own").alias("class_id"), F.sum("copies").alias("class_rows"), F.min(F.struct(F.col("own").isNull(), "own", "digest"))["digest"].alias("class_digest")
    )
    of_text = stored(texts.select("digest", name.alias("name")).join(whole, "name").drop("name"))
    return keyed.join(of_text.hint("merge"), "digest")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each class, in all columns of ``docs``.

    What is left out is found on ids and digests; rows that equal the one that stays in both are told apart last.
    """
    rows = near_duplicates(docs)
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("class_digest"))
    judged = stored(rows.groupBy("doc_id", "digest").agg(F.max(stays).alias("stays"), F.count(F.lit(1)).alias("n")))
    name, d, i = (n + "_" * max(map(len, docs.columns)) for n in ("_digest", "_d", "_i"))  # no column is named so
    tagged = docs.withColumn(name, digest(F.col("text")))
    same = (F.col(name) == F.col(d)) & F.col("doc_id").eqNullSafe(F.col(i))
    short = [F.col("digest").alias(d), F.col("doc_id").alias(i)]
    kept = without(tagged, F.col(name), judged.where(~F.col("stays")).select(*short), same)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    repeated = judged.where(F.col("stays") & (F.col("n") > 1)).select(*short)
    if repeated.isEmpty():
        return kept.select(*columns)
    one = kept.join(repeated, same, "left_semi").dropDuplicates([name]).select(*columns)
    return kept.join(repeated, same, "left_anti").select(*columns).unionByName(one)
