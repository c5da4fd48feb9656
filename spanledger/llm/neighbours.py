"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Equal vectors become one node. A first graph joins the nodes of random leaves
(signs of random projections, large leaves cut in pieces). Each round then joins
every node with its neighbours and the nodes that have it as neighbour, compares
those with each other (neighbours of neighbours), and keeps the best ``DEGREE`` of
every node, until few change. A search starts at given nodes and expands the best
nodes not yet expanded, until those within its beam all are. Graph and search
compare unit vectors in single precision; the results are scored on the original
vectors in double precision.

Bounds: a node takes part in at most ``MEMBERS`` neighbours a round, new ones
first, which NN-descent makes up for in later rounds; no group grows with copies
of a vector. In the search a popular node leads to all that have it as neighbour.

Defined results: vectors that are NULL, zero, of another length than most, or
with NULL or non-finite components take no part; copies are neighbours of each
other with cosine 1; ties go to the smaller id; fewer candidates than asked for
are all returned; repeated ids count as one vector each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.llm.batches import map_batches
from spanledger.session import stored

DEGREE, MEMBERS, SENT = 32, 64, 6
TABLES, LEAF, PIECE, FIRST = 4, 200, 512, 12
ROUNDS, SETTLED = 8, 0.4
BEAM, EXPAND = 256, 32
GROUP = 400


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that take part."""
    rows = vectors.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding"))).select("vec_id", "embedding")
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (common["n"] if common else 0)).distinct()


def coded(rows: DataFrame) -> DataFrame:
    """``node``, ``code``: the bytes of each vector as a unit vector in single precision."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                x = np.stack(part.column(1).to_numpy(zero_copy_only=False)).astype(np.float64)
                x = x / np.abs(x).max(1, keepdims=True)  # so that no square is out of range
                codes = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.tobytes() for c in codes], pa.binary())], ["node", "code"])

    return map_batches(rows, batches, "node bigint, code binary")


def _units(codes: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), np.float32).reshape(len(codes), -1)


def _best(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the ``k`` greatest entries above -2 of each row."""
    k = min(k, sims.shape[1])
    at = np.argpartition(-sims, k - 1, 1)[:, :k] if k < sims.shape[1] else np.tile(np.arange(k), (len(sims), 1))
    value = np.take_along_axis(sims, at, 1)
    row, column = np.nonzero(value > -2)
    return row, at[row, column], value[row, column]


_EDGE = pa.schema([("v", pa.int64()), ("u", pa.int64()), ("s", pa.float32())])


def _edges(parts: list[tuple]) -> pa.Table:
    columns = [np.concatenate([p[i] for p in parts]) if parts else [] for i in range(3)]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _EDGE, strict=True)], schema=_EDGE)


def leaves(nodes: DataFrame, count: int) -> DataFrame:
    """``t``, ``leaf`` of every node in each table of random leaves."""
    bits = max(0, int(np.ceil(np.log2(max(count, 1) / LEAF))))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                x = _units(part.column(1))
                for t in range(TABLES):
                    planes = np.random.default_rng(t).standard_normal((x.shape[1], bits)).astype(np.float32)
                    leaf = ((x @ planes) > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t), pa.int32()), pa.array(leaf, pa.int64()), part.column(0), part.column(1)], ["t", "leaf", "node", "code"]
                    )

    return map_batches(nodes.select("node", "code"), batches, "t int, leaf bigint, node bigint, code binary")


def _first_edges(in_leaves: DataFrame) -> DataFrame:
    sizes = stored(in_leaves.groupBy("t", "leaf").count())
    piece = F.pmod(F.xxhash64("node", "t"), F.ceil(F.col("count") / PIECE)).alias("piece")
    cut = in_leaves.join(sizes, ["t", "leaf"]).select("t", "leaf", piece, "node", "code")

    def join(part: pa.Table) -> pa.Table:
        part = part.sort_by("node")
        node, x = part["node"].to_numpy(), _units(part["code"])
        sims = x @ x.T
        np.fill_diagonal(sims, -9)
        row, column, value = _best(sims, FIRST)
        return _edges([(node[row], node[column], value)])

    return cut.groupBy("t", "leaf", "piece").applyInArrow(join, "v bigint, u bigint, s float")


def _kept(edges: DataFrame, buckets: int) -> DataFrame:
    """The best ``DEGREE`` edges of each node; an edge that was there before is not ``new``."""

    def best(part: pa.Table) -> pa.Table:
        v, u, s, new = (part[c].to_numpy() for c in ("v", "u", "s", "new"))
        order = np.lexsort((-s, new, u, v))
        v, u, s, new = v[order], u[order], s[order], new[order]
        once = np.ones(len(v), bool)
        once[1:] = (v[1:] != v[:-1]) | (u[1:] != u[:-1])
        v, u, s, new = v[once], u[once], s[once], new[once]
        order = np.lexsort((u, -s, v))
        v, u, s, new = v[order], u[order], s[order], new[order]
        start = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
        rank = np.arange(len(v)) - np.repeat(start, np.diff(np.r_[start, len(v)]))
        k = rank < DEGREE
        return pa.table({"v": v[k], "u": u[k], "s": pa.array(s[k], pa.float32()), "new": pa.array(new[k].astype(bool))})

    keyed = edges.withColumn("g", F.pmod(F.xxhash64("v"), F.lit(buckets)))
    return keyed.groupBy("g").applyInArrow(best, "v bigint, u bigint, s float, new boolean")


def _both_ways(graph: DataFrame) -> DataFrame:
    back = graph.select(F.col("u").alias("c"), F.col("v").alias("m"), "new")
    return graph.select(F.col("v").alias("c"), F.col("u").alias("m"), "new").unionByName(back)


def _members(graph: DataFrame, seed: int) -> DataFrame:
    """At most ``MEMBERS`` neighbours, either way, of each centre ``c``: the new first, then by a hash."""
    first = Window.partitionBy("c").orderBy(F.desc("new"), F.xxhash64("c", "m", F.lit(seed)), "m")
    return _both_ways(graph).withColumn("r", F.row_number().over(first)).where(F.col("r") <= MEMBERS).drop("r")


def _improved(members: DataFrame, nodes: DataFrame, graph: DataFrame, buckets: int) -> DataFrame:
    """Better edges among the members of each centre."""
    worst = graph.groupBy("v").agg(F.when(F.count(F.lit(1)) >= DEGREE, F.min("s")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    known = stored(nodes.join(worst, nodes["node"] == worst["v"], "left").select(F.col("node").alias("m"), "code", F.coalesce("worst", F.lit(-2.0)).alias("worst")))
    asked = members.join(known, "m").withColumn("g", F.pmod(F.xxhash64("c"), F.lit(buckets)))

    def join(part: pa.Table) -> pa.Table:
        part = part.sort_by([("c", "ascending"), ("m", "ascending")])
        c, m, new, worst = (part[x].to_numpy() for x in ("c", "m", "new", "worst"))
        x = _units(part["code"])
        start = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        found = []
        for a, b in zip(start, np.r_[start[1:], len(c)], strict=True):
            node, fresh = m[a:b], new[a:b]
            sims = x[a:b] @ x[a:b].T
            able = (sims > worst[a:b, None]) & (fresh[:, None] | fresh[None, :]) & (node[:, None] != node[None, :])
            row, column, value = _best(np.where(able, sims, -9), SENT)
            found.append((node[row], node[column], value))
        return _edges(found)

    return asked.select("g", "c", "m", "new", "worst", "code").groupBy("g").applyInArrow(join, "v bigint, u bigint, s float")


def build(nodes: DataFrame) -> DataFrame:
    """The neighbour graph (``v``, ``u``, ``s``) of stored nodes, stored."""
    count = nodes.count()
    buckets = max(1, count // GROUP)
    first = _first_edges(stored(leaves(nodes, count)))
    graph = stored(_kept(first.withColumn("new", F.lit(True)), buckets))
    for k in range(ROUNDS):
        better = _improved(_members(graph, k), nodes, graph, buckets).withColumn("new", F.lit(True))
        graph = stored(_kept(graph.withColumn("new", F.lit(False)).unionByName(better), buckets))
        if graph.where("new").count() <= SETTLED * count:
            break
    return graph


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, entries: DataFrame) -> DataFrame:
    """The beam of every query (``q``, ``node``), by greedy expansion from the entries (``q``, ``node``).

    ``queries``: ``q``, ``code``. A query's rows stay within its beam and what one step adds.
    """
    count = queries.count()
    buckets = max(1, count // 64)
    near = stored(_both_ways(graph.withColumn("new", F.lit(False))).select(F.col("c").alias("node"), "m").distinct())
    codes = queries.withColumnsRenamed({"code": "asked"})
    fields = "q bigint, node bigint, s float, open boolean, pick boolean"
    key = F.pmod(F.xxhash64("q"), F.lit(buckets)).alias("g")

    def merge(part: pa.Table) -> pa.Table:
        q, node, s, opened = (part[x].to_numpy(zero_copy_only=False) for x in ("q", "node", "s", "open"))
        s = s.astype(np.float32)
        fresh = np.isnan(s)
        if fresh.any():
            a, b = _units(part["code"].filter(pa.array(fresh))), _units(part["asked"].filter(pa.array(fresh)))
            s[fresh] = (a * b).sum(1)
        order = np.lexsort((opened.astype(bool), node, q))
        q, node, s, opened = q[order], node[order], s[order], opened[order].astype(bool)
        once = np.ones(len(q), bool)
        once[1:] = (q[1:] != q[:-1]) | (node[1:] != node[:-1])
        q, node, s, opened = q[once], node[once], s[once], opened[once]
        order = np.lexsort((node, -s, q))
        q, node, s, opened = q[order], node[order], s[order], opened[order]
        start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        each = np.diff(np.r_[start, len(q)])
        k = np.arange(len(q)) - np.repeat(start, each) < BEAM
        q, node, s, opened = q[k], node[k], s[k], opened[k]
        start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        before = np.cumsum(opened) - opened
        pick = opened & (before - np.repeat(before[start], np.diff(np.r_[start, len(q)])) < EXPAND)
        return pa.table({"q": q, "node": node, "s": pa.array(s, pa.float32()), "open": pa.array(opened & ~pick), "pick": pa.array(pick)})

    none = F.lit(None).cast("float")

    def fresh(rows: DataFrame) -> DataFrame:
        return rows.distinct().join(nodes.select("node", "code"), "node").join(codes, "q").select(key, "q", "node", none.alias("s"), F.lit(True).alias("open"), "code", "asked")

    beam = stored(fresh(entries.select("q", "node")).groupBy("g").applyInArrow(merge, fields))
    # A beam only gets better and a node in it is expanded once, so the steps come to an end.
    while not (picked := beam.where("pick")).isEmpty():
        reached = picked.select("q", "node").join(near, "node").select("q", F.col("m").alias("node"))
        empty = F.lit(None).cast("binary")
        held = beam.select(key, "q", "node", "s", "open", empty.alias("code"), empty.alias("asked"))
        beam = stored(held.unionByName(fresh(reached)).groupBy("g").applyInArrow(merge, fields))
    return beam.select("q", "node")


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def scored(pairs: DataFrame) -> DataFrame:
    """``score`` of pairs of original vectors ``x``, ``y`` in double precision, beside the other columns."""
    kept = [c for c in pairs.columns if c not in ("x", "y")]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                x, y = (np.stack(part.column(c).to_numpy(zero_copy_only=False)) for c in ("x", "y"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(_cosine(x, y))], [*kept, "score"])

    fields = ", ".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in kept)
    return map_batches(pairs, batches, f"{fields}, score double")


def nearest(vectors: DataFrame, asked: Column, k: int = 5) -> DataFrame:
    """The ``k`` nearest rows found for every row that satisfies ``asked``: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    rows = stored(usable(vectors))
    least = Window.partitionBy("embedding").orderBy("vec_id")
    # A query needs at most k other copies of a vector besides itself.
    copies = rows.withColumn("r", F.row_number().over(least)).where(F.col("r") <= k + 1)
    copies = stored(copies.withColumn("node", F.first("vec_id").over(least)))
    distinct = copies.where(F.col("r") == 1)
    nodes = stored(coded(distinct.select("node", "embedding")))
    graph = build(nodes)
    of_query = rows.where(asked).join(distinct.select("node", "embedding"), "embedding").select(F.col("vec_id").alias("query_id"), "node")
    of_query = stored(of_query)
    starts = of_query.select("node").distinct()
    queries = stored(nodes.join(starts, "node").select(F.col("node").alias("q"), "code"))
    found = search(graph, nodes, queries, starts.select(F.col("node").alias("q"), "node"))
    full = distinct.select("node", "embedding")
    pairs = found.join(full.withColumnRenamed("embedding", "y"), "node").join(full.select(F.col("node").alias("q"), F.col("embedding").alias("x")), "q")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    listed = scored(pairs).join(copies.select("node", "vec_id"), "node").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    own = of_query.select("query_id", F.col("node").alias("q")).join(stored(listed.select("q", "vec_id", "score")), "q").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return own.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
