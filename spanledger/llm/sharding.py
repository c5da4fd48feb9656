"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws
``-ln(u) / weight`` with ``u`` hashed from the key and the child alone, and the
least draw wins, so a child is chosen in proportion to its weight and a row
changes branch only where a weight on the path of its old or new branch
changed. A shard added by ``grow`` is a region of its own: all draws made
before stay as they were, so one more shard takes rows only into itself.

Defined results: a NULL key is a key like any other (all such rows share a
shard); equal keys share a shard; an empty table gives no rows; a column of
the table that is named like a result is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.session import shared_folder

ROWS_PER_CHUNK = 1_000_000


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def base_tree(shards: int = 24, racks_per_region: int = 2, shards_per_rack: int = 4) -> list[Leaf]:
    """A tree of equal shards, filled rack by rack and region by region."""
    per_region = racks_per_region * shards_per_rack
    return [Leaf(s // per_region, s // shards_per_rack, s) for s in range(shards)]


def grow(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, the only leaf of a new region."""
    return [*tree, Leaf(*(max(getattr(x, n) for x in tree) + 1 for n in ("region", "rack", "shard")), weight)]


def _draw(key: Column, level: str, node: int, weight: float) -> Column:
    # The low 53 bits, moved off zero, are a uniform number below 1.
    bits = F.xxhash64(F.lit(level), F.lit(node), key).bitwiseAND(F.lit((1 << 53) - 1))
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _winner(key: Column, level: str, weights: dict[int, float]) -> Column:
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    draws = [F.struct(_draw(key, level, n, w).alias("draw"), F.lit(n).alias("node")) for n, w in sorted(weights.items())]
    return F.array_min(F.array(*draws))["node"]


def _weights(leaves: list[Leaf], level: str) -> dict[int, float]:
    out: dict[int, float] = {}
    for x in leaves:
        if x.weight > 0:
            out[getattr(x, level)] = out.get(getattr(x, level), 0.0) + x.weight
    return out


def _descend(df: DataFrame, key: Column, leaves: list[Leaf], parent: str, level: str) -> Column:
    """The child at ``level``, drawn among the children of the row's ``parent`` only."""
    groups: dict[int, list[Leaf]] = {}
    for x in leaves:
        groups.setdefault(getattr(x, parent), []).append(x)
    cases = [(F.col(f"_{parent}") == n, _winner(key, level, w)) for n, g in sorted(groups.items()) if (w := _weights(g, level))]
    return reduce(lambda case, x: case.when(*x), cases[1:], F.when(*cases[0]))


def place(df: DataFrame, key: str, tree: list[Leaf], into: str = "shard") -> DataFrame:
    """``df`` with the shard of every row in column ``into``; no row moves between tasks."""
    k = F.col(key)
    out = df.withColumn("_region", _winner(k, "region", _weights(tree, "region")))
    out = out.withColumn("_rack", _descend(out, k, tree, "region", "rack"))
    return out.withColumn(into, _descend(out, k, tree, "rack", "shard").cast("int")).drop("_region", "_rack")


def number_slots(df: DataFrame, shard: str = "shard", into: str = "slot") -> DataFrame:
    """``df`` with a gapless number from 0 within each shard.

    The rows are stored first, which gives each a fixed place (file and row).
    A window numbers the rows of one shard within a stretch of at most
    ``ROWS_PER_CHUNK`` rows of one file, and a running count over the
    stretches, which are few, gives each its first number. No window grows
    with a shard or with the copies of a key.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    place_of = [
        F.xxhash64(F.col("_metadata.file_path")).alias("_file"),
        F.expr(f"_metadata.row_index div {ROWS_PER_CHUNK}").alias("_chunk"),
    ]
    kept = [F.col(c) for c in df.columns if c != into]
    read = spark.read.schema(df.schema).parquet(path)
    rows = read.select(*kept, *place_of, F.col("_metadata.row_index").alias("_row"))
    stretch = [shard, "_file", "_chunk"]
    before = Window.partitionBy(shard).orderBy("_file", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*stretch).agg(F.count(F.lit(1)).alias("_n"))
    first = sizes.select(*stretch, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.row_number().over(Window.partitionBy(*stretch).orderBy("_row")) - 1
    numbered = rows.withColumn("_within", within).join(first, stretch)
    return numbered.select(*kept, (F.col("_first") + F.col("_within")).cast("bigint").alias(into))


