"""A fixed-size filter in front of joins that would move whole texts.

The keys of the narrow side set bits of a bitmap of ``BITS`` bits in all, which
is at most 8 MB however many keys there are, and so is broadcast. Rows whose
bit is not set have no partner and need not move; the others, partners and
chance hits alike, go through the exact join. More keys than bits only make the
filter let more rows through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, ROW = 1 << 26, 1 << 15


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def flagged(df: DataFrame, key: Column, keys: DataFrame, into: str) -> DataFrame:
    """``df`` with a boolean that is true wherever ``key`` may be among the values of the one column of ``keys``."""
    place = _place(F.col(f"`{keys.columns[0]}`"))
    part, bits = f"{into}_part", f"{into}_bits"
    rows = keys.select((place / ROW).cast("int").alias(part), (place % ROW).alias("place"))
    bitmap = rows.groupBy(part).agg(F.expr("bitmap_construct_agg(place)").alias(bits))
    at = _place(key) % ROW
    byte = F.conv(F.hex(F.substring(F.col(bits), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    found = df.withColumn(part, (_place(key) / ROW).cast("int")).join(F.broadcast(bitmap), part, "left")
    return found.withColumn(into, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop(part, bits)


def without(df: DataFrame, key: Column, keys: DataFrame, same: Column | None = None) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not in ``keys`` (whose columns no column of ``df`` is named like).

    ``same`` is the exact condition, by default equality with the first column of ``keys``.
    """
    flag = "_maybe" + "_" * max(map(len, df.columns))
    marked = flagged(df, key, keys.select(keys.columns[0]), flag)
    same = (key == F.col(keys.columns[0])) if same is None else same
    some = marked.where(flag).join(keys.hint("merge"), same, "left_anti")
    return marked.where(~F.col(flag)).unionByName(some).drop(flag)
