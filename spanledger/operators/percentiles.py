"""Exact percentiles of values that have no small domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def grouped_percentiles(df: DataFrame, keys: list[str], values: dict[str, Column], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Interpolated percentiles per group, without a group's rows in one task's memory.

    ``values`` names the measured columns, ``wanted`` maps each result to a value
    name and a share. Rows first become counts per (group, value name, value),
    with the value in the shuffle key, so a hot group is spread and combined
    before the ordered pass, which is a running count over sorted rows that
    spills. All values go through one such pass.
    """
    measured = F.array(*[F.struct(F.lit(n).alias("kind"), c.cast("double").alias("v")) for n, c in values.items()])
    rows = df.select(*keys, F.inline(F.filter(measured, lambda x: x["v"].isNotNull())))
    counts = rows.groupBy(*keys, "kind", "v").agg(F.count("*").alias("n"))
    group = W.partitionBy(*keys, "kind")
    ranked = counts.withColumns(
        {
            "upto": F.sum("n").over(group.orderBy("v").rowsBetween(W.unboundedPreceding, 0)),
            "total": F.sum("n").over(group),
        }
    )
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1

    def at(kind: str, rank: Column) -> Column:
        return F.max(F.when((F.col("kind") == kind) & (first <= rank) & (rank <= last), F.col("v")))

    results = []
    for name, (kind, share) in wanted.items():
        place = (F.col("total") - 1) * F.lit(share)
        low, high = at(kind, F.floor(place)), at(kind, F.ceil(place))
        part = F.max(F.when(F.col("kind") == kind, place - F.floor(place)))
        results.append(((F.lit(1.0) - part) * low + part * high).alias(name))
    return ranked.groupBy(*keys).agg(*results)


def grouped_median(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Interpolated median per group."""
    return grouped_percentiles(df, keys, {value: F.col(value)}, {name: (value, 0.5)})
