"""Exact sums of texts of digits against Python's integers."""

import random

from pyspark.sql import functions as F

from spanledger.functions.exact import exact_sum, whole_number


def test_sums_of_all_widths(spark):
    rng = random.Random(4)
    groups = {g: [rng.randrange(10 ** rng.choice([1, 8, 9, 38, 39, 78, 80])) for _ in range(rng.randint(1, 60))] for g in range(40)}
    groups[40] = [10**80 - 1] * 500
    groups[41] = [2**256 - 1] * 3
    groups[42] = [0, 0]
    rows = [(g, str(n).zfill(rng.choice([1, 5, 80]))) for g, ns in groups.items() for n in ns]
    got = spark.createDataFrame(rows, "g int, n string").repartition(7).groupBy("g").agg(exact_sum(F.col("n")).alias("total")).collect()
    assert {r.g: int(r.total) for r in got} == {g: sum(ns) for g, ns in groups.items()}
    assert all(r.total == str(int(r.total)) for r in got)


def test_other_texts_are_left_out(spark):
    rows = [(1, None), (1, ""), (1, "-1"), (1, "1.0"), (1, "9" * 81), (1, " 5"), (2, None), (2, "007"), (3, "1e3")]
    df = spark.createDataFrame(rows, "g int, n string")
    got = {r.g: r.total for r in df.groupBy("g").agg(exact_sum(F.col("n")).alias("total")).collect()}
    assert got == {1: None, 2: "7", 3: None}
    assert [r.n for r in df.select(whole_number(F.col("n")).alias("n")).where("n is not null").collect()] == ["7"]
    assert spark.createDataFrame([], "g int, n string").agg(exact_sum(F.col("n")).alias("t")).first().t is None


def test_partial_sums_come_before_the_shuffle(spark):
    plan = spark.range(10).select(F.col("id").cast("string").alias("n")).groupBy("n").agg(exact_sum(F.col("n")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text
