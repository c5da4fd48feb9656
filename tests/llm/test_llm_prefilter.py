"""The bitmap in front of joins."""

from pyspark.sql import functions as F

from spanledger.llm.prefilter import flagged, without


def test_no_partner_is_lost_and_few_others_pass(spark):
    rows = spark.range(20_000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("key"))
    keys = rows.where("id % 40 = 0").select(F.col("key").alias("k"))
    marked = flagged(rows, F.col("key"), keys, "maybe")
    assert marked.columns == [*rows.columns, "maybe"]
    assert marked.where("id % 40 = 0 AND NOT maybe").count() == 0
    assert marked.where("maybe").count() <= 510


def test_without_is_an_exact_anti_join(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "key string, v int")
    keys = spark.createDataFrame([("a",), ("z",)], "k string")
    assert sorted(r.v for r in without(rows, F.col("key"), keys).collect()) == [2, 4]
    assert without(rows, F.col("key"), keys.limit(0)).count() == 4
    assert without(rows.limit(0), F.col("key"), keys).count() == 0
    same = (F.col("key") == F.col("k")) & (F.col("v") == F.col("w"))
    pairs = spark.createDataFrame([("a", 1)], "k string, w int")
    assert sorted(r.v for r in without(rows, F.col("key"), pairs, same).collect()) == [2, 3, 4]
