"""Declared rules as data, and their counts taken while a model is written."""

from collections import Counter

from pyspark.sql import functions as F

from spanledger.model_rules import LAYERS, MODEL_RULES, RAW_REQUIRED
from spanledger.operators import rules
from spanledger.operators.rules import Rule

RULES = [
    Rule("staging", "m", "not_null", ("a",)),
    Rule("staging", "m", "not_null", ("b",), where="a > 1", severity="warn"),
    Rule("staging", "m", "accepted_values", ("b",), ("x", "y")),
    Rule("staging", "m", "unique", ("a",)),
    Rule("staging", "m", "unique", ("a", "b"), where="a > 1", severity="warn"),
]
ROWS = [(1, "x"), (1, None), (2, None), (2, None), (3, "z"), (None, "y")]
WANT = {
    "not_null a": ("error", 1, 6, False), "not_null b": ("warn", 2, 6, False), "accepted_values b": ("error", 1, 6, False),
    "unique a": ("error", 2, 5, False), "unique a, b": ("warn", 0, 1, True),
}


def told(report):
    return {r.rule: (r.severity, r.failures, r.checked, r.passed) for r in report.collect()}


def test_as_many_checks_as_declared():
    count = Counter()
    for r in rules.declared_rules():
        count[r.layer] += len(r.chains) or 1
    assert count == {"source": 23, "staging": 484, "intermediate": 73, "marts": 41} and sum(count.values()) == 621
    kinds = Counter()
    for r in rules.declared_rules():
        kinds[r.kind] += len(r.chains) or 1
    assert kinds == {"not_null": 546, "accepted_values": 62, "unique": 13}
    assert {m for models in LAYERS.values() for m in models} == set(MODEL_RULES) and len(RAW_REQUIRED) == 6


def test_rules_by_scan_and_while_writing(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "a int, b string").repartition(3)
    assert told(rules.report(df, "m", RULES)) == WANT
    seen = rules.Observed(df, "m", RULES)
    seen.rows.write.parquet(str(tmp_path / "m"))
    spark.sparkContext.setJobGroup("report", "")
    stored = spark.read.schema(df.schema).parquet(str(tmp_path / "m"))
    report = seen.report(spark, stored)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("report")  # the counts are there already
    assert told(report) == WANT
    plan = report._jdf.queryExecution().sparkPlan().toString()
    spark.sparkContext.setJobGroup("", "")
    assert plan.count("FileScan") == 2 and "ReadSchema: struct<a:int>" in plan  # the two rules of uniqueness alone read the model


def test_nothing_checked_is_not_passed(spark, tmp_path):
    df = spark.createDataFrame([], "a int, b string")
    assert {x[1:] for x in told(rules.report(df, "m", RULES)).values()} == {(0, 0, False)}
    seen = rules.Observed(df, "m", RULES)
    seen.rows.write.parquet(str(tmp_path / "m"))
    assert {x[1:] for x in told(seen.report(spark, df)).values()} == {(0, 0, False)}


def test_chains_without_rows_are_told(spark):
    mine = [
        Rule("staging", "m", "not_null", ("a",), chains=("base", "bsc")),
        Rule("staging", "m", "unique", ("blockchain", "a"), chains=("base", "bsc")),
        Rule("staging", "m", "not_null", ("b",), chains=("base",)),
    ]
    df = spark.createDataFrame([("base", 1, "x"), ("base", 1, None), ("zora", None, None)], "blockchain string, a int, b string")
    got = {(r.chain, r.rule): (r.failures, r.checked, r.passed) for r in rules.report_by_chain(df, "m", mine).collect()}
    assert got == {
        ("base", "not_null a"): (0, 2, True), ("base", "unique blockchain, a"): (1, 2, False), ("base", "not_null b"): (1, 2, False),
        ("bsc", "not_null a"): (0, 0, False), ("bsc", "unique blockchain, a"): (0, 0, False),
    }


def test_counts_stay_exact_over_a_rebalance(spark, tmp_path):
    rows = spark.range(10_000).select((F.col("id") % 7).alias("day"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("a"), F.lit("x").alias("b"))
    seen = rules.Observed(rows.hint("rebalance", "day"), "m", RULES[:1])
    seen.rows.write.partitionBy("day").parquet(str(tmp_path / "m"))
    assert told(seen.report(spark, rows)) == {"not_null a": ("error", 1000, 10_000, False)}
