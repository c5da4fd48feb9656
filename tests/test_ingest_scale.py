"""Copies, bad values, layouts and hot keys."""

from datetime import datetime
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions.numbers import round_half_up
from spanledger.functions.times import text_to_timestamp
from spanledger.operators import ingest, quality, staging
from spanledger.operators.decode import decode_logs, undecodable_logs
from spanledger.plans import star_input as S
from spanledger.plans import stored as stored_input
from spanledger.plans.pipeline import Bridge
from spanledger.session import shared_folder
from spanledger.sources import landing, logs
from spanledger.sources.chains import supported_chains

SF = "/root/testdata/sf0.001"
RAW = "topics array<string>, data string, timeStamp string, gasPrice string, gasUsed string, transactionHash string, logIndex string, blockNumber string, blockchain string"


def test_copies_do_not_multiply_fills(spark, tmp_path):
    raw = stored_input.raw_logs(spark, SF)
    dims = S.chain_metadata(spark, SF), S.token_metadata(spark, SF), S.token_prices(spark, SF)
    once = Bridge.from_raw(raw, str(tmp_path / "a"), *dims).unified_fills.count()
    twice = Bridge.from_raw(raw.unionByName(raw), str(tmp_path / "b"), *dims).unified_fills.count()
    assert once == twice > 0


def test_first_copy_by_block_number_stays(spark):
    rows = [("0x1", "0x1", "0x10", "late"), ("0x1", "0x1", "0x9", "b"), ("0x1", "0x1", "0x9", "a"), ("0x1", "0x1", None, "none")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "transactionHash string, logIndex string, blockNumber string, note string")
        assert [r.note for r in ingest.unique_logs(df).collect()] == ["a"]


def test_receipt_with_a_price_and_most_gas_stays(spark):
    rows = [("0x1", "0x9", "0x5", None), ("0x1", "0x10", "", "0x7"), ("0x1", "0xff", None, ""), (None, "0x1", "0x1", "0x1")]
    got = ingest.receipt_gas(spark.createDataFrame(rows, "transactionHash string, gasUsed string, effectiveGasPrice string, gasPrice string"))
    assert [(r.receipt_used, r.receipt_price) for r in got.collect()] == [("0x10", "0x7")]


def _hot(spark, function):
    """The executed plan's text with small thresholds and no broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = function()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_transaction_is_split_in_gas_enrichment(spark):
    ids = spark.range(40_000).repartition(8)
    tx = F.when(F.col("id") % 2 == 0, F.lit("0xhot")).otherwise(F.concat(F.lit("0x"), F.hex("id")))
    hot = ids.select(tx.alias("transactionHash"), F.lit("0x1").alias("gasUsed"), F.md5(F.col("id").cast("string")).alias("gasPrice"))
    gas = hot.select("transactionHash", "gasUsed", F.lit("0x2").alias("effectiveGasPrice"), F.lit("0x2").alias("gasPrice")).distinct()
    plan = _hot(spark, lambda: ingest.enrich_with_gas(hot, gas))
    assert "skew=true" in plan or "isSkew=true" in plan


def test_copies_of_a_row_are_combined_before_the_shuffle(spark):
    rows = spark.range(10_000).select((F.col("id") % 2 * F.col("id")).alias("k"), F.lit("x").alias("v"))
    plan = _hot(spark, lambda: quality.duplicate_rows(rows))
    assert "partial_count" in plan and "Join" not in plan
    assert quality.duplicate_rows(rows).collect()[0].copies == 5_000


def test_bad_times_become_null_or_raise_only_when_strict(spark):
    rows = spark.createDataFrame([("0x7fffffffffffffff",), ("0x0",), ("junk",)], "h string")
    got = decode_logs(rows.select(F.array().cast("array<string>").alias("topics"), F.lit("0x").alias("data"), F.col("h").alias("timeStamp"),
                                  *[F.lit(None).cast("string").alias(c) for c in ("gasPrice", "gasUsed", "transactionHash")]))
    assert [r.timestamp_datetime for r in got.collect()] == [None, datetime(1970, 1, 1), None]
    text = spark.createDataFrame([("99999999999999999",), ("1704067200",), ("2024-01-01 00:00:00",)], "t string")
    assert [r.t for r in text.select(text_to_timestamp(F.col("t")).alias("t")).collect()] == [None, datetime(2024, 1, 1), datetime(2024, 1, 1)]
    with pytest.raises(Exception, match="no time"):
        text.select(text_to_timestamp(F.col("t"), strict=True)).collect()


def test_rounding_near_ties(spark):
    cases = [(0.0049999999, 2, 0.0), (1.0049999999, 2, 1.0), (1237.155, 2, 1237.16), (-1237.155, 2, -1237.16), (0.005, 2, 0.01), (2.5, 0, 3.0),
             (1.00005, 4, 1.0001), (1e20, 2, 1e20), (123456789.125, 2, 123456789.13), (0.1 + 0.2, 2, 0.3), (1.115, 2, 1.12)]
    for x, places, want in cases:
        got = spark.createDataFrame([(x,)], "x double").select(round_half_up(F.col("x"), places).alias("y")).first().y
        assert got == want, (x, places, got)
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) AS x").select(round_half_up(F.col("x"), 2)).first()[0] is None


def test_every_lost_log_has_a_reason(spark):
    raw = stored_input.raw_logs(spark, SF)
    number = F.pmod(F.xxhash64("transactionHash", "logIndex"), F.lit(7))
    event = F.get("topics", F.lit(0))
    damaged = raw.withColumns(
        {
            "data": F.when(number == 0, F.substring("data", 1, 150)).when((number == 1), F.concat(F.substring("data", 1, 100), F.lit("zz" * 200))).otherwise(F.col("data")),
            "topics": F.when((number == 2) & (event != C.EXECUTED_REFUND), F.slice("topics", 1, 3)).otherwise(F.col("topics")),
            "blockchain": F.when(number == 3, F.upper("blockchain")).otherwise(F.col("blockchain")),
        }
    )
    rejects = undecodable_logs(damaged, supported_chains(spark))
    kept = {"bad chain id", "bad time", "bad party"}
    lost = {r.reason: r.n for r in rejects.groupBy("reason").agg(F.sum("rejected_logs").alias("n")).collect()}
    landed = landing.fit_columns(decode_logs(damaged)).join(
        supported_chains(spark).select(F.lower("blockchain").alias("c")), F.lower("blockchain") == F.col("c"), "left_semi"
    )
    tokens = S.token_metadata(spark, SF)
    staged = staging.stage_deposits(landed, tokens).count() + staging.stage_fills(landed, tokens).count() + staging.stage_refunds(landed).count()
    assert {"data cut short", "malformed data", "missing party", "malformed refund", "unknown chain"} <= set(lost)
    assert staged + sum(n for r, n in lost.items() if r not in kept) == raw.count()


def test_landing_is_ordered_by_event_and_read_without_rows(spark, tmp_path):
    path = str(tmp_path / "landing")
    block = spark.sparkContext._jsc.hadoopConfiguration()
    block.set("parquet.block.size", "20000")
    try:
        landing.refresh_landing(S.landed_logs(spark, SF), path)
    finally:
        block.unset("parquet.block.size")
    spans = []
    for file in (tmp_path / "landing").rglob("*.parquet"):
        meta = pq.read_metadata(file)
        at = meta.schema.names.index("topic_0")
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(at).statistics
            spans.append((column.min, column.max))
    events = {C.FILLED_RELAY, C.EXECUTED_REFUND, C.FUNDS_DEPOSITED}
    for event in events:
        assert any(not low <= event <= high for low, high in spans)  # row groups that a reader of this event skips
    landing.refresh_landing(S.landed_logs(spark, SF).limit(0), path, [r.blockchain for r in landing.read_landing(spark, path).select("blockchain").distinct().collect()])
    assert landing.read_landing(spark, path).count() == 0
    empty = str(tmp_path / "empty")
    landing.refresh_landing(S.landed_logs(spark, SF).limit(0), empty)
    assert landing.read_landing(spark, empty).count() == 0


def test_days_of_the_match_prune_partitions(spark):
    folder = shared_folder(spark)
    bridge = stored_input.bridge(spark, SF)
    bridge.write_match(f"{folder}/match")
    some = bridge.over_match(spark, f"{folder}/match", ("2024-01-03", "2024-01-04"))
    plan = some.general_overview._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(deposit_date" in plan
    days = {r.d.isoformat() for r in some.deposit_fill_matching.select(F.to_date("deposit_timestamp").alias("d")).distinct().collect()}
    assert days == {"2024-01-03", "2024-01-04"}


def test_files_get_a_verdict_each(spark, tmp_path):
    whole = '{"blockNumber":"0x1","transactionHash":"0x%s","logIndex":"0x0","topics":["0x%s"],"data":"0x","address":"0x%s"}' % ("a" * 64, "b" * 64, "c" * 40)
    names = [f"logs_{c}_2024-01-01_to_2024-02-01.jsonl" for c in ("base", "bsc", "linea")]
    for name, text in zip(names, (whole + "\n", whole + "\nno json\n", ""), strict=True):
        (tmp_path / name).write_text(text)
    rows = spark.createDataFrame([(n,) for n in names], "source_file string")
    report = quality.check_files(logs.scan_logs(spark, str(tmp_path)), quality.file_kind(names[0]), rows)
    verdict = {r.source_file: r.ok for r in report.groupBy("source_file").agg(F.min("passed").alias("ok")).collect()}
    assert verdict == {names[0]: True, names[1]: False, names[2]: False}
    bad = {(r.source_file, r.rule): r.failures for r in report.where("failures > 0").collect()}
    assert bad[(names[1], "invalid line")] == 1
    assert not quality.rule_report(spark.range(0), {"x": F.col("id") < 0}).first().passed


def test_shared_folder_needs_one_on_a_cluster(spark):
    def session_of(master, folder):
        conf = SimpleNamespace(get=lambda key, default: folder)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, _jvm=spark._jvm, _jsc=spark.sparkContext._jsc))

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(session_of("spark://host:7077", None))
    assert shared_folder(session_of("spark://host:7077", "file:///tmp/spark-shared-test")).startswith("file:///tmp/spark-shared-test/")
    assert shared_folder(session_of("local[2]", None)).startswith("/tmp/spark-")
