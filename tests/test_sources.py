"""Files in and out, ingest operators and file checks."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.model_rules import MODEL_RULES
from spanledger.operators import ingest, quality
from spanledger.schemas import DECODED, LANDED
from spanledger.sources import chains, landing, logs, prices


def test_scan_takes_lineage_from_file_names(spark, tmp_path):
    line = {"transactionHash": "0x1", "topics": ["0xa"], "data": "0x", "blockTimestamp": "0x5", "removed": False}
    (tmp_path / "logs_base_2026-01-05_to_2026-01-06.jsonl").write_text(json.dumps(line) + "\n{broken\n")
    (tmp_path / "logs_linea_2026-01-05_to_2026-01-07.jsonl").write_text(json.dumps(line) + "\n")
    rows = logs.scan_logs(spark, str(tmp_path)).collect()
    seen = {(r.blockchain, r.api_extracted_start_date, r.api_extracted_end_date, r.transactionHash) for r in rows}
    assert seen == {
        ("base", "2026-01-05", "2026-01-06", "0x1"), ("base", "2026-01-05", "2026-01-06", None), ("linea", "2026-01-05", "2026-01-07", "0x1"),
    }
    shaped = ingest.harmonise_sources(logs.scan_logs(spark, str(tmp_path)))
    assert "removed" not in shaped.columns and shaped.filter("timeStamp = '0x5'").count() == 2


def landed(spark, rows):
    df = spark.createDataFrame(rows, "blockchain STRING, transactionHash STRING, source_file STRING")
    return landing.fit_columns(df)


def test_refresh_replaces_only_the_chains_it_holds(spark, tmp_path):
    path = str(tmp_path / "t")
    landing.refresh_landing(landed(spark, [("base", "0x1", "a"), ("base", "0x2", "a"), ("linea", "0x3", "b")]), path)
    landing.refresh_landing(landed(spark, [("base", "0x9", "c")]), path)
    table = landing.read_landing(spark, path)
    assert table.columns == [*LANDED, "loaded_at"]
    assert {(r.blockchain, r.transactionHash) for r in table.collect()} == {("base", "0x9"), ("linea", "0x3")}
    assert table.filter("loaded_at IS NULL OR topic_0 IS NOT NULL").count() == 0
    assert {(r.blockchain, r.source_file, r.row_count) for r in landing.load_status(table).collect()} == {("base", "c", 1), ("linea", "b", 1)}


def test_table_status(spark):
    assert landing.table_status(spark, "no_such_table") == {"exists": False, "row_count": 0, "file_loaded": None}
    landed(spark, [("base", "0x1", "a")]).createOrReplaceTempView("some_logs")
    assert landing.table_status(spark, "some_logs", "a") == {"exists": True, "row_count": 1, "file_loaded": True}
    assert landing.table_status(spark, "some_logs", "b")["file_loaded"] is False
    assert landing.table_status(spark, "some_logs")["file_loaded"] is None


def test_prices_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("token_symbol,timestamp,price_usd\nETH,2026-01-05 01:00:00+00:00,3456.78\nETH,2026-01-05T02:00:00Z,1\n")
    got = prices.read_prices(spark, str(tmp_path / "p.csv")).collect()
    assert [(r.token_symbol, r.timestamp, r.price_usd) for r in got] == [
        ("ETH", datetime(2026, 1, 5, 1), 3456.78), ("ETH", datetime(2026, 1, 5, 2), 1.0),
    ]
    assert prices.price_window(prices.read_prices(spark, str(tmp_path / "p.csv")), "2026-01-06", "2026-01-06").count() == 2
    assert prices.price_window(prices.read_prices(spark, str(tmp_path / "p.csv")), "2026-01-07", "2026-01-08").count() == 0


def test_chain_config(spark, tmp_path):
    config = {
        "base": {"chain_id": 8453, "spoke_pool_contract": "0x1", "topics": ["a", "b", "c"], "tokens": {"USDC": "0xA", "DAI": None, "BAL": ""}},
        "plasma": {"chain_id": None, "spoke_pool_contract": None, "topics": ["a", "b", "c"], "tokens": {}},
    }
    (tmp_path / "c.json").write_text(json.dumps(config, indent=2))
    rows = chains.read_chain_config(spark, str(tmp_path / "c.json"))
    assert chains.chain_metadata(rows).collect() == [(8453, "base")]
    assert [tuple(r) for r in chains.token_contracts(rows).collect()] == [("base", 8453, "USDC", "0xA")]
    assert chains.chain_settings(rows, "BASE").first().topics == ["a", "b", "c"]
    assert chains.native_tokens(spark).count() == 11 == chains.supported_chains(spark).count()


def test_append_counts_null_parts_as_empty(spark):
    schema = "transactionHash STRING, logIndex STRING, blockNumber STRING"
    stored = spark.createDataFrame([("0x1", None, "0x1"), ("0x2", "0x0", "0x1")], schema)
    batch = [("0x1", "", "0x2"), ("0x2", "0x0", "0x3"), ("0x2", "0x1", "0x4")] + [("0x3", "0x0", f"0x{i}") for i in (7, 5, 6)]
    got = ingest.append_new_logs(stored, spark.createDataFrame(batch, schema)).collect()
    assert {tuple(r) for r in got} == {("0x2", "0x1", "0x4"), ("0x3", "0x0", "0x5")}


def test_gas_enrichment_rules(spark):
    logs_df = spark.createDataFrame([("0x1", "a", "b"), ("0x2", "a", "b"), ("0x2", "c", "d")], "transactionHash STRING, gasUsed STRING, gasPrice STRING")
    receipts = spark.createDataFrame(
        [("0x2", "0x10", "", "0x7"), ("0x2", "0x10", "", "0x7")], "transactionHash STRING, gasUsed STRING, effectiveGasPrice STRING, gasPrice STRING"
    )
    got = sorted(map(tuple, ingest.enrich_with_gas(logs_df, receipts).collect()))
    assert got == [("0x1", "a", "b"), ("0x2", "0x10", "0x7"), ("0x2", "0x10", "0x7")]
    assert ingest.pending_receipts(logs_df, receipts).collect() == [("0x1",)]
    assert ingest.pending_receipts(logs_df).count() == 2


def test_file_kinds():
    assert [quality.file_kind(n) for n in ("logs_x.jsonl", "Receipts_x.jsonl", "alchemy_prices.csv")] == ["logs", "receipts", "prices"]
    for bad in ("x.csv", "x.parquet"):
        with pytest.raises(ValueError):
            quality.file_kind(bad)


def test_schema_differences(spark):
    df = landing.fit_columns(spark.createDataFrame([("a",)], "topic_0 STRING"), DECODED)
    assert quality.schema_differences(df).count() == 0
    changed = df.withColumn("refund_count", F.lit("1")).drop("topic_relayer")
    assert {tuple(r) for r in quality.schema_differences(changed).collect()} == {
        ("refund_count", "bigint", "string"), ("topic_relayer", "string", None),
    }


def test_rule_counts_match_declared_model_rules():
    assert sum(len(r["not_null"]) for n, r in MODEL_RULES.items() if n.startswith("stage_")) == 39
    assert set(MODEL_RULES["stage_refunds"]["accepted"]["chain_id"]) == set(C.SUPPORTED_CHAINS.values())
