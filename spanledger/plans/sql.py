"""The library from SQL: functions for hex, time and amounts, and a view for every layer.

The functions are SQL functions of the session, which Spark inlines into the
query that calls them, so they are optimised and compiled like any expression.
The views are the lazy models; a query over them is planned as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanledger.constants import DEFAULT_DECIMALS, ZERO_ADDRESS
from spanledger.functions.hexcodec import QUANTITY_64
from spanledger.functions.times import LAST_SECOND
from spanledger.plans.pipeline import Bridge

_BARE = "CASE WHEN startswith(h, '0x') THEN substr(h, 3) ELSE h END"
_SLOT = f"lpad({_BARE}, 64, '0')"


def _half(start: int) -> str:
    return f"CAST(conv(substr({_SLOT}, {start}, 16), 16, 10) AS DECIMAL(20,0))"


#: Name and arguments, type, and body of every function.
FUNCTIONS = [
    ("hex_to_integer(h STRING)", "BIGINT", f"CASE WHEN h RLIKE '{QUANTITY_64}' THEN try_cast(conv(right(replace(h, '0x', '0'), 16), 16, 10) AS BIGINT) END"),
    (
        "hex_to_numeric(h STRING)",
        "DECIMAL(38,0)",
        f"CASE WHEN length({_BARE}) BETWEEN 1 AND 64 AND {_SLOT} RLIKE '^0{{32}}[0-3][0-9a-fA-F]{{31}}$' "
        f"THEN CAST({_half(33)} * CAST('18446744073709551616' AS DECIMAL(20,0)) + {_half(49)} AS DECIMAL(38,0)) END",
    ),
    ("hex_to_address(h STRING)", "STRING", f"concat('0x', right({_BARE}, 40))"),
    (
        "text_to_timestamp(t STRING)",
        "TIMESTAMP",
        f"CASE WHEN t RLIKE '^[0-9]+$' THEN CASE WHEN try_cast(t AS BIGINT) BETWEEN 0 AND {LAST_SECOND} THEN timestamp_seconds(try_cast(t AS BIGINT)) END "
        "ELSE try_cast(t AS TIMESTAMP) END",
    ),
    ("rescale_amount(raw DOUBLE, decimals INT)", "DOUBLE", f"raw / pow(10D, coalesce(decimals, {DEFAULT_DECIMALS}))"),
    (
        "rescale_output_amount(token STRING, raw DOUBLE, input_decimals INT, output_decimals INT)",
        "DOUBLE",
        f"raw / pow(10D, coalesce(CASE WHEN token = '{ZERO_ADDRESS}' THEN input_decimals ELSE output_decimals END, {DEFAULT_DECIMALS}))",
    ),
]

LAYERS = [
    "landed", "stage_deposits", "stage_fills", "stage_refunds", "hourly_prices", "unified_deposits", "unified_fills", "unified_refunds",
    "refunds_expanded", "deposit_fill_matching", "general_overview", "fill_latency_analysis", "bridge_fee_analysis",
    "route_concentration_risk", "chain_metadata", "token_metadata", "token_prices",
]


def register(spark: SparkSession, bridge: Bridge, raw_logs: DataFrame | None = None, prefix: str = "") -> None:
    """Make the functions and, under ``prefix`` and their names, the layers known to the session's SQL."""
    for head, kind, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    for name in LAYERS:
        getattr(bridge, name).createOrReplaceTempView(prefix + name)
    if raw_logs is not None:
        raw_logs.createOrReplaceTempView(f"{prefix}raw_logs")
