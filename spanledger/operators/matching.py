"""Each deposit with its fill on the destination chain, priced and tiered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions.numbers import percent_of, round_half_up, tier, usd_value
from spanledger.operators.unify import attach_price

MATCH_KEY = ["deposit_id", "origin_chain_id", "destination_chain_id"]


def allowed_deposits(deposits: DataFrame) -> DataFrame:
    """Deposits of tokens that are not on the exclusion list."""
    return deposits.filter(~F.lower("input_token_address").isin(C.EXCLUDED_DEPOSIT_TOKENS))


def pair_deposits_with_fills(deposits: DataFrame, fills: DataFrame) -> DataFrame:
    """Deposits LEFT JOIN fills on id and both chains; unfilled ones are kept.

    Written as filled (inner) plus unfilled (anti): an adaptive skew join may
    split either side of an inner join but never the right side of a left
    join, and it is the fills of one deposit that can pile up. The price is a
    second shuffle of the deposits; the fills take part in it with their
    distinct keys only, and the unfilled branch enriches only what it keeps.
    """
    left = deposits.select(
        "deposit_timestamp",
        F.col("transaction_hash").alias("deposit_tx_hash"),
        "origin_chain_id",
        "origin_chain_name",
        "destination_chain_id",
        "destination_chain_name",
        "deposit_id",
        "depositor_address",
        F.col("recipient_address").alias("deposit_recipient"),
        F.col("input_token_address").alias("deposit_token"),
        F.col("input_token_symbol").alias("deposit_token_symbol"),
        F.col("input_amount").alias("deposit_amount"),
        F.col("output_amount").alias("expected_output_amount"),
        F.col("input_token_price_usd").alias("deposit_token_price_usd"),
    ).dropna(subset=MATCH_KEY)
    right = fills.select(
        *MATCH_KEY,
        "fill_timestamp",
        F.col("transaction_hash").alias("fill_tx_hash"),
        "relayer_address",
        F.col("output_token_address").alias("fill_token"),
        "fill_token_symbol",
        F.col("output_amount").alias("actual_output_amount"),
        "repayment_chain_id",
        F.col("output_token_price_usd").alias("fill_token_price_usd"),
        "gas_price_wei",
        "gas_used",
        "gas_cost_wei",
    )
    filled = left.join(right, MATCH_KEY).withColumn("is_filled", F.lit(True))
    unfilled = left.join(right.select(*MATCH_KEY).distinct(), MATCH_KEY, "left_anti").withColumn("is_filled", F.lit(False))
    return filled.unionByName(unfilled, allowMissingColumns=True)


def native_symbol_of(chain_id: Column) -> Column:
    pairs = [x for k, v in C.NATIVE_TOKENS.items() for x in (F.lit(k).cast("bigint"), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), chain_id)


def match_deposits_to_fills(deposits: DataFrame, fills: DataFrame, hourly: DataFrame) -> DataFrame:
    """The match fact: one row per deposit and fill, 38 columns.

    Symbols and token prices arrive with the unified facts; only the price of
    the gas token is looked up here.
    """
    pairs = pair_deposits_with_fills(allowed_deposits(deposits), fills)
    pairs = pairs.withColumn("_native_symbol", native_symbol_of(F.col("destination_chain_id")))
    pairs = attach_price(pairs, hourly, "_native_symbol", "fill_timestamp", "_native_price")

    paid_in, paid_out, expected = F.col("deposit_amount"), F.col("actual_output_amount"), F.col("expected_output_amount")
    seconds = (F.unix_micros("fill_timestamp") - F.unix_micros("deposit_timestamp")) / F.lit(1e6)
    gas_native = F.col("gas_cost_wei").cast("double") / F.lit(1e18)

    measured = pairs.withColumns(
        {
            "fill_latency_seconds": F.when(F.col("is_filled"), F.greatest(F.lit(0.0), seconds)),
            "bridge_fee_nominal": round_half_up(paid_in - paid_out, 2),
            "bridge_fee_percent": percent_of(paid_in - paid_out, paid_in, 2),
            "slippage_percent": F.when(expected > 0, percent_of(expected - paid_out, expected, 2)),
        }
    )
    return measured.select(
        "deposit_timestamp",
        "deposit_tx_hash",
        "origin_chain_id",
        "origin_chain_name",
        "destination_chain_id",
        "destination_chain_name",
        "deposit_id",
        "depositor_address",
        "deposit_recipient",
        "deposit_token",
        "deposit_token_symbol",
        "deposit_amount",
        "expected_output_amount",
        "deposit_token_price_usd",
        usd_value(paid_in, F.col("deposit_token_price_usd"), C.DEFAULT_TOKEN_PRICE).alias("deposit_amount_usd"),
        "fill_timestamp",
        "fill_tx_hash",
        "relayer_address",
        "fill_token",
        "fill_token_symbol",
        "actual_output_amount",
        "repayment_chain_id",
        "fill_token_price_usd",
        usd_value(paid_out, F.col("fill_token_price_usd"), C.DEFAULT_TOKEN_PRICE).alias("fill_amount_usd"),
        "fill_latency_seconds",
        "is_filled",
        "bridge_fee_nominal",
        "bridge_fee_percent",
        "slippage_percent",
        "gas_price_wei",
        "gas_used",
        "gas_cost_wei",
        round_half_up(gas_native, 8).alias("gas_cost_native"),
        usd_value(gas_native, F.col("_native_price"), C.DEFAULT_GAS_PRICE).alias("gas_cost_usd"),
        usd_value(F.col("bridge_fee_nominal"), F.col("deposit_token_price_usd"), C.DEFAULT_TOKEN_PRICE).alias(
            "bridge_fee_nominal_usd"
        ),
        F.concat("origin_chain_name", F.lit(" → "), "destination_chain_name").alias("route_name"),
        F.concat(F.col("origin_chain_id").cast("string"), F.lit("_"), F.col("destination_chain_id").cast("string")).alias(
            "route_id"
        ),
        F.when(F.col("is_filled"), tier(F.col("fill_latency_seconds"), C.LATENCY_TIERS, C.LATENCY_REST)).alias(
            "latency_tier"
        ),
    )
