"""Decoded logs to typed deposit, fill and refund facts, for all chains at once.

Each operator is a filter on the landed table (event, required amounts). The
landed files are ordered by event, so the Parquet scan skips the row groups
that hold other events only, and reads only the event's own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions.numbers import rescale_amount, rescale_output_amount


def tokens_by_chain_name(token_metadata: DataFrame, prefix: str) -> DataFrame:
    """Token lookup keyed by lower-case chain name and address."""
    return token_metadata.select(
        F.lower("chain").alias(f"{prefix}_chain"),
        F.lower("token_address").alias(f"{prefix}_address"),
        F.col("token_symbol").alias(f"{prefix}_token_symbol"),
        F.col("decimals").alias(f"{prefix}_decimals"),
    )


def tokens_by_chain_id(token_metadata: DataFrame, prefix: str) -> DataFrame:
    """Token lookup keyed by chain id and lower-case address."""
    return token_metadata.select(
        F.col("chain_id").alias(f"{prefix}_chain_id"),
        F.lower("token_address").alias(f"{prefix}_address"),
        F.col("token_symbol").alias(f"{prefix}_token_symbol"),
        F.col("decimals").alias(f"{prefix}_decimals"),
    )


def _join_tokens(df: DataFrame, tokens: DataFrame, prefix: str, chain: Column, address: str) -> DataFrame:
    key = f"{prefix}_chain_id" if f"{prefix}_chain_id" in tokens.columns else f"{prefix}_chain"
    on = (F.col(address) == F.col(f"{prefix}_address")) & (chain == F.col(key))
    return df.join(tokens, on, "left")


def stage_deposits(landed: DataFrame, token_metadata: DataFrame) -> DataFrame:
    """FundsDeposited events with rescaled amounts and token symbols.

    The input token lies on the log's own chain, the output token on the
    destination chain.
    """
    cleaned = landed.filter(
        (F.col("topic_0") == C.FUNDS_DEPOSITED)
        & F.col("funds_deposited_data_input_amount").isNotNull()
        & F.col("funds_deposited_data_output_amount").isNotNull()
    ).select(
        F.col("timestamp_datetime").alias("deposit_timestamp"),
        F.col("transactionHash").alias("transaction_hash"),
        "blockchain",
        "source_file",
        F.col("topic_destination_chain_id").alias("destination_chain_id"),
        F.col("topic_deposit_id").alias("deposit_id"),
        F.col("topic_depositor").alias("depositor_address"),
        F.lower("funds_deposited_data_input_token").alias("input_token_address"),
        F.lower("funds_deposited_data_output_token").alias("output_token_address"),
        F.col("funds_deposited_data_input_amount").alias("input_amount_raw"),
        F.col("funds_deposited_data_output_amount").alias("output_amount_raw"),
        F.col("funds_deposited_data_recipient").alias("recipient_address"),
    )
    cleaned = cleaned.dropna(
        subset=["deposit_id", "depositor_address", "input_token_address", "output_token_address"]
    )
    named = _join_tokens(
        cleaned, tokens_by_chain_name(token_metadata, "input"), "input", F.lower("blockchain"), "input_token_address"
    )
    named = _join_tokens(
        named, tokens_by_chain_id(token_metadata, "output"), "output", F.col("destination_chain_id"), "output_token_address"
    )
    return named.select(
        "deposit_timestamp",
        "transaction_hash",
        "blockchain",
        "source_file",
        "destination_chain_id",
        "deposit_id",
        "depositor_address",
        "input_token_address",
        "input_token_symbol",
        "output_token_address",
        "output_token_symbol",
        rescale_amount(F.col("input_amount_raw"), F.col("input_decimals")).alias("input_amount"),
        rescale_output_amount(
            F.col("output_token_address"), F.col("output_amount_raw"), F.col("input_decimals"), F.col("output_decimals")
        ).alias("output_amount"),
        "input_amount_raw",
        "output_amount_raw",
        "recipient_address",
    )


def stage_fills(landed: DataFrame, token_metadata: DataFrame) -> DataFrame:
    """FilledRelay events with rescaled amounts, token symbols and exact gas cost.

    The input token lies on the origin chain, the output token on the log's
    own chain; a native output has no rule of its own here.
    """
    cleaned = landed.filter(
        (F.col("topic_0") == C.FILLED_RELAY)
        & F.col("filled_relay_data_input_amount").isNotNull()
        & F.col("filled_relay_data_output_amount").isNotNull()
    ).select(
        F.col("timestamp_datetime").alias("fill_timestamp"),
        F.col("transactionHash").alias("transaction_hash"),
        "blockchain",
        "source_file",
        F.col("topic_origin_chain_id").alias("origin_chain_id"),
        F.col("topic_deposit_id").alias("deposit_id"),
        F.col("topic_relayer").alias("relayer_address"),
        F.lower("filled_relay_data_input_token").alias("input_token_address"),
        F.lower("filled_relay_data_output_token").alias("output_token_address"),
        F.col("filled_relay_data_input_amount").alias("input_amount_raw"),
        F.col("filled_relay_data_output_amount").alias("output_amount_raw"),
        F.col("filled_relay_data_repayment_chain_id").try_cast("bigint").alias("repayment_chain_id"),
        F.col("filled_relay_data_exclusive_relayer").alias("exclusive_relayer_address"),
        F.col("filled_relay_data_depositor").alias("depositor_address"),
        F.col("filled_relay_data_recipient").alias("recipient_address"),
        "gas_price_wei",
        "gas_used",
    )
    cleaned = cleaned.dropna(subset=["deposit_id", "relayer_address", "input_token_address", "output_token_address"])
    named = _join_tokens(
        cleaned, tokens_by_chain_id(token_metadata, "input"), "input", F.col("origin_chain_id"), "input_token_address"
    )
    named = _join_tokens(
        named, tokens_by_chain_name(token_metadata, "output"), "output", F.lower("blockchain"), "output_token_address"
    )
    gas_cost = F.col("gas_price_wei").cast("decimal(19,0)") * F.col("gas_used").cast("decimal(19,0)")
    return named.select(
        "fill_timestamp",
        "transaction_hash",
        "blockchain",
        "source_file",
        "origin_chain_id",
        "deposit_id",
        "relayer_address",
        "input_token_address",
        "input_token_symbol",
        "output_token_address",
        "output_token_symbol",
        rescale_amount(F.col("input_amount_raw"), F.col("input_decimals")).alias("input_amount"),
        rescale_amount(F.col("output_amount_raw"), F.col("output_decimals")).alias("output_amount"),
        "input_amount_raw",
        "output_amount_raw",
        "repayment_chain_id",
        "exclusive_relayer_address",
        "depositor_address",
        "recipient_address",
        "gas_price_wei",
        "gas_used",
        gas_cost.cast("decimal(38,0)").alias("gas_cost_wei"),
    )


def stage_refunds(landed: DataFrame) -> DataFrame:
    """ExecutedRelayerRefundRoot events; the payout lists stay comma-separated."""
    return (
        landed.filter(
            (F.col("topic_0") == C.EXECUTED_REFUND)
            & F.col("amount_to_return").isNotNull()
            & F.col("l2_token_address").isNotNull()
            & F.col("refund_count").isNotNull()
            & F.col("topic_chain_id").isNotNull()
        )
        .select(
            F.col("timestamp_datetime").alias("refund_timestamp"),
            F.col("transactionHash").alias("transaction_hash"),
            "blockchain",
            "source_file",
            F.col("topic_chain_id").alias("chain_id"),
            F.col("topic_root_bundle_id").alias("root_bundle_id"),
            F.col("topic_leaf_id").alias("leaf_id"),
            F.col("l2_token_address").alias("refund_token_address"),
            F.col("amount_to_return").alias("total_refund_amount"),
            F.col("refund_amounts").alias("refund_amounts_string"),
            F.col("refund_addresses").alias("refund_addresses_string"),
            F.col("refund_count").cast("int").alias("refund_count"),
        )
    )
