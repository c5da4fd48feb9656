"""Staged facts of all chains with chain names and hourly USD prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions.exact import exact_sum, whole_number
from spanledger.functions.numbers import rescale_amount, usd_value
from spanledger.operators.staging import tokens_by_chain_id

PRICE_SCALE = "decimal(38,18)"


def chain_id_of(blockchain: Column) -> Column:
    """Id of a supported chain by name, NULL for any other."""
    pairs = [F.lit(x) for pair in C.SUPPORTED_CHAINS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(blockchain)).cast("bigint")


def on_supported_chains(df: DataFrame, other_side: str | None = None) -> DataFrame:
    """Logs of the chains with a feed, and whose other end is one of them too."""
    kept = df.filter(F.lower("blockchain").isin(list(C.SUPPORTED_CHAINS)))
    if other_side is not None:
        kept = kept.filter(F.col(other_side).isin(C.SUPPORTED_CHAIN_IDS))
    return kept


def with_chain_name(df: DataFrame, chain_metadata: DataFrame, role: str) -> DataFrame:
    """Adds ``<role>_chain_name`` by ``<role>_chain_id``."""
    names = chain_metadata.select(
        F.col("chain_id").cast("bigint").alias(f"{role}_chain_id"), F.col("chain_name").alias(f"{role}_chain_name")
    )
    return df.join(names, f"{role}_chain_id", "left")


def hourly_prices(prices: DataFrame) -> DataFrame:
    """Average price per symbol and hour.

    The sum runs over decimals, so it does not depend on the order of rows;
    prices outside their range are averaged as doubles.
    """
    exact = F.col("price_usd").try_cast(PRICE_SCALE)
    inexact = exact.isNull() & F.col("price_usd").isNotNull()
    return (
        prices.groupBy("token_symbol", F.date_trunc("hour", "timestamp").alias("price_hour"))
        .agg(
            F.try_sum(exact).cast("double").alias("total"),
            F.count("price_usd").alias("n"),
            F.avg("price_usd").alias("plain"),
            F.count_if(inexact).alias("out_of_range"),
        )
        .select(
            "token_symbol",
            "price_hour",
            F.when(F.col("total").isNotNull() & (F.col("out_of_range") == 0), F.col("total") / F.col("n"))
            .otherwise(F.col("plain"))
            .alias("price_usd"),
        )
    )


def attach_price(df: DataFrame, hourly: DataFrame, symbol: str, timestamp: str, name: str) -> DataFrame:
    """Adds the price of a symbol in the hour of a timestamp, NULL if there is none."""
    prices = hourly.select(
        F.col("token_symbol").alias("_symbol"), F.col("price_hour").alias("_hour"), F.col("price_usd").alias(name)
    )
    on = (F.col(symbol) == F.col("_symbol")) & (F.date_trunc("hour", timestamp) == F.col("_hour"))
    return df.join(prices, on, "left").drop("_symbol", "_hour")


def unify_deposits(staged: DataFrame, chain_metadata: DataFrame, hourly: DataFrame) -> DataFrame:
    """Deposits between supported chains, named and priced at the deposit hour."""
    df = on_supported_chains(staged, "destination_chain_id").withColumn("origin_chain_id", chain_id_of(F.col("blockchain")))
    df = with_chain_name(with_chain_name(df, chain_metadata, "origin"), chain_metadata, "destination")
    df = attach_price(df, hourly, "input_token_symbol", "deposit_timestamp", "input_token_price_usd")
    return df.select(
        "deposit_timestamp",
        "transaction_hash",
        "origin_chain_id",
        "origin_chain_name",
        "destination_chain_id",
        "destination_chain_name",
        "deposit_id",
        "depositor_address",
        "recipient_address",
        "input_token_address",
        "input_token_symbol",
        "output_token_address",
        "output_token_symbol",
        "input_amount",
        "output_amount",
        "input_token_price_usd",
        usd_value(F.col("input_amount"), F.col("input_token_price_usd"), C.DEFAULT_TOKEN_PRICE).alias("input_amount_usd"),
    )


def unify_fills(staged: DataFrame, chain_metadata: DataFrame, hourly: DataFrame) -> DataFrame:
    """Fills between supported chains, named and priced at the fill hour."""
    df = on_supported_chains(staged, "origin_chain_id").withColumn("destination_chain_id", chain_id_of(F.col("blockchain")))
    df = with_chain_name(with_chain_name(df, chain_metadata, "origin"), chain_metadata, "destination")
    df = attach_price(df, hourly, "output_token_symbol", "fill_timestamp", "output_token_price_usd")
    return df.select(
        "fill_timestamp",
        "transaction_hash",
        "origin_chain_id",
        "origin_chain_name",
        "destination_chain_id",
        "destination_chain_name",
        "deposit_id",
        "relayer_address",
        "depositor_address",
        "recipient_address",
        "input_token_address",
        "output_token_address",
        F.col("output_token_symbol").alias("fill_token_symbol"),
        "input_amount",
        "output_amount",
        "repayment_chain_id",
        "gas_price_wei",
        "gas_used",
        "gas_cost_wei",
        "output_token_price_usd",
        usd_value(F.col("output_amount"), F.col("output_token_price_usd"), C.DEFAULT_TOKEN_PRICE).alias("output_amount_usd"),
    )


def unify_refunds(staged: DataFrame, chain_metadata: DataFrame, token_metadata: DataFrame) -> DataFrame:
    """Refund batches with token symbol and rescaled total; no price."""
    tokens = tokens_by_chain_id(token_metadata, "refund")
    names = chain_metadata.select(F.col("chain_id").cast("bigint").alias("chain_id"), "chain_name")
    df = on_supported_chains(staged).withColumn("refund_token_address", F.lower("refund_token_address"))
    df = df.join(names, "chain_id", "left").join(
        tokens,
        (F.col("refund_token_address") == F.col("refund_address")) & (F.col("chain_id") == F.col("refund_chain_id")),
        "left",
    )
    return df.select(
        "refund_timestamp",
        "transaction_hash",
        "chain_id",
        "chain_name",
        "root_bundle_id",
        "leaf_id",
        "refund_token_address",
        "refund_token_symbol",
        F.col("refund_decimals").alias("token_decimals"),
        rescale_amount(F.col("total_refund_amount"), F.col("refund_decimals")).alias("total_refund_amount"),
        F.col("total_refund_amount").alias("total_refund_amount_raw"),
        "refund_addresses_string",
        "refund_amounts_string",
        "refund_count",
        F.lower("blockchain").alias("source_blockchain"),
    )


def expand_refunds(unified: DataFrame, hourly: DataFrame) -> DataFrame:
    """One row per relayer payout: the i-th amount goes to the i-th address.

    Entries without a partner (lists of different length) and blanks drop out.
    The explode happens inside each task, without a shuffle. The raw amount is
    a DOUBLE; ``refund_amount_exact`` holds all digits of a whole number as
    text, for ``exact_totals``; it is NULL only where the amount is none.
    """
    pairs = F.arrays_zip(
        F.split("refund_amounts_string", ",").alias("amount"), F.split("refund_addresses_string", ",").alias("address")
    )
    rows = (
        unified.filter(F.col("refund_count") > 0)
        .select("*", F.posexplode(pairs).alias("position", "payout"))
        .withColumns(
            {
                "refund_index": F.col("position") + 1,
                "amount_text": F.trim("payout.amount"),
                "relayer_address": F.trim("payout.address"),
            }
        )
        .filter((F.col("amount_text") != "") & F.col("relayer_address").isNotNull())
        .withColumn("refund_amount_raw", F.col("amount_text").cast("double"))
    )
    rows = attach_price(rows, hourly, "refund_token_symbol", "refund_timestamp", "refund_token_price_usd")
    amount = rescale_amount(F.col("refund_amount_raw"), F.col("token_decimals"))
    return rows.select(
        "refund_timestamp",
        "transaction_hash",
        "source_blockchain",
        "chain_id",
        "chain_name",
        "root_bundle_id",
        "leaf_id",
        "refund_index",
        "relayer_address",
        "refund_token_address",
        "refund_token_symbol",
        amount.alias("refund_amount"),
        "refund_amount_raw",
        whole_number(F.col("amount_text")).alias("refund_amount_exact"),
        "refund_token_price_usd",
        usd_value(amount, F.col("refund_token_price_usd"), C.DEFAULT_TOKEN_PRICE).alias("refund_amount_usd"),
        F.col("total_refund_amount").alias("batch_total_amount"),
        F.col("total_refund_amount_raw").alias("batch_total_amount_raw"),
        F.col("refund_count").alias("batch_refund_count"),
        F.concat(
            F.col("transaction_hash"), F.lit("-"), F.col("leaf_id").cast("string"), F.lit("-"), F.col("refund_index").cast("string")
        ).alias("refund_id"),
    )


def exact_totals(expanded: DataFrame, by: list[str]) -> DataFrame:
    """Payouts of each group with their raw sum in all digits, and how many amounts are no whole number and not in the sum."""
    amount = F.col("refund_amount_exact")
    return expanded.groupBy(*by).agg(
        F.count("*").alias("payouts"), exact_sum(amount).alias("total_raw"), F.count_if(amount.isNull()).alias("not_whole")
    )
