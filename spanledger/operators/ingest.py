"""Joining, cleaning and appending raw logs before decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanledger.functions.hexcodec import hex_to_bigint
from spanledger.session import stored

LOG_KEY = ("transactionHash", "logIndex")
KEYS = ["key_hash", "key_tx", "key_index"]


def _filled(name: str) -> Column:
    """Empty text counts as missing."""
    return F.nullif(F.col(name), F.lit(""))


def harmonise_sources(logs: DataFrame) -> DataFrame:
    """One shape for logs of both providers: ``blockTimestamp`` is the time, no ``removed``."""
    if "blockTimestamp" in logs.columns:
        known = [F.col("timeStamp")] if "timeStamp" in logs.columns else []
        logs = logs.withColumn("timeStamp", F.coalesce("blockTimestamp", *known)).drop("blockTimestamp")
    return logs.drop("removed")


def pending_receipts(logs: DataFrame, receipts: DataFrame | None = None) -> DataFrame:
    """Transactions of the logs that have no stored receipt yet."""
    wanted = logs.select("transactionHash").distinct()
    if receipts is None:
        return wanted
    return wanted.join(receipts, "transactionHash", "left_anti")


def receipt_gas(receipts: DataFrame) -> DataFrame:
    """One row of gas data per transaction: the effective price, else the plain one.

    Of several receipts of a transaction the one with a price and the most gas
    used stays. The rank limit works before the shuffle too.
    """
    price = F.coalesce(_filled("effectiveGasPrice"), _filled("gasPrice"))
    gas = receipts.select("transactionHash", F.col("gasUsed").alias("receipt_used"), price.alias("receipt_price"))
    order = [F.col("receipt_price").isNull(), F.desc_nulls_last(hex_to_bigint(F.col("receipt_used"))), "receipt_price", "receipt_used"]
    best = F.row_number().over(W.partitionBy("transactionHash").orderBy(*order))
    return gas.filter(F.col("transactionHash").isNotNull()).withColumn("n", best).filter(F.col("n") == 1).drop("n")


def join_gas(logs: DataFrame, gas: DataFrame) -> DataFrame:
    """Gas fields of ``receipt_gas`` where a transaction has them; other logs stay as they are."""
    others = [c for c in logs.columns if c not in ("transactionHash", "gasUsed", "gasPrice")]
    found = F.col("has_receipt").isNotNull()
    joined = logs.join(gas.withColumn("has_receipt", F.lit(True)), "transactionHash", "left")
    return joined.select(
        "transactionHash",
        *others,
        F.when(found, F.col("receipt_used")).otherwise(F.col("gasUsed")).alias("gasUsed"),
        F.when(found, F.col("receipt_price")).otherwise(F.col("gasPrice")).alias("gasPrice"),
    )


def enrich_with_gas(logs: DataFrame, receipts: DataFrame, path: str | None = None) -> DataFrame:
    """Gas fields from the receipt where there is one; other logs stay as they are.

    Receipts are reduced per transaction and stored (at ``path``, if given), so a log never multiplies
    and the join has a plain input on both sides: the adaptive planner splits
    a transaction with very many logs, which it does not where an aggregate
    lies between the shuffle and the join.
    """
    return join_gas(logs, stored(receipt_gas(receipts), path))


def with_log_key(logs: DataFrame) -> DataFrame:
    """Adds the key of a log, NULL parts as empty text, and before it a hash of the key.

    Sorts compare the hash first: hashes of transactions begin alike, and a
    sort by them alone compares whole texts.
    """
    tx, index = (F.coalesce(F.col(n), F.lit("")) for n in LOG_KEY)
    return logs.withColumns({"key_hash": F.xxhash64(tx, index), "key_tx": tx, "key_index": index})


def _first_copies(keyed: DataFrame, order_by: str) -> DataFrame:
    others = sorted(c for c in keyed.columns if c not in KEYS)
    order = [F.asc_nulls_last(hex_to_bigint(F.col(order_by))), *[F.col(c) for c in others]]
    ranked = keyed.withColumn("copy", F.row_number().over(W.partitionBy(*KEYS).orderBy(*order)))
    return ranked.filter(F.col("copy") == 1).drop("copy")


def unique_logs(logs: DataFrame, order_by: str = "blockNumber") -> DataFrame:
    """Each (transaction, index) once: the copy with the least number in ``order_by``, then the least of all other columns.

    The rank limit is applied before the shuffle too, so many copies of one
    log do not meet in one task.
    """
    return _first_copies(with_log_key(logs), order_by).drop(*KEYS)


def new_logs(existing: DataFrame, incoming: DataFrame, order_by: str = "blockNumber") -> DataFrame:
    """Incoming logs whose (transaction, index) is not stored, once each, with their key.

    ``existing`` may hold the key columns already. The rank and the join use
    the same columns, so the incoming logs move once, and stored logs that lie
    bucketed by the key do not move at all.
    """
    known = existing if set(KEYS) <= set(existing.columns) else with_log_key(existing.select(*LOG_KEY))
    first = _first_copies(with_log_key(incoming), order_by)
    return first.join(known.select(*KEYS), KEYS, "left_anti").select(*first.columns)


def unique_logs_among(wanted: DataFrame, incoming: DataFrame, order_by: str = "blockNumber") -> DataFrame:
    """Incoming logs whose key is among the ``wanted``, once each, with their key.

    The rank comes first, so that its limit works before the logs move; the join then finds them where they lie.
    """
    first = _first_copies(with_log_key(incoming), order_by)
    return first.join(wanted, KEYS, "left_semi").select(*first.columns)


def append_new_logs(existing: DataFrame, incoming: DataFrame, order_by: str = "blockNumber") -> DataFrame:
    """Incoming logs whose (transaction, index) is not stored, once each."""
    return new_logs(existing, incoming, order_by).drop(*KEYS)


def prepare_logs(logs: DataFrame, receipts: DataFrame | None = None, gas_path: str | None = None) -> DataFrame:
    """Raw logs of all providers as decoding expects them: one shape, each log once, gas from the receipts (reduced ones lie at ``gas_path``)."""
    once = unique_logs(harmonise_sources(logs))
    return once if receipts is None else enrich_with_gas(once, receipts, gas_path)


def run_summary(logs: DataFrame) -> DataFrame:
    """Block range, number of logs and how many carry gas data."""
    block = hex_to_bigint(F.col("blockNumber"))
    return logs.agg(
        F.min(block).alias("first_block"),
        F.max(block).alias("last_block"),
        F.count("*").alias("total_logs"),
        F.count_if(_filled("gasUsed").isNotNull()).alias("logs_with_gas"),
    )
