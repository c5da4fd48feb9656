"""Raw logs to the 31 decoded columns, for all chains and events in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions.hexcodec import (
    SLOT,
    hex_to_address,
    hex_to_bigint,
    hex_to_timestamp,
    slot,
    slot_address,
    slot_to_address,
    slot_to_double,
    slot_to_integer_text,
)
from spanledger.schemas import DECODED

ADDRESS_PADDING = "0" * 24
TOPIC_HEX = "^0x[0-9a-fA-F]{64}$"


@dataclass(frozen=True)
class EventSignatures:
    filled_relay: str = C.FILLED_RELAY
    executed_refund: str = C.EXECUTED_REFUND
    funds_deposited: str = C.FUNDS_DEPOSITED


def split_topics(logs: DataFrame) -> DataFrame:
    """The topic list as four columns; short lists give NULL, extra entries are dropped."""
    return logs.withColumns({f"topic_{i}": F.get("topics", F.lit(i)) for i in range(4)})


def topic_columns(sig: EventSignatures) -> dict[str, Column]:
    """Indexed fields; which topic means what depends on the event."""
    event = F.col("topic_0")
    filled, refunded, deposited = (
        event == sig.filled_relay,
        event == sig.executed_refund,
        event == sig.funds_deposited,
    )
    first, second, third = (F.col(f"topic_{i}") for i in (1, 2, 3))
    return {
        "topic_origin_chain_id": F.when(filled, hex_to_bigint(first)),
        "topic_deposit_id": F.when(filled | deposited, hex_to_bigint(second)),
        "topic_relayer": F.when(filled, hex_to_address(third)),
        "topic_destination_chain_id": F.when(deposited, hex_to_bigint(first)),
        "topic_depositor": F.when(deposited, hex_to_address(third)),
        "topic_chain_id": F.when(refunded, hex_to_bigint(first)),
        "topic_root_bundle_id": F.when(refunded, hex_to_bigint(second)),
        "topic_leaf_id": F.when(refunded, hex_to_bigint(third)),
    }


def with_numbers(logs: DataFrame, sig: EventSignatures) -> DataFrame:
    """Adds the data as bytes and the numeric slots (``_n<slot>``).

    Fill and deposit logs keep their amounts in the same slots, so one
    expression serves both. A log cut short has NULL from there on.
    """
    event = F.col("topic_0")
    is_fill, is_deposit, is_refund = (
        event == sig.filled_relay,
        event == sig.funds_deposited,
        event == sig.executed_refund,
    )
    holders = {0: is_refund, 2: is_fill | is_deposit, 3: is_fill | is_deposit, 4: is_fill}
    logs = logs.withColumn("_bytes", F.col("data").cast("binary"))
    logs = logs.withColumns({f"_s{n}": F.when(held, slot(F.col("_bytes"), n)) for n, held in holders.items()})
    return logs.withColumns({f"_n{n}": slot_to_double(F.col(f"_s{n}")) for n in holders})


def fill_columns(is_fill: Column) -> dict[str, Column]:
    """FilledRelay: tokens, amounts, repayment chain and parties in fixed slots."""

    def address(n: int) -> Column:
        return F.when(is_fill, slot_address(F.col("_bytes"), n))

    def number(n: int) -> Column:
        return F.when(is_fill, F.col(f"_n{n}"))

    return {
        "filled_relay_data_input_token": address(0),
        "filled_relay_data_output_token": address(1),
        "filled_relay_data_input_amount": number(2),
        "filled_relay_data_output_amount": number(3),
        "filled_relay_data_repayment_chain_id": number(4),
        "filled_relay_data_exclusive_relayer": address(7),
        "filled_relay_data_depositor": address(8),
        "filled_relay_data_recipient": address(9),
    }


def deposit_columns(is_deposit: Column) -> dict[str, Column]:
    """FundsDeposited: tokens, amounts and recipient in fixed slots."""

    def address(n: int) -> Column:
        return F.when(is_deposit, slot_address(F.col("_bytes"), n))

    def number(n: int) -> Column:
        return F.when(is_deposit, F.col(f"_n{n}"))

    return {
        "funds_deposited_data_input_token": address(0),
        "funds_deposited_data_output_token": address(1),
        "funds_deposited_data_input_amount": number(2),
        "funds_deposited_data_output_amount": number(3),
        "funds_deposited_data_recipient": address(7),
    }


def with_refund_arrays(logs: DataFrame, is_refund: Column) -> DataFrame:
    """Adds ``_amounts`` and ``_addresses``: the slots of the two dynamic arrays.

    A head slot holds the byte offset of the array, which starts with its
    length. Each step is a projection of its own, so that it is computed once
    per row and only for refund logs. An offset or length that leads outside
    the data gives NULL.
    """
    data = F.col("_bytes")
    length = F.octet_length(data)
    heads = {"_amounts": 1, "_addresses": 3}

    def cut(start: Column) -> Column:
        return F.substr(data, start, F.lit(SLOT)).cast("string")

    logs = logs.withColumns({f"{n}_offset": F.when(is_refund, hex_to_bigint(slot(data, h))) for n, h in heads.items()})
    logs = logs.withColumns(
        {
            f"{n}_start": F.when(F.col(f"{n}_offset") < length, (F.col(f"{n}_offset") * 2 + 3).cast("int"))
            for n in heads
        }
    )
    logs = logs.withColumns({f"{n}_count": hex_to_bigint(cut(F.col(f"{n}_start"))) for n in heads})

    def items(n: str) -> Column:
        start, count = F.col(f"{n}_start"), F.col(f"{n}_count")
        whole = count <= F.floor((length - start + 1) / SLOT) - 1
        return F.when(whole & (count == 0), F.array().cast("array<string>")).when(
            whole,
            F.transform(F.sequence(F.lit(1), count.cast("int")), lambda i: cut(start + i * F.lit(SLOT))),
        )

    return logs.withColumns({n: items(n) for n in heads})


def with_refund_check(logs: DataFrame) -> DataFrame:
    """Adds ``_well_formed``, true where a strict ABI decoder accepts the refund data.

    Beside the arrays, address padding must be zero and the flag 0 or 1.
    """
    data, digits = F.col("data"), F.col("_bytes")
    well_formed = (
        F.col("_amounts").isNotNull()
        & F.col("_addresses").isNotNull()
        & data.rlike("^0x[0-9a-fA-F]*$")
        & (F.octet_length(data) % 2 == 0)
        & (slot(digits, 2, 0, 24) == ADDRESS_PADDING)
        & (slot(digits, 5, 0, 24) == ADDRESS_PADDING)
        & slot(digits, 4).rlike("^0{63}[01]$")
        & F.forall("_addresses", lambda a: a.startswith(ADDRESS_PADDING))
    )
    return logs.withColumn("_well_formed", well_formed)


def refund_columns() -> dict[str, Column]:
    """ExecutedRelayerRefundRoot: all five columns, or NULL in all of them."""
    ok = F.col("_well_formed")
    return {
        "amount_to_return": F.when(ok, F.col("_n0")),
        "l2_token_address": F.when(ok, F.lower(slot_address(F.col("_bytes"), 2))),
        "refund_amounts": F.when(ok, F.array_join(F.transform("_amounts", slot_to_integer_text), ",")),
        "refund_addresses": F.when(
            ok, F.array_join(F.transform("_addresses", lambda a: F.lower(slot_to_address(a))), ",")
        ),
        "refund_count": F.when(ok, F.size("_amounts").cast("bigint")),
    }


def prepared_logs(logs: DataFrame, sig: EventSignatures) -> DataFrame:
    """Logs with their topics, slots and refund arrays cut out."""
    prepared = with_numbers(split_topics(logs), sig)
    return with_refund_check(with_refund_arrays(prepared, F.col("topic_0") == sig.executed_refund))


def decode_logs(logs: DataFrame, sig: EventSignatures = EventSignatures()) -> DataFrame:
    """The 31 decoded columns, plus any lineage columns the input carries."""
    event = F.col("topic_0")
    columns = {
        "timestamp_datetime": hex_to_timestamp(F.col("timeStamp")),
        "transactionHash": F.col("transactionHash"),
        "topic_0": event,
        "gas_price_wei": hex_to_bigint(F.col("gasPrice")),
        "gas_used": hex_to_bigint(F.col("gasUsed")),
        **topic_columns(sig),
        **fill_columns(event == sig.filled_relay),
        **deposit_columns(event == sig.funds_deposited),
        **refund_columns(),
    }
    kept = [c for c in logs.columns if c in ("blockchain", "source_file") or c.startswith("api_extracted")]
    return prepared_logs(logs, sig).select(*[columns[n].alias(n) for n in DECODED], *kept)


def reject_reason(sig: EventSignatures = EventSignatures()) -> Column:
    """Why decoding or staging would lose a log that is prepared by ``prepared_logs``; NULL if it would not.

    The first reason that holds counts; ``known`` says whether the chain is. The
    last three spoil a value but leave the log in staging.
    """
    event = F.coalesce("topic_0", F.lit(""))
    refunded, deposited = event == sig.executed_refund, event == sig.funds_deposited
    with_deposit = (event == sig.filled_relay) | deposited
    chain = hex_to_bigint(F.col("topic_1"))
    tokens = F.col("_s2").isNotNull() & F.col("_s3").isNotNull()
    return (
        F.when(F.col("known").isNull(), "unknown chain")
        .when(~(with_deposit | refunded), "unknown event")
        .when(with_deposit & hex_to_bigint(F.col("topic_2")).isNull(), "deposit id out of range")
        .when(with_deposit & F.col("topic_3").isNull(), "missing party")
        .when(with_deposit & ~tokens, "data cut short")
        .when(with_deposit & (F.col("_n2").isNull() | F.col("_n3").isNull()), "malformed data")
        .when(refunded & ~F.coalesce("_well_formed", F.lit(False)), "malformed refund")
        .when(chain.isNull(), "bad chain id")
        .when(hex_to_timestamp(F.col("timeStamp")).isNull(), "bad time")
        .when(with_deposit & ~F.col("topic_3").rlike(TOPIC_HEX), "bad party")
    )


def undecodable_logs(logs: DataFrame, known_chains: DataFrame) -> DataFrame:
    """Logs that decoding or staging would lose without an error, counted by chain and reason."""
    chains = known_chains.select(F.lower("blockchain").alias("_chain"), F.lit(True).alias("known"))
    sig = EventSignatures()
    named = prepared_logs(logs, sig).withColumn("_chain", F.lower("blockchain")).join(chains, "_chain", "left")
    return (
        named.select("blockchain", reject_reason(sig).alias("reason"))
        .filter(F.col("reason").isNotNull())
        .groupBy("blockchain", "reason")
        .agg(F.count("*").alias("rejected_logs"))
    )
