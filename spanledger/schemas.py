"""Fixed schemas; nothing is inferred from files.

Fixed values: names and types are the data contract of the decoded logs.
"""

from __future__ import annotations

RAW_LOG = (
    "address STRING, topics ARRAY<STRING>, data STRING, blockNumber STRING, blockHash STRING, "
    "timeStamp STRING, blockTimestamp STRING, gasPrice STRING, gasUsed STRING, logIndex STRING, "
    "transactionHash STRING, transactionIndex STRING, removed BOOLEAN"
)
RECEIPT = "transactionHash STRING, gasUsed STRING, effectiveGasPrice STRING, gasPrice STRING, status STRING"

PRICE = "token_symbol STRING, timestamp TIMESTAMP, price_usd DOUBLE"
PRICE_TEXT = "token_symbol STRING, timestamp STRING, price_usd STRING"

CHAIN_CONFIG = (
    "chain_id BIGINT, spoke_pool_contract STRING, topics ARRAY<STRING>, tokens MAP<STRING, STRING>"
)

# Decoded logs: column -> type, in output order.
DECODED = {
    "timestamp_datetime": "timestamp",
    "transactionHash": "string",
    "topic_0": "string",
    "gas_price_wei": "bigint",
    "gas_used": "bigint",
    "topic_origin_chain_id": "bigint",
    "topic_deposit_id": "bigint",
    "topic_relayer": "string",
    "filled_relay_data_input_token": "string",
    "filled_relay_data_output_token": "string",
    "filled_relay_data_input_amount": "double",
    "filled_relay_data_output_amount": "double",
    "filled_relay_data_repayment_chain_id": "double",
    "filled_relay_data_exclusive_relayer": "string",
    "filled_relay_data_depositor": "string",
    "filled_relay_data_recipient": "string",
    "topic_destination_chain_id": "bigint",
    "topic_depositor": "string",
    "funds_deposited_data_input_token": "string",
    "funds_deposited_data_output_token": "string",
    "funds_deposited_data_input_amount": "double",
    "funds_deposited_data_output_amount": "double",
    "funds_deposited_data_recipient": "string",
    "topic_chain_id": "bigint",
    "topic_root_bundle_id": "bigint",
    "topic_leaf_id": "bigint",
    "amount_to_return": "double",
    "l2_token_address": "string",
    "refund_amounts": "string",
    "refund_addresses": "string",
    "refund_count": "bigint",
}

LINEAGE = {
    "blockchain": "string",
    "api_extracted_start_date": "string",
    "api_extracted_end_date": "string",
    "source_file": "string",
}

LANDED = {**DECODED, **LINEAGE}

ADDRESS_COLUMNS = [
    "topic_relayer",
    "filled_relay_data_input_token",
    "filled_relay_data_output_token",
    "filled_relay_data_exclusive_relayer",
    "filled_relay_data_depositor",
    "filled_relay_data_recipient",
    "topic_depositor",
    "funds_deposited_data_input_token",
    "funds_deposited_data_output_token",
    "funds_deposited_data_recipient",
    "l2_token_address",
]

AMOUNT_COLUMNS = [
    "filled_relay_data_input_amount",
    "filled_relay_data_output_amount",
    "funds_deposited_data_input_amount",
    "funds_deposited_data_output_amount",
    "amount_to_return",
    "refund_count",
]
