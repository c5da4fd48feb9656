"""The fields a raw log must have, and the declared column rules of the models.

They must equal the published contract of the tables, so they are stated here as plain text, in the order of the layers.
"""

from spanledger import constants as C

RAW_REQUIRED = ["blockNumber", "transactionHash", "logIndex", "topics", "data", "address"]

_CHAIN_IDS = C.SUPPORTED_CHAIN_IDS
_CHAIN_NAMES = sorted(C.SUPPORTED_CHAINS)
_MART_KEYS = ["deposit_minute", "origin_chain_id", "destination_chain_id", "route_id", "deposit_token"]
_CHAIN_PAIR = {"origin_chain_id": _CHAIN_IDS, "destination_chain_id": _CHAIN_IDS}

# Rules of a layer hold for each chain where its tables are one per chain; the event of a log is declared for one chain alone.
LAYERS = {
    "source": ["landed_logs"],
    "staging": ["stage_deposits", "stage_fills", "stage_refunds"],
    "intermediate": ["unified_deposits", "unified_fills", "unified_refunds", "refunds_expanded", "deposit_fill_matching"],
    "marts": ["general_overview", "fill_latency_analysis", "bridge_fee_analysis"],
}
PER_CHAIN = {"source": "blockchain", "staging": "blockchain"}
ONE_CHAIN_ONLY = {("landed_logs", "topic_0"): ["arbitrum"]}

MODEL_RULES = {
    "landed_logs": {"not_null": ["transactionHash", "timestamp_datetime", "topic_0"]},
    "stage_deposits": {
        "not_null": [
            "deposit_id", "deposit_timestamp", "transaction_hash", "depositor_address", "blockchain",
            "input_token_address", "output_token_address", "input_amount", "output_amount",
            "input_amount_raw", "output_amount_raw", "destination_chain_id", "recipient_address",
        ],
        "accepted": {"blockchain": _CHAIN_NAMES},
        "unique": [["blockchain", "deposit_id"]],
    },
    "stage_fills": {
        "not_null": [
            "deposit_id", "fill_timestamp", "transaction_hash", "relayer_address", "blockchain",
            "input_token_address", "output_token_address", "input_amount", "output_amount",
            "input_amount_raw", "output_amount_raw", "origin_chain_id", "repayment_chain_id",
            "depositor_address", "recipient_address",
        ],
        "accepted": {"blockchain": _CHAIN_NAMES},
    },
    "stage_refunds": {
        "not_null": [
            "chain_id", "root_bundle_id", "leaf_id", "refund_timestamp", "transaction_hash", "blockchain",
            "refund_token_address", "total_refund_amount", "refund_count",
            "refund_amounts_string", "refund_addresses_string",
        ],
        "accepted": {"blockchain": _CHAIN_NAMES, "chain_id": _CHAIN_IDS},
    },
    "unified_deposits": {
        "not_null": [
            "deposit_id", "deposit_timestamp", "transaction_hash", "origin_chain_id", "destination_chain_id",
            "depositor_address", "recipient_address", "input_token_address", "output_token_address",
            "input_amount", "output_amount",
        ],
        "accepted": _CHAIN_PAIR,
        "unique": [["origin_chain_id", "deposit_id"]],
    },
    "unified_fills": {
        "not_null": [
            "deposit_id", "fill_timestamp", "transaction_hash", "origin_chain_id", "destination_chain_id",
            "relayer_address", "depositor_address", "recipient_address", "input_token_address",
            "output_token_address", "input_amount", "output_amount", "repayment_chain_id",
        ],
        "accepted": _CHAIN_PAIR,
    },
    "unified_refunds": {
        "not_null": [
            "chain_id", "root_bundle_id", "leaf_id", "refund_timestamp", "transaction_hash",
            "refund_token_address", "total_refund_amount", "total_refund_amount_raw", "refund_count",
            "refund_amounts_string", "refund_addresses_string", "source_blockchain",
        ],
        "accepted": {"chain_id": _CHAIN_IDS},
    },
    "refunds_expanded": {
        "not_null": [
            "refund_id", "refund_timestamp", "transaction_hash", "chain_id", "root_bundle_id", "leaf_id",
            "refund_index", "relayer_address", "refund_token_address", "refund_amount", "refund_amount_raw",
            "batch_total_amount", "batch_total_amount_raw", "batch_refund_count", "source_blockchain",
        ],
        "unique": [["refund_id"]],
    },
    "deposit_fill_matching": {
        "not_null": [
            "deposit_id", "deposit_timestamp", "deposit_tx_hash", "origin_chain_id", "destination_chain_id",
            "depositor_address", "deposit_recipient", "deposit_token", "deposit_amount",
            "expected_output_amount", "is_filled", "route_id",
        ],
        "accepted": {**_CHAIN_PAIR, "is_filled": [True, False]},
    },
    "general_overview": {
        "not_null": [*_MART_KEYS, "total_deposits", "total_fills", "unique_depositors"],
        "accepted": _CHAIN_PAIR,
    },
    "fill_latency_analysis": {
        "not_null": [
            *_MART_KEYS, "total_deposits", "total_fills", "unfilled_count", "instant_fill_count",
            "fast_fill_count", "slow_fill_count", "very_slow_fill_count", "liquidity_gap_status",
        ],
        "accepted": {**_CHAIN_PAIR, "liquidity_gap_status": ["CRITICAL", "HIGH", "MODERATE", "HEALTHY"]},
    },
    "bridge_fee_analysis": {
        "not_null": [
            *_MART_KEYS, "total_fills", "pricing_tier", "fee_volatility_tier", "unique_depositors", "gas_cost_tier",
        ],
        "accepted": {
            **_CHAIN_PAIR,
            "pricing_tier": ["OVERPRICED", "HIGH", "COMPETITIVE", "AGGRESSIVE", "VERY_LOW"],
            "fee_volatility_tier": ["HIGH_VOLATILITY", "MODERATE_VOLATILITY", "LOW_VOLATILITY", "STABLE"],
            "gas_cost_tier": ["VERY_HIGH", "HIGH", "MEDIUM", "LOW", "VERY_LOW"],
        },
    },
}
