"""The fixed values, written out again: the SQL restatements share them with the operators."""

from spanledger import constants as C
from spanledger.model_rules import MODEL_RULES
from spanledger.plans.star_input import CHAINS, TOKENS


def test_tiers():
    assert C.LATENCY_TIERS == [(60, "CRITICAL"), (30, "MODERATE"), (10, "FAST")] and C.LATENCY_REST == "VERY_FAST"
    assert C.LIQUIDITY_GAP_TIERS == [(100, "CRITICAL"), (30, "HIGH"), (15, "MODERATE")] and C.LIQUIDITY_GAP_REST == "HEALTHY"
    assert C.PRICING_TIERS == [(0.5, "OVERPRICED"), (0.1, "HIGH"), (0.02, "COMPETITIVE"), (0.005, "AGGRESSIVE")]
    assert C.VOLATILITY_TIERS == [(1.0, "HIGH_VOLATILITY"), (0.3, "MODERATE_VOLATILITY"), (0.05, "LOW_VOLATILITY")]
    assert C.GAS_TIERS == [(0.05, "VERY_HIGH"), (0.001, "HIGH"), (0.0001, "MEDIUM"), (0.00001, "LOW")]
    assert C.CONCENTRATION_TIERS == [(90, "CRITICAL"), (80, "HIGH"), (60, "MODERATE")] and C.CONCENTRATION_REST == "HEALTHY"
    assert (C.INSTANT_SECONDS, C.FAST_SECONDS, C.SLOW_SECONDS, C.VERY_SLOW_SECONDS) == (30, 60, 300, 900)


def test_chains_and_tokens():
    assert C.SUPPORTED_CHAIN_IDS == [1, 10, 56, 130, 137, 143, 480, 999, 8453, 42161, 59144]
    assert {C.NATIVE_TOKENS[i] for i in (1, 10, 130, 480, 999, 8453, 42161, 59144)} == {"WETH"}
    assert (C.NATIVE_TOKENS[56], C.NATIVE_TOKENS[137], C.NATIVE_TOKENS[143]) == ("BNB", "POL", "MON")
    assert len(set(C.EXCLUDED_DEPOSIT_TOKENS)) == 6 and all(len(t) == 42 and t == t.lower() for t in C.EXCLUDED_DEPOSIT_TOKENS)
    assert C.METADATA_EXEMPT_TOKENS == C.EXCLUDED_DEPOSIT_TOKENS[:1]
    assert (C.DEFAULT_DECIMALS, C.DEFAULT_TOKEN_PRICE, C.DEFAULT_GAS_PRICE) == (18, 1.0, 0.0)
    assert {e[:10] for e in (C.FILLED_RELAY, C.EXECUTED_REFUND, C.FUNDS_DEPOSITED)} == {"0x44b559f1", "0xf4ad9258", "0x32ed1a40"}


def test_input_and_rule_lists():
    assert len(CHAINS) == 16 and sum(i in C.SUPPORTED_CHAIN_IDS for _, i in CHAINS) == 11
    assert [s for s, _, _ in TOKENS] == ["USDC", "USDT", "WETH", "DAI", "WBTC", "USDC.e", None]
    assert len(MODEL_RULES) > 0
