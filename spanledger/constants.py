"""Event signatures, chain ids, token lists and tier bounds.

They must equal the values used on the chains and in the published
definitions of the metrics, so they are stated here as plain text.
"""

# Event signature hashes (topic 0).
FILLED_RELAY = "0x44b559f101f8fbcc8a0ea43fa91a05a729a5ea6e14a7c75aa750374690137208"
EXECUTED_REFUND = "0xf4ad92585b1bc117fbdd644990adf0827bc4c95baeae8a23322af807b6d0020e"
FUNDS_DEPOSITED = "0x32ed1a409ef04c7b0227189c3a103dc5ac10e775a15b785dcc510201f7c25ad3"

ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"

# Chains with extracted logs: name -> chain id.
SUPPORTED_CHAINS = {
    "arbitrum": 42161,
    "ethereum": 1,
    "polygon": 137,
    "linea": 59144,
    "worldchain": 480,
    "unichain": 130,
    "hyperevm": 999,
    "monad": 143,
    "base": 8453,
    "bsc": 56,
    "optimism": 10,
}
SUPPORTED_CHAIN_IDS = sorted(SUPPORTED_CHAINS.values())

# Token whose price values the gas of a chain: chain id -> symbol.
NATIVE_TOKENS = {
    1: "WETH",
    42161: "WETH",
    137: "POL",
    59144: "WETH",
    480: "WETH",
    130: "WETH",
    999: "WETH",
    143: "MON",
    8453: "WETH",
    56: "BNB",
    10: "WETH",
}

# Deposit tokens left out of matching (no price source).
EXCLUDED_DEPOSIT_TOKENS = [
    "0x25788a1a171ec66da6502f9975a15b609ff54cf6",  # POL on Polygon
    "0x0cec1a9154ff802e7934fc916ed7ca50bde6844e",  # POOL on Ethereum
    "0xd652c5425aea2afd5fb142e120fecf79e18fafc3",  # POOL on Base
    "0xcf934e2402a5e072928a39a956964eb8f2b5b79c",  # POOL on Arbitrum
    "0x4e107a0000db66f0e9fd2039288bf811dd1f9c74",  # VELORA on Base
    "0x395ae52bb17aef68c2888d941736a71dc6d4e125",  # POOL on Optimism
]
# Tokens known to have no metadata, not reported by the coverage check.
METADATA_EXEMPT_TOKENS = ["0x25788a1a171ec66da6502f9975a15b609ff54cf6"]

DEFAULT_DECIMALS = 18
DEFAULT_TOKEN_PRICE = 1.0
DEFAULT_GAS_PRICE = 0.0

# Symbol prefixes folded into one base token.
BASE_TOKENS = ["USDC", "USDT", "DAI", "WETH", "WBTC"]
STABLECOINS = ["USDC", "USDT", "DAI"]

# Tiers: (exclusive lower bound, label) from high to low, then the rest.
LATENCY_TIERS = [(60, "CRITICAL"), (30, "MODERATE"), (10, "FAST")]
LATENCY_REST = "VERY_FAST"
LIQUIDITY_GAP_TIERS = [(100, "CRITICAL"), (30, "HIGH"), (15, "MODERATE")]
LIQUIDITY_GAP_REST = "HEALTHY"
PRICING_TIERS = [(0.5, "OVERPRICED"), (0.1, "HIGH"), (0.02, "COMPETITIVE"), (0.005, "AGGRESSIVE")]
PRICING_REST = "VERY_LOW"
VOLATILITY_TIERS = [(1.0, "HIGH_VOLATILITY"), (0.3, "MODERATE_VOLATILITY"), (0.05, "LOW_VOLATILITY")]
VOLATILITY_REST = "STABLE"
GAS_TIERS = [(0.05, "VERY_HIGH"), (0.001, "HIGH"), (0.0001, "MEDIUM"), (0.00001, "LOW")]
GAS_REST = "VERY_LOW"
CONCENTRATION_TIERS = [(90, "CRITICAL"), (80, "HIGH"), (60, "MODERATE")]
CONCENTRATION_REST = "HEALTHY"

# Seconds that bound the fill-speed buckets.
INSTANT_SECONDS = 30
FAST_SECONDS = 60
SLOW_SECONDS = 300
VERY_SLOW_SECONDS = 900
