"""Staging, unification, matching and marts on literal rows."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions.numbers import exact_sum, round_half_up, text_to_bigint, tier
from spanledger.functions.times import text_to_timestamp
from spanledger.operators import marts, matching, staging, unify
from spanledger.operators.percentiles import grouped_median
from spanledger.schemas import LANDED

T0 = datetime(2024, 1, 5, 10, 59, 30)
USDC, WETH, NEW = "0x" + "a" * 40, "0x" + "b" * 40, "0x" + "c" * 40


def landed(spark, *rows):
    full = [tuple(r.get(c) for c in LANDED) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} {t}" for c, t in LANDED.items()))


def deposit(**kw):
    base = dict(
        timestamp_datetime=T0, transactionHash="0xd", topic_0=C.FUNDS_DEPOSITED, blockchain="ethereum", source_file="f",
        topic_destination_chain_id=8453, topic_deposit_id=1, topic_depositor="0xdep", funds_deposited_data_input_token=USDC.upper().replace("X", "x"),
        funds_deposited_data_output_token=USDC, funds_deposited_data_input_amount=5e6, funds_deposited_data_output_amount=4.9e6,
        funds_deposited_data_recipient="0xrec",
    )
    return base | kw


def fill(**kw):
    base = dict(
        timestamp_datetime=T0 + timedelta(seconds=4), transactionHash="0xf", topic_0=C.FILLED_RELAY, blockchain="base", source_file="f",
        topic_origin_chain_id=1, topic_deposit_id=1, topic_relayer="0xrel", filled_relay_data_input_token=USDC,
        filled_relay_data_output_token=USDC, filled_relay_data_input_amount=5e6, filled_relay_data_output_amount=4.8e6,
        filled_relay_data_repayment_chain_id=1.0, filled_relay_data_depositor="0xdep", filled_relay_data_recipient="0xrec",
        gas_price_wei=10**9, gas_used=100000,
    )
    return base | kw


def refund(**kw):
    base = dict(
        timestamp_datetime=T0, transactionHash="0xe", topic_0=C.EXECUTED_REFUND, blockchain="base", source_file="f", topic_chain_id=8453,
        topic_root_bundle_id=3, topic_leaf_id=1, amount_to_return=6e6, l2_token_address=USDC.upper().replace("X", "x"),
        refund_amounts="1000000, 2000000,3000000", refund_addresses="0x1,0x2,0x3", refund_count=3,
    )
    return base | kw


@pytest.fixture(scope="module")
def dims(spark):
    chains = spark.createDataFrame([(1, "ethereum"), (8453, "base"), (137, "polygon")], "chain_id BIGINT, chain_name STRING")
    tokens = spark.createDataFrame(
        [("Ethereum", 1, USDC, "USDC", 6), ("base", 8453, USDC, "USDC.e", 6), ("ethereum", 1, WETH, "WETH", 18)],
        "chain STRING, chain_id BIGINT, token_address STRING, token_symbol STRING, decimals INT",
    )
    prices = spark.createDataFrame(
        [("USDC", T0.replace(minute=1), 0.5), ("USDC", T0.replace(minute=50), 1.5), ("WETH", T0 + timedelta(hours=-1), 9.0)],
        "token_symbol STRING, timestamp TIMESTAMP, price_usd DOUBLE",
    )
    return chains, tokens, unify.hourly_prices(prices)


def matched(spark, dims, deposits, fills):
    chains, tokens, hourly = dims
    d = unify.unify_deposits(staging.stage_deposits(landed(spark, *deposits), tokens), chains, hourly)
    f = unify.unify_fills(staging.stage_fills(landed(spark, *fills), tokens), chains, hourly)
    return matching.match_deposits_to_fills(d, f, hourly)


def test_stage_deposits_scales_and_names(spark, dims):
    rows = landed(
        spark,
        deposit(),
        deposit(topic_deposit_id=2, funds_deposited_data_output_token=C.ZERO_ADDRESS),
        deposit(topic_deposit_id=3, funds_deposited_data_input_token=NEW, funds_deposited_data_input_amount=2e18),
        deposit(topic_deposit_id=None),
        deposit(topic_deposit_id=5, funds_deposited_data_input_amount=None),
        fill(),
    )
    got = {r.deposit_id: r for r in staging.stage_deposits(rows, dims[1]).collect()}
    assert sorted(got) == [1, 2, 3]
    assert (got[1].input_amount, got[1].output_amount, got[1].input_token_symbol, got[1].output_token_symbol) == (5.0, 4.9, "USDC", "USDC.e")
    assert got[2].output_amount == 4.9  # native output in the input token's decimals
    assert (got[3].input_amount, got[3].input_token_symbol) == (2.0, None)  # 18 decimals by default


def test_fill_output_has_no_native_rule_and_gas_is_exact(spark, dims):
    rows = landed(spark, fill(filled_relay_data_output_token=C.ZERO_ADDRESS, gas_price_wei=2**62, gas_used=2**40 + 1))
    row = staging.stage_fills(rows, dims[1]).first()
    assert row.output_amount == 4.8e6 / 1e18
    assert int(row.gas_cost_wei) == 2**62 * (2**40 + 1)


def test_unsupported_chains_drop_out(spark, dims):
    chains, tokens, hourly = dims
    rows = landed(spark, deposit(), deposit(topic_deposit_id=2, topic_destination_chain_id=324), deposit(topic_deposit_id=3, blockchain="zksync"))
    out = unify.unify_deposits(staging.stage_deposits(rows, tokens), chains, hourly).collect()
    assert [r.deposit_id for r in out] == [1]
    assert (out[0].origin_chain_name, out[0].destination_chain_name, out[0].input_token_price_usd, out[0].input_amount_usd) == ("ethereum", "base", 1.0, 5.0)


def test_refund_lists_pair_by_position(spark, dims):
    chains, tokens, hourly = dims
    rows = landed(
        spark,
        refund(),
        refund(topic_leaf_id=2, refund_addresses="0x1,0x2", refund_count=3),
        refund(topic_leaf_id=3, refund_amounts="", refund_addresses="", refund_count=0),
        refund(topic_leaf_id=4, refund_amounts="", refund_addresses="", refund_count=1),
    )
    u = unify.unify_refunds(staging.stage_refunds(rows), chains, tokens)
    assert u.first().total_refund_amount == 6.0
    got = unify.expand_refunds(u, hourly).orderBy("leaf_id", "refund_index").collect()
    assert [(r.leaf_id, r.refund_index, r.relayer_address, r.refund_amount) for r in got] == [
        (1, 1, "0x1", 1.0), (1, 2, "0x2", 2.0), (1, 3, "0x3", 3.0), (2, 1, "0x1", 1.0), (2, 2, "0x2", 2.0),
    ]
    assert got[0].refund_id == "0xe-1-1" and got[0].refund_amount_usd == 1.0  # USDC.e has no price


def test_match_metrics(spark, dims):
    row = matched(spark, dims, [deposit()], [fill()]).first()
    assert len(row) == 38
    assert (row.fill_latency_seconds, row.is_filled, row.latency_tier) == (4.0, True, "VERY_FAST")
    assert (row.bridge_fee_nominal, row.bridge_fee_percent, row.slippage_percent) == (0.2, 4.0, 2.04)
    assert (row.gas_cost_native, row.gas_cost_usd) == (0.0001, 0.0)  # no gas price counts 0
    assert (row.deposit_amount_usd, row.fill_amount_usd) == (5.0, 4.8)  # no token price counts 1
    assert (row.route_name, row.route_id) == ("ethereum → base", "1_8453")


def test_unfilled_fanout_clamp_and_zero_input(spark, dims):
    out = matched(
        spark,
        dims,
        [deposit(), deposit(topic_deposit_id=2), deposit(topic_deposit_id=3, funds_deposited_data_input_amount=0.0, funds_deposited_data_output_amount=0.0)],
        [fill(), fill(transactionHash="0xf2", timestamp_datetime=T0 - timedelta(seconds=9)), fill(topic_deposit_id=3), fill(topic_deposit_id=2, blockchain="polygon")],
    ).collect()
    by = {(r.deposit_id, r.fill_tx_hash): r for r in out}
    assert set(by) == {(1, "0xf"), (1, "0xf2"), (2, None), (3, "0xf")}
    assert by[1, "0xf2"].fill_latency_seconds == 0.0
    unfilled = by[2, None]
    assert (unfilled.is_filled, unfilled.fill_latency_seconds, unfilled.latency_tier, unfilled.gas_cost_usd) == (False, None, None, None)
    assert (by[3, "0xf"].bridge_fee_percent, by[3, "0xf"].slippage_percent) == (None, None)


def test_excluded_tokens(spark, dims):
    deposits = [deposit(topic_deposit_id=i, funds_deposited_data_input_token=t) for i, t in enumerate(C.EXCLUDED_DEPOSIT_TOKENS)]
    assert len(C.EXCLUDED_DEPOSIT_TOKENS) == 6
    assert [r.deposit_id for r in matched(spark, dims, [*deposits, deposit(topic_deposit_id=99)], []).collect()] == [99]


def test_pairing_equals_left_join_with_a_hot_deposit(spark):
    """A third of all fills on one deposit: same rows as a plain left join."""
    rng = random.Random(3)
    dep = [(i, rng.choice([1, 10]), 56) for i in range(200)]
    fil = [(7, *dep[7][1:])] * 300 + [(rng.randrange(250), rng.choice([1, 10]), 56) for _ in range(600)]
    key = "deposit_id BIGINT, origin_chain_id BIGINT, destination_chain_id BIGINT"
    d = spark.createDataFrame(dep, key)
    f = spark.createDataFrame([(*k, f"x{i}") for i, k in enumerate(fil)], key + ", transaction_hash STRING")
    for name in ["deposit_timestamp", "fill_timestamp"]:
        d, f = d.withColumn(name, F.lit(T0)), f.withColumn(name, F.lit(T0))
    blank = lambda df, names: df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})
    d = blank(d, ["transaction_hash", "origin_chain_name", "destination_chain_name", "depositor_address", "recipient_address",
                  "input_token_address", "input_token_symbol", "input_amount", "output_amount", "input_token_price_usd"])
    f = blank(f, ["relayer_address", "output_token_address", "fill_token_symbol", "output_amount", "repayment_chain_id",
                  "output_token_price_usd", "gas_price_wei", "gas_used", "gas_cost_wei"])
    got = matching.pair_deposits_with_fills(d, f).select("deposit_id", "fill_tx_hash", "is_filled").collect()
    want = []
    for k in dep:
        hits = [f"x{i}" for i, fk in enumerate(fil) if fk == k]
        want += [(k[0], h, True) for h in hits] or [(k[0], None, False)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize(
    "bounds, rest",
    [
        (C.LATENCY_TIERS, C.LATENCY_REST), (C.LIQUIDITY_GAP_TIERS, C.LIQUIDITY_GAP_REST), (C.PRICING_TIERS, C.PRICING_REST),
        (C.VOLATILITY_TIERS, C.VOLATILITY_REST), (C.GAS_TIERS, C.GAS_REST), (C.CONCENTRATION_TIERS, C.CONCENTRATION_REST),
    ],
)
def test_tier_bounds_are_exclusive(spark, bounds, rest):
    labels = [label for _, label in bounds] + [rest]
    rows = [(float(b), labels[i + 1]) for i, (b, _) in enumerate(bounds)]
    rows += [(b * 1.0001, label) for b, label in bounds] + [(None, rest), (-1.0, rest)]
    df = spark.createDataFrame(rows, "x DOUBLE, want STRING")
    assert df.filter(tier(F.col("x"), bounds, rest) != F.col("want")).count() == 0


def test_rounding_and_sums(spark):
    df = spark.createDataFrame([(1.005,), (1237.1549999999998,), (-1.005,), (2.5e40,), (None,)], "x DOUBLE")
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()] == [1.01, 1237.16, -1.01, 2.5e40, None]
    sums = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", 1e30), ("b", 0.25), ("c", None)], "k STRING, x DOUBLE")
    assert dict(sums.groupBy("k").agg(exact_sum(F.col("x"))).collect()) == {"a": 0.3, "b": 1e30, "c": None}


def test_text_columns(spark):
    df = spark.createDataFrame([("1704067200",), ("2024-01-01 00:00:00",), ("soon",), (None,)], "t STRING")
    got = [r[0] for r in df.select(F.unix_seconds(text_to_timestamp(F.col("t")))).collect()]
    assert got == [1704067200, 1704067200, None, None]
    assert spark.createDataFrame([("8453.0",), ("12",)], "t STRING").select(text_to_bigint(F.col("t"))).collect() == [(8453,), (12,)]


def test_grouped_median_against_python(spark):
    rng = random.Random(5)
    rows = [(f"g{rng.randrange(6)}", rng.choice([None, *range(9)])) for _ in range(400)] + [("hot", rng.randrange(10**12)) for _ in range(301)]
    rows += [("one", 4), ("none", None)]
    got = dict(grouped_median(spark.createDataFrame(rows, "k STRING, v BIGINT"), ["k"], "v", "m").collect())
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert got == {k: float(statistics.median(v)) for k, v in groups.items()}


def test_overview_keeps_rows_without_time(spark, dims):
    m = matched(spark, dims, [deposit(), deposit(topic_deposit_id=2, timestamp_datetime=None)], [fill()])
    rows = marts.general_overview(m, dims[0], dims[1]).collect()
    assert {(r.deposit_minute, r.total_deposits, r.unique_depositors) for r in rows} == {(T0.replace(second=0), 1, 1), (None, 1, 1)}
    latency = {r.deposit_minute: r for r in marts.fill_latency_analysis(m, dims[0], dims[1]).collect()}
    assert (latency[None].p95_ttf_seconds, latency[None].instant_fill_pct, latency[None].liquidity_gap_status) == (None, None, "HEALTHY")
    assert (latency[T0.replace(second=0)].instant_fill_pct, latency[T0.replace(second=0)].very_slow_fill_count) == (100.0, 0)


def test_fee_mart_single_fill(spark, dims):
    row = marts.bridge_fee_analysis(matched(spark, dims, [deposit()], [fill()]), dims[0], dims[1]).first()
    assert (row.fee_std_dev, row.fee_volatility_tier, row.effective_fee_pct, row.pricing_tier) == (None, "STABLE", 4.0, "OVERPRICED")
    assert (row.median_gas_price_gwei, row.avg_gas_cost_native, row.gas_cost_tier) == (1.0, 0.0001, "LOW")
    assert (row.token_symbol, row.base_token_symbol) == ("USDC", "USDC")


def test_concentration_top3_with_ties(spark):
    rows = [("o", "d", "o → d", f"0x{i}", v, True) for i, v in enumerate([10.0, 10.0, 10.0, 10.0, 5.0])] + [("o", "e", "o → e", "0x1", 0.0, True)]
    m = spark.createDataFrame(
        rows, "origin_chain_name STRING, destination_chain_name STRING, route_name STRING, relayer_address STRING, fill_amount_usd DOUBLE, is_filled BOOLEAN"
    )
    (row,) = marts.route_concentration_risk(m).collect()
    assert (row.total_volume_usd, row.top_3_relayer_volume_usd, row.filler_dominance_index_pct, row.concentration_risk) == (45.0, 30.0, 66.67, "MODERATE")
