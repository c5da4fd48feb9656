"""Dashboard tables over the match fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions.numbers import exact_sum, percent_of, round_half_up, tier
from spanledger.operators.percentiles import grouped_percentiles

GRAIN = ["deposit_minute", "origin_chain_id", "destination_chain_id", "route_id", "deposit_token"]
LABELS = ["origin_chain_name", "destination_chain_name", "route_name", "token_symbol", "base_token_symbol"]


# Stands for "no time" while rows are grouped and joined: a NULL key would be
# lost in the joins below. The other keys of the grain are never NULL.
NO_TIME = "0001-01-01 00:00:00"


def with_minute(match: DataFrame) -> DataFrame:
    minute = F.date_trunc("minute", "deposit_timestamp")
    return match.withColumn("deposit_minute", F.coalesce(minute, F.lit(NO_TIME).cast("timestamp")))


def with_distinct_counts(metrics: DataFrame, rows: DataFrame, counted: dict[str, Column]) -> DataFrame:
    """Joins exact distinct counts per grain to the other metrics.

    Counted apart, since several distinct counts multiply the rows they are
    computed from, and here those rows are the keys and addresses alone. Both
    sides end up partitioned by the grain, so the join moves nothing.
    """
    counts = rows.groupBy(*GRAIN).agg(*[F.count_distinct(c).alias(n) for n, c in counted.items()])
    return metrics.join(counts, GRAIN)


def base_symbol(symbol: Column) -> Column:
    """Bridged variants such as USDC.e count as their base token."""
    return F.coalesce(*[F.when(symbol.startswith(b), b) for b in C.BASE_TOKENS], symbol)


def with_labels(metrics: DataFrame, chain_metadata: DataFrame, token_metadata: DataFrame) -> DataFrame:
    """Chain names and token symbols, joined after the aggregation."""
    df = metrics
    for role in ("origin", "destination"):
        names = chain_metadata.select(
            F.col("chain_id").cast("bigint").alias(f"{role}_chain_id"), F.col("chain_name").alias(f"{role}_chain_name")
        )
        df = df.join(names, f"{role}_chain_id", "left")
    tokens = token_metadata.select(
        F.col("chain_id").cast("bigint").alias("_chain_id"), F.lower("token_address").alias("_address"), "token_symbol"
    )
    df = df.join(
        tokens, (F.col("origin_chain_id") == F.col("_chain_id")) & (F.lower("deposit_token") == F.col("_address")), "left"
    )
    return df.drop("_chain_id", "_address").withColumns(
        {
            "deposit_minute": F.nullif("deposit_minute", F.lit(NO_TIME).cast("timestamp")),
            "route_name": F.concat("origin_chain_name", F.lit(" → "), "destination_chain_name"),
            "base_token_symbol": base_symbol(F.col("token_symbol")),
        }
    )


def _when_filled(col: str) -> Column:
    return F.when(F.col("is_filled"), F.col(col))


def _fills() -> Column:
    return F.count_if("is_filled")


def _fill_rate() -> Column:
    return percent_of(_fills(), F.count("*"), 2)


def with_percentiles(metrics: DataFrame, rows: DataFrame, values: dict[str, Column], wanted: dict[str, tuple[str, float]], places: int) -> DataFrame:
    """Joins exact percentiles per grain to the other metrics, which so stay a plain hash aggregate."""
    found = grouped_percentiles(rows, GRAIN, values, wanted)
    return metrics.join(found, GRAIN, "left").withColumns({n: round_half_up(F.col(n), places) for n in wanted})


def general_overview(match: DataFrame, chain_metadata: DataFrame, token_metadata: DataFrame) -> DataFrame:
    """Volumes, activity, fill rate, latency and fees per minute, route and token."""
    rows = with_minute(match)
    metrics = (
        rows.groupBy(*GRAIN)
        .agg(
            F.count("*").alias("total_deposits"),
            _fills().alias("total_fills"),
            F.sum("deposit_amount").alias("total_deposit_volume"),
            F.sum(F.coalesce(_when_filled("actual_output_amount"), F.lit(0.0))).alias("total_filled_volume"),
            exact_sum(F.col("deposit_amount_usd")).alias("total_deposit_volume_usd"),
            exact_sum(F.coalesce(_when_filled("fill_amount_usd"), F.lit(0.0))).alias("total_filled_volume_usd"),
            _fill_rate().alias("fill_rate_pct"),
            round_half_up(F.avg(_when_filled("fill_latency_seconds")), 2).alias("avg_fill_latency_seconds"),
            exact_sum(F.coalesce(_when_filled("bridge_fee_nominal"), F.lit(0.0))).alias("total_bridge_fees"),
            round_half_up(F.avg(_when_filled("bridge_fee_percent")), 4).alias("avg_bridge_fee_pct"),
            round_half_up(F.avg(_when_filled("slippage_percent")), 4).alias("avg_slippage_pct"),
        )
    )
    metrics = with_distinct_counts(
        metrics,
        rows,
        {"unique_depositors": F.col("depositor_address"), "unique_relayers": _when_filled("relayer_address")},
    )
    seconds = {"seconds": _when_filled("fill_latency_seconds")}
    metrics = with_percentiles(metrics, rows, seconds, {"median_fill_latency_seconds": ("seconds", 0.5)}, 2)
    return with_labels(metrics, chain_metadata, token_metadata).select(
        "deposit_minute",
        "origin_chain_id",
        "origin_chain_name",
        "destination_chain_id",
        "destination_chain_name",
        "route_id",
        "route_name",
        "deposit_token",
        "token_symbol",
        "base_token_symbol",
        "total_deposits",
        "total_fills",
        "total_deposit_volume",
        "total_filled_volume",
        "total_deposit_volume_usd",
        "total_filled_volume_usd",
        "unique_depositors",
        "unique_relayers",
        "fill_rate_pct",
        "avg_fill_latency_seconds",
        "median_fill_latency_seconds",
        "total_bridge_fees",
        "avg_bridge_fee_pct",
        "avg_slippage_pct",
    )


def fill_latency_analysis(match: DataFrame, chain_metadata: DataFrame, token_metadata: DataFrame) -> DataFrame:
    """Time to fill per minute, route and token, with speed buckets and a gap status."""
    seconds = _when_filled("fill_latency_seconds")
    rows = with_minute(match)
    metrics = (
        rows.groupBy(*GRAIN)
        .agg(
            F.count("*").alias("total_deposits"),
            _fills().alias("total_fills"),
            F.count_if(~F.col("is_filled")).alias("unfilled_count"),
            _fill_rate().alias("fill_rate_pct"),
            round_half_up(F.avg(seconds), 2).alias("avg_ttf_seconds"),
            F.min(seconds).alias("min_ttf_seconds"),
            F.max(seconds).alias("max_ttf_seconds"),
            F.count_if(seconds <= C.INSTANT_SECONDS).alias("instant_fill_count"),
            F.count_if(seconds <= C.FAST_SECONDS).alias("fast_fill_count"),
            F.count_if(seconds > C.SLOW_SECONDS).alias("slow_fill_count"),
            F.count_if(seconds > C.VERY_SLOW_SECONDS).alias("very_slow_fill_count"),
            exact_sum(F.col("deposit_amount_usd")).alias("total_deposit_volume_usd"),
            exact_sum(F.coalesce(_when_filled("fill_amount_usd"), F.lit(0.0))).alias("total_filled_volume_usd"),
        )
    )
    metrics = with_distinct_counts(metrics, rows, {"unique_relayers": _when_filled("relayer_address")})
    wanted = {"median_ttf_seconds": ("seconds", 0.5), "p95_ttf_seconds": ("seconds", 0.95)}
    metrics = with_percentiles(metrics, rows, {"seconds": seconds}, wanted, 2)
    buckets = ["instant", "fast", "slow", "very_slow"]
    insights = metrics.withColumns(
        {f"{b}_fill_pct": percent_of(F.col(f"{b}_fill_count"), F.col("total_fills"), 2) for b in buckets}
        | {"liquidity_gap_status": tier(F.col("p95_ttf_seconds"), C.LIQUIDITY_GAP_TIERS, C.LIQUIDITY_GAP_REST)}
    )
    return with_labels(insights, chain_metadata, token_metadata).select(
        "deposit_minute",
        "origin_chain_id",
        "origin_chain_name",
        "destination_chain_id",
        "destination_chain_name",
        "route_id",
        "route_name",
        "deposit_token",
        "token_symbol",
        "base_token_symbol",
        "total_deposits",
        "total_fills",
        "unfilled_count",
        "fill_rate_pct",
        "total_deposit_volume_usd",
        "total_filled_volume_usd",
        "avg_ttf_seconds",
        "median_ttf_seconds",
        "p95_ttf_seconds",
        "min_ttf_seconds",
        "max_ttf_seconds",
        *[f"{b}_fill_count" for b in buckets],
        *[f"{b}_fill_pct" for b in buckets],
        "liquidity_gap_status",
        "unique_relayers",
    )


def bridge_fee_analysis(match: DataFrame, chain_metadata: DataFrame, token_metadata: DataFrame) -> DataFrame:
    """Fees, slippage and gas cost of filled deposits per minute, route and token."""
    filled = with_minute(match.filter("is_filled"))
    fee_usd = F.col("bridge_fee_nominal") * F.coalesce("deposit_token_price_usd", F.lit(C.DEFAULT_TOKEN_PRICE))
    fee_pct, slippage, gas_usd = F.col("bridge_fee_percent"), F.col("slippage_percent"), F.col("gas_cost_usd")
    gas_total = F.coalesce(F.try_sum("gas_cost_wei").cast("double"), F.sum(F.col("gas_cost_wei").cast("double")))
    metrics = filled.groupBy(*GRAIN).agg(
        F.count("*").alias("total_fills"),
        exact_sum(F.col("deposit_amount_usd")).alias("total_deposit_volume_usd"),
        exact_sum(F.col("fill_amount_usd")).alias("total_filled_volume_usd"),
        F.sum(fee_usd).alias("total_fees_usd"),
        percent_of(F.sum(fee_usd), exact_sum(F.col("deposit_amount_usd")), 4).alias("effective_fee_pct"),
        round_half_up(F.avg(fee_pct), 4).alias("avg_fee_pct"),
        round_half_up(F.stddev_samp(fee_pct), 4).alias("fee_std_dev"),
        round_half_up(F.min(fee_pct), 4).alias("min_fee_pct"),
        round_half_up(F.max(fee_pct), 4).alias("max_fee_pct"),
        round_half_up(F.avg(slippage), 4).alias("avg_slippage_pct"),
        round_half_up(F.avg(F.col("gas_price_wei").cast("decimal(19,0)")).cast("double") / 1e9, 4).alias("avg_gas_price_gwei"),
        round_half_up(gas_total / 1e18, 8).alias("total_gas_cost_native"),
        round_half_up(gas_total / F.nullif(F.count("gas_cost_wei"), F.lit(0)) / 1e18, 8).alias("avg_gas_cost_native"),
        exact_sum(gas_usd).alias("total_gas_cost_usd"),
        round_half_up(exact_sum(gas_usd) / F.nullif(F.count(gas_usd), F.lit(0)), 4).alias("avg_gas_cost_usd"),
    )
    metrics = with_distinct_counts(
        metrics,
        filled,
        {"unique_depositors": F.col("depositor_address"), "unique_relayers": F.col("relayer_address")},
    )
    values = {"fee": fee_pct, "slippage": slippage, "gas": F.col("gas_price_wei").cast("double") / 1e9}
    wanted = {"median_fee_pct": ("fee", 0.5), "median_slippage_pct": ("slippage", 0.5), "median_gas_price_gwei": ("gas", 0.5)}
    insights = with_percentiles(metrics, filled, values, wanted, 4).withColumns(
        {
            "fee_spread_pct": round_half_up(F.col("max_fee_pct") - F.col("min_fee_pct"), 4),
            "pricing_tier": tier(F.col("effective_fee_pct"), C.PRICING_TIERS, C.PRICING_REST),
            "fee_volatility_tier": tier(F.col("fee_std_dev"), C.VOLATILITY_TIERS, C.VOLATILITY_REST),
            "gas_cost_tier": tier(F.col("avg_gas_cost_native"), C.GAS_TIERS, C.GAS_REST),
        }
    )
    return with_labels(insights, chain_metadata, token_metadata).select(
        "deposit_minute",
        "origin_chain_id",
        "origin_chain_name",
        "destination_chain_id",
        "destination_chain_name",
        "route_id",
        "route_name",
        "deposit_token",
        "token_symbol",
        "base_token_symbol",
        "total_fills",
        "total_deposit_volume_usd",
        "total_filled_volume_usd",
        "total_fees_usd",
        "effective_fee_pct",
        "avg_fee_pct",
        "median_fee_pct",
        "fee_std_dev",
        "min_fee_pct",
        "max_fee_pct",
        "fee_spread_pct",
        "avg_slippage_pct",
        "median_slippage_pct",
        "pricing_tier",
        "fee_volatility_tier",
        "unique_depositors",
        "unique_relayers",
        "avg_gas_price_gwei",
        "median_gas_price_gwei",
        "total_gas_cost_native",
        "avg_gas_cost_native",
        "total_gas_cost_usd",
        "avg_gas_cost_usd",
        "gas_cost_tier",
    )


RELAYER_ROUTE = ["origin_chain_name", "destination_chain_name", "route_name", "relayer_address"]


def relayer_volume_by_route(match: DataFrame, *by: str) -> DataFrame:
    """USD filled per relayer and route, and per further columns, such as the day."""
    return (
        match.filter(
            F.col("is_filled")
            & F.col("relayer_address").isNotNull()
            & F.col("route_name").isNotNull()
            & (F.col("fill_amount_usd") > 0)
        )
        .groupBy(*by, *RELAYER_ROUTE)
        .agg(exact_sum(F.col("fill_amount_usd")).alias("relayer_volume_usd"))
    )


def route_concentration_risk(match: DataFrame) -> DataFrame:
    """Share of each route's volume held by its three largest relayers."""
    return concentration_of(relayer_volume_by_route(match))


def concentration_of(volumes: DataFrame) -> DataFrame:
    """The same from the volumes of relayers and routes.

    Both branches read one row per relayer and route; the rank limit is
    applied before the shuffle, the totals are combined on the map side.
    """
    by_volume = W.partitionBy("route_name").orderBy(F.desc("relayer_volume_usd"), "relayer_address")
    top3 = (
        volumes.withColumn("rank_in_route", F.row_number().over(by_volume))
        .filter(F.col("rank_in_route") <= 3)
        .groupBy("origin_chain_name", "destination_chain_name", "route_name")
        .agg(exact_sum(F.col("relayer_volume_usd")).alias("top3"))
    )
    totals = volumes.groupBy("route_name").agg(exact_sum(F.col("relayer_volume_usd")).alias("total")).filter("total > 0")
    share = F.try_divide("top3", "total") * 100
    return top3.join(totals, "route_name").select(
        "origin_chain_name",
        "destination_chain_name",
        "route_name",
        round_half_up(F.col("total"), 2).alias("total_volume_usd"),
        round_half_up(F.col("top3"), 2).alias("top_3_relayer_volume_usd"),
        round_half_up(share, 2).alias("filler_dominance_index_pct"),
        F.when(share.isNull(), "NO DATA")
        .otherwise(tier(share, C.CONCENTRATION_TIERS, C.CONCENTRATION_REST))
        .alias("concentration_risk"),
    )


def presented(mart: DataFrame) -> DataFrame:
    """A mart in dashboard order (NULLs first, as a descending sort puts them)."""
    if "deposit_minute" in mart.columns:
        return mart.orderBy(F.desc_nulls_first("deposit_minute"), F.desc_nulls_first("total_deposit_volume_usd"))
    return mart.orderBy(F.desc_nulls_first("filler_dominance_index_pct"))
