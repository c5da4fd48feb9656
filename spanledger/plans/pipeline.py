"""The layers wired together: landed logs to staged, unified, matched and mart tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from spanledger.model_rules import MODEL_RULES
from spanledger.operators import marts, matching, rules, staging, unify
from spanledger.operators.decode import decode_logs
from spanledger.operators.ingest import prepare_logs
from spanledger.session import SHUFFLE_CLEANUP, discard, input_bytes, settings, stored
from spanledger.sources.landing import Swap, read_landing, refresh_landing

# A stored match and its marts are written in passes, one for so many bytes of the files read, and in so many at most: what lies shuffled
# is that of one pass.
PASS_BYTES, MOST_PASSES = 64 << 20, 16

# Layers kept as tables because several readers follow; the rest stay lazy.
STORED = ["deposit_fill_matching", "general_overview", "fill_latency_analysis", "bridge_fee_analysis", "route_concentration_risk"]


@dataclass
class Bridge:
    """All models over one set of inputs, as lazy DataFrames.

    ``match`` may be given as a stored table; otherwise it is the lazy plan.
    """

    landed: DataFrame
    chain_metadata: DataFrame
    token_metadata: DataFrame
    token_prices: DataFrame
    match: DataFrame | None = None

    @classmethod
    def from_raw(
        cls,
        raw_logs: DataFrame,
        folder: str,
        chain_metadata: DataFrame,
        token_metadata: DataFrame,
        token_prices: DataFrame,
        receipts: DataFrame | None = None,
        chains: list[str] | None = None,
    ) -> Bridge:
        """Bring raw logs to one shape, add gas, drop copies, decode once into the landing table, then model from that.

        Three models read the decoded logs with different filters; from Parquet
        each reads only its own columns and, as logs are ordered by event, the
        row groups that hold its event. ``chains`` are refreshed even if empty.
        """
        path = f"{folder}/landed_logs"
        spark, gas_path = raw_logs.sparkSession, f"{folder}/receipt_gas"
        refresh_landing(decode_logs(prepare_logs(raw_logs, receipts, gas_path)), path, chains)
        discard(spark, gas_path)
        landed = read_landing(spark, path)
        return cls(landed, chain_metadata, token_metadata, token_prices)

    @cached_property
    def hourly_prices(self) -> DataFrame:
        """One row a token and hour, written once: Spark then knows how small it is, and the facts are priced where they lie."""
        return stored(unify.hourly_prices(self.token_prices))

    @cached_property
    def stage_deposits(self) -> DataFrame:
        return staging.stage_deposits(self.landed, self.token_metadata)

    @cached_property
    def stage_fills(self) -> DataFrame:
        return staging.stage_fills(self.landed, self.token_metadata)

    @cached_property
    def stage_refunds(self) -> DataFrame:
        return staging.stage_refunds(self.landed)

    @cached_property
    def unified_deposits(self) -> DataFrame:
        return unify.unify_deposits(self.stage_deposits, self.chain_metadata, self.hourly_prices)

    @cached_property
    def unified_fills(self) -> DataFrame:
        return unify.unify_fills(self.stage_fills, self.chain_metadata, self.hourly_prices)

    @cached_property
    def unified_refunds(self) -> DataFrame:
        return unify.unify_refunds(self.stage_refunds, self.chain_metadata, self.token_metadata)

    @cached_property
    def refunds_expanded(self) -> DataFrame:
        return unify.expand_refunds(self.unified_refunds, self.hourly_prices)

    @cached_property
    def deposit_fill_matching(self) -> DataFrame:
        if self.match is not None:
            return self.match
        return matching.match_deposits_to_fills(self.unified_deposits, self.unified_fills, self.hourly_prices)

    @cached_property
    def general_overview(self) -> DataFrame:
        return marts.general_overview(self.deposit_fill_matching, self.chain_metadata, self.token_metadata)

    @cached_property
    def fill_latency_analysis(self) -> DataFrame:
        return marts.fill_latency_analysis(self.deposit_fill_matching, self.chain_metadata, self.token_metadata)

    @cached_property
    def bridge_fee_analysis(self) -> DataFrame:
        return marts.bridge_fee_analysis(self.deposit_fill_matching, self.chain_metadata, self.token_metadata)

    @cached_property
    def route_concentration_risk(self) -> DataFrame:
        return marts.route_concentration_risk(self.deposit_fill_matching)

    def match_parts(self) -> list[DataFrame]:
        """The match in parts that together are the whole: its deposits and fills by a hash of the key that joins them."""
        count = passes(self.landed)
        if self.match is not None or count == 1:
            return [self.deposit_fill_matching]
        part = F.pmod(F.xxhash64(*matching.MATCH_KEY), F.lit(count))
        sides = [(self.unified_deposits.filter(part == k), self.unified_fills.filter(part == k)) for k in range(count)]
        return [matching.match_deposits_to_fills(deposits, fills, self.hourly_prices) for deposits, fills in sides]

    def write_match(self, path: str, only_days: list[date] | None = None, observe: bool = False) -> rules.Observed | None:
        """The match as a table partitioned by deposit day; with ``only_days``, these days of it and no other partition.

        The rebalance gathers a day into few files and lets the adaptive
        planner split a large day; ``over_match`` reads only the days asked for.
        With ``observe`` the declared rules of the match are counted on the way.
        """
        parts = [p.withColumn("deposit_date", F.to_date("deposit_timestamp")).hint("rebalance", "deposit_date") for p in self.match_parts()]
        seen = [rules.Observed(p, "deposit_fill_matching") for p in parts] if observe else []
        write_days([s.rows for s in seen] or parts, path, only_days)
        for further in seen[1:]:
            seen[0].add(further)
        return seen[0] if seen else None

    def write_by_day(self, spark: SparkSession, match_path: str, model: Callable[[Bridge], DataFrame], path: str, days: list[date] | None = None) -> None:
        """A model over the stored match that keeps days apart, as a table partitioned by day; ``model`` adds ``deposit_date``."""
        count = passes(self.over_match(spark, match_path, days).deposit_fill_matching)
        parts = [model(self.over_match(spark, match_path, days, (k, count))).hint("rebalance", "deposit_date") for k in range(count)]
        write_days(parts, path, days)

    def over_match(self, spark: SparkSession, path: str, days: tuple[str, str] | list[date] | None = None, part: tuple[int, int] = (0, 1)) -> Bridge:
        """The same models with the marts reading a stored match: of all days, from a first to a last one, or of a list of days.

        A mart aggregates the match in several narrow passes; each is a scan of
        its own columns there, instead of the whole match computed again. ``part``
        takes every so many days of these, from a number on.
        """
        match = spark.read.schema(StructType([*self.deposit_fill_matching.schema, StructField("deposit_date", DateType())])).parquet(path)
        if isinstance(days, tuple):
            match = match.filter(F.col("deposit_date").between(*[F.lit(d).cast("date") for d in days]))
        elif days is not None:
            match = match.filter(F.col("deposit_date").isin(days))
        if part[1] > 1:
            day = F.coalesce(F.unix_date("deposit_date"), F.lit(0))
            match = match.filter(F.pmod(day, F.lit(part[1])) == part[0])
        return self.over_logs(self.landed, match.drop("deposit_date"))

    def over_logs(self, landed: DataFrame, match: DataFrame | None = None) -> Bridge:
        """The same models over other logs or another match, with the same hourly prices."""
        other = Bridge(landed, self.chain_metadata, self.token_metadata, self.token_prices, match)
        other.hourly_prices = self.hourly_prices
        return other

    def store(self, spark: SparkSession, folder: str) -> tuple[Bridge, DataFrame]:
        """Write the match once, then the marts from it; also returns the report of their declared rules, counted while writing."""
        path = f"{folder}/deposit_fill_matching"
        seen = self.write_match(path, observe=True)
        over = self.over_match(spark, path)
        reports = [seen.report(spark, over.deposit_fill_matching)]
        for name in STORED[1:]:
            mart = getattr(over, name)
            watched = rules.Observed(mart, name) if name in MODEL_RULES else None
            with settings(spark, {SHUFFLE_CLEANUP: "true"}):
                writer = (watched.rows if watched else mart).write.mode("overwrite").option("partitionOverwriteMode", "static")
                writer.option("compression", "zstd").parquet(f"{folder}/{name}")
            if watched:
                reports.append(watched.report(spark, spark.read.schema(mart.schema).parquet(f"{folder}/{name}")))
        return over, reduce(DataFrame.unionByName, reports)


def passes(df: DataFrame) -> int:
    """In how many passes a table is written that is made from these rows."""
    return max(1, min(MOST_PASSES, -(-input_bytes(df) // PASS_BYTES)))


def write_days(parts: list[DataFrame], path: str, only_days: list[date] | None = None) -> None:
    """A table partitioned by ``deposit_date``: as a whole, or the partitions of the given days alone.

    Its parts are written one after the other to a folder beside the table, each after the shuffles of the one before are gone.
    Then their days take the place of the old ones, as chains do in the landing table.
    """
    spark = parts[0].sparkSession
    swap = Swap(spark, path)
    for part in parts:
        with settings(spark, {SHUFFLE_CLEANUP: "true"}):
            part.write.mode("append").option("compression", "zstd").partitionBy("deposit_date").parquet(swap.loading)
    swap.finish(swap.present() if only_days is None else [])
