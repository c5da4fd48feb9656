"""Chain configuration and the small dimensions derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.constants import NATIVE_TOKENS, SUPPORTED_CHAINS
from spanledger.schemas import CHAIN_CONFIG


def read_chain_config(spark: SparkSession, path: str) -> DataFrame:
    """The nested config file as one row per chain: name plus its settings."""
    text = spark.read.text(path, wholetext=True)
    return config_rows(text.select(F.col("value").alias("config")))


def config_rows(config: DataFrame) -> DataFrame:
    """Rows of a JSON object ``{chain: settings}`` held in column ``config``."""
    parsed = F.from_json("config", T.MapType(T.StringType(), T.StructType.fromDDL(CHAIN_CONFIG)))
    return config.select(F.explode(parsed).alias("chain", "s")).select(F.lower("chain").alias("chain"), "s.*")


def chain_metadata(config: DataFrame) -> DataFrame:
    """chain_id, chain_name for every chain that has an id."""
    return config.filter(F.col("chain_id").isNotNull()).select("chain_id", F.col("chain").alias("chain_name"))


def token_contracts(config: DataFrame) -> DataFrame:
    """chain, chain_id, symbol, address; tokens without an address are dropped."""
    return (
        config.select("chain", "chain_id", F.explode("tokens").alias("token_symbol", "token_address"))
        .filter(F.coalesce(F.trim("token_address"), F.lit("")) != "")
    )


def chain_settings(config: DataFrame, chain: str) -> DataFrame:
    """Settings of one chain, found without regard to case."""
    return config.filter(F.lower("chain") == chain.lower())


def native_tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NATIVE_TOKENS.items()), "chain_id BIGINT, native_token_symbol STRING")


def supported_chains(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SUPPORTED_CHAINS.items()), "blockchain STRING, chain_id BIGINT")
