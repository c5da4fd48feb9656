"""Token prices: CSV in and out, and the window worth keeping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.schemas import PRICE, PRICE_TEXT


def read_prices_as_text(spark: SparkSession, path: str) -> DataFrame:
    """Uncast columns, for the price check."""
    return spark.read.schema(PRICE_TEXT).option("header", True).csv(path)


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Typed prices. Casting accepts any ISO form of the time, down to microseconds."""
    text = read_prices_as_text(spark, path)
    return text.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(PRICE)])


def write_prices(prices: DataFrame, path: str) -> None:
    """CSV sorted by token and time (a range partition, not one big task)."""
    (
        prices.select("token_symbol", F.col("timestamp").cast("timestamp").cast("string").alias("timestamp"), "price_usd")
        .orderBy("token_symbol", "timestamp")
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def price_window(prices: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Prices of whole UTC days from start - 1 day to end + 1 day."""
    first = F.date_sub(F.lit(start_date).cast("date"), 1).cast("timestamp")
    after = F.date_add(F.lit(end_date).cast("date"), 2).cast("timestamp")
    return prices.filter((F.col("timestamp") >= first) & (F.col("timestamp") < after))
