"""Data-quality checks: each returns offending rows or verdict rows.

Row rules of a dataset are evaluated together in one pass and one aggregate.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions.hexcodec import hex_to_bigint
from spanledger.operators.unify import chain_id_of
from spanledger.model_rules import RAW_REQUIRED
from spanledger.schemas import ADDRESS_COLUMNS, AMOUNT_COLUMNS, DECODED

Rules = dict[str, Column]


def rule_report(df: DataFrame, rules: Rules, by: str | None = None, expected: DataFrame | None = None) -> DataFrame:
    """One row per rule: violating rows and rows checked. An unknown is no violation.

    With ``by``, one row per rule and value of that column, also for the values
    of ``expected`` that have no row. Nothing checked is not passed.
    """
    counts = df.groupBy(*([by] if by else [])).agg(
        F.count("*").alias("checked"), *[F.count_if(cond).alias(f"r{i}") for i, cond in enumerate(rules.values())]
    )
    if expected is not None:
        counts = expected.select(by).distinct().join(counts, by, "full")
    none = F.lit(0).cast("bigint")
    rows = [F.struct(F.lit(name).alias("rule"), F.coalesce(f"r{i}", none).alias("failures")) for i, name in enumerate(rules)]
    checked = F.coalesce("checked", none)
    return counts.select(*([by] if by else []), F.inline(F.array(*rows)), checked.alias("checked")).select(
        *([by] if by else []), "rule", "failures", "checked", ((F.col("failures") == 0) & (F.col("checked") > 0)).alias("passed")
    )


def _prefixed(name: str, length: int) -> Column:
    """0x plus the right number of characters; NULL stays unknown."""
    col = F.col(name)
    return col.startswith("0x") & (F.length(col) == length)


def _present(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) != ""


def _is_hex(name: str) -> Column:
    return F.coalesce(F.col(name).startswith("0x"), F.lit(False))


# Raw files.


def raw_log_rules() -> Rules:
    topic0 = F.get("topics", F.lit(0))
    return {
        **{f"missing {c}": F.col(c).isNull() for c in RAW_REQUIRED},
        "bad transactionHash": ~_prefixed("transactionHash", 66),
        "bad address": ~_prefixed("address", 42),
        "empty topics": F.size("topics") < 1,
        "bad topic0": ~(topic0.startswith("0x") & (F.length(topic0) == 66)),
    }


def receipt_rules() -> Rules:
    return {
        **{f"missing {c}": F.col(c).isNull() for c in ("transactionHash", "gasUsed", "gasPrice")},
        "bad transactionHash": ~_prefixed("transactionHash", 66),
        "bad gasUsed": ~F.col("gasUsed").startswith("0x"),
        "bad gasPrice": ~F.col("gasPrice").startswith("0x"),
    }


def price_rules() -> Rules:
    """For prices read as text."""
    price = F.col("price_usd").try_cast("double")
    return {
        "empty token_symbol": F.coalesce(F.trim("token_symbol"), F.lit("")) == "",
        "invalid price_usd": price.isNull(),
        "negative price_usd": price < 0,
        "invalid timestamp": F.length(F.coalesce(F.trim("timestamp"), F.lit(""))) < 10,
    }


FILE_RULES = {"logs": raw_log_rules, "receipts": receipt_rules, "prices": price_rules}


def file_kind(file_name: str) -> str:
    """Which rules a file falls under, by its name."""
    name = file_name.lower().removesuffix(".gz")
    if name.endswith(".jsonl"):
        return "receipts" if "receipt" in name else "logs"
    if name.endswith(".csv") and "price" in name:
        return "prices"
    raise ValueError(f"no checks for this kind of file: {file_name}")


def check_file(df: DataFrame, kind: str) -> DataFrame:
    """The rule report of a dataset of the given kind."""
    return rule_report(df, FILE_RULES[kind]())


def check_files(df: DataFrame, kind: str, files: DataFrame | None = None) -> DataFrame:
    """A verdict for every rule and ``source_file``; a file of ``files`` without a row fails.

    Lines that are no JSON count under a rule of their own where the reader kept them in ``_corrupt_record``.
    """
    rules = FILE_RULES[kind]()
    if "_corrupt_record" in df.columns:
        rules["invalid line"] = F.col("_corrupt_record").isNotNull()
    return rule_report(df, rules, "source_file", files)


def duplicate_keys(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Key values that occur more than once. NULL keys are not compared."""
    kept = df.dropna(subset=keys) if where is None else df.filter(where).dropna(subset=keys)
    return kept.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def duplicate_logs(logs: DataFrame) -> DataFrame:
    keyed = logs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("transactionHash", "logIndex")])
    return duplicate_keys(keyed, ["transactionHash", "logIndex"])


def gas_coverage(logs: DataFrame) -> DataFrame:
    """How many logs carry both gas fields in hex, and the blocks they span."""
    block = hex_to_bigint(F.col("blockNumber"))
    covered = _is_hex("gasPrice") & _is_hex("gasUsed")
    return logs.agg(
        F.count("*").alias("total_logs"),
        F.count_if(covered).alias("logs_with_gas"),
        F.count_if(~covered).alias("logs_without_gas"),
        F.min(block).alias("min_block"),
        F.max(block).alias("max_block"),
        F.count_distinct("transactionHash").alias("unique_transactions"),
    )


def price_tokens(prices: DataFrame) -> DataFrame:
    return prices.agg(F.count("*").alias("records"), F.count_distinct(F.trim("token_symbol")).alias("token_count"))


# Raw against decoded.


def file_stem(name: Column) -> Column:
    """A raw file and its decoded file share this name."""
    return F.regexp_replace(name, r"(_processed)?\.(jsonl(\.gz)?|parquet)$", "")


def transform_parity(raw: DataFrame, decoded: DataFrame) -> DataFrame:
    """Per file: row counts on both sides, missing gas fields and a status."""
    no_price, no_used = F.col("gasPrice").isNull(), F.col("gasUsed").isNull()
    left = raw.groupBy(file_stem(F.col("source_file")).alias("file")).agg(
        F.count("*").alias("raw_rows"),
        F.count_if(no_price).alias("missing_gas_price"),
        F.count_if(no_used).alias("missing_gas_used"),
        F.count_if(no_price & no_used).alias("missing_both"),
    )
    right = decoded.groupBy(file_stem(F.col("source_file")).alias("file")).agg(F.count("*").alias("processed_rows"))
    return left.join(right, "file", "full").select(
        "file",
        "raw_rows",
        "processed_rows",
        "missing_gas_price",
        "missing_gas_used",
        "missing_both",
        F.when(F.col("raw_rows").isNull(), "NO RAW FILE")
        .when(F.col("processed_rows").isNull(), "MISSING")
        .when(F.col("raw_rows") != F.col("processed_rows"), "ROW COUNT DIFFERS")
        .when((F.col("missing_gas_price") > 0) | (F.col("missing_gas_used") > 0), "GAS MISSING")
        .otherwise("OK")
        .alias("status"),
    )


# Decoded logs before loading.


def schema_differences(df: DataFrame) -> DataFrame:
    """Decoded columns the input lacks or holds in another type."""
    found = dict(df.dtypes)
    rows = [(c, kind, found.get(c)) for c, kind in DECODED.items() if found.get(c) != kind]
    return df.sparkSession.createDataFrame(rows, "column_name STRING, expected STRING, found STRING")


def column_report(df: DataFrame) -> DataFrame:
    """Every decoded column: the type it should have, the one it has (NULL: missing), rows, how many are NULL, and whether the type is right.

    One pass over the columns that are there.
    """
    kinds = dict(df.dtypes)
    counted = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(f"n_{c}") for c in DECODED if c in kinds])
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kind).alias("expected"),
            F.lit(kinds.get(c)).cast("string").alias("found"),
            F.col("rows"),
            (F.col("rows") - (F.col(f"n_{c}") if c in kinds else F.lit(0).cast("bigint"))).alias("nulls"),
            F.lit(kinds.get(c) == kind).alias("type_ok"),
        )
        for c, kind in DECODED.items()
    ]
    return counted.select(F.inline(F.array(*entries)))


def decoded_rules() -> Rules:
    return {
        **{f"null {c}": F.col(c).isNull() for c in ("transactionHash", "timestamp_datetime", "topic_0")},
        **{f"negative {c}": F.col(c) < 0 for c in AMOUNT_COLUMNS},
    }


def format_rules() -> Rules:
    """Addresses are 0x + 40, hashes 0x + 64 characters."""
    return {
        **{f"bad {c}": ~_prefixed(c, 42) for c in ADDRESS_COLUMNS},
        "bad transactionHash": ~_prefixed("transactionHash", 66),
    }


def completeness_rules(now: datetime) -> Rules:
    """Gas on every log, no future times, refunds executed on the file's own chain."""
    return {
        "missing gas_price_wei": F.col("gas_price_wei").isNull(),
        "missing gas_used": F.col("gas_used").isNull(),
        "future timestamp": F.col("timestamp_datetime") > F.lit(now),
        "chain id differs from file": F.col("topic_chain_id") != chain_id_of(F.col("blockchain")),
    }


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once in every column, with their copies.

    Copies are counted within each task first, so many copies of one row do
    not meet in one task.
    """
    return df.groupBy(*df.columns).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def file_profile(df: DataFrame) -> DataFrame:
    """Rows and time range of each loaded file."""
    return df.groupBy("source_file").agg(
        F.count("*").alias("row_count"),
        F.min("timestamp_datetime").alias("min_date"),
        F.max("timestamp_datetime").alias("max_date"),
    )


# Files against the loaded table.

CRITICAL_COLUMNS = ["transactionHash", "timestamp_datetime", "topic_0", "gas_price_wei", "gas_used"]


def fingerprint(columns: list[str]) -> Column:
    """Aggregate: a number that is the same for the same rows in any order, copies counted.

    The sum of 64-bit hashes of whole rows, in digits that cannot overflow. Sums are combined before the shuffle.
    """
    return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))


def load_stats(df: DataFrame, side: str, contents: bool = False) -> DataFrame:
    content = [fingerprint(list(DECODED)).alias(f"{side}_content")] if contents else []
    return df.groupBy("blockchain").agg(
        F.count("*").alias(f"{side}_rows"),
        F.count_distinct("transactionHash").alias(f"{side}_unique_tx"),
        *[F.count_if(F.col(c).isNull()).alias(f"{side}_null_{c}") for c in CRITICAL_COLUMNS],
        *content,
    )


def content_differences(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose decoded rows are not the same on both sides, with the rows of each."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*by).agg(F.count("*").alias(f"{name}_rows"), fingerprint(list(DECODED)).alias(name))

    both = side(left, "left").join(side(right, "right"), by, "full")
    differ = ~(F.col("left").eqNullSafe(F.col("right")) & F.col("left_rows").eqNullSafe(F.col("right_rows")))
    return both.filter(differ).select(*by, "left_rows", "right_rows")


def reconcile_load(files: DataFrame, table: DataFrame, contents: bool = False) -> DataFrame:
    """Per chain: do file and table agree? Counts must, the rest only warns.

    With ``contents`` all decoded columns are read, and a chain of equal counts with any other value in a row is named too.
    """
    both = load_stats(files, "file", contents).join(load_stats(table, "table", contents), "blockchain", "full")
    content_differs = F.col("file_content") != F.col("table_content") if contents else F.lit(False)
    nulls_differ = F.lit(False)
    for c in CRITICAL_COLUMNS:
        nulls_differ = nulls_differ | (F.col(f"file_null_{c}") != F.col(f"table_null_{c}"))
    return both.select(
        "blockchain",
        "file_rows",
        "table_rows",
        "file_unique_tx",
        "table_unique_tx",
        F.when(F.col("table_rows").isNull(), "ERROR: not loaded")
        .when(F.col("file_rows").isNull(), "WARN: no file")
        .when(F.col("file_rows") != F.col("table_rows"), "ERROR: row count differs")
        .when(F.col("file_unique_tx") != F.col("table_unique_tx"), "WARN: transactions differ")
        .when(nulls_differ, "WARN: null counts differ")
        .when(content_differs, "WARN: contents differ")
        .otherwise("OK")
        .alias("status"),
    )


# Freshness and metric checks.


def source_freshness(landed: DataFrame, now: datetime, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """Per chain: hours since the newest log, and whether that is too long."""
    newest = landed.groupBy("blockchain").agg(F.max("timestamp_datetime").alias("newest"))
    hours = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("newest")) / F.lit(3.6e9)
    return newest.select(
        "blockchain",
        "newest",
        hours.alias("hours_old"),
        F.when(hours > error_hours, "error").when(hours > warn_hours, "warn").otherwise("pass").alias("status"),
    )


def negative_bridge_fees(match: DataFrame) -> DataFrame:
    """Routes and tokens whose fills paid out more than was put in."""
    return (
        match.filter((F.col("bridge_fee_nominal") < 0) & F.col("is_filled"))
        .groupBy("origin_chain_name", "destination_chain_name", "deposit_token_symbol")
        .agg(F.count("*").alias("negative_fee_count"), F.sum("bridge_fee_nominal_usd").alias("total_negative_usd"))
    )


def suspicious_amounts(unified_deposits: DataFrame, below: float = 0.01, more_than: int = 10) -> DataFrame:
    """Stablecoins often deposited in dust amounts, a sign of wrong decimals."""
    return (
        unified_deposits.filter((F.col("input_amount") < below) & F.col("input_token_symbol").isin(C.STABLECOINS))
        .groupBy("origin_chain_name", "input_token_symbol", "input_token_address")
        .agg(F.count("*").alias("suspicious_count"), F.avg("input_amount").alias("avg_suspicious_amount"))
        .filter(F.col("suspicious_count") > more_than)
    )


def missing_token_metadata(unified_deposits: DataFrame) -> DataFrame:
    """Deposited tokens without metadata, beside the known ones."""
    return (
        unified_deposits.filter(
            F.col("input_token_symbol").isNull() & ~F.lower("input_token_address").isin(C.METADATA_EXEMPT_TOKENS)
        )
        .groupBy("origin_chain_name", "input_token_address")
        .agg(F.count("*").alias("missing_count"))
    )


def missing_token_prices(unified_deposits: DataFrame, unified_fills: DataFrame, prices: DataFrame) -> DataFrame:
    """Symbols in use that have no price at all, with where they are deposited."""
    used = (
        unified_deposits.select(F.col("input_token_symbol").alias("token_symbol"))
        .union(unified_fills.select("fill_token_symbol"))
        .filter(F.col("token_symbol").isNotNull())
        .distinct()
    )
    priced = prices.select(F.upper("token_symbol").alias("priced")).distinct()
    unpriced = used.join(priced, F.upper("token_symbol") == F.col("priced"), "left_anti")
    # Deposits are counted per symbol and token before the join, so a popular
    # symbol is one row per chain there.
    deposited = unified_deposits.groupBy(
        F.col("input_token_symbol").alias("token_symbol"), "input_token_address", "origin_chain_name"
    ).agg(F.count("*").alias("n"))
    return unpriced.join(deposited, "token_symbol", "left").select(
        "token_symbol", "input_token_address", "origin_chain_name", F.coalesce("n", F.lit(1)).alias("deposit_count")
    )
