"""Timestamps from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_TEXT = r"^\d+$"
# 9999-12-31T23:59:59Z
LAST_SECOND = 253402300799


def epoch_to_timestamp(seconds: Column) -> Column:
    """Seconds since 1970 to TIMESTAMP; NULL below 0 and after the year 9999, which would overflow."""
    return F.timestamp_seconds(F.when(seconds.between(0, LAST_SECOND), seconds))


def text_to_timestamp(col: Column, strict: bool = False) -> Column:
    """Digits are epoch seconds, anything else a timestamp literal.

    Unparseable text gives NULL, or an error when ``strict``.
    """
    seconds = epoch_to_timestamp(F.when(col.rlike(EPOCH_TEXT), col).try_cast("bigint"))
    if strict:
        refused = F.raise_error(F.concat(F.lit("no time: "), col)).cast("timestamp")
        return F.when(col.rlike(EPOCH_TEXT), F.coalesce(seconds, refused)).otherwise(col.cast("timestamp"))
    return F.when(col.rlike(EPOCH_TEXT), seconds).otherwise(col.try_cast("timestamp"))
