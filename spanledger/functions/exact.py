"""Exact sums of whole numbers of up to 80 digits, held as decimal text.

A 256-bit quantity has up to 78 digits, more than any Spark number type. Each
text is cut into ten numbers of eight digits, these are summed apart as plain
BIGINTs, with partial sums before the shuffle, and one pass over the ten sums
carries what is beyond eight digits on to the next. A group may hold
90 billion numbers; beyond that the sum raises instead of turning wrong.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS, PARTS = 8, 10
WHOLE_NUMBER = rf"^[0-9]{{1,{DIGITS * PARTS}}}$"


def whole_number(text: Column) -> Column:
    """The digits of a whole number without leading zeros, NULL for any other text."""
    digits = F.ltrim(text, F.lit("0"))
    return F.when(text.rlike(WHOLE_NUMBER), F.when(digits == "", "0").otherwise(digits))


def exact_sum(text: Column) -> Column:
    """Aggregate: the sum as decimal text. NULLs and texts that are no whole number are left out; NULL where nothing is left."""
    padded = F.when(text.rlike(WHOLE_NUMBER), F.lpad(text, DIGITS * PARTS, "0"))
    starts = range(1 + DIGITS * (PARTS - 1), 0, -DIGITS)  # the lowest digits first
    sums = F.array(*[F.sum(F.substring(padded, start, DIGITS).cast("bigint")) for start in starts])
    base = F.lit(10**DIGITS).cast("bigint")

    def carried(held: Column, part: Column) -> Column:
        total = held["carry"] + part
        low = F.lpad((total % base).cast("string"), DIGITS, "0")
        return F.struct(F.call_function("div", total, base).alias("carry"), F.concat(low, held["digits"]).alias("digits"))

    nothing = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("digits"))
    joined = F.aggregate(sums, nothing, carried, lambda x: F.ltrim(F.concat(x["carry"].cast("string"), x["digits"]), F.lit("0")))
    return F.when(joined == "", "0").otherwise(joined)

