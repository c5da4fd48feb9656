"""Rounding, rescaling and tier labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanledger.constants import DEFAULT_DECIMALS, ZERO_ADDRESS


# Decimal places kept of a value's 15 digits; 14 are left before the point.
DIGITS_SCALE = 24


def round_half_up(x: Column, places: int) -> Column:
    """Decimal rounding of a DOUBLE, back to DOUBLE, half away from zero.

    A value counts as its 15 significant digits, which drops the binary noise
    that would push an exact tie (1237.155) the wrong way but keeps 0.0049999999
    below one. Only values near a tie are written out in digits, as that is
    slow. A value too large for the decimal has no such fraction left.
    """
    value = x.cast("double")
    scaled = F.abs(value) * F.lit(10.0**places)
    near_tie = (scaled < 1e15) & (F.abs(scaled - F.floor(scaled) - 0.5) < 1e-3)
    digits = F.format_string("%.14e", value).try_cast(f"decimal(38,{DIGITS_SCALE})")
    exact = F.coalesce(F.round(digits, places).cast("double"), value)
    return F.when(near_tie, exact).otherwise(F.round(value, places))


def exact_sum(x: Column, places: int = 2) -> Column:
    """Sum of values that are already rounded to ``places``, as DOUBLE.

    Adds decimals, so the result does not depend on the order of rows. Values
    beyond DECIMAL(28) are added apart as doubles rather than lost.
    """
    amount = x.try_cast(f"decimal(28,{places})")
    beyond = F.sum(F.when(amount.isNull(), x))
    total = F.sum(amount).cast("double")
    return F.when(beyond.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + beyond)


def rescale_amount(raw: Column, decimals: Column) -> Column:
    """Raw token units to whole tokens; unknown tokens count 18 decimals."""
    return raw.cast("double") / F.pow(F.lit(10.0), F.coalesce(decimals, F.lit(DEFAULT_DECIMALS)))


def rescale_output_amount(token: Column, raw: Column, input_decimals: Column, output_decimals: Column) -> Column:
    """A native output (zero address) is stated in the input token's units."""
    return F.when(token == ZERO_ADDRESS, rescale_amount(raw, input_decimals)).otherwise(
        rescale_amount(raw, output_decimals)
    )


def usd_value(amount: Column, price: Column, default_price: float) -> Column:
    return round_half_up(amount * F.coalesce(price, F.lit(default_price)), 2)


def percent_of(part: Column, whole: Column, places: int) -> Column:
    """part / whole x 100, NULL on a zero whole."""
    return round_half_up(F.try_divide(part.cast("double"), whole.cast("double")) * 100, places)


def tier(value: Column, bounds: list[tuple[float, str]], rest: str) -> Column:
    """First label whose bound the value exceeds; NULL falls to ``rest``."""
    (bound, label), *others = bounds
    chain = F.when(value > bound, label)
    for bound, label in others:
        chain = chain.when(value > bound, label)
    return chain.otherwise(rest)


def text_to_bigint(col: Column) -> Column:
    """Numeric text such as "8453" or "8453.0" to BIGINT."""
    return col.cast("decimal(38,10)").cast("bigint")
