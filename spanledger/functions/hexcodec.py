"""Hex decoding as Column -> Column expressions; all of it stays in the JVM.

``conv`` works on unsigned 64-bit values and yields 0 for junk, so every use
here is limited to 16 hex digits and guarded by an alphabet check.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanledger.functions.times import epoch_to_timestamp

SLOT = 64  # hex digits of one 32-byte slot
SLOT_HEX = "^[0-9a-fA-F]{64}$"
# At most 16 significant digits, with or without prefix.
QUANTITY_64 = "^(?:0x)?0*[0-9a-fA-F]{1,16}$"


def strip_prefix(col: Column) -> Column:
    return F.when(col.startswith("0x"), F.substring(col, 3, 2147483647)).otherwise(col)


def hex_to_bigint(col: Column) -> Column:
    """Hex quantity of any width to BIGINT; NULL if malformed or too large."""
    digits = F.replace(col, F.lit("0x"), F.lit("0"))
    return F.when(col.rlike(QUANTITY_64), F.conv(F.right(digits, F.lit(16)), 16, 10).try_cast("bigint"))


def hex_to_address(col: Column) -> Column:
    """The low 20 bytes of a topic or slot as an address."""
    return F.concat(F.lit("0x"), F.right(strip_prefix(col), F.lit(40)))


def hex_to_timestamp(col: Column) -> Column:
    """Hex epoch seconds to TIMESTAMP; NULL beyond the years a timestamp can show."""
    return epoch_to_timestamp(hex_to_bigint(col))


def slot(data: Column, n: int, start: int = 0, count: int = SLOT) -> Column:
    """Hex digits of the n-th 32-byte slot of 0x-prefixed data, NULL when cut short.

    Cut from the bytes of the text: a position in a string is found by walking
    its characters, in a binary it is a plain offset.
    """
    digits = data.cast("binary")
    cut = F.substring(digits, 3 + SLOT * n + start, count).cast("string")
    return F.when(F.octet_length(digits) >= 2 + SLOT * (n + 1), cut)


def slot_address(data: Column, n: int) -> Column:
    """The n-th slot as an address: its last 40 digits."""
    return F.concat(F.lit("0x"), slot(data, n, 24, 40))


def slot_to_address(slot_hex: Column) -> Column:
    return F.concat(F.lit("0x"), F.substring(slot_hex, 25, 40))


def slot_to_bytes32(slot_hex: Column) -> Column:
    return F.concat(F.lit("0x"), slot_hex)


def _digits(slot_hex: Column, start: int, count: int) -> Column:
    """Up to 13 digits (52 bits) from a position, exact as DOUBLE."""
    return F.conv(F.substring(slot_hex, start, count), 16, 10).cast("bigint").cast("double")


def slot_to_double(slot_hex: Column) -> Column:
    """uint256 slot to DOUBLE, rounded once for values below 2^104.

    Amounts nearly always fit 104 bits, which takes two pieces of 52 bits
    instead of five.
    """
    step = F.lit(4503599627370496.0)  # 2^52
    short = _digits(slot_hex, 39, 13) * step + _digits(slot_hex, 52, 13)
    whole = _digits(slot_hex, 1, 12)
    for start in (13, 26, 39, 52):
        whole = whole * step + _digits(slot_hex, start, 13)
    return F.when(slot_hex.rlike("^0{38}[0-9a-fA-F]{26}$"), short).when(slot_hex.rlike(SLOT_HEX), whole)


def slot_to_decimal(slot_hex: Column) -> Column:
    """uint256 slot to DECIMAL(38,0); NULL from 2^126 on or if malformed."""
    half = F.lit("18446744073709551616").cast("decimal(20,0)")
    high = F.conv(F.substring(slot_hex, 33, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(slot_hex, 49, 16), 16, 10).cast("decimal(20,0)")
    fits = slot_hex.rlike("^0{32}[0-3][0-9a-fA-F]{31}$")
    return F.when(fits, (high * half + low).cast("decimal(38,0)"))


def _limbs_times_65536_plus(limbs: Column, chunk: Column) -> Column:
    """One step of base conversion on little-endian base-10^9 limbs."""
    base = F.lit(1000000000)

    def step(state: Column, limb: Column) -> Column:
        total = limb * F.lit(65536) + state["carry"]
        return F.struct(
            F.concat(state["out"], F.array(total % base)).alias("out"),
            F.floor(total / base).cast("bigint").alias("carry"),
        )

    empty = F.struct(
        F.array().cast("array<bigint>").alias("out"), chunk.cast("bigint").alias("carry")
    )
    return F.aggregate(limbs, empty, step)["out"]


def _wide_slot_to_text(slot_hex: Column) -> Column:
    chunks = F.transform(
        F.sequence(F.lit(0), F.lit(15)),
        lambda i: F.conv(F.substr(slot_hex, i * F.lit(4) + F.lit(1), F.lit(4)), 16, 10).cast("bigint"),
    )
    zeros = F.array_repeat(F.lit(0).cast("bigint"), 9)
    limbs = F.aggregate(chunks, zeros, _limbs_times_65536_plus)
    digits = F.array_join(
        F.transform(F.reverse(limbs), lambda x: F.lpad(x.cast("string"), 9, "0")), ""
    )
    return F.ltrim(digits, F.lit("0"))


def slot_to_integer_text(slot_hex: Column) -> Column:
    """uint256 slot to its exact decimal digits, over the whole 256-bit range.

    64-bit values come straight from ``conv``, values below 2^126 from decimal
    arithmetic, and only the rest from digit-by-digit base conversion.
    """
    return F.when(
        slot_hex.rlike(SLOT_HEX),
        F.when(slot_hex.startswith("0" * 48), F.conv(F.right(slot_hex, F.lit(16)), 16, 10))
        .when(slot_hex.rlike("^0{32}[0-3]"), slot_to_decimal(slot_hex).cast("string"))
        .otherwise(_wide_slot_to_text(slot_hex)),
    )


def hex_to_decimal(col: Column) -> Column:
    """Hex quantity to DECIMAL(38,0) where it fits, else NULL."""
    digits = strip_prefix(col)
    return F.when(F.length(digits).between(1, SLOT), slot_to_decimal(F.lpad(digits, SLOT, "0")))
