"""Hex decoding against Python integers."""

from pyspark.sql import functions as F

from spanledger.functions import hexcodec as H


def values(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, h STRING")
    return [r["v"] for r in df.select("i", fn(F.col("h")).alias("v")).orderBy("i").collect()]


def test_hex_to_bigint_limits(spark):
    texts = ["0x0", "0xff", "0x" + f"{2**63 - 1:064x}", "0x" + f"{2**63:064x}", "0x" + "f" * 64, "0x", "", "zz", "0xzz", None, "FF", "0x12g4"]
    assert values(spark, texts, H.hex_to_bigint) == [0, 255, 2**63 - 1, None, None, None, None, None, None, None, 255, None]


def test_hex_to_address_and_timestamp(spark):
    word = "0x" + "0" * 24 + "a0b86991c6218b36c1d19d4a2e9eb0ce3606eb48"
    assert values(spark, [word, word[2:]], H.hex_to_address) == ["0x" + word[-40:]] * 2
    epochs = values(spark, ["0x692f6f7b", None, "0xzz"], lambda c: F.unix_seconds(H.hex_to_timestamp(c)))
    assert epochs == [0x692F6F7B, None, None]


NUMBERS = [0, 1, 2**32, 2**52, 2**52 - 1, 2**53 + 1, 2**63, 2**64 - 1, 10**18, 15 * 10**17, 10**23 + 7, 2**96 - 1,
           2**103 + 12345, 2**104, 2**125, 2**126 - 1, 2**126, 10**38, 2**128 + 5, 2**200 + 987654321, 2**256 - 1]


def test_slot_to_double(spark):
    got = values(spark, [f"{n:064x}" for n in NUMBERS], H.slot_to_double)
    for n, v in zip(NUMBERS, got):
        if n < 2**104:
            assert v == float(n), n
        else:
            assert abs(v - n) / n < 1e-15, n


def test_slot_to_double_rejects_short_or_junk(spark):
    assert values(spark, ["", "ff", "g" * 64, "0" * 63, None], H.slot_to_double) == [None] * 5


def test_slot_to_integer_text_is_exact_over_256_bits(spark):
    got = values(spark, [f"{n:064x}" for n in NUMBERS], H.slot_to_integer_text)
    assert got == [str(n) for n in NUMBERS]


def test_hex_to_decimal(spark):
    got = values(spark, ["0xde0b6b3a7640000", "0x" + f"{2**126 - 1:x}", "0x" + f"{2**126:x}", "0x", "0xzz"], H.hex_to_decimal)
    assert [None if v is None else int(v) for v in got] == [10**18, 2**126 - 1, None, None, None]
