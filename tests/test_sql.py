"""SQL functions against the column functions they stand beside, and the views of the layers."""

from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions import hexcodec, numbers, times
from spanledger.plans import sql, stored

SF = "/root/testdata/sf0.001"
HEX = [None, "", "0x", "0x0", "0xff", "ff", "0x" + "0" * 63 + "7", "0x7fffffffffffffff", "0x8000000000000000", "0x" + "f" * 64, "zz", "0x1g",
       "0x" + "0" * 32 + "3" + "f" * 31, "0x" + "0" * 32 + "4" + "0" * 31, "0x" + "a" * 65, "0x" + "0" * 24 + "ab" * 20]
TIMES = [None, "", "0", "1704067200", "253402300800", "99999999999999999999", "2024-01-01 00:00:00", "2024-01-01T05:06:07Z", "junk", "-5"]


def test_functions_equal_the_columns(spark):
    sql.register(spark, stored.bridge(spark, SF))
    h = F.col("h")
    df = spark.createDataFrame([(x,) for x in HEX], "h string")
    pairs = {"hex_to_integer": hexcodec.hex_to_bigint(h), "hex_to_numeric": hexcodec.hex_to_decimal(h), "hex_to_address": hexcodec.hex_to_address(h)}
    for name, column in pairs.items():
        got = df.select("h", F.expr(f"{name}(h)").alias("a"), column.alias("b")).collect()
        assert [r.a for r in got] == [r.b for r in got], name
    got = spark.createDataFrame([(x,) for x in TIMES], "t string").select(F.expr("text_to_timestamp(t)").alias("a"), times.text_to_timestamp(F.col("t")).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    rows = [(token, 5e18, a, b) for token in (C.ZERO_ADDRESS, "0x1", None) for a in (None, 6) for b in (None, 8)]
    df = spark.createDataFrame(rows, "token string, raw double, a int, b int")
    own = numbers.rescale_output_amount(F.col("token"), F.col("raw"), F.col("a"), F.col("b"))
    got = df.select(F.expr("rescale_output_amount(token, raw, a, b)").alias("x"), own.alias("y"), F.expr("rescale_amount(raw, a)").alias("v"), numbers.rescale_amount(F.col("raw"), F.col("a")).alias("w")).collect()
    assert [(r.x, r.v) for r in got] == [(r.y, r.w) for r in got]


def test_every_layer_is_a_view(spark):
    bridge = stored.bridge_over_match(spark, SF)
    sql.register(spark, bridge, stored.raw_logs(spark, SF), "v_")
    for name in sql.LAYERS:
        assert spark.table(f"v_{name}").columns == getattr(bridge, name).columns
    assert spark.sql("SELECT count(*) AS n FROM v_raw_logs").first().n > 0


def test_functions_are_inlined(spark):
    sql.register(spark, stored.bridge(spark, SF))
    plan = spark.sql("SELECT hex_to_integer(h) AS n FROM VALUES ('0x1') AS t(h) WHERE hex_to_integer(h) > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert "hex_to_integer" not in plan and "Python" not in plan
