"""Time normalisation (F8), value conversion (F9), HTML to text, grid form."""

from datetime import datetime

from pyspark.sql import functions as F

from shoreline.functions import convert as C
from shoreline.functions import text as TX
from shoreline.functions import times as TM
from shoreline.operators import export as X


def test_mixed_times(spark):
    vals = ["1704067200", "1704067200123", "2024-01-01T10:20:30.123Z", "", "garbage", "123",
            " 1704067200 ", "1704067200.5", "01704067200"]
    df = spark.createDataFrame([(v,) for v in vals], "raw string")
    got = [r.t for r in df.select(TM.normalize_time(F.col("raw")).alias("t")).collect()]
    assert got == [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 123000),
                   datetime(2024, 1, 1, 10, 20, 30, 123000), None, None, None,
                   datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 500000), None]


def test_literals(spark):
    df = spark.createDataFrame([("NaN",), ("Infinity",), ("-Infinity",), ("2.5",), ("3kg",)], "s string")
    got = [r.v for r in df.select(C.finite_or_null(C.special_double(F.col("s"))).alias("v")).collect()]
    assert got == [None, None, None, 2.5, None]
    r = spark.range(1).select(C.int_floor(F.lit(-1.5)).alias("f"),
                              C.json_text(a=F.lit(1), b=F.lit("q\"")).alias("j"),
                              F.decode(C.from_base64(F.lit("aGk=")), "UTF-8").alias("b")).first()
    assert (r.f, r.j, r.b) == (-2, '{"a":1,"b":"q\\""}', "hi")


def test_html_to_text(spark):
    html = ('<html><head><style>p{x:1}</style><script>var t="</p>";</script></head>'
            '<body><p>Hello&nbsp;&amp; <b>world</b></p>\n\n<!-- c --> end</body></html>')
    r = spark.createDataFrame([(html,)], "h string").select(TX.html_to_text(F.col("h")).alias("t")).first()
    assert r.t == "Hello & world end"


def test_grid_iso(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 2, 3, 4, 5, 678901), 2.5)], "id long, ts timestamp_ntz, v double")
    r = X.to_grid(df).first()
    assert (r.id, r.ts, r.v) == ("1", "2024-01-02T03:04:05.678Z", "2.5")
