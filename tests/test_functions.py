"""Column expressions (P-series) on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from tidepool.functions import expressions as X


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).collect()[0]["v"]


def test_text_checks(spark):
    df = spark.createDataFrame([("123",), ("12a",), ("",), ("héllo",), ("ok fine",), (None,)],
                               "s STRING")
    got = {r["s"]: (r["p"], r["d"], r["n"]) for r in df.select(
        "s", X.printable_ascii("s").alias("p"), X.digits_only("s").alias("d"),
        X.non_empty("s").alias("n")).collect()}
    assert got["123"] == (True, True, True)
    assert got["12a"] == (True, False, True)
    assert got[""] == (True, False, False)
    assert got["héllo"][0] is False
    assert got["ok fine"] == (True, False, True)


def test_defaults_prefix_ratio(spark):
    assert one(spark, X.default(F.lit(None).cast("string"), "Unknown")) == "Unknown"
    assert one(spark, X.prefixed("USER_", F.lit(42))) == "USER_42"
    assert one(spark, X.safe_ratio(F.lit(3), F.lit(2))) == 1.5
    assert one(spark, X.safe_ratio(F.lit(3), F.lit(0))) is None


def test_time_helpers(spark):
    ts = one(spark, X.parse_timestamp(F.lit("2024-01-31 10:00:00")))
    assert ts == dt.datetime(2024, 1, 31, 10, 0, 0)
    assert one(spark, X.parse_timestamp(F.lit("31/01/2024"))) is None
    back = one(spark, X.days_before(F.lit(ts), 14))
    assert back == dt.datetime(2024, 1, 17, 10, 0, 0)


def test_distance_and_nearest(spark):
    assert one(spark, X.euclidean(F.lit(0), F.lit(0), F.lit(3.0), F.lit(4.0))) == 5.0
    cs = [(2, 10.0, 0.0), (0, 0.0, 0.0), (1, 10.0, 0.0)]
    df = spark.createDataFrame([(5, 0), (9, 0), (1, 0)], "x BIGINT, y BIGINT")
    got = [(r["x"], r["id"], r["cx"]) for r in df.select(
        "x", X.nearest_centre("x", "y", cs).alias("c")).select("x", "c.id", F.col("c.x").alias("cx"))
        .orderBy("x").collect()]
    # x=5 ties between id 0 (0,0) and ids 1/2 (10,0): lowest id wins
    assert got == [(1, 0, 0.0), (5, 0, 0.0), (9, 1, 10.0)]


def test_json_int_field_matches_json_parse(spark):
    df = spark.createDataFrame([('{"k": 5}',), ('{"a": {"k": 1}, "k": 7}',), ('{ "k" : -3 }',),
                                ('{"k": "9"}',), ('{"k": 5.5}',), ('{"kk": 4}',), ('junk',),
                                ('{"k": 007}',), ('{"k":\f5}',), ('{"k":\n-0}',),
                                ('{"k": 99999999999999999999}',), (None,)], "props STRING")
    got = df.select(X.json_int_field("props", "k").alias("h"),
                    F.get_json_object("props", "$.k").try_cast("bigint").alias("g")).collect()
    assert [r["h"] for r in got] == [r["g"] for r in got]
    assert [r["h"] for r in got][:4] == [5, 7, -3, 9]


def test_text_checks_take_the_whole_text(spark):
    got = spark.createDataFrame([("ab",), ("ab\n",), ("12",), ("12\n",), ("",)], "c STRING").select(
        X.printable_ascii("c").alias("p"), X.digits_only("c").alias("d")).collect()
    assert [(r.p, r.d) for r in got] == [(True, False), (False, False), (True, True), (False, False), (True, False)]
