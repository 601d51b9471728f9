import datetime as dt

from pyspark.sql import functions as F

from urbanlens.functions import columns as X


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_safe_int_accepts_whole_decimals_and_rejects_text(spark):
    assert one(spark, X.safe_int, "5.0") == 5
    assert one(spark, X.safe_int, " 12 ") == 12
    assert one(spark, X.safe_int, "abc") is None
    assert one(spark, X.safe_int, None) is None


def test_safe_decimal_and_timestamp(spark):
    assert str(one(spark, X.safe_decimal, "12.34")) == "12.3"
    assert one(spark, X.safe_decimal, "<31") is None
    assert one(spark, X.safe_timestamp, "1/5/2023 7:05") == dt.datetime(2023, 1, 5, 7, 5)
    assert one(spark, X.safe_timestamp, "2023-01-05 07:05") is None


def test_strict_date_accepts_midnight_suffix(spark):
    assert one(spark, X.strict_date, "2024-01-05 00:00:00") == dt.date(2024, 1, 5)


def test_surrogate_key_is_null_safe_and_order_sensitive(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    keys = [r[0] for r in df.select(X.surrogate_key("x", "y")).collect()]
    assert keys[0] != keys[1] and all(k is not None for k in keys)


def test_buckets(spark):
    df = spark.createDataFrame([(v,) for v in (59, 299, 300, 899, 1799, 3599, 3600, None)], "d int")
    got = [r[0] for r in df.select(X.duration_bucket("d")).collect()]
    assert got == ["Under 5 min", "Under 5 min", "5-15 min", "5-15 min", "15-30 min", "30-60 min",
                   "Over 60 min", "Over 60 min"]
    t = spark.createDataFrame([(-0.1,), (0.0,), (19.9,), (None,)], "t double")
    assert [r[0][:1] for r in t.select(X.temperature_bucket("t")).collect()] == ["1", "2", "3", "4"]
    d = spark.createDataFrame([(100,), (101,), (501,), (None,)], "m long")
    assert [r[0][:1] for r in d.select(X.delay_day_bucket("m")).collect()] == ["1", "2", "3", "1"]


def test_weather_condition_null_is_clear(spark):
    df = spark.createDataFrame([(None, None), (1.0, 0.0), (0.0, 2.0), (None, 2.0)], "s double, r double")
    assert [r[0] for r in df.select(X.weather_condition("s", "r")).collect()] == ["Clear", "Snow", "Rain", "Rain"]


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(v,) for v in (-30.0, -29.9, 0.0, 0.1, 5.0, 40.0, 40.1)], "t double")
    got = [r[0] for r in df.select(X.right_closed_bin("t")).collect()]
    assert got == [None, -30, -5, 0, 0, 35, None]


def test_one_of_validates_domain(spark):
    import pytest

    with pytest.raises(ValueError):
        X.one_of("m", [], ["a"])
    with pytest.raises(ValueError):
        X.one_of("m", ["zzz"], ["a"])


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
        # 2:43 on a spring-forward Sunday does not exist in that zone
        assert one(spark, X.safe_timestamp, "4/2/2000 2:43") == dt.datetime(2000, 4, 2, 2, 43)
        assert one(spark, X.safe_timestamp, "2/30/2020 1:00") is None
        df = spark.createDataFrame([("2000-04-02 02:43:05",)], "v string").select(F.col("v").cast("timestamp_ntz").alias("t"))
        r = df.select(X.format_ntz("t", "M/d/yyyy H:mm").alias("a"), X.format_ntz("t", "yyyy-MM-dd HH:mm:ss").alias("b")).first()
        assert (r.a, r.b) == ("4/2/2000 2:43", "2000-04-02 02:43:05")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
