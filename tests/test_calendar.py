import datetime as dt

from pyspark.sql import functions as F

from urbanlens.operators import calendar as K

# published Gregorian Easter Sundays and Victoria Days
EASTER = {2019: (4, 21), 2020: (4, 12), 2021: (4, 4), 2022: (4, 17), 2023: (4, 9), 2024: (3, 31),
          2025: (4, 20), 2026: (4, 5)}
VICTORIA = {2019: 20, 2020: 18, 2021: 24, 2022: 23, 2023: 22, 2024: 20, 2025: 19, 2026: 18}


def test_easter_and_good_friday(spark):
    years = spark.createDataFrame([(y,) for y in EASTER], "year int")
    got = {r.year: r.d for r in years.select("year", K.easter_sunday(F.col("year")).alias("d")).collect()}
    assert got == {y: dt.date(y, m, d) for y, (m, d) in EASTER.items()}
    hol = {(r.holiday_name, r.holiday_date.year): r.holiday_date for r in K.holidays(years).collect()}
    for y, (m, d) in EASTER.items():
        assert hol[("Good Friday", y)] == dt.date(y, m, d) - dt.timedelta(days=2)
        assert hol[("Victoria Day", y)] == dt.date(y, 5, VICTORIA[y])


def test_nine_holidays_per_year_and_flags(spark):
    dim = K.dim_date(K.spine_between(spark, "2019-01-01", "2026-12-31"))
    assert dim.count() == 2922
    per_year = {r.year: r.n for r in dim.filter("is_holiday").groupBy("year").agg(F.count("*").alias("n")).collect()}
    assert set(per_year.values()) == {9}
    row = dim.filter(F.col("full_date") == dt.date(2024, 8, 5)).first()
    assert row.is_holiday and row.day_of_week == "Monday" and row.day_of_week_num == 1
    assert dim.filter(F.col("full_date") == dt.date(2024, 8, 6)).first().is_holiday is False
    sat = dim.filter(F.col("full_date") == dt.date(2024, 1, 6)).first()
    assert sat.is_weekend and sat.day_of_week_num == 6 and sat.quarter == 1 and sat.date_key == 20240106


def test_contiguity(spark):
    dim = K.dim_date(K.spine_between(spark, "2024-01-01", "2024-12-31"))
    r = K.contiguity(dim).first()
    assert (r.n_rows, r.expected_rows, r.gaps, r.duplicates) == (366, 366, 0, 0)
    gappy = dim.filter(F.col("full_date") != dt.date(2024, 6, 1))
    assert K.contiguity(gappy).first().gaps == 1
