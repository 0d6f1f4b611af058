import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpiframe.functions.period import Period, bounds_columns, period_start

D = dt.date


def test_month_bounds():
    p = Period(D(2001, 8, 15))
    assert (p.previous_start, p.previous_end, p.current_start, p.current_end) == (
        D(2001, 6, 1), D(2001, 7, 1), D(2001, 7, 1), D(2001, 8, 1))
    assert p.current_last_day == D(2001, 7, 31)
    # year boundary
    p = Period(D(2024, 1, 3))
    assert (p.previous_start, p.current_start, p.current_end) == (D(2023, 11, 1), D(2023, 12, 1), D(2024, 1, 1))


def test_week_and_day_bounds():
    p = Period("2024-01-24", "week")  # a Wednesday
    assert (p.previous_start, p.current_start, p.current_end) == (D(2024, 1, 8), D(2024, 1, 15), D(2024, 1, 22))
    p = Period(D(2024, 1, 22), "week")  # a Monday: its own week is excluded
    assert p.current_start == D(2024, 1, 15)
    p = Period(D(2024, 3, 1), "day")
    assert (p.previous_start, p.current_start, p.current_end) == (D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 1))


def test_bad_unit():
    with pytest.raises(ValueError):
        Period(D(2024, 1, 1), "year")


@pytest.mark.parametrize("unit", ["month", "week", "day"])
def test_column_bounds_match_driver_bounds(spark, unit):
    days = [D(2023, 12, 31) + dt.timedelta(days=i) for i in range(0, 400, 7)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    b = bounds_columns(F.col("d"), unit)
    rows = df.select("d", b["previous_start"].alias("ps"), b["current_start"].alias("cs"),
                     b["current_end"].alias("ce")).collect()
    for r in rows:
        p = Period(r.d, unit)
        assert (r.ps, r.cs, r.ce) == (p.previous_start, p.current_start, p.current_end)


def test_period_start_week_is_monday(spark):
    df = spark.createDataFrame([(D(2024, 1, d),) for d in range(1, 15)], "d date")
    for r in df.select("d", period_start(F.col("d"), "week").alias("w")).collect():
        assert r.w.weekday() == 0 and 0 <= (r.d - r.w).days < 7


def test_filter_is_half_open_and_typed(spark):
    p = Period(D(2001, 8, 15))
    rows = [(dt.datetime(2001, 6, 1, 0, 0),), (dt.datetime(2001, 7, 31, 23, 59),), (dt.datetime(2001, 8, 1),),
            (dt.datetime(2001, 5, 31, 23, 59),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    assert p.filter(df, "ts").count() == 2
    assert p.filter(df, "ts", "current").count() == 1


def test_filter_on_timestamp_ltz_column_is_pushed(spark, tmp_path):
    from kpiframe.plans.inspect import explain_text, pushed_filters
    p = Period(D(2001, 8, 15))
    rows = [(dt.datetime(2001, 6, 1, 0, 0),), (dt.datetime(2001, 7, 31, 23, 59),), (dt.datetime(2001, 8, 1),),
            (dt.datetime(2001, 5, 31, 23, 59),)]
    spark.createDataFrame(rows, "ts timestamp").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = p.filter(df, "ts")
    assert out.count() == 2
    pushed = " ".join(pushed_filters(explain_text(out)))
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed
