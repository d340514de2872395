import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbline.functions import scalars as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_month_span_is_anchored_at_month_ends(spark):
    year = one(spark, fn.month_span("2021-03-01", "2022-03-01"))
    assert len(year) == 12 and year[0] == dt.date(2021, 3, 1) and year[-1] == dt.date(2022, 2, 1)
    assert one(spark, fn.month_span("2021-03-01", "2022-02-01"))[-1] == dt.date(2022, 1, 1)


def test_month_window_covers_the_same_months():
    assert fn.month_window("2021-03", "2022-02") == (dt.date(2021, 3, 1), dt.date(2022, 1, 31))


def test_day_span_includes_both_ends(spark):
    days = one(spark, fn.day_span("2021-02-27", "2021-03-01"))
    assert days == [dt.date(2021, 2, 27), dt.date(2021, 2, 28), dt.date(2021, 3, 1)]


def test_ordinal_day(spark):
    assert one(spark, fn.ordinal_day(fn.as_date("2020-01-02"))) == dt.date(2020, 1, 2).toordinal()


def test_zero_denominator_and_zero_log_are_null(spark):
    assert one(spark, fn.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, fn.safe_log(F.lit(0.0))) is None


def test_cap_keeps_null(spark):
    rows = spark.createDataFrame([(7.0,), (None,), (5.0,)], "x double")
    assert [r[0] for r in rows.select(fn.cap("x", 5.0)).collect()] == [5.0, None, 5.0]


def test_unmask_nulls_the_marker_and_raises_on_junk(spark):
    rows = spark.createDataFrame([("IDE",), ("1.5",)], "x string")
    assert [r[0] for r in rows.select(fn.unmask("x")).collect()] == [None, 1.5]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("abc",)], "x string").select(fn.unmask("x")).collect()


def test_names_and_paths(spark):
    assert one(spark, fn.repair_name(F.lit("Lavender’s"))) == "Lavender's"
    path = F.lit("file:/a/received/drop_01_02_2022/files/msoa_daily_agg_1.csv")
    assert one(spark, fn.file_name_of(path)) == "msoa_daily_agg_1.csv"
    assert one(spark, fn.folder_date(path)) == dt.date(2022, 2, 1)
    assert one(spark, fn.hour_of_band(F.lit("07-09"))) == 7


def test_row_mean_skips_nulls(spark):
    rows = spark.createDataFrame([(1.0, None), (None, None), (1.0, 3.0)], "a double, b double")
    assert [r[0] for r in rows.select(fn.row_mean(["a", "b"])).collect()] == [1.0, None, 2.0]


def test_within_includes_the_whole_last_day(spark):
    rows = spark.sql(
        "SELECT explode(array(timestamp_ntz'2021-01-01 00:00:00', timestamp_ntz'2021-01-02 23:59:59',"
        " timestamp_ntz'2021-01-03 00:00:00')) AS t"
    )
    assert rows.where(fn.within("t", "2021-01-01", "2021-01-02")).count() == 2


def test_nan_becomes_null(spark):
    rows = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in rows.select(fn.nan_to_null("x")).collect()] == [None, 1.0]
