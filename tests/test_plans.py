import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from kerbline.operators.projection import quoted
from kerbline.plans import at_risk, recovery
from kerbline.plans.figures import grouped_profiles

C = dict(key="key", time="t", value="v")


def test_clean_profiles_columns_and_values(spark):
    raw = [
        *recovery.PROFILE_CLASS_COLUMNS,
        *recovery.PROFILE_RENAMES,
        *recovery.PROFILE_UNUSED,
        "average IMD2019 score",
        "area_id",
    ]
    rows = spark.range(1).select(*[F.lit(10.0).alias(c) for c in raw])
    rows = rows.withColumn("total_number_of_offices", F.lit(0.0))
    out = recovery.clean_profiles(rows)
    assert set(out.columns) == {
        "area_id", "average IMD2019 score", "num_addresses", "pct residential addresses", "loac rank 1",
        "ptal", "pct JSA 2021", "pct work age", "log_pct commercial addresses", "log_Pop",
        "log_2019 scale", "log_pct offices", "log_pct HW", "log_pct employees",
    }
    row = out.select(*[F.col(quoted(c)) for c in out.columns]).first()
    assert row["log_Pop"] == pytest.approx(math.log(10)) and row["log_pct offices"] is None
    assert row["pct JSA 2021"] == 1.0


def weekly(spark):
    start = dt.date(2019, 12, 30)
    rows = [
        (k, start + dt.timedelta(days=7 * w), 1.0 + 0.1 * k + 0.01 * w * k)
        for k in range(6)
        for w in range(105)
    ]
    return spark.createDataFrame(rows, "key long, t date, v double")


def test_recovery_stats_use_the_stated_periods(spark):
    series = weekly(spark)
    out = {r["key"]: r for r in recovery.recovery_stats(series, **C).collect()}
    rows = [r for r in series.collect() if r["key"] == 3]

    def mean(a, b):
        lo, hi = dt.date.fromisoformat(a), dt.date.fromisoformat(b)
        inside = [r["v"] for r in rows if lo <= r["t"] <= hi]
        return sum(inside) / len(inside)

    assert out[3]["mean 2020"] == pytest.approx(mean("2020-03-14", "2020-11-01"))
    assert out[3]["hit percent 2021"] == pytest.approx(
        mean("2021-01-05", "2021-03-12") / mean("2020-08-01", "2020-11-05")
    )
    assert out[3]["slope 2020"] == pytest.approx(0.03 / 7)


def test_parameter_shift(spark):
    fits = spark.createDataFrame(
        [(1, "a", 1.0, 2.0), (1, "b", 2.0, 5.0), (2, "a", 3.0, 4.0), (2, "b", 3.0, 4.0)],
        "key long, fit string, slope double, intercept double",
    )
    raw = {r["key"]: r for r in recovery.parameter_shift(fits, "a", "b", key="key").collect()}
    assert (raw[1]["slope_shift"], raw[1]["intercept_shift"]) == (1.0, 3.0)
    scaled = {r["key"]: r for r in recovery.parameter_shift(fits, "a", "b", key="key", scaled=True).collect()}
    assert (scaled[1]["slope_shift"], scaled[1]["intercept_shift"]) == (1.0, 3.0)
    assert scaled[2]["slope_shift"] == 0.0 and scaled[2]["slope"] == 3.0


def test_spend_features_follow_month_rules(spark):
    rows = spark.createDataFrame(
        [(1, "2021-03-01", 1.0), (1, "2022-02-28", 3.0), (1, "2022-03-01", 99.0), (2, "2020-05-01", 1.0),
         (3, "2019-01-01", 1.0)],
        "key long, t string, v double",
    ).withColumn("t", F.col("t").cast("date"))
    out = {r["key"]: r for r in at_risk.spend_features(rows, **C).collect()}
    assert out[1]["mean"] == 2.0 and out[1]["std"] == pytest.approx(math.sqrt(2))
    assert out[1]["gradient"] == pytest.approx(2 / 364)
    assert out[2]["mean"] is None and out[2]["gradient_r1"] is None
    assert 3 not in out


def test_footfall_lookup_repeats_rows_and_keeps_visitors(spark):
    year = spark.createDataFrame(
        [("m1", "2021-06-01", "Visitor", 1.0), ("m1", "2021-06-01", "Worker", 9.0), ("m9", "2021-06-01", "Visitor", 2.0)],
        "msoa11cd string, count_date string, count_type string, h13 double",
    )
    lookup = spark.createDataFrame([("m1", "A"), ("m1", "B")], "msoa11cd string, area_name string")
    out = at_risk.prepare_footfall(
        [year, year.limit(0)], lookup, small_area="msoa11cd", time="count_date", kind="count_type",
        value="h13", name="area_name",
    )
    assert sorted(r["area_name"] for r in out.collect()) == ["A", "B"]


def test_grouped_profiles_means(spark):
    series = weekly(spark)
    stats = recovery.recovery_stats(series, **C)
    rows, means = grouped_profiles(series, stats, "mean 2020", "slope 2020", 2, **C)
    assert rows.count() == 6 * 105 and means.groupBy("cell").count().count() == 4
    week = rows.where("t = '2020-06-01'").groupBy("cell").agg(F.avg("v").alias("m")).collect()
    got = {r["cell"]: r["mean_value"] for r in means.where("t = '2020-06-01'").collect()}
    assert {r["cell"]: pytest.approx(r["m"]) for r in week} == got
