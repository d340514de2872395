import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbline.sources import feeds

STAMP = {"file_date": dt.date(2022, 2, 1), "file_name": "f.csv"}
BASE = {"scaled_volume": "12.5", "loyalty_percentage": "IDE", "dwell_time": "3"}
AREA = {"worker_population_percentage": "IDE", "resident_population_percentage": "40"}
GOOD = {
    "hex_daily": {"hex_grid_id": "17", "time_indicator": "21-24", "date": "2022-01-05"},
    "hex_monthly": {"hex_grid_id": "17", "time_indicator": "00-03", "month": "2022-01-01", "day_name": "Monday"},
    "lsoa_daily": {"lsoa_id": "E01", "time_indicator": "Night", "date": "2022-01-05", **AREA},
    "lsoa_monthly": {"lsoa_id": "E01", "time_indicator": "Noon", "month": "2022-01-01", "day_name": "Sunday", **AREA},
    "msoa_daily": {"msoa_id": "E02", "time_indicator": "Morning", "date": "2022-01-05", **AREA},
    "msoa_monthly": {"msoa_id": "E02", "time_indicator": "Evening", "month": "2022-01-01", "day_name": "Friday", **AREA},
}


def frame(spark, route, *changes):
    rows = [{**STAMP, **BASE, **GOOD[route], **c} for c in (changes or ({},))]
    names = list(rows[0])
    kinds = ", ".join(f"{n} {'date' if n == 'file_date' else 'string'}" for n in names)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], kinds)


@pytest.mark.parametrize("route", list(GOOD))
def test_good_rows_come_out_typed(spark, route):
    out = feeds.clean_feed(frame(spark, route), route)
    spec = feeds.FEEDS[route].spec
    assert {f.name: f.dataType.simpleString() for f in out.schema} == {c: f.type for c, f in spec.items()}
    row = out.first()
    assert row["loyalty_percentage"] is None and row["scaled_volume"] == 12.5
    if "hex" in route:
        assert row["hex_grid_id"] == 17 and row["time_indicator"] in (21, 0)


@pytest.mark.parametrize(
    "route, change, rule",
    [
        ("hex_daily", {"dwell_time": "0"}, "dwell_time:positive"),
        ("hex_daily", {"scaled_volume": "abc"}, "scaled_volume:type"),
        ("hex_daily", {"time_indicator": "24-27"}, "time_indicator:between"),
        ("hex_daily", {"hex_grid_id": None}, "hex_grid_id:not_null"),
        ("hex_daily", {"date": "soon"}, "date:type"),
        ("lsoa_daily", {"time_indicator": "Noonish"}, "time_indicator:one_of"),
        ("msoa_monthly", {"day_name": "Someday"}, "day_name:one_of"),
        ("msoa_monthly", {"msoa_id": None}, "msoa_id:not_null"),
        ("lsoa_monthly", {"worker_population_percentage": "-1"}, "worker_population_percentage:positive"),
    ],
)
def test_each_rule(spark, route, change, rule):
    rows = frame(spark, route, {}, change)
    checked = feeds.clean_feed(rows, route, mode="keep")
    assert [r["violations"] for r in checked.collect()] == [[], [rule]]
    assert feeds.clean_feed(rows, route, mode="drop").count() == 1
    assert feeds.quarantine(rows, feeds.FEEDS[route].spec).count() == 1
    report = {r["rule"]: r["n"] for r in feeds.violation_report(rows, feeds.FEEDS[route].spec).collect()}
    assert report[rule] == 1 and sum(report.values()) == 1
    with pytest.raises(Exception, match=rule):
        feeds.clean_feed(rows, route).count()


def test_null_passes_value_checks(spark):
    rows = frame(spark, "hex_daily", {"scaled_volume": None, "dwell_time": "IDE"})
    assert feeds.clean_feed(rows, "hex_daily").count() == 1


def test_missing_column_fails_before_any_job(spark):
    with pytest.raises(ValueError, match="dwell_time"):
        feeds.clean_feed(frame(spark, "hex_daily").drop("dwell_time"), "hex_daily")


def test_extra_columns_pass(spark):
    out = feeds.clean_feed(frame(spark, "hex_daily").withColumn("more", F.lit(1)), "hex_daily")
    assert out.first()["more"] == 1


def test_routes(spark):
    names = [(f.prefix + "_202201.csv", r) for r, f in feeds.FEEDS.items()]
    files = spark.createDataFrame([(n,) for n, _ in names] + [("msoa_footfall_hist_1.csv",)], "file_name string")
    got = {r["file_name"]: r["r"] for r in files.withColumn("r", feeds.route_of("file_name")).collect()}
    assert all(got[n] == r for n, r in names)
    assert [r[0] for r in feeds.unroutable(files).collect()] == ["msoa_footfall_hist_1.csv"]
