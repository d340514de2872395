import datetime as dt

import numpy as np
import pandas as pd
import pytest

from kerbline.operators import reshape, series
from kerbline.operators.projection import average_day_kinds

C = dict(key="key", time="t", value="v")


def frame(spark, rows):
    return spark.createDataFrame(rows, "key long, t date, v double")


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def as_map(df, value="v"):
    return {(r["key"], r["t"]): r[value] for r in df.collect()}


def test_gap_rules(spark):
    rows = [(1, day(0), 9.0)] + [(1, day(n), float(n)) for n in range(1, 6)]
    rows += [(2, day(1), 1.0), (2, day(3), 3.0), (2, day(5), None)]
    got = as_map(series.densify(frame(spark, rows), **C))
    assert [got[(2, day(n))] for n in range(6)] == [None, 1.0, 2.0, 3.0, 3.0, 3.0]
    kept = series.densify(frame(spark, rows), **C, keep_incomplete=False)
    assert {r["key"] for r in kept.collect()} == {1}


def test_interpolation_ignores_uneven_spacing(spark):
    rows = [(1, day(0), 0.0), (1, day(7), 10.0), (2, day(0), 1.0), (2, day(5), 1.0), (2, day(7), 1.0)]
    assert as_map(series.densify(frame(spark, rows), **C))[(1, day(5))] == 5.0


def test_key_without_values_stays_all_null_then_drops(spark):
    rows = [(1, day(0), 1.0), (1, day(1), 2.0), (2, day(1), None)]
    got = as_map(series.densify(frame(spark, rows), **C))
    assert got[(2, day(0))] is None and got[(2, day(1))] is None and len(got) == 4
    assert {k for k, _ in as_map(series.densify(frame(spark, rows), **C, keep_incomplete=False))} == {1}


def test_matches_the_wide_form_on_random_gaps(spark):
    rng = np.random.default_rng(1)
    rows = [
        (k, day(int(n)), float(rng.normal()) if rng.random() > 0.2 else None)
        for k in range(12)
        for n in range(0, 60, 3)
        if rng.random() > 0.35
    ]
    wide = pd.DataFrame(rows, columns=["key", "t", "v"]).pivot(index="t", columns="key", values="v")
    wide = wide.astype(float).interpolate()
    got = as_map(series.densify(frame(spark, rows), **C))
    assert len(got) == wide.size
    for (k, t), v in got.items():
        w = wide.loc[t, k]
        assert (v is None and np.isnan(w)) or v == pytest.approx(w, abs=1e-12)
    whole = wide.dropna(axis="columns", how="any")
    cut = whole[(whole.index >= day(10)) & (whole.index <= day(40))].clip(upper=0.5)
    part = as_map(series.extract_series(frame(spark, rows), day(10), day(40), **C, upper=0.5))
    assert len(part) == cut.size
    assert all(v == pytest.approx(cut.loc[t, k], abs=1e-12) for (k, t), v in part.items())


def test_drop_comes_before_slice(spark):
    # key 2 starts late: it is complete inside the slice, but not over the whole range
    rows = [(1, day(n), 1.0) for n in range(5)] + [(2, day(n), 1.0) for n in range(2, 5)]
    part = series.extract_series(frame(spark, rows), day(3), day(4), **C)
    assert {r["key"] for r in part.collect()} == {1}


def test_repeated_period_stops(spark):
    rows = frame(spark, [(1, day(0), 1.0), (1, day(0), 2.0)])
    assert series.duplicate_periods(rows, key="key", time="t").first()["n_rows"] == 2
    with pytest.raises(Exception, match="more than one row"):
        series.densify(rows, **C).collect()


def test_observed_values_never_change(spark):
    rows = [(1, day(0), 3.0), (1, day(4), 7.0), (2, day(2), 1.0)]
    got = as_map(series.densify(frame(spark, rows), **C))
    assert all(got[(k, t)] == v for k, t, v in rows)


def test_stack_moves_weekends_and_reads_once(spark):
    rows = spark.createDataFrame(
        [(dt.date(2020, 1, 6), 1, "a", 1.0, 2.0, 3.0, None)],
        "week_start date, id long, name string, yoy_txn_amt_we_retail double, yoy_txn_amt_wd_retail double,"
        " yoy_txn_cnt_we_retail double, yoy_txn_cnt_wd_retail double",
    )
    out = reshape.stack_day_kinds(rows, key="id", name="name", prefix="yoy_").collect()
    got = {r["we_wd"]: (r["period_start"], r["txn_amt"], r["txn_cnt"]) for r in out}
    assert got["we"] == (dt.date(2020, 1, 11), 1.0, 3.0)
    assert got["wd"] == (dt.date(2020, 1, 6), 2.0, None)
    mean = average_day_kinds(rows, keep=["id", "name"], prefix="yoy_").first()
    assert (mean["txn_amt"], mean["txn_cnt"]) == (1.5, 3.0)


def test_one_hot_of_null_is_all_zero(spark):
    rows = spark.createDataFrame([("a",), (None,)], "c string")
    assert [tuple(r) for r in reshape.one_hot(rows, "c", ["a", "b"]).collect()] == [(1, 0), (0, 0)]


def test_densify_plan_has_no_pair_join(spark):
    rows = frame(spark, [(1, day(0), 3.0), (1, day(4), 7.0), (2, day(2), 1.0)])
    plan = series.densify(rows, **C)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_union_fills_missing_columns(spark):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 3 AS x")
    rows = reshape.union_all([a, b]).orderBy("x").collect()
    assert [tuple(r) for r in rows] == [(1, 2), (3, None)]
