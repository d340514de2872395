"""The feature builders and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import month_window
from ..operators.groups import percentile_cells
from ..operators.series import extract_series
from ..plans import at_risk, recovery
from ..sources.tables import group_table
from .aggregation import LINE_SPANS, LINES_SQL, SECTOR_SQL, lines, sector_spend
from .base import (
    NATION_MONTH,
    R,
    SUPPLIER_WEEK,
    USER_DAY,
    case,
    complete_sql,
    dense_sql,
    nation_month,
    supplier_week,
    table,
    text,
    tidy,
    user_day,
)

_C = dict(key="key", time="t", value="v")


def _b(a: str, b: str) -> str:
    return f"t BETWEEN DATE '{a}' AND DATE '{b}'"


@case(
    "recovery_cells",
    f"""WITH {NATION_MONTH}, {dense_sql('nm')}, {complete_sql('dense')},
s AS (SELECT key, t, CASE WHEN v > 260000 THEN 260000 ELSE v END AS v FROM whole WHERE {_b('1997-01-01', '1998-12-31')}),
st AS (SELECT key, avg(v) FILTER (WHERE {_b('1998-01-01', '1998-12-31')}) / avg(v) FILTER (WHERE {_b('1997-01-01', '1997-12-31')}) AS hit,
  regr_slope(v, date_diff('day', DATE '1998-01-01', t)) FILTER (WHERE {_b('1998-01-01', '1998-12-31')}) AS slope FROM s GROUP BY key),
a AS (SELECT *, ntile(4) OVER (ORDER BY hit, key) AS i FROM st),
b AS (SELECT *, ntile(4) OVER (PARTITION BY i ORDER BY slope, key) AS j FROM a)
SELECT key, {R('hit', 6)} AS hit, {R('slope')} AS slope, CAST((i - 1) * 4 + j AS INT) AS overall_group,
  CAST(i AS INT) AS group_1, CAST(j AS INT) AS group_2 FROM b""",
)
def recovery_cells(spark, sf):
    out = recovery.recovery_cells(
        nation_month(spark, sf),
        ("1997-01-01", "1998-12-31"),
        (("1998-01-01", "1998-12-31"), ("1997-01-01", "1997-12-31")),
        (("1998-01-01", "1998-12-31"), "1998-01-01"),
        **_C,
        upper=260000.0,
        unique=True,
    )
    return out.withColumns({"hit": tidy("hit", 6), "slope": tidy("slope")})


# ---- profile ------------------------------------------------------------------------

# profile column -> how it is derived from the customer and its orders
_PROFILE_SQL = {
    "pattern_2020": "'p'",
    "pattern_2021": "'q'",
    "all_pandemic": "'r'",
    "RECODE": "'s'",
    "total_number_of_addresses": "n",
    "total_number_of_offices": "urgent",
    "total_number_of_residential_addresses": "low",
    "total_number_of_commercial_addresses": "n - low",
    "percentage of commercial addresses (%)": "100.0 * (n - low) / n",
    "precentage of residential addresses (%)": "100.0 * low / n",
    "TotalPopulation": "total",
    "WorkAgePopulation": "open_total",
    "Employees": "top",
    "total number of job seekers allownace 2021": "bottom",
    "total estimated number of home workers": "c_acctbal",
    "Sum_y2019_07wd": "total / 7",
    "Sum_y2021_10wd": "total / 10",
    "Cnt_highstreet": "n",
    "pc_chng": "top - bottom",
    "LOAC2011_Group_Name (Rank 1)": "c_mktsegment",
    "LOAC2011_Group_Name (Rank 2)": "c_name",
    "PTAL2015 (Rank 1)": "c_nationkey",
    "average IMD2019 score": "bottom / 1000",
    "ptal2015 percentage of overlap %(Rank 1)": "n * 1.5",
}


def profile(spark, sf):
    orders = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("urgent"),
            F.count(F.when(F.col("o_orderpriority") == "5-LOW", 1)).alias("low"),
            F.sum("o_totalprice").alias("total"),
            F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))).alias("open_total"),
            F.max("o_totalprice").alias("top"),
            F.min("o_totalprice").alias("bottom"),
        )
    )
    rows = table(spark, sf, "customer").join(orders, "c_custkey")
    return rows.select(
        F.col("c_custkey").alias("area_id"),
        *[F.expr(e.replace("100.0 *", "100.0D *").replace("1.5", "1.5D")).alias(c) for c, e in _PROFILE_SQL.items()],
    )


def _log(expr: str) -> str:
    return R(f"ln(CASE WHEN {expr} > 0 THEN {expr} END)", 5)


PROFILE_CTE = """pr AS (SELECT o_custkey, count(*) AS n, count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS urgent,
  count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) AS low, sum(o_totalprice) AS total,
  sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS open_total, max(o_totalprice) AS top,
  min(o_totalprice) AS bottom FROM orders GROUP BY 1)"""


@case(
    "b01_clean_profiles",
    f"""WITH {PROFILE_CTE} SELECT c_custkey AS area_id, n AS num_addresses,
  {R('100.0 * low / n')} AS "pct residential addresses", c_mktsegment AS "loac rank 1", c_nationkey AS ptal,
  {R('bottom / 1000')} AS "average IMD2019 score", {R('bottom / nullif(total, 0)', 6)} AS "pct JSA 2021",
  {R('open_total / nullif(total, 0)', 6)} AS "pct work age",
  {_log('(100.0 * (n - low) / n)')} AS "log_pct commercial addresses", {_log('total')} AS "log_Pop",
  {_log('(total / 7)')} AS "log_2019 scale", {_log('(urgent / n)')} AS "log_pct offices",
  {_log('(c_acctbal / total)')} AS "log_pct HW", {_log('(top / total)')} AS "log_pct employees"
FROM customer JOIN pr ON c_custkey = o_custkey""",
)
def b01(spark, sf):
    out = recovery.clean_profiles(profile(spark, sf))
    places = {"pct residential addresses": 4, "average IMD2019 score": 4, "pct JSA 2021": 6, "pct work age": 6}
    places.update({c: 5 for c in out.columns if c.startswith("log_")})
    return out.withColumns({c: tidy(f"`{c}`", n) for c, n in places.items()})


_MEANS = {"mean 2020": ("1996-03-14", "1996-11-01"), "mean 2021": ("1997-03-14", "1997-11-01")}
_HITS = {
    "hit percent 2020": (("1996-03-24", "1996-06-15"), ("1996-01-04", "1996-03-24")),
    "hit percent 2021": (("1997-01-05", "1997-03-12"), ("1996-08-01", "1996-11-05")),
}
_SLOPES = {f"slope {y}": LINE_SPANS[f] for y, f in (("2020", "a"), ("2021", "b"))}


def _mean_sql(span) -> str:
    return f"avg(v) FILTER (WHERE {_b(*span)})"


_STATS_SQL = ", ".join(
    [f"{R(_mean_sql(s), 3)} AS \"{n}\"" for n, s in _MEANS.items()]
    + [f"{R(f'{_mean_sql(a)} / {_mean_sql(c)}')} AS \"{n}\"" for n, (a, c) in _HITS.items()]
    + [
        R(f"regr_slope(v, date_diff('day', DATE '{t0}', t)) FILTER (WHERE {_b(*s)})", 3) + f' AS "{n}"'
        for n, (s, t0) in _SLOPES.items()
    ]
)


@case(
    "b02_profile_features",
    f"""WITH {SUPPLIER_WEEK}, {dense_sql('sw')}, {complete_sql('dense')}, {SECTOR_SQL},
st AS (SELECT key, {_STATS_SQL} FROM whole GROUP BY key)
SELECT st.*, {R('(yoy_e + 0) / nullif(tot, 0)')} AS percent_retail, s_nationkey AS cluster_size, s_name
FROM st LEFT JOIN (SELECT area_id, coalesce(yoy_txn_amt_wd_retail, 0) + coalesce(yoy_txn_amt_we_retail, 0) AS yoy_e,
  {' + '.join(f"coalesce(yoy_txn_amt_{k}_{s}, 0)" for k in ('we', 'wd') for s in ('eating', 'retail', 'apparel'))} AS tot FROM sp) x
  ON st.key = x.area_id
LEFT JOIN supplier ON st.key = s_suppkey""",
)
def b02(spark, sf):
    series = extract_series(
        supplier_week(spark, sf), "1995-01-01", "2001-12-31", **_C, upper=None, unique=True
    )
    suppliers = table(spark, sf, "supplier")
    clusters = suppliers.select(
        F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("cluster_hourly"),
        F.col("s_nationkey").alias("cluster_daily"), F.col("s_nationkey").alias("cluster_size"),
    )
    out = recovery.profile_features(
        series,
        sector_spend(spark, sf).withColumnRenamed("area_id", "key"),
        clusters,
        suppliers.select(F.col("s_suppkey").alias("key"), "s_name"),
        **_C,
        means=_MEANS, hits=_HITS, slopes=_SLOPES,
    )
    return out.select(
        "key",
        *[tidy(f"`{c}`", 3).alias(c) for c in _MEANS],
        *[tidy(f"`{c}`").alias(c) for c in _HITS],
        *[tidy(f"`{c}`", 3).alias(c) for c in _SLOPES],
        tidy("percent_retail").alias("percent_retail"), "cluster_size", "s_name",
    )


@case(
    "b10_parameter_shift",
    f"""WITH {SUPPLIER_WEEK}, f AS ({LINES_SQL})
SELECT x.key, {R('y.slope - x.slope')} AS slope_shift, {R('y.intercept - x.intercept', 2)} AS intercept_shift
FROM f x JOIN f y ON x.key = y.key WHERE x.fit = 'a' AND y.fit = 'b'""",
)
def b10(spark, sf):
    out = recovery.parameter_shift(lines(spark, sf).where(F.col("n") > 0), "a", "b", key="key")
    return out.select(
        "key", tidy("slope_shift").alias("slope_shift"), tidy("intercept_shift", 2).alias("intercept_shift")
    )


@case(
    "b10_parameter_shift_scaled",
    f"""WITH {SUPPLIER_WEEK}, f AS ({LINES_SQL}), p AS (SELECT stddev_pop(slope) AS ss, stddev_pop(intercept) AS si FROM f WHERE fit = 'a')
SELECT x.key, {R('(y.slope - x.slope) / ss')} AS slope_shift, {R('(y.intercept - x.intercept) / si')} AS intercept_shift
FROM f x JOIN f y ON x.key = y.key, p WHERE x.fit = 'a' AND y.fit = 'b'""",
)
def b10b(spark, sf):
    out = recovery.parameter_shift(
        lines(spark, sf).where(F.col("n") > 0), "a", "b", key="key", scaled=True
    )
    return out.select(
        "key", tidy("slope_shift").alias("slope_shift"), tidy("intercept_shift").alias("intercept_shift")
    )


@case(
    "s15_group_table",
    """WITH o AS (SELECT o_custkey, max(o_totalprice) AS top, min(o_totalprice) AS low FROM orders GROUP BY 1),
e AS (SELECT quantile_cont(top, 0.1) AS a, quantile_cont(top, 0.9) AS b, quantile_cont(low, 0.1) AS c, quantile_cont(low, 0.9) AS d FROM o),
g AS (SELECT o_custkey, (top >= a)::INT + (top > b)::INT AS r, (low >= c)::INT + (low > d)::INT AS k FROM o, e)
SELECT c_name, CAST(r AS INT) AS "row", CAST(k AS INT) AS "column", CAST(r * 3 + k AS INT) AS "group"
FROM g JOIN customer ON o_custkey = c_custkey""",
)
def s15(spark, sf):
    from ..session import staging_path
    from ..sources.tables import read_csv, write_csv

    stats = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("top"), F.min("o_totalprice").alias("low"))
        .join(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")
    )
    cells = percentile_cells(stats, "top", "low", 1, key="c_custkey")
    where = staging_path(spark, "groups") + ".csv"
    write_csv(group_table(cells, name="c_name"), where)
    return read_csv(spark, where, schema="c_name string, `row` int, `column` int, `group` int")


# ---- at-risk features ---------------------------------------------------------------

_SPEND_MONTHS = ("1997-03", "1998-03")
_RECOVERIES = {"gradient_r1": ("1996-04", "1996-10"), "gradient_r2": ("1997-04", "1997-08")}


def _spend(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderdate").cast("date").alias("t"),
        F.col("o_totalprice").alias("v"),
    )


_SPEND_CTE = "sp AS (SELECT o_custkey AS key, CAST(o_orderdate AS DATE) AS t, o_totalprice AS v FROM orders)"


def _months_sql(months) -> str:
    first, last = month_window(*months)
    return _b(str(first), str(last))


def _slope_sql(cond: str, places: int = 3) -> str:
    return R(f"regr_slope(v, date_diff('day', DATE '0001-01-01', t) + 1) FILTER (WHERE {cond})", places)


_SPEND_FEATURES = f"""SELECT key, {R(f"avg(v) FILTER (WHERE {_months_sql(_SPEND_MONTHS)})", 3)} AS mean,
  {R(f"stddev_samp(v) FILTER (WHERE {_months_sql(_SPEND_MONTHS)})", 3)} AS std,
  {_slope_sql(_months_sql(_SPEND_MONTHS))} AS gradient,
  {', '.join(f"{_slope_sql(_months_sql(m))} AS {n}" for n, m in _RECOVERIES.items())}
FROM sp WHERE {' OR '.join(_months_sql(m) for m in [_SPEND_MONTHS, *_RECOVERIES.values()])} GROUP BY key"""


@case(
    "b04_mean_spread_in_months",
    f"""WITH {_SPEND_CTE} SELECT key, {R('avg(v)', 3)} AS mean, {R('stddev_samp(v)', 3)} AS std
FROM sp WHERE {_months_sql(_SPEND_MONTHS)} GROUP BY key""",
)
def b04(spark, sf):
    out = at_risk.mean_spread_in(
        _spend(spark, sf), at_risk.months_as_span(_SPEND_MONTHS), **_C, mean="mean", sd="std"
    )
    return out.select("key", tidy("mean", 3).alias("mean"), tidy("std", 3).alias("std"))


@case(
    "b05_gradient_in_months",
    f"""WITH {_SPEND_CTE} SELECT key, {_slope_sql('TRUE')} AS gradient FROM sp
WHERE {_months_sql(_SPEND_MONTHS)} GROUP BY key""",
)
def b05(spark, sf):
    from ..operators.aggregates import gradients
    from ..operators.series import slice_period

    span = at_risk.months_as_span(_SPEND_MONTHS)
    rows = slice_period(_spend(spark, sf), *span, time="t")
    out = gradients(rows, {"gradient": span}, **_C)
    return out.select("key", tidy("gradient", 3).alias("gradient"))


@case("b06_spend_features", f"WITH {_SPEND_CTE} {_SPEND_FEATURES}")
def b06(spark, sf):
    out = at_risk.spend_features(
        _spend(spark, sf), **_C, months=_SPEND_MONTHS, recoveries=_RECOVERIES
    )
    return out.select(
        "key", *[tidy(c, 3).alias(c) for c in ("mean", "std", "gradient", *_RECOVERIES)]
    )


_DAYS = ("2024-01-03", "2024-01-28")
_SPLITS = {"grad_o2_pre": ("2024-01-03", "2024-01-14"), "grad_o2_post": ("2024-01-15", "2024-01-28")}


@case(
    "b03_mean_spread_in_days",
    f"""WITH {USER_DAY} SELECT key, {R('avg(v)')} AS mean_o2, {R('stddev_samp(v)')} AS std_o2
FROM ud WHERE {_b(*_DAYS)} GROUP BY key""",
)
def b03(spark, sf):
    out = at_risk.mean_spread_in(user_day(spark, sf), _DAYS, **_C, mean="mean_o2", sd="std_o2")
    return out.select("key", tidy("mean_o2").alias("mean_o2"), tidy("std_o2").alias("std_o2"))


@case(
    "b07_footfall_features",
    f"""WITH {USER_DAY} SELECT key, {R('avg(v)')} AS mean_o2, {R('stddev_samp(v)')} AS std_o2,
  {', '.join(f"{_slope_sql(_b(*s), 4)} AS {n}" for n, s in _SPLITS.items())}
FROM ud WHERE {_b(*_DAYS)} GROUP BY key
HAVING {' AND '.join(f"count(*) FILTER (WHERE {_b(*s)}) > 0" for s in _SPLITS.values())}""",
)
def b07(spark, sf):
    out = at_risk.footfall_features(user_day(spark, sf), **_C, days=_DAYS, gradients=_SPLITS)
    return out.select("key", *[tidy(c).alias(c) for c in ("mean_o2", "std_o2", *_SPLITS)])


@case(
    "b08_complete_features",
    f"""WITH a AS (SELECT 'caf''' || CAST(o_custkey AS VARCHAR) AS name, count(*) AS n FROM orders GROUP BY 1),
b AS (SELECT 'caf''' || CAST(user_id AS VARCHAR) AS name, {R('avg(value)')} AS mean_o2 FROM events GROUP BY user_id)
SELECT name, n, mean_o2 FROM a JOIN b USING (name)""",
)
def b08(spark, sf):
    spend = table(spark, sf, "orders").groupBy(
        F.concat(F.lit("caf'"), F.col("o_custkey").cast("string")).alias("name")
    ).agg(F.count(F.lit(1)).alias("n"))
    footfall = table(spark, sf, "events").groupBy(
        F.concat(F.lit("café"), F.col("user_id").cast("string")).alias("name")
    ).agg(tidy(F.avg("value")).alias("mean_o2"))
    return at_risk.complete_features(spend, footfall, key="name")


@case(
    "b09_prepare_footfall",
    """WITH v AS (SELECT user_id, CAST(ts AS DATE) AS day, value FROM events WHERE event_type = 'view'),
lk AS (SELECT c_custkey, 'n' || CAST(c_nationkey AS VARCHAR) AS area FROM customer
  UNION ALL SELECT c_custkey, c_mktsegment FROM customer)
SELECT user_id, CAST(day AS VARCHAR) AS day, 'Visitor' AS kind, value, area FROM v JOIN lk ON user_id = c_custkey""",
)
def b09(spark, sf):
    events = table(spark, sf, "events")
    kind = F.when(F.col("event_type") == "view", F.lit("Visitor")).otherwise(F.col("event_type"))
    rows = events.select("user_id", F.col("ts").alias("day"), kind.alias("kind"), "value")
    middle = F.lit("2024-01-16").cast("date")
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "user_id")
    lookup = customers.select(
        "user_id",
        F.explode(
            F.array(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")), F.col("c_mktsegment"))
        ).alias("area"),
    )
    out = at_risk.prepare_footfall(
        [rows.where(F.col("day") < middle), rows.where(F.col("day") >= middle)],
        lookup, small_area="user_id", time="day", kind="kind", value="value", name="area",
    )
    return out.withColumn("day", text("day"))
