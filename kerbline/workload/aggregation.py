"""Per-key statistics over spans, shares, slopes, correlations, histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from .base import (
    R,
    SUPPLIER_WEEK,
    USER_DAY,
    case,
    complete_sql,
    dense_sql,
    supplier_week,
    table,
    text,
    tidy,
    user_day,
)

_C = dict(key="key", time="t", value="v")


def _between(a: str, b: str) -> str:
    return f"t BETWEEN DATE '{a}' AND DATE '{b}'"


@case(
    "a01_mean_per_key",
    f"SELECT user_id, {R('avg(value)')} AS mean FROM events GROUP BY user_id",
)
def a01(spark, sf):
    out = agg.mean_and_spread(table(spark, sf, "events"), key="user_id", value="value")
    return out.select("user_id", tidy("mean").alias("mean"))


@case(
    "a02_mean_and_spread",
    f"""SELECT o_custkey, {R('avg(o_totalprice)')} AS mean, {R('stddev_samp(o_totalprice)', 3)} AS std
FROM orders GROUP BY o_custkey""",
)
def a02(spark, sf):
    out = agg.mean_and_spread(table(spark, sf, "orders"), key="o_custkey", value="o_totalprice")
    return out.select("o_custkey", tidy("mean").alias("mean"), tidy("std", 3).alias("std"))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# every order falls in one kind of day and one sector
_SECTOR_COLUMNS = {
    f"yoy_txn_amt_{kind}_{sector}": (statuses, priorities)
    for kind, statuses in (("we", ["O"]), ("wd", ["F", "P"]))
    for sector, priorities in (
        ("eating", ["1-URGENT", "4-NOT SPECIFIED"]), ("retail", ["2-HIGH", "5-LOW"]), ("apparel", ["3-MEDIUM"])
    )
}


def _listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


SECTOR_SQL = "sp AS (SELECT o_custkey AS area_id, " + ", ".join(
    f"sum(CASE WHEN o_orderstatus IN {_listed(s)} AND o_orderpriority IN {_listed(p)} THEN o_totalprice END) AS {c}"
    for c, (s, p) in _SECTOR_COLUMNS.items()
) + " FROM orders GROUP BY 1)"


def sector_spend(spark, sf):
    """Orders in the layout of the sector spend table, one row per order."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("area_id"),
        *[
            F.when(
                F.col("o_orderstatus").isin(s) & F.col("o_orderpriority").isin(p),
                F.col("o_totalprice"),
            ).alias(c)
            for c, (s, p) in _SECTOR_COLUMNS.items()
        ],
    )


@case(
    "a03_sum_per_key",
    f"WITH {SECTOR_SQL} SELECT area_id, "
    + ", ".join(f"{R(f'coalesce({c}, 0)', 2)} AS {c}" for c in _SECTOR_COLUMNS)
    + " FROM sp",
)
def a03(spark, sf):
    out = agg.sum_per_key(sector_spend(spark, sf), list(_SECTOR_COLUMNS), key="area_id")
    return out.select("area_id", *[tidy(c, 2).alias(c) for c in _SECTOR_COLUMNS])


def _plus(names) -> str:
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in names) + ")"


_ALL = _plus(_SECTOR_COLUMNS)
_WE = _plus([c for c in _SECTOR_COLUMNS if "_we_" in c])
_WD = _plus([c for c in _SECTOR_COLUMNS if "_wd_" in c])


@case(
    "a05_row_sums",
    f"""WITH {SECTOR_SQL} SELECT area_id, {R(_ALL, 2)} AS total, {R(_WE, 2)} AS total_we,
  {R(_WD, 2)} AS total_wd FROM sp""",
)
def a05(spark, sf):
    out = agg.sector_shares(
        sector_spend(spark, sf), key="area_id", sectors=["eating", "retail", "apparel"]
    )
    return out.select(
        "area_id", *[tidy(c, 2).alias(c) for c in ("total", "total_we", "total_wd")]
    )


@case(
    "a06_sector_shares",
    f"WITH {SECTOR_SQL} SELECT area_id, "
    + ", ".join(
        R(f"{_plus([c for c in _SECTOR_COLUMNS if c.endswith(s)])} / nullif({_ALL}, 0)") + f" AS percent_{s}"
        for s in ("eating", "retail", "apparel")
    )
    + f", {R(f'{_WE} / nullif({_ALL}, 0)')} AS percent_we, {R(f'{_WD} / nullif({_ALL}, 0)')} AS percent_wd FROM sp",
)
def a06(spark, sf):
    sectors = ["eating", "retail", "apparel"]
    out = agg.sector_shares(sector_spend(spark, sf), key="area_id", sectors=sectors)
    names = [f"percent_{s}" for s in [*sectors, "we", "wd"]]
    return out.select("area_id", *[tidy(c).alias(c) for c in names])


# the weeks of the spans, and every supplier whether or not it has a line in them
_SPANNED = ("1996-01-01", "1997-12-31")
_PER_SUPPLIER = "FROM supplier LEFT JOIN sw ON key = s_suppkey GROUP BY s_suppkey"


def _per_supplier(spark, sf, out, names):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"))
    return suppliers.join(out, "key", "left").select("key", *[tidy(c).alias(c) for c in names])


@case(
    "a07_span_means",
    f"""WITH {SUPPLIER_WEEK} SELECT s_suppkey AS key,
  {R(f"avg(v) FILTER (WHERE {_between('1996-03-14', '1996-11-01')})")} AS mean_1996,
  {R(f"avg(v) FILTER (WHERE {_between('1997-03-14', '1997-11-01')})")} AS mean_1997 {_PER_SUPPLIER}""",
)
def a07(spark, sf):
    out = agg.span_means(
        supplier_week(spark, sf, _SPANNED),
        {"mean_1996": ("1996-03-14", "1996-11-01"), "mean_1997": ("1997-03-14", "1997-11-01")},
        **_C,
    )
    return _per_supplier(spark, sf, out, ["mean_1996", "mean_1997"])


@case(
    "a08_hit_ratios",
    f"""WITH {SUPPLIER_WEEK} SELECT s_suppkey AS key,
  {R(f"avg(v) FILTER (WHERE {_between('1996-03-24', '1996-06-15')}) / avg(v) FILTER (WHERE {_between('1996-01-04', '1996-03-24')})")} AS hit_1996,
  {R(f"avg(v) FILTER (WHERE {_between('1997-01-05', '1997-03-12')}) / avg(v) FILTER (WHERE {_between('1996-08-01', '1996-11-05')})")} AS hit_1997
{_PER_SUPPLIER}""",
)
def a08(spark, sf):
    spans = {
        "hit_1996": (("1996-03-24", "1996-06-15"), ("1996-01-04", "1996-03-24")),
        "hit_1997": (("1997-01-05", "1997-03-12"), ("1996-08-01", "1996-11-05")),
    }
    out = agg.hit_ratios(supplier_week(spark, sf, _SPANNED), spans, **_C)
    return _per_supplier(spark, sf, out, spans)


@case(
    "a09_quantile_hit_ratio",
    f"""WITH {SUPPLIER_WEEK} SELECT s_suppkey AS key,
  {R(f"quantile_cont(v, 0.2) FILTER (WHERE {_between('1996-03-24', '1996-06-15')}) / avg(v) FILTER (WHERE {_between('1996-01-04', '1996-03-01')})")} AS hit
{_PER_SUPPLIER}""",
)
def a09(spark, sf):
    out = agg.quantile_hit_ratio(
        supplier_week(spark, sf, _SPANNED), ("1996-03-24", "1996-06-15"), ("1996-01-04", "1996-03-01"), **_C
    )
    return _per_supplier(spark, sf, out, ["hit"])


@case(
    "a10_span_mean_of_dense",
    f"""WITH {SUPPLIER_WEEK}, {dense_sql('sw')}, {complete_sql('dense')}
SELECT key, {R('avg(v)')} AS mean FROM whole WHERE {_between('1997-03-01', '1997-04-12')} GROUP BY key""",
)
def a10(spark, sf):
    from ..operators.series import extract_series

    series = extract_series(
        supplier_week(spark, sf), "1997-03-01", "1997-04-12", **_C, upper=None, unique=True
    )
    return series.groupBy("key").agg(tidy(F.avg("v")).alias("mean"))


@case("a11_class_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def a11(spark, sf):
    return agg.class_counts(table(spark, sf, "events"), "event_type")


@case(
    "a12_sum_by_day_area_kind",
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id, event_type, {R('sum(value)', 3)} AS value
FROM events GROUP BY 1, 2, 3""",
)
def a12(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy(text(F.col("ts").cast("date")).alias("day"), "user_id", "event_type")
        .agg(tidy(F.sum("value"), 3).alias("value"))
    )


@case(
    "a13_gradients",
    f"""WITH {USER_DAY} SELECT key,
  {R("regr_slope(v, date_diff('day', DATE '0001-01-01', t) + 1)", 5)} AS whole,
  {R(f"regr_slope(v, date_diff('day', DATE '0001-01-01', t) + 1) FILTER (WHERE {_between('2024-01-10', '2024-01-20')})", 5)} AS middle
FROM ud GROUP BY key""",
)
def a13(spark, sf):
    spans = {"whole": ("2024-01-01", "2024-12-31"), "middle": ("2024-01-10", "2024-01-20")}
    out = agg.gradients(user_day(spark, sf), spans, **_C)
    return out.select("key", *[tidy(c, 5).alias(c) for c in spans])


LINE_SPANS = {"a": (("1996-04-15", "1996-10-31"), "1996-04-01"), "b": (("1997-02-12", "1997-08-31"), "1997-04-12")}
LINES_SQL = " UNION ALL ".join(
    f"""SELECT key, '{n}' AS fit, regr_slope(v, date_diff('day', DATE '{t0}', t)) AS slope,
  regr_intercept(v, date_diff('day', DATE '{t0}', t)) AS intercept, count(v) AS n
FROM sw WHERE {_between(*s)} GROUP BY key"""
    for n, (s, t0) in LINE_SPANS.items()
)


def lines(spark, sf):
    return agg.fit_lines(supplier_week(spark, sf), LINE_SPANS, **_C)


@case(
    "a14_fit_lines",
    f"""WITH {SUPPLIER_WEEK}, f AS ({LINES_SQL}),
k AS (SELECT DISTINCT key, fit FROM sw, (VALUES ('a'), ('b')) x(fit))
SELECT k.key, k.fit, {R('slope')} AS slope, {R('intercept', 2)} AS intercept, coalesce(n, 0) AS n
FROM k LEFT JOIN f ON k.key = f.key AND k.fit = f.fit""",
)
def a14(spark, sf):
    return lines(spark, sf).select(
        "key", "fit", tidy("slope").alias("slope"), tidy("intercept", 2).alias("intercept"), "n"
    )


@case(
    "a15_line_values",
    f"""WITH {SUPPLIER_WEEK}, f AS ({LINES_SQL})
SELECT sw.key, CAST(t AS VARCHAR) AS t, {R("intercept + slope * date_diff('day', DATE '1996-04-01', t)", 2)} AS fitted
FROM sw LEFT JOIN (SELECT * FROM f WHERE fit = 'a') f ON sw.key = f.key""",
)
def a15(spark, sf):
    one = lines(spark, sf).where(F.col("fit") == "a")
    out = agg.line_values(supplier_week(spark, sf), one, "1996-04-01", key="key", time="t")
    return out.select("key", text("t").alias("t"), tidy("fitted", 2).alias("fitted"))


@case(
    "a16_yearly_slope",
    f"""WITH {SUPPLIER_WEEK}, f AS ({LINES_SQL})
SELECT key, {R('365 * slope', 2)} AS per_year FROM f WHERE fit = 'a'""",
)
def a16(spark, sf):
    out = lines(spark, sf).where((F.col("fit") == "a") & (F.col("n") > 0))
    return out.select("key", tidy(365 * F.col("slope"), 2).alias("per_year"))


_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@case(
    "a18_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {R(f'corr({a}, {b})', 6)} AS r FROM lineitem"
        for i, a in enumerate(_FEATURES)
        for b in _FEATURES[i:]
    ),
)
def a18(spark, sf):
    out = agg.correlations(table(spark, sf, "lineitem"), _FEATURES)
    return out.select("a", "b", tidy("r", 6).alias("r"))


def _histogram_sql(source: str, columns) -> str:
    parts = []
    for c in columns:
        parts.append(f"""SELECT '{c}' AS feature, CAST(r.i AS INT) AS bin,
  {R('lo + (hi - lo) / 10 * r.i')} AS low, {R('lo + (hi - lo) / 10 * (r.i + 1)')} AS high, count(x.b) AS n
FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM {source}) e CROSS JOIN range(10) r(i)
LEFT JOIN (SELECT least(floor((CAST({c} AS DOUBLE) - lo) * 10 / (hi - lo)), 9) AS b
  FROM {source}, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {source})) x ON x.b = r.i
GROUP BY r.i, lo, hi""")
    return " UNION ALL ".join(parts)


@case("a19_histograms", _histogram_sql("part", ["p_size", "p_retailprice"]))
def a19(spark, sf):
    out = agg.histograms(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    return out.select("feature", "bin", tidy("low").alias("low"), tidy("high").alias("high"), "n")


@case(
    "a24_contingency",
    "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def a24(spark, sf):
    return agg.contingency(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
