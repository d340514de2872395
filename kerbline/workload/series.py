"""Series operators and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reshape
from ..operators import series as ops
from ..operators.joins import index_encode
from ..operators.ranking import rank_rows
from .base import (
    NATION_MONTH,
    R,
    SUPPLIER_WEEK,
    USER_DAY,
    case,
    complete_sql,
    dense_sql,
    long,
    nation_month,
    supplier_week,
    table,
    text,
    tidy,
    user_day,
)

_C = dict(key="key", time="t", value="v")


@case(
    "w01_densify_interpolate",
    f"""WITH {SUPPLIER_WEEK}, {dense_sql('sw')}
SELECT key, CAST(t AS VARCHAR) AS t, pos, {R('v')} AS v, is_filled FROM dense""",
)
def w01(spark, sf):
    out = ops.densify(supplier_week(spark, sf), **_C, unique=True)
    return out.select(
        "key", text("t").alias("t"), long("pos").alias("pos"), tidy("v").alias("v"),
        F.col("is_filled").cast("int").alias("is_filled"),
    )


@case(
    "w01_densify_user_days",
    f"""WITH {USER_DAY}, {dense_sql('ud')}
SELECT key, CAST(t AS VARCHAR) AS t, pos, {R('v')} AS v, is_filled FROM dense""",
)
def w01b(spark, sf):
    out = ops.densify(user_day(spark, sf), **_C)
    return out.select(
        "key", text("t").alias("t"), long("pos").alias("pos"), tidy("v").alias("v"),
        F.col("is_filled").cast("int").alias("is_filled"),
    )


@case(
    "w02_drop_incomplete",
    f"""WITH {USER_DAY}, {dense_sql('ud')}, {complete_sql('dense')}
SELECT key, count(*) AS n, {R('sum(v)', 3)} AS total FROM whole GROUP BY key""",
)
def w02(spark, sf):
    full = ops.densify(user_day(spark, sf), **_C, unique=True)
    kept = ops.drop_incomplete(full, key="key", value="v")
    return kept.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), tidy(F.sum("v"), 3).alias("total")
    )


@case(
    "w03_extract_series",
    f"""WITH {SUPPLIER_WEEK}, {dense_sql('sw')}, {complete_sql('dense')}
SELECT key, CAST(t AS VARCHAR) AS t, {R('CASE WHEN v > 60000 THEN 60000 ELSE v END')} AS v
FROM whole WHERE t BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
)
def w03(spark, sf):
    out = ops.extract_series(
        supplier_week(spark, sf), "1996-01-01", "1998-12-31", **_C, upper=60000.0, unique=True
    )
    return out.select("key", text("t").alias("t"), tidy("v").alias("v"))


@case(
    "w04_duplicate_periods",
    """SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS n_rows
FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
)
def w04(spark, sf):
    out = ops.duplicate_periods(table(spark, sf, "orders"), key="o_custkey", time="o_orderdate")
    return out.select("o_custkey", text("o_orderdate").alias("day"), "n_rows")


@case(
    "w13_sort_rows",
    f"""WITH {NATION_MONTH}
SELECT key, CAST(t AS VARCHAR) AS t, {R('v')} AS v,
       row_number() OVER (ORDER BY t, key) - 1 AS place FROM nm""",
)
def w13(spark, sf):
    ranked = rank_rows(nation_month(spark, sf), ["t", "key"], rank="place")
    return ranked.df.select("key", text("t").alias("t"), tidy("v").alias("v"), "place")


@case(
    "w14_rank_by_value",
    """SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS place
FROM customer""",
)
def w14(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return rank_rows(rows, ["c_acctbal", "c_custkey"], rank="place").df.drop("c_acctbal")


@case(
    "w15_index_encode",
    """SELECT c_custkey, c_mktsegment, d.code FROM customer c JOIN (
  SELECT s, row_number() OVER (ORDER BY s) - 1 AS code
  FROM (SELECT DISTINCT c_mktsegment AS s FROM customer)) d ON c.c_mktsegment = d.s""",
)
def w15(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return index_encode(rows, "c_mktsegment")


# ---- reshape ------------------------------------------------------------------------

_HALVES = {
    "yoy_txn_amt_we_retail": ("O", "l_extendedprice"),
    "yoy_txn_amt_wd_retail": ("F", "l_extendedprice"),
    "yoy_txn_cnt_we_retail": ("O", "l_quantity"),
    "yoy_txn_cnt_wd_retail": ("F", "l_quantity"),
}
WEEKLY_SQL = """wk AS (
  SELECT l_suppkey AS area_id, 'area ' || CAST(l_suppkey AS VARCHAR) AS area_name,
    CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start,
    avg(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END) AS yoy_txn_amt_we_retail,
    avg(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END) AS yoy_txn_amt_wd_retail,
    avg(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS yoy_txn_cnt_we_retail,
    avg(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS yoy_txn_cnt_wd_retail
  FROM lineitem GROUP BY 1, 2, 3)"""


def weekly(spark, sf):
    """Supplier weeks in the layout of the weekly spend table."""
    week = F.date_trunc("week", "l_shipdate").cast("date")
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("area_id"), week.alias("week_start"))
        .agg(
            *[
                F.avg(F.when(F.col("l_linestatus") == s, F.col(c))).alias(n)
                for n, (s, c) in _HALVES.items()
            ]
        )
        .withColumn("area_name", F.concat(F.lit("area "), F.col("area_id").cast("string")))
    )


@case(
    "u02_stack_day_kinds",
    f"""WITH {WEEKLY_SQL}
SELECT area_id, area_name, CAST(CAST(week_start + INTERVAL 5 DAY AS DATE) AS VARCHAR) AS period_start,
  {R('yoy_txn_amt_we_retail')} AS txn_amt, {R('yoy_txn_cnt_we_retail')} AS txn_cnt, 'we' AS we_wd FROM wk
UNION ALL
SELECT area_id, area_name, CAST(week_start AS VARCHAR),
  {R('yoy_txn_amt_wd_retail')}, {R('yoy_txn_cnt_wd_retail')}, 'wd' FROM wk""",
)
def u02(spark, sf):
    out = reshape.stack_day_kinds(
        weekly(spark, sf), key="area_id", name="area_name", prefix="yoy_"
    )
    return out.select(
        "area_id", "area_name", text("period_start").alias("period_start"),
        tidy("txn_amt").alias("txn_amt"), tidy("txn_cnt").alias("txn_cnt"), "we_wd",
    )


@case(
    "a04_average_day_kinds",
    f"""WITH {WEEKLY_SQL}
SELECT area_id, area_name, CAST(week_start AS VARCHAR) AS period_start,
  {R('''(coalesce(yoy_txn_amt_we_retail, 0) + coalesce(yoy_txn_amt_wd_retail, 0)) / nullif(
    (yoy_txn_amt_we_retail IS NOT NULL)::INT + (yoy_txn_amt_wd_retail IS NOT NULL)::INT, 0)''')} AS txn_amt,
  {R('''(coalesce(yoy_txn_cnt_we_retail, 0) + coalesce(yoy_txn_cnt_wd_retail, 0)) / nullif(
    (yoy_txn_cnt_we_retail IS NOT NULL)::INT + (yoy_txn_cnt_wd_retail IS NOT NULL)::INT, 0)''')} AS txn_cnt
FROM wk""",
)
def a04(spark, sf):
    from ..operators.projection import average_day_kinds

    out = average_day_kinds(weekly(spark, sf), keep=["area_id", "area_name"], prefix="yoy_")
    return out.select(
        "area_id", "area_name", text("period_start").alias("period_start"),
        tidy("txn_amt").alias("txn_amt"), tidy("txn_cnt").alias("txn_cnt"),
    )


@case(
    "u01_union_yearly",
    """SELECT year, count(*) AS n, count(status) AS n_status, min(k) AS lo, max(k) AS hi FROM (
  SELECT o_orderkey AS k, o_orderstatus AS status, 'orders' AS year FROM orders
  UNION ALL SELECT l_orderkey, NULL, 'lines' FROM lineitem) GROUP BY year""",
)
def u01(spark, sf):
    a = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"),
        F.lit("orders").alias("year"),
    )
    b = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.lit("lines").alias("year"))
    return reshape.union_all([a, b]).groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.count("status").alias("n_status"),
        F.min("k").alias("lo"), F.max("k").alias("hi"),
    )


@case(
    "u04_long_to_wide",
    f"""SELECT user_id, {', '.join(
        R(f"avg(CASE WHEN event_type = '{e}' THEN value END)") + f" AS v_{e}"
        for e in ('click', 'error', 'purchase', 'signup', 'view'))}
FROM events GROUP BY user_id""",
)
def u04(spark, sf):
    kinds = ["click", "error", "purchase", "signup", "view"]
    means = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.avg("value").alias("v"))
    wide = reshape.widen(
        means, index="user_id", columns="event_type", value="v", categories=kinds, prefix="v_"
    )
    return wide.select("user_id", *[tidy(f"v_{k}").alias(f"v_{k}") for k in kinds])


@case(
    "u06_one_hot",
    f"""SELECT c_custkey, {', '.join(
        f"coalesce((nullif(c_mktsegment, 'HOUSEHOLD') = '{s}')::INT, 0) AS seg_{s}"
        for s in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY'))} FROM customer""",
)
def u06(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("seg")
    )
    return reshape.one_hot(rows, "seg", ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"])
