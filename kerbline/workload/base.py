"""Registry, table access and result formatting shared by the registered queries."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Averages of prices in cents often end exactly on a decimal tie (...5), which engines
# round either way. Both sides add this before rounding, so such values leave the tie.
_OFF_TIE = 1.234e-7


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Case] = {}


def case(name: str, sql: str | None = None):
    def add(run):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Case(run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(c: Column | str, places: int = 4) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double") + F.lit(_OFF_TIE), places) + F.lit(0.0)


def R(expr: str, places: int = 4) -> str:
    return f"(round(CAST(({expr}) AS DOUBLE) + {_OFF_TIE!r}, {places}) + 0.0)"


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


# ---- the three series the queries run on ---------------------------------------------

NATION_MONTH = """nm AS (
  SELECT c.c_nationkey AS key, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS t,
         avg(o.o_totalprice) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)"""
SUPPLIER_WEEK = """sw AS (
  SELECT l_suppkey AS key, CAST(date_trunc('week', l_shipdate) AS DATE) AS t,
         avg(l_extendedprice) AS v
  FROM lineitem GROUP BY 1, 2)"""
USER_DAY = """ud AS (
  SELECT user_id AS key, CAST(ts AS DATE) AS t, avg(value) AS v FROM events GROUP BY 1, 2)"""


def nation_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order price by nation and month; orders shrink per customer before the join."""
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("t"))
        .agg(F.sum("o_totalprice").alias("s"), F.count("o_totalprice").alias("n"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        per_customer.join(customers, per_customer.o_custkey == customers.c_custkey)
        .groupBy(F.col("c_nationkey").alias("key"), "t")
        .agg((F.sum("s") / F.sum("n")).alias("v"))
    )


def supplier_week(
    spark: SparkSession, sf_dir: str, span: tuple[str, str] | None = None
) -> DataFrame:
    """Mean line price by supplier and week; with a ``span`` only of its weeks.

    The span is stated on the raw column, widened to whole weeks, so that it reaches the scan.
    """
    week = F.date_trunc("week", "l_shipdate").cast("date")
    lines = table(spark, sf_dir, "lineitem")
    if span:
        first, last = (datetime.date.fromisoformat(d) for d in span)
        first -= datetime.timedelta(days=first.weekday())
        last += datetime.timedelta(days=6 - last.weekday())
        kind = lines.schema["l_shipdate"].dataType
        after = last + datetime.timedelta(days=1)
        lines = lines.where(
            (F.col("l_shipdate") >= F.lit(str(first)).cast(kind))
            & (F.col("l_shipdate") < F.lit(str(after)).cast(kind))
        )
    return (
        lines
        .groupBy(F.col("l_suppkey").alias("key"), week.alias("t"))
        .agg(F.avg("l_extendedprice").alias("v"))
    )


def user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("key"), F.col("ts").cast("date").alias("t"))
        .agg(F.avg("value").alias("v"))
    )


def dense_sql(source: str, out: str = "dense") -> str:
    """CTEs that densify and interpolate ``source`` (key, t, v) the textbook way."""
    back = "OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = "OVER (PARTITION BY key ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""{out}_days AS (
  SELECT t, row_number() OVER (ORDER BY t) - 1 AS pos FROM (SELECT DISTINCT t FROM {source})),
{out}_grid AS (
  SELECT k.key, d.t, d.pos, x.v
  FROM (SELECT DISTINCT key FROM {source}) k CROSS JOIN {out}_days d
  LEFT JOIN {source} x ON x.key = k.key AND x.t = d.t),
{out}_near AS (
  SELECT key, t, pos, v,
    last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) {back} AS p0,
    last_value(v IGNORE NULLS) {back} AS v0,
    first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) {ahead} AS p1,
    first_value(v IGNORE NULLS) {ahead} AS v1
  FROM {out}_grid),
{out} AS (
  SELECT key, t, pos,
    CASE WHEN v IS NOT NULL THEN v WHEN p0 IS NULL THEN NULL WHEN p1 IS NULL THEN v0
         ELSE v0 + (v1 - v0) * (pos - p0) / (p1 - p0) END AS v,
    CASE WHEN v IS NULL AND p0 IS NOT NULL THEN 1 ELSE 0 END AS is_filled
  FROM {out}_near)"""


def complete_sql(dense: str, out: str = "whole") -> str:
    return f"""{out} AS (
  SELECT * FROM {dense} WHERE key NOT IN (SELECT key FROM {dense} WHERE v IS NULL))"""
