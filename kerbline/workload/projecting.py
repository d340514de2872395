"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import projection as ops
from .base import R, case, table, text, tidy


@case("p01_column_subset", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def p01(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@case(
    "p02_rename",
    'SELECT c_custkey AS "area id", c_name AS "area name", c_acctbal AS "pct (%)" FROM customer',
)
def p02(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return rows.withColumnsRenamed(
        {"c_custkey": "area id", "c_name": "area name", "c_acctbal": "pct (%)"}
    )


@case("p03_drop_columns", "SELECT p_partkey, p_size, p_retailprice FROM part")
def p03(spark, sf):
    return table(spark, sf, "part").drop("p_name", "p_brand", "p_type", "no such column")


@case(
    "p04_select_by_pattern",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate::DATE::VARCHAR AS day FROM lineitem",
)
def p04(spark, sf):
    rows = ops.select_like(
        table(spark, sf, "lineitem"), "status|flag|shipdate", keep=["l_orderkey", "l_linenumber"]
    )
    return rows.withColumn("day", text(F.col("l_shipdate").cast("date"))).drop("l_shipdate")


@case(
    "p05_ratio_columns",
    f"""SELECT p_partkey, {R('p_retailprice / nullif(p_size, 0)')} AS "pct size",
  {R('p_size / nullif(p_retailprice - 900, 0)')} AS "pct over" FROM part""",
)
def p05(spark, sf):
    rows = table(spark, sf, "part").withColumn("over", F.col("p_retailprice") - 900)
    out = ops.add_ratios(rows, {"pct size": ("p_retailprice", "p_size"), "pct over": ("p_size", "over")})
    return out.select(
        "p_partkey", tidy("`pct size`").alias("pct size"), tidy("`pct over`").alias("pct over")
    )


@case(
    "p06_log_columns",
    f"""SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN {R('ln(CASE WHEN c_acctbal > 0 THEN c_acctbal END)', 6)} END
  AS "log_c_acctbal" FROM customer""",
)
def p06(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return ops.log_columns(rows, ["c_acctbal"]).select(
        "c_custkey", tidy("log_c_acctbal", 6).alias("log_c_acctbal")
    )


@case(
    "p07_upper_cap",
    """SELECT event_id, CASE WHEN v > 20 THEN 20.0 ELSE v END AS v FROM (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)""",
)
def p07(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v")
    )
    return ops.cap_columns(rows, ["v"], 20.0)


@case(
    "p08_equality_filter",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'",
)
def p08(spark, sf):
    rows = table(spark, sf, "events").where(F.col("event_type") == "purchase")
    return rows.select("event_id", "user_id", "value")


@case(
    "p09_months_filter",
    """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1998-03-01'""",
)
def p09(spark, sf):
    rows = ops.in_months(table(spark, sf, "orders"), "1997-03", "1998-03", time="o_orderdate")
    return rows.select("o_orderkey", "o_totalprice")


@case(
    "p09_semi_join_filter",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
  SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE'))""",
)
def p09b(spark, sf):
    wanted = ops.in_list(table(spark, sf, "customer"), "c_mktsegment", ["BUILDING", "FURNITURE"])
    wanted = wanted.withColumnRenamed("c_custkey", "o_custkey")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return ops.in_table(rows, wanted, "o_custkey").select("o_orderkey", "o_custkey")


@case(
    "p10_null_filter",
    "SELECT p_partkey, p_name FROM part WHERE nullif(p_type, 'ECONOMY') IS NOT NULL",
)
def p10(spark, sf):
    rows = table(spark, sf, "part").withColumn("k", F.nullif(F.col("p_type"), F.lit("ECONOMY")))
    return rows.where(F.col("k").isNotNull()).select("p_partkey", "p_name")


@case(
    "p11_complete_rows",
    f"""SELECT c_custkey, {R('ln(c_acctbal)', 6)} AS log_bal FROM customer
WHERE c_acctbal > 0 AND c_mktsegment <> 'MACHINERY'""",
)
def p11(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", tidy(fn.safe_log("c_acctbal"), 6).alias("log_bal"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("seg"),
    )
    return ops.complete_rows(rows).select("c_custkey", "log_bal")


@case(
    "p12_date_slice",
    """SELECT event_id, user_id FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'""",
)
def p12(spark, sf):
    from ..operators.series import slice_period

    return slice_period(table(spark, sf, "events"), "2024-01-05", "2024-01-11", time="ts").select(
        "event_id", "user_id"
    )


@case(
    "p13_one_group",
    """WITH g AS (SELECT o_custkey, ntile(4) OVER (ORDER BY m, o_custkey) - 1 AS grp FROM (
  SELECT o_custkey, max(o_totalprice) AS m FROM orders GROUP BY 1))
SELECT o_custkey FROM g WHERE grp = 0""",
)
def p13(spark, sf):
    from ..operators.ranking import add_tile

    top = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_totalprice").alias("m"))
    tiles = add_tile(top, "m", 4, key="o_custkey", out="grp")
    return tiles.where(F.col("grp") == 0).select("o_custkey")


@case("p14_distinct_values", "SELECT DISTINCT p_brand, p_type FROM part")
def p14(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_type").distinct()


@case("p15_columns_except", "SELECT s_suppkey, s_nationkey FROM supplier")
def p15(spark, sf):
    rows = table(spark, sf, "supplier")
    return rows.select(*ops.columns_except(rows, ["s_name", "s_acctbal"]))


# ---- scalar functions ---------------------------------------------------------------


@case(
    "f01_hour_of_band",
    """SELECT event_id, CAST(strftime(ts, '%H') AS INT) AS hour FROM events""",
)
def f01(spark, sf):
    band = F.concat(F.date_format("ts", "HH"), F.lit("-"), F.lit("24"))
    return table(spark, sf, "events").select("event_id", fn.hour_of_band(band).alias("hour"))


@case(
    "f02_starts_with",
    "SELECT page_id, (CASE WHEN starts_with(url, 'https') THEN 1 ELSE 0 END) AS secure FROM pages",
)
def f02(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.col("url").startswith("https").cast("int").alias("secure")
    )


@case(
    "f03_file_name_and_folder_date",
    """SELECT o_orderkey, 'orders_' || o_orderstatus || '.csv' AS file_name,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS file_date FROM orders""",
)
def f03(spark, sf):
    path = F.concat(
        F.lit("/x/received/drop"), F.date_format("o_orderdate", "dd_MM_yyyy"),
        F.lit("/files/orders_"), F.col("o_orderstatus"), F.lit(".csv"),
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.file_name_of(path).alias("file_name"),
        text(fn.folder_date(path)).alias("file_date"),
    )


@case(
    "f04_unmask",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN NULL ELSE l_quantity END AS q FROM lineitem""",
)
def f04(spark, sf):
    raw = F.when(F.col("l_quantity") < 10, F.lit("IDE")).otherwise(F.col("l_quantity").cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", fn.unmask(raw).alias("q"))


@case(
    "f05_repair_name",
    """SELECT doc_id, md5(regexp_replace(text, '[^\\x00-\\x7f]', '''', 'g')) AS h FROM documents""",
)
def f05(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(fn.repair_name("text")).alias("h"))


@case(
    "f06_parse_date",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders",
)
def f06(spark, sf):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select("o_orderkey", text(F.to_date(stamp)).alias("day"))


@case(
    "f07_month_of",
    "SELECT event_id, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month FROM events",
)
def f07(spark, sf):
    return table(spark, sf, "events").select("event_id", text(fn.month_of("ts")).alias("month"))


@case(
    "f08_ordinal_day",
    """SELECT o_orderkey, CAST(date_diff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE)) + 1 AS INT) AS ordinal
FROM orders""",
)
def f08(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.ordinal_day(F.col("o_orderdate").cast("date")).alias("ordinal")
    )


@case(
    "f09_days_since",
    """SELECT l_orderkey, l_linenumber,
  CAST(date_diff('day', DATE '1998-01-01', CAST(l_shipdate AS DATE)) AS INT) AS days FROM lineitem""",
)
def f09(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.days_since("l_shipdate", "1998-01-01").alias("days")
    )


@case(
    "f10_weeks_since",
    f"""SELECT event_id, {R("date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7.0", 6)} AS weeks FROM events""",
)
def f10(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", tidy(fn.weeks_since("ts", "2024-01-01"), 6).alias("weeks")
    )


@case(
    "f11_shift_days",
    "SELECT o_orderkey, CAST(CAST(o_orderdate + INTERVAL 5 DAY AS DATE) AS VARCHAR) AS day FROM orders",
)
def f11(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", text(F.date_add(F.col("o_orderdate").cast("date"), 5)).alias("day")
    )


@case(
    "f12_month_span",
    """WITH m AS (SELECT CAST(unnest(generate_series(DATE '1997-03-01', DATE '1998-03-01', INTERVAL 1 MONTH)) AS DATE) AS m)
SELECT CAST(m AS VARCHAR) AS month, count(o_orderkey) AS n FROM m
LEFT JOIN orders ON CAST(date_trunc('month', o_orderdate) AS DATE) = m
WHERE m + INTERVAL 1 MONTH - INTERVAL 1 DAY <= DATE '1998-03-01' GROUP BY 1""",
)
def f12(spark, sf):
    months = spark.range(1).select(F.explode(fn.month_span("1997-03-01", "1998-03-01")).alias("m"))
    counts = (
        table(spark, sf, "orders")
        .groupBy(fn.month_of("o_orderdate").alias("m"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return months.join(counts, "m", "left").select(
        text("m").alias("month"), F.coalesce("n", F.lit(0)).alias("n")
    )


@case(
    "f13_day_span",
    """WITH d AS (SELECT CAST(unnest(generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS d)
SELECT CAST(d AS VARCHAR) AS day, count(event_id) AS n FROM d LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY 1""",
)
def f13(spark, sf):
    days = spark.range(1).select(F.explode(fn.day_span("2023-12-30", "2024-02-02")).alias("d"))
    counts = (
        table(spark, sf, "events")
        .groupBy(F.col("ts").cast("date").alias("d"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return days.join(counts, "d", "left").select(
        text("d").alias("day"), F.coalesce("n", F.lit(0)).alias("n")
    )


@case(
    "f14_natural_log",
    f"""SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN {R('ln(CASE WHEN s_acctbal > 0 THEN s_acctbal END)', 6)} END AS l
FROM supplier""",
)
def f14(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", tidy(fn.safe_log("s_acctbal"), 6).alias("l"))


@case(
    "f15_safe_division",
    f"""SELECT l_orderkey, l_linenumber, {R('l_tax / nullif(l_discount, 0)', 6)} AS r FROM lineitem""",
)
def f15(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", tidy(fn.ratio("l_tax", "l_discount"), 6).alias("r")
    )


@case(
    "f16_sqrt_and_round",
    f"""SELECT p_partkey, {R('sqrt(p_retailprice)', 3)} AS root FROM part""",
)
def f16(spark, sf):
    return table(spark, sf, "part").select("p_partkey", tidy(F.sqrt("p_retailprice"), 3).alias("root"))
