"""File routing, cleaning, checks and the idempotent load, on drops derived from lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import staging_path
from ..sources import drops, feeds, inputs
from ..sources.tables import read_csv, write_csv
from ..streaming.folder import land_stream
from .base import R, case, table, text, tidy

# which feed a line belongs to, by its two flags
_ROUTES = {
    ("A", "O"): "hex_daily",
    ("A", "F"): "hex_monthly",
    ("N", "O"): "lsoa_daily",
    ("N", "F"): "lsoa_monthly",
    ("R", "O"): "msoa_daily",
    ("R", "F"): "msoa_monthly",
}
_FLAGS = {route: flags for flags, route in _ROUTES.items()}


def _is(flags):
    return (F.col("l_returnflag") == flags[0]) & (F.col("l_linestatus") == flags[1])


def _is_sql(flags) -> str:
    return f"l_returnflag = '{flags[0]}' AND l_linestatus = '{flags[1]}'"


def stamped_lines(spark, sf):
    return with_path(table(spark, sf, "lineitem"))


def with_path(lines):
    """Line items with the path of the drop file they would arrive in: one per month and feed."""
    prefix = F.coalesce(
        *[F.when(_is(fl), F.lit(feeds.FEEDS[r].prefix)) for fl, r in _ROUTES.items()]
    )
    folder = F.date_format(F.trunc("l_shipdate", "month"), "dd_MM_yyyy")
    path = F.concat(
        F.lit("/data/received/drop_"), folder, F.lit("/files/"), prefix, F.lit("_"),
        F.date_format("l_shipdate", "yyyyMM"), F.lit(".csv"),
    )
    return lines.withColumn("path", path)


_PREFIX_SQL = "CASE " + " ".join(
    f"WHEN {_is_sql(fl)} THEN '{feeds.FEEDS[r].prefix}'" for fl, r in _ROUTES.items()
) + " END"
_NAME_SQL = f"({_PREFIX_SQL} || '_' || strftime(l_shipdate, '%Y%m') || '.csv')"
_ROUTE_SQL = "CASE " + " ".join(
    f"WHEN {_is_sql(fl)} THEN '{r}'" for fl, r in _ROUTES.items()
) + " END"


def raw_feed(spark, sf, route: str):
    return feed_text(table(spark, sf, "lineitem"), route)


def feed_text(lines, route: str):
    """The rows of one feed as text, as they stand in its files."""
    spec = feeds.FEEDS[route].spec
    text_of = {
        # suppressed below 5, otherwise the number as text
        "scaled_volume": F.when(F.col("l_quantity") < 5, F.lit("IDE")).otherwise(
            F.col("l_quantity").cast("string")
        ),
        "loyalty_percentage": F.col("l_discount").cast("string"),
        # missing, or no number, otherwise the number as text
        "dwell_time": F.when(F.col("l_tax") == 0.08, F.lit("n/a"))
        .when(F.col("l_tax") == 0.07, F.lit("long"))
        .otherwise(F.col("l_tax").cast("string")),
        "worker_population_percentage": F.col("l_extendedprice").cast("string"),
        "resident_population_percentage": F.lit("IDE"),
        "hex_grid_id": F.col("l_suppkey").cast("string"),
        "lsoa_id": F.concat(F.lit("E"), F.col("l_suppkey").cast("string")),
        "msoa_id": F.nullif(F.concat(F.lit("E"), F.col("l_suppkey").cast("string")), F.lit("E1")),
        "date": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "month": F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd"),
        "day_name": F.when(F.col("l_linenumber") == 7, F.lit("Someday")).otherwise(
            F.date_format("l_shipdate", "EEEE")
        ),
        "time_indicator": (
            F.concat((F.col("l_linenumber") + 18).cast("string"), F.lit("-24"))
            if "hex" in route
            else F.element_at(
                F.array(*[F.lit(v) for v in [*feeds.TIMES_OF_DAY, "Noonish", "Noon", "Night"]]),
                F.col("l_linenumber"),
            )
        ),
    }
    rows = drops.stamp(with_path(lines.where(_is(_FLAGS[route]))), "path")
    return rows.select(
        "l_orderkey", "l_linenumber", "file_date", "file_name",
        *[text_of[c].alias(c) for c in spec if c not in ("file_date", "file_name")],
    )


def _typed_sql(route: str) -> tuple[dict[str, str], dict[str, str]]:
    """Typed expressions and rule conditions of a feed, written out by hand for SQL."""
    value = {
        "scaled_volume": "CASE WHEN l_quantity < 5 THEN NULL ELSE l_quantity END",
        "loyalty_percentage": "l_discount",
        "dwell_time": "CASE WHEN l_tax IN (0.07, 0.08) THEN NULL ELSE l_tax END",
        "worker_population_percentage": "l_extendedprice",
        "resident_population_percentage": "CAST(NULL AS DOUBLE)",
        "hex_grid_id": "l_suppkey",
        "lsoa_id": "'E' || l_suppkey::VARCHAR",
        "msoa_id": "nullif('E' || l_suppkey::VARCHAR, 'E1')",
        "date": "CAST(CAST(l_shipdate AS DATE) AS VARCHAR)",
        "month": "CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR)",
        "day_name": "CASE WHEN l_linenumber = 7 THEN 'Someday' ELSE strftime(l_shipdate, '%A') END",
        "time_indicator": (
            "l_linenumber + 18"
            if "hex" in route
            else "CASE l_linenumber WHEN 1 THEN 'Morning' WHEN 2 THEN 'Noon' WHEN 3 THEN 'Evening'"
            " WHEN 4 THEN 'Night' WHEN 5 THEN 'Noonish' WHEN 6 THEN 'Noon' ELSE 'Night' END"
        ),
    }
    broken = {
        "loyalty_percentage:positive": "l_discount <= 0",
        "dwell_time:type": "l_tax = 0.07",
        "dwell_time:positive": "l_tax <= 0",
    }
    spec = feeds.FEEDS[route].spec
    if "day_name" in spec:
        broken["day_name:one_of"] = "l_linenumber = 7"
    if "hex" in route:
        broken["time_indicator:between"] = "l_linenumber + 18 > 23"
    else:
        broken["time_indicator:one_of"] = "l_linenumber = 5"
    if "msoa_id" in spec:
        broken["msoa_id:not_null"] = "l_suppkey = 1"
    return value, broken


def _clean_sql(route: str) -> str:
    value, broken = _typed_sql(route)
    columns = [c for c in feeds.FEEDS[route].spec if c not in ("file_date", "file_name")]
    shown = ", ".join(f"{value[c]} AS {c}" for c in columns)
    fine = " AND ".join(f"NOT coalesce({cond}, FALSE)" for cond in broken.values())
    return f"""SELECT l_orderkey, l_linenumber,
  CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS file_date, {_NAME_SQL} AS file_name, {shown}
FROM lineitem WHERE {_is_sql(_FLAGS[route])} AND {fine}"""


def _shown(df, route: str):
    dates = [c for c, f in feeds.FEEDS[route].spec.items() if f.type == "date"]
    return df.withColumns({c: text(c) for c in dates})


def _add_clean(number: int, route: str) -> None:
    @case(f"c{number:02d}_clean_{route}", _clean_sql(route))
    def run(spark, sf):
        return _shown(feeds.clean_feed(raw_feed(spark, sf, route), route, mode="drop"), route)


def _add_report(route: str) -> None:
    _, broken = _typed_sql(route)
    every = feeds.rule_names(feeds.FEEDS[route].spec)
    counts = " UNION ALL ".join(
        f"SELECT '{r}' AS rule, count(*) AS n FROM lineitem WHERE {_is_sql(_FLAGS[route])} AND "
        + broken.get(r, "FALSE")
        for r in every
    )

    @case(f"v08_violation_report_{route}", counts)
    def run(spark, sf):
        return feeds.violation_report(raw_feed(spark, sf, route), feeds.FEEDS[route].spec)


for _number, _route in enumerate(feeds.FEEDS, start=7):
    _add_clean(_number, _route)
    _add_report(_route)


@case(
    "v08_quarantine",
    "SELECT l_orderkey, l_linenumber, concat_ws(',', "
    + ", ".join(
        f"CASE WHEN {cond} THEN '{r}' END" for r, cond in _typed_sql("msoa_monthly")[1].items()
    )
    + ") AS broken FROM lineitem WHERE "
    + f"{_is_sql(_FLAGS['msoa_monthly'])} AND ("
    + " OR ".join(_typed_sql("msoa_monthly")[1].values())
    + ")",
)
def v08_quarantine(spark, sf):
    bad = feeds.quarantine(raw_feed(spark, sf, "msoa_monthly"), feeds.FEEDS["msoa_monthly"].spec)
    order = ["loyalty_percentage:positive", "dwell_time:type", "dwell_time:positive",
             "day_name:one_of", "time_indicator:one_of", "msoa_id:not_null"]
    named = F.array_join(
        F.filter(F.array(*[F.lit(r) for r in order]), lambda r: F.array_contains("violations", r)), ","
    )
    return bad.select("l_orderkey", "l_linenumber", named.alias("broken"))


def _one_rule(name: str, sql: str, field: feeds.Field, column: str, source: str, key: str, raw=None):
    @case(name, sql)
    def run(spark, sf):
        rows = table(spark, sf, source).select(
            key, (F.col(column) if raw is None else raw()).alias(column)
        )
        checked = feeds.check(rows, {column: field})
        return checked.where(F.size("violations") > 0).select(
            key, F.col("violations")[0].alias("rule")
        )


_one_rule(
    "v02_type_check",
    "SELECT l_orderkey, 'l_linestatus:type' AS rule FROM lineitem WHERE l_linestatus = 'O'",
    feeds.Field("double", nullable=True), "l_linestatus", "lineitem", "l_orderkey",
    lambda: F.when(F.col("l_linestatus") == "O", F.lit("zero")).otherwise(F.lit("1.5")),
)
_one_rule(
    "v03_not_null",
    "SELECT p_partkey, 'p_type:not_null' AS rule FROM part WHERE p_type = 'ECONOMY'",
    feeds.Field("string"), "p_type", "part", "p_partkey",
    lambda: F.nullif(F.col("p_type"), F.lit("ECONOMY")),
)
_one_rule(
    "v04_positive",
    "SELECT c_custkey, 'c_acctbal:positive' AS rule FROM customer WHERE c_acctbal <= 0",
    feeds.Field("double", nullable=True, read="measure", positive=True), "c_acctbal", "customer",
    "c_custkey",
)
_one_rule(
    "v05_membership",
    "SELECT doc_id, 'lang:one_of' AS rule FROM documents WHERE lang NOT IN ('en', 'fr')",
    feeds.Field("string", one_of=("en", "fr")), "lang", "documents", "doc_id",
)
_one_rule(
    "v06_closed_range",
    "SELECT p_partkey, 'p_size:between' AS rule FROM part WHERE p_size NOT BETWEEN 5 AND 40",
    feeds.Field("int", between=(5, 40)), "p_size", "part", "p_partkey",
)


# ---- files --------------------------------------------------------------------------


@case(
    "s03_file_date",
    f"""SELECT {_NAME_SQL} AS file_name, CAST(CAST(date_trunc('month', min(l_shipdate)) AS DATE) AS VARCHAR) AS file_date,
  count(*) AS n FROM lineitem GROUP BY 1""",
)
def s03(spark, sf):
    rows = drops.stamp(stamped_lines(spark, sf), "path")
    return rows.groupBy("file_name", text("file_date").alias("file_date")).agg(
        F.count(F.lit(1)).alias("n")
    )


@case(
    "s04_prefix_routes",
    f"SELECT {_ROUTE_SQL} AS route, count(*) AS n FROM lineitem GROUP BY 1",
)
def s04(spark, sf):
    rows = drops.stamp(stamped_lines(spark, sf), "path")
    return rows.groupBy(feeds.route_of("file_name").alias("route")).agg(
        F.count(F.lit(1)).alias("n")
    )


@case(
    "s05_unroutable_files",
    """SELECT 'msoa_footfall_hist_' || strftime(o_orderdate, '%Y%m') || '.csv' AS file_name, count(*) AS n
FROM orders WHERE o_orderstatus = 'P' GROUP BY 1""",
)
def s05(spark, sf):
    stem = F.when(F.col("o_orderstatus") == "P", F.lit("msoa_footfall_hist_")).otherwise(
        F.lit("msoa_daily_agg_")
    )
    files = table(spark, sf, "orders").select(
        F.concat(stem, F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv")).alias("file_name")
    )
    return drops.rows_per_file(feeds.unroutable(files))


@case("s07_rows_per_file", f"SELECT {_NAME_SQL} AS file_name, count(*) AS n FROM lineitem GROUP BY 1")
def s07(spark, sf):
    return drops.rows_per_file(drops.stamp(stamped_lines(spark, sf), "path"))


@case(
    "s10_reconcile",
    f"""WITH f AS (SELECT {_NAME_SQL} AS file_name, count(*) AS n_file FROM lineitem WHERE l_shipdate >= DATE '1995-03-01' GROUP BY 1),
t AS (SELECT {_NAME_SQL} AS file_name, count(*) AS n_table FROM lineitem
  WHERE l_returnflag = 'A' OR (l_returnflag = 'N' AND l_discount < 0.05) GROUP BY 1)
SELECT file_name, n_file, n_table, CASE WHEN n_file IS NULL THEN 'keep' WHEN n_table IS NULL THEN 'append'
  WHEN n_table = n_file THEN 'skip' ELSE 'replace' END AS action FROM f FULL JOIN t USING (file_name)""",
)
def s10(spark, sf):
    rows = drops.stamp(stamped_lines(spark, sf), "path")
    incoming = drops.incoming_files(
        rows.where(F.col("l_shipdate") >= F.lit("1995-03-01").cast("date"))
    )
    held = rows.where(
        (F.col("l_returnflag") == "A") | ((F.col("l_returnflag") == "N") & (F.col("l_discount") < 0.05))
    )
    return drops.reconcile(
        incoming.select("file_name", "n_file"), drops.rows_per_file(held, "n_table")
    )


@case(
    "s02_csv_scan",
    f"""SELECT l_orderkey, l_linenumber, {R('l_quantity')} AS q, l_returnflag FROM lineitem""",
)
def s02(spark, sf):
    where = staging_path(spark, "csv") + ".csv"
    write_csv(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"),
        where,
    )
    rows = read_csv(
        spark, where,
        schema="l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string",
    )
    return rows.select("l_orderkey", "l_linenumber", tidy("l_quantity").alias("q"), "l_returnflag")


@case(
    "s08_load_replayed",
    f"""SELECT {_NAME_SQL} AS file_name, count(*) AS n, {R('sum(l_extendedprice)', 2)} AS workers
FROM lineitem WHERE {_is_sql(_FLAGS['lsoa_daily'])}
AND {' AND '.join(f'NOT coalesce({c}, FALSE)' for c in _typed_sql('lsoa_daily')[1].values())} GROUP BY 1""",
)
def s08(spark, sf):
    """Half a drop, then all of it, then all of it again: every file ends up whole, once."""
    feed = feeds.FEEDS["lsoa_daily"]
    target = staging_path(spark, feed.table)
    rows = _sound(raw_feed(spark, sf, "lsoa_daily"), "lsoa_daily")
    drops.load_rows(rows.where(F.col("scaled_volume") > 25), feed, target)
    drops.load_rows(rows, feed, target)
    drops.load_rows(rows, feed, target)
    done = spark.read.parquet(target)
    return done.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n"), tidy(F.sum("worker_population_percentage"), 2).alias("workers")
    )


def _sound(rows, route: str):
    """The rows of a feed that break no rule, still as text."""
    value = feeds.check(rows, feeds.FEEDS[route].spec).where(F.size("violations") == 0)
    return value.drop("violations").withColumn("resident_population_percentage", F.lit("IDE"))


@case(
    "st1_stream_into_table",
    f"""SELECT {_NAME_SQL} AS file_name, count(*) AS n, {R('sum(l_extendedprice)', 2)} AS workers
FROM lineitem WHERE {_is_sql(_FLAGS['msoa_daily'])}
AND {' AND '.join(f'NOT coalesce({c}, FALSE)' for c in _typed_sql('msoa_daily')[1].values())} GROUP BY 1""",
)
def st1(spark, sf):
    """The feed as a stream; the second run finds nothing new and changes nothing."""
    feed = feeds.FEEDS["msoa_daily"]
    target = staging_path(spark, feed.table)
    log = staging_path(spark, "stream")
    for _ in range(2):
        lines = (
            spark.readStream.schema(table(spark, sf, "lineitem").schema)
            .parquet(f"{sf}/lineitem*.parquet")
        )
        rows = _sound(feed_text(lines, "msoa_daily"), "msoa_daily")
        land_stream(rows, feed, target, log).awaitTermination()
    done = spark.read.parquet(target)
    return done.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n"), tidy(F.sum("worker_population_percentage"), 2).alias("workers")
    )


# ---- declared inputs ----------------------------------------------------------------


def _add_scan(name: str, kind: str, sql: str, select, shown) -> None:
    """A table in the layout of an input, with its columns in another order, read back."""

    @case(name, sql)
    def run(spark, sf):
        where = staging_path(spark, kind) + ".csv"
        write_csv(select(spark, sf), where)
        return shown(inputs.read_input(spark, kind, where))


_add_scan(
    "s13_weekly_spend_scan",
    "weekly_spend",
    f"""SELECT o_orderkey AS area_id, strftime(o_orderdate, '%Y')::INT AS yr, month(o_orderdate)::INT AS wk,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS week_start,
  'area ' || o_custkey AS area_name, {R('o_totalprice', 2)} AS txn_amt_wd_retail FROM orders""",
    lambda spark, sf: table(spark, sf, "orders").select(
        F.lit("x").alias("further"),
        F.col("o_totalprice").alias("txn_amt_wd_retail"),
        F.concat(F.lit("area "), F.col("o_custkey").cast("string")).alias("area_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("week_start"),
        F.month("o_orderdate").alias("wk"),
        F.year("o_orderdate").alias("yr"),
        F.col("o_orderkey").alias("area_id"),
    ),
    lambda df: df.withColumns(
        {"week_start": text("week_start"), "txn_amt_wd_retail": tidy("txn_amt_wd_retail", 2)}
    ),
)
_add_scan(
    "s13_area_lookup_scan",
    "area_lookup",
    "SELECT 'E' || s_suppkey AS msoa11cd, s_name AS area_name FROM supplier",
    lambda spark, sf: table(spark, sf, "supplier").select(
        F.col("s_name").alias("area_name"),
        F.concat(F.lit("E"), F.col("s_suppkey").cast("string")).alias("msoa11cd"),
    ),
    lambda df: df,
)
_add_scan(
    "s13_clusters_scan",
    "clusters",
    """SELECT p_partkey AS area_id, p_size AS cluster_hourly, p_size % 7 AS cluster_daily, p_size % 3 AS cluster_size
FROM part""",
    lambda spark, sf: table(spark, sf, "part").select(
        (F.col("p_size") % 3).alias("cluster_size"),
        (F.col("p_size") % 7).alias("cluster_daily"),
        F.col("p_size").alias("cluster_hourly"),
        F.col("p_partkey").alias("area_id"),
    ),
    lambda df: df,
)
