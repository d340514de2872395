"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import repair_name
from ..operators import joins
from ..operators.aggregates import mean_and_spread
from ..session import cut
from .base import R, SUPPLIER_WEEK, case, supplier_week, table, text, tidy


@case(
    "j01_mean_against_mean",
    f"""WITH a AS (SELECT o_custkey, avg(o_totalprice) AS m FROM orders
    WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01' GROUP BY 1),
b AS (SELECT o_custkey, avg(o_totalprice) AS m FROM orders
    WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01' GROUP BY 1)
SELECT a.o_custkey, {R('a.m')} AS m_x, {R('b.m')} AS m_y FROM a JOIN b ON a.o_custkey = b.o_custkey""",
)
def j01(spark, sf):
    from ..operators.projection import in_months

    orders = table(spark, sf, "orders")

    def mean(a, b):
        return in_months(orders, a, b, time="o_orderdate").groupBy("o_custkey").agg(
            tidy(F.avg("o_totalprice")).alias("m")
        )

    return joins.merge_suffixed(mean("1998-01", "1999-01"), mean("1997-01", "1998-01"), "o_custkey")


@case(
    "j02_mean_with_spread",
    f"""WITH a AS (SELECT l_suppkey, avg(l_quantity) AS m FROM lineitem GROUP BY 1),
b AS (SELECT l_suppkey, stddev_samp(l_quantity) AS s FROM lineitem GROUP BY 1)
SELECT a.l_suppkey, {R('m')} AS mean, {R('s')} AS std FROM a JOIN b ON a.l_suppkey = b.l_suppkey""",
)
def j02(spark, sf):
    out = mean_and_spread(table(spark, sf, "lineitem"), key="l_suppkey", value="l_quantity")
    return out.select("l_suppkey", tidy("mean").alias("mean"), tidy("std").alias("std"))


@case(
    "j03_lookup_fan_out",
    """WITH lk AS (SELECT DISTINCT l_suppkey, l_returnflag AS area FROM lineitem)
SELECT s.s_suppkey, s.s_name, lk.area FROM supplier s JOIN lk ON s.s_suppkey = lk.l_suppkey""",
)
def j03(spark, sf):
    lookup = (
        table(spark, sf, "lineitem")
        .select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_returnflag").alias("area"))
        .distinct()
    )
    return joins.fan_out(table(spark, sf, "supplier").select("s_suppkey", "s_name"), lookup, "s_suppkey")


_PARTS = {
    "urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "open": "4-NOT SPECIFIED", "low": "5-LOW"
}


def _customer_features(spark, sf):
    """A feature table per priority, all from one count of the orders."""
    counts = cut(
        table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    )
    return [
        counts.where(F.col("o_orderpriority") == p).select("o_custkey", F.col("n").alias(name))
        for name, p in _PARTS.items()
    ]


def _parts_sql() -> str:
    return ", ".join(
        f"{n} AS (SELECT o_custkey, count(*) AS {n} FROM orders WHERE o_orderpriority = '{p}' GROUP BY 1)"
        for n, p in _PARTS.items()
    )


def _merged_sql(kind: str) -> str:
    first, *rest = _PARTS
    joined = " ".join(f"{kind} JOIN {n} USING (o_custkey)" for n in rest)
    return f"WITH {_parts_sql()} SELECT o_custkey, {', '.join(_PARTS)} FROM {first} {joined}"


@case("j04_full_outer_merge", _merged_sql("FULL"))
def j04(spark, sf):
    return joins.merge_all(_customer_features(spark, sf), "o_custkey", "full")


@case("j05_inner_merge", _merged_sql("INNER"))
def j05(spark, sf):
    return joins.merge_all(_customer_features(spark, sf), "o_custkey", "inner")


@case(
    "j06_left_statistics",
    f"""SELECT c_custkey, n, {R('m')} AS mean FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m FROM orders GROUP BY 1)
ON c_custkey = o_custkey""",
)
def j06(spark, sf):
    stats = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"), tidy(F.avg("o_totalprice")).alias("mean"))
    )
    return joins.attach(table(spark, sf, "customer").select("c_custkey"), stats, "c_custkey")


@case(
    "j07_left_clusters",
    """SELECT l_suppkey, n, s_nationkey FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)
LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def j07(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    clusters = (
        table(spark, sf, "supplier")
        .select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    )
    return joins.attach(counts, clusters, "l_suppkey")


@case(
    "j08_left_profile",
    """SELECT o.o_custkey, n, c_name, c_mktsegment FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o
LEFT JOIN customer ON o.o_custkey = c_custkey""",
)
def j08(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    profile = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    return joins.attach(counts, profile, "o_custkey")


@case(
    "j09_series_with_predictors",
    f"""WITH {SUPPLIER_WEEK} SELECT sw.key, CAST(t AS VARCHAR) AS t, {R('sw.v')} AS v_x, p.s_acctbal AS v_y
FROM sw LEFT JOIN supplier p ON sw.key = p.s_suppkey""",
)
def j09(spark, sf):
    predictors = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("v")
    )
    out = joins.merge_suffixed(supplier_week(spark, sf), predictors, "key", how="left")
    return out.select("key", text("t").alias("t"), tidy("v_x").alias("v_x"), "v_y")


@case(
    "j10_prediction_with_actual",
    f"""WITH {SUPPLIER_WEEK}, g AS (SELECT k.key, d.t FROM (SELECT DISTINCT key FROM sw) k CROSS JOIN (SELECT DISTINCT t FROM sw) d)
SELECT g.key, CAST(g.t AS VARCHAR) AS t, {R('sw.v')} AS actual FROM g LEFT JOIN sw ON g.key = sw.key AND g.t = sw.t""",
)
def j10(spark, sf):
    series = supplier_week(spark, sf)
    grid = joins.period_grid(series, key="key", time="t")
    return joins.attach(grid, series, ["key", "t"]).select(
        "key", text("t").alias("t"), tidy("v").alias("actual")
    )


@case(
    "j11_name_of",
    """SELECT l_orderkey, l_linenumber, p_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def j11(spark, sf):
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.name_of(lines, names, "l_partkey").drop("l_partkey")


@case(
    "j12_period_grid",
    """SELECT u.user_id, CAST(d.d AS VARCHAR) AS day FROM (SELECT DISTINCT user_id FROM events) u
CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) d""",
)
def j12(spark, sf):
    grid = joins.period_grid(table(spark, sf, "events"), key="user_id", time="ts")
    return grid.select("user_id", text("ts").alias("day"))


@case(
    "j13_attach_by_key",
    f"""WITH f AS (SELECT regexp_replace(source, '[^\\x00-\\x7f]', '''', 'g') AS source, avg(n_chars) AS m FROM documents GROUP BY 1),
l AS (SELECT source, CAST(sum(quality) AS BIGINT) AS q FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT f.source, {R('m')} AS mean_chars, q FROM f JOIN l ON f.source = l.source""",
)
def j13(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    features = docs.groupBy(repair_name("source").alias("source")).agg(
        tidy(F.avg("n_chars")).alias("mean_chars")
    )
    labels = docs.join(table(spark, sf, "labels"), "doc_id").groupBy("source").agg(
        F.sum("quality").alias("q")
    )
    return features.join(labels, "source")
