"""Labels, splits, bins and the tables behind the grouped figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups
from ..operators.ranking import add_tile
from ..plans.figures import grouped_profiles, profiles_with_lines
from .base import (
    NATION_MONTH,
    R,
    SUPPLIER_WEEK,
    case,
    complete_sql,
    dense_sql,
    nation_month,
    supplier_week,
    table,
    text,
    tidy,
)
from ..operators.series import extract_series

# one row per supplier; two-decimal inputs keep both engines on the same sort keys
SUPPLIER_STATS = """ss AS (
  SELECT l_suppkey AS key, sum(l_quantity) AS qty, max(l_extendedprice) AS top
  FROM lineitem GROUP BY 1)"""


def supplier_stats(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("key"))
        .agg(F.sum("l_quantity").alias("qty"), F.max("l_extendedprice").alias("top"))
    )


ORDER_STATS = """os AS (
  SELECT o_custkey AS key, max(o_totalprice) AS top, min(o_totalprice) AS low, count(*) AS n
  FROM orders GROUP BY 1)"""


def order_stats(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("key"))
        .agg(
            F.max("o_totalprice").alias("top"),
            F.min("o_totalprice").alias("low"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def _quantiles(source: str, column: str, probs) -> str:
    return ", ".join(
        f"quantile_cont({column}, {p}) AS q{i}" for i, p in enumerate(probs)
    ) + f" FROM {source}"


@case(
    "w05_quantile_label",
    f"""WITH {ORDER_STATS}, e AS (SELECT {_quantiles('os', 'top', (0.25, 0.5, 0.75))})
SELECT key, (top > q0)::INT + (top > q1)::INT + (top > q2)::INT AS label FROM os, e""",
)
def w05(spark, sf):
    return groups.quantile_label(order_stats(spark, sf), "top", key="key").select("key", "label")


@case(
    "w06_risk_labels",
    f"""WITH r AS (
  SELECT c.c_nationkey AS key,
    avg(CASE WHEN o_orderdate >= DATE '2001-03-01' AND o_orderdate < DATE '2001-04-01' THEN o_totalprice END) AS latest,
    avg(CASE WHEN o_orderdate >= DATE '2000-03-01' AND o_orderdate < DATE '2001-02-01' THEN o_totalprice END) AS usual
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1),
k AS (SELECT key, latest / usual AS ratio FROM r WHERE latest IS NOT NULL AND usual IS NOT NULL),
e AS (SELECT {_quantiles('k', 'ratio', (0.25, 0.5, 0.75))})
SELECT key, {R('ratio')} AS ratio, (ratio > q0)::INT + (ratio > q1)::INT + (ratio > q2)::INT AS label
FROM k, e""",
)
def w06(spark, sf):
    # orders shrink to months of customers before they meet the customer table
    months = table(spark, sf, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month")).agg(
        F.sum("o_totalprice").alias("total"), F.count("o_totalprice").alias("n")
    )
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("key"))
    rows = months.join(customers, months.o_custkey == customers.c_custkey)
    out = groups.risk_labels(
        rows, "2001-03", "2000-03", "2001-02", key="key", time="month", value="total", count="n"
    )
    return out.select("key", tidy("ratio").alias("ratio"), "label")


@case(
    "w07_equal_split",
    f"""WITH {ORDER_STATS}
SELECT key, CAST(ntile(7) OVER (ORDER BY top, key) - 1 AS INT) AS tile FROM os""",
)
def w07(spark, sf):
    return add_tile(order_stats(spark, sf), "top", 7, key="key", out="tile").select("key", "tile")


@case(
    "w08_split_with_means",
    f"""WITH {ORDER_STATS},
a AS (SELECT *, ntile(4) OVER (ORDER BY top, key) - 1 AS i FROM os),
b AS (SELECT *, ntile(4) OVER (PARTITION BY i ORDER BY low, key) - 1 AS j FROM a)
SELECT key, {R('avg(top) OVER (PARTITION BY i, j)')} AS group_top,
  {R('avg(low) OVER (PARTITION BY i, j)')} AS group_low, CAST(i * 4 + j AS INT) AS group_num FROM b""",
)
def w08(spark, sf):
    out = groups.split_with_means(order_stats(spark, sf), "top", "low", 4, key="key")
    return out.select(
        "key", tidy("group_top").alias("group_top"), tidy("group_low").alias("group_low"), "group_num"
    )


@case(
    "w09_split_table",
    f"""WITH {SUPPLIER_STATS},
a AS (SELECT *, ntile(3) OVER (ORDER BY qty, key) AS i FROM ss),
b AS (SELECT *, ntile(3) OVER (PARTITION BY i ORDER BY top, key) AS j FROM a)
SELECT key, {R('qty', 2)} AS qty, {R('top', 2)} AS top, CAST((i - 1) * 3 + j AS INT) AS overall_group,
  CAST(i AS INT) AS group_1, CAST(j AS INT) AS group_2 FROM b""",
)
def w09(spark, sf):
    out = groups.split_table(supplier_stats(spark, sf), "qty", "top", 3, key="key")
    return out.withColumns({"qty": tidy("qty", 2), "top": tidy("top", 2)})


def _edges_sql(source: str, column: str, lo: float, hi: float, name: str) -> str:
    return (
        f"{name} AS (SELECT quantile_cont({column}, {lo}) AS lo, quantile_cont({column}, {hi}) AS hi"
        f" FROM {source})"
    )


def _bin_sql(column: str, edges: str, bins: int) -> str:
    reached = " + ".join(
        f"({column} >= {edges}.lo + {i} * (({edges}.hi - {edges}.lo) / {bins}))::INT" for i in range(bins)
    )
    return f"CAST({reached} + ({column} > {edges}.hi)::INT AS INT)"


@case(
    "a20_bin_edges",
    f"""WITH {ORDER_STATS}, {_edges_sql('os', 'top', 0.1, 0.9, 'e')}
SELECT CAST(i AS INT) AS i, {R('lo + i * ((hi - lo) / 4)', 3)} AS edge FROM e, range(5) r(i)""",
)
def a20(spark, sf):
    edges = groups.bin_edges(order_stats(spark, sf), "top", 4, 10, 90, key="key")
    made = spark.createDataFrame(list(enumerate(edges)), "i int, edge double")
    return made.select("i", tidy("edge", 3).alias("edge"))


@case(
    "w10_percentile_cells",
    f"""WITH {ORDER_STATS}, {_edges_sql('os', 'top', 0.1, 0.9, 'e')}, {_edges_sql('os', 'low', 0.1, 0.9, 'f')},
b AS (SELECT key, {_bin_sql('top', 'e', 4)} AS "row", {_bin_sql('low', 'f', 4)} AS "column" FROM os, e, f)
SELECT key, "row", "column", CAST("row" * 6 + "column" AS INT) AS "group" FROM b""",
)
def w10(spark, sf):
    out = groups.percentile_cells(order_stats(spark, sf), "top", "low", 4, key="key")
    return out.select("key", "row", "column", "group")


@case(
    "w10_three_by_three",
    f"""WITH {SUPPLIER_STATS}, {_edges_sql('ss', 'qty', 0.1, 0.9, 'e')}, {_edges_sql('ss', 'top', 0.1, 0.9, 'f')},
b AS (SELECT key, {_bin_sql('qty', 'e', 1)} AS "row", {_bin_sql('top', 'f', 1)} AS "column" FROM ss, e, f)
SELECT key, "row", "column", CAST("row" * 3 + "column" AS INT) AS "group" FROM b""",
)
def w10b(spark, sf):
    out = groups.percentile_cells(supplier_stats(spark, sf), "qty", "top", 1, key="key")
    return out.select("key", "row", "column", "group")


@case(
    "w11_even_cells",
    f"""WITH {ORDER_STATS}, b AS (
  SELECT key, CAST(ntile(4) OVER (ORDER BY top, key) - 1 AS INT) AS row_even,
         CAST(ntile(4) OVER (ORDER BY low, key) - 1 AS INT) AS column_even FROM os)
SELECT *, CAST(row_even * 4 + column_even AS INT) AS group_even FROM b""",
)
def w11(spark, sf):
    out = groups.even_cells(order_stats(spark, sf), "top", "low", 4, key="key")
    return out.select("key", "row_even", "column_even", "group_even")


@case(
    "w12_plot_cells_equal",
    f"""WITH {ORDER_STATS},
a AS (SELECT *, ntile(5) OVER (ORDER BY top, key) - 1 AS i FROM os),
b AS (SELECT *, ntile(5) OVER (PARTITION BY i ORDER BY low, key) - 1 AS j FROM a)
SELECT key, CAST(i * 5 + j + 1 AS INT) AS cell FROM b""",
)
def w12(spark, sf):
    return groups.plot_cells(order_stats(spark, sf), "top", "low", 5, key="key").select("key", "cell")


_RANGE_CELLS = f"""{_edges_sql('os', 'top', 0.05, 0.9, 'e')}, {_edges_sql('os', 'low', 0.05, 0.9, 'f')},
b AS (SELECT os.*, {_bin_sql('top', 'e', 4)} AS r, {_bin_sql('low', 'f', 4)} AS c FROM os, e, f),
cell AS (SELECT *, CAST((r - 1) * 4 + c AS INT) AS cell FROM b WHERE r BETWEEN 1 AND 4 AND c BETWEEN 1 AND 4)"""


@case(
    "w12_plot_cells_range",
    f"WITH {ORDER_STATS}, {_RANGE_CELLS} SELECT key, cell FROM cell",
)
def w12b(spark, sf):
    out = groups.plot_cells(
        order_stats(spark, sf), "top", "low", 4, key="key", equal_counts=False
    )
    return out.select("key", "cell")


@case(
    "a21_cell_counts",
    f"""WITH {ORDER_STATS}, {_RANGE_CELLS},
g AS (SELECT CAST(a.i AS INT) AS "row", CAST(b.i AS INT) AS "column" FROM range(1, 5) a(i), range(1, 5) b(i))
SELECT g."row", g."column", count(cell.key) AS n FROM g
LEFT JOIN cell ON cell.r = g."row" AND cell.c = g."column" GROUP BY 1, 2""",
)
def a21(spark, sf):
    binned = groups.percentile_cells(
        order_stats(spark, sf), "top", "low", 4, key="key", low_pct=5, high_pct=90
    )
    return groups.cell_counts(binned, 4)


@case(
    "a23_cell_means",
    f"""WITH {ORDER_STATS}, {_RANGE_CELLS}
SELECT cell, count(*) AS n, {R('avg(top)')} AS mean_top, {R('avg(low)')} AS mean_low FROM cell GROUP BY cell""",
)
def a23(spark, sf):
    cells = groups.plot_cells(
        order_stats(spark, sf), "top", "low", 4, key="key", equal_counts=False
    )
    out = groups.cell_means(cells, ["top", "low"])
    return out.select(
        "cell", "n", tidy("mean_top").alias("mean_top"), tidy("mean_low").alias("mean_low")
    )


# ---- figures ------------------------------------------------------------------------

_SUPPLIER_CELLS = f"""{SUPPLIER_STATS},
a AS (SELECT *, ntile(3) OVER (ORDER BY qty, key) - 1 AS i FROM ss),
cell AS (SELECT *, CAST(i * 3 + ntile(3) OVER (PARTITION BY i ORDER BY top, key) AS INT) AS cell FROM a)"""


def _grouped(spark, sf):
    series = extract_series(
        supplier_week(spark, sf), "1995-01-01", "2001-12-31", key="key", time="t", value="v",
        upper=None, unique=True,
    )
    return grouped_profiles(
        series, supplier_stats(spark, sf), "qty", "top", 3, key="key", time="t", value="v"
    )


@case(
    "d02_grouped_series",
    f"""WITH {SUPPLIER_WEEK}, {dense_sql('sw')}, {complete_sql('dense')}, {_SUPPLIER_CELLS}
SELECT cell.cell, whole.key, CAST(t AS VARCHAR) AS t, {R('v')} AS v FROM whole JOIN cell ON whole.key = cell.key""",
)
def d02(spark, sf):
    rows, _ = _grouped(spark, sf)
    return rows.select("cell", "key", text("t").alias("t"), tidy("v").alias("v"))


@case(
    "a22_cell_profiles",
    f"""WITH {SUPPLIER_WEEK}, {dense_sql('sw')}, {complete_sql('dense')}, {_SUPPLIER_CELLS}
SELECT cell.cell, CAST(t AS VARCHAR) AS t, {R('avg(v)')} AS mean_value
FROM whole JOIN cell ON whole.key = cell.key GROUP BY 1, 2""",
)
def a22(spark, sf):
    _, means = _grouped(spark, sf)
    return means.select("cell", text("t").alias("t"), tidy("mean_value").alias("mean_value"))


@case(
    "d01_profiles_with_lines",
    f"""WITH {NATION_MONTH}, f AS (
  SELECT key,
    regr_slope(v, date_diff('day', DATE '1997-01-01', t)) FILTER (WHERE t BETWEEN DATE '1997-01-01' AND DATE '1997-12-31') AS s1,
    regr_intercept(v, date_diff('day', DATE '1997-01-01', t)) FILTER (WHERE t BETWEEN DATE '1997-01-01' AND DATE '1997-12-31') AS i1,
    regr_slope(v, date_diff('day', DATE '1998-02-01', t)) FILTER (WHERE t BETWEEN DATE '1998-01-01' AND DATE '1999-06-30') AS s2,
    regr_intercept(v, date_diff('day', DATE '1998-02-01', t)) FILTER (WHERE t BETWEEN DATE '1998-01-01' AND DATE '1999-06-30') AS i2
  FROM nm GROUP BY key)
SELECT nm.key, CAST(t AS VARCHAR) AS t, {R('v', 3)} AS v,
  CASE WHEN t BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' THEN {R("i1 + s1 * date_diff('day', DATE '1997-01-01', t)", 3)} END AS fit_a,
  CASE WHEN t BETWEEN DATE '1998-01-01' AND DATE '1999-06-30' THEN {R("i2 + s2 * date_diff('day', DATE '1998-02-01', t)", 3)} END AS fit_b
FROM nm JOIN f ON nm.key = f.key""",
)
def d01(spark, sf):
    fits = {
        "a": (("1997-01-01", "1997-12-31"), "1997-01-01"),
        "b": (("1998-01-01", "1999-06-30"), "1998-02-01"),
    }
    out = profiles_with_lines(nation_month(spark, sf), fits, key="key", time="t", value="v")
    return out.select(
        "key", text("t").alias("t"), tidy("v", 3).alias("v"), tidy("fit_a", 3).alias("fit_a"),
        tidy("fit_b", 3).alias("fit_b"),
    )
