"""Scores of predictions and clusterings, splits, nearest neighbours, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, learning
from ..operators.blocks import knn_classify
from .base import R, case, table, tidy


@case(
    "m01_standardise",
    f"""SELECT p_partkey, {R('(p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER ()', 5)} AS p_size,
  {R('(p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER ()', 5)} AS p_retailprice
FROM part""",
)
def m01(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    out = learning.Scaler.fit(rows, ["p_size", "p_retailprice"]).apply(rows)
    return out.select(
        "p_partkey", tidy("p_size", 5).alias("p_size"), tidy("p_retailprice", 5).alias("p_retailprice")
    )


_SILHOUETTE_SQL = """v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.x, b.x)) AS s, count(*) AS n
  FROM v a CROSS JOIN v b GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, label, max(CASE WHEN other = label THEN s END) / nullif(max(CASE WHEN other = label THEN n END) - 1, 0) AS a,
  min(CASE WHEN other <> label THEN s / n END) AS b FROM d GROUP BY 1, 2),
sil AS (SELECT vec_id, label, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""


def _silhouettes(spark, sf):
    return evaluate.silhouettes(
        table(spark, sf, "embeddings"), key="vec_id", vector="embedding", cluster="label"
    )


@case(
    "m03_silhouettes",
    f"""WITH {_SILHOUETTE_SQL} SELECT vec_id, label, {R('s')} AS silhouette FROM sil""",
)
def m03(spark, sf):
    return _silhouettes(spark, sf).select("vec_id", "label", tidy("silhouette").alias("silhouette"))


@case(
    "m03_mean_silhouette",
    f"""WITH {_SILHOUETTE_SQL} SELECT {R('avg(s)', 5)} AS silhouette FROM sil""",
)
def m03b(spark, sf):
    out = evaluate.mean_silhouette(_silhouettes(spark, sf))
    return out.select(tidy("silhouette", 5).alias("silhouette"))


@case(
    "m05_adjusted_rand",
    f"""WITH t AS (SELECT l_returnflag AS a, l_linenumber AS b, count(*) AS n FROM lineitem GROUP BY 1, 2),
q AS (SELECT sum(n * (n - 1) / 2.0) AS s, sum(n) * (sum(n) - 1) / 2.0 AS every FROM t),
ra AS (SELECT sum(m * (m - 1) / 2.0) AS s FROM (SELECT sum(n) AS m FROM t GROUP BY a)),
cb AS (SELECT sum(m * (m - 1) / 2.0) AS s FROM (SELECT sum(n) AS m FROM t GROUP BY b))
SELECT {R('(q.s - ra.s * cb.s / every) / ((ra.s + cb.s) / 2 - ra.s * cb.s / every)', 8)} AS adjusted_rand FROM q, ra, cb""",
)
def m05(spark, sf):
    out = evaluate.adjusted_rand(table(spark, sf, "lineitem"), "l_returnflag", "l_linenumber")
    return out.select(tidy("adjusted_rand", 8).alias("adjusted_rand"))


@case(
    "m07_independent_shuffle",
    """SELECT 'p_size' AS feature, CAST(p_size AS DOUBLE) AS v, count(*) AS n FROM part GROUP BY 2
UNION ALL SELECT 'p_retailprice', p_retailprice, count(*) FROM part GROUP BY 2""",
)
def m07(spark, sf):
    """A shuffle keeps what each column holds; the rows are compared in the tests."""
    rows = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    out = learning.shuffle_columns(rows, ["p_size", "p_retailprice"], key="p_partkey", seed=3)
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("feature"), F.col(c).alias("v"))
                for c in ("p_size", "p_retailprice")
            ]
        )
    )
    return out.select(cells.alias("c")).select("c.*").groupBy("feature", "v").agg(
        F.count(F.lit(1)).alias("n")
    )


@case(
    "m08_exact_split",
    """SELECT part, CASE WHEN part = 'test' THEN t ELSE n - t END AS n FROM (
  SELECT count(*) AS n, CAST(ceil(count(*) * 0.33) AS BIGINT) AS t FROM customer), (VALUES ('train'), ('test')) p(part)""",
)
def m08(spark, sf):
    """Sizes of both parts; a key in both or in none would change them."""
    rows = table(spark, sf, "customer").select("c_custkey")
    train, test = learning.split_rows(rows, 0.33, key="c_custkey", seed=0)
    tagged = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    one = tagged.groupBy("c_custkey").agg(F.max("part").alias("part"))
    return one.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@case(
    "m12_contiguous_folds",
    "SELECT c_custkey, CAST(ntile(5) OVER (ORDER BY c_custkey) - 1 AS INT) AS fold FROM customer",
)
def m12(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey")
    return learning.with_folds(rows, 5, key="c_custkey")


@case(
    "m13_regression_scores",
    f"""WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)
SELECT {R('1 - avg((y - p) * (y - p)) / var_pop(y)', 6)} AS r2, {R('avg(abs(y - p))', 3)} AS mae,
  {R('sqrt(avg((y - p) * (y - p)))', 3)} AS rmse FROM p""",
)
def m13(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("p", F.col("l_quantity") * 1500)
    out = evaluate.regression_scores(rows, actual="l_extendedprice", predicted="p")
    return out.select(tidy("r2", 6).alias("r2"), tidy("mae", 3).alias("mae"), tidy("rmse", 3).alias("rmse"))


@case(
    "m20_nearest_neighbours",
    """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS r
  FROM v a CROSS JOIN v b),
c AS (SELECT vec_id, label, count(*) AS n FROM d WHERE r <= 5 GROUP BY 1, 2)
SELECT vec_id, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) AS r FROM c) WHERE r = 1""",
)
def m20(spark, sf):
    rows = table(spark, sf, "embeddings")
    return knn_classify(rows, rows, 5, key="vec_id", vector="embedding", label="label")


# ---- classification scores ----------------------------------------------------------

_CALLS = """p AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS label,
  CAST(floor(o_totalprice / 100000) AS INT) + 1 AS prediction FROM orders)"""
_GRID = f"""{_CALLS}, c AS (SELECT DISTINCT label AS c FROM p UNION SELECT DISTINCT prediction FROM p),
cm AS (SELECT a.c AS label, b.c AS prediction, count(p.label) AS n FROM c a CROSS JOIN c b
  LEFT JOIN p ON p.label = a.c AND p.prediction = b.c GROUP BY 1, 2),
k AS (SELECT c.c AS class, CAST(sum(n) FILTER (WHERE label = c.c AND prediction = c.c) AS BIGINT) AS tp,
  CAST(sum(n) FILTER (WHERE label = c.c) AS BIGINT) AS support, CAST(sum(n) FILTER (WHERE prediction = c.c) AS BIGINT) AS called,
  CAST(sum(n) AS BIGINT) AS total FROM c CROSS JOIN cm GROUP BY 1),
s AS (SELECT *, coalesce(tp / nullif(called, 0), 0) AS pr, coalesce(tp / nullif(support, 0), 0) AS re FROM k)"""


def _confusion(spark, sf):
    calls = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("label"),
        (F.floor(F.col("o_totalprice") / 100000) + 1).cast("int").alias("prediction"),
    )
    return evaluate.confusion(calls)


@case("m25_confusion", f"WITH {_GRID} SELECT label, prediction, n FROM cm")
def m25(spark, sf):
    return _confusion(spark, sf)


@case(
    "m24_overall_scores",
    f"""WITH {_GRID} SELECT {R('sum(tp) / sum(support)', 6)} AS accuracy,
  {R('sum(support * coalesce(2 * pr * re / nullif(pr + re, 0), 0)) / sum(support)', 6)} AS weighted_f1 FROM s""",
)
def m24(spark, sf):
    out = evaluate.overall_scores(_confusion(spark, sf))
    return out.select(tidy("accuracy", 6).alias("accuracy"), tidy("weighted_f1", 6).alias("weighted_f1"))


@case(
    "m26_class_scores",
    f"""WITH {_GRID} SELECT class, {R('pr', 6)} AS precision, {R('re', 6)} AS recall,
  {R('coalesce(2 * pr * re / nullif(pr + re, 0), 0)', 6)} AS f_score, support FROM s""",
)
def m26(spark, sf):
    out = evaluate.class_scores(_confusion(spark, sf))
    return out.select(
        "class", *[tidy(c, 6).alias(c) for c in ("precision", "recall", "f_score")], "support"
    )


@case(
    "m27_one_against_rest",
    f"""WITH {_GRID} SELECT class, tp, called - tp AS fp, support - tp AS fn, total - called - support + tp AS tn,
  {R('(total - called - support + 2 * tp) / total', 6)} AS ovr_accuracy FROM s""",
)
def m27(spark, sf):
    out = evaluate.class_scores(_confusion(spark, sf))
    return out.select("class", "tp", "fp", "fn", "tn", tidy("ovr_accuracy", 6).alias("ovr_accuracy"))


@case(
    "m28_class_accuracy",
    f"WITH {_GRID} SELECT class, {R('pr', 6)} AS class_accuracy FROM s",
)
def m28(spark, sf):
    out = evaluate.class_scores(_confusion(spark, sf))
    return out.select("class", tidy("class_accuracy", 6).alias("class_accuracy"))
