"""Properties that a fitted model must have, counted over all rows it was fitted on.

A learnt model has no SQL form, but its optimum has: gradients that vanish, leaves that
hold the mean of their rows, points that lie nearest to their own centre. Each query
returns how many rows it looked at and how many places break the property.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import days_since
from ..operators import learning
from ..operators.fits import huber_lines
from ..operators.series import slice_period
from ..session import cut
from .base import SUPPLIER_WEEK, case, supplier_week
from .learning import _POOLED, FEATURES, _scaled_customers, embedding_vectors, labelled_customers

# customers with at least two orders have all features
_CUSTOMERS = """c AS (SELECT o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)
  GROUP BY 1 HAVING count(*) > 1)"""


def _counted(groups: DataFrame, rows: Column, wrong: Column, name: str) -> DataFrame:
    """All rows of the groups, and how many groups are wrong."""
    wrong = F.coalesce(wrong, F.lit(True)).cast("int")
    return groups.agg(F.sum(rows).cast("bigint").alias("n"), F.sum(wrong).cast("bigint").alias(name))


def _column(i: int):
    return vector_to_array("features")[i]


def _gradients_off(rows: DataFrame, errors, penalties, size: float, name: str) -> DataFrame:
    """Sums of error times feature that differ from their penalty by over ``size`` a row."""
    sums = [F.sum(errors), *[F.sum(errors * _column(i)) for i in range(len(penalties))]]
    wanted = [0.0, *penalties]
    off = [(F.abs(s - F.lit(float(w))) > size * F.count(F.lit(1))).cast("int") for s, w in zip(sums, wanted)]
    return rows.agg(F.count(F.lit(1)).alias("n"), sum(off[1:], off[0]).cast("bigint").alias(name))


@case("m02_nearest_centres", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS misplaced FROM embeddings")
def m02_nearest(spark, sf):
    """Rows that another centre is nearer to than the one of their cluster."""
    rows = embedding_vectors(spark, sf)
    model = learning.cluster(rows, 3)
    centres = [[float(v) for v in centre] for centre in model.centres]

    def apart(centre: list[float]) -> Column:
        gaps = F.zip_with("_x", F.lit(centre), lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)

    placed = model.transform(rows).withColumn("_x", vector_to_array("features"))
    placed = placed.withColumn("_d", F.array(*[apart(c) for c in centres]))
    wrong = F.get("_d", F.col("cluster")) > F.array_min("_d") + 1e-9
    return _counted(placed, F.lit(1), wrong, "misplaced")


@case("m06_component_properties", f"WITH {_CUSTOMERS} SELECT count(*) AS n, CAST(0 AS BIGINT) AS off FROM c")
def m06_properties(spark, sf):
    """Components whose scores have another variance, or go with those of another one."""
    rows = _scaled_customers(spark, sf).drop("features")
    scores, variance = learning.principal_components(rows, FEATURES)
    wanted = [r["variance"] for r in variance.orderBy("component").collect()]
    names = [f"pc{i + 1}" for i in range(len(wanted))]
    off = [(F.abs(F.var_samp(c) - w) > 1e-6).cast("int") for c, w in zip(names, wanted)]
    off += [
        (F.abs(F.covar_samp(a, b)) > 1e-6).cast("int") for i, a in enumerate(names) for b in names[:i]
    ]
    return scores.agg(F.count(F.lit(1)).alias("n"), sum(off[1:], off[0]).cast("bigint").alias("off"))


@case("m09_ridge_gradients", f"WITH {_CUSTOMERS} SELECT count(*) AS n, CAST(0 AS BIGINT) AS off FROM c")
def m09_gradients(spark, sf):
    """Gradients of squared error plus penalty that do not vanish at the fitted line."""
    rows = _scaled_customers(spark, sf).withColumn("label", F.col("label") / 1000)
    model = learning.ridge(learning.size_of(rows, "label"), {"alpha": 200}).fit(rows)
    errors = F.col("label") - F.col("prediction")
    return _gradients_off(model.transform(rows), errors, [200 * c for c in model.coefficients], 1e-6, "off")


@case("m17_logistic_gradients", f"WITH {_CUSTOMERS} SELECT count(*) AS n, CAST(0 AS BIGINT) AS off FROM c")
def m17_gradients(spark, sf):
    """Gradients of the log loss plus penalty, over all classes, that do not vanish."""
    rows = labelled_customers(spark, sf)
    rows = cut(learning.assemble(learning.Scaler.fit(rows, FEATURES).apply(rows), FEATURES))
    size = learning.size_of(rows, "label")
    model = learning.logistic(size, {"C": 10, "max_iter": 2000}).fit(rows)
    scored = model.transform(rows).withColumn("_p", vector_to_array("probability"))
    weights, off = model.coefficientMatrix.toArray(), []
    for c in range(model.numClasses):
        error = (F.col("label") == c).cast("double") - F.col("_p")[c]
        for i in range(len(FEATURES)):
            gap = F.sum(error * _column(i)) - F.lit(float(weights[c, i]) / 10)
            off.append((F.abs(gap) > 0.01 * size.n).cast("int"))
    return scored.agg(F.count(F.lit(1)).alias("n"), sum(off[1:], off[0]).cast("bigint").alias("off"))


@case("m11_leaf_means", f"WITH {_CUSTOMERS} SELECT count(*) AS n, CAST(0 AS BIGINT) AS off FROM c")
def m11_leaves(spark, sf):
    """Predictions of the regression tree that are not the mean label of their rows."""
    rows = _scaled_customers(spark, sf)
    model = learning.regression_tree(learning.size_of(rows, "label"), {"max_depth": 4}).fit(rows)
    leaves = model.transform(rows).groupBy("prediction").agg(
        F.avg("label").alias("mean"), F.count(F.lit(1)).alias("rows")
    )
    wrong = F.abs(F.col("mean") - F.col("prediction")) > 1e-6 * F.col("mean")
    return _counted(leaves, F.col("rows"), wrong, "off")


def _add_leaf_shares(name: str, criterion: str) -> None:
    @case(name, f"WITH {_CUSTOMERS} SELECT count(*) AS n, CAST(0 AS BIGINT) AS off FROM c")
    def run(spark, sf):
        """Leaves of the classification tree whose shares are not those of their rows."""
        rows = labelled_customers(spark, sf)
        rows = cut(learning.assemble(learning.Scaler.fit(rows, FEATURES).apply(rows), FEATURES))
        model = learning.classification_tree(
            learning.size_of(rows, "label"), {"criterion": criterion}
        ).fit(rows)
        done = model.transform(rows).withColumn("_p", vector_to_array("probability"))
        shares = [F.avg((F.col("label") == c).cast("double")).alias(f"s{c}") for c in range(model.numClasses)]
        leaves = done.groupBy("_p").agg(*shares, F.count(F.lit(1)).alias("rows"))
        gaps = [F.abs(F.col("_p")[c] - F.col(f"s{c}")) for c in range(model.numClasses)]
        return _counted(leaves, F.col("rows"), F.greatest(*gaps) > 1e-9, "off")


_add_leaf_shares("m18_leaf_shares_gini", "gini")
_add_leaf_shares("m18_leaf_shares_entropy", "entropy")


@case(
    "a17_huber_gradients",
    f"""WITH {SUPPLIER_WEEK} SELECT count(DISTINCT key) AS n, CAST(0 AS BIGINT) AS off FROM sw
WHERE t BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
)
def a17_gradients(spark, sf):
    """Keys whose Huber line has not converged, or whose clipped residuals do not balance."""
    weeks = cut(slice_period(supplier_week(spark, sf, _POOLED), *_POOLED, time="t"))
    fits = cut(huber_lines(weeks, _POOLED, _POOLED[0], key="key", time="t", value="v"))
    day = days_since("t", _POOLED[0])
    rest = (F.col("v") - F.col("intercept") - F.col("slope") * day) / F.col("scale")
    clipped = F.greatest(F.lit(-1.05), F.least(F.lit(1.05), rest))
    sums = weeks.join(fits.where("n >= 3"), "key").groupBy("key").agg(F.avg(clipped).alias("balance"))
    joined = fits.join(sums, "key", "left")
    wrong = ~F.col("converged") | (F.abs(F.coalesce("balance", F.lit(0.0))) > 1e-5)
    return _counted(joined, F.lit(1), wrong, "off")
