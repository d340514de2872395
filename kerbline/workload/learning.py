"""Clustering, regression, classification, robust and pooled fits."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..operators import evaluate, learning
from ..operators.fits import (
    Pool,
    band_with_actuals,
    fit_pool,
    huber_lines,
    pooled_posterior,
    pooled_summary,
    pooled_sums,
    predictive_band,
)
from ..operators.reshape import one_hot
from ..operators.series import extract_series, slice_period
from ..plans.at_risk import compare_models, final_model
from ..plans.pooling import pooled_lines
from ..session import cut, staging_path
from ..sources.tables import load_model, save_model
from .base import R, SUPPLIER_WEEK, case, supplier_week, table, text, tidy
from .cells import order_stats

_C = dict(key="key", time="t", value="v")
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FEATURES = ["n_orders", "mean_price", "sd_price", "c_acctbal"] + [f"seg_{s}" for s in _SEGMENTS]


def customer_matrix(spark, sf):
    """Customer features and two targets: the top price, and its quartile as a label."""
    orders = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("n_orders"),
            F.avg("o_totalprice").alias("mean_price"),
            F.stddev_samp("o_totalprice").alias("sd_price"),
            F.max("o_totalprice").alias("top_price"),
        )
    )
    customers = one_hot(
        table(spark, sf, "customer").select(
            "c_custkey", "c_acctbal", F.col("c_mktsegment").alias("seg")
        ),
        "seg",
        _SEGMENTS,
    )
    return customers.join(orders, "c_custkey")


def labelled_customers(spark, sf):
    from ..operators.groups import quantile_label

    rows = customer_matrix(spark, sf).dropna("any")
    return quantile_label(rows, "top_price", key="c_custkey").drop("top_price")


def embedding_vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", array_to_vector("embedding").alias("features")
    )


# ---- clustering ---------------------------------------------------------------------


@case("m02_kmeans_embeddings")
def m02(spark, sf):
    rows = embedding_vectors(spark, sf)
    model = learning.cluster(rows, 3)
    return model.transform(rows).select("vec_id", "cluster")


@case("m02_kmeans_series")
def m02b(spark, sf):
    series = extract_series(
        supplier_week(spark, sf), "1996-01-01", "1996-12-31", **_C, upper=None, unique=True
    )
    rows = learning.series_vectors(series, **_C)
    return learning.cluster(rows, 3).transform(rows).select("key", "cluster")


@case("m04_cluster_sweep")
def m04(spark, sf):
    return learning.cluster_sweep(
        embedding_vectors(spark, sf), [2, 3, 4, 5], key="vec_id", exact=True
    )


@case("m04_cluster_sweep_centroid")
def m04b(spark, sf):
    return learning.cluster_sweep(
        embedding_vectors(spark, sf), [2, 3, 4, 5], key="vec_id"
    )


@case("m03_ordered_silhouettes")
def m03(spark, sf):
    scores = evaluate.silhouettes(
        table(spark, sf, "embeddings"), key="vec_id", vector="embedding", cluster="label"
    )
    return evaluate.ordered_silhouettes(scores, key="vec_id", cluster="label")


@case("m06_principal_components")
def m06(spark, sf):
    rows = customer_matrix(spark, sf).dropna("any")
    _, variance = learning.principal_components(rows, FEATURES)
    return variance


@case("m06_component_scores")
def m06b(spark, sf):
    rows = customer_matrix(spark, sf).dropna("any").select("c_custkey", *FEATURES)
    scores, variance = learning.principal_components(rows, FEATURES)
    # components of (nearly) no variance have no direction of their own
    clear = variance.where("ratio > 1e-9").count()
    return scores.select("c_custkey", *[f"pc{i + 1}" for i in range(clear)])


@case("m07_shuffle_control")
def m07(spark, sf):
    """The sweep, and the sweep of shuffled columns, its null case."""
    names = ["n_orders", "mean_price", "sd_price", "c_acctbal"]
    rows = customer_matrix(spark, sf).dropna("any").select("c_custkey", *names)
    scaled = learning.Scaler.fit(rows, names).apply(rows)
    mixed = learning.shuffle_columns(scaled, names, key="c_custkey", seed=12)
    sweeps = [
        learning.cluster_sweep(learning.assemble(part, names), [2, 3, 4, 5], key="c_custkey").withColumn(
            "columns", F.lit(tag)
        )
        for part, tag in ((scaled, "as they are"), (mixed, "shuffled"))
    ]
    return sweeps[0].union(sweeps[1])


# ---- regression ---------------------------------------------------------------------


def _scaled_customers(spark, sf):
    """Scaled features of every customer, and the top price as label."""
    rows = cut(customer_matrix(spark, sf).dropna("any"))
    scaled = learning.Scaler.fit(rows, FEATURES).apply(rows)
    return learning.assemble(scaled.withColumn("label", F.col("top_price")), FEATURES)


def _fitted(spark, sf, make, params):
    ready = _scaled_customers(spark, sf)
    model = make(learning.size_of(ready, "label"), params).fit(ready)
    return model.transform(ready).select("c_custkey", "label", "prediction")

_XY = """x AS (SELECT o_custkey AS key, min(o_totalprice) / 1000 AS x, max(o_totalprice) / 1000 AS y FROM orders GROUP BY 1)"""


def _one_feature(spark, sf):
    rows = order_stats(spark, sf).select(
        "key", (F.col("low") / 1000).alias("x"), (F.col("top") / 1000).alias("label")
    )
    return learning.assemble(rows, ["x"])


@case(
    "m09_ridge",
    f"""WITH {_XY}, s AS (SELECT count(*) * covar_pop(y, x) / (count(*) * var_pop(x) + 500) AS b, avg(x) AS mx, avg(y) AS my FROM x)
SELECT {R('b', 5)} AS slope, {R('my - b * mx', 3)} AS intercept FROM s""",
)
def m09(spark, sf):
    rows = _one_feature(spark, sf)
    model = learning.ridge(learning.size_of(rows, "label"), {"alpha": 500}).fit(rows)
    return spark.createDataFrame(
        [(float(model.coefficients[0]), float(model.intercept))], "b double, a double"
    ).select(tidy("b", 5).alias("slope"), tidy("a", 3).alias("intercept"))


@case("m09_ridge_all_features")
def m09_all(spark, sf):
    return _fitted(spark, sf, learning.ridge, {"alpha": 200})


@case("m10_huber")
def m10(spark, sf):
    return _fitted(spark, sf, learning.huber, {"alpha": 300})


@case("m11_regression_tree")
def m11(spark, sf):
    return _fitted(spark, sf, learning.regression_tree, {"max_depth": 4})


def _experiment(spark, sf):
    rows = customer_matrix(spark, sf)
    train, test = learning.split_rows(rows, 0.33, key="c_custkey")
    return learning.run_experiment(
        train, test, FEATURES, "top_price", *learning.REGRESSION_GRIDS["ridge"], key="c_custkey"
    )


@case("m15_experiment_scores")
def m15(spark, sf):
    return _experiment(spark, sf).scores


@case("m15_experiment_board")
def m15_board(spark, sf):
    return _experiment(spark, sf).board.drop("scores")


@case("m15_experiment_pairs")
def m15_pairs(spark, sf):
    """Actual and predicted values of the training and the test part, in order."""
    return _experiment(spark, sf).pairs


@case("m15_experiment_importance")
def m15_importance(spark, sf):
    return _experiment(spark, sf).importance


@case("m14_permutation_importance")
def m14(spark, sf):
    ready = _scaled_customers(spark, sf)
    model = learning.ridge(learning.size_of(ready, "label"), {"alpha": 200}).fit(ready)
    return learning.permutation_importance(
        model, ready.drop("features"), FEATURES, key="c_custkey", repeats=30, only_clear=False
    )


@case("m12_grid_search")
def m12(spark, sf):
    ready = _scaled_customers(spark, sf)
    _, _, board = learning.grid_search(
        ready, *learning.REGRESSION_GRIDS["tree"], key="c_custkey"
    )
    return board.drop("scores")


@case("m12_grid_search_huber")
def m12_huber(spark, sf):
    ready = _scaled_customers(spark, sf)
    _, _, board = learning.grid_search(ready, *learning.REGRESSION_GRIDS["huber"], key="c_custkey")
    return board.drop("scores")


@case(
    "d04_actual_against_predicted",
    f"""WITH {_XY}, s AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM x)
SELECT key, {R('y', 2)} AS actual, {R('a + b * x', 3)} AS predicted,
  row_number() OVER (ORDER BY y, key) - 1 AS place FROM x, s""",
)
def d04(spark, sf):
    rows = _one_feature(spark, sf)
    model = learning.ridge(learning.size_of(rows, "label"), {"alpha": 0}).fit(rows)
    pairs = model.transform(rows).select("key", "label", "prediction")
    ranked = evaluate.ordered_pairs(pairs, key="key", actual="label", predicted="prediction")
    return ranked.select(
        "key", tidy("label", 2).alias("actual"), tidy("prediction", 3).alias("predicted"),
        F.col("rank").alias("place"),
    )


# ---- classification -----------------------------------------------------------------


@case(
    "m16_gaussian_bayes",
    f"""SELECT label, i, {R('m', 5)} AS mean, {R('v', 5)} AS variance FROM (
  SELECT label, j AS i, avg(CAST(embedding[j + 1] AS DOUBLE)) AS m, var_pop(CAST(embedding[j + 1] AS DOUBLE)) AS v
  FROM embeddings, range(64) r(j) GROUP BY 1, 2)""",
)
def m16(spark, sf):
    rows = embedding_vectors(spark, sf).withColumn("label", F.col("label").cast("double"))
    model = learning.gaussian_bayes(learning.size_of(rows, "label"), {}).fit(rows)
    cells = [
        (int(c), j, float(model.theta[c, j]), float(model.sigma[c, j]))
        for c in range(model.numClasses)
        for j in range(model.numFeatures)
    ]
    out = spark.createDataFrame(cells, "label int, i bigint, m double, v double")
    return out.select("label", "i", tidy("m", 5).alias("mean"), tidy("v", 5).alias("variance"))


def _add_classifier(name: str, make, params) -> None:
    @case(name)
    def run(spark, sf):
        rows = labelled_customers(spark, sf)
        scaled = learning.Scaler.fit(rows, FEATURES).apply(rows)
        ready = learning.assemble(scaled, FEATURES)
        model = make(learning.size_of(ready, "label"), params).fit(ready)
        return model.transform(ready).select(
            "c_custkey", "label", F.col("prediction").cast("int").alias("prediction")
        )


_add_classifier("m17_logistic", learning.logistic, {"C": 10})
_add_classifier("m18_classification_tree", learning.classification_tree, {"criterion": "entropy"})
_add_classifier("m18_classification_tree_gini", learning.classification_tree, {"criterion": "gini"})
_add_classifier("m19_random_forest", learning.forest, {"criterion": "gini"})
_add_classifier("m19_random_forest_entropy", learning.forest, {"criterion": "entropy"})
for _cost in learning.CLASSIFIER_GRIDS["linear_svc"][1]["C"]:
    _mark = "" if _cost == 1.0 else f"_c{_cost:g}".replace(".", "_")
    _add_classifier(f"m21_linear_svc{_mark}", learning.linear_svc, {"C": _cost})
_add_classifier("m22_boosted_trees", learning.boosted_trees, {})


@case("m23_model_comparison")
def m23(spark, sf):
    """Ten folds of seven classes of model in all their settings, on the training part."""
    train, _ = learning.split_rows(labelled_customers(spark, sf), 0.3, key="c_custkey")
    return compare_models(train, FEATURES, key="c_custkey").drop("scores")


@case("m29_final_model_scores")
def m29(spark, sf):
    _, _, _, per_class, _ = final_model(labelled_customers(spark, sf), FEATURES, key="c_custkey")
    return per_class


# ---- robust and pooled lines --------------------------------------------------------

_POOLED = ("1996-01-01", "1997-12-31")


@case("a17_huber_lines")
def a17(spark, sf):
    return huber_lines(supplier_week(spark, sf, _POOLED), _POOLED, _POOLED[0], **_C)


def _index_series(spark, sf, span=_POOLED):
    """Supplier weeks relative to the overall level, around 1 as a yearly index is."""
    return supplier_week(spark, sf, span).withColumn("v", F.col("v") / 50000)


@case("h01_pooled_lines")
def h01(spark, sf):
    _, posterior = fit_pool(_index_series(spark, sf), _POOLED, _POOLED[0], **_C)
    return posterior.select("key", "a", "b", "var_a", "var_b", "cov_ab")


@case(
    "h02_training_slice",
    f"""WITH {SUPPLIER_WEEK} SELECT key, {R("date_diff('day', DATE '1996-01-01', t) / 7.0", 5)} AS weeks, {R('v')} AS v
FROM sw WHERE t BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
)
def h02(spark, sf):
    from ..functions.scalars import weeks_since
    rows = slice_period(supplier_week(spark, sf, _POOLED), *_POOLED, time="t")
    return rows.select("key", tidy(weeks_since("t", _POOLED[0]), 5).alias("weeks"), tidy("v").alias("v"))


@case(
    "h02_pooled_sums",
    f"""WITH {SUPPLIER_WEEK}, r AS (SELECT key, date_diff('day', DATE '1996-01-01', t) / 7.0 AS x, v / 50000 AS y FROM sw
  WHERE t BETWEEN DATE '1996-01-01' AND DATE '1997-12-31')
SELECT key, count(*)::DOUBLE AS n, {R('sum(x)', 3)} AS sx, {R('sum(x * x)', 3)} AS sxx, {R('sum(y)')} AS sy,
  {R('sum(x * y)', 3)} AS sxy, {R('sum(y * y)')} AS syy FROM r GROUP BY key""",
)
def h02b(spark, sf):
    out = pooled_sums(_index_series(spark, sf), _POOLED, _POOLED[0], **_C)
    return out.select(
        "key", "n", tidy("sx", 3).alias("sx"), tidy("sxx", 3).alias("sxx"), tidy("sy").alias("sy"),
        tidy("sxy", 3).alias("sxy"), tidy("syy").alias("syy"),
    )


@case("h03_pooled_summary")
def h03(spark, sf):
    _, posterior = fit_pool(_index_series(spark, sf), _POOLED, _POOLED[0], **_C)
    return pooled_summary(posterior, key="key")


@case("h04_predictive_band")
def h04(spark, sf):
    """Fitted on two years, predicted for every week."""
    series = _index_series(spark, sf, None)
    pool, posterior = fit_pool(series, _POOLED, _POOLED[0], **_C)
    return predictive_band(posterior, pool, _POOLED[0], key="key", time="t", periods=series)


@case("h05_band_with_actuals")
def h05(spark, sf):
    _, _, band = pooled_lines(_index_series(spark, sf, None), **_C, span=_POOLED)
    return band


@case("d03_line_clusters")
def d03(spark, sf):
    """Slope, intercept and cluster of each key with its shift between two periods."""
    from ..plans.recovery import parameter_shift
    from .aggregation import lines

    fits = lines(spark, sf)
    shifts = parameter_shift(fits, "a", "b", key="key", scaled=True).dropna("any")
    ready = learning.assemble(shifts, ["slope", "intercept"])
    names = ["key", "slope", "intercept", "slope_shift", "intercept_shift"]
    by_line = learning.cluster(ready, 3).transform(ready).select(*names, "cluster")
    moved = learning.assemble(by_line, ["slope_shift", "intercept_shift"])
    model = learning.cluster(moved, 3).named("shift_cluster")
    return model.transform(moved).select(*names, "cluster", "shift_cluster")


@case("d03_rand_of_clusterings")
def d03_rand(spark, sf):
    """How far the clusters of lines and those of their shifts agree."""
    return evaluate.adjusted_rand(d03(spark, sf), "cluster", "shift_cluster")


# a stated population level, so that the posterior has a closed form in SQL too
_LEVEL = Pool(1.0, 0.001, 0.1, 0.002, 0.5)
_LEVEL_SQL = f"""{SUPPLIER_WEEK}, r AS (SELECT key, t, date_diff('day', DATE '1996-01-01', t) / 7.0 AS x, v / 50000 AS y FROM sw
  WHERE t BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'),
s AS (SELECT key, count(*) / 0.25 + 1 / 0.01 AS p11, sum(x) / 0.25 AS p12, sum(x * x) / 0.25 + 1 / 0.000004 AS p22,
  sum(y) / 0.25 + 1.0 / 0.01 AS h1, sum(x * y) / 0.25 + 0.001 / 0.000004 AS h2 FROM r GROUP BY key),
post AS (SELECT key, (p22 * h1 - p12 * h2) / (p11 * p22 - p12 * p12) AS a, (p11 * h2 - p12 * h1) / (p11 * p22 - p12 * p12) AS b,
  p22 / (p11 * p22 - p12 * p12) AS va, p11 / (p11 * p22 - p12 * p12) AS vb, -p12 / (p11 * p22 - p12 * p12) AS c FROM s)"""


def _posterior_at_level(spark, sf):
    series = _index_series(spark, sf)
    sums = pooled_sums(series, _POOLED, _POOLED[0], **_C)
    return series, pooled_posterior(sums, _LEVEL, key="key")


@case(
    "h03_posterior_at_level",
    f"""WITH {_LEVEL_SQL} SELECT key, {R('a', 5)} AS mean_a, {R('sqrt(va)', 5)} AS sd_a,
  {R('b', 6)} AS mean_b, {R('sqrt(vb)', 6)} AS sd_b FROM post""",
)
def h03_level(spark, sf):
    _, posterior = _posterior_at_level(spark, sf)
    return pooled_summary(posterior, key="key").select(
        "key", tidy("mean_a", 5).alias("mean_a"), tidy("sd_a", 5).alias("sd_a"),
        tidy("mean_b", 6).alias("mean_b"), tidy("sd_b", 6).alias("sd_b"),
    )


@case(
    "h05_band_at_level",
    f"""WITH {_LEVEL_SQL}, g AS (SELECT k.key, d.t, date_diff('day', DATE '1996-01-01', d.t) / 7.0 AS x
  FROM (SELECT DISTINCT key FROM r) k CROSS JOIN (SELECT DISTINCT t FROM r) d)
SELECT g.key, CAST(g.t AS VARCHAR) AS t, {R('a + b * g.x', 5)} AS pred,
  {R('sqrt(0.25 + va + 2 * g.x * c + g.x * g.x * vb)', 5)} AS sigma, {R('y', 5)} AS actual
FROM g JOIN post ON g.key = post.key LEFT JOIN r ON g.key = r.key AND g.t = r.t""",
)
def h05_level(spark, sf):
    series, posterior = _posterior_at_level(spark, sf)
    used = slice_period(series, *_POOLED, time="t")
    band = predictive_band(posterior, _LEVEL, _POOLED[0], key="key", time="t", periods=used)
    out = band_with_actuals(band, used, key="key", time="t", value="v")
    return out.select(
        "key", text("t").alias("t"), tidy("pred", 5).alias("pred"), tidy("sigma", 5).alias("sigma"),
        tidy("actual", 5).alias("actual"),
    )


@case("s16_model_round_trip")
def s16(spark, sf):
    """A saved classifier, read back, labels every customer."""
    rows = labelled_customers(spark, sf)
    ready = learning.assemble(learning.Scaler.fit(rows, FEATURES).apply(rows), FEATURES)
    model = learning.gaussian_bayes(learning.size_of(ready, "label"), {}).fit(ready)
    where = staging_path(spark, "model")
    save_model(model, where)
    return load_model(where).transform(ready).select(
        "c_custkey", "label", F.col("prediction").cast("int").alias("prediction")
    )
