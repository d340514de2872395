"""Scaling, splitting, clustering, regression and classification on tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import gram, lloyd
from .blocks import knn_classify
from .evaluate import regression_scores, silhouettes_of
from .projection import quoted
from .ranking import affine_place, affine_steps, rank_rows, tile_of

# ---- features -----------------------------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    """Column means and population deviations, learnt from one table."""

    stats: Mapping[str, tuple[float, float]]

    @staticmethod
    def fit(df: DataFrame, names: Sequence[str]) -> Scaler:
        row = df.agg(
            *[F.avg(F.col(quoted(c))).alias(f"m{i}") for i, c in enumerate(names)],
            *[F.stddev_pop(F.col(quoted(c))).alias(f"s{i}") for i, c in enumerate(names)],
        ).first()
        return Scaler({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(names)})

    def apply(self, df: DataFrame, *, centre: bool = True) -> DataFrame:
        """Scaled columns; a constant column is only centred."""
        def scaled(name: str) -> Column:
            mean, sd = self.stats[name]
            shift = F.lit(mean if centre else 0.0)
            return (F.col(quoted(name)) - shift) / F.lit(sd if sd else 1.0)

        return df.withColumns({c: scaled(c) for c in self.stats})


def assemble(df: DataFrame, names: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector next to the other columns; rows with a null feature are left out."""
    whole = df.dropna("any", subset=list(names))
    return VectorAssembler(inputCols=list(names), outputCol=out).transform(whole)


def series_vectors(
    df: DataFrame, *, key: str, time: str, value: str, out: str = "features"
) -> DataFrame:
    """One vector per key, ordered by period; keys of unequal length raise an error.

    A key's values come from distinct periods; a repeated one raises an error too.
    """
    points = F.sort_array(F.collect_list(F.struct(F.col(time).alias("_t"), F.col(value).alias("_v"))))
    vectors = cut(df.groupBy(key).agg(points.alias("_p")))
    repeats = F.size("_p") - F.size(F.array_distinct("_p._t"))
    shortest, longest, most = vectors.agg(
        F.min(F.size("_p")), F.max(F.size("_p")), F.max(repeats)
    ).first()
    if shortest != longest:
        raise ValueError(f"series of {shortest} to {longest} values have no common vector space")
    if most:
        raise ValueError(f"a series repeats {most} of its periods")
    return vectors.select(key, array_to_vector("_p._v").alias(out))


# ---- splits -------------------------------------------------------------------------


def split_rows(
    df: DataFrame, test_share: float, *, key: str, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Exact-size random split, the same for the same keys and seed."""
    ranked = rank_rows(
        df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))), ["_h", key], rank="_r"
    )
    n_test = math.ceil(ranked.n * test_share)
    rows = ranked.df.drop("_h")
    return (
        rows.where(F.col("_r") >= n_test).drop("_r"),
        rows.where(F.col("_r") < n_test).drop("_r"),
    )


def with_folds(df: DataFrame, folds: int, *, key: str, out: str = "fold") -> DataFrame:
    """Contiguous folds of equal size in key order."""
    ranked = rank_rows(df, [key], rank="_r")
    return ranked.df.withColumn(out, tile_of(F.col("_r"), ranked.n, folds)).drop("_r")


def shuffle_columns(
    df: DataFrame, names: Sequence[str], *, key: str, seed: int = 0, together: bool = False
) -> DataFrame:
    """Permute columns against their rows: each one on its own, or all ``together``.

    Rows are numbered in the order of a seeded hash. Each column then moves from row i to
    row (a*i + b) mod n, a permutation that needs no further sort; one shuffle brings the
    columns together again.
    """
    ranked = rank_rows(
        df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))), ["_h", key], rank="_r"
    )
    n = ranked.n
    if n == 0:
        return df
    steps = affine_steps(n, 1 if together else len(names), seed)
    steps = steps * len(names) if together else steps
    moved = F.array(
        F.struct(
            F.col("_r").alias("_to"), F.lit(-1).alias("_c"), F.lit(None).cast("double").alias("_v")
        ),
        *[
            F.struct(
                affine_place("_r", step, n).alias("_to"),
                F.lit(i).alias("_c"),
                F.col(quoted(c)).cast("double").alias("_v"),
            )
            for i, (c, step) in enumerate(zip(names, steps))
        ],
    )
    cells = ranked.df.select(key, F.explode(moved).alias("_m")).select(key, "_m.*")
    return (
        cells.groupBy("_to")
        .agg(
            F.max(F.when(F.col("_c") == -1, F.col(key))).alias(key),
            *[F.max(F.when(F.col("_c") == i, F.col("_v"))).alias(c) for i, c in enumerate(names)],
        )
        .drop("_to")
    )


# ---- clustering ---------------------------------------------------------------------


def cluster(
    df: DataFrame,
    k: int,
    *,
    features: str = "features",
    restarts: int = 10,
    max_iter: int = 50,
    tol: float = 1e-2,
    seed: int = 0,
    start: str = "random",
) -> lloyd.Centres:
    """K-means from ``random`` or spread-out (``k-means||``) starts; the lowest cost wins.

    All restarts from random rows run side by side.
    """
    if start == "random":
        runs = lloyd.lloyd_runs(
            df, [k], features=features, restarts=restarts, max_iter=max_iter, tol=tol, seed=seed
        )
        return lloyd.best_runs(runs)[k]
    kept = df.select(features).persist()
    try:
        best = None
        for i in range(restarts):
            model = KMeans(
                k=k, initMode=start, maxIter=max_iter, tol=tol, seed=seed + i,
                featuresCol=features, predictionCol="cluster",
            ).fit(kept)
            if best is None or model.summary.trainingCost < best.summary.trainingCost:
                best = model
        centres = np.array(best.clusterCenters())
        return lloyd.Centres(k, centres, best.summary.trainingCost, best.summary.numIter, features)
    finally:
        kept.unpersist()


def cluster_sweep(
    df: DataFrame, ks: Sequence[int], *, key: str, features: str = "features",
    exact: bool = False, restarts: int = 10, seed: int = 0, start: str = "random",
) -> DataFrame:
    """(k, silhouette) for each k, by squared distances to centroids.

    ``exact=True`` compares every row with every other, which is quadratic.
    """
    if not exact and start == "random":
        # all numbers of clusters and restarts side by side
        board = lloyd.cluster_sweep(df, ks, key=key, features=features, restarts=restarts, seed=seed)
        return board.select("k", "silhouette")
    table = cut(df.select(key, features))
    if start == "random":
        models = lloyd.best_runs(lloyd.lloyd_runs(table, ks, features=features, restarts=restarts, seed=seed))
    else:
        models = {k: cluster(table, k, features=features, restarts=restarts, seed=seed, start=start) for k in ks}
    if not exact:
        points = table.select(vector_to_array(features).alias("x"))
        rows = list(zip(ks, lloyd.centroid_silhouettes(points, [models[k] for k in ks]), strict=True))
        return df.sparkSession.createDataFrame(rows, "k int, silhouette double")
    labelled = table.withColumn("_x", vector_to_array(features))
    for i, k in enumerate(ks):
        labelled = models[k].named(f"_k{i}").transform(labelled)
    names = [f"_k{i}" for i in range(len(ks))]
    scores = silhouettes_of(labelled.select(key, "_x", *names), key=key, vector="_x", clusters=names)
    means = scores.groupBy("which").agg(F.avg("silhouette").alias("silhouette")).collect()
    known = {r["which"]: r["silhouette"] for r in means}
    rows = [(k, known.get(i)) for i, k in enumerate(ks)]
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


@dataclass(frozen=True)
class Projection:
    """Standardised columns on principal components, learnt from one table."""

    scaler: Scaler
    model: PCAModel
    names: Sequence[str]
    variances: Sequence[float]

    @staticmethod
    def fit(df: DataFrame, names: Sequence[str], k: int | None = None) -> Projection:
        """``k`` components (all without it) of the rows that have every column."""
        whole = cut(df.select(*[F.col(quoted(c)) for c in names]).dropna("any"))
        scaler = Scaler.fit(whole, names)
        n = whole.count()
        k = k or len(names)
        model = PCA(k=k, inputCol="features", outputCol="_pc").fit(assemble(scaler.apply(whole), names))
        # a column scaled by its population deviation has the sample variance n / (n - 1),
        # a constant one has none
        varying = sum(1 for _, sd in scaler.stats.values() if sd)
        total = varying * n / (n - 1) if n > 1 else 0.0
        return Projection(scaler, model, list(names), [float(v) * total for v in model.explainedVariance])

    def apply(self, df: DataFrame) -> DataFrame:
        """Columns pc1, pc2, ... of any rows that have the columns."""
        scaled = self.model.transform(assemble(self.scaler.apply(df), self.names))
        parts = vector_to_array("_pc")
        named = [parts[i].alias(f"pc{i + 1}") for i in range(len(self.variances))]
        return scaled.select(*[F.col(quoted(c)) for c in df.columns], *named)


def principal_components(
    df: DataFrame, names: Sequence[str], k: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Scores of the standardised columns on k components, and the variance of each.

    Rows with a missing column are left out before anything is learnt. The sign of a
    component is arbitrary.
    """
    fitted = Projection.fit(df, names, k)
    ratios = [float(v) for v in fitted.model.explainedVariance]
    variance = df.sparkSession.createDataFrame(
        [(i + 1, v, r) for i, (v, r) in enumerate(zip(fitted.variances, ratios))],
        "component int, variance double, ratio double",
    )
    return fitted.apply(df), variance


# ---- estimators with the penalties of the analyses ----------------------------------


@dataclass(frozen=True)
class Size:
    """Facts about a training table that some penalties depend on."""

    n: int
    sd_y: float


def size_of(df: DataFrame, label: str) -> Size:
    row = df.agg(F.count(F.lit(1)), F.stddev_pop(F.col(label).cast("double"))).first()
    return Size(row[0], row[1] or 0.0)


Maker = Callable[[Size, Mapping[str, object]], Estimator]


def ridge(size: Size, p: Mapping) -> Estimator:
    """Sum of squared errors plus ``alpha`` times the squared coefficients."""
    return LinearRegression(
        solver="normal", elasticNetParam=0.0, standardization=False,
        regParam=float(p["alpha"]) * size.sd_y / size.n, labelCol="label",
    )


def huber(size: Size, p: Mapping) -> Estimator:
    return LinearRegression(
        loss="huber", epsilon=float(p.get("epsilon", 1.35)), standardization=False,
        regParam=float(p["alpha"]) / size.n, maxIter=int(p.get("max_iter", 100)), labelCol="label",
    )


def regression_tree(size: Size, p: Mapping) -> Estimator:
    return DecisionTreeRegressor(maxDepth=int(p["max_depth"]), labelCol="label", seed=0)


def logistic(size: Size, p: Mapping) -> Estimator:
    return LogisticRegression(
        regParam=1.0 / (float(p["C"]) * size.n), elasticNetParam=0.0, standardization=False,
        maxIter=int(p.get("max_iter", 150)), family=str(p.get("family", "auto")), labelCol="label",
    )


def gaussian_bayes(size: Size, p: Mapping) -> Estimator:
    return NaiveBayes(modelType="gaussian", labelCol="label")


def classification_tree(size: Size, p: Mapping) -> Estimator:
    return DecisionTreeClassifier(impurity=str(p["criterion"]), labelCol="label", seed=0)


def forest(size: Size, p: Mapping) -> Estimator:
    return RandomForestClassifier(
        impurity=str(p["criterion"]), numTrees=int(p.get("trees", 100)), labelCol="label", seed=0
    )


def linear_svc(size: Size, p: Mapping) -> Estimator:
    """One-against-rest linear separators (the kernel form has no distributed solver)."""
    base = LinearSVC(
        regParam=1.0 / (float(p["C"]) * size.n), standardization=False,
        tol=float(p.get("tol", 1e-3)), maxIter=int(p.get("max_iter", 100)),
    )
    return OneVsRest(classifier=base, labelCol="label", parallelism=4)


def boosted_trees(size: Size, p: Mapping) -> Estimator:
    base = GBTClassifier(maxIter=int(p.get("rounds", 20)), seed=0)
    return OneVsRest(classifier=base, labelCol="label", parallelism=4)


class Neighbours:
    """k nearest neighbours in the place of an estimator."""

    def __init__(self, k: int, key: str):
        self.k, self.key, self.train = k, key, None

    def fit(self, df: DataFrame) -> Neighbours:
        self.train = df.select(self.key, "label", vector_to_array("features").alias("_x"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        rows = df.select(self.key, vector_to_array("features").alias("_x"))
        called = knn_classify(rows, self.train, self.k, key=self.key, vector="_x", label="label")
        return df.join(called, self.key)


def neighbours(key: str) -> Maker:
    return lambda size, p: Neighbours(int(p["n_neighbors"]), key)


# The grids the analyses search.
NEIGHBOUR_GRID = {"n_neighbors": [3, 5]}
REGRESSION_GRIDS = {
    "ridge": (ridge, {"alpha": [200, 300, 400, 500, 600, 700, 800, 900]}),
    "huber": (huber, {"alpha": [300, 400, 600], "epsilon": [1.35]}),
    "tree": (regression_tree, {"max_depth": [2, 4, 6, 8]}),
}
CLASSIFIER_GRIDS = {
    "logistic": (logistic, {"C": [0.01, 0.1, 1.0, 10.0]}),
    "decision_tree": (classification_tree, {"criterion": ["gini", "entropy"]}),
    "random_forest": (forest, {"criterion": ["gini", "entropy"]}),
    "naive_bayes": (gaussian_bayes, {}),
    "linear_svc": (linear_svc, {"C": [0.01, 0.1, 1.0, 10.0]}),
    "boosted_trees": (boosted_trees, {}),
}


def expand(grid: Mapping[str, Sequence]) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values)) for values in product(*[grid[n] for n in names])]


def r2_of(model: Model, df: DataFrame) -> float:
    out = model.transform(df)
    return regression_scores(out, actual="label", predicted="prediction").first()["r2"]


def accuracy_of(model: Model, df: DataFrame) -> float:
    hit = (F.col("label").cast("double") == F.col("prediction")).cast("double")
    return model.transform(df).agg(F.avg(hit)).first()[0]


def cross_validate(
    df: DataFrame,
    candidates: Sequence[tuple[str, Maker, Mapping]],
    *,
    key: str,
    folds: int,
    score: Callable[[Model, DataFrame], float],
    parallelism: int = 4,
) -> DataFrame:
    """Score of every candidate on every fold, then mean and population deviation.

    ``df`` holds ``key``, ``features`` and ``label``; folds are contiguous in key order.
    Returns (model, params, scores, mean_score, sd_score, candidate), best mean first, ties
    in the order of the candidates. Folds without a score are NULL and do not count.
    """
    spark = df.sparkSession
    table = cut(with_folds(df.select(key, "features", "label"), folds, key=key))
    parts = [
        (table.where(F.col("fold") != f), table.where(F.col("fold") == f)) for f in range(folds)
    ]
    sizes = [size_of(train, "label") for train, _ in parts]

    def run(job: tuple[int, int]) -> float | None:
        which, fold = job
        _, make, params = candidates[which]
        train, test = parts[fold]
        return score(make(sizes[fold], params).fit(train), test)

    jobs = list(product(range(len(candidates)), range(folds)))
    with ThreadPoolExecutor(parallelism) as pool:
        got = dict(zip(jobs, pool.map(run, jobs)))
    rows = []
    for i, (name, _, params) in enumerate(candidates):
        scores = [got[(i, f)] for f in range(folds)]
        # a fold whose labels are all alike has no score
        known = [float(s) for s in scores if s is not None]
        mean = sum(known) / len(known) if known else None
        sd = math.sqrt(sum((s - mean) ** 2 for s in known) / len(known)) if known else None
        shown = ",".join(f"{k}={v}" for k, v in sorted(params.items()))
        rows.append((name, shown, [None if s is None else float(s) for s in scores], mean, sd, i))
    rows.sort(key=lambda r: (r[3] is None, -(r[3] or 0.0), r[0], r[5]))
    return spark.createDataFrame(
        rows,
        "model string, params string, scores array<double>, mean_score double, sd_score double, "
        "candidate int",
    )


def grid_candidates(grids: Mapping[str, tuple[Maker, Mapping]]) -> list[tuple[str, Maker, dict]]:
    return [(name, make, p) for name, (make, grid) in grids.items() for p in expand(grid)]


def grid_search(
    df: DataFrame,
    make: Maker,
    grid: Mapping[str, Sequence],
    *,
    key: str,
    folds: int = 5,
    score: Callable[[Model, DataFrame], float] = r2_of,
    parallelism: int = 4,
) -> tuple[Model, dict, DataFrame]:
    """Cross-validate a grid, then fit the best setting on all rows."""
    options = expand(grid)
    df = cut(df)
    if make is ridge and score is r2_of:
        # all penalties and folds from one pass over the rows
        board, line = gram.ridge_board(df, [p["alpha"] for p in options], key=key, folds=folds)
        return line, options[board.first()["candidate"]], board
    named = [(make.__name__, make, p) for p in options]
    board = cross_validate(df, named, key=key, folds=folds, score=score, parallelism=parallelism)
    best = options[board.first()["candidate"]]
    model = make(size_of(df, "label"), best).fit(df)
    return model, best, board


def permutation_importance(
    model: Model,
    df: DataFrame,
    names: Sequence[str],
    *,
    key: str,
    label: str = "label",
    repeats: int = 30,
    seed: int = 0,
    only_clear: bool = True,
) -> DataFrame:
    """Loss of R2 when a feature is shuffled: mean and population deviation per feature.

    All repeats and features go through the model in one job: a row of every repeat meets
    the donor row its permutation names, and yields one feature vector per feature; with a
    linear model it yields one error per feature, whose vectors need not be made.
    ``only_clear`` keeps features whose mean exceeds two deviations.
    """
    cols = [F.col(quoted(c)).cast("double") for c in names]
    ranked = rank_rows(
        df.dropna("any", subset=list(names) + [label])
        .select(key, F.col(label).cast("double").alias("label"), F.array(*cols).alias("_x"))
        .withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))),
        ["_h", key],
        rank="_r",
    )
    n = ranked.n
    rows = ranked.df.select("_r", "label", "_x")
    steps = affine_steps(n, repeats, seed)
    draws = F.array(
        *[
            F.struct(
                F.lit(i).alias("rep"),
                affine_place("_r", step, n).alias("_from"),
            )
            for i, step in enumerate(steps)
        ]
    )
    donors = rows.select(F.col("_r").alias("_from"), F.col("_x").alias("_dx"))
    paired = (
        rows.select("_r", "label", "_x", F.explode(draws).alias("_d"))
        .select("_r", "label", "_x", "_d.*")
        .join(donors, "_from")
    )
    unshuffled = r2_of(model, rows.select("label", array_to_vector("_x").alias("features")))
    if isinstance(model, (LinearRegressionModel, gram.Line)):
        # one feature moves the prediction by its weight alone
        weights = [float(w) for w in model.coefficients]
        fitted = sum((F.lit(w) * F.col("_x")[i] for i, w in enumerate(weights)), F.lit(float(model.intercept)))
        errors = paired.select(
            "rep", "label", (F.col("label") - fitted).alias("_e"),
            *[(F.lit(w) * (F.col("_dx")[i] - F.col("_x")[i])).alias(f"_m{i}") for i, w in enumerate(weights)],
        )
        lost = [F.avg((F.col("_e") - F.col(f"_m{i}")) ** 2).alias(f"_l{i}") for i in range(len(names))]
        known = errors.groupBy("rep").agg(F.var_pop("label").alias("_var"), *lost)
        cells = F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_l{i}").alias("_l")) for i, c in enumerate(names)])
        )
        per = known.select("rep", "_var", cells.alias("_c")).select(
            "_c.feature", "rep", (1 - F.try_divide("_c._l", "_var")).alias("r2")
        )
    else:
        swapped = F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    array_to_vector(
                        F.array(*[(F.col("_dx") if j == i else F.col("_x"))[j] for j in range(len(names))])
                    ).alias("features"),
                )
                for i, c in enumerate(names)
            ]
        )
        trials = paired.select("rep", "label", F.explode(swapped).alias("_s")).select("rep", "label", "_s.*")
        err = F.col("label") - F.col("prediction")
        per = (
            model.transform(trials)
            .groupBy("feature", "rep")
            .agg((1 - F.try_divide(F.avg(err * err), F.var_pop("label"))).alias("r2"))
        )
    out = per.groupBy("feature").agg(
        F.avg(F.lit(unshuffled) - F.col("r2")).alias("importance"),
        F.stddev_pop("r2").alias("sd"),
    )
    if only_clear:
        out = out.where(F.col("importance") - 2 * F.col("sd") > 0)
    return out.orderBy(F.col("importance").desc(), "feature")


@dataclass(frozen=True)
class Experiment:
    """What one modelling run leaves behind; the importance is worked out when asked for."""

    model: Model
    params: dict
    board: DataFrame
    scores: DataFrame
    pairs: DataFrame
    explain: Callable[[], DataFrame]

    @property
    def importance(self) -> DataFrame:
        return self.explain()


def run_experiment(
    train: DataFrame,
    test: DataFrame,
    names: Sequence[str],
    label: str,
    make: Maker,
    grid: Mapping[str, Sequence],
    *,
    key: str,
    folds: int = 5,
    repeats: int = 30,
    scoring: Callable[[Model, DataFrame], float] = r2_of,
) -> Experiment:
    """Scale on the training rows, search a grid by ``scoring``, score and explain the winner."""
    scaler = Scaler.fit(train, names)

    def prepare(df: DataFrame) -> DataFrame:
        wanted = df.select(key, *names, F.col(label).cast("double").alias("label"))
        return assemble(scaler.apply(wanted.dropna("any")), names)

    tr, te = cut(prepare(train)), cut(prepare(test))
    model, best, board = grid_search(tr, make, grid, key=key, folds=folds, score=scoring)
    shown = [
        model.transform(part).select(key, F.lit(tag).alias("part"), "label", "prediction")
        for part, tag in ((tr, "train"), (te, "test"))
    ]
    tagged = shown[0].unionByName(shown[1])
    ranked = rank_rows(tagged, ["part", "label", key], rank="place").df
    scores = regression_scores(shown[1], actual="label", predicted="prediction")

    def explain() -> DataFrame:
        return permutation_importance(model, te.drop("features"), names, key=key, repeats=repeats)

    return Experiment(model, best, board, scores, ranked, explain)
