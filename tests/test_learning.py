import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kerbline.operators import learning as ml
from kerbline.operators.ranking import affine_place
from kerbline.plans.at_risk import at_risk_flow, compare_models, final_model, labelled_matrix
from kerbline.sources.tables import load_model, save_model


def matrix(spark, n=120, seed=0, noise=0.3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(0, noise, n)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id long, a double, b double, c double, label double")


NAMES = ["a", "b", "c"]


def test_scaler_uses_population_deviation_and_training_rows(spark):
    x, _, rows = matrix(spark)
    train, test = rows.where("id < 80"), rows.where("id >= 80")
    out = ml.Scaler.fit(train, NAMES).apply(test).orderBy("id").collect()
    want = (x[80:, 0] - x[:80, 0].mean()) / x[:80, 0].std()
    assert [r["a"] for r in out] == pytest.approx(list(want))


def test_split_is_exact_disjoint_and_repeatable(spark):
    _, _, rows = matrix(spark, n=101)
    train, test = ml.split_rows(rows, 0.33, key="id", seed=4)
    a, b = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert len(b) == 34 and not a & b and len(a | b) == 101
    again = ml.split_rows(rows.orderBy(F.desc("id")), 0.33, key="id", seed=4)[1]
    assert {r["id"] for r in again.collect()} == b
    assert {r["id"] for r in ml.split_rows(rows, 0.33, key="id", seed=5)[1].collect()} != b


def test_shuffle_keeps_columns_and_breaks_rows(spark):
    x, _, rows = matrix(spark)
    out = ml.shuffle_columns(rows.select("id", *NAMES), NAMES, key="id", seed=1).collect()
    got = np.array([[r[c] for c in NAMES] for r in out])
    assert len({r["id"] for r in out}) == 120
    for j in range(3):
        assert sorted(got[:, j]) == pytest.approx(sorted(x[:, j]))
    pairs = {tuple(r) for r in np.round(x[:, :2], 9)}
    assert sum(tuple(r) in pairs for r in np.round(got[:, :2], 9)) < 20
    whole = ml.shuffle_columns(rows.select("id", *NAMES), NAMES, key="id", seed=1, together=True).collect()
    triples = {tuple(r) for r in np.round(x, 9)}
    assert all(tuple(np.round([r[c] for c in NAMES], 9)) in triples for r in whole)


def test_ridge_matches_the_closed_form(spark):
    x, y, rows = matrix(spark)
    ready = ml.assemble(rows, NAMES)
    model = ml.ridge(ml.size_of(ready, "label"), {"alpha": 40}).fit(ready)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 40 * np.eye(3), xc.T @ yc)
    assert list(model.coefficients) == pytest.approx(list(want), abs=1e-8)


def test_logistic_matches_newton(spark):
    x, y, rows = matrix(spark)
    ready = ml.assemble(rows.withColumn("label", (F.col("label") > 0).cast("double")), NAMES)
    model = ml.logistic(ml.size_of(ready, "label"), {"C": 0.1, "max_iter": 500}).fit(ready)
    z, t, w = np.column_stack([np.ones(120), x]), (y > 0).astype(float), np.zeros(4)
    penalty = np.diag([0, 10.0, 10.0, 10.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (p - t) + penalty @ w)
    assert [model.intercept, *model.coefficients] == pytest.approx(list(w), abs=1e-3)


def test_pca_variance_matches_numpy(spark):
    x, _, rows = matrix(spark)
    scores, variance = ml.principal_components(rows.select("id", *NAMES), NAMES, 2)
    z = (x - x.mean(0)) / x.std(0)
    eig, vec = np.linalg.eigh(np.cov(z.T))
    got = [r["variance"] for r in variance.orderBy("component").collect()]
    assert got == pytest.approx(list(eig[::-1][:2]))
    mine = np.array([r["pc1"] for r in scores.orderBy("id").collect()])
    assert np.abs(mine) == pytest.approx(np.abs(z @ vec[:, -1]), abs=1e-8)


def test_clusters_and_sweep_find_separate_groups(spark):
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0], [10, 0], [0, 10]])
    x = np.vstack([c + rng.normal(0, 0.5, (20, 2)) for c in centres])
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double")
    ready = ml.assemble(rows, ["a", "b"])
    labels = ml.cluster(ready, 3, restarts=4).transform(ready).orderBy("id").collect()
    got = [r["cluster"] for r in labels]
    assert all(len(set(got[i : i + 20])) == 1 for i in (0, 20, 40)) and len(set(got)) == 3
    sweep = {r["k"]: r["silhouette"] for r in ml.cluster_sweep(ready, [2, 3], key="id", restarts=4).collect()}
    assert sweep[3] > 0.85 and sweep[3] > sweep[2]


def test_series_vectors_follow_time(spark):
    rows = spark.createDataFrame([(1, 2, 20.0), (1, 1, 10.0), (1, 3, 30.0)], "key int, t int, v double")
    out = ml.series_vectors(rows, key="key", time="t", value="v")
    assert out.select(vector_to_array("features")).first()[0] == [10.0, 20.0, 30.0]


def test_importance_ranks_the_real_features(spark):
    _, _, rows = matrix(spark)
    ready = ml.assemble(rows, NAMES)
    model = ml.ridge(ml.size_of(ready, "label"), {"alpha": 0.1}).fit(ready)
    out = ml.permutation_importance(model, rows, NAMES, key="id", repeats=10, only_clear=False).collect()
    got = {r["feature"]: r["importance"] for r in out}
    assert [r["feature"] for r in out][:2] == ["a", "b"] and abs(got["c"]) < 0.05
    # shuffling a feature of weight w costs about 2 w^2 var(x) / var(y)
    assert got["a"] == pytest.approx(2 * 4 / 5, rel=0.35)
    clear = ml.permutation_importance(model, rows, NAMES, key="id", repeats=10).collect()
    assert {r["feature"] for r in clear} <= {"a", "b"}


def test_experiment_and_grid(spark):
    _, _, rows = matrix(spark)
    train, test = ml.split_rows(rows, 0.33, key="id")
    done = ml.run_experiment(
        train, test, NAMES, "label", ml.ridge, {"alpha": [0.1, 500]}, key="id", folds=3, repeats=5
    )
    assert done.params == {"alpha": 0.1}
    assert done.scores.first()["r2"] > 0.9
    assert done.pairs.count() == 120
    places = done.pairs.where("part = 'test'").orderBy("place").collect()
    assert [r["label"] for r in places] == sorted(r["label"] for r in places)


def test_regression_grids_fit(spark):
    _, _, rows = matrix(spark, n=60)
    ready = ml.assemble(rows, NAMES)
    for make, grid in ml.REGRESSION_GRIDS.values():
        for params in (ml.expand(grid)[0], ml.expand(grid)[-1]):
            assert make(ml.size_of(ready, "label"), params).fit(ready).transform(ready).count() == 60


def test_comparison_and_final_model(spark, tmp_path):
    _, _, rows = matrix(spark, n=90)
    rows = rows.withColumn("label", F.when(F.col("label") > 1, 2).when(F.col("label") > -1, 1).otherwise(0))
    grids = {
        "logistic": (ml.logistic, {"C": [1.0]}),
        "linear_svc": (ml.linear_svc, {"C": [1.0]}),
        "boosted_trees": (ml.boosted_trees, {"rounds": [2]}),
        "random_forest": (ml.forest, {"criterion": ["gini"], "trees": [5]}),
        "k_neighbours": (ml.neighbours("id"), {"n_neighbors": [3]}),
    }
    board = compare_models(rows, NAMES, key="id", folds=2, grids=grids).collect()
    assert len(board) == 5 and [r["mean_score"] for r in board] == sorted((r["mean_score"] for r in board), reverse=True)
    assert all(len(r["scores"]) == 2 and r["mean_score"] > 0.5 for r in board)
    features, labels = rows.drop("label"), rows.select("id", "label").where("id < 80")
    flow = at_risk_flow(features, labels, NAMES, key="id", folds=2, grids={"logistic": grids["logistic"]})
    assert flow.board.count() == 1 and flow.predictions.count() == 24
    assert flow.overall.first()["accuracy"] > 0.6 and flow.per_class.count() == 3
    table = labelled_matrix(features, labels, NAMES, key="id")
    model, predicted, _, per_class, overall = final_model(table, NAMES, key="id")
    assert table.count() == 80 and predicted.count() == 24 and per_class.count() == 3
    assert overall.first()["accuracy"] > 0.6
    save_model(model, str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m"))
    ready = ml.assemble(rows, NAMES)
    assert again.transform(ready).select("prediction").collect() == model.transform(ready).select("prediction").collect()


def test_pca_leaves_constant_columns_and_gaps_out(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(20, 2))
    rows = [(i, float(a), float(b), 3.0) for i, (a, b) in enumerate(x)] + [(99, 50.0, None, 3.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    _, variance = ml.principal_components(df, NAMES)
    got = [r["variance"] for r in variance.orderBy("component").collect()]
    z = (x - x.mean(0)) / x.std(0)
    assert got == pytest.approx([*np.linalg.eigvalsh(np.cov(z.T))[::-1], 0.0], abs=1e-9)
    # the fitted projection serves other rows
    fitted = ml.Projection.fit(df.where("id < 99"), NAMES, 1)
    centre = spark.createDataFrame([(float(x[:, 0].mean()), float(x[:, 1].mean()), 3.0)], "a double, b double, c double")
    assert fitted.apply(centre).first()["pc1"] == pytest.approx(0.0, abs=1e-9)


def test_fold_of_one_label_has_no_score(spark):
    rows = [(i, float(i), 1.0 if i < 10 else float(i)) for i in range(20)]
    ready = ml.assemble(spark.createDataFrame(rows, "id long, a double, label double"), ["a"])
    candidates = [("same", ml.ridge, {"alpha": a}) for a in (10, 2, 2)]
    board = ml.cross_validate(ready, candidates, key="id", folds=2, score=ml.r2_of).collect()
    assert all(r["scores"][0] is None and r["mean_score"] == r["scores"][1] for r in board)
    # equal means keep the order of the candidates
    assert [r["candidate"] for r in board if r["params"] == "alpha=2"] == [1, 2]


def test_places_of_very_many_rows(spark):
    n, step = 4_000_000_007, (3_999_999_999, 3_999_999_998)
    got = spark.range(n - 3, n).select(affine_place("id", step, n).alias("p")).collect()
    assert [r["p"] for r in got] == [(step[0] * i + step[1]) % n for i in range(n - 3, n)]


def test_unequal_series_raise(spark):
    rows = spark.createDataFrame([(1, 1, 1.0), (1, 2, 1.0), (2, 1, 1.0)], "key int, t int, v double")
    with pytest.raises(ValueError, match="1 to 2 values"):
        ml.series_vectors(rows, key="key", time="t", value="v")


def test_experiment_by_another_score(spark):
    _, _, rows = matrix(spark)
    train, test = ml.split_rows(rows, 0.33, key="id")

    def least_error(model, df):
        return -model.transform(df).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]

    done = ml.run_experiment(
        train, test, NAMES, "label", ml.ridge, {"alpha": [500, 0.1]}, key="id", folds=2, scoring=least_error
    )
    assert done.params == {"alpha": 0.1} and done.board.first()["mean_score"] < 0
    assert done.importance.count() > 0


def test_importance_of_a_linear_model_without_its_vectors(spark):
    class Plain:
        """The same model, not known to be linear."""

        def __init__(self, model):
            self.transform = model.transform

    rng = np.random.default_rng(8)
    x = rng.normal(size=(80, 2))
    rows = spark.createDataFrame(
        [(i, float(a), float(b), float(3 * a - b + 1)) for i, (a, b) in enumerate(x)], "id long, a double, b double, label double"
    )
    ready = ml.assemble(rows, ["a", "b"])
    model = ml.ridge(ml.size_of(ready, "label"), {"alpha": 2}).fit(ready)
    both = []
    for m in (model, Plain(model)):
        out = ml.permutation_importance(m, rows, ["a", "b"], key="id", repeats=3, only_clear=False)
        both.append((out, {r["feature"]: (r["importance"], r["sd"]) for r in out.collect()}))
    for f in ("a", "b"):
        assert both[0][1][f] == pytest.approx(both[1][1][f], rel=1e-9)
    plans = [o._jdf.queryExecution().optimizedPlan().toString() for o, _ in both]
    assert "UDF(" not in plans[0] and "UDF(" in plans[1]
