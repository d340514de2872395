"""Added-up arrays, k-means runs and Gram blocks against numpy."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from kerbline.operators import learning, lloyd
from kerbline.operators.gram import block_cells, gram_blocks, ridge_board
from kerbline.operators.passes import added_up, matrix


def vectors(spark, x, **more):
    rows = [(i, list(map(float, r)), *(float(c[i]) for c in more.values())) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ["key", "x", *more]).repartition(6)
    return df.withColumn("features", array_to_vector("x"))


def test_arrays_of_all_tasks_are_added_once(spark):
    def make(batches):
        for batch in batches:
            x = matrix(batch.column("x"), batch.num_rows)
            yield {"sum": x.sum(axis=0), "n": np.array(len(x))}

    x = np.random.default_rng(0).standard_normal((500, 3))
    for parts in (1, 40, 90):
        found = added_up(vectors(spark, x).select("x").repartition(parts), make)
        assert np.allclose(found["sum"], x.sum(axis=0)) and found["n"] == 500
    assert added_up(vectors(spark, x[:1]).select("x").where("false"), make) == {}


def numpy_lloyd(x, centres, tol, rounds):
    for _ in range(rounds):
        at = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[at == c].mean(axis=0) if (at == c).any() else centres[c] for c in range(len(centres))])
        step = np.sqrt(((new - centres) ** 2).sum(axis=1)).max()
        centres = new
        if step <= tol:
            break
    return centres, ((x[:, None] - centres) ** 2).sum(axis=2).min(axis=1).sum()


def test_all_runs_as_single_ones(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.6, (60, 2)) for c in ((0, 0), (4, 0), (0, 4))])
    df = vectors(spark, x)
    runs = lloyd.lloyd_runs(df, [2, 3, 4], key="key", restarts=5, tol=1e-6)
    table = df.select("key", "x")
    starts = lloyd.random_starts(table, [2, 3, 4], 5, key="key")
    assert [r.k for r in runs] == [2] * 5 + [3] * 5 + [4] * 5
    for run, start in zip(runs, starts, strict=True):
        centres, cost = numpy_lloyd(x, start, 1e-6, 50)
        assert np.allclose(run.centres, centres) and run.cost == pytest.approx(cost)
        assert len(np.unique(start, axis=0)) == run.k
    best = lloyd.best_runs(runs)
    assert best[3].cost == min(r.cost for r in runs if r.k == 3)
    at = [r["cluster"] for r in best[3].transform(df).orderBy("key").collect()]
    assert sorted(np.bincount(at)) == [60, 60, 60] or best[3].cost < 150


def test_centroid_silhouettes_as_the_evaluator(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator

    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.8, (40, 3)) for c in (0, 3, 6)])
    df = vectors(spark, x)
    board = lloyd.cluster_sweep(df, [2, 3, 4], key="key", restarts=4).collect()
    best = lloyd.best_runs(lloyd.lloyd_runs(df, [2, 3, 4], key="key", restarts=4))
    for row in board:
        want = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(best[row["k"]].transform(df))
        assert row["silhouette"] == pytest.approx(want, abs=1e-9)
    with pytest.raises(ValueError):
        lloyd.lloyd_runs(df.limit(2), [3], key="key")


def test_starts_are_different_vectors(spark):
    x = np.array([[0.0, 0.0]] * 400 + [[float(i), 1.0] for i in range(5)])
    table = vectors(spark, x).select("key", "x")
    for key in ("key", None):
        for start in lloyd.random_starts(table, [4, 6], 3, key=key):
            assert len(np.unique(start, axis=0)) == len(start)
    with pytest.raises(ValueError):
        lloyd.random_starts(table, [7], 2)


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((200, 4)) * [1, 5, 0.1, 2] + [1000, 0, 3, -2]
    return x, x @ [1.0, -0.5, 8.0, 0.0] + rng.standard_normal(200) + 500


def test_board_as_fitted_models(spark, table):
    x, y = table
    df = vectors(spark, x, label=y)
    board, line = ridge_board(df, [0.0, 10.0, 300.0], key="key", folds=4)
    fitted = learning.cross_validate(
        df, [("ridge", learning.ridge, {"alpha": a}) for a in (0.0, 10.0, 300.0)], key="key", folds=4, score=learning.r2_of
    )
    one, two = ({r["params"]: r["scores"] for r in b.collect()} for b in (board, fitted))
    assert set(one) == set(two)
    for p in one:
        assert np.allclose(one[p], two[p], atol=1e-6)
    top = float(board.first()["params"].removeprefix("alpha="))
    model = learning.ridge(learning.size_of(df, "label"), {"alpha": top}).fit(df)
    assert np.allclose(line.coefficients, list(model.coefficients), atol=1e-6)
    got = [r["prediction"] for r in line.transform(df).orderBy("key").collect()]
    assert np.allclose(got, x @ line.coefficients + line.intercept)


def test_correlations_and_components_from_the_same_blocks(spark, table):
    x, y = table
    blocks = gram_blocks(vectors(spark, x, label=y))
    assert np.allclose(blocks.correlations(), np.corrcoef(np.concatenate([x, y[:, None]], axis=1).T), atol=1e-9)
    values, vectors_ = blocks.components()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1])
    assert np.allclose((z @ vectors_).var(axis=0, ddof=1), values)
    whole = np.concatenate([np.ones((200, 1)), x, y[:, None]], axis=1)
    cells = block_cells(spark, blocks).collect()
    assert len(cells) == 21
    for r in cells:
        assert r["value"] == pytest.approx((whole[:, r["i"]] * whole[:, r["j"]]).sum(), rel=1e-9)


def test_flat_fold_has_no_score(spark):
    x, y = np.arange(8.0)[:, None], np.array([1, 1, 1, 1, 2, 3, 4, 5.0])
    board, _ = ridge_board(vectors(spark, x, label=y), [1.0], key="key", folds=2)
    assert board.first()["scores"][0] is None and board.first()["scores"][1] is not None
    with pytest.raises(ValueError):
        gram_blocks(vectors(spark, x, label=y).limit(0))
