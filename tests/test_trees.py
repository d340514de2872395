"""Binned trees, forests and boosting against small numpy versions that try every split."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kerbline.operators.trees import (
    CRITERIA,
    ClassForest,
    RegressionTree,
    SoftmaxBoosting,
    draws,
    feature_bins,
    softmax,
    tree_family,
    tree_grid,
)


def vectors(spark, x, y, **more):
    rows = [(i, list(map(float, r)), float(v), *(int(c[i]) for c in more.values())) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["key", "x", "label", *more]).repartition(5)
    return df.withColumn("features", array_to_vector("x")).drop("x")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    x = np.stack([rng.integers(0, 12, 160), rng.integers(0, 3, 160), rng.integers(0, 30, 160) / 4], axis=1).astype(float)
    y = np.round(np.where(x[:, 0] > 5, 10, 2) + 3 * (x[:, 1] == 1) * x[:, 2] + rng.standard_normal(160), 1)
    return x, y


def loss(y, criterion):
    if criterion == "absolute_error":
        return np.abs(y - np.median(y)).sum()
    if criterion in ("gini", "entropy"):
        p = np.unique(y, return_counts=True)[1] / len(y)
        return len(y) * (1 - (p**2).sum() if criterion == "gini" else -(p * np.log2(p)).sum())
    return ((y - y.mean()) ** 2).sum()


def exhaustive(x, y, depth, criterion):
    """Nested (feature, edge, left, right) or the value of a leaf."""
    value = np.median(y) if criterion == "absolute_error" else y.mean()
    whole = loss(y, criterion)
    if not depth or whole <= 1e-12 * len(y):
        return value
    tried = []
    for f in range(x.shape[1]):
        for edge in np.unique(x[:, f])[:-1]:
            low = x[:, f] <= edge
            tried.append((whole - loss(y[low], criterion) - loss(y[~low], criterion), f, edge))
    if not tried:
        return value
    best = max(t[0] for t in tried)
    _, f, edge = next(t for t in tried if round(t[0] / max(best, 1e-9 * whole), 9) == round(best / max(best, 1e-9 * whole), 9))
    low = x[:, f] <= edge
    return f, edge, exhaustive(x[low], y[low], depth - 1, criterion), exhaustive(x[~low], y[~low], depth - 1, criterion)


def predicted(tree, x):
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, edge, left, right = tree
    return np.where(x[:, f] <= edge, predicted(left, x), predicted(right, x))


@pytest.mark.parametrize("criterion", CRITERIA)
def test_regression_trees_try_every_split(spark, data, criterion):
    x, y = data
    df = vectors(spark, x, y)
    deep = tree_family(df, [2, 4, 6], [criterion], key="key")[criterion][0]
    for depth in (2, 4, 6):
        model = type(deep)(deep.bins, deep.tree, deep.criterion, deep.shift, depth)
        got = np.array([r["prediction"] for r in model.transform(df).orderBy("key").collect()])
        assert np.allclose(got, predicted(exhaustive(x, y, depth, criterion), x), atol=1e-9), depth
    nodes = deep.nodes(spark).toPandas()
    leaves = deep.transform(df).groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("m")).toPandas()
    joined = leaves.merge(nodes, left_on="leaf", right_on="node")
    assert (joined.n == joined["rows"]).all() and (joined.feature == -1).all() and joined.n.sum() == len(y)


def test_friedman_gain_is_the_squared_error_removed(spark, data):
    df = vectors(spark, *data)
    one, other = (RegressionTree("key", 4, c).fit(df).nodes(spark).toPandas() for c in ("squared_error", "friedman_mse"))
    assert np.allclose(one.gain, other.gain) and (one.feature == other.feature).all()


def test_grid_equals_single_fits_by_fold(spark, data):
    x, y = data
    board = {
        (r["criterion"], r["max_depth"]): r["scores"]
        for r in tree_grid(vectors(spark, x, y), [2, 4], key="key", folds=4).collect()
    }
    assert len(board) == 6
    for (criterion, depth), scores in board.items():
        for f, part in enumerate(np.array_split(np.arange(len(y)), 4)):
            rest = np.setdiff1d(np.arange(len(y)), part)
            guess = predicted(exhaustive(x[rest], y[rest], depth, criterion), x[part])
            want = 1 - ((y[part] - guess) ** 2).sum() / ((y[part] - y[part].mean()) ** 2).sum()
            assert scores[f] == pytest.approx(want, abs=1e-9)


def test_unknown_criterion_and_flat_label(spark, data):
    df = vectors(spark, data[0], np.ones(len(data[1])))
    assert {r["prediction"] for r in RegressionTree("key", 3).fit(df).transform(df).collect()} == {1.0}
    with pytest.raises(ValueError):
        RegressionTree("key", 3, "poisson").fit(df)


def test_few_bins_cut_at_quantiles(spark):
    x = np.arange(1000.0)[:, None]
    df = vectors(spark, x, x[:, 0])
    (edges,) = feature_bins(df, bins=10).edges
    assert np.abs(np.array(edges) - np.arange(99, 999, 100)).max() <= 1
    coarse = RegressionTree("key", 1, bins=10).fit(df)
    assert 390 <= coarse.nodes(spark).orderBy("node").first()["edge"] <= 600


@pytest.mark.parametrize("criterion", ["gini", "entropy"])
def test_class_trees_try_every_split(spark, data, criterion):
    x, y = data
    labels = np.digitize(y, np.quantile(y, [0.25, 0.5, 0.75]))
    df = vectors(spark, x, labels)
    model = ClassForest("key", criterion, max_depth=4).fit(df)
    rows = model.transform(df).orderBy("key").collect()

    def shares(x, y, depth):
        tree = exhaustive(x, y, 1, criterion) if depth else None
        if not isinstance(tree, tuple):
            return {tuple(map(tuple, x)): np.bincount(y, minlength=4) / len(y)} if len(x) else {}
        low = x[:, tree[0]] <= tree[1]
        return shares(x[low], y[low], depth - 1) | shares(x[~low], y[~low], depth - 1)

    want = {}
    for points, p in shares(x, labels, 4).items():
        want |= {point: p for point in points}
    for r, point in zip(rows, x, strict=True):
        assert np.allclose(r["probability"], want[tuple(point)])
        assert r["prediction"] == np.argmax(r["probability"])


def test_forest_is_seeded_and_better_than_chance(spark, data):
    x, y = data
    labels = np.digitize(y, np.quantile(y, [0.5]))
    df = vectors(spark, x, labels)
    one, two = (ClassForest("key", trees=12, max_depth=4, seed=3).fit(d).transform(df).orderBy("key").collect() for d in (df, df.repartition(3)))
    assert [r["probability"] for r in one] == [r["probability"] for r in two]
    assert np.mean([r["prediction"] == v for r, v in zip(one, labels)]) > 0.8
    drawn = draws(np.arange(200_000), 5)
    assert drawn.mean() == pytest.approx(1, abs=0.01) and drawn.var() == pytest.approx(1, abs=0.02)


def boosted(x, y, classes, rounds, depth, rate=0.3, l2=1.0, least=1.0):
    """Margins of second-order boosting, every split tried."""
    margins = np.zeros((len(x), classes))

    def step(rows, g, h, left_depth, out):
        G, H = g[rows].sum(), h[rows].sum()
        best = None
        for f in range(x.shape[1]):
            for edge in np.unique(x[:, f])[:-1]:
                low = x[rows, f] <= edge
                hl, hr = h[rows][low].sum(), h[rows][~low].sum()
                if not low.any() or low.all() or hl < least or hr < least:
                    continue
                gl = g[rows][low].sum()
                gain = gl**2 / (hl + l2) + (G - gl) ** 2 / (hr + l2) - G**2 / (H + l2)
                if best is None or gain > best[0] * (1 + 1e-9):
                    best = gain, f, edge
        if not left_depth or best is None or best[0] <= 1e-6:
            out[rows] = -rate * G / (H + l2)
            return
        low = x[rows, best[1]] <= best[2]
        step(rows[low], g, h, left_depth - 1, out)
        step(rows[~low], g, h, left_depth - 1, out)

    for _ in range(rounds):
        p = softmax(margins)
        add = np.zeros_like(margins)
        for k in range(classes):
            step(np.arange(len(x)), p[:, k] - (y == k), 2 * p[:, k] * (1 - p[:, k]), depth, add[:, k])
        margins += add
    return margins


def test_boosting_as_every_split_tried(spark, data):
    x, y = data
    labels = np.digitize(y, np.quantile(y, [0.3, 0.7]))
    fold = np.arange(len(y)) % 2
    df = vectors(spark, x, labels, fold=fold)
    models = SoftmaxBoosting("key", rounds=5, max_depth=3, carry=2).fit_folds(df, 2)
    rows = models[0].transform(df).orderBy("key").collect()
    want = softmax(boosted(x, labels, 3, 5, 3))
    assert np.allclose([r["probability"] for r in rows], want, atol=1e-9)
    half = fold == 1
    got = softmax(models[1].margins(models[1].bins.codes(x[half])))
    assert np.allclose(got, softmax(boosted(x[half], labels[half], 3, 5, 3)), atol=1e-9)


def test_nodes_in_bounded_blocks_grow_the_same_trees(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector

    from kerbline.operators import trees

    rng = np.random.default_rng(8)
    x = rng.integers(0, 12, (400, 4)).astype(float)
    rows = [(i, r.tolist(), float(int(r[0] + r[1] * r[2]) % 3)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "key long, x array<double>, label double").withColumn("features", array_to_vector("x"))
    grown = []
    for cells in (1 << 22, 1 << 8):
        # one block, and blocks of less nodes than a tree has
        monkeypatch.setattr(trees, "_CELLS", cells)
        model = trees.ClassForest("key", trees=3, max_depth=3).fit(df)
        grown.append([(t.feature, t.upto, [a.tolist() for a in t.totals]) for t in model.trees])
    assert grown[0] == grown[1]


def test_nodes_that_meet_once_split_as_their_cells_do(spark, monkeypatch):
    from kerbline.operators import trees

    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, (300, 3)).astype(float)
    rows = vectors(spark, x, (x[:, 0] > 4) + 1.0 * (x[:, 1] > 6))
    once = trees.SoftmaxBoosting("key", rounds=1, max_depth=2).fit(rows).rounds
    monkeypatch.setattr(trees, "_at_once", trees._by_cells)
    cells = trees.SoftmaxBoosting("key", rounds=1, max_depth=2).fit(rows).rounds
    for (a, steps), (b, others) in zip(once[0], cells[0], strict=True):
        assert (a.feature, a.upto, a.left) == (b.feature, b.upto, b.left) and len(a.feature) > 1
        assert list(steps) == pytest.approx(list(others))
        # the sums of nodes stay with the driver
        assert not a.shape().totals and (a.shape().leaves(np.zeros((1, 3), int)) == a.leaves(np.zeros((1, 3), int))).all()


def test_held_rows_boost_in_few_jobs_as_passes_do(spark, monkeypatch):
    from kerbline.operators import trees

    rng = np.random.default_rng(6)
    x = rng.integers(0, 30, (500, 3)).astype(float)
    label = (x[:, 0] > 9) + 1.0 * (x[:, 1] + rng.integers(0, 9, 500) > 20)
    # keys come twice, and the folds are uneven
    df = vectors(spark, x, label, fold=rng.integers(0, 5, 500) // 3).withColumn("key", F.col("key") % 400)
    boosting = trees.SoftmaxBoosting("key", rounds=6, max_depth=4, carry=4)
    sc = spark.sparkContext

    def fit(group):
        sc.setJobGroup(group, group)
        models = boosting.fit_folds(df, 2)
        sc.setJobGroup("others", "others")
        return models, len(sc.statusTracker().getJobIdsForGroup(group))

    held, few = fit("held")
    # so that no rows are held
    monkeypatch.setattr(trees, "_HELD", 0, raising=False)
    passes, many = fit("passes")
    # a pass for each of 24 levels is at least a job
    assert few <= 24 <= many - 20
    assert len(held) == len(passes) == 3
    for a, b in zip(held, passes, strict=True):
        assert np.array_equal(a.start, b.start)
        for ones, others in zip(a.rounds, b.rounds, strict=True):
            for (one, steps), (other, wanted) in zip(ones, others, strict=True):
                assert (one.feature, one.upto, one.left, one.depth) == (other.feature, other.upto, other.left, other.depth)
                assert np.allclose(steps, wanted, atol=1e-9) and np.allclose(one.totals, other.totals, atol=1e-9)
                assert np.allclose(one.gain, other.gain, atol=1e-9)
