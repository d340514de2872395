"""Kernel maps against exact kernels, separators against an exact solver of the dual."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from kerbline.operators.kernels import (
    KernelRegression,
    KernelSeparator,
    Landmarks,
    Waves,
    feature_map,
    kernel,
    scale_gamma,
)


def vectors(spark, x, y, **more):
    rows = [(i, list(map(float, r)), float(v), *(int(c[i]) for c in more.values())) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["key", "x", "label", *more]).repartition(4)
    return df.withColumn("features", array_to_vector("x")).drop("x")


def dual(gram, signs, cost, low=None, rounds=4000):
    """Coefficients of the dual: max signs.a - a K a / 2, 0 <= signs a <= cost, sum a = 0, pair by pair.

    ``low`` gives other linear terms (regression): then the box is [-cost, cost] on pairs of signs.
    """
    n = len(signs)
    a = np.zeros(n)
    linear = signs.astype(float) if low is None else low
    f = np.zeros(n)
    for _ in range(rounds):
        g = linear - f
        up = np.where(signs > 0, a < cost - 1e-12, a < -1e-12)
        down = np.where(signs > 0, a > 1e-12, a > -cost + 1e-12)
        i = np.argmax(np.where(up, g, -np.inf))
        j = np.argmin(np.where(down, g, np.inf))
        if g[i] - g[j] < 1e-8:
            break
        bend = gram[i, i] + gram[j, j] - 2 * gram[i, j]
        room = min((cost if signs[i] > 0 else 0) - a[i], a[j] - (0 if signs[j] > 0 else -cost))
        t = min((g[i] - g[j]) / max(bend, 1e-12), room)
        a[i] += t
        a[j] -= t
        f += t * (gram[i] - gram[j])
    return a, (g[i] + g[j]) / 2


@pytest.fixture(scope="module")
def rings():
    rng = np.random.default_rng(3)
    angle = rng.uniform(0, 6.28, 120)
    radius = np.where(np.arange(120) % 2, 1.0, 2.2) + 0.25 * rng.standard_normal(120)
    return np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1), np.arange(120) % 2


def test_maps_estimate_the_kernel():
    rng = np.random.default_rng(4)
    x, y = rng.standard_normal((80, 3)), rng.standard_normal((50, 3))
    for kind in ("rbf", "poly"):
        whole = Landmarks.of(x, kind, 0.4)
        assert np.allclose(whole(x) @ whole(x).T, kernel(x, x, kind, 0.4), atol=1e-6)
    exact, last = kernel(x, y, "rbf", 0.4), np.inf
    for size in (64, 1024, 16384):
        error = np.sqrt(np.mean([((Waves.of(3, size, 0.4, s)(x) @ Waves.of(3, size, 0.4, s)(y).T - exact) ** 2).mean() for s in range(4)]))
        assert error < 1.5 / np.sqrt(size) and error < last
        last = error
    with pytest.raises(ValueError):
        kernel(x, y, "sigmoid", 1.0)


def test_gamma_from_the_spread_of_all_values(spark, rings):
    x, y = rings
    assert scale_gamma(vectors(spark, x, y)) == pytest.approx(1 / (2 * x.var()))


@pytest.mark.parametrize("kind", ["rbf", "poly"])
@pytest.mark.parametrize("cost", [0.1, 10.0])
def test_decisions_as_the_exact_dual(spark, rings, kind, cost):
    x, y = rings
    df = vectors(spark, x, y)
    gamma = scale_gamma(df)
    model = KernelSeparator("key", C=cost, kind=kind, size=500, tol=1e-6).fit(df)
    signs = np.where(y == 0, 1.0, -1.0)
    gram = kernel(x, x, kind, gamma)
    a, b = dual(gram, signs, cost)
    want = gram @ a + b
    got = model.decisions(x)[:, 0]
    clear = np.abs(want) > 0.05
    assert clear.mean() > 0.8 and (np.sign(got) == np.sign(want))[clear].all()
    value = lambda f, w2: 0.5 * w2 + cost * np.maximum(0, 1 - signs * f).sum()
    best = value(want, a @ gram @ a)
    assert value(got, (model.weights[0, :-1] ** 2).sum()) <= best * (1 + 1e-4) + 1e-9
    rows = model.transform(df).collect()
    if kind == "rbf" and cost == 10.0:
        assert np.mean([r["prediction"] == r["label"] for r in rows]) > 0.95


def test_votes_of_several_classes_and_folds(spark):
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0], [4, 0], [0, 4], [4, 4]])
    y = np.arange(160) % 4
    x = centres[y] + 0.5 * rng.standard_normal((160, 2))
    df = vectors(spark, x, y + 3, fold=np.arange(160) // 80)
    (models,) = KernelSeparator("key", size=60).fit_costs(df, [1.0], folds=2)
    assert len(models) == 3 and models[0].weights.shape[0] == 6
    for model in models:
        assert np.mean([r["prediction"] == r["label"] for r in model.transform(df).collect()]) > 0.97
    waves = KernelSeparator("key", size=512, how="waves").fit(df)
    assert np.mean([r["prediction"] == r["label"] for r in waves.transform(df).collect()]) > 0.97
    # the second model has not seen the first half
    alone = KernelSeparator("key", size=60).fit(df.where("fold = 1"))
    assert models[1].votes(x).shape == alone.votes(x).shape


@pytest.mark.parametrize("cost,epsilon", [(1.0, 0.1), (0.1, 0.3)])
def test_regression_as_the_exact_dual(spark, cost, epsilon):
    rng = np.random.default_rng(6)
    x = np.sort(rng.uniform(-3, 3, 90))[:, None]
    y = np.sin(x[:, 0]) + 0.1 * rng.standard_normal(90)
    df = vectors(spark, x, y)
    gamma = scale_gamma(df)
    model = KernelRegression("key", C=cost, epsilon=epsilon, size=500, tol=1e-6).fit(df)
    gram = kernel(x, x, "rbf", gamma)
    # each row once with each sign
    both = np.tile(gram, (2, 2))
    signs = np.repeat([1.0, -1.0], 90)
    a, b = dual(both, signs, cost, low=np.concatenate([y - epsilon, y + epsilon]), rounds=60_000)
    a = a[:90] + a[90:]
    want, got = gram @ a + b, model.values(x)
    value = lambda f, w2: 0.5 * w2 + cost * np.maximum(0, np.abs(y - f) - epsilon).sum()
    best = value(want, a @ gram @ a)
    assert value(got, (model.weights[:-1] ** 2).sum()) <= best * (1 + 1e-3)
    assert np.abs(want - got).max() < 0.05


def test_landmarks_are_seeded_rows(spark, rings):
    df = vectors(spark, *rings)
    one, two = (feature_map(d, "rbf", key="key", size=20, seed=4).points for d in (df, df.repartition(7)))
    assert (one == two).all() and len(one) == 20
    assert (feature_map(df, "rbf", key="key", size=20, seed=5).points != one).any()
    with pytest.raises(ValueError):
        feature_map(df.limit(0), "rbf", key="key", gamma=1.0)
    with pytest.raises(ValueError):
        feature_map(df, "poly", key="key", how="waves")


def test_curvature_stays_off_the_driver(spark, rings, monkeypatch):
    from kerbline.operators import kernels

    sizes = []

    def watched(*args):
        got = added_up(*args)
        sizes.extend(a.size for a in got.values())
        return got

    added_up = kernels.added_up
    monkeypatch.setattr(kernels, "added_up", watched)
    x, y = rings
    rounds = []
    for copies in (1, 30):
        sizes.clear()
        df = vectors(spark, np.tile(x, (copies, 1)), np.tile(y, copies))
        model = KernelSeparator("key", C=1.0, gamma=0.5, size=40, tol=1e-4).fit(df)
        # a step and four numbers, no square of the features
        assert max(sizes) <= model.features.size + 5
        rounds.append(len(sizes))
    assert rounds[1] <= 1.6 * rounds[0]
