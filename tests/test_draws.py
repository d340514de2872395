"""Draws of the pooled level and lines against a plain sampler and closed forms."""

import numpy as np
import pytest

from kerbline.operators.draws import (
    NAMES,
    bound,
    draw_levels,
    effective_size,
    free,
    key_summary,
    level_summary,
    line_draws,
    log_evidence,
    log_posterior,
    log_prior,
    pooled_draws,
    split_r_hat,
    summary_of,
)
from kerbline.operators.fits import Pool


@pytest.fixture(scope="module")
def lines():
    rng = np.random.default_rng(2)
    rows = []
    for k in range(30):
        a, b = rng.normal(0.8, 0.3), rng.normal(0.05, 0.04)
        for w in range(rng.integers(4, 14)):
            rows.append((k, w, a + b * w + rng.normal(0, 0.2)))
    return np.array(rows)


def sums_of(rows):
    out = []
    for k in np.unique(rows[:, 0]):
        _, x, y = rows[rows[:, 0] == k].T
        out.append((len(x), x.sum(), (x * x).sum(), y.sum(), (x * y).sum(), (y * y).sum()))
    return np.array(out)


def test_evidence_as_the_joint_normal(lines):
    sums = sums_of(lines)
    for level in ([0.7, 0.1, 0.4, 0.05, 0.25], [-1.0, 0.0, 1.5, 0.3, 0.9]):
        ma, mb, sa, sb, s = level
        want = 0.0
        for k in np.unique(lines[:, 0]):
            _, x, y = lines[lines[:, 0] == k].T
            design = np.stack([np.ones(len(x)), x], axis=1)
            cov = design @ np.diag([sa**2, sb**2]) @ design.T + s**2 * np.eye(len(x))
            off = y - design @ [ma, mb]
            want += -0.5 * (off @ np.linalg.solve(cov, off) + np.linalg.slogdet(2 * np.pi * cov)[1])
        assert log_evidence(sums, np.array([level]))[0] == pytest.approx(want, rel=1e-9)


def test_evidence_of_many_keys_near_a_spread_of_zero(lines):
    # as the spreads go to zero the lines become the level's line, whatever the number of keys
    sums = np.tile(sums_of(lines), (2000, 1))
    ma, mb, s = 0.8, 0.05, 0.3
    _, x, y = lines.T
    want = -0.5 * 2000 * (((y - ma - mb * x) ** 2).sum() / s**2 + len(x) * np.log(2 * np.pi * s**2))
    level = np.array([[ma, mb, small, small, s] for small in (1e-6, 1e-7, 1e-8)])
    # a spread of 1e-6 is worth about a millionth of a key and less
    assert log_evidence(sums, level) == pytest.approx(np.full(3, want), abs=1e-3)


def test_levels_of_many_keys_alike(spark):
    # no spread between the keys: the posterior of the spreads reaches down to zero
    rng = np.random.default_rng(5)
    rows = np.array([(k, w, 1 + 0.4 * rng.standard_normal()) for k in range(200) for w in range(80)])
    row = np.tile(sums_of(rows), (60, 1))
    names = ["n", "sx", "sxx", "sy", "sxy", "syy"]
    sums = spark.createDataFrame(row.tolist(), ", ".join(f"{c} double" for c in names))
    levels = draw_levels(sums, Pool(1.0, 0.0, 0.01, 2e-4, 0.4), draws=500)
    assert split_r_hat(np.moveaxis(levels, -1, 0)).max() < 1.1
    assert levels[..., 4].mean() == pytest.approx(0.4, rel=0.02)
    assert levels[..., 2].mean() < 5e-3


def metropolis(sums, steps=60_000):
    """A random walk over levels, one at a time."""
    rng = np.random.default_rng(9)
    value = lambda u: log_evidence(sums, bound(u[None]))[0] + log_prior(u[None])[0]
    u = free(np.array([[0.8, 0.05, 0.3, 0.04, 0.2]]))[0]
    size = np.array([0.06, 0.012, 0.15, 0.25, 0.05])
    now, out = value(u), []
    for _ in range(steps):
        to = u + size * rng.standard_normal(5) * 0.7
        there = value(to)
        if np.log(rng.random()) < there - now:
            u, now = to, there
        out.append(u)
    return bound(np.array(out[steps // 10 :]))


def test_draws_as_a_plain_sampler(spark, lines):
    rows = [(int(k), f"2020-01-{1 + int(w):02d}", float(v)) for k, w, v in lines]
    df = spark.createDataFrame(rows, "key int, t string, v double").selectExpr("key", "date_add(date'2020-01-06', int(day(date(t)) - 1) * 7) AS t", "v")
    found = pooled_draws(df, ("2020-01-01", "2020-12-31"), "2020-01-06", key="key", time="t", value="v", draws=1500)
    sums = sums_of(lines)
    plain = metropolis(sums)
    level = {r["parameter"]: r for r in found.level.collect()}
    assert list(level) == NAMES
    for i, name in enumerate(NAMES):
        sd = plain[:, i].std()
        assert level[name]["mean"] == pytest.approx(plain[:, i].mean(), abs=0.15 * sd)
        assert level[name]["sd"] == pytest.approx(sd, rel=0.12)
        for q, c in ((0.05, "q05"), (0.5, "median"), (0.95, "q95")):
            assert level[name][c] == pytest.approx(np.quantile(plain[:, i], q), abs=0.2 * sd)
        assert level[name]["r_hat"] < 1.03 and level[name]["n_eff"] > 400
    # lines given the plain sampler's levels
    some = plain[:: len(plain) // 4000]
    a, b = line_draws(sums, np.arange(len(sums)), some, 5)
    keys = {(r["key"], r["parameter"]): r for r in found.keys.collect()}
    assert len(keys) == 2 * len(sums)
    for k in range(len(sums)):
        for name, x in (("a", a[k]), ("b", b[k])):
            r = keys[k, name]
            assert r["mean"] == pytest.approx(x.mean(), abs=0.15 * x.std())
            assert r["sd"] == pytest.approx(x.std(), rel=0.1)
            assert r["q05"] < r["median"] < r["q95"] and r["r_hat"] < 1.03


def test_lines_at_one_level_have_the_closed_form():
    sums = np.array([[10.0, 45.0, 285.0, 22.0, 130.0, 70.0]])
    level = np.tile([1.0, 0.1, 0.5, 0.2, 0.4], (40_000, 1))
    a, b = line_draws(sums, np.array([77]), level, 1)
    p = np.array([[10 / 0.16 + 4, 45 / 0.16], [45 / 0.16, 285 / 0.16 + 25]])
    mean, cov = np.linalg.solve(p, [22 / 0.16 + 4, 130 / 0.16 + 2.5]), np.linalg.inv(p)
    got = np.stack([a[0], b[0]])
    assert np.allclose(got.mean(axis=1), mean, atol=6 * np.sqrt(np.diag(cov) / 40_000))
    assert np.allclose(np.cov(got), cov, rtol=0.05)


def test_diagnostics():
    rng = np.random.default_rng(0)
    fine = rng.standard_normal((3, 4, 2000))
    assert np.all(split_r_hat(fine) < 1.01) and np.all(effective_size(fine) > 5500)
    walk = np.zeros((1, 4, 4000))
    for i in range(1, 4000):
        walk[..., i] = 0.9 * walk[..., i - 1] + rng.standard_normal((1, 4))
    assert effective_size(walk)[0] == pytest.approx(16_000 * 0.1 / 1.9, rel=0.3)
    apart = fine + np.arange(4)[:, None]
    assert np.all(split_r_hat(apart) > 1.3)
    assert summary_of(fine).shape == (3, 7)


def test_reruns_and_layouts_agree(spark, lines):
    rows = [(i, *map(float, r)) for i, r in enumerate(sums_of(lines))]
    sums = spark.createDataFrame(rows, "key int, n double, sx double, sxx double, sy double, sxy double, syy double")
    u = free(np.array([[0.8, 0.05, 0.3, 0.04, 0.2], [0.0, 0.0, 1.0, 1.0, 1.0]]))
    assert np.allclose(log_posterior(sums.repartition(3), u), log_evidence(sums_of(lines), bound(u)) + log_prior(u))
    start = Pool(0.8, 0.05, 0.3, 0.04, 0.2)
    one, two = (draw_levels(d, start, draws=200, chains=2, seed=4) for d in (sums, sums.repartition(5)))
    assert np.allclose(one, two)
    a, b = (sorted(map(tuple, key_summary(d, one, key="key").collect())) for d in (sums, sums.repartition(5)))
    assert a == b and len(a) == 2 * len(rows)
    assert level_summary(spark, one).count() == 5
