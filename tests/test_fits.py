import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from kerbline.operators import fits
from kerbline.operators.aggregates import fit_lines, line_values
from kerbline.plans.pooling import pooled_lines

C = dict(key="key", time="t", value="v")
T0 = dt.date(2020, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(
        [(k, T0 + dt.timedelta(days=int(d)), float(v)) for k, d, v in rows], "key long, t date, v double"
    )


def test_lines_against_numpy_and_single_points(spark):
    rng = np.random.default_rng(0)
    days = np.arange(0, 100, 7)
    y = 1 + 0.02 * days + rng.normal(0, 0.1, len(days))
    rows = frame(spark, [(1, d, v) for d, v in zip(days, y)] + [(2, 3, 1.0)])
    out = fit_lines(rows, {"a": (("2020-01-01", "2020-12-31"), "2020-01-01")}, **C)
    got = {r["key"]: r for r in out.collect()}
    slope, intercept = np.polyfit(days, y, 1)
    assert got[1]["slope"] == pytest.approx(slope) and got[1]["intercept"] == pytest.approx(intercept)
    assert got[2]["slope"] is None and got[2]["n"] == 1
    values = line_values(rows, out, "2020-01-01", key="key", time="t").where("key = 1").collect()
    assert all(
        r["fitted"] == pytest.approx(intercept + slope * (r["t"] - T0).days) for r in values
    )


def test_huber_line_is_the_joint_scale_optimum(spark):
    rng = np.random.default_rng(1)
    days = np.arange(40)
    rows, ys = [], {}
    for k in range(3):
        y = 2 + 0.05 * days + rng.normal(0, 0.2, 40)
        y[::9] += 5
        ys[k] = y
        rows += [(k, d, v) for d, v in zip(days, y)]
    out = fits.huber_lines(frame(spark, rows), ("2020-01-01", "2020-12-31"), "2020-01-01", **C, epsilon=1.35)
    got = {r["key"]: r for r in out.collect()}
    for k, y in ys.items():
        data = spark.createDataFrame([(float(d), float(v)) for d, v in zip(days, y)], "x double, label double")
        data = VectorAssembler(inputCols=["x"], outputCol="features").transform(data)
        model = LinearRegression(
            loss="huber", epsilon=1.35, regParam=1e-4 / 40, standardization=False, maxIter=500, tol=1e-10
        ).fit(data)
        assert got[k]["slope"] == pytest.approx(model.coefficients[0], abs=1e-4)
        assert got[k]["intercept"] == pytest.approx(model.intercept, abs=1e-3)
        assert got[k]["scale"] == pytest.approx(model.scale, rel=1e-2)


def test_huber_small_and_perfect_series(spark):
    rows = [(1, 0, 1.0), (1, 1, 3.0)] + [(2, d, 2.0 * d) for d in range(6)] + [(3, 0, 1.0)]
    out = fits.huber_lines(frame(spark, rows), ("2020-01-01", "2020-12-31"), "2020-01-01", **C)
    got = {r["key"]: r for r in out.collect()}
    assert got[1]["slope"] == pytest.approx(2.0) and got[2]["slope"] == pytest.approx(2.0)
    assert got[3]["slope"] is None


def simulated(seed=2, keys=150, weeks=12):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(0.7, 0.2, keys), rng.normal(0.03, 0.02, keys)
    rows = [
        (k, 7 * w, a[k] + b[k] * w + rng.normal(0, 0.1)) for k in range(keys) for w in range(weeks)
    ]
    return a, b, rows


def test_pool_recovers_known_parameters(spark):
    a, b, rows = simulated()
    pool, post = fits.fit_pool(frame(spark, rows), ("2020-01-01", "2020-12-31"), "2020-01-01", **C)
    assert pool.mu_a == pytest.approx(a.mean(), abs=0.02)
    assert pool.mu_b == pytest.approx(b.mean(), abs=0.005)
    assert pool.sigma_a == pytest.approx(0.2, rel=0.2)
    assert pool.sigma_b == pytest.approx(0.02, rel=0.25)
    assert pool.sigma == pytest.approx(0.1, rel=0.1)
    assert pool.rounds < 60
    got = {r["key"]: r for r in fits.pooled_summary(post, key="key").collect()}
    error = np.array([got[k]["mean_a"] - a[k] for k in got])
    assert np.mean(np.abs(error) < 2 * np.array([got[k]["sd_a"] for k in got])) > 0.85


def test_posterior_of_one_key_against_numpy(spark):
    days = np.arange(0, 70, 7)
    y = np.linspace(1, 2, 10)
    sums = fits.pooled_sums(
        frame(spark, [(1, d, v) for d, v in zip(days, y)]), ("2020-01-01", "2020-12-31"), "2020-01-01", **C
    )
    pool = fits.Pool(0.5, 0.1, 0.3, 0.2, 0.4)
    row = fits.pooled_posterior(sums, pool, key="key").first()
    x = np.column_stack([np.ones(10), days / 7])
    prior = np.diag([1 / 0.3**2, 1 / 0.2**2])
    cov = np.linalg.inv(x.T @ x / 0.16 + prior)
    mean = cov @ (x.T @ y / 0.16 + prior @ [0.5, 0.1])
    assert [row["a"], row["b"]] == pytest.approx(list(mean))
    assert [row["var_a"], row["var_b"], row["cov_ab"]] == pytest.approx([cov[0, 0], cov[1, 1], cov[0, 1]])
    band = fits.predictive_band(
        fits.pooled_posterior(sums, pool, key="key"), pool, "2020-01-01", key="key", time="t",
        rows=frame(spark, [(1, 14, 0.0)]),
    ).first()
    at = np.array([1.0, 2.0])
    assert band["pred"] == pytest.approx(at @ mean)
    assert band["sigma"] == pytest.approx(np.sqrt(0.16 + at @ cov @ at))
    assert band["hi"] - band["lo"] == pytest.approx(2 * band["sigma"])


def test_log_posterior_matches_numpy(spark):
    _, _, rows = simulated(keys=20)
    sums = fits.pooled_sums(frame(spark, rows), ("2020-01-01", "2020-12-31"), "2020-01-01", **C)
    pools = [fits.Pool(0.6, 0.02, 0.3, 0.05, 0.2), fits.Pool(0.7, 0.03, 0.2, 0.02, 0.1)]
    x = np.column_stack([np.ones(12), np.arange(12)])

    def exact(p):
        cov = x @ np.diag([p.sigma_a**2, p.sigma_b**2]) @ x.T + p.sigma**2 * np.eye(12)
        out = -0.5 * (p.mu_a**2 + p.mu_b**2 + p.sigma**2 + p.sigma_a**2 + p.sigma_b**2)
        for k in range(20):
            r = np.array([v for key, _, v in rows if key == k]) - x @ [p.mu_a, p.mu_b]
            out += -0.5 * (np.linalg.slogdet(cov)[1] + r @ np.linalg.solve(cov, r))
        return out

    scores = [fits._round(sums, p)[1] for p in pools]
    assert scores[1] - scores[0] == pytest.approx(exact(pools[1]) - exact(pools[0]), rel=1e-6)


def test_band_covers_the_grid_and_joins_actuals(spark):
    _, _, rows = simulated(keys=10)
    rows = [r for r in rows if not (r[0] == 3 and r[1] == 14)]
    _, summary, band = pooled_lines(frame(spark, rows), **C, span=("2020-01-01", "2020-12-31"))
    assert summary.count() == 10 and band.count() == 120
    assert band.where(F.col("actual").isNull()).count() == 1
