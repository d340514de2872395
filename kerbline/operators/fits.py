"""Robust lines per key and partially pooled lines over all keys."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import days_since, weeks_since, within
from ..session import cut
from .joins import period_grid
from .series import unique_periods

# ---- Huber line per key -------------------------------------------------------------


def _huber_block(t, y, mask, eps, alpha, tol, max_iter):
    """Joint slope, intercept and scale for each row of padded (rows x points) arrays."""
    n = mask.sum(1)
    centre = (t * mask).sum(1) / np.maximum(n, 1)
    x = (t - centre[:, None]) * mask
    w = mask.astype(float)
    sigma = np.zeros(len(n))

    def solve(w, sigma):
        s0, s1 = w.sum(1), (w * x).sum(1)
        s2 = (w * x * x).sum(1) + alpha * sigma
        r0, r1 = (w * y).sum(1), (w * x * y).sum(1)
        det = s0 * s2 - s1 * s1
        ok = np.abs(det) > 1e-12 * np.maximum(s0 * s2, 1e-300)
        safe = np.where(ok, det, 1.0)
        slope = np.where(ok, (s0 * r1 - s1 * r0) / safe, np.nan)
        return slope, np.where(ok, (s2 * r0 - s1 * r1) / safe, np.nan)

    slope, level = solve(w, sigma)
    resid = (y - level[:, None] - slope[:, None] * x) * mask
    sigma = np.sqrt((resid**2).sum(1) / np.maximum(n, 1))
    scale0 = np.sqrt((y * y * mask).sum(1) / np.maximum(n, 1))
    active = (n >= 3) & (sigma > 1e-10 * np.maximum(scale0, 1e-300)) & np.isfinite(slope)
    for _ in range(max_iter):
        if not active.any():
            break
        size = np.abs(resid)
        limit = (eps * sigma)[:, None]
        inside = size <= limit
        w = mask * np.where(inside, 1.0, limit / np.where(size > 0, size, 1.0))
        b, a = solve(w, sigma)
        r = (y - a[:, None] - b[:, None] * x) * mask
        inside = (np.abs(r) <= limit) & mask
        room = n - (n - inside.sum(1)) * eps**2
        square = ((r**2) * inside).sum(1)
        good = active & (room > 0) & (square > 0) & np.isfinite(b)
        s = np.sqrt(np.where(good, square, 1.0) / np.where(good, room, 1.0))
        moved = np.maximum(np.abs(s / np.where(good, sigma, 1.0) - 1), np.abs(b - slope) / (np.abs(b) + 1e-12))
        slope, level = np.where(good, b, slope), np.where(good, a, level)
        sigma = np.where(good, s, sigma)
        resid = np.where(good[:, None], r, resid)
        active = good & (moved > tol)
    return slope, level - slope * centre, sigma, n, ~active


def huber_lines(
    df: DataFrame,
    span: tuple[str, str],
    t0: str,
    *,
    key: str,
    time: str,
    value: str,
    epsilon: float = 1.05,
    alpha: float = 1e-4,
    tol: float = 1e-9,
    max_iter: int = 2000,
) -> DataFrame:
    """Huber line with a joint scale for every key, one shuffle for all rounds.

    A key's points (one per day at most, enforced) travel as two arrays, so the
    reweighting rounds need no further job. Fewer than three points give the
    least-squares line. ``converged`` is false for a key whose rounds ended at ``max_iter``.
    """
    rows = unique_periods(
        df.where(within(time, *span) & F.col(value).isNotNull()), key=key, time=time, value=value
    )
    points = rows.groupBy(key).agg(
        F.collect_list(
            F.struct(days_since(time, t0).cast("double").alias("t"), F.col(value).alias("y"))
        ).alias("p")
    )
    points = points.select(key, F.col("p.t").alias("t"), F.col("p.y").alias("y"))
    out = T.StructType(
        [
            df.schema[key],
            T.StructField("slope", T.DoubleType()),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("scale", T.DoubleType()),
            T.StructField("n", T.LongType()),
            T.StructField("converged", T.BooleanType()),
        ]
    )

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            widest = max((len(v) for v in batch["t"]), default=1)
            step = max(1, 500_000 // max(widest, 1))
            for i in range(0, len(batch), step):
                part = batch.iloc[i : i + step]
                width = max(len(v) for v in part["t"])
                t, y = np.zeros((len(part), width)), np.zeros((len(part), width))
                mask = np.zeros((len(part), width), dtype=bool)
                for j, (tv, yv) in enumerate(zip(part["t"], part["y"])):
                    t[j, : len(tv)], y[j, : len(yv)], mask[j, : len(tv)] = tv, yv, True
                slope, intercept, scale, n, converged = _huber_block(
                    t, y, mask, epsilon, alpha, tol, max_iter
                )
                yield pd.DataFrame(
                    {
                        key: part[key].to_numpy(),
                        "slope": slope,
                        "intercept": intercept,
                        "scale": scale,
                        "n": n.astype("int64"),
                        "converged": converged,
                    }
                )

    fitted = points.mapInPandas(fit, out)
    return fitted.select(
        key,
        *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("slope", "intercept", "scale")],
        "n",
        "converged",
    )


# ---- Partially pooled lines ---------------------------------------------------------


@dataclass(frozen=True)
class Pool:
    """Population level of the pooled model; spreads are standard deviations."""

    mu_a: float
    mu_b: float
    sigma_a: float
    sigma_b: float
    sigma: float
    rounds: int = 0


def pooled_sums(
    df: DataFrame, span: tuple[str, str], t0: str, *, key: str, time: str, value: str
) -> DataFrame:
    """Sufficient statistics of a line per key, time in weeks since ``t0``."""
    rows = df.where(within(time, *span) & F.col(value).isNotNull())
    x, y = F.col("_x"), F.col("_y")
    return (
        rows.select(key, weeks_since(time, t0).alias("_x"), F.col(value).cast("double").alias("_y"))
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum(x).alias("sx"),
            F.sum(x * x).alias("sxx"),
            F.sum(y).alias("sy"),
            F.sum(x * y).alias("sxy"),
            F.sum(y * y).alias("syy"),
        )
    )


# Gaussian algebra of one key, given the numbers of the population level.
_POSTERIOR = """
  SELECT *, (p22 * h1 - p12 * h2) / det AS a, (p11 * h2 - p12 * h1) / det AS b,
         p22 / det AS var_a, p11 / det AS var_b, -p12 / det AS cov_ab
  FROM (SELECT *, p11 * p22 - p12 * p12 AS det
        FROM (SELECT *, n / %(s2)s + 1 / %(va)s AS p11, sx / %(s2)s AS p12,
                     sxx / %(s2)s + 1 / %(vb)s AS p22, sy / %(s2)s + %(ma)s / %(va)s AS h1,
                     sxy / %(s2)s + %(mb)s / %(vb)s AS h2
              FROM {sums}))"""

# Squared error at the posterior mean (rss), what the doubt about the line adds to it, the
# log evidence of a key (fit, distance from the prior, volume), and the key's part in the
# normal equations of the two means with its own line integrated out.
_ROUND = """
SELECT count(1), sum(n), sum(qa + var_a), sum(qb + var_b), sum(rss + doubt),
       sum(-0.5D * (n * ln(%(s2)s) + ln(%(va)s) + ln(%(vb)s) + ln(det)
                    + rss / %(s2)s + qa / %(va)s + qb / %(vb)s)),
       sum(1 / %(va)s - var_a / (%(va)s * %(va)s)), sum(-cov_ab / (%(va)s * %(vb)s)),
       sum(1 / %(vb)s - var_b / (%(vb)s * %(vb)s)),
       sum((var_a * sy + cov_ab * sxy) / (%(s2)s * %(va)s)),
       sum((cov_ab * sy + var_b * sxy) / (%(s2)s * %(vb)s))
FROM (SELECT *,
             syy - 2 * a * sy - 2 * b * sxy + n * a * a + 2 * sx * a * b + sxx * b * b AS rss,
             n * var_a + 2 * sx * cov_ab + sxx * var_b AS doubt,
             (a - %(ma)s) * (a - %(ma)s) AS qa, (b - %(mb)s) * (b - %(mb)s) AS qb
      FROM (""" + _POSTERIOR + "))"


def _level(pool: Pool) -> dict[str, str]:
    numbers = {
        "ma": pool.mu_a,
        "mb": pool.mu_b,
        "va": pool.sigma_a**2,
        "vb": pool.sigma_b**2,
        "s2": pool.sigma**2,
    }
    return {name: f"({float(v)!r}D)" for name, v in numbers.items()}


def pooled_posterior(sums: DataFrame, pool: Pool, *, key: str) -> DataFrame:
    """Closed-form Gaussian posterior of each key's intercept and slope."""
    rows = sums.sparkSession.sql(_POSTERIOR % _level(pool), sums=sums)
    return rows.select(
        key, "n", "sx", "sxx", "sy", "sxy", "syy", "a", "b", "var_a", "var_b", "cov_ab"
    )


def _half_normal_scale(total: float, count: float) -> float:
    """Mode of a scale with a unit half-normal prior given a sum of squares."""
    return math.sqrt(max((-count + math.sqrt(count * count + 4 * total)) / 2, 1e-12))


_SPREADS = ("sigma_a", "sigma_b", "sigma")
_FLOOR = 1e-6


def _spreads(pool: Pool) -> np.ndarray:
    return np.log([getattr(pool, s) for s in _SPREADS])


def _scales(at: np.ndarray) -> list[float]:
    return [float(v) for v in np.exp(np.clip(at, math.log(_FLOOR), 50.0))]


def _round(sums: DataFrame, pool: Pool) -> tuple[Pool, float]:
    """The next population level, and the log posterior of the present one, in one job."""
    k, n, qa, qb, err, score, g11, g12, g22, u1, u2 = (
        sums.sparkSession.sql(_ROUND % _level(pool), sums=sums).first()
    )
    # unit normal priors of the means add one to the diagonal
    det = (g11 + 1) * (g22 + 1) - g12 * g12
    nxt = Pool(
        ((g22 + 1) * u1 - g12 * u2) / det,
        ((g11 + 1) * u2 - g12 * u1) / det,
        _half_normal_scale(max(qa, 0.0), k),
        _half_normal_scale(max(qb, 0.0), k),
        _half_normal_scale(max(err, 0.0), n),
    )
    spreads = pool.sigma**2 + pool.sigma_a**2 + pool.sigma_b**2
    return nxt, score - 0.5 * (pool.mu_a**2 + pool.mu_b**2 + spreads)


def fit_pool(
    df: DataFrame,
    span: tuple[str, str],
    t0: str,
    *,
    key: str,
    time: str,
    value: str,
    max_rounds: int = 300,
    tol: float = 1e-7,
) -> tuple[Pool, DataFrame]:
    """Fit ``y = a_k + b_k * weeks + e`` with a shared prior by EM.

    ``a_k ~ N(mu_a, sigma_a)``, ``b_k ~ N(mu_b, sigma_b)``; the means have N(0, 1) priors
    and the spreads unit half-normal ones. The series is read once, into one row of sums
    per key; a round is one aggregate over that table and returns a single row.

    A round sets the means to their optimum for the present spreads and moves the spreads
    one EM step. Every third round starts from an extrapolation of the spreads over the two
    before it (squared extrapolation of EM) and is taken only if it raises the log
    posterior. Stops when rounds change it by less than ``tol`` per observation.
    Returns the population level and the posterior per key; a level that has not settled
    after ``max_rounds`` is an error.
    """
    sums = cut(pooled_sums(df, span, t0, key=key, time=time, value=value))
    return settled_pool(sums, key=key, max_rounds=max_rounds, tol=tol)


def settled_pool(
    sums: DataFrame, *, key: str, max_rounds: int = 300, tol: float = 1e-7
) -> tuple[Pool, DataFrame]:
    """:func:`fit_pool` on the sums per key of :func:`pooled_sums`."""
    start = sums.agg(
        F.sum("n"), F.sum("sy"), F.sum("syy"), F.avg(F.col("sy") / F.col("n")),
        F.stddev_pop(F.col("sy") / F.col("n")),
    ).first()
    if not start[0]:
        raise ValueError("no rows to fit")
    var_y = max(start[2] / start[0] - (start[1] / start[0]) ** 2, 1e-8)
    pool = Pool(start[3], 0.0, max(start[4] or 0.0, 1e-3), 0.1, math.sqrt(var_y))
    enough = tol * start[0]
    rounds, before, longest = 0, -math.inf, 16.0
    while rounds < max_rounds:
        one, here = _round(sums, pool)
        two, after_one = _round(sums, one)
        rounds += 2
        settled = abs(after_one - here) < enough and abs(here - before) < enough
        if settled:
            return replace(two, rounds=rounds), pooled_posterior(sums, two, key=key)
        before = after_one
        x0, x1, x2 = _spreads(pool), _spreads(one), _spreads(two)
        r, v = x1 - x0, (x2 - x1) - (x1 - x0)
        length = float(np.linalg.norm(v))
        pool = two
        if length > 0:
            step = min(max(float(np.linalg.norm(r)) / length, 1.0), longest)
            leap = replace(two, **dict(zip(_SPREADS, _scales(x0 + 2 * step * r + step * step * v))))
            landed, there = _round(sums, leap)
            rounds += 1
            if math.isfinite(there) and there >= after_one:
                pool, before, longest = landed, there, longest * 4
            else:
                longest = max(longest / 4, 2.0)
    raise RuntimeError(f"the pooled level has not settled after {rounds} rounds")


def pooled_summary(posterior: DataFrame, *, key: str) -> DataFrame:
    """Posterior mean and standard deviation of each key's line."""
    return posterior.select(
        key,
        "n",
        F.col("a").alias("mean_a"),
        F.sqrt("var_a").alias("sd_a"),
        F.col("b").alias("mean_b"),
        F.sqrt("var_b").alias("sd_b"),
        "cov_ab",
    )


def predictive_band(
    posterior: DataFrame, pool: Pool, t0: str, *, key: str, time: str, rows: DataFrame | None = None,
    periods: DataFrame | None = None,
) -> DataFrame:
    """Predictive mean, deviation and one-sigma band.

    On ``rows`` (key, time) when given, else on every key x period of ``periods``.
    """
    if rows is None:
        if periods is None:
            raise ValueError("give rows or periods")
        rows = period_grid(periods, key=key, time=time)
    t = weeks_since(time, t0)
    joined = rows.select(key, time).join(
        posterior.select(key, "a", "b", "var_a", "var_b", "cov_ab"), key
    )
    spread: Column = F.sqrt(
        F.lit(pool.sigma**2) + F.col("var_a") + 2 * t * F.col("cov_ab") + t * t * F.col("var_b")
    )
    out = joined.select(
        key, time, t.alias("weeks"), (F.col("a") + F.col("b") * t).alias("pred"),
        spread.alias("sigma"),
    )
    return out.withColumns(
        {"lo": F.col("pred") - F.col("sigma"), "hi": F.col("pred") + F.col("sigma")}
    )


def band_with_actuals(
    band: DataFrame, series: DataFrame, *, key: str, time: str, value: str
) -> DataFrame:
    actual = series.select(key, F.col(time).cast("date").alias(time), F.col(value).alias("actual"))
    return band.join(actual, [key, time], "left")
