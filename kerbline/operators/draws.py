"""Posterior draws of the pooled lines: the population level first, then every key's line.

The lines can be integrated out in closed form, so the level's five numbers have a density
of their own, a sum over the keys. One pass over the keys' sums evaluates it at thousands
of levels at once; the chains that walk over these levels then need no further pass, and
one more pass draws all lines given all levels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .fits import Pool, pooled_sums, settled_pool
from .passes import added_up
from .trees import mixed

NAMES = ["mu_a", "mu_b", "sigma_a", "sigma_b", "sigma"]
_SUMS = ["n", "sx", "sxx", "sy", "sxy", "syy"]
_FREEDOM = 5  # of the t distribution that levels are proposed from


# ---- density -------------------------------------------------------------------------


def _normal_equations(sums: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, ...]:
    """Precision (p11, p12, p22) and shift (h1, h2) of lines; keys by rows, levels by columns."""
    n, sx, sxx, sy, sxy, _ = (c[:, None] for c in sums.T)
    ma, mb, sa, sb, s = level.T
    va, vb, v = sa**2, sb**2, s**2
    return n / v + 1 / va, sx / v, sxx / v + 1 / vb, sy / v + ma / va, sxy / v + mb / vb


def log_evidence(sums: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Log density of the keys' observations at each level, lines integrated out; summed over keys.

    Worked out from the residuals about the level's line and with the spreads multiplied, not
    divided by, so that nothing cancels where a spread is near zero: the error of a key must
    stay far below one over the number of keys.
    """
    n, sx, sxx, sy, sxy, syy = (c[:, None] for c in sums.T)
    ma, mb, sa, sb, s = level.T
    v = s**2
    r, xr = sy - ma * n - mb * sx, sxy - ma * sx - mb * sxx
    rr = syy - 2 * (ma * sy + mb * sxy) + ma**2 * n + 2 * ma * mb * sx + mb**2 * sxx
    p11, p12, p22 = 1 + n * (sa**2 / v), sx * (sa * sb / v), 1 + sxx * (sb**2 / v)
    det = p11 * p22 - p12**2
    h1, h2 = sa * r, sb * xr
    fit = (p22 * h1**2 - 2 * p12 * h1 * h2 + p11 * h2**2) / det
    each = n * np.log(2 * math.pi * v) + np.log(det) + (rr - fit / v) / v
    return -0.5 * each.sum(axis=0)


def free(level: np.ndarray) -> np.ndarray:
    """Levels with the logarithms of their spreads."""
    return np.concatenate([level[:, :2], np.log(level[:, 2:])], axis=1)


def bound(u: np.ndarray) -> np.ndarray:
    return np.concatenate([u[:, :2], np.exp(np.clip(u[:, 2:], -30, 30))], axis=1)


def log_prior(u: np.ndarray) -> np.ndarray:
    """Standard normal means, half-normal spreads, and the volume of their logarithms."""
    level = bound(u)
    return -0.5 * (level**2).sum(axis=1) + u[:, 2:].sum(axis=1)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in _SUMS], axis=1).astype(np.float64)


def log_posterior(sums: DataFrame, u: np.ndarray) -> np.ndarray:
    """Log posterior of all levels ``u`` in one pass over the keys."""
    level = bound(u)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        step = max(1, (1 << 17) // len(level))
        for batch in batches:
            rows = _rows(batch)
            for lo in range(0, len(rows), step):
                yield {"log": log_evidence(rows[lo : lo + step], level)}

    found = added_up(sums.select(*_SUMS), make).get("log", np.zeros(len(u)))
    return np.where(np.isfinite(found), found, -np.inf) + log_prior(u)


# ---- levels --------------------------------------------------------------------------


def _widths(sums: DataFrame, start: Pool) -> np.ndarray:
    """How far each number may lie from its start, by the numbers of keys and observations."""
    keys, rows = sums.agg(F.count(F.lit(1)), F.sum("n")).first()
    keys, rows = math.sqrt(max(keys, 1)), math.sqrt(max(rows or 1.0, 1.0))
    return np.array([start.sigma_a / keys, start.sigma_b / keys, 1 / keys, 1 / keys, 1 / rows]) * 2


def _tempered(log_weight: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """Weights raised to the largest power up to one that leaves ``least`` of the rows effective."""

    def at(power: float) -> np.ndarray:
        w = np.exp(power * (log_weight - log_weight.max()))
        return w / w.sum()

    low, high = 0.0, 1.0
    if 1 / (at(1.0) ** 2).sum() >= least * len(log_weight):
        return at(1.0), 1.0
    for _ in range(40):
        power = (low + high) / 2
        low, high = (power, high) if 1 / (at(power) ** 2).sum() >= least * len(log_weight) else (low, power)
    return at(low), low


def _log_t(u: np.ndarray, middle: np.ndarray, root: np.ndarray) -> np.ndarray:
    z = np.linalg.solve(root, (u - middle).T)
    d = len(middle)
    return -0.5 * (_FREEDOM + d) * np.log1p((z * z).sum(axis=0) / _FREEDOM) - np.log(np.diag(root)).sum()


def _propose(rng: np.random.Generator, n: int, middle: np.ndarray, root: np.ndarray) -> np.ndarray:
    z = rng.standard_normal((n, len(middle))) @ root.T
    return middle + z * np.sqrt(_FREEDOM / rng.chisquare(_FREEDOM, (n, 1)))


def draw_levels(
    sums: DataFrame, start: Pool, *, chains: int = 4, draws: int = 2000, warm_up: int = 1000, seed: int = 0,
    least_moves: float = 0.2,
) -> np.ndarray:
    """Levels (chain, draw, number) by independent proposals that are taken or not.

    Proposals come from a t distribution. Warm-up batches of ``warm_up`` move its middle and
    spread from the fitted level to the posterior: a batch is weighed by the ratio of
    posterior and proposal, to a power that leaves a quarter of it effective, until the
    plain weights are even. All proposals of all chains are then evaluated in one pass,
    and each chain takes or refuses them in turn. Chains that take less than
    ``least_moves`` of them are an error.
    """
    rng = np.random.default_rng(seed)
    middle = free(np.array([[getattr(start, c) for c in NAMES]]))[0]
    spread = np.diag(_widths(sums, start) ** 2)
    for _ in range(25):
        root = np.linalg.cholesky(1.2 * spread)
        tried = _propose(rng, max(warm_up, 500), middle, root)
        weight, power = _tempered(log_posterior(sums, tried) - _log_t(tried, middle, root), 0.25)
        middle = weight @ tried
        off = tried - middle
        spread = (off * weight[:, None]).T @ off
        # a direction that shrank to nothing could not grow again
        spread += np.diag(1e-6 * np.diag(spread) + 1e-18)
        if power == 1.0 and 1 / (weight**2).sum() > 0.5 * len(weight):
            break
    root = np.linalg.cholesky(1.2 * spread)
    tried = _propose(rng, chains * (draws + 1), middle, root)
    weight = (log_posterior(sums, tried) - _log_t(tried, middle, root)).reshape(chains, draws + 1)
    chance = np.log(rng.random((chains, draws + 1)))
    at = np.zeros((chains, draws), np.int64)
    moves = 0
    for c in range(chains):
        now = 0
        for i in range(1, draws + 1):
            if weight[c, i] - weight[c, now] >= chance[c, i]:
                now = i
                moves += 1
            at[c, i - 1] = now
    if moves < least_moves * chains * draws:
        raise RuntimeError(f"only {moves} of {chains * draws} proposed levels were taken")
    levels = bound(tried).reshape(chains, draws + 1, len(middle))
    return np.take_along_axis(levels, at[:, :, None], axis=1)


# ---- summaries -----------------------------------------------------------------------


def split_r_hat(x: np.ndarray) -> np.ndarray:
    """Potential scale reduction of draws (..., chain, draw), each chain cut in halves."""
    half = x.shape[-1] // 2
    parts = np.concatenate([x[..., :half], x[..., -half:]], axis=-2)
    within = parts.var(axis=-1, ddof=1).mean(axis=-1)
    between = parts.mean(axis=-1).var(axis=-1, ddof=1)
    return np.sqrt((half - 1) / half + between / np.where(within > 0, within, 1))


def effective_size(x: np.ndarray) -> np.ndarray:
    """Effective number of draws (..., chain, draw): sums of neighbouring autocorrelations
    count as long as they are positive, and none more than the one before."""
    m, n = x.shape[-2:]
    centred = x - x.mean(axis=-1, keepdims=True)
    size = 1 << (2 * n - 1).bit_length()
    wave = np.fft.rfft(centred, size, axis=-1)
    auto = np.fft.irfft(wave * np.conj(wave), size, axis=-1)[..., :n] / n
    within = auto[..., 0].mean(axis=-1) * n / (n - 1)
    total = within * (n - 1) / n + (x.mean(axis=-1).var(axis=-1, ddof=1) if m > 1 else 0.0)
    rho = 1 - (within[..., None] - auto.mean(axis=-2)) / np.where(total > 0, total, 1)[..., None]
    rho[..., 0] = 1
    pairs = rho[..., 0 : n - n % 2 : 2] + rho[..., 1::2]
    pairs = np.where(np.cumprod(pairs > 0, axis=-1) > 0, pairs, 0)
    pairs = np.minimum.accumulate(pairs, axis=-1)
    tau = np.maximum(2 * pairs.sum(axis=-1) - 1, 1 / math.log10(max(10, m * n)))
    return m * n / tau


def summary_of(x: np.ndarray) -> np.ndarray:
    """mean, sd, median, 5%, 95%, n_eff and r_hat of draws (..., chain, draw), on the last axis."""
    flat = x.reshape(*x.shape[:-2], -1)
    middle = np.quantile(flat, [0.5, 0.05, 0.95], axis=-1)
    return np.stack([flat.mean(axis=-1), flat.std(axis=-1, ddof=1), *middle, effective_size(x), split_r_hat(x)], axis=-1)


_SUMMARY = ["mean", "sd", "median", "q05", "q95", "n_eff", "r_hat"]


def level_summary(spark, levels: np.ndarray) -> DataFrame:
    """(parameter, mean, sd, median, q05, q95, n_eff, r_hat) of the five population numbers."""
    found = summary_of(np.moveaxis(levels, -1, 0))
    rows = [(name, *map(float, r)) for name, r in zip(NAMES, found, strict=True)]
    return spark.createDataFrame(rows, "parameter string, " + ", ".join(f"{c} double" for c in _SUMMARY))


def _variates(h: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two standard normal numbers per key and draw, from the key's hash, the draw and the seed."""
    with np.errstate(over="ignore"):
        cell = h.view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(n, dtype=np.uint64)
    u = 1 - mixed(cell.view(np.int64), 2 * seed)
    v = mixed(cell.view(np.int64), 2 * seed + 1)
    far = np.sqrt(-2 * np.log(u))
    return far * np.cos(2 * math.pi * v), far * np.sin(2 * math.pi * v)


def line_draws(sums: np.ndarray, h: np.ndarray, level: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """One line per key and level from its normal posterior given that level."""
    p11, p12, p22, h1, h2 = _normal_equations(sums, level)
    det = p11 * p22 - p12**2
    a, b = (p22 * h1 - p12 * h2) / det, (p11 * h2 - p12 * h1) / det
    z1, z2 = _variates(h, len(level), seed)
    # b given a has precision p22; a alone has variance p22 / det
    drawn = a + z1 * np.sqrt(p22 / det)
    return drawn, b - p12 / p22 * (drawn - a) + z2 / np.sqrt(p22)


def key_summary(sums: DataFrame, levels: np.ndarray, *, key: str, seed: int = 0) -> DataFrame:
    """(key, parameter, mean, sd, median, q05, q95, n_eff, r_hat) of intercept ``a`` and slope ``b``.

    Every key draws one line for each level, with numbers from its own hash, in one pass
    without a shuffle.
    """
    chains, draws, _ = levels.shape
    flat = levels.reshape(chains * draws, -1)
    kind = sums.schema[key].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 18) // len(flat))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                both = line_draws(_rows(part), part.column("h").to_numpy(), flat, seed)
                for name, x in zip("ab", both, strict=True):
                    found = summary_of(x.reshape(-1, chains, draws))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("k"), pa.array([name] * len(x)), *(pa.array(c) for c in found.T)],
                        names=["k", "parameter", *_SUMMARY],
                    )

    rows = sums.select(F.col(key).alias("k"), F.xxhash64(key).alias("h"), *_SUMS)
    kinds = ", ".join(f"{c} double" for c in _SUMMARY)
    return rows.mapInArrow(make, f"k {kind}, parameter string, {kinds}").withColumnRenamed("k", key)


@dataclass(frozen=True)
class PooledDraws:
    """Draws of the level, and the summaries of level and keys."""

    levels: np.ndarray
    level: DataFrame
    keys: DataFrame


def pooled_draws(
    df: DataFrame, span: tuple[str, str], t0: str, *, key: str, time: str, value: str, chains: int = 4,
    draws: int = 2000, warm_up: int = 1000, seed: int = 0,
) -> PooledDraws:
    """Draws from the posterior of ``y = a_k + b_k * weeks + e`` with a shared level.

    ``a_k ~ N(mu_a, sigma_a)``, ``b_k ~ N(mu_b, sigma_b)``, ``e ~ N(0, sigma)``; the means
    have N(0, 1) priors, the spreads half-normal ones. The series is read once into six
    sums per key.
    """
    sums = spread(pooled_sums(df, span, t0, key=key, time=time, value=value))
    pool, _ = settled_pool(sums, key=key)
    levels = draw_levels(sums, pool, chains=chains, draws=draws, warm_up=warm_up, seed=seed)
    return PooledDraws(
        levels, level_summary(df.sparkSession, levels), key_summary(sums, levels, key=key, seed=seed)
    )
