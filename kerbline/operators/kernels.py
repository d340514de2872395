"""Kernel separators and kernel regression on explicit feature maps."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread
from .passes import added_up, matrix

DEGREE = 3  # of the polynomial kernel


# ---- kernels and their maps ----------------------------------------------------------


def kernel(x: np.ndarray, y: np.ndarray, kind: str, gamma: float) -> np.ndarray:
    """``rbf``: exp(-gamma |x - y|^2); ``poly``: (gamma x.y)^3."""
    if kind == "poly":
        return (gamma * (x @ y.T)) ** DEGREE
    if kind != "rbf":
        raise ValueError(f"no kernel {kind!r}")
    apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(apart, 0))


@dataclass(frozen=True)
class Landmarks:
    """Nystroem map: kernel values at landmark rows, whitened, so that products of maps are
    the kernel's best reconstruction from the landmarks. With all rows as landmarks it is exact."""

    kind: str
    gamma: float
    points: np.ndarray
    whiten: np.ndarray

    @staticmethod
    def of(points: np.ndarray, kind: str, gamma: float) -> Landmarks:
        values, vectors = np.linalg.eigh(kernel(points, points, kind, gamma))
        clear = values > 1e-10 * max(values.max(initial=0.0), 1e-300)
        return Landmarks(kind, gamma, points, vectors[:, clear] / np.sqrt(values[clear]))

    @property
    def size(self) -> int:
        return self.whiten.shape[1]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return kernel(x, self.points, self.kind, self.gamma) @ self.whiten


@dataclass(frozen=True)
class Waves:
    """Random Fourier features of the rbf kernel: seeded frequencies, products of maps
    estimate the kernel without bias, with an error of the order of 1 / sqrt(size)."""

    frequencies: np.ndarray

    @staticmethod
    def of(features: int, size: int, gamma: float, seed: int) -> Waves:
        draw = np.random.default_rng((seed, features, size)).standard_normal((features, size // 2))
        return Waves(np.sqrt(2 * gamma) * draw)

    @property
    def size(self) -> int:
        return 2 * self.frequencies.shape[1]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        angle = x @ self.frequencies
        return np.concatenate([np.cos(angle), np.sin(angle)], axis=1) / np.sqrt(self.frequencies.shape[1])


Map = Landmarks | Waves


def scale_gamma(df: DataFrame, features: str = "features") -> float:
    """1 / (number of features * variance of all their values)."""
    values = df.select(F.explode(vector_to_array(features)).alias("x"))
    size = df.select(F.max(F.size(vector_to_array(features)))).first()[0] or 1
    spread = values.agg(F.var_pop("x")).first()[0]
    return 1.0 / (size * spread) if spread else 1.0


def feature_map(
    df: DataFrame, kind: str, *, key: str, size: int = 256, gamma: float | None = None, how: str = "landmarks",
    features: str = "features", seed: int = 0,
) -> Map:
    """The map of a kernel: ``landmarks`` are the ``size`` rows of the smallest seeded key
    hashes, a bounded sample; ``waves`` need none but know the rbf kernel only."""
    gamma = scale_gamma(df, features) if gamma is None else gamma
    if how == "waves":
        if kind != "rbf":
            raise ValueError("waves are for the rbf kernel")
        width = df.select(F.max(F.size(vector_to_array(features)))).first()[0] or 1
        return Waves.of(width, size, gamma, seed)
    picked = df.select(F.xxhash64(F.lit(seed), F.col(key)).alias("h"), vector_to_array(features).alias("x"))
    rows = picked.orderBy("h", "x").limit(size).collect()
    if not rows:
        raise ValueError("no rows to take landmarks from")
    return Landmarks.of(np.unique(np.array([r["x"] for r in rows], float), axis=0), kind, gamma)


# ---- the optimiser -------------------------------------------------------------------


@dataclass(frozen=True)
class Task:
    """One margin problem: |w|^2 / 2 + C * sum of hinges over the rows it takes.

    With ``pair`` the rows of two classes, a hinge max(0, 1 - s f) with s = 1 for the first.
    With ``epsilon`` all rows, two hinges max(0, |y - f| - epsilon). Rows of ``fold`` are
    left out.
    """

    cost: float
    pair: tuple[int, int] | None = None
    epsilon: float = 0.0
    fold: int = -1

    def hinges(self, y: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(taken rows, slope, offset): hinges max(0, offset - slope * f)."""
        if self.pair is None:
            one = np.ones(len(y))
            return [(np.ones(len(y), bool), one, y - self.epsilon), (np.ones(len(y), bool), -one, -y - self.epsilon)]
        taken = (y == self.pair[0]) | (y == self.pair[1])
        return [(taken, np.where(y == self.pair[0], 1.0, -1.0), np.ones(len(y)))]


def _blocks(batches: Iterator[pa.RecordBatch], features: Map) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            z = features(matrix(part.column("x"), part.num_rows))
            yield (np.concatenate([z, np.ones((len(z), 1))], axis=1), part.column("y").to_numpy(),
                   part.column("fold").to_numpy())


def barrier(u: np.ndarray, cost: float, mu: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value over s > max(0, u) of cost s - mu log s - mu log(s - u), its slope and curvature in u.

    This is cost * max(0, u) with both of its corners rounded; slopes lie inside (0, cost).
    """
    root = np.sqrt((cost * u) ** 2 + 4 * mu * mu)
    # root + cost u and root - cost u, the small one of them without cancellation
    large = root + cost * np.abs(u)
    small = 4 * mu * mu / large
    up, down = np.where(u >= 0, large, small), np.where(u >= 0, small, large)
    s, over = (2 * mu + up) / (2 * cost), (2 * mu + down) / (2 * cost)
    value = cost * s - mu * np.log(s) - mu * np.log(over)
    return value, mu / over, mu / (s * s + over * over)


_SHARES = (2.0, 1.0, 0.5, 0.25, 0.1, 0.03, 0.003)  # of a Newton step that are tried


def solve(
    table: DataFrame, features: Map, tasks: Sequence[Task], *, tol: float = 1e-3, max_passes: int = 200
) -> np.ndarray:
    """Weights (task, feature) of all margin problems, the last one the free intercept.

    Every hinge is replaced by its logarithmic barrier, whose width shrinks tenfold
    whenever Newton steps have come close to its optimum; the width bounds how far the
    objective is off, by ``tol`` of itself in the end. Close is a small share of what the
    width leaves open, so the rounds do not grow with the rows; only at the last width it
    is the width itself. A round has two passes over the rows. The first adds up slope and
    curvature of every open problem, whose Newton step is worked out where its sums meet;
    the driver gets the step, not the curvature. The second compares lengths of the step.
    All problems advance together, and one that has settled is not counted any more. Not
    settling within ``max_passes`` rounds is an error.
    """
    size = features.size + 1
    penalty = np.append(np.ones(features.size), 0.0)

    def parts(t: int, y: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Rows of a problem, and slope and offset of its hinges for them."""
        seen = fold != tasks[t].fold if tasks[t].fold >= 0 else np.ones(len(y), bool)
        hinges = tasks[t].hinges(y)
        # the hinges of a problem take the same rows
        own = hinges[0][0] & seen
        return own, [(s[own], offset[own]) for _, s, offset in hinges]

    def measure(at: dict[int, tuple[np.ndarray, float]]) -> dict[int, np.ndarray]:
        """Barrier, hinges and their number, decrement and Newton step of each open problem."""

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[Mapping]:
            out = {t: np.zeros(3 + size + size * size) for t in at}
            for z, y, fold in _blocks(batches, features):
                for t, (w, mu) in at.items():
                    own, hinges = parts(t, y, fold)
                    rows = z if own.all() else z[own]
                    f = rows @ w
                    down, bend = np.zeros(len(rows)), np.zeros(len(rows))
                    for s, offset in hinges:
                        u = offset - s * f
                        value, slope, curve = barrier(u, tasks[t].cost, mu)
                        out[t][:3] += [value.sum(), tasks[t].cost * np.maximum(u, 0).sum(), len(u)]
                        down += slope * s
                        bend += curve
                    out[t][3 : 3 + size] -= down @ rows
                    out[t][3 + size :] += ((rows * bend[:, None]).T @ rows).ravel()
            yield out

        def step(name: str, sums: np.ndarray) -> np.ndarray:
            w, _ = at[int(name)]
            bend = sums[3 + size :].reshape(size, size)
            gradient = penalty * w + sums[3 : 3 + size]
            curve = np.diag(penalty) + bend
            curve[-1, -1] += 1e-12 * max(1.0, bend[-1, -1]) + (not sums[2])
            step = np.linalg.solve(curve, -gradient)
            return np.concatenate([sums[:3], [-gradient @ step], step])

        found = added_up(table, make, step)
        return {t: found.get(str(t), np.append(np.zeros(4), -penalty * at[t][0])) for t in at}

    def along(at: dict[int, tuple[np.ndarray, np.ndarray, float]]) -> dict[int, np.ndarray]:
        """Barriers of each open problem at all lengths of its step."""

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[Mapping]:
            out = {t: np.zeros(len(_SHARES)) for t in at}
            for z, y, fold in _blocks(batches, features):
                both = z @ np.concatenate([np.stack([w for w, _, _ in at.values()]), np.stack([d for _, d, _ in at.values()])]).T
                for i, (t, (_, _, mu)) in enumerate(at.items()):
                    own, hinges = parts(t, y, fold)
                    f, df = both[own, i], both[own, len(at) + i]
                    for k, share in enumerate(_SHARES):
                        for s, offset in hinges:
                            out[t][k] += barrier(offset - s * (f + share * df), tasks[t].cost, mu)[0].sum()
            yield out

        found = added_up(table, make, lambda name, sums: sums)
        none = np.zeros(len(_SHARES))
        return {t: found.get(str(t), none) for t in at}

    wide = table.agg(F.stddev_pop("y")).first()[0] or 0.0
    weights = np.zeros((len(tasks), size))
    mu = np.array([t.cost * (1.0 if t.pair else max(wide, t.epsilon, 1e-6)) for t in tasks])
    open_ = set(range(len(tasks)))
    for _ in range(max_passes):
        if not open_:
            return weights
        moving = {}
        for t, found in measure({t: (weights[t], mu[t]) for t in sorted(open_)}).items():
            rounded, hinges, rows, decrement = found[:4]
            objective = 0.5 * (penalty * weights[t] ** 2).sum() + hinges
            last = 2 * rows * mu[t] <= tol * objective or not rows or mu[t] < 1e-14
            if last and decrement <= mu[t]:
                weights[t] += found[4:]
                open_.discard(t)
                continue
            if not last and decrement <= max(1.0, 0.1 * rows) * mu[t]:
                mu[t] /= 10
            moving[t] = (weights[t].copy(), found[4:], mu[t])
        if moving:
            for t, values in along(moving).items():
                w, step, _ = moving[t]
                tried = w + np.outer(_SHARES, step)
                best = np.argmin(0.5 * (penalty * tried**2).sum(axis=1) + values)
                weights[t] = tried[best]
    if not open_:
        return weights
    raise RuntimeError(f"{len(open_)} margin problems have not settled after {max_passes} rounds")


def _table(df: DataFrame, label: str, features: str) -> DataFrame:
    fold = F.col("fold").cast("int") if "fold" in df.columns else F.lit(-1)
    return spread(df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), fold.alias("fold")))


def _scored(df: DataFrame, score, kind: str, out: str, features: str) -> DataFrame:
    @F.pandas_udf(kind)
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(list(score(np.stack(x.to_numpy()).astype(np.float64))) if len(x) else [])

    return df.withColumn(out, run(vector_to_array(features)))


# ---- models --------------------------------------------------------------------------


@dataclass(frozen=True)
class SeparatorModel:
    """One separator per pair of classes; a row goes to the class with the most votes,
    of equally many the first."""

    features: Map
    classes: list[int]
    weights: np.ndarray

    def decisions(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.features(x), np.ones((len(x), 1))], axis=1) @ self.weights.T

    def votes(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.classes)))
        for f, (i, j) in zip(self.decisions(x).T, combinations(range(len(self.classes)), 2), strict=True):
            out[:, i] += f > 0
            out[:, j] += f <= 0
        return out

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        names = np.array(self.classes, float)
        return _scored(df, lambda x: names[self.votes(x).argmax(axis=1)], "double", "prediction", features)


@dataclass(frozen=True)
class KernelSeparator:
    """Support vector classification: hinge loss with cost ``C`` in the space of a kernel,
    one against one. ``kind`` is ``rbf`` or ``poly``; gamma is 1 / (features * variance)
    unless it is given."""

    key: str
    C: float = 1.0
    kind: str = "rbf"
    gamma: float | None = None
    size: int = 256
    how: str = "landmarks"
    tol: float = 1e-3
    seed: int = 0

    def fit(self, df: DataFrame) -> SeparatorModel:
        return self.fit_costs(df, [self.C])[0][0]

    def fit_costs(self, df: DataFrame, costs: Sequence[float], folds: int = 0) -> list[list[SeparatorModel]]:
        """For each cost the model of all rows, and then those without each fold (column
        ``fold``); all of them advance in the same passes."""
        found = feature_map(df, self.kind, key=self.key, size=self.size, gamma=self.gamma, how=self.how, seed=self.seed)
        table = _table(df, "label", "features")
        # as many rows as classes
        classes = sorted(int(r["y"]) for r in table.select("y").distinct().collect())
        pairs = list(combinations(classes, 2))
        tasks = [Task(c, p, fold=f) for c in costs for f in range(-1, folds) for p in pairs]
        weights = solve(table, found, tasks, tol=self.tol).reshape(len(costs), folds + 1, len(pairs), found.size + 1)
        return [[SeparatorModel(found, classes, w) for w in of_cost] for of_cost in weights]


@dataclass(frozen=True)
class CurveModel:
    features: Map
    weights: np.ndarray

    def values(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights[:-1] + self.weights[-1]

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        return _scored(df, self.values, "double", "prediction", features)


@dataclass(frozen=True)
class KernelRegression:
    """Support vector regression: errors beyond ``epsilon`` cost ``C`` each, in the space of
    a kernel."""

    key: str
    C: float = 1.0
    epsilon: float = 0.1
    kind: str = "rbf"
    gamma: float | None = None
    size: int = 256
    how: str = "landmarks"
    tol: float = 1e-3
    seed: int = 0

    def fit(self, df: DataFrame) -> CurveModel:
        return self.fit_grid(df, [(self.C, self.epsilon)])[0][0]

    def fit_grid(self, df: DataFrame, options: Sequence[tuple[float, float]], folds: int = 0) -> list[list[CurveModel]]:
        """For each (C, epsilon) the model of all rows, and then those without each fold."""
        found = feature_map(df, self.kind, key=self.key, size=self.size, gamma=self.gamma, how=self.how, seed=self.seed)
        table = _table(df, "label", "features")
        tasks = [Task(c, epsilon=e, fold=f) for c, e in options for f in range(-1, folds)]
        weights = solve(table, found, tasks, tol=self.tol).reshape(len(options), folds + 1, found.size + 1)
        return [[CurveModel(found, w) for w in of_option] for of_option in weights]


# The grids the analyses search.
SEPARATOR_COSTS = [0.01, 0.1, 1.0, 10.0]
CURVE_KINDS = ["rbf", "poly"]
CURVE_COSTS = [0.0001, 0.001, 0.01, 0.1, 0.2]
CURVE_EPSILONS = [0.0009, 0.001, 0.0015, 0.002]


def regression_board(
    df: DataFrame, *, key: str, folds: int = 5, kinds: Sequence[str] = CURVE_KINDS, costs: Sequence[float] = CURVE_COSTS,
    epsilons: Sequence[float] = CURVE_EPSILONS, size: int = 256, seed: int = 0,
) -> DataFrame:
    """R2 of every kernel, cost and width by contiguous folds in key order, best mean first.

    Returns (kernel, C, epsilon, scores, mean_score, sd_score). The fits of a kernel, over
    all folds, settle in the same passes; one pass over the rows then scores them.
    """
    from .learning import with_folds

    table = cut(with_folds(df.select(key, "features", "label"), folds, key=key))
    rows = _table(table, "label", "features")
    out = []
    options = [(c, e) for c in costs for e in epsilons]
    for kind in kinds:
        models = KernelRegression(key, kind=kind, size=size, seed=seed).fit_grid(table, options, folds)
        found = models[0][0].features

        def make(batches: Iterator[pa.RecordBatch], models=models, found=found) -> Iterator[Mapping]:
            for z, y, fold in _blocks(batches, found):
                sums = {}
                for f in range(folds):
                    own, label = z[fold == f], y[fold == f]
                    if len(label):
                        guess = own @ np.stack([of_option[f + 1].weights for of_option in models], axis=1)
                        sums[f"error{f}"] = ((label[:, None] - guess) ** 2).sum(axis=0)
                        sums[f"label{f}"] = np.array([len(label), label.sum(), (label**2).sum()])
                yield sums

        got = added_up(rows, make)
        for o, (c, e) in enumerate(options):
            scores = []
            for f in range(folds):
                n, s, ss = got.get(f"label{f}", np.zeros(3))
                spread = ss - s * s / n if n else 0.0
                scores.append(float(1 - got[f"error{f}"][o] / spread) if spread > 1e-12 * max(1.0, ss) else None)
            known = [s for s in scores if s is not None]
            mean = float(np.mean(known)) if known else None
            out.append((kind, c, e, scores, mean, float(np.std(known)) if known else None))
    out.sort(key=lambda r: (r[4] is None, -(r[4] or 0.0), r[0], r[1], r[2]))
    return df.sparkSession.createDataFrame(
        out, "kernel string, C double, epsilon double, scores array<double>, mean_score double, sd_score double"
    )
