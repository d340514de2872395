"""K-means with all numbers of clusters and all restarts in the same passes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .passes import added_up, matrix


@dataclass(frozen=True)
class Centres:
    """The centres of one run, what it costs, and the rounds it took; ``out`` names the cluster."""

    k: int
    centres: np.ndarray
    cost: float
    rounds: int
    features: str = "features"
    out: str = "cluster"

    def named(self, out: str) -> Centres:
        return replace(self, out=out)

    def transform(self, df: DataFrame) -> DataFrame:
        @F.pandas_udf("int")
        def nearest(x: pd.Series) -> pd.Series:
            found = _squares(np.stack(x.to_numpy()), self.centres).argmin(axis=1) if len(x) else []
            return pd.Series(found, dtype="int32")

        return df.withColumn(self.out, nearest(vector_to_array(self.features)))


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    apart = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)
    return np.maximum(apart, 0)


def random_starts(
    table: DataFrame, ks: Sequence[int], restarts: int, *, key: str | None = None, seed: int = 0
) -> list[np.ndarray]:
    """For each k and restart k different vectors, those of the smallest seeded hashes of the
    key, or of the vector where there is none.

    All runs are drawn together; the driver gets some rows more than the largest k for each
    restart, whatever the size of the table. Runs of one restart share their first rows.
    """
    most = max(ks)
    named = F.col(key) if key else F.col("x")
    salted = F.explode(F.array(*[
        F.struct(F.lit(r).alias("restart"), F.xxhash64(F.lit(seed), F.lit(r), named).alias("h")) for r in range(restarts)
    ]))
    rows = table.select("x", salted.alias("s")).select("x", "s.*")
    n = table.count()
    # hashes spread evenly, so a share of their range holds the smallest ones with room to
    # spare; equal vectors may need more of it
    share = min(1.0, (8.0 * most + 64) / max(1, n))
    while True:
        few = rows.where(F.col("h") <= min(2**63 - 1, int(-(2**63) + share * 2**64)))
        found: dict[int, list] = {r: [] for r in range(restarts)}
        for row in few.orderBy("restart", "h", "x").collect():
            if row["x"] not in found[row["restart"]] and len(found[row["restart"]]) < most:
                found[row["restart"]].append(row["x"])
        if all(len(p) == most for p in found.values()):
            return [np.array(p[:k], float) for k in ks for p in found.values()]
        if share == 1.0:
            raise ValueError(f"fewer than {most} different rows to start from")
        share = min(1.0, 8 * share)


def lloyd_runs(
    df: DataFrame, ks: Sequence[int], *, key: str | None = None, features: str = "features", restarts: int = 10,
    max_iter: int = 50, tol: float = 1e-2, seed: int = 0, starts: Sequence[np.ndarray] | None = None,
) -> list[Centres]:
    """Lloyd's rounds of every k and restart side by side, in the order of ``ks``.

    A pass returns, for each run that still moves, the sums, counts and cost of its
    clusters. A run settles when no centre moves by more than ``tol``, or after
    ``max_iter`` rounds, and drops out; a centre without rows stays where it is.
    """
    table = cut(_vectors(df, key, features))
    runs = _runs(table, ks, key, restarts, max_iter, tol, seed, starts)
    return [replace(r, features=features) for r in runs]


def _vectors(df: DataFrame, key: str | None, features: str) -> DataFrame:
    own = [F.col(key)] if key else []
    return df.select(*own, vector_to_array(features).cast("array<double>").alias("x"))


def _runs(table, ks, key, restarts, max_iter, tol, seed, starts) -> list[Centres]:
    centres = list(starts) if starts is not None else random_starts(table, ks, restarts, key=key, seed=seed)
    costs, rounds = np.zeros(len(centres)), np.zeros(len(centres), int)
    moving = set(range(len(centres)))
    settled: set[int] = set()

    def measure(which: list[int]) -> dict[int, np.ndarray]:
        now = {r: centres[r] for r in which}

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for batch in batches:
                x = matrix(batch.column("x"), batch.num_rows)
                with_one = np.concatenate([x, np.ones((len(x), 1))], axis=1)
                every = np.concatenate(list(now.values()))
                apart = _squares(x, every)
                out, lo = {}, 0
                for r, c in now.items():
                    own = apart[:, lo : lo + len(c)]
                    lo += len(c)
                    at = own.argmin(axis=1)
                    belongs = (at[:, None] == np.arange(len(c))).astype(np.float64)
                    cost = own[np.arange(len(x)), at].sum()
                    out[r] = np.concatenate([(belongs.T @ with_one).ravel(), [cost]])
                yield out

        found = added_up(table.select("x"), make)
        return {r: found[str(r)] for r in which}

    while moving:
        for r, sums in measure(sorted(moving)).items():
            cells = sums[:-1].reshape(len(centres[r]), -1)
            costs[r] = sums[-1]
            if r in settled:
                # the cost of the centres as they came to rest
                moving.discard(r)
                continue
            n = cells[:, -1:]
            new = np.where(n > 0, cells[:, :-1] / np.maximum(n, 1), centres[r])
            rounds[r] += 1
            step = np.sqrt(((new - centres[r]) ** 2).sum(axis=1)).max()
            centres[r] = new
            if step <= tol or rounds[r] >= max_iter:
                settled.add(r)
    return [Centres(len(c), c, float(costs[r]), int(rounds[r])) for r, c in enumerate(centres)]


def best_runs(runs: Sequence[Centres]) -> dict[int, Centres]:
    """The cheapest run of each k, the first of equally cheap ones."""
    out: dict[int, Centres] = {}
    for run in runs:
        if run.k not in out or run.cost < out[run.k].cost:
            out[run.k] = run
    return out


def centroid_silhouettes(table: DataFrame, runs: Sequence[Centres]) -> list[float]:
    """Mean silhouette of each run by mean squared distances to whole clusters.

    These follow from a cluster's count, sum and sum of squares, so two passes serve all
    runs. A row alone in its cluster scores 0; a run with a single cluster scores 0.
    """

    def labels(x: np.ndarray) -> list[np.ndarray]:
        return [_squares(x, r.centres).argmin(axis=1) for r in runs]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = matrix(batch.column("x"), batch.num_rows)
            wide = np.concatenate([x, (x * x).sum(axis=1, keepdims=True), np.ones((len(x), 1))], axis=1)
            yield {
                i: (at[:, None] == np.arange(r.k)).astype(float).T @ wide for i, (r, at) in enumerate(zip(runs, labels(x)))
            }

    stats = added_up(table.select("x"), first)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = matrix(batch.column("x"), batch.num_rows)
            square = (x * x).sum(axis=1)
            out = {}
            for i, at in enumerate(labels(x)):
                sums = stats[str(i)]
                n = sums[:, -1]
                total = square[:, None] * n - 2 * x @ sums[:, :-2].T + sums[:, -2]
                own = np.arange(len(x)), at
                a = np.maximum(total[own], 0) / np.maximum(n[at] - 1, 1)
                other = np.where(n > 0, np.maximum(total, 0) / np.maximum(n, 1), np.inf)
                other[own] = np.inf
                b = other.min(axis=1)
                fine = (n[at] > 1) & np.isfinite(b) & (np.maximum(a, b) > 0)
                score = np.where(fine, (b - a) / np.where(fine, np.maximum(a, b), 1), 0.0)
                out[i] = np.array([score.sum(), len(x)])
            yield out

    found = added_up(table.select("x"), second)
    return [float(found[str(i)][0] / found[str(i)][1]) for i in range(len(runs))]


def cluster_sweep(
    df: DataFrame, ks: Sequence[int], *, key: str, features: str = "features", restarts: int = 10, seed: int = 0,
    max_iter: int = 50, tol: float = 1e-2,
) -> DataFrame:
    """(k, cost, rounds, silhouette) of the cheapest of ``restarts`` runs for each k."""
    table = cut(_vectors(df, key, features))
    runs = best_runs(_runs(table, ks, key, restarts, max_iter, tol, seed, None))
    scores = centroid_silhouettes(table, [runs[k] for k in ks])
    rows = [(k, runs[k].cost, runs[k].rounds, s) for k, s in zip(ks, scores, strict=True)]
    return df.sparkSession.createDataFrame(rows, "k int, cost double, rounds int, silhouette double")
