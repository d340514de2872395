"""Everything that follows from products of columns, from one pass over the rows.

The products of (1, features, label) add up by fold. A ridge fit without a fold is solved
from the total minus the fold's block, and its errors on the fold follow from that block, so
a whole grid of penalties and folds costs a single aggregate; so do correlations and
principal components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .passes import added_up, matrix


@dataclass(frozen=True)
class Line:
    """A linear model with a penalty on its squared coefficients."""

    coefficients: np.ndarray
    intercept: float

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients])
        parts = F.zip_with(vector_to_array(features), weights, lambda x, w: x * w)
        return df.withColumn("prediction", F.aggregate(parts, F.lit(float(self.intercept)), lambda total, x: total + x))


@dataclass(frozen=True)
class Blocks:
    """Product sums of (1, x - shift, y - shift) by fold; fold -1 where there are none."""

    by_fold: dict[int, np.ndarray]
    shift: np.ndarray

    @property
    def total(self) -> np.ndarray:
        return sum(self.by_fold.values())

    def seen(self, without: int | None) -> np.ndarray:
        """All rows but those of a fold."""
        return self.total if without is None else self.total - self.by_fold.get(without, 0)

    def spread(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Means and centred products of features and label."""
        n = block[0, 0]
        mean = block[0, 1:] / n
        return mean, block[1:, 1:] - n * np.outer(mean, mean)

    def ridge(self, alpha: float, without: int | None = None) -> Line:
        """Least sum of squared errors plus ``alpha`` times the squared coefficients."""
        mean, centred = self.spread(self.seen(without))
        xx, xy = centred[:-1, :-1], centred[:-1, -1]
        # a penalty of nothing leaves columns that depend on each other; any solution predicts alike
        w = np.linalg.lstsq(xx + alpha * np.eye(len(xx)), xy, rcond=1e-12)[0]
        mean = mean + self.shift
        return Line(w, float(mean[-1] - w @ mean[:-1]))

    def squared_error(self, line: Line, fold: int | None = None) -> tuple[float, float, float]:
        """(rows, squared errors of a line, squared deviations of the label) on a fold or all rows."""
        block = self.total if fold is None else self.by_fold.get(fold, np.zeros_like(self.total))
        n = block[0, 0]
        if not n:
            return 0.0, 0.0, 0.0
        start = line.intercept + line.coefficients @ self.shift[:-1] - self.shift[-1]
        v = np.concatenate([[-start], -line.coefficients, [1.0]])
        return float(n), float(max(v @ block @ v, 0.0)), float(block[-1, -1] - block[0, -1] ** 2 / n)

    def r2(self, line: Line, fold: int | None = None) -> float | None:
        """None where the label does not vary."""
        n, error, spread = self.squared_error(line, fold)
        return 1 - error / spread if n and spread > 1e-12 * max(1.0, n) else None

    def correlations(self) -> np.ndarray:
        """Of features and label; a constant column has none (nan)."""
        _, centred = self.spread(self.total)
        sd = np.sqrt(np.diag(centred))
        with np.errstate(invalid="ignore", divide="ignore"):
            return centred / np.outer(sd, sd)

    def components(self) -> tuple[np.ndarray, np.ndarray]:
        """Variances and directions of the standardised features, largest variance first.

        The largest entry of a direction is positive. Constant columns only count as zero.
        """
        n = self.total[0, 0]
        _, centred = self.spread(self.total)
        sd = np.sqrt(np.diag(centred)[:-1] / n)
        sd[sd == 0] = 1
        values, vectors = np.linalg.eigh(centred[:-1, :-1] / np.outer(sd, sd) / max(1.0, n - 1))
        order = np.argsort(-values, kind="stable")
        vectors = vectors[:, order]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(sd))])
        return np.maximum(values[order], 0), vectors


def gram_blocks(df: DataFrame, *, label: str = "label", features: str = "features", fold: str | None = None) -> Blocks:
    """Product sums of all rows by ``fold``, in one pass.

    Columns are moved by the first row met by the planner's cheapest read, which keeps
    large means out of the products.
    """
    by = F.col(fold).cast("int") if fold else F.lit(-1)
    table = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), by.alias("fold"))
    first = table.first()
    if first is None:
        raise ValueError("no rows")
    shift = np.append(np.array(first["x"], float), first["y"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = matrix(batch.column("x"), batch.num_rows)
            y = batch.column("y").to_numpy()
            rows = np.concatenate([np.ones((len(x), 1)), x - shift[:-1], (y - shift[-1])[:, None]], axis=1)
            at = batch.column("fold").to_numpy()
            yield {f: rows[at == f].T @ rows[at == f] for f in np.unique(at).tolist()}

    return Blocks({int(f): block for f, block in added_up(table, make).items()}, shift)


def block_cells(spark, blocks: Blocks) -> DataFrame:
    """(fold, i, j, value) of the products without the shift; 0 is the count, the last the label."""
    rows = []
    for f, block in sorted(blocks.by_fold.items()):
        back = np.eye(len(block))
        back[1:, 0] = blocks.shift
        whole = back @ block @ back.T
        rows += [(f, i, j, float(whole[i, j])) for i in range(len(block)) for j in range(i + 1)]
    return spark.createDataFrame(rows, "fold int, i int, j int, value double")


def ridge_board(
    df: DataFrame, alphas: Sequence[float], *, key: str, folds: int = 5, features: str = "features", label: str = "label"
) -> tuple[DataFrame, Line]:
    """Scores of all penalties on contiguous folds in key order, and the best line on all rows.

    Returns (model, params, scores, mean_score, sd_score, candidate) like
    ``learning.cross_validate``, best mean first, and reads the rows once.
    """
    from .learning import with_folds

    table = cut(with_folds(df.select(key, features, label), folds, key=key))
    blocks = gram_blocks(table, label=label, features=features, fold="fold")
    rows = []
    for i, alpha in enumerate(alphas):
        scores = [blocks.r2(blocks.ridge(alpha, f), f) if f in blocks.by_fold else None for f in range(folds)]
        known = [s for s in scores if s is not None]
        mean = sum(known) / len(known) if known else None
        sd = math.sqrt(sum((s - mean) ** 2 for s in known) / len(known)) if known else None
        rows.append(("ridge", f"alpha={alpha}", scores, mean, sd, i))
    rows.sort(key=lambda r: (r[3] is None, -(r[3] or 0.0), r[5]))
    board = df.sparkSession.createDataFrame(
        rows, "model string, params string, scores array<double>, mean_score double, sd_score double, candidate int"
    )
    return board, blocks.ridge(alphas[rows[0][5]])
