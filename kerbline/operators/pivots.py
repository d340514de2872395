"""Exact nearest neighbours through cells around pivots.

Training rows belong to the cell of their nearest pivot. A test row first looks into its
own cell. The distance of its k-th row there, and the triangle inequality, then say which
other cells can hold a nearer one; most are never met.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import cut
from .blocks import _squared
from .passes import added_up, matrix

_ROWS = 2048  # of either side that meet in a task


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(y)))
    for i, sq in _squared(x, y):
        out[i : i + len(sq)] = np.sqrt(sq)
    return out


@dataclass(frozen=True)
class Cells:
    """Pivots with what is known of their cells: rows, radius, and the distances of the
    ``k`` rows nearest to the pivot."""

    pivots: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    near: np.ndarray

    def reach(self, apart: np.ndarray, k: int) -> np.ndarray:
        """A bound of the distance to the k-th nearest row, from the pivots alone."""
        through = (apart[:, :, None] + self.near).reshape(len(apart), -1)
        return np.partition(through, k - 1, axis=1)[:, k - 1] if through.shape[1] >= k else np.full(len(apart), np.inf)

    def possible(self, apart: np.ndarray, home: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Which cells can hold a row within ``reach``: those whose ball it touches, and whose
        side of the middle between two pivots."""
        slack = 1e-9 * (1 + apart)
        touches = apart - self.radius <= reach[:, None] + slack
        between = _distances(self.pivots, self.pivots)[home]
        own = np.take_along_axis(apart, home[:, None], axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            beyond = np.where(between > 0, (apart**2 - own**2) / (2 * between), -np.inf)
        return touches & (beyond <= reach[:, None] + slack) & (self.rows > 0)


def make_cells(train: DataFrame, k: int, pivots: int, seed: int) -> Cells:
    """Cells of ``train`` (_tid, _y) around its rows of the smallest seeded key hashes.

    The number of pivots bounds what the driver and each task hold.
    """
    picked = train.select(F.xxhash64(F.lit(seed), "_tid").alias("h"), "_y").orderBy("h", "_y").limit(pivots).collect()
    points = np.unique(np.array([r["_y"] for r in picked], float), axis=0) if picked else np.zeros((0, 0))
    if not len(points):
        return Cells(points, np.zeros(0), np.zeros(0), np.zeros((0, k)))

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each task the rows, radius and nearest rows of each cell."""
        rows, radius = np.zeros(len(points)), np.zeros(len(points))
        near = np.full((len(points), k), np.inf)
        for batch in batches:
            d = _distances(matrix(batch.column("_y"), batch.num_rows), points)
            home = d.argmin(axis=1)
            own = d[np.arange(len(d)), home]
            rows += np.bincount(home, minlength=len(points))
            np.maximum.at(radius, home, own)
            for c in np.unique(home):
                near[c] = np.sort(np.concatenate([near[c], own[home == c]]))[:k]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(points))), pa.array(rows), pa.array(radius), pa.array(near.tolist())],
            names=["cell", "rows", "radius", "near"],
        )

    parts = train.select("_y").mapInArrow(far, "cell long, rows double, radius double, near array<double>")
    per = parts.groupBy("cell").agg(F.sum("rows").alias("rows"), F.max("radius").alias("radius"))
    # the smallest k of every task's smallest k
    spread = parts.select("cell", F.explode("near").alias("d")).withColumn(
        "r", F.row_number().over(W.partitionBy("cell").orderBy("d"))
    )
    least = spread.where(F.col("r") <= k).groupBy("cell").agg(F.sort_array(F.collect_list("d")).alias("near"))
    found = per.join(least, "cell").orderBy("cell").collect()
    return Cells(
        points, np.array([r["rows"] for r in found]), np.array([r["radius"] for r in found]),
        np.array([r["near"] for r in found]),
    )


def _meet(visits: DataFrame, members: DataFrame, cells: Cells, k: int) -> DataFrame:
    """The k nearest rows of each visited cell: (_id, _tid, _label, _d).

    Crowded cells are cut into slices of rows and of visitors that meet pair by pair.
    """
    slices = np.maximum(1, np.ceil(cells.rows / _ROWS)).astype(int)
    asked = dict(visits.groupBy("_cell").count().collect())
    shares = [max(1, math.ceil(asked.get(c, 0) / _ROWS)) for c in range(len(cells.pivots))]
    of_rows, of_visits = (F.element_at(F.array(*map(F.lit, map(int, n))), F.col("_cell") + 1) for n in (slices, shares))

    def dealt(df: DataFrame, key: str, own: str, other: str, parts, others) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), parts).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), others - 1))
        )

    # cells that nobody visits send no rows
    wanted = F.col("_cell").isin(sorted(asked))
    left = dealt(visits, "_id", "_share", "_slice", of_visits, of_rows).groupBy("_cell", "_share", "_slice")
    right = dealt(members.where(wanted), "_tid", "_slice", "_share", of_rows, of_visits).groupBy("_cell", "_share", "_slice")
    kinds = [members.schema[c].dataType.simpleString() for c in ("_tid", "_label")]

    def closest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"_id": [], "_tid": [], "_label": [], "_d": []})
        b = b.sort_values("_tid", kind="stable")
        d = _distances(np.stack(a["_x"].to_numpy()), np.stack(b["_y"].to_numpy()))
        kept = min(k, len(b))
        at = np.argsort(d, axis=1, kind="stable")[:, :kept]
        return pd.DataFrame(
            {
                "_id": np.repeat(a["_id"].to_numpy(), kept),
                "_tid": b["_tid"].to_numpy()[at.ravel()],
                "_label": b["_label"].to_numpy()[at.ravel()],
                "_d": np.take_along_axis(d, at, axis=1).ravel(),
            }
        )

    kind = visits.schema["_id"].dataType.simpleString()
    return left.cogroup(right).applyInPandas(closest, f"_id {kind}, _tid {kinds[0]}, _label {kinds[1]}, _d double")


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("_id").orderBy("_d", "_tid"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def visits(rows: DataFrame, cells: Cells, k: int, *, first: bool) -> DataFrame:
    """(_id, _x, _cell) of the cells that test rows look into: at ``first`` their own one, then
    all others that their ``_reach`` touches (or the pivots' bound, where it is less)."""
    kind = rows.schema["_id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("_x"), batch.num_rows)
            apart = _distances(x, cells.pivots)
            home = np.where(cells.rows > 0, apart, np.inf).argmin(axis=1)
            if first:
                row, cell = np.arange(len(x)), home
            else:
                reach = np.minimum(cells.reach(apart, k), batch.column("_reach").to_numpy(zero_copy_only=False))
                ok = cells.possible(apart, home, reach)
                ok[np.arange(len(x)), home] = False
                row, cell = np.nonzero(ok)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(at), batch.column("_x").take(at), pa.array(cell.astype(np.int32))],
                names=["_id", "_x", "_cell"],
            )

    return rows.mapInArrow(look, f"_id {kind}, _x array<double>, _cell int")


def nearest_by_pivots(
    test: DataFrame, train: DataFrame, k: int, *, key: str, vector: str, label: str, pivots: int = 64, seed: int = 0
) -> DataFrame:
    """The k nearest training rows of each test row; equal distances go to the lower key.

    Returns (key, place, neighbour, label, distance), the same rows as ``blocks.nearest``.
    Rows without a vector take no part.
    """
    rows = cut(
        test.where(F.col(vector).isNotNull()).select(
            F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_x")
        )
    )
    members = train.where(F.col(vector).isNotNull()).select(
        F.col(key).alias("_tid"), F.col(vector).cast("array<double>").alias("_y"), F.col(label).alias("_label")
    )
    cells = make_cells(members, k, pivots, seed)
    kind = members.schema["_tid"].dataType.simpleString()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = _distances(matrix(batch.column("_y"), batch.num_rows), cells.pivots).argmin(axis=1)
            names = ["_tid", "_y", "_label"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(home.astype(np.int32))], names=[*names, "_cell"]
            )

    label_kind = members.schema["_label"].dataType.simpleString()
    if not len(cells.pivots):
        shown = rows.select(F.col("_id").alias(key)).where("false")
        return shown.select(
            key, F.lit(0).alias("place"), F.lit(None).cast(kind).alias("neighbour"),
            F.lit(None).cast(label_kind).alias(label), F.lit(0.0).alias("distance"),
        )
    members = cut(members.mapInArrow(settle, f"_tid {kind}, _y array<double>, _label {label_kind}, _cell int"))
    own = cut(_best(_meet(visits(rows, cells, k, first=True), members, cells, k), k).drop("place"))
    # a cell with fewer rows than k says nothing of the k-th
    reach = own.groupBy("_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("_d")).otherwise(float("inf")).alias("_reach"))
    further = cut(visits(rows.join(reach, "_id"), cells, k, first=False))
    both = own.union(_meet(further, members, cells, k))
    return _best(both, k).select(
        F.col("_id").alias(key), "place", F.col("_tid").alias("neighbour"), F.col("_label").alias(label),
        F.col("_d").alias("distance"),
    )


def knn_by_pivots(
    test: DataFrame, train: DataFrame, k: int, *, key: str, vector: str, label: str, pivots: int = 64
) -> DataFrame:
    """Majority vote of the k nearest rows; the lowest label wins a tie."""
    near = nearest_by_pivots(test, train, k, key=key, vector=vector, label=label, pivots=pivots)
    votes = near.groupBy(key, label).agg(F.count(F.lit(1)).alias("_v"))
    return votes.groupBy(key).agg(F.min_by(F.col(label), F.struct(-F.col("_v"), F.col(label))).alias("prediction"))
