"""Nearest neighbours through pivots: exact, and most cells are never met."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.operators import pivots
from kerbline.operators.blocks import nearest


def points(spark, x, start=0):
    rows = [(start + i, list(map(float, r)) if r is not None else None, i % 3) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, x array<double>, label int").repartition(4)


@pytest.mark.parametrize("n_pivots,k", [(1, 3), (12, 1), (40, 7)])
def test_same_rows_as_all_pairs(spark, n_pivots, k):
    rng = np.random.default_rng(n_pivots)
    centres = rng.uniform(-20, 20, (9, 3))
    draw = lambda n: np.round(centres[rng.integers(0, 9, n)] + rng.standard_normal((n, 3)), 1)
    # rounded, so that distances tie
    train, test = points(spark, draw(260)), points(spark, draw(70), 1000)
    names = dict(key="id", vector="x", label="label")
    want = nearest(test, train, k, **names).collect()
    got = pivots.nearest_by_pivots(test, train, k, pivots=n_pivots, **names).collect()
    order = lambda r: (r["id"], r["place"])
    assert [tuple(r) for r in sorted(got, key=order)] == [tuple(r) for r in sorted(want, key=order)]


def test_most_cells_are_never_met(spark):
    rng = np.random.default_rng(0)
    centres = rng.uniform(-100, 100, (30, 2))
    train = centres[rng.integers(0, 30, 600)] + rng.standard_normal((600, 2))
    members = points(spark, train).select(F.col("id").alias("_tid"), F.col("x").alias("_y"))
    cells = pivots.make_cells(members, 3, 60, 0)
    assert cells.rows.sum() == 600 and len(cells.pivots) <= 60
    test = centres[rng.integers(0, 30, 80)] + rng.standard_normal((80, 2))
    rows = points(spark, test).select(F.col("id").alias("_id"), F.col("x").alias("_x"), F.lit(float("inf")).alias("_reach"))
    met = pivots.visits(rows, cells, 3, first=False).count()
    assert met < 0.2 * 80 * len(cells.pivots)
    # no cell that holds one of the nearest is left out
    apart = np.sqrt(((test[:, None] - train) ** 2).sum(axis=2))
    home = np.sqrt(((train[:, None] - cells.pivots) ** 2).sum(axis=2)).argmin(axis=1)
    looked = {(r["_id"], r["_cell"]) for r in pivots.visits(rows, cells, 3, first=False).collect()}
    looked |= {(r["_id"], r["_cell"]) for r in pivots.visits(rows, cells, 3, first=True).collect()}
    assert all((i, int(home[j])) in looked for i in range(80) for j in np.argsort(apart[i])[:3])


def test_crowded_cell_is_sliced_and_few_rows_are_enough(spark, monkeypatch):
    monkeypatch.setattr(pivots, "_ROWS", 16)
    rng = np.random.default_rng(1)
    x = np.concatenate([np.zeros((60, 2)), rng.standard_normal((40, 2))])
    names = dict(key="id", vector="x", label="label")
    train, test = points(spark, [*x, None]), points(spark, [*x[50:70], None], 500)
    got, want = (sorted(map(tuple, f(test.where("x IS NOT NULL"), train.where("x IS NOT NULL"), 5, **names).collect()))
                 for f in (pivots.nearest_by_pivots, nearest))
    assert got == want
    few = pivots.nearest_by_pivots(test, train.where("id < 2"), 5, **names).collect()
    assert len(few) == 40 and {r["place"] for r in few} == {1, 2}
    assert pivots.nearest_by_pivots(test, train.limit(0), 5, **names).count() == 0
    calls = pivots.knn_by_pivots(test, train, 5, **names).collect()
    assert len(calls) == 20 and {r["prediction"] for r in calls} <= {0, 1, 2}
