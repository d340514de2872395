import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbline.operators import groups, ranking


def frame(spark, values, other=None):
    other = values if other is None else other
    return spark.createDataFrame(
        [(i, None if a is None else float(a), float(b)) for i, (a, b) in enumerate(zip(values, other))],
        "key long, a double, b double",
    )


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(0, 5), min_size=1, max_size=40), tiles=st.integers(1, 6))
def test_equal_split_matches_array_split(spark, values, tiles):
    order = sorted(range(len(values)), key=lambda i: (values[i], i))
    want = {int(i): t for t, part in enumerate(np.array_split(order, tiles)) for i in part}
    out = ranking.add_tile(frame(spark, values), "a", tiles, key="key", out="tile").collect()
    assert {r["key"]: r["tile"] for r in out} == want


def test_split_sizes(spark):
    out = ranking.add_tile(frame(spark, range(14)), "a", 4, key="key", out="tile")
    assert [r["n"] for r in out.groupBy("tile").agg(F.count("*").alias("n")).orderBy("tile").collect()] == [4, 4, 3, 3]


def test_nulls_rank_last(spark):
    out = ranking.rank_rows(frame(spark, [3, None, 1], [0, 0, 0]), ["a", "key"]).df
    assert {r["key"]: r["rank"] for r in out.collect()} == {2: 0, 0: 1, 1: 2}


def test_a_hot_value_spreads_over_partitions(spark):
    rows = spark.range(3000).select(F.col("id").alias("key"), F.lit(1.0).alias("a"))
    ranked = ranking.rank_rows(rows, ["a", "key"], partitions=6)
    sizes = [r["count"] for r in ranked.df.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1500
    assert ranked.df.where(F.col("rank") != F.col("key")).count() == 0


@pytest.mark.parametrize("probs", [[0, 0.25, 0.5, 0.75, 1], [0.1, 0.9]])
def test_quantiles_match_numpy(spark, probs):
    values = np.random.default_rng(3).normal(size=57)
    got = ranking.exact_quantiles(frame(spark, values), "a", probs, key="key")
    assert got == pytest.approx(list(np.quantile(values, probs)), abs=1e-12)


def test_quantile_labels(spark):
    out = groups.quantile_label(frame(spark, [1, 2, 3, 4, 5]), "a", key="key").orderBy("key").collect()
    assert [r["label"] for r in out] == [0, 0, 1, 2, 3]
    values = np.random.default_rng(4).normal(size=41)
    want = pd.qcut(pd.Series(values), 4, labels=False).tolist()
    got = groups.quantile_label(frame(spark, values), "a", key="key").orderBy("key").collect()
    assert [r["label"] for r in got] == want


def test_tied_quantile_edges(spark):
    rows = frame(spark, [1, 1, 1, 1, 5])
    with pytest.raises(ValueError, match="not unique"):
        groups.quantile_label(rows, "a", key="key")
    merged = groups.quantile_label(rows, "a", key="key", duplicates="merge").collect()
    assert {r["label"] for r in merged} == {0}


def test_edge_bins(spark):
    rows = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 1.0, 2.0, 3.0)] + [(None,)], "v double")
    got = [r[0] for r in rows.select(groups.edge_bin("v", [0.0, 1.0, 2.0])).collect()]
    assert got == [0, 1, 2, 2, 3, None]


def test_two_level_split_against_numpy(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 10, 50), rng.normal(size=50)
    rows = frame(spark, a, b)
    order = sorted(range(50), key=lambda i: (a[i], i))
    want = {}
    for i, part in enumerate(np.array_split(order, 3)):
        inner = sorted(part, key=lambda k: (b[k], k))
        for j, cell in enumerate(np.array_split(inner, 3)):
            for k in cell:
                want[int(k)] = (i, j)
    out = groups.two_level_split(rows, "a", "b", 3, key="key").collect()
    assert {r["key"]: (r["_i"], r["_j"]) for r in out} == want
    means = groups.split_with_means(rows, "a", "b", 3, key="key").collect()
    cell = [r for r in means if r["group_num"] == 4]
    ids = [k for k, ij in want.items() if ij == (1, 1)]
    assert cell[0]["group_b"] == pytest.approx(np.mean(b[ids]))


def test_percentile_cells_against_numpy(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=80), rng.normal(size=80)
    out = groups.percentile_cells(frame(spark, a, b), "a", "b", 4, key="key").collect()

    def bins(x):
        edges = np.linspace(np.percentile(x, 10), np.percentile(x, 90), 5)
        at = np.digitize(x, edges)
        at[x == edges[-1]] = 4
        return at

    ra, rb = bins(a), bins(b)
    assert all(r["row"] == ra[r["key"]] and r["column"] == rb[r["key"]] for r in out)
    assert all(r["group"] == r["row"] * 6 + r["column"] for r in out)
    counts = groups.cell_counts(groups.percentile_cells(frame(spark, a, b), "a", "b", 4, key="key"), 4)
    assert counts.count() == 16
    inner = sum(1 for x, y in zip(ra, rb) if 1 <= x <= 4 and 1 <= y <= 4)
    assert counts.agg(F.sum("n")).first()[0] == inner


def test_even_cells_split_each_column_on_its_own(spark):
    out = groups.even_cells(frame(spark, [1, 2, 3, 4], [4, 3, 2, 1]), "a", "b", 2, key="key")
    got = {r["key"]: (r["row_even"], r["column_even"], r["group_even"]) for r in out.collect()}
    assert got == {0: (0, 1, 1), 1: (0, 1, 1), 2: (1, 0, 2), 3: (1, 0, 2)}


def test_month_ratio_and_labels(spark):
    rows = spark.createDataFrame(
        [(k, f"2021-{m:02d}-15", float(k if m == 12 else 1)) for k in (1, 2, 3, 4, 5) for m in (9, 10, 11, 12)]
        + [(6, "2021-12-15", 1.0)],
        "key long, t string, v double",
    ).withColumn("t", F.col("t").cast("date"))
    out = groups.risk_labels(rows, "2021-12", "2021-09", "2021-12", key="key", time="t", value="v")
    got = {r["key"]: (r["ratio"], r["label"]) for r in out.collect()}
    assert got == {1: (1.0, 0), 2: (2.0, 0), 3: (3.0, 1), 4: (4.0, 2), 5: (5.0, 3)}
