"""Labels and cells: quantile labels, equal-count splits, percentile-range bins.

Inputs hold one row per key. Where edges are needed before rows can be labelled, the input
is checkpointed first, so that what it was computed from is read once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import month_window, ratio, within
from ..session import cut
from .aggregates import in_span
from .ranking import add_tile, exact_quantiles, not_before, rank_rows, rows_at, tile_starts


def quantile_label(
    df: DataFrame,
    column: str,
    *,
    key: str,
    bins: int = 4,
    out: str = "label",
    duplicates: str = "raise",
) -> DataFrame:
    """Label 0..bins-1 by interpolated quantile edges, right-closed, lowest included.

    Tied edges are an error; ``duplicates="merge"`` keeps the distinct edges instead.
    This is not an equal-count split: equal values always share a label.
    """
    df = cut(df)
    edges = exact_quantiles(df, column, [i / bins for i in range(bins + 1)], key=key)
    if edges[0] is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    distinct = sorted(set(edges))
    if len(distinct) < len(edges):
        if duplicates != "merge":
            raise ValueError(f"quantile edges of {column} are not unique: {edges}")
        edges = distinct
    label = F.lit(0)
    for edge in edges[1:-1]:
        label = label + (F.col(column) > F.lit(edge)).cast("int")
    return df.withColumn(out, label.cast("int"))


def _month_end(first: str) -> str:
    start = dt.date.fromisoformat(first)
    return str((start + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1))


def month_ratio(
    df: DataFrame,
    month: str,
    start: str,
    end: str,
    *,
    key: str,
    time: str,
    value: str,
    out: str = "ratio",
    count: str | None = None,
) -> DataFrame:
    """Mean of one month over the mean of the comparison months, keys with both only.

    The comparison months end before the month of ``end``. With ``count`` a row stands for
    so many, ``value`` is their sum, and ``time`` any day of their month.
    """
    first, last = month_window(start, end)
    m = f"{month[:7]}-01"

    def mean(span: tuple[str, str]) -> Column:
        v = in_span(value, time, span)
        return F.try_divide(F.sum(v), F.sum(in_span(count, time, span))) if count else F.avg(v)

    latest, usual = mean((m, _month_end(m))), mean((first, last))
    wanted = within(time, m, _month_end(m)) | within(time, first, last)
    return (
        df.where(wanted)
        .groupBy(key)
        .agg(latest.alias("latest"), usual.alias("usual"))
        .where(F.col("latest").isNotNull() & F.col("usual").isNotNull())
        .withColumn(out, ratio("latest", "usual"))
    )


def risk_labels(
    df: DataFrame, month: str, start: str, end: str, *, key, time, value, count: str | None = None
) -> DataFrame:
    """Quartile label of the month ratio; the key stays with its label."""
    table = month_ratio(df, month, start, end, key=key, time=time, value=value, count=count)
    return quantile_label(table, "ratio", key=key).select(key, "ratio", "label")


def two_level_split(
    df: DataFrame, first: str, second: str, tiles: int, *, key: str
) -> DataFrame:
    """Equal-count split by ``first``, then inside each part by ``second``.

    Adds 0-based ``_i`` and ``_j``. Both levels rank a value and the key alone, over the
    whole table, so a part of it is never sorted by a single task. The rows at which parts
    begin are fetched, and all other columns are labelled by comparison with them.
    """
    parted = add_tile(df, first, tiles, key=key, out="_i")
    narrow = parted.select("_i", F.col(second).alias("_v"), F.col(key).alias("_k"))
    ranked = rank_rows(narrow, ["_i", "_v", "_k"])
    starts = tile_starts(ranked.n, tiles)
    sizes = [b - a for a, b in zip(starts, [*starts[1:], ranked.n])]
    begins = {
        (i, j): start + inner
        for i, (start, size) in enumerate(zip(starts, sizes))
        for j, inner in enumerate(tile_starts(size, tiles))
        if j and inner < size
    }
    # tiles * (tiles - 1) rows
    edges = rows_at(ranked, list(begins.values()))
    label = F.lit(0)
    for (i, _), place in begins.items():
        reached = (F.col("_i") == i) & not_before(F.col(second), F.col(key), edges[place])
        label = label + reached.cast("int")
    return parted.withColumn("_j", label.cast("int"))


def split_with_means(
    df: DataFrame, first: str, second: str, tiles: int = 4, *, key: str
) -> DataFrame:
    """Two-level split with the cell means of both columns and a 0-based cell number."""
    cells = two_level_split(df, first, second, tiles, key=key)
    # tiles * tiles rows
    means = cells.groupBy("_i", "_j").agg(
        F.avg(first).alias(f"group_{first}"), F.avg(second).alias(f"group_{second}")
    )
    return (
        cells.join(F.broadcast(means), ["_i", "_j"])
        .withColumn("group_num", (F.col("_i") * tiles + F.col("_j")).cast("int"))
        .drop("_i", "_j")
    )


def split_table(
    df: DataFrame, first: str, second: str, tiles: int, *, key: str, name: str | None = None
) -> DataFrame:
    """Two-level split as a table of 1-based group, row and column numbers."""
    cells = two_level_split(df, first, second, tiles, key=key)
    return cells.select(
        key,
        *([name] if name else []),
        first,
        second,
        (F.col("_i") * tiles + F.col("_j") + 1).cast("int").alias("overall_group"),
        (F.col("_i") + 1).cast("int").alias("group_1"),
        (F.col("_j") + 1).cast("int").alias("group_2"),
    )


def bin_edges(
    df: DataFrame, column: str, bins: int, low_pct: float, high_pct: float, *, key: str
) -> list[float]:
    """``bins + 1`` evenly spaced edges between two percentiles."""
    lo, hi = exact_quantiles(df, column, [low_pct / 100, high_pct / 100], key=key)
    if lo is None:
        raise ValueError(f"{column} holds no values")
    return [lo + i * ((hi - lo) / bins) for i in range(bins)] + [hi]


def edge_bin(column: Column | str, edges: Sequence[float]) -> Column:
    """0 below the edges, 1..n between them, n+1 above; the last edge belongs to bin n."""
    v = F.col(column) if isinstance(column, str) else column
    reached = F.lit(0)
    for edge in edges[:-1]:
        reached = reached + (v >= F.lit(edge)).cast("int")
    return (reached + (v > F.lit(edges[-1])).cast("int")).cast("int")


def percentile_cells(
    df: DataFrame,
    first: str,
    second: str,
    bins: int = 4,
    *,
    key: str,
    low_pct: float = 10,
    high_pct: float = 90,
    names: tuple[str, str, str] = ("row", "column", "group"),
) -> DataFrame:
    """Two-way bins over percentile ranges, with bins for values outside them."""
    r, c, g = names
    df = cut(df)
    one = bin_edges(df, first, bins, low_pct, high_pct, key=key)
    two = bin_edges(df, second, bins, low_pct, high_pct, key=key)
    return (
        df.withColumn(r, edge_bin(first, one))
        .withColumn(c, edge_bin(second, two))
        .withColumn(g, (F.col(r) * (bins + 2) + F.col(c)).cast("int"))
    )


def even_cells(
    df: DataFrame,
    first: str,
    second: str,
    bins: int = 4,
    *,
    key: str,
    names: tuple[str, str, str] = ("row", "column", "group"),
) -> DataFrame:
    """Independent equal-count split of both columns, 0-based."""
    r, c, g = (f"{n}_even" for n in names)
    out = add_tile(df, first, bins, key=key, out=r)
    out = add_tile(out, second, bins, key=key, out=c)
    return out.withColumn(g, (F.col(r) * bins + F.col(c)).cast("int"))


def cell_counts(df: DataFrame, bins: int, *, row: str = "row", column: str = "column") -> DataFrame:
    """Keys per inner cell on the full grid, empty cells included."""
    spark = df.sparkSession
    grid = spark.range(bins * bins).select(
        (F.floor(F.col("id") / bins) + 1).cast("int").alias(row),
        (F.pmod("id", F.lit(bins)) + 1).cast("int").alias(column),
    )
    counts = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, [row, column], "left").select(
        row, column, F.coalesce("n", F.lit(0)).alias("n")
    )


def plot_cells(
    df: DataFrame,
    first: str,
    second: str,
    bins: int = 4,
    *,
    key: str,
    equal_counts: bool = True,
    low_pct: float = 5,
    high_pct: float = 90,
) -> DataFrame:
    """Cell 1..bins^2 of each key; range bins leave out keys outside the ranges."""
    if equal_counts:
        cells = two_level_split(df, first, second, bins, key=key)
        return cells.withColumn("cell", (F.col("_i") * bins + F.col("_j") + 1).cast("int")).drop(
            "_i", "_j"
        )
    binned = percentile_cells(
        df, first, second, bins, key=key, low_pct=low_pct, high_pct=high_pct,
        names=("_row", "_col", "_grp"),
    )
    inner = binned.where(F.col("_row").between(1, bins) & F.col("_col").between(1, bins))
    return inner.withColumn(
        "cell", ((F.col("_row") - 1) * bins + F.col("_col")).cast("int")
    ).drop("_row", "_col", "_grp")


def cell_means(cells: DataFrame, names: Sequence[str], *, cell: str = "cell") -> DataFrame:
    return cells.groupBy(cell).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in names]
    )


def cell_series(
    series: DataFrame, cells: DataFrame, *, key: str, time: str, value: str, cell: str = "cell"
) -> DataFrame:
    """Series rows with the cell of their key."""
    return series.select(key, time, value).join(cells.select(key, cell), key)


def cell_profiles(
    series: DataFrame, cells: DataFrame, *, key: str, time: str, value: str, cell: str = "cell"
) -> DataFrame:
    """Mean series of each cell."""
    rows = cell_series(series, cells, key=key, time=time, value=value, cell=cell)
    return rows.groupBy(cell, time).agg(F.avg(value).alias("mean_value"))
