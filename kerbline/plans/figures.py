"""Tables behind the figures: what a chart needs, not the drawing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import days_since, within
from ..operators.aggregates import Span, fit_lines
from ..operators.groups import cell_profiles, cell_series, plot_cells


def profiles_with_lines(
    series: DataFrame,
    fits: Mapping[str, tuple[Span, str]],
    *,
    key: str,
    time: str,
    value: str,
) -> DataFrame:
    """Series rows with the value of each fit, NULL outside the span of that fit."""
    lines = fit_lines(series, fits, key=key, time=time, value=value)
    wide = lines.groupBy(key).agg(
        *[
            F.max(F.when(F.col("fit") == name, F.col(part))).alias(f"_{part}_{name}")
            for name in fits
            for part in ("slope", "intercept")
        ]
    )
    out = series.select(key, time, value).join(wide, key, "left")
    return out.select(
        key,
        time,
        value,
        *[
            F.when(
                within(time, *span),
                F.col(f"_intercept_{name}") + F.col(f"_slope_{name}") * days_since(time, t0),
            ).alias(f"fit_{name}")
            for name, (span, t0) in fits.items()
        ],
    )


def grouped_profiles(
    series: DataFrame,
    stats: DataFrame,
    first: str,
    second: str,
    bins: int,
    *,
    key: str,
    time: str,
    value: str,
    equal_counts: bool = True,
    low_pct: float = 5,
    high_pct: float = 90,
) -> tuple[DataFrame, DataFrame]:
    """(cell, key, period, value) and (cell, period, mean) of a grouped grid."""
    cells = plot_cells(
        stats, first, second, bins, key=key, equal_counts=equal_counts,
        low_pct=low_pct, high_pct=high_pct,
    )
    return (
        cell_series(series, cells, key=key, time=time, value=value),
        cell_profiles(series, cells, key=key, time=time, value=value),
    )
