"""Partial pooling: fit on a period, predict on the period grid, join to actuals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.fits import (
    Pool,
    band_with_actuals,
    fit_pool,
    pooled_summary,
    predictive_band,
)
from ..operators.series import slice_period

# The period the pooled lines are fitted on; weeks count from its first day.
LOCKDOWN = ("2020-03-24", "2020-06-15")


def pooled_lines(
    series: DataFrame, *, key: str, time: str, value: str, span: tuple[str, str] = LOCKDOWN
) -> tuple[Pool, DataFrame, DataFrame]:
    """Population level, posterior summary per key, and the band joined to actual values."""
    pool, posterior = fit_pool(series, span, span[0], key=key, time=time, value=value)
    used = slice_period(series, *span, time=time)
    band = predictive_band(posterior, pool, span[0], key=key, time=time, periods=used)
    return (
        pool,
        pooled_summary(posterior, key=key),
        band_with_actuals(band, used, key=key, time=time, value=value),
    )
