"""Column choices, derived columns and row filters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import cap, month_window, ratio, row_mean, safe_log, within


def quoted(name: str) -> str:
    """Column reference for names that hold spaces, dots or percent signs."""
    return "`" + name.replace("`", "``") + "`"


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def columns_except(df: DataFrame, names: Sequence[str]) -> list[str]:
    left_out = set(names)
    return [c for c in df.columns if c not in left_out]


def select_like(df: DataFrame, pattern: str, keep: Sequence[str] = ()) -> DataFrame:
    wanted = list(keep) + [c for c in columns_like(df, pattern) if c not in keep]
    return df.select(*[quoted(c) for c in wanted])


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """New columns ``name -> (top, bottom)``; a zero bottom gives NULL."""
    return df.withColumns(
        {name: ratio(F.col(quoted(a)), F.col(quoted(b))) for name, (a, b) in ratios.items()}
    )


def log_columns(df: DataFrame, names: Sequence[str], prefix: str = "log_") -> DataFrame:
    """Replace each column by its log under ``prefix``."""
    return df.withColumns({prefix + c: safe_log(F.col(quoted(c))) for c in names}).drop(*names)


def cap_columns(df: DataFrame, names: Sequence[str], upper: float) -> DataFrame:
    return df.withColumns({c: cap(F.col(quoted(c)), upper) for c in names})


def in_months(df: DataFrame, start: str, end: str, *, time: str) -> DataFrame:
    """Rows of the months from ``start`` up to, not including, the month of ``end``."""
    first, last = month_window(start, end)
    return df.where(within(time, first, last))


def in_list(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(quoted(column)).isin(list(values)))


def in_table(df: DataFrame, wanted: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in another table, without changing row counts."""
    return df.join(wanted.select(on), on, "left_semi")


def complete_rows(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=None if names is None else list(names))


def average_day_kinds(
    df: DataFrame,
    *,
    keep: Sequence[str],
    prefix: str = "",
    sector: str = "retail",
    measures: Sequence[str] = ("txn_amt", "txn_cnt"),
    time: str = "week_start",
    out_time: str = "period_start",
) -> DataFrame:
    """Mean of the weekend and weekday column of each measure, skipping nulls."""
    return df.select(
        F.col(time).cast("date").alias(out_time),
        *keep,
        *[
            row_mean([f"{prefix}{m}_we_{sector}", f"{prefix}{m}_wd_{sector}"]).alias(m)
            for m in measures
        ],
    )
