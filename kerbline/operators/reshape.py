"""Row/column reshaping and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column layout of the weekly year-over-year spend table.
MEASURES = ["txn_amt", "txn_cnt"]
DAY_KINDS = ["we", "wd"]
WEEKEND_SHIFT_DAYS = 5


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from a part is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stack_day_kinds(
    df: DataFrame,
    *,
    key: str,
    name: str,
    time: str = "week_start",
    prefix: str = "",
    sector: str = "retail",
    measures: Sequence[str] = tuple(MEASURES),
    out_time: str = "period_start",
) -> DataFrame:
    """Weekend and weekday columns to rows in one scan; weekends move to Saturday.

    The result is not sorted: order rows where they are written or shown.
    """
    def row(kind: str):
        day = F.col(time).cast("date")
        shifted = F.date_add(day, WEEKEND_SHIFT_DAYS) if kind == "we" else day
        return F.struct(
            shifted.alias(out_time),
            *[F.col(f"{prefix}{m}_{kind}_{sector}").cast("double").alias(m) for m in measures],
            F.lit(kind).alias("we_wd"),
        )

    stacked = df.select(
        F.col(key), F.col(name), F.explode(F.array(*[row(k) for k in DAY_KINDS])).alias("_r")
    )
    return stacked.select(
        F.col(f"_r.{out_time}").alias(out_time),
        key,
        name,
        *[F.col(f"_r.{m}").alias(m) for m in measures],
        F.col("_r.we_wd").alias("we_wd"),
    )


def widen(
    df: DataFrame, *, index: str, columns: str, value: str, categories: Sequence, prefix: str = ""
) -> DataFrame:
    """Long to wide for export, over a stated list of columns."""
    return df.groupBy(index).agg(
        *[
            F.max(F.when(F.col(columns) == F.lit(c), F.col(value))).alias(f"{prefix}{c}")
            for c in categories
        ]
    )


def one_hot(
    df: DataFrame, column: str, categories: Sequence, *, prefix: str | None = None, drop: bool = True
) -> DataFrame:
    """A 0/1 column per category; NULL is 0 in all of them."""
    stem = column if prefix is None else prefix
    out = df.withColumns(
        {
            f"{stem}_{c}": F.coalesce((F.col(column) == F.lit(c)).cast("int"), F.lit(0))
            for c in categories
        }
    )
    return out.drop(column) if drop else out
