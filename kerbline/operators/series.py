"""Entity x period series kept long: densify, interpolate, drop, slice, cap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import cap as cap_column
from ..functions.scalars import within
from ..session import cut


def duplicate_periods(df: DataFrame, *, key: str, time: str) -> DataFrame:
    """(key, period) pairs that occur more than once, with their counts."""
    return (
        df.groupBy(key, F.col(time).cast("date").alias(time))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def unique_periods(df: DataFrame, *, key: str, time: str, value: str) -> DataFrame:
    """One row per (key, day); a repeated pair stops the query."""
    n = F.count(F.lit(1))
    return df.groupBy(key, F.col(time).cast("date").alias(time)).agg(
        F.when(
            n > 1, F.raise_error(F.lit(f"more than one row for a ({key}, {time}) pair"))
        )
        .otherwise(F.max(F.col(value).cast("double")))
        .cast("double")
        .alias(value)
    )


def calendar(df: DataFrame, *, time: str) -> DataFrame:
    """The observed periods with their 0-based position ``pos`` and their number.

    One row per calendar day at most, so it is small whatever the size of ``df``:
    that is the bound behind the broadcasts in this module.
    """
    return (
        df.select(F.col(time).cast("date").alias(time))
        .where(F.col(time).isNotNull())
        .distinct()
        .withColumn("pos", F.row_number().over(Window.orderBy(time)) - 1)
        .withColumn("n_periods", F.count(F.lit(1)).over(Window.partitionBy()).cast("int"))
    )


def densify(
    df: DataFrame,
    *,
    key: str,
    time: str,
    value: str,
    keep_incomplete: bool = True,
    unique: bool = False,
    periods: DataFrame | None = None,
) -> DataFrame:
    """Give every key a row for every observed period and fill the gaps.

    Gaps inside a series are linear in the *position* of the period, gaps at the end
    repeat the last value, gaps at the start stay NULL. With ``keep_incomplete=False``
    keys that would keep a NULL are left out before any row is generated for them.

    No key x period grid is joined: each observation emits the stretch of positions up
    to the next observation of its key. A key's window holds one row per period.

    ``unique=True`` says that ``df`` already has one row per (key, day). ``periods`` are rows
    with all the days the calendar is to have; without them the days come from ``df``, which
    is worked out once and checkpointed for the two uses.
    """
    base = df if unique else unique_periods(df, key=key, time=time, value=value)
    base = base.select(key, F.col(time).cast("date").alias(time), F.col(value).cast("double"))
    if periods is None:
        periods = base = cut(base)
    days = calendar(periods, time=time)

    placed = base.join(F.broadcast(days), time).select(key, "pos", "n_periods", value)
    along = Window.partitionBy(key).orderBy("pos")
    # the frame of the whole key, stated over the same order to share its sort
    throughout = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a key without any value keeps one row, so that it still shows up as all NULL
    held = (
        placed.withColumn("_seen", F.count(value).over(throughout))
        .withColumn("_nth", F.row_number().over(along))
        .where(F.col(value).isNotNull() | ((F.col("_seen") == 0) & (F.col("_nth") == 1)))
    )
    linked = held.select(
        key,
        "n_periods",
        F.col("pos").alias("_p0"),
        F.col(value).alias("_v0"),
        F.lead("pos").over(along).alias("_p1"),
        F.lead(value).over(along).alias("_v1"),
        F.min("pos").over(throughout).alias("_start"),
    )
    if not keep_incomplete:
        linked = linked.where((F.col("_start") == 0) & F.col("_v0").isNotNull())
    begin = F.when(F.col("_p0") == F.col("_start"), 0).otherwise(F.col("_p0"))
    stop = F.coalesce(F.col("_p1"), F.col("n_periods")) - 1
    step = F.try_divide(
        F.col("_v1") - F.col("_v0"), (F.col("_p1") - F.col("_p0")).cast("double")
    )
    filled = (
        linked.withColumn("pos", F.explode(F.sequence(begin.cast("int"), stop.cast("int"))))
        .withColumn("_gap", F.col("pos") - F.col("_p0"))
        .withColumn(
            value,
            F.when(F.col("_gap") < 0, F.lit(None).cast("double"))
            .when(F.col("_gap") == 0, F.col("_v0"))
            .otherwise(F.col("_v0") + F.coalesce(step, F.lit(0.0)) * F.col("_gap")),
        )
        .withColumn("is_filled", (F.col("_gap") != 0) & F.col(value).isNotNull())
    )
    return filled.join(F.broadcast(days.select("pos", time)), "pos").select(
        key, time, "pos", value, "is_filled"
    )


def drop_incomplete(df: DataFrame, *, key: str, value: str) -> DataFrame:
    """Remove every key that has a NULL anywhere in its series."""
    gaps = F.count(F.when(F.col(value).isNull(), 1)).over(Window.partitionBy(key))
    return df.withColumn("_gaps", gaps).where(F.col("_gaps") == 0).drop("_gaps")


def slice_period(df: DataFrame, start, end, *, time: str) -> DataFrame:
    """Rows between two days, both included."""
    return df.where(within(time, start, end))


def extract_series(
    df: DataFrame,
    start,
    end,
    *,
    key: str,
    time: str,
    value: str,
    upper: float | None = 5.0,
    unique: bool = False,
    periods: DataFrame | None = None,
) -> DataFrame:
    """Densify, drop incomplete keys over the whole range, then slice, then cap."""
    full = densify(
        df, key=key, time=time, value=value, keep_incomplete=False, unique=unique, periods=periods
    )
    part = slice_period(full, start, end, time=time)
    return part if upper is None else part.withColumn(value, cap_column(value, upper))
