"""Keyed joins.

Tables read from files carry their size, so the optimizer broadcasts a lookup by
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with adaptive execution
splitting skewed partitions. A broadcast is forced only by ``join_counted``, behind a count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import rank_rows

BROADCAST_ROWS = 200_000


def join_counted(
    df: DataFrame, stored: DataFrame, on: str | list[str], how: str, *, limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Join to a checkpointed table of narrow rows, broadcast when it has few enough.

    A checkpoint carries no size, so without the count a small table would make the large
    side shuffle, hot keys and all.
    """
    few = stored.limit(limit + 1).count() <= limit
    return df.join(F.broadcast(stored) if few else stored, on, how)


def merge_all(parts: Sequence[DataFrame], on: str | list[str], how: str = "full") -> DataFrame:
    return reduce(lambda a, b: a.join(b, on, how), parts)


def merge_suffixed(
    left: DataFrame, right: DataFrame, on: str, *, how: str = "inner", suffixes=("_x", "_y")
) -> DataFrame:
    """Join on ``on``; columns that both sides have get a suffix."""
    shared = [c for c in left.columns if c in right.columns and c != on]
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return a.join(b, on, how)


def fan_out(df: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Inner join to a many-to-many lookup: a row repeats for each match."""
    return df.join(lookup, on, "inner")


def attach(df: DataFrame, table: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join by key; never by row position."""
    return df.join(table, on, "left")


def name_of(df: DataFrame, names: DataFrame, on: str) -> DataFrame:
    """Id to name; ids without a name keep NULL. A repeated id takes its smallest row."""
    others = [c for c in names.columns if c != on]
    # the smallest row as a whole, so that its columns belong together
    one = names.groupBy(on).agg(F.min(F.struct(*others)).alias("_n")).select(on, "_n.*")
    return df.join(one, on, "left")


def index_encode(df: DataFrame, column: str, *, out: str = "code") -> DataFrame:
    """0-based code of each value in the order of the values; NULL has no code.

    The codes are counted and broadcast when they are few, so a value that very many rows
    share is not shuffled.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    codes = rank_rows(values, [column], rank=out)
    return join_counted(df, codes.df, column, "left")


def period_grid(df: DataFrame, *, key: str, time: str) -> DataFrame:
    """Every key with every observed period.

    The periods form one array of at most one entry per calendar day, read as a scalar
    subquery, and each key explodes it: no join between keys and periods.
    """
    days = df.select(F.sort_array(F.collect_set(F.col(time).cast("date"))).alias("d"))
    return df.select(key).distinct().withColumn(time, F.explode(days.scalar()))
