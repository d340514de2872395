"""Global order statistics without a single-task window.

A window without PARTITION BY sorts the whole table in one task. Here rows are
range-partitioned on the full sort order (value first, unique key last, so that a
value shared by a third of the rows still spreads over tasks), numbered inside their
partition, and shifted by the sizes of the partitions before. The laid-out rows are
checkpointed once, because the numbering is only meaningful while the layout is fixed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import cut

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


@dataclass(frozen=True)
class Ranked:
    """Rows with a 0-based ``rank`` column, and how many there are."""

    df: DataFrame
    n: int


def nulls_last(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def rank_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    *,
    rank: str = "rank",
    partitions: int | None = None,
) -> Ranked:
    """Number all rows of ``df`` in ``order``. The order must end in a unique key."""
    spark = df.sparkSession
    by = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    # without a stated number, adaptive execution merges neighbouring small partitions,
    # which keeps them in order
    spread = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    laid = cut(
        spread.sortWithinPartitions(*by)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_slot", _ROW_BITS).cast("int"))
    )
    # one row per partition
    sizes = sorted(laid.groupBy("_part").count().collect())
    offsets, before = [], 0
    for part, size in sizes:
        offsets.append((part, before))
        before += size
    table = spark.createDataFrame(offsets or [(0, 0)], "_part int, _before long")
    numbered = (
        laid.join(F.broadcast(table), "_part")
        .withColumn(rank, F.col("_before") + F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_slot", "_part", "_before")
    )
    return Ranked(numbered, before)


def tile_of(rank: Column, n_rows: int | Column, tiles: int) -> Column:
    """0-based equal-count split: the first ``n_rows mod tiles`` tiles hold one row more."""
    n = F.lit(n_rows) if isinstance(n_rows, int) else n_rows
    small = F.floor(n / F.lit(tiles))
    extra = F.pmod(n, F.lit(tiles))
    wide = extra * (small + 1)
    return (
        F.when(rank < wide, F.floor(rank / (small + 1)))
        .otherwise(extra + F.floor((rank - wide) / F.greatest(small, F.lit(1))))
        .cast("int")
    )


def tile_starts(n: int, tiles: int) -> list[int]:
    """Ranks at which the tiles of :func:`tile_of` begin; equal where a tile is empty."""
    return [t * (n // tiles) + min(t, n % tiles) for t in range(tiles)]


def rows_at(ranked: Ranked, places: Sequence[int]) -> dict[int, Row]:
    """The rows of a few places, by place."""
    wanted = sorted({p for p in places if p < ranked.n})
    return {r["rank"]: r for r in ranked.df.where(F.col("rank").isin(wanted)).collect()}


def not_before(value: Column, key: Column, at: Row, *, descending: bool = False) -> Column:
    """True for rows at or after the row ``at`` (_v, _k) by value, nulls last, then key."""
    tied = key >= F.lit(at["_k"])
    if at["_v"] is None:
        return value.isNull() & tied
    edge = F.lit(at["_v"])
    beyond = value < edge if descending else value > edge
    return value.isNull() | beyond | ((value == edge) & tied)


def add_tile(
    df: DataFrame, column: str, tiles: int, *, key: str, out: str, descending: bool = False
) -> DataFrame:
    """Equal-count split of all rows by ``column``, ties broken by ``key``; 0-based.

    Only the column and the key are ranked. The rows at which tiles begin are fetched, and
    the other columns are labelled where they are, by comparison with these few rows.
    """
    df = cut(df)
    first = F.col("_v").desc_nulls_last() if descending else F.col("_v").asc_nulls_last()
    ranked = rank_rows(df.select(F.col(column).alias("_v"), F.col(key).alias("_k")), [first, "_k"])
    starts = tile_starts(ranked.n, tiles)[1:]
    edges = rows_at(ranked, starts)
    label = F.lit(0)
    for start in starts:
        if start in edges:
            reached = not_before(F.col(column), F.col(key), edges[start], descending=descending)
            label = label + reached.cast("int")
    return df.withColumn(out, label.cast("int"))


_COLLECTED = 100_000  # values of a bracket that may go to the driver
_ACCURACY = 10_000


def order_statistics(
    rows: DataFrame, ranks: Sequence[int], margin: float = 2 / _ACCURACY
) -> dict[int, float]:
    """The values ``_v`` (no nulls) at 0-based ``ranks`` of a fixed table, without a sort.

    Approximate percentiles bracket each rank, a count places the bracket, and the few
    values inside, with their counts, tell the rank exactly. A bracket that still holds
    too many rows is narrowed in the same way; one of a single value is the answer.
    """
    n = rows.count()
    around = [
        F.percentile_approx("_v", [max(0.0, (r - 1) / n - margin), min(1.0, (r + 2) / n + margin)], _ACCURACY)
        for r in ranks
    ]
    brackets = [tuple(x) for x in rows.agg(*[a.alias(f"b{i}") for i, a in enumerate(around)]).first()]
    counts = rows.agg(
        *[F.count(F.when(F.col("_v") < lo, 1)) for lo, _ in brackets],
        *[F.count(F.when(F.col("_v").between(lo, hi), 1)) for lo, hi in brackets],
    ).first()
    found: dict[int, float] = {}
    for i, (rank, (lo, hi)) in enumerate(zip(ranks, brackets)):
        before, inside = counts[i], counts[len(ranks) + i]
        if not before <= rank < before + inside:
            # the percentile was further off than it states
            found[rank] = order_statistics(rows, [rank], 10 * margin)[rank]
            continue
        part = rows.where(F.col("_v").between(lo, hi))
        if lo == hi:
            found[rank] = lo
        elif inside > _COLLECTED and inside < n:
            found[rank] = order_statistics(part, [rank - before])[rank - before]
        else:
            for value, count in sorted(part.groupBy("_v").count().collect()):
                before += count
                if rank < before:
                    found[rank] = value
                    break
    return found


def exact_quantiles(
    df: DataFrame, column: str, probs: Sequence[float], *, key: str
) -> list[float | None]:
    """Linearly interpolated quantiles of a column, nulls left out.

    The column alone is checkpointed, and :func:`order_statistics` finds the two values of
    each probability in three passes over it.
    """
    rows = cut(df.select(F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull()))
    n = rows.count()
    if n == 0:
        return [None] * len(probs)
    at = [(n - 1) * p for p in probs]
    wanted = sorted({int(math.floor(h)) for h in at} | {int(math.ceil(h)) for h in at})
    found = order_statistics(rows, wanted)
    out = []
    for h in at:
        lo, hi = found[math.floor(h)], found[math.ceil(h)]
        out.append(lo + (hi - lo) * (h - math.floor(h)))
    return out


def affine_place(place: Column | str, step: tuple[int, int], n: int) -> Column:
    """``(a*place + b) mod n``, in decimals wide enough for the product."""
    a, b = (F.lit(str(x)).cast("decimal(19,0)") for x in step)
    p = F.col(place) if isinstance(place, str) else place
    return F.pmod(p.cast("decimal(18,0)") * a + b, F.lit(str(n)).cast("decimal(19,0)")).cast("long")


def affine_steps(n: int, count: int, seed: int) -> list[tuple[int, int]]:
    """``count`` pairs (a, b) such that ``i -> (a*i + b) mod n`` permutes 0..n-1."""
    import random

    rng = random.Random(seed)
    steps = []
    for _ in range(count):
        a = 1
        if n > 2:
            a = rng.randrange(1, n)
            while math.gcd(a, n) != 1:
                a = rng.randrange(1, n)
        steps.append((a, rng.randrange(n) if n else 0))
    return steps
