"""Per-key statistics. All windows of one call are computed in one pass over the data.

Every aggregate here has a partial form, so a hot key is reduced before the shuffle.
The one exception, an exact percentile per key, holds a key's distinct values and is
meant for series with one value per day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import days_since, ordinal_day, ratio, row_sum, within
from .projection import columns_like, quoted
from .series import unique_periods

Span = tuple[str, str]


def in_span(value: Column | str, time: str, span: Span) -> Column:
    """The value inside the span, NULL outside it."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(within(time, *span), v)


def mean_and_spread(
    df: DataFrame, *, key: str, value: str, mean: str = "mean", sd: str = "std"
) -> DataFrame:
    """Mean and sample standard deviation; a single row has no spread (NULL)."""
    return df.groupBy(key).agg(F.avg(value).alias(mean), F.stddev_samp(value).alias(sd))


def sum_per_key(df: DataFrame, names: Sequence[str], *, key: str) -> DataFrame:
    """Sums that are 0 for an all-null column."""
    return df.groupBy(key).agg(
        *[F.coalesce(F.sum(F.col(quoted(c))), F.lit(0.0)).alias(c) for c in names]
    )


def span_means(
    df: DataFrame, spans: Mapping[str, Span], *, key: str, time: str, value: str
) -> DataFrame:
    return df.groupBy(key).agg(
        *[F.avg(in_span(value, time, s)).alias(name) for name, s in spans.items()]
    )


def hit_ratios(
    df: DataFrame,
    spans: Mapping[str, tuple[Span, Span]],
    *,
    key: str,
    time: str,
    value: str,
) -> DataFrame:
    """Mean inside a span over the mean of a baseline span."""
    return df.groupBy(key).agg(
        *[
            ratio(
                F.avg(in_span(value, time, hit)), F.avg(in_span(value, time, base))
            ).alias(name)
            for name, (hit, base) in spans.items()
        ]
    )


def quantile_hit_ratio(
    df: DataFrame,
    hit: Span,
    base: Span,
    *,
    key: str,
    time: str,
    value: str,
    q: float = 0.2,
    out: str = "hit",
    unique: bool = False,
) -> DataFrame:
    """A low quantile inside a span over the mean of a baseline span.

    The exact quantile holds a key's values, so there is one per day: a repeated
    (key, day) stops the query unless ``unique`` vouches for the input.
    """
    rows = df if unique else unique_periods(df, key=key, time=time, value=value)
    return rows.groupBy(key).agg(
        ratio(
            F.percentile(in_span(value, time, hit), F.lit(q)), F.avg(in_span(value, time, base))
        ).alias(out)
    )


def sector_shares(
    df: DataFrame,
    *,
    key: str,
    sectors: Sequence[str],
    prefix: str = "yoy_txn_amt",
    pattern: str = "txn_amt",
    amount_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Share of each sector and of weekend and weekday in a key's total amount."""
    names = list(amount_columns) if amount_columns else columns_like(df, pattern)
    sums = sum_per_key(df, names, key=key)
    total = row_sum([F.col(quoted(c)) for c in names])
    kind = {
        k: row_sum([F.col(quoted(c)) for c in names if k in c]) for k in ("we", "wd")
    }
    return sums.select(
        key,
        total.alias("total"),
        kind["we"].alias("total_we"),
        kind["wd"].alias("total_wd"),
        *[
            ratio(
                row_sum([F.col(quoted(f"{prefix}_wd_{s}")), F.col(quoted(f"{prefix}_we_{s}"))]),
                total,
            ).alias(f"percent_{s}")
            for s in sectors
        ],
        *[ratio(kind[k], total).alias(f"percent_{k}") for k in ("we", "wd")],
    )


def class_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def gradients(
    df: DataFrame, spans: Mapping[str, Span], *, key: str, time: str, value: str
) -> DataFrame:
    """Least-squares slope per day inside each span; NULL on a single distinct day."""
    x = ordinal_day(time).cast("double")
    return df.groupBy(key).agg(
        *[F.regr_slope(in_span(value, time, s), x).alias(name) for name, s in spans.items()]
    )


def fit_lines(
    df: DataFrame, fits: Mapping[str, tuple[Span, str]], *, key: str, time: str, value: str
) -> DataFrame:
    """Slope, intercept and point count per span; time counts days from the given day.

    ``fits`` maps a name to ``(span, t0)``. One row per (key, name).
    """
    aggs = []
    for name, (span, t0) in fits.items():
        y = in_span(value, time, span)
        x = days_since(time, t0).cast("double")
        aggs += [
            F.regr_slope(y, x).alias(f"{name}_slope"),
            F.regr_intercept(y, x).alias(f"{name}_intercept"),
            F.count(y).alias(f"{name}_n"),
        ]
    wide = df.groupBy(key).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("fit"),
                F.col(f"{name}_slope").alias("slope"),
                F.col(f"{name}_intercept").alias("intercept"),
                F.col(f"{name}_n").alias("n"),
            )
            for name in fits
        ]
    )
    return wide.select(key, F.explode(rows).alias("_f")).select(key, "_f.*")


def line_values(
    df: DataFrame, lines: DataFrame, t0: str, *, key: str, time: str, out: str = "fitted"
) -> DataFrame:
    """Value of each key's line on the rows of ``df``."""
    placed = df.join(lines.select(key, "slope", "intercept"), key, "left")
    return placed.withColumn(
        out, F.col("intercept") + F.col("slope") * days_since(time, t0)
    ).drop("slope", "intercept")


def correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, one row per ordered pair (a <= b)."""
    pairs = list(combinations_with_replacement(names, 2))
    row = df.agg(
        *[
            F.corr(F.col(quoted(a)).cast("double"), F.col(quoted(b)).cast("double")).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return row.select(F.explode(cells).alias("_c")).select("_c.*")


def histograms(df: DataFrame, names: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width histogram of each column between its minimum and maximum.

    The last bin is closed; a constant column gets a range of one around its value.
    """
    entry = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(quoted(c)).cast("double").alias("v"))
            for c in names
        ]
    )
    long = df.select(F.explode(entry).alias("_e")).select("_e.*").where(F.col("v").isNotNull())
    ends = long.groupBy("feature").agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    # one row per feature
    ends = ends.select(
        "feature",
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"),
    )
    slot = F.floor((F.col("v") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    counts = (
        long.join(F.broadcast(ends), "feature")
        .groupBy("feature", F.least(slot, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    slots = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / bins
    return slots.join(counts, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("low"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
