"""Recovery profile of each area: means, hits, sector shares, slopes, cells, clusters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import days_since, ratio
from ..operators.aggregates import Span, fit_lines, in_span, sector_shares
from ..operators.groups import split_table
from ..operators.joins import attach
from ..operators.learning import Scaler
from ..operators.projection import add_ratios, log_columns
from ..operators.series import extract_series
from ..session import cut

# The periods the recovery features compare, (first day, last day).
MEAN_SPANS = {
    "mean 2020": ("2020-03-14", "2020-11-01"),
    "mean 2021": ("2021-03-14", "2021-11-01"),
}
HIT_SPANS = {
    "hit percent 2020": (("2020-03-24", "2020-06-15"), ("2020-01-04", "2020-03-24")),
    "hit percent 2021": (("2021-01-05", "2021-03-12"), ("2020-08-01", "2020-11-05")),
}
# Fixed values: (span, day zero) of the fitted lines.
LINE_SPANS = {
    "2020": (("2020-04-15", "2020-10-31"), "2020-04-01"),
    "2021": (("2021-02-12", "2021-08-31"), "2021-04-12"),
    "full": (("2020-01-01", "2021-12-31"), "2020-04-01"),
}
# The sectors, as the spend columns name them.
SECTORS = ["eating", "retail", "apparel"]

# Columns of the area profile, spelt as they are delivered.
PROFILE_CLASS_COLUMNS = ["pattern_2020", "pattern_2021", "all_pandemic", "RECODE"]
PROFILE_RATIOS = {
    "pct offices": ("total_number_of_offices", "total_number_of_addresses"),
    "pct JSA 2021": ("total number of job seekers allownace 2021", "TotalPopulation"),
    "pct HW": ("total estimated number of home workers", "TotalPopulation"),
    "pct work age": ("WorkAgePopulation", "TotalPopulation"),
    "pct employees": ("Employees", "TotalPopulation"),
}
PROFILE_RENAMES = {
    "percentage of commercial addresses (%)": "pct commercial addresses",
    "precentage of residential addresses (%)": "pct residential addresses",
    "LOAC2011_Group_Name (Rank 1)": "loac rank 1",
    "PTAL2015 (Rank 1)": "ptal",
    "Sum_y2019_07wd": "2019 scale",
    "TotalPopulation": "Pop",
    "total_number_of_addresses": "num_addresses",
}
PROFILE_LOGGED = [
    "pct commercial addresses",
    "Pop",
    "2019 scale",
    "pct offices",
    "pct HW",
    "pct employees",
]
PROFILE_UNUSED = [
    "total_number_of_residential_addresses",
    "total_number_of_commercial_addresses",
    "total_number_of_offices",
    "total number of job seekers allownace 2021",
    "total estimated number of home workers",
    "WorkAgePopulation",
    "Employees",
    "Sum_y2021_10wd",
    "Cnt_highstreet",
    "pc_chng",
    "LOAC2011_Group_Name (Rank 2)",
    "LOAC2011_Group_Name (Rank 3)",
    "PTAL2015 (Rank 2)",
    "PTAL2015 (Rank 3)",
    "loac2011 percentage of overlap % (Rank 1)",
    "loac2011 percentage of overlap % (Rank 2)",
    "loac2011 percentage of overlap % (Rank 3)",
    "ptal2015 percentage of overlap %(Rank 1)",
    "ptal2015 percentage of overlap% (Rank 2)",
    "ptal2015 percentage of overlap%(Rank 3)",
]


def clean_profiles(stats: DataFrame) -> DataFrame:
    """Ratios, short names and logs; earlier class columns and raw counts are dropped."""
    out = add_ratios(stats.drop(*PROFILE_CLASS_COLUMNS), PROFILE_RATIOS)
    out = out.withColumnsRenamed(PROFILE_RENAMES)
    return log_columns(out, PROFILE_LOGGED).drop(*PROFILE_UNUSED)


def recovery_stats(
    series: DataFrame,
    *,
    key: str,
    time: str,
    value: str,
    means: Mapping[str, Span] = MEAN_SPANS,
    hits: Mapping[str, tuple[Span, Span]] = HIT_SPANS,
    slopes: Mapping[str, tuple[Span, str]] | None = None,
) -> DataFrame:
    """Span means, hit ratios and slopes of each key in one aggregation."""
    if slopes is None:
        slopes = {f"slope {y}": LINE_SPANS[y] for y in ("2020", "2021")}
    return series.groupBy(key).agg(
        *[F.avg(in_span(value, time, s)).alias(n) for n, s in means.items()],
        *[
            ratio(F.avg(in_span(value, time, a)), F.avg(in_span(value, time, b))).alias(n)
            for n, (a, b) in hits.items()
        ],
        *[
            F.regr_slope(in_span(value, time, s), days_since(time, t0).cast("double")).alias(n)
            for n, (s, t0) in slopes.items()
        ],
    )


def profile_features(
    series: DataFrame,
    spend: DataFrame,
    clusters: DataFrame,
    profile: DataFrame,
    *,
    key: str,
    time: str,
    value: str,
    sectors: Sequence[str] = tuple(SECTORS),
    prefix: str = "yoy_txn_amt",
    **spans,
) -> DataFrame:
    """Recovery statistics with sector shares, cluster numbers and the profile, by key."""
    stats = recovery_stats(series, key=key, time=time, value=value, **spans)
    shares = sector_shares(spend, key=key, sectors=sectors, prefix=prefix).drop(
        "total", "total_we", "total_wd"
    )
    out = attach(stats, shares, key)
    out = attach(out, clusters.select(key, "cluster_hourly", "cluster_daily", "cluster_size"), key)
    return attach(out, profile, key)


def parameter_shift(
    lines: DataFrame, before: str, after: str, *, key: str, scaled: bool = False
) -> DataFrame:
    """Change of slope and intercept between two fits.

    ``scaled`` measures it in population deviations of the earlier fit. The two fits of a
    key meet in one aggregate.
    """
    if scaled:
        lines = cut(lines)

    def of(fit: str, name: str) -> Column:
        return F.max(F.when(F.col("fit") == fit, F.col(name)))

    units = {"slope": 1.0, "intercept": 1.0}
    if scaled:
        earlier = Scaler.fit(lines.where(F.col("fit") == before), list(units))
        units = {c: sd or 1.0 for c, (_, sd) in earlier.stats.items()}
    fits = F.count(F.when(F.col("fit").isin(before, after), 1))
    both = lines.groupBy(key).agg(
        *[of(before, c).alias(c) for c in units],
        *[((of(after, c) - of(before, c)) / F.lit(u)).alias(f"{c}_shift") for c, u in units.items()],
        fits.alias("_n"),
    )
    return both.where(F.col("_n") == 2).drop("_n")


def recovery_cells(
    readings: DataFrame,
    period: Span,
    hit: tuple[Span, Span],
    line: tuple[Span, str],
    *,
    key: str,
    time: str,
    value: str,
    upper: float | None = 5.0,
    tiles: int = 4,
    unique: bool = False,
) -> DataFrame:
    """From readings to cells: dense series, cap, hit ratio, slope, two-level split."""
    series = extract_series(
        readings, *period, key=key, time=time, value=value, upper=upper, unique=unique
    )
    stats = recovery_stats(
        series, key=key, time=time, value=value, means={}, hits={"hit": hit},
        slopes={"slope": line},
    )
    return split_table(stats, "hit", "slope", tiles, key=key)


def line_table(series: DataFrame, *, key: str, time: str, value: str, spans=None) -> DataFrame:
    """Fitted lines of each key for the 2020, 2021 and whole periods."""
    return fit_lines(series, spans or LINE_SPANS, key=key, time=time, value=value)
