"""The spend, footfall, lookup and cluster tables with their declared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.projection import quoted
from ..plans.recovery import PROFILE_LOGGED, PROFILE_RATIOS, PROFILE_RENAMES
from .tables import read_csv, read_table, without_nan

# Columns and types of the input tables.
SCHEMAS = {
    "yearly_spend": (
        "week_start date, area_id bigint, area_name string, "
        "yoy_txn_amt_wd_retail double, yoy_txn_amt_we_retail double, "
        "yoy_txn_amt_wd_eating double, yoy_txn_amt_we_eating double, "
        "yoy_txn_amt_wd_apparel double, yoy_txn_amt_we_apparel double, "
        "yoy_txn_cnt_wd_retail double, yoy_txn_cnt_we_retail double"
    ),
    "weekly_spend": (
        "yr int, wk int, week_start date, area_id bigint, area_name string, txn_amt_wd_retail double"
    ),
    "mobile_footfall": "msoa11cd string, count_date date, count_type string, h13 double",
    "area_lookup": "msoa11cd string, area_name string",
    "clusters": "area_id bigint, cluster_hourly int, cluster_daily int, cluster_size int",
}


def read_input(spark: SparkSession, kind: str, path: str, *, renames: dict | None = None) -> DataFrame:
    """The declared columns of an input, typed; other columns are not read.

    CSV is matched by header, whatever the order. ``renames`` maps delivered names to the
    declared ones.
    """
    schema = T._parse_datatype_string(SCHEMAS[kind])
    raw = read_csv(spark, path) if ".csv" in path else read_table(spark, path)
    raw = raw.withColumnsRenamed(renames or {})
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return without_nan(
        raw.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema])
    )


# the profile's columns that are told apart by text; all other declared ones are numbers
_PROFILE_TEXT = {"LOAC2011_Group_Name (Rank 1)", "PTAL2015 (Rank 1)"}


def profile_columns(key: str) -> dict[str, str]:
    """The columns that the profile features are made of, with their types."""
    named = [c for pair in PROFILE_RATIOS.values() for c in pair] + list(PROFILE_RENAMES)
    made = {*PROFILE_RATIOS, *PROFILE_RENAMES.values()}
    named += [c for c in PROFILE_LOGGED if c not in made]
    return {key: "bigint"} | {c: "string" if c in _PROFILE_TEXT else "double" for c in named}


def read_profile(spark: SparkSession, path: str, *, key: str = "area_id") -> DataFrame:
    """The area profile as exported, its declared columns typed, further ones as they are."""
    raw = read_csv(spark, path) if ".csv" in path else read_table(spark, path)
    declared = profile_columns(key)
    missing = [c for c in declared if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return without_nan(raw.withColumns({c: F.col(quoted(c)).cast(t) for c, t in declared.items()}))
