"""The six footfall feeds: columns, cleaning and checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import SUPPRESSED
from ..operators.projection import quoted

# The closed lists of the feeds.
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
TIMES_OF_DAY = ["Morning", "Noon", "Evening", "Night"]
HOURS = (0, 23)
# Texts that stand for a missing value in any column of a file.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


@dataclass(frozen=True)
class Field:
    """A column: target type, how the text is read, and what must hold."""

    type: str
    nullable: bool = False
    read: str = "cast"  # cast | measure | hour | stamp
    positive: bool = False
    one_of: tuple[str, ...] | None = None
    between: tuple[int, int] | None = None


Spec = Mapping[str, Field]


def extend(spec: Spec, **more: Field) -> dict[str, Field]:
    """A schema with further columns; a column given again replaces the old one."""
    return {**spec, **more}


# The columns of the six kinds of file.
_measure = Field("double", nullable=True, read="measure", positive=True)
_hour = Field("int", read="hour", between=HOURS)
_day_name = Field("string", one_of=tuple(DAYS))
_part_of_day = Field("string", one_of=tuple(TIMES_OF_DAY))

BASE = {
    "file_date": Field("date", read="stamp"),
    "file_name": Field("string", read="stamp"),
    "scaled_volume": _measure,
    "loyalty_percentage": _measure,
    "dwell_time": _measure,
}
HEX_DAILY = extend(BASE, hex_grid_id=Field("bigint"), time_indicator=_hour, date=Field("date"))
HEX_MONTHLY = extend(
    BASE, hex_grid_id=Field("bigint"), month=Field("date"), day_name=_day_name, time_indicator=_hour
)
AREA_DAILY = extend(
    BASE,
    date=Field("date"),
    time_indicator=_part_of_day,
    worker_population_percentage=_measure,
    resident_population_percentage=_measure,
)
AREA_MONTHLY = extend(
    BASE,
    month=Field("date"),
    day_name=_day_name,
    time_indicator=_part_of_day,
    worker_population_percentage=_measure,
    resident_population_percentage=_measure,
)


@dataclass(frozen=True)
class Feed:
    """A route: file-name prefix, target table and schema."""

    prefix: str
    table: str
    spec: Spec


# File-name prefixes of the six feeds and the tables they load.
FEEDS = {
    "hex_daily": Feed("tfl_hex_daily_agg", "footfall_tfl_hex_daily", HEX_DAILY),
    "hex_monthly": Feed("tfl_hex_monthly_agg", "footfall_tfl_hex_monthly", HEX_MONTHLY),
    "lsoa_daily": Feed(
        "lsoa_daily_agg", "footfall_lsoa_daily", extend(AREA_DAILY, lsoa_id=Field("string"))
    ),
    "lsoa_monthly": Feed(
        "lsoa_monthly_agg", "footfall_lsoa_monthly", extend(AREA_MONTHLY, lsoa_id=Field("string"))
    ),
    "msoa_daily": Feed(
        "msoa_daily_agg", "footfall_msoa_daily", extend(AREA_DAILY, msoa_id=Field("string"))
    ),
    "msoa_monthly": Feed(
        "msoa_monthly_agg", "footfall_msoa_monthly", extend(AREA_MONTHLY, msoa_id=Field("string"))
    ),
}


def route_of(file_name: Column | str) -> Column:
    """Name of the feed a file belongs to, NULL when no prefix matches."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.coalesce(
        *[F.when(name.startswith(feed.prefix), F.lit(route)) for route, feed in FEEDS.items()]
    )


def unroutable(files: DataFrame, *, file_name: str = "file_name") -> DataFrame:
    """Files that no feed takes."""
    return files.where(route_of(file_name).isNull())


def missing_columns(df: DataFrame, spec: Spec) -> list[str]:
    return [c for c in spec if c not in df.columns]


def require_columns(df: DataFrame, spec: Spec) -> None:
    missing = missing_columns(df, spec)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def _given(name: str, field: Field) -> Column:
    """The delivered value, NULL where its text stands for a missing one."""
    raw = F.col(quoted(name))
    return raw if field.read == "stamp" else F.when(~raw.cast("string").isin(MISSING), raw)


def _typed(name: str, field: Field) -> Column:
    raw = _given(name, field)
    if field.read == "measure":
        return F.nullif(F.trim(raw.cast("string")), F.lit(SUPPRESSED)).try_cast("double")
    if field.read == "hour":
        return F.substring(raw.cast("string"), 1, 2).try_cast("int")
    if field.read == "cast" and field.type == "date":
        return raw.cast("string").try_cast("date")
    return raw.try_cast(field.type) if field.read == "cast" else raw.cast(field.type)


def _kinds(field: Field) -> list[str]:
    return [
        kind
        for kind, wanted in (
            ("type", field.read != "stamp" and field.type != "string"),
            ("not_null", not field.nullable),
            ("positive", field.positive),
            ("one_of", field.one_of is not None),
            ("between", field.between is not None),
        )
        if wanted
    ]


def rule_names(spec: Spec) -> list[str]:
    return [f"{name}:{kind}" for name, field in spec.items() for kind in _kinds(field)]


def _broken(kind: str, field: Field, raw: Column, v: Column) -> Column:
    """True on a row that breaks the rule; a null value passes all but ``not_null``."""
    if kind == "type":
        given = raw.isNotNull()
        if field.read == "measure":
            given = given & (F.trim(raw.cast("string")) != F.lit(SUPPRESSED))
        return given & v.isNull()
    if kind == "not_null":
        return raw.isNull()
    if kind == "positive":
        return v <= 0
    if kind == "one_of":
        return ~v.isin(list(field.one_of))
    return ~v.between(*field.between)


def _held(df: DataFrame, spec: Spec) -> DataFrame:
    """Typed columns of the schema, the other columns, and the text the types came from."""
    require_columns(df, spec)
    return df.select(
        *[_typed(c, f).alias(c) for c, f in spec.items()],
        *[F.col(quoted(c)) for c in df.columns if c not in spec],
        *[_given(c, f).alias(f"_raw_{c}") for c, f in spec.items()],
    )


def _conditions(spec: Spec) -> dict[str, Column]:
    """Rule name -> condition on a held row, never NULL."""
    return {
        f"{c}:{kind}": F.coalesce(
            _broken(kind, field, F.col(quoted(f"_raw_{c}")), F.col(quoted(c))), F.lit(False)
        )
        for c, field in spec.items()
        for kind in _kinds(field)
    }


def _without_raw(df: DataFrame, spec: Spec) -> DataFrame:
    return df.drop(*[f"_raw_{c}" for c in spec])


def check(df: DataFrame, spec: Spec, *, out: str = "violations") -> DataFrame:
    """Typed columns of the schema, other columns as they are, and the broken rules."""
    held = _held(df, spec)
    found = F.array(*[F.when(cond, F.lit(rule)) for rule, cond in _conditions(spec).items()])
    return _without_raw(held.withColumn(out, F.array_compact(found)), spec)


def violation_report(df: DataFrame, spec: Spec) -> DataFrame:
    """(rule, n) for every rule of the schema, counted in one pass."""
    rules = _conditions(spec)
    row = _held(df, spec).agg(
        *[F.count(F.when(cond, 1)).alias(f"r{i}") for i, cond in enumerate(rules.values())]
    )
    cells = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.col(f"r{i}").alias("n"))
            for i, r in enumerate(rules)
        ]
    )
    return row.select(F.explode(cells).alias("_c")).select("_c.*")


def sound(spec: Spec) -> Callable[[DataFrame], DataFrame]:
    """Keeps the delivered rows of a feed that break no rule."""

    def keep(df: DataFrame) -> DataFrame:
        columns = [F.col(quoted(c)) for c in df.columns]
        held = df.select(
            F.struct(*columns).alias("_row"),
            *[_typed(c, f).alias(c) for c, f in spec.items()],
            *[_given(c, f).alias(f"_raw_{c}") for c, f in spec.items()],
        )
        return held.where(~reduce(or_, _conditions(spec).values())).select("_row.*")

    return keep


def clean(df: DataFrame, spec: Spec, *, mode: str = "raise") -> DataFrame:
    """Typed rows of a feed.

    ``raise`` stops the query at a row that breaks a rule, ``keep`` returns every row with
    its ``violations``, ``drop`` returns the rows that break none.
    """
    if mode == "keep":
        return check(df, spec)
    held, rules = _held(df, spec), _conditions(spec)
    fine = ~reduce(or_, rules.values())
    if mode == "raise":
        names = F.concat_ws(", ", *[F.when(cond, F.lit(r)) for r, cond in rules.items()])
        text = F.concat(F.lit("row breaks "), names)
        fine = F.when(fine, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    return _without_raw(held.where(fine), spec)


def quarantine(df: DataFrame, spec: Spec) -> DataFrame:
    """The rows that ``clean(mode="drop")`` leaves out, with the rules they break."""
    return check(df, spec).where(F.size("violations") > 0)


def clean_feed(df: DataFrame, route: str, *, mode: str = "raise") -> DataFrame:
    """Clean rows of one of the six feeds, lineage columns already stamped."""
    return clean(df, FEEDS[route].spec, mode=mode)
