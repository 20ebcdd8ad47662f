"""Projections and filters.

All are plain Catalyst expressions: predicates on scan columns reach the
Parquet reader as PushedFilters, and projections prune the ReadSchema.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamkit.functions.scalars import as_of_date, col, is_true


# P01 - P04 -------------------------------------------------------------------
def project(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Select and rename: ``{output_name: column or input name}``, in order."""
    return df.select(*[col(v).alias(k) if isinstance(v, (str, Column)) else F.lit(v).alias(k)
                       for k, v in mapping.items()])


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant (or blank ``''``) columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def with_nulls(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed NULL placeholders, so unions line up by type."""
    return df.withColumns({k: F.lit(None).cast(t) for k, t in types.items()})


def select_star(df: DataFrame) -> DataFrame:
    return df.select("*")


# P05 - P12 -------------------------------------------------------------------
def filter_eq(df: DataFrame, c: str, v: object) -> DataFrame:
    return df.where(F.col(c) == F.lit(v))


def filter_neq(df: DataFrame, c: str, v: object, keep_null: bool = False) -> DataFrame:
    """``c <> v`` drops NULLs; ``keep_null`` adds ``or c is null``."""
    cond = F.col(c) != F.lit(v)
    return df.where(cond | F.col(c).isNull() if keep_null else cond)


def filter_in(df: DataFrame, c: str, values: Iterable[object]) -> DataFrame:
    return df.where(F.col(c).isin(list(values)))


def filter_not_in(df: DataFrame, c: str, values: Iterable[object]) -> DataFrame:
    """``NOT IN (constants)``: a NULL value is dropped."""
    return df.where(~F.col(c).isin(list(values)))


def exclude_pairs(df: DataFrame, a: str, b: str, pairs: Iterable[str]) -> DataFrame:
    """NOT IN on the concatenated pair; a NULL in either code drops the row."""
    return df.where(~F.concat(F.col(a), F.col(b)).isin(list(pairs)))


def require(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.where(cond)


def active(df: DataFrame, flag: str = "bdp_active_flag") -> DataFrame:
    """Soft-deleted rows out."""
    return df.where(F.col(flag) == F.lit(1))


# P13 - P15 -------------------------------------------------------------------
def lookback(df: DataFrame, c: str, as_of: dt.date | str | None, days: int) -> DataFrame:
    """``c > as_of - days``; with a literal date Catalyst folds the bound."""
    return df.where(F.col(c) > F.date_sub(as_of_date(as_of), days))


def settled(df: DataFrame, c: str, as_of: dt.date | str | None, days: int) -> DataFrame:
    """``c < as_of - days``."""
    return df.where(F.col(c) < F.date_sub(as_of_date(as_of), days))


def since(df: DataFrame, c: str, floor: dt.date | str) -> DataFrame:
    floor = floor if isinstance(floor, dt.date) else dt.date.fromisoformat(floor)
    return df.where(F.col(c) >= F.lit(floor))


def month_bound(df: DataFrame, c: str, op: str, v: int | str) -> DataFrame:
    """``yyyymm`` bound.  A string bound compares text; an int casts to bigint first."""
    left = F.col(c) if isinstance(v, str) else F.col(c).cast("bigint")
    return df.where(_cmp(left, op, F.lit(v)))


def _cmp(a: Column, op: str, b: Column) -> Column:
    return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b, "=": a == b, "<>": a != b}[op]


# P16 - P18 -------------------------------------------------------------------
def alert_filter(df: DataFrame, pct: float, rate: float, charge: float, volume: float) -> DataFrame:
    """``(percentage > pct or iot_rate_eur > rate) and eur > charge and volume > volume``."""
    return df.where(((F.col("percentage") > pct) | (F.col("iot_rate_eur") > rate))
                    & (F.col("total_charges_eur") > charge)
                    & (F.col("total_charged_volume_mb") > volume))


def contains_upper(c: str, text: str) -> Column:
    """``upper(c) like '%TEXT%'``."""
    return F.upper(F.col(c)).contains(text.upper())


def filter_is_true(df: DataFrame, c: str) -> DataFrame:
    return df.where(is_true(c))
