"""Set operations (U01-U07) and the top-1 sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamkit.operators.joins import not_exists, with_scalar


# U01 / U02 ---------------------------------------------------------------------
def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL; columns are matched by name (all inputs carry the same names)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


# U03 ---------------------------------------------------------------------------
def cutover(df: DataFrame, month_col: str, cutover_month: int, code_col: str, excluded: Sequence[str],
            as_text: bool = False) -> DataFrame:
    """All rows before the cut-over month, rows from it on minus ``excluded`` codes.

    One scan with ``m < cut or (m > cut-1 and code not in (...))``, the same
    rows as the two filtered union branches (NULL months drop out of both, and
    NULL codes from the later branch).  ``as_text`` compares ``yyyymm`` text.
    """
    y, m = divmod(cutover_month, 100)
    prev = (y - 1) * 100 + 12 if m == 1 else cutover_month - 1
    c = F.col(month_col) if as_text else F.col(month_col).cast("bigint")
    lo, hi = (F.lit(str(cutover_month)), F.lit(str(prev))) if as_text else (F.lit(cutover_month), F.lit(prev))
    return df.where((c < lo) | ((c > hi) & ~F.col(code_col).isin(list(excluded))))


# U04 ---------------------------------------------------------------------------
def splice(history: DataFrame, live: DataFrame, live_pred: Column | None = None) -> DataFrame:
    """Frozen history plus the live rows that pass ``live_pred``."""
    return history.unionByName(live if live_pred is None else live.where(live_pred))


# U05 ---------------------------------------------------------------------------
def split_direction(df: DataFrame, c: str = "relationship_direction", both: str = "Bilateral",
                    into: Sequence[str] = ("Inbound", "Outbound")) -> DataFrame:
    """A two-way row becomes one row per direction; other rows (NULL too) pass."""
    parts = F.when(F.col(c) == F.lit(both), F.array(*[F.lit(x) for x in into])).otherwise(F.array(F.col(c)))
    return df.withColumn(c, F.explode(parts))


# U06 ---------------------------------------------------------------------------
def merge_ledger(new: DataFrame, prev: DataFrame, keys: Sequence[str] | Mapping[str, str],
                 flag: str = "latest_flag", null_safe: bool = False) -> DataFrame:
    """New rows not already in the previous ledger, flagged '1', plus every old row flagged '0'."""
    keys = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    cols = [c for c in prev.columns if c != flag]
    fresh = not_exists(new, prev, keys, null_safe).select(*cols).withColumn(flag, F.lit("1"))
    return fresh.unionByName(prev.select(*cols).withColumn(flag, F.lit("0")))


# U07 / S07 -----------------------------------------------------------------------
def literal_row(spark, **values) -> DataFrame:
    """A one-row literal source."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def latest_or_default(df: DataFrame, order: str, default: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """The latest row by ``order``; when ``given`` (``df`` itself if None) is empty, the ``default`` row."""
    top = latest_row(df, order)
    n = (df if given is None else given).agg(F.count(F.lit(1)).alias("__n"))
    fallback = with_scalar(default, n).where(F.col("__n") == 0).drop("__n")
    return top.unionByName(fallback)


# T01 -----------------------------------------------------------------------------
def latest_row(df: DataFrame, order: str) -> DataFrame:
    """``order by order desc limit 1`` (a TakeOrderedAndProject: per-task top-1, then one merge)."""
    return df.orderBy(F.col(order).desc()).limit(1)


def latest_row_per(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str]) -> DataFrame:
    """``latest_row`` of every key: one row each, ties broken by ``ties`` ascending.

    A partial aggregate: the greatest (order, ties) struct a key, so no key's rows meet in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in ties]))
    top = df.groupBy(*keys, order).agg(first.alias("__row"))  # one row a key and order value
    best = top.groupBy(*keys).agg(F.max_by("__row", order).alias("__row"))
    return best.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def latest_or_default_per(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], default: DataFrame, given: DataFrame) -> DataFrame:
    """``latest_or_default`` of every key; ``default`` has the row of each key that ``given`` lacks."""
    top = latest_row_per(df, keys, order, ties)
    known = given.select(*keys).distinct()
    return top.unionByName(default.join(known, list(keys), "left_anti"))
