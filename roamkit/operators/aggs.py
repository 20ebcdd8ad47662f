"""Aggregations (A01-A06) and window operators.

Grouped work goes through hash aggregation, which Spark splits into a
map-side partial and a post-shuffle final step, so a hot key is pre-combined
on every executor before anything moves.  Window operators whose partitions
would be a few very large groups (latest-per-key, partition totals, ranks of
totals) are written as "aggregate, then join back": the aggregate is partial
and small, and the join back is broadcast when its size allows.  The latest rows
of a key are a rank limited before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamkit.functions.scalars import col
from roamkit.operators.joins import bounded_broadcast


def _parts(x: Column) -> tuple[Column, ...]:
    """A floating value as parts whose sums don't depend on the order of adding: decimals, and a double.

    Below 1e15: the first six decimals, and what they leave, which has 24 more.  From 1e15
    to 1e22: three decimals, all that a double has there.  Parts that are nothing are NULL
    and cost nothing.  Only values from 1e22 up, infinite ones and NaN are added as doubles.
    """
    size = F.abs(x)
    head = F.when(size < 1e15, x.cast("decimal(38,6)"))
    left = x - head.cast("double")
    return head, F.when(left != 0, left.cast("decimal(38,30)")), F.when((size >= 1e15) & (size < 1e22), x.cast("decimal(38,3)")), F.when(size >= 1e22, x)


def _exact_total(x: Column, total: Callable[[Column], Column], count: Callable[[Column], Column]) -> Column:
    """The sum of ``x`` by ``total`` (an aggregate or one over a window), NULL if ``x`` has no value."""
    sums = [F.coalesce(total(p).cast("double"), F.lit(0.0)) for p in _parts(x)]
    head, left, big, rest = sums
    return F.when(count(x) > 0, big + head + left + rest)


def _sum(c: str, dtype: str, exact: bool) -> Column:
    if dtype in ("float", "double") and exact:
        return _exact_total(F.col(c).cast("double"), F.sum, F.count)
    if dtype in ("int", "smallint", "tinyint"):
        return F.sum(F.col(c)).cast("bigint")
    return F.sum(F.col(c))


# A01 ---------------------------------------------------------------------------
def group_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str] | Mapping[str, str],
              exact: bool = True) -> DataFrame:
    """Several sums by several keys.

    ``exact`` adds floating measures as decimals (see ``_parts``), so totals have the
    same bits however rows were partitioned or ordered, unless values of 1e22 and more
    are among them; digits beyond 30 decimals are cut off.  Decimal measures give
    decimal sums.
    """
    measures = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    types = dict(df.dtypes)
    return df.groupBy(*keys).agg(*[_sum(src, types[src], exact).alias(out) for out, src in measures.items()])


# A02 - A06 -----------------------------------------------------------------------
def global_max(df: DataFrame, c: str | Column, alias: str, where: Column | None = None) -> DataFrame:
    """One-row ``max`` without keys (empty input gives one NULL row)."""
    src = df if where is None else df.where(where)
    return src.agg(F.max(col(c)).alias(alias))


def group_max(df: DataFrame, keys: Sequence[str], expr: str | Column, alias: str) -> DataFrame:
    """``max`` of a column or computed expression by keys."""
    return df.groupBy(*keys).agg(F.max(col(expr)).alias(alias))


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


# W01 -----------------------------------------------------------------------------
def _rejoin(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join an aggregate back to its rows on null-safe keys."""
    renamed = small.select(*[F.col(k).alias(f"__g_{k}") for k in keys],
                           *[c for c in small.columns if c not in keys])
    renamed = bounded_broadcast(renamed)
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(renamed[f"__g_{k}"])
        cond = c if cond is None else cond & c
    out = df.join(renamed, cond, "inner") if cond is not None else df.crossJoin(F.broadcast(renamed))  # one row without keys
    return out.drop(*[f"__g_{k}" for k in keys])


def latest(df: DataFrame, keys: Sequence[str], order: str,
           stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Rows holding the greatest ``order`` per key, ties kept (``dense_rank() = 1``).

    A rank of which only the first is kept: Spark limits each task's rows to it before
    the shuffle (WindowGroupLimit), so ``df`` is read once and only candidates move.
    With ``stage`` it is max-per-key + join back instead, the per-key table written
    first so that its measured size can prove it broadcastable: two reads, but rows
    that tie in a hot key don't meet in one task.  A key whose ``order`` is NULL on
    every row keeps those rows (descending order puts NULLs last).
    """
    if stage is None and keys:
        w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
        return df.withColumn("__rank", F.dense_rank().over(w)).where(F.col("__rank") == 1).drop("__rank")
    top = df.groupBy(*keys).agg(F.max(order).alias("__top"))
    if stage is not None:
        top = stage(top, "per_key_latest")
    out = _rejoin(df, top, keys)
    return out.where(F.col(order).eqNullSafe(F.col("__top"))).drop("__top")


# W02 / W04 ---------------------------------------------------------------------------
def with_partition_aggs(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column],
                        stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """``agg(...) over (partition by keys)`` for whole-partition frames.

    Aggregated per key (partial, skew-tolerant) and joined back on null-safe
    keys; the per-key table is broadcast when its size is known to be small
    (``stage`` materialises it so that its size is measured, not estimated).
    """
    small = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    if stage is not None:
        small = stage(small, "per_key_aggs")
    return _rejoin(df, small, keys)


def with_total(df: DataFrame, keys: Sequence[str], c: str, alias: str, exact: bool = True,
               stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """``sum(c) over (partition by keys)``."""
    dtype = dict(df.dtypes)[c]
    return with_partition_aggs(df, keys, {alias: _sum(c, dtype, exact)}, stage)


# W03 ---------------------------------------------------------------------------------
def rank_totals(df: DataFrame, by: Sequence[str], total: str, alias: str) -> DataFrame:
    """``dense_rank() over (partition by by order by total)`` (NULLs first).

    Dense rank only depends on the distinct totals of a partition, so the
    distinct (by, total) pairs are ranked - a table the size of the key space -
    and joined back, instead of sorting every row of a month in one task.
    """
    ranks = (df.select(*by, total).distinct()
             .withColumn(alias, F.dense_rank().over(Window.partitionBy(*by).orderBy(F.col(total).asc_nulls_first()))))
    return _rejoin(df, ranks, [*by, total])


def with_totals_and_ranks(df: DataFrame, by: Sequence[str], c: str,
                          specs: Sequence[tuple[str, str, str | None]], exact: bool = True,
                          stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Several ``sum(c) over (partition by by + key)`` totals, each optionally ranked within ``by``.

    ``specs`` holds ``(key, total_alias, rank_alias)``.  Each total is one
    partial aggregate of ``df`` by (by, key); its dense rank within ``by``
    (ascending, NULLs first) is computed on that per-key table, because a
    total is a function of its key, so ranking keys ranks the distinct totals.
    Every table is joined back to ``df`` itself, so the plan grows linearly
    with the number of totals instead of nesting each step in the next.

    ``stage(df, name) -> DataFrame`` (e.g. ``TableStore.replace``) materialises
    each per-key table first.  Without statistics, Spark sizes an aggregate
    like its input, so only a written table has a size that proves it small
    enough to broadcast; staged, the join back never shuffles ``df``.
    """
    dtype = dict(df.dtypes)[c]
    out = df
    for key, total, rank in specs:
        keys = [*by, key]
        small = df.groupBy(*keys).agg(_sum(c, dtype, exact).alias(total))
        if rank is not None:
            small = small.withColumn(rank, F.dense_rank().over(
                Window.partitionBy(*by).orderBy(F.col(total).asc_nulls_first())))
        if stage is not None:
            small = stage(small, f"per_key_{total}")
        out = _rejoin(out, small, keys)
    return out


# W05 ---------------------------------------------------------------------------------
def rolling_avg(df: DataFrame, keys: Sequence[str], order: str, c: str, alias: str, preceding: int = 6,
                exact: bool = True) -> DataFrame:
    """``avg(c) over (partition by keys order by order rows between n preceding and current row)``.

    A row frame, not a date range: gaps stretch it.  ``exact`` adds the frame as
    in ``group_sum`` and divides by its non-NULL count, so the mean does not depend on
    summation order.  Input is expected to be one row per key and day already.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order)).rowsBetween(-preceding, 0)
    if not exact:
        return df.withColumn(alias, F.avg(c).over(w))
    s = _exact_total(F.col(c).cast("double"), lambda p: F.sum(p).over(w), lambda p: F.count(p).over(w))
    return df.withColumn(alias, F.try_divide(s, F.count(F.col(c)).over(w).cast("double")))
