"""Joins (J01-J14).

Broadcast is never assumed: :func:`bounded_broadcast` hints a side only when
the optimizer's size estimate of that side is under a limit, and otherwise
leaves the planner (and AQE) to pick a shuffled join.  Range joins are turned
into equi-joins on a month bucket so they hash-partition instead of running a
nested loop, and NOT IN is rebuilt as a shuffled anti join plus two counts so
the subquery side does not have to fit in memory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest estimated size hinted for broadcast (bytes).  Kept at Spark's own
# automatic threshold scale; dimensions above it are shuffle-joined.
BROADCAST_LIMIT = 64 * 1024 * 1024


_UNITS = {"B": 1, "KiB": 1 << 10, "MiB": 1 << 20, "GiB": 1 << 30, "TiB": 1 << 40, "PiB": 1 << 50, "EiB": 1 << 60}


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for ``df`` (file sizes for scans).

    Read from the statistics' text form: the raw number can run to thousands
    of digits for stacked joins, which is no use and does not convert.
    """
    try:
        text = df._jdf.queryExecution().optimizedPlan().stats().simpleString()
    except Exception:  # noqa: BLE001  (no JVM plan to ask, e.g. a remote session): assume large
        return 1 << 62
    value = text.split("sizeInBytes=", 1)[1].split(",", 1)[0].strip()
    number, _, unit = value.partition(" ")
    try:
        return min(int(min(float(number), 1e30) * _UNITS.get(unit or "B", 1 << 60)), 1 << 62)
    except (ValueError, OverflowError):
        return 1 << 62


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint ``df`` for broadcast only when its estimated size is within ``limit``."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def _on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool = False) -> Column:
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b]
        cond = c if cond is None else cond & c
    return cond


# J01 / J03 / J04 / J05 ---------------------------------------------------------
def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], columns: Mapping[str, str] | None = None,
           how: str = "left", right_pred: Column | None = None, null_safe: bool = False) -> DataFrame:
    """Join ``dim`` on ``{df_col: dim_col}`` and add ``{output: dim_col}`` columns.

    ``right_pred`` is a condition on the dimension alone (``ON ... and r.x = 1``):
    it filters the dimension before a left join, which keeps unmatched rows.
    """
    if right_pred is not None:
        dim = dim.where(right_pred)
    columns = dict(columns) if columns is not None else {c: c for c in dim.columns if c not in on.values()}
    d = dim.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(on.values())],
                   *[F.col(src).alias(out) for out, src in columns.items()])
    d = bounded_broadcast(d)
    pairs = [(a, f"__k{i}") for i, a in enumerate(on)]
    out = df.join(d, _on(df, d, pairs, null_safe), how)
    return out.drop(*[f"__k{i}" for i in range(len(on))])


def left_join(df: DataFrame, other: DataFrame, keys: Mapping[str, str], columns: Mapping[str, str] | None = None,
              right_pred: Column | None = None) -> DataFrame:
    return lookup(df, other, keys, columns, "left", right_pred)


def inner_join(df: DataFrame, other: DataFrame, keys: Mapping[str, str],
               columns: Mapping[str, str] | None = None) -> DataFrame:
    """A LEFT JOIN whose WHERE tests the right side is an inner join; write it as one."""
    return lookup(df, other, keys, columns, "inner")


# J02 ---------------------------------------------------------------------------
def lookup_roles(df: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
                 columns: Mapping[str, str], key_fn=None) -> DataFrame:
    """Join one dimension once per role.

    ``roles`` maps an output prefix to the fact column playing that role;
    ``columns`` maps an output suffix to a dimension column, giving
    ``<prefix><suffix>`` columns.  ``key_fn`` normalises both keys (J06).
    """
    out = df
    for prefix, fact_col in roles.items():
        out = lookup_expr(out, dim, fact_col, dim_key, {f"{prefix}{s}": c for s, c in columns.items()}, key_fn)
    return out


# J06 ---------------------------------------------------------------------------
def lookup_expr(df: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, columns: Mapping[str, str],
                key_fn=None, how: str = "left") -> DataFrame:
    """Equi-join on ``key_fn(fact_col) = key_fn(dim_col)`` (e.g. ``trim``).

    The key is normalised once per side into a column, so the join stays a
    hash join on that column.
    """
    key_fn = key_fn or (lambda c: c)
    tmp = f"__{fact_col}_key"
    left = df.withColumn(tmp, key_fn(F.col(fact_col)))
    right = dim.select(key_fn(F.col(dim_col)).alias("__dim_key"), *[F.col(c).alias(o) for o, c in columns.items()])
    right = bounded_broadcast(right)
    return left.join(right, left[tmp] == right["__dim_key"], how).drop(tmp, "__dim_key")


# F09 on distinct values ----------------------------------------------------------
def value_map(df: DataFrame, columns: Sequence[str], fn) -> DataFrame:
    """``__value``, ``__mapped``: each distinct non-NULL value of ``columns`` (texts) and ``fn`` of it.

    A partial aggregate over these columns alone; for functions too costly to run a row.
    """
    values = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("__value"))
    return values.where(F.col("__value").isNotNull()).distinct().select("__value", fn(F.col("__value")).alias("__mapped"))


def with_mapped(df: DataFrame, mapped: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add ``{output: column}``: each column's value looked up in a ``value_map`` (NULL stays NULL)."""
    for out, c in columns.items():
        df = lookup(df, mapped, {c: "__value"}, {out: "__mapped"})
    return df


# J07 ---------------------------------------------------------------------------
def operator_country(operator: DataFrame, country: DataFrame) -> DataFrame:
    """Operator dimension with its country name (snowflake step)."""
    return lookup(operator, country, {"fk_country_id": "country_id"}, {"abs_country": "country_description"}) \
        .select(F.col("tap_code"), F.col("operator_name"), F.col("abs_country"))


# J08 / J09 -----------------------------------------------------------------------
def _window_shape(w: DataFrame) -> DataFrame:
    """One row: ``__lo`` and ``__hi``, to which days are clipped, and ``__width`` of a bucket.

    Before the first end no window has ended and after the last start none begins, so
    days beyond are alike and windows without an end don't stretch the index.  A bucket
    is as wide as the mean window: windows then touch three buckets on average at most,
    whatever their mix of lengths.
    """
    ends = w.agg((F.min("__e") - 1).alias("__lo"), (F.max("__s") + 1).alias("__hi"))
    length = _clipped("__e") - _clipped("__s") + 1
    return with_scalar(w, ends).groupBy("__lo", "__hi").agg(F.ceil(F.avg(length)).alias("__width"))


def _clipped(day: str) -> Column:
    return F.least(F.greatest(F.col(day), F.col("__lo")), F.col("__hi"))


def _bucket(day: str) -> Column:
    return F.floor(_clipped(day) / F.col("__width"))


def as_valid_join(fact: DataFrame, windows: DataFrame, date_col: str, start: str, end: str,
                  columns: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join each fact row to the windows with ``start <= date <= end``.

    Instead of a nested-loop join, every window is listed once per bucket of days it
    touches and the join is an equi-join on the bucket plus the range test.  Each fact
    date falls in exactly one bucket, so overlapping windows fan out exactly as the
    range join does, and no window is repeated.  The buckets come from the windows
    alone (see ``_window_shape``), so the facts are read once; the listing holds at
    most four times the windows' rows, and counts so for the broadcast limit.
    """
    day = lambda c: F.unix_date(F.to_date(F.col(c)))
    w = windows.where(F.col(start) <= F.col(end)).select(
        day(start).alias("__s"), day(end).alias("__e"), F.col(start).alias("__vw_start"), F.col(end).alias("__vw_end"),
        *[F.col(c).alias(o) for o, c in columns.items()])
    shape = _window_shape(w)
    listed = with_scalar(w, shape).withColumn("__bucket", F.explode(F.sequence(_bucket("__s"), _bucket("__e")))) \
        .drop("__s", "__e", "__lo", "__hi", "__width")
    listed = F.broadcast(listed) if 4 * estimated_bytes(w) <= BROADCAST_LIMIT else listed
    f = attach_one(fact.withColumn("__day", day(date_col)), shape).withColumn("__fbucket", _bucket("__day")) \
        .drop("__day", "__lo", "__hi", "__width")
    cond = (f["__fbucket"] == listed["__bucket"]) & (f[date_col] >= listed["__vw_start"]) & (f[date_col] <= listed["__vw_end"])
    return f.join(listed, cond, how).drop("__fbucket", "__bucket", "__vw_start", "__vw_end")


def assign_period(df: DataFrame, periods: DataFrame, date_col: str, start: str, end: str,
                  columns: Mapping[str, str]) -> DataFrame:
    """Cross join + ``start <= date <= end`` filter, as an inner bucketed range join."""
    return as_valid_join(df, periods, date_col, start, end, columns, how="inner")


# J10 / J14 -------------------------------------------------------------------------
def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    ``one_row`` must be a global aggregate (exactly one row by construction),
    so broadcasting it is always safe.
    """
    return df.crossJoin(F.broadcast(one_row))


def attach_one(df: DataFrame, at_most_one: DataFrame) -> DataFrame:
    """``with_scalar`` for a row that may be missing: every row of ``df`` stays, with NULLs then."""
    return df.join(F.broadcast(at_most_one), F.lit(True), "left")


# J11 -------------------------------------------------------------------------------
def period_over_period(df: DataFrame, keys: Sequence[str], date_col: str, columns: Mapping[str, str],
                       months: int = 1, earlier: DataFrame | None = None) -> DataFrame:
    """Left join each row to the rows ``months`` earlier (``a.d = add_months(b.d, months)``).

    ``earlier`` (default: ``df`` itself) supplies the earlier rows.  Its date is
    shifted forward once, so the join is an equi-join on keys + date and
    hash-partitions on them.  ``add_months`` clamps to month end: several
    earlier dates can match one row (Jan 28-31 -> Feb 28) and some match none.
    """
    earlier = df if earlier is None else earlier
    prev = earlier.select(*[F.col(k).alias(f"__p_{k}") for k in keys],
                          F.add_months(F.col(date_col), months).alias("__p_shift"),
                          *[F.col(c).alias(o) for o, c in columns.items()])
    cond = _on(df, prev, [(k, f"__p_{k}") for k in keys] + [(date_col, "__p_shift")])
    return df.join(prev, cond, "left").drop(*[f"__p_{k}" for k in keys], "__p_shift")


# J12 / J13 -------------------------------------------------------------------------
def not_exists(df: DataFrame, other: DataFrame, keys: Mapping[str, str], null_safe: bool = False) -> DataFrame:
    """Correlated NOT EXISTS on equal keys: NULL keys never match, so those rows stay."""
    o = other.select(*[F.col(b).alias(f"__x{i}") for i, b in enumerate(keys.values())])
    return df.join(o, _on(df, o, [(a, f"__x{i}") for i, a in enumerate(keys)], null_safe), "left_anti")


def not_in(df: DataFrame, c: str, other: DataFrame, other_col: str) -> DataFrame:
    """Null-aware ``c NOT IN (SELECT other_col FROM other)``.

    Empty subquery: every row stays (NULL too).  A NULL in the subquery: no
    row stays.  Otherwise rows with a NULL ``c`` go, the rest are anti-joined.
    The anti join shuffles like any join; only two counts are broadcast.
    """
    sub = other.select(F.col(other_col).alias("__v"))
    stats = sub.agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col("__v").isNull()).alias("__n_null"))
    kept = df.join(sub.where(F.col("__v").isNotNull()).distinct(), F.col(c) == F.col("__v"), "left_anti")
    return (with_scalar(kept, stats)
            .where((F.col("__n") == 0) | ((F.col("__n_null") == 0) & F.col(c).isNotNull()))
            .drop("__n", "__n_null"))
