"""Scalar column functions.

All of them are compositions of Spark built-ins; none is a Python UDF.  Regex
extraction and lambdas (initcap of odd words) are interpreted per row.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from roamkit.config import INITCAP_DELIMITERS, STATUS_DEFAULT, STATUS_GROUPS

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F01 / F02 -------------------------------------------------------------------
def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """NULL instead of an error when the divisor is zero (or either side NULL)."""
    return F.try_divide(col(a), col(b))


def divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Plain division.  A zero divisor gives NULL rather than failing the job."""
    return F.try_divide(col(a), col(b))


# F04 / F05 / F06 -------------------------------------------------------------
def coalesce(*cols: ColumnOrName) -> Column:
    return F.coalesce(*[col(c) for c in cols])


def backfill(x: ColumnOrName, y: ColumnOrName, f: Callable[[Column], Column] = lambda c: c) -> Column:
    """``case when f(x) is null then f(y) else f(x) end``."""
    return F.coalesce(f(col(x)), f(col(y)))


def if_empty(x: ColumnOrName, y: ColumnOrName) -> Column:
    """``''`` falls back to ``y``; NULL stays NULL."""
    x = col(x)
    return F.when(x == F.lit(""), col(y)).otherwise(x)


# F07 / F08 -------------------------------------------------------------------
def case(branches: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Searched CASE; branches are tried in order."""
    expr = None
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if expr is None else expr.otherwise(d)


def map_status(c: ColumnOrName) -> Column:
    """Simple CASE of the CRM status into Open / Progressing / Not Open."""
    c = col(c)
    return case([(c == F.lit(k), v) for k, v in STATUS_GROUPS], STATUS_DEFAULT)


# F09 / F10 / F11 / F12 -------------------------------------------------------
_DELIM_CLASS = "[\\s" + re.sub(r"([\[\]\\^\-])", r"\\\1", INITCAP_DELIMITERS) + "]"
_WORD_RUNS = f"({_DELIM_CLASS}+|[^{_DELIM_CLASS[1:-1]}]+)"
_PLAIN_WORDS = "^[A-Za-z0-9 ']*$"


def initcap(c: ColumnOrName) -> Column:
    """Warehouse INITCAP: a word starts after whitespace or punctuation.

    Spark's own ``initcap`` only splits on spaces ("Bosnia-herzegovina").
    Here the lower-cased text is cut into alternating delimiter / word runs and
    each run gets its first character upper-cased (a no-op on delimiters).
    """
    c = col(c)
    runs = F.regexp_extract_all(F.lower(c), F.lit(_WORD_RUNS), 1)
    cap = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substr(r, F.lit(2))))
    # Plain ASCII words separated by spaces: Spark's initcap gives the same text, cheaper.
    return F.when(c.rlike(_PLAIN_WORDS), F.initcap(c)).when(c.isNotNull(), F.array_join(cap, ""))


def upper(c: ColumnOrName) -> Column:
    return F.upper(col(c))


def trim(c: ColumnOrName) -> Column:
    return F.trim(col(c))


def substr(c: ColumnOrName, pos: int, length: int | None = None) -> Column:
    """1-based; position 0 is read as 1 and negative positions count from the end."""
    return F.substring(col(c), pos, (1 << 31) - 1 if length is None else length)


# F13 -------------------------------------------------------------------------
def crm_date_text(c: ColumnOrName) -> Column:
    """``substr(c, 5, 6) || ' ' || substr(c, -4)`` with space runs collapsed."""
    c = col(c)
    return F.regexp_replace(F.concat(F.substring(c, 5, 6), F.lit(" "), F.substring(c, -4, 4)), " +", " ")


def parse_crm_date(c: ColumnOrName, strict: bool = True) -> Column:
    """CRM timestamp text (``Tue Mar 01 00:00:00 GMT 2022``) -> DATE.

    Month abbreviation, day with or without padding, year.  ``strict`` raises on
    text that is not a date, as the warehouse parser does; otherwise NULL.
    """
    text = crm_date_text(c)
    return F.to_date(text, "MMM d yyyy") if strict else F.try_to_date(text, "MMM d yyyy")


# F14 / F15 -------------------------------------------------------------------
def concat(*cols: ColumnOrName) -> Column:
    """NULL when any part is NULL."""
    return F.concat(*[col(c) for c in cols])


def split_at(c: ColumnOrName, sep: str, i: int) -> Column:
    """Element ``i`` (0-based) of ``c`` split on the literal ``sep``; NULL when absent."""
    return F.get(F.split(col(c), re.escape(sep)), i)


# F16 - F19 -------------------------------------------------------------------
def add_months(d: ColumnOrName, n: int) -> Column:
    """Month arithmetic; the day is clamped to the month's end."""
    return F.add_months(col(d), n)


def date_sub(d: ColumnOrName, n: int) -> Column:
    return F.date_sub(col(d), n)


def trunc_month(d: ColumnOrName) -> Column:
    return F.trunc(col(d), "month")


def yyyymm(d: ColumnOrName) -> Column:
    d = col(d)
    return (F.year(d) * 100 + F.month(d)).cast("bigint")


# F20 / F21 / F22 / F23 / F24 -------------------------------------------------
def cast(c: ColumnOrName, to: str) -> Column:
    return col(c).cast(to)


def safe_cast(c: ColumnOrName, to: str) -> Column:
    return col(c).try_cast(to)


def as_of_date(as_of: dt.date | str | None) -> Column:
    """A fixed run date, or today's date when none is given."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


def date_text(c: ColumnOrName) -> Column:
    return F.to_date(col(c)).cast("string")


def before_first(c: ColumnOrName, sep: str) -> Column:
    return F.substring_index(col(c), sep, 1)


# helpers ----------------------------------------------------------------------
def exact_sum(c: ColumnOrName, scale: int = 6) -> Column:
    """Sum a measure as decimal so the total does not depend on row order."""
    return F.sum(col(c).cast(f"decimal(38,{scale})")).cast("double")


def is_true(c: ColumnOrName) -> Column:
    """NULL-safe boolean test."""
    return F.coalesce(col(c), F.lit(False))
