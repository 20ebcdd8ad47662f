"""Roaming business operators (M01-M18), composed from the generic ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamkit.config import AlertConfig, DeviationConfig, ValuedConfig
from roamkit.functions import scalars as S
from roamkit.operators import aggs as A
from roamkit.operators import filters as P
from roamkit.operators import joins as J
from roamkit.operators import sets as U


# M01 ---------------------------------------------------------------------------
def name_from_email(c: str) -> Column:
    """``first.last@host`` -> ``First Last``; anything else -> ``''``."""
    local = S.split_at(c, "@", 0)
    return F.coalesce(F.concat(S.initcap(S.split_at(local, ".", 0)), F.lit(" "),
                               S.initcap(S.split_at(local, ".", 1))), F.lit(""))


# M02 ---------------------------------------------------------------------------
def open_date_expr(*text_cols: str) -> Column:
    """First parseable CRM date among the columns (NULL text is skipped)."""
    return F.coalesce(*[S.parse_crm_date(c) for c in text_cols])


def open_date(df: DataFrame, keys: Sequence[str], text_cols: Sequence[str], alias: str = "open_date") -> DataFrame:
    """Latest of the first-non-NULL of several CRM dates, per key."""
    return A.group_max(df, keys, open_date_expr(*text_cols), alias)


# M03 / M04 / M05 / M06 -----------------------------------------------------------
def _either(b: str, c: str, value: str) -> Column:
    return (F.upper(F.col(b)) == value) | (F.upper(F.col(c)) == value)


def traffic_type(variant: str, b_type: str = "b_traffic_type", c_type: str = "c_traffic_type",
                 b_country: str = "b_country", cfg: DeviationConfig | None = None,
                 capped: tuple[str, str] | None = None) -> Column:
    """Traffic class of a usage row.  ``capped``: columns that hold the home and partner countries' INITCAP already.

    inbound:  M2M, ISR, NR (same 3-letter prefix, partner country = serving), OTHER, IOT
    outbound: M2M, ISR, NR (home country = partner country), OTH, then by subscriber type
    deviation: M2M by code or class, ISR by class, else IOT
    """
    same_prefix = S.substr("my_pmn_tadig_code", 0, 3) == S.substr("their_pmn_tadig_code", 0, 3)
    if variant == "inbound":
        return S.case([
            (_either(b_type, c_type, "M2M"), "M2M"),
            (_either(b_type, c_type, "ISR"), "ISR"),
            (same_prefix & (F.col("their_country_name") == F.col("serving_country_name")), "NR"),
            (_either(b_type, c_type, "OTHER"), "OTHER"),
        ], "IOT")
    if variant == "outbound":
        st = F.upper(F.col("subscriber_type"))
        home, partner = map(F.col, capped) if capped else (S.initcap(b_country), S.initcap("their_country_name"))
        return S.case([
            (_either(b_type, c_type, "M2M"), "M2M"),
            (_either(b_type, c_type, "ISR"), "ISR"),
            (same_prefix & (home == partner), "NR"),
            (_either(b_type, c_type, "OTHER"), "OTH"),
            (st.isin("NLM2M", "M2M"), "M2M"),
            (st.isin("NLISR", "ISR"), "ISR"),
        ], "IOT")
    if variant == "deviation":
        cfg = cfg or DeviationConfig()
        return S.case([
            (F.col("my_pmn_tadig_code").isin(list(cfg.m2m_codes)) | (F.col("subscriber_type") == "M2M"), "M2M"),
            (F.col("subscriber_type") == "ISR", "ISR"),
        ], "IOT")
    raise ValueError(variant)


def subscriber_class(cfg: DeviationConfig | None = None) -> Column:
    """Subscriber type -> M2M / IOT / ISR for the split code; by code elsewhere."""
    cfg = cfg or DeviationConfig()
    st = F.upper(F.col("subscriber_type"))
    split = S.case([
        (st.isin("NLM2M", "M2M"), "M2M"),
        (st.contains("IOT"), "IOT"),
        (st.contains("POST"), "IOT"),
    ], "ISR")
    other = F.when(F.col("my_pmn_tadig_code") == cfg.m2m_code, F.lit("M2M")).otherwise(F.lit("IOT"))
    return F.when(F.col("my_pmn_tadig_code") == cfg.split_code, split).otherwise(other)


def split_code(cfg: DeviationConfig | None = None) -> Column:
    """The split code becomes prefix + class (``NLM2M``, ``NLIOT`` ...)."""
    cfg = cfg or DeviationConfig()
    return F.when(F.col("my_pmn_tadig_code") == cfg.split_code,
                  F.concat(F.lit(cfg.split_prefix), F.col("subscriber_type"))).otherwise(F.col("my_pmn_tadig_code"))


def intragroup(b: str = "b_intragroup_eligible", c: str = "c_intragroup_eligible") -> Column:
    """'Yes' only when both ends are eligible (NULL counts as not)."""
    return F.when(S.is_true(b) & S.is_true(c), F.lit("Yes")).otherwise(F.lit("No"))


# M07 ---------------------------------------------------------------------------
def recent_flag(d: str, max_d: str, recent_days: int, year_ago: tuple[int, int]) -> Column:
    """'Y' for the last ``recent_days`` days and for [max - lo, max - hi] a year back."""
    lo, hi = year_ago
    date, top = F.col(d), F.col(max_d)
    return S.case([
        (date > F.date_sub(top, recent_days), "Y"),
        ((date >= F.date_sub(top, lo)) & (date <= F.date_sub(top, hi)), "Y"),
    ], "N")


# M08 ---------------------------------------------------------------------------
def rate_table(rate_card: DataFrame, cfg: ValuedConfig) -> DataFrame:
    """Actual rates, with the excluded source codes cut from the cut-over month on."""
    actual = P.filter_eq(rate_card, "traffic_type", cfg.rate_traffic_type)
    return U.cutover(actual, "call_year_month", cfg.cutover_month, "src_tadig", cfg.cutover_excluded, as_text=True)


RATE_KEYS = ("dst_tadig", "src_tadig", "call_type")


def asof_rates(rates: DataFrame, rate_col: str, months: tuple[int, int]) -> DataFrame:
    """Per key and calendar month (``yyyymm``, first and last included): that month's rate and the key's latest one.

    ``x_rate``, ``x_month``: of the month itself, NULL without one; ``l_rate``,
    ``l_month``: of the latest month that the key has.  A key without rates has no
    row; months listed twice in the rate card fan out as two look-ups would.  The table
    has keys x months rows, however large the usage.
    """
    entries, last = _rate_rows(rates, rate_col)
    day = lambda m: F.to_date(F.lit(str(m)), "yyyyMM")
    calendar = F.transform(F.sequence(day(months[0]), day(months[1]), F.expr("interval 1 month")), S.yyyymm)
    return last.withColumn("month", F.explode(calendar)).join(entries, [*RATE_KEYS, "month"], "left")


def _rate_rows(rates: DataFrame, rate_col: str) -> tuple[DataFrame, DataFrame]:
    """Each month's rates of each key, and those of the key's latest month."""
    rows = rates.dropna(subset=list(RATE_KEYS))
    rate, month = F.col(rate_col).cast("double"), F.col("call_year_month")
    entries = rows.select(*RATE_KEYS, month.cast("bigint").alias("month"), month.alias("x_month"), rate.alias("x_rate"))
    return entries, A.latest(rows.select(*RATE_KEYS, month.alias("l_month"), rate.alias("l_rate")), list(RATE_KEYS), "l_month")


def rate_lookup(usage: DataFrame, rates: DataFrame, rate_col: str, isr: Column, fallback_months: int = 3,
                month_as_text: bool = True, months: tuple[int, int] | None = None,
                stage: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Add ``iot_rate`` and ``iot_call_year_month`` to usage rows.

    Exact month rate; when that rate is NULL (no row, or a NULL rate), the
    latest rate of the pair and call type - the latest month overall, which may
    be later than the call - unless it is more than ``fallback_months`` older
    than the call.  ISR traffic has no rate.

    With ``months`` (``yyyymm`` bounds of the usage's months, both included), rates are
    carried into a table of (key, month) once, at the size of the rate card, and the
    usage has one equi-join on partner, home, call type and month; ``stage`` writes that
    table first, so that its measured size decides on a broadcast.  Without, the month's
    rate and the key's latest one are two equi-joins.
    """
    key = {"their_pmn_tadig_code": "dst_tadig", "my_pmn_tadig_code": "src_tadig", "call_type": "call_type"}
    exact_cols, last_cols = {"__x_rate": "x_rate", "__x_month": "x_month"}, {"__l_rate": "l_rate", "__l_month": "l_month"}
    found = exact_cols | last_cols
    if months is None:
        entries, last = _rate_rows(rates, rate_col)
        out = J.lookup(J.lookup(usage, entries, key | {"call_month": "month"}, exact_cols), last, key, last_cols)
    else:
        table = asof_rates(rates, rate_col, months)
        out = J.lookup(usage, stage(table, "asof_rates") if stage else table, key | {"call_month": "month"}, found)
    too_old = F.col("__l_month").cast("bigint") < S.yyyymm(F.add_months(F.col("call_date"), -fallback_months))
    exact = F.col("__x_rate").isNotNull()
    rate = F.when(isr, F.lit(None)).when(exact, F.col("__x_rate")).when(too_old, F.lit(None)).otherwise(F.col("__l_rate"))
    month = F.when(isr, F.lit(None)).when(exact, F.col("__x_month")).when(too_old, F.lit(None)).otherwise(F.col("__l_month"))
    return (out.withColumn("iot_rate", rate.cast("double"))
            .withColumn("iot_call_year_month", month if month_as_text else month.cast("bigint")).drop(*found))


def months_until(since: dt.date, as_of: dt.date | str | None) -> tuple[int, int]:
    """The months (``yyyymm``) from that of ``since`` to that of the run date."""
    last = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of or dt.date.today()
    return since.year * 100 + since.month, last.year * 100 + last.month


# M09 ---------------------------------------------------------------------------
def value_usage(variant: str, rate: str = "iot_rate") -> Column:
    """Quantity x rate by call type (revenue inbound, cost outbound)."""
    r = F.col(rate)
    sms_mo = F.col("number_of_calls") * r if variant == "inbound" else F.lit(None).cast("double")
    return S.case([
        (F.col("call_type") == "MOC", F.col("real_duration_minutes") * r),
        (F.col("call_type") == "GPRS", F.col("total_real_volume_mb") * r),
        (F.col("call_type") == "SMS-MT", F.lit(0.0)),
        (F.col("call_type") == "SMS-MO", sms_mo),
        (F.col("call_type") == "MTC", F.col("real_duration_minutes") * r),
        (F.col("call_type") == "SS", F.lit(None).cast("double")),
    ], F.lit(None).cast("double"))


# M10 ---------------------------------------------------------------------------
def to_currency(df: DataFrame, fx: DataFrame, currency: str = "EUR", charges: str = "total_charges_sdr",
                volume: str = "total_charged_volume_mb") -> DataFrame:
    """Convert charges with the rate valid on the call date; add the unit price.

    NULL volume -> unit price 0; zero volume -> NULL.
    """
    rates = P.filter_eq(fx, "currency_code", currency)
    out = J.as_valid_join(df, rates, "call_date", "effective_date", "end_date",
                          {"__fx": "sdr_to_local_currency_exchange_rate"})
    eur = F.col(charges) * F.col("__fx")
    return (out.withColumn("total_charges_eur", eur)
            .withColumn("iot_rate_eur", F.when(F.col(volume).isNull(), F.lit(0.0)).otherwise(S.safe_divide(eur, volume)))
            .drop("__fx"))


# M11 ---------------------------------------------------------------------------
PRICE_KEYS = ("my_pmn_tadig_code", "their_pmn_tadig_code", "call_type")


def price_change(df: DataFrame, report_from: Column | None = None) -> DataFrame:
    """Each day against the same day one month earlier: % change and impact.

    ``report_from`` limits the reported (left) days; the month-earlier side
    keeps its full range.
    """
    left = df if report_from is None else df.where(F.col("call_date") > report_from)
    joined = J.period_over_period(left, list(PRICE_KEYS), "call_date",
                                  {"total_charges_eur_30": "total_charges_eur", "call_date_30": "call_date",
                                   "iot_rate_eur_30": "iot_rate_eur"}, earlier=df)
    r, r30 = F.col("iot_rate_eur"), F.col("iot_rate_eur_30")
    return (joined
            .withColumn("percentage", F.when(r30 == 0, F.lit(0.0)).otherwise(S.safe_divide(r - r30, r30) * 100))
            .withColumn("impact", (r - r30) * F.col("total_charged_volume_mb")))


# M12 ---------------------------------------------------------------------------
def alert_base(usage: DataFrame, cfg: AlertConfig, as_of: dt.date | str | None) -> DataFrame:
    """Daily volume and charges per pair for the alert ledgers."""
    df = P.lookback(usage, "call_date", as_of, cfg.scan_days)
    df = P.filter_not_in(df, "my_pmn_tadig_code", cfg.excluded_home)
    df = P.filter_not_in(df, "their_pmn_tadig_code", cfg.excluded_partner)
    df = P.filter_eq(df, "call_type", cfg.call_type)
    df = P.exclude_pairs(df, "my_pmn_tadig_code", "their_pmn_tadig_code", cfg.excluded_pairs)
    return A.group_sum(df, ["call_date", *PRICE_KEYS], ["total_charged_volume_mb", "total_charges_sdr"])


# M13 ---------------------------------------------------------------------------
def steering_setting(steering: DataFrame, renames: Sequence[tuple[str, str]] = (("NLISR", "NLDLT"),)) -> DataFrame:
    """Latest month's steering setting per (source, destination, target rate).

    B: target 0.  P: target at or above an equal share (1 / number of
    destinations with a positive target in the same country, source, call
    type and month).  NP: below it.  No positive target: NULL.
    """
    top = A.global_max(steering, "call_year_month", "__max_month")
    latest = J.with_scalar(steering, top).where(F.col("call_year_month") == F.col("__max_month")).drop("__max_month")
    keys = ["target_country_name", "source_tadig", "call_type", "call_year_month"]
    counted = A.with_partition_aggs(latest, keys, {"__n_pos": F.count(
        F.when(F.col("target_capture_rate") > 0, F.col("destination_tadig")))})
    share = S.divide(F.lit(1.0), F.col("__n_pos"))
    t = F.col("target_capture_rate")
    setting = S.case([(t == 0, "B"), (t >= share, "P"), (t < share, "NP")], F.lit(None).cast("string"))
    src = F.col("source_tadig")
    for old, new in renames:
        src = F.when(F.col("source_tadig") == old, F.lit(new)).otherwise(src)
    return counted.select(src.alias("source_tadig"), "destination_tadig", "target_capture_rate",
                          setting.alias("steering_settings")).distinct()


# M14 ---------------------------------------------------------------------------
def cost_delta(traffic: str = "country_traffic", rate: str = "curr_out_final_iot",
               target: str = "target_capture_rate", actual: str = "actual_capture_rate") -> Column:
    """traffic x rate (NULL rate = 0) x (target - actual)."""
    return F.col(traffic) * F.coalesce(F.col(rate), F.lit(0.0)) * (F.col(target) - F.col(actual))


# M15 ---------------------------------------------------------------------------
def latest_names(inbound: DataFrame, outbound: DataFrame, stage=None) -> DataFrame:
    """Latest operator and country name per code, over both usage tables and both roles.

    One scan per table: each row yields its home and partner (code, name,
    country, date); rows on each code's latest date are kept, ties included.
    An empty partner operator name falls back to the primary operator name.
    """
    def roles(df: DataFrame) -> DataFrame:
        home = F.struct(F.col("my_pmn_tadig_code").alias("tadig"), F.col("my_operator_name").alias("syn_operator"),
                        F.col("my_country_name").alias("syn_country"), F.col("call_date"))
        partner = F.struct(F.col("their_pmn_tadig_code").alias("tadig"),
                           S.if_empty("their_operator_name", "their_primary_operator_name").alias("syn_operator"),
                           F.col("their_country_name").alias("syn_country"), F.col("call_date"))
        return df.select(F.explode(F.array(home, partner)).alias("r")).select("r.*")

    # The result is distinct, so distinct first: a partial aggregate that shrinks
    # usage rows to (code, name, country, day) before anything is shuffled or
    # joined back; the latest-day step then works on that small table.
    both = roles(inbound).unionByName(roles(outbound)).distinct()
    if stage is not None:  # written once, so each usage table is scanned once
        both = stage(both, "name_days")
    return A.latest(both, ["tadig"], "call_date")


# M16 / M17 / M18 ---------------------------------------------------------------------
def best_name(*cols: str) -> Column:
    """First non-NULL of CRM, usage and billing names."""
    return F.coalesce(*[F.col(c) for c in cols])


def month_floor(df: DataFrame, date_col: str = "call_date", months: int = 2, alias: str = "max_call_date") -> DataFrame:
    """One row: first day of the month ``months`` before the latest date."""
    return df.agg(F.trunc(F.add_months(F.max(date_col), -months), "month").alias(alias))


def tap_rate() -> Column:
    """Charge per minute for MOC, per MB otherwise."""
    return F.when(F.col("call_type") == "MOC", S.safe_divide("total_charges_sdr", "real_duration_minutes")) \
        .otherwise(S.safe_divide("total_charges_sdr", "total_real_volume_mb"))
