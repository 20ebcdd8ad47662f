"""Configuration: code lists, thresholds, windows and cut-over months.

Every report takes one of these frozen dataclasses, so a deployment (or a test
binding) can re-aim a report at other codes or dates without touching the plan.
The defaults are the production values the reports were written with.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the production report definitions for the
# reports to give the same answers; they are listed here together, as text.
# ---------------------------------------------------------------------------

# Home operator codes left out of the alert ledgers.
ALERT_EXCLUDED_HOME = ("AUSVF", "EGYMS", "QATB1", "MLTTL")
# Partner operator codes left out of the alert ledgers.
ALERT_EXCLUDED_PARTNER = (
    "ALBVF", "CODVC", "CZECM", "DEUD2", "ESPAT", "GBRVF", "GHAGT", "GRCPF",
    "HUNVR", "IRLEC", "ITAOM", "LSOVL", "MLTTL", "MOZVC", "NLDLT", "NZLBS",
    "PRTTL", "ROMMF", "TURTS", "TZAVC", "ZAFVC",
)
# Concatenated home+partner pairs left out of the alert ledgers.
ALERT_EXCLUDED_PAIRS = ("NZLBSNZLNH", "ITAOMITAFS", "DEUD2DEU42")
# Source codes dropped from rate cards and steering from the cut-over month on.
CUTOVER_EXCLUDED_SOURCES = ("MLTTL", "MLTMA")
CUTOVER_MONTH = 202004
# CRM service-opening status -> status group; anything else is "Not Open".
STATUS_GROUPS = (
    ("NA", "Not Open"),
    ("Not Started", "Not Open"),
    ("0", "Not Open"),
    ("CLL", "Progressing"),
    ("FD", "Progressing"),
    ("Impl", "Progressing"),
    ("Leg HP Done", "Progressing"),
    ("Pretest", "Progressing"),
    ("Hold", "Progressing"),
    ("Awaiting", "Progressing"),
    ("Live", "Open"),
)
STATUS_DEFAULT = "Not Open"
# Characters that start a new word for the warehouse's INITCAP (besides whitespace).
INITCAP_DELIMITERS = "[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"
# Sentinel partition value when a landing table has nothing new.
NO_PARTITION = "9999-12-31"


@dataclass(frozen=True)
class AlertConfig:
    """Price and rolling-average alert ledgers."""

    call_type: str = "GPRS"
    currency: str = "EUR"
    excluded_home: tuple[str, ...] = ALERT_EXCLUDED_HOME
    excluded_partner: tuple[str, ...] = ALERT_EXCLUDED_PARTNER
    excluded_pairs: tuple[str, ...] = ALERT_EXCLUDED_PAIRS
    scan_days: int = 100
    report_days: int = 35
    pct_threshold: float = 20.0
    unit_price_threshold: float = 0.90
    charge_threshold: float = 10000.0
    volume_threshold: float = 150.0
    rolling_rows: int = 7
    rolling_threshold: float = 10000.0
    # Match snapshot rows whose call_date_30 is NULL too (the production
    # ledger does not: such rows are re-added on every run).
    null_safe: bool = False


@dataclass(frozen=True)
class ValuedConfig:
    """Inbound/outbound usage valued with the rate card."""

    cutover_month: int = CUTOVER_MONTH
    cutover_excluded: tuple[str, ...] = CUTOVER_EXCLUDED_SOURCES
    history_floor: dt.date = dt.date(2019, 2, 1)
    settle_days: int = 6
    recent_days: int = 28
    # Year-ago span, as (lo, hi) days before the latest date, per direction.
    inbound_year_ago: tuple[int, int] = (393, 366)
    outbound_year_ago: tuple[int, int] = (392, 365)
    fallback_months: int = 3
    rate_traffic_type: str = "Actual"
    # Outbound: the frozen-history code and the last date its history covers.
    frozen_code: str = "DEUD2"
    frozen_until: dt.date = dt.date(2019, 8, 2)


@dataclass(frozen=True)
class SteeringConfig:
    """Steering performance and service openings."""

    history_floor_month: int = 201801
    extended_floor_month: str = "201901"
    cutover_month: int = CUTOVER_MONTH
    cutover_excluded: tuple[str, ...] = CUTOVER_EXCLUDED_SOURCES
    # Source code renamed before the steering lookup in C04.
    source_renames: tuple[tuple[str, str], ...] = (("NLISR", "NLDLT"),)


@dataclass(frozen=True)
class DeviationConfig:
    """Traffic deviation."""

    months_back: int = 2
    call_types: tuple[str, ...] = ("MOC", "GPRS")
    split_code: str = "NLDLT"
    split_prefix: str = "NL"
    m2m_code: str = "AAZVF"
    m2m_codes: tuple[str, ...] = ("AAZVF", "MLTMA")


@dataclass(frozen=True)
class MonthlyCountsConfig:
    """History + live monthly counts."""

    excluded_home: tuple[str, ...] = CUTOVER_EXCLUDED_SOURCES


@dataclass(frozen=True)
class LoadConfig:
    """Staged load (L01-L09).  ``date`` and ``sources`` override discovery."""

    sources: tuple[str, ...] = ()
    date: str | None = None
    flow: str = "staging_load"
    sentinel: str = NO_PARTITION
    success_log: str = "Data is successfully loaded in staging"
    load_task: str = "load_data_"  # task of the run log that loads a source, and the one that refuses to
    skip_task: str = "do_not_load_"
    job_prefix: str = "job_"


@dataclass(frozen=True)
class Settings:
    alert: AlertConfig = field(default_factory=AlertConfig)
    valued: ValuedConfig = field(default_factory=ValuedConfig)
    steering: SteeringConfig = field(default_factory=SteeringConfig)
    deviation: DeviationConfig = field(default_factory=DeviationConfig)
    monthly: MonthlyCountsConfig = field(default_factory=MonthlyCountsConfig)
    load: LoadConfig = field(default_factory=LoadConfig)
    ledger_buckets: int = 200  # buckets of the alert ledgers; one holds at most a few hundred MB


def settings_from(values: Mapping[str, Any]) -> Settings:
    """``Settings`` with some values replaced: ``{"alert": {"scan_days": 60}, "ledger_buckets": 50}``, as read from JSON.

    Lists become tuples and ISO dates of date fields dates; a name that doesn't exist is an error.
    """
    def filled(default: Any, given: Any) -> Any:
        if dataclasses.is_dataclass(default):
            known = {f.name: getattr(default, f.name) for f in dataclasses.fields(default)}
            if unknown := set(given) - set(known):
                raise ValueError(f"unknown settings: {sorted(unknown)}")
            return dataclasses.replace(default, **{k: filled(known[k], v) for k, v in given.items()})
        if isinstance(given, list):
            return tuple(tuple(v) if isinstance(v, list) else v for v in given)
        return dt.date.fromisoformat(given) if isinstance(default, dt.date) else given

    return filled(Settings(), values)
