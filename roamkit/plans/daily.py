"""Run the report builds against real tables, in dependency order.

``build_reports`` is what a deployment calls once per run: it reads the named
input tables, builds every report, and writes each output as a new version in
a :class:`~roamkit.sources.tables.TableStore` (readers keep the old version
until the new one is committed).  The alert ledgers snapshot their previous
output first and are rebuilt against that snapshot.  Order: C01 and C02, then
C03 (reads C01's table), then C04 (reads C01-C03), then the rest.

Command line::

    python -m roamkit.plans.daily --tables tables.json --out <root> [--as-of YYYY-MM-DD] [--only c05,c11]
        [--settings settings.json]

``tables.json`` maps each input name (see ``REPORT_INPUTS``) to a Parquet path
or a catalog table name.  ``settings.json`` replaces defaults of ``roamkit.config``
(see ``settings_from``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from roamkit.config import Settings, settings_from
from roamkit.plans import reports as C
from roamkit.operators.joins import estimated_bytes
from roamkit.session import apply_scale_conf, size_shuffles
from roamkit.sources.tables import TableStore

# Output table and the inputs each build reads.
REPORT_INPUTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "c01": ("tadig_reference", ("inbound_usage", "outbound_usage", "operator", "country", "crm_account")),
    "c02": ("abs_steering_performance", ("capture_rate_performance", "rate_card", "code_region")),
    "c03": ("sfc_service_openings_vw", ("crm_footprint_service", "code_region", "crm_asset")),
    "c04": ("service_openings_extended_vw", ("crm_extended_coverage", "code_region")),
    "c05": ("inbound_valued", ("inbound_aggregate", "code_business", "rate_card")),
    "c06": ("outbound_valued", ("outbound_usage", "code_business", "rate_card", "outbound_history")),
    "c07": ("steering_mtd_vw", ("steering_mtd", "code_business")),
    "c08": ("monthly_counts", ("monthly_counts_history", "monthly_counts_live")),
    "c09": ("contract_register", ("crm_negotiator", "crm_contract", "fiscal_year", "crm_user", "crm_deleted_deal")),
    "c10": ("traffic_deviation", ("outbound_usage", "unique_roamers_daily", "code_business")),
    "c11": ("price_alert", ("inbound_usage", "fx_rates")),
    "c12": ("rolling_alert_inbound", ("inbound_usage", "fx_rates")),
    "c13": ("rolling_alert_outbound", ("outbound_usage", "fx_rates")),
}
DEPENDS = {"c03": ("c01",), "c04": ("c01", "c02", "c03")}


def build_reports(tables: Mapping[str, DataFrame], store: TableStore, settings: Settings = Settings(),
                  as_of: dt.date | str | None = None, only: set[str] | None = None) -> dict[str, DataFrame]:
    """Build the selected reports (all by default) and return their new versions."""
    wanted = set(only or REPORT_INPUTS)
    for rid in list(wanted):
        wanted |= set(DEPENDS.get(rid, ()))
    out: dict[str, DataFrame] = {}

    def put(rid: str, df: DataFrame) -> None:
        out[rid] = store.replace(df, REPORT_INPUTS[rid][0])

    def ledger(rid: str, build: Callable[[DataFrame | None], DataFrame]) -> None:
        name, keys = REPORT_INPUTS[rid][0], C.PRICE_ALERT_KEYS if rid == "c11" else C.ROLLING_ALERT_KEYS
        prev = store.snapshot(name)  # before the rebuild; None on the first run
        if prev is not None:
            prev = store.read_bucketed(f"{name}_prev", keys, s.ledger_buckets)
        out[rid] = store.replace_bucketed(build(prev), name, keys, s.ledger_buckets)

    s = settings
    if "c01" in wanted:
        put("c01", C.tadig_reference(tables, stage=store.replace))
    if "c02" in wanted:
        put("c02", C.steering_performance(tables, s.steering, stage=store.replace))
    if "c03" in wanted:
        put("c03", C.service_openings(tables, out["c01"]))
    if "c04" in wanted:
        put("c04", C.service_openings_extended(tables, out["c02"], out["c03"], out["c01"], s.steering))
    simple = {
        "c05": lambda: C.inbound_valued(tables, s.valued, as_of, store.replace),
        "c06": lambda: C.outbound_valued(tables, s.valued, as_of, store.replace),
        "c07": lambda: C.steering_mtd(tables),
        "c08": lambda: C.monthly_counts(tables, s.monthly),
        "c09": lambda: C.contract_register(tables),
        "c10": lambda: C.traffic_deviation(tables, s.deviation),
    }
    for rid, build in simple.items():
        if rid in wanted:
            put(rid, build())
    if "c11" in wanted:
        ledger("c11", lambda prev: C.price_alert(tables, prev, s.alert, as_of, stage=store.replace))
    if "c12" in wanted:
        ledger("c12", lambda prev: C.rolling_alert(tables, prev, s.alert, as_of, "inbound", store.replace))
    if "c13" in wanted:
        ledger("c13", lambda prev: C.rolling_alert(tables, prev, s.alert, as_of, "outbound", store.replace))
    return out


def read_inputs(spark: SparkSession, locations: Mapping[str, str]) -> dict[str, DataFrame]:
    """Input DataFrames by name: a Parquet path (contains ``/``) or a catalog table name."""
    return {name: spark.read.parquet(where) if "/" in where else spark.table(where)
            for name, where in locations.items()}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--tables", required=True, help="JSON file: input name -> Parquet path or table name")
    ap.add_argument("--out", required=True, help="root folder of the output table store")
    ap.add_argument("--as-of", default=None, help="run date (default: today)")
    ap.add_argument("--only", default=None, help="comma-separated report ids, e.g. c05,c11")
    ap.add_argument("--settings", default=None, help="JSON file: settings that differ from the defaults")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("roamkit-daily").getOrCreate()
    apply_scale_conf(spark)
    with open(args.tables) as fh:
        locations = json.load(fh)
    only = set(args.only.split(",")) if args.only else None
    tables = read_inputs(spark, locations)
    size_shuffles(spark, sum(estimated_bytes(df) for df in tables.values()))
    settings = Settings()
    if args.settings:
        with open(args.settings) as fh:
            settings = settings_from(json.load(fh))
    built = build_reports(tables, TableStore(spark, args.out), settings, args.as_of, only)
    for rid, df in sorted(built.items()):
        print(rid, REPORT_INPUTS[rid][0], df.inputFiles()[0].rsplit("/", 1)[0] if df.inputFiles() else "")


if __name__ == "__main__":
    main()
