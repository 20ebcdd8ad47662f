"""End-to-end report builds.

Each build is a function from input DataFrames (a ``Mapping[str, DataFrame]``
keyed by input name, see ``sources.binding``) to one output DataFrame.  The
caller decides where outputs go (``sources.tables.TableStore``); builds that
depend on another build's output take it as an argument, in the order
C01, C02 -> C03 -> C04.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamkit.config import (AlertConfig, DeviationConfig, MonthlyCountsConfig, SteeringConfig,
                            ValuedConfig)
from roamkit.functions import scalars as S
from roamkit.operators import aggs as A
from roamkit.operators import filters as P
from roamkit.operators import joins as J
from roamkit.operators import roaming as M
from roamkit.operators import sets as U

Tables = Mapping[str, DataFrame]
Stage = Callable[[DataFrame, str], DataFrame]


# C01 -------------------------------------------------------------------------------
def tadig_reference(t: Tables, stage=None) -> DataFrame:
    """One row per code and name variant from usage, billing and CRM sources.

    ``stage(df, name) -> DataFrame`` writes the small (code, name, country, day)
    table once; without it Spark re-reads the usage tables for every use.
    """
    syn = M.latest_names(t["inbound_usage"], t["outbound_usage"], stage)
    crm = P.active(t["crm_account"])
    master = U.union_distinct(t["operator"].select(F.col("tap_code").alias("tadig")),
                              syn.select("tadig"),
                              crm.select(F.col("tadig_code").alias("tadig")))
    abs_ = J.operator_country(t["operator"], t["country"])
    out = J.lookup(master, abs_, {"tadig": "tap_code"}, {"abs_country": "abs_country", "abs_operator": "operator_name"})
    out = J.lookup(out, syn, {"tadig": "tadig"}, {"syn_country": "syn_country", "syn_operator": "syn_operator"})
    out = J.lookup(out, crm, {"tadig": "tadig_code"},
                   {"sfc_region": "country_region", "sfc_country": "country", "sfc_operator": "name",
                    "sfc_network_name": "network_name"})
    out = P.with_nulls(out, {"syn_region": "string", "abs_region": "string"})
    return out.select("tadig", "syn_region", "syn_country", "syn_operator", "abs_region", "abs_country",
                      "abs_operator", "sfc_region", "sfc_country", "sfc_operator", "sfc_network_name").distinct()


# C02 -------------------------------------------------------------------------------
STEERING_TOTALS = (
    ("total_target_country_cost_delta", "target_country_name", "total_target_country_rank"),
    ("total_source_country_cost_delta", "source_country_name", "total_source_country_rank"),
    ("total_call_type_cost_delta", "call_type", "total_call_type_rank"),
    ("total_source_tadig_cost_delta", "source_tadig", "total_source_tadig_rank"),
    ("total_dest_tadig_cost_delta", "destination_tadig", "total_dest_tadig_rank"),
)
CAPTURE_PASSTHROUGH = ("traffic_volume_dst_tadig", "country_traffic", "actual_capture_rate", "target_capture_rate",
                       "target_based_outbound_costs", "actual_outbound_costs")
CAPTURE_TAIL = ("discount_period_id", "period_from", "period_to", "discount_model", "commitment_type", "created_by",
                "created_date", "last_updated_by", "last_updated_date", "parent_id", "level_number")


def steering_performance(t: Tables, cfg: SteeringConfig = SteeringConfig(), stage=None) -> DataFrame:
    """Capture-rate performance valued at the rate card: cost delta, 5 totals, 5 ranks.

    ``stage(df, name) -> DataFrame`` materialises the valued rows and the five
    per-key total tables (see ``aggs.with_totals_and_ranks``): the rows are then
    computed once and every total joins back by broadcast of a measured table.
    """
    crp = t["capture_rate_performance"]
    crp = crp.where((F.col("call_type") != "TOTAL")
                    & (F.col("dst_tadig").isNotNull() | (F.col("dst_tadig") != ""))
                    & (F.col("src_tadig").isNotNull() | (F.col("src_tadig") != ""))
                    & (F.col("call_year_month").cast("bigint") >= cfg.history_floor_month))
    # LEFT JOIN abs_iot ... WHERE iot.src_tadig = ... is an inner join on all four keys.
    df = J.inner_join(crp, t["rate_card"], {"dst_tadig": "dst_tadig", "src_tadig": "src_tadig",
                                            "call_year_month": "call_year_month", "call_type": "call_type"},
                      {"curr_out_final_iot": "curr_out_final_iot"})
    region = t["code_region"]
    df = J.lookup_roles(df, region, "tadig", {"source_": "src_tadig"},
                        {"operator_name": "operator_name", "group_name": "group_name", "country_name": "country_name",
                         "region_name": "region_name"}, key_fn=S.trim)
    df = J.lookup_roles(df, region, "tadig", {"target_": "dst_tadig"},
                        {"operator_name": "operator_name", "group_name": "group_name", "region_name": "region_name"},
                        key_fn=S.trim)
    df = df.select(
        "capture_rate_performance_id", "call_year_month", "call_type",
        F.col("src_tadig").alias("source_tadig"), "source_operator_name", "source_group_name", "source_country_name",
        "source_region_name", F.col("dst_tadig").alias("destination_tadig"), "target_operator_name",
        "target_group_name", F.col("country_description").alias("target_country_name"), "target_region_name",
        *CAPTURE_PASSTHROUGH, M.cost_delta().alias("cost_delta"),
        F.coalesce(F.col("curr_out_final_iot"), F.lit(0.0)).alias("iot_rate"), *CAPTURE_TAIL)
    if stage is not None:
        df = stage(df, "steering_valued")
    df = A.with_totals_and_ranks(df, ["call_year_month"], "cost_delta",
                                 [(key, total, rank) for total, key, rank in STEERING_TOTALS], stage=stage)
    df = U.cutover(df, "call_year_month", cfg.cutover_month, "source_tadig", cfg.cutover_excluded)
    return df.select(*STEERING_COLUMNS)


STEERING_COLUMNS = (
    "capture_rate_performance_id", "call_year_month", "call_type", "source_tadig", "source_operator_name",
    "source_group_name", "source_country_name", "source_region_name", "destination_tadig", "target_operator_name",
    "target_group_name", "target_country_name", "target_region_name", *CAPTURE_PASSTHROUGH, "cost_delta", "iot_rate",
    *CAPTURE_TAIL, *[x[0] for x in STEERING_TOTALS], *[x[2] for x in STEERING_TOTALS])


# C03 -------------------------------------------------------------------------------
OPENINGS_COLUMNS = ("operator_name_id", "home_tadig", "home_region", "visited_tadig", "visited_region", "product",
                    "relationship_direction", "status", "operator_type", "home_contract_type",
                    "visited_contract_type", "open_date", "home_operator", "visited_operator", "home_country",
                    "visited_country", "vplmn_shutdown_date", "hplmn_shutdown_date", "home_network_name",
                    "tadig_network_name")


def service_openings(t: Tables, tadig_ref: DataFrame) -> DataFrame:
    """CRM service openings per direction with the best available names."""
    sfs = P.active(t["crm_footprint_service"])
    region = t["code_region"]
    cols = {"operator": "operator_name", "country": "country_name", "region": "region_name"}
    df = J.lookup_expr(sfs, region, "hplmn_operator_tadig", "tadig", {f"home_{k}": v for k, v in cols.items()}, S.trim)
    df = J.lookup_expr(df, region, "vplmn_operator_tadig", "tadig", {f"visited_{k}": v for k, v in cols.items()}, S.trim)
    assets = P.active(t["crm_asset"])
    # LEFT JOIN asset ... WHERE asset.bdp_active_flag = 1: inner joins to active assets.
    df = J.inner_join(df, assets, {"vplmn_asset_service": "id"}, {"vp_shutdown": "shutdown_date"})
    df = J.inner_join(df, assets, {"hplmn_account_asset_service": "id"}, {"hp_shutdown": "shutdown_date"})
    keys = ["name", "hplmn_operator_tadig", "home_operator", "home_country", "home_region", "vplmn_operator_tadig",
            "visited_operator", "visited_country", "visited_region", "product", "relationship_direction", "status",
            "so_type", "hp_contract_type", "vp_contract_type", "vp_shutdown", "hp_shutdown"]
    # Group on the raw shutdown text: two texts of one date stay two rows.
    grouped = M.open_date(df, keys, ["cll_date", "commercial_migration_date", "open_date_formula"])
    grouped = grouped.select(
        "name", F.col("hplmn_operator_tadig").alias("home_tadig"), F.col("vplmn_operator_tadig").alias("visited_tadig"),
        "product", "relationship_direction", "status", F.col("so_type").alias("type"),
        F.col("hp_contract_type").alias("home_contract_type"), F.col("vp_contract_type").alias("visited_contract_type"),
        "open_date", S.parse_crm_date("vp_shutdown").alias("vplmn_shutdown_date"),
        S.parse_crm_date("hp_shutdown").alias("hplmn_shutdown_date"))
    split = U.split_direction(grouped)
    ref = {"region": "sfc_region", "sfc_operator": "sfc_operator", "syn_operator": "syn_operator",
           "abs_operator": "abs_operator", "sfc_country": "sfc_country", "syn_country": "syn_country",
           "abs_country": "abs_country", "network_name": "sfc_network_name"}
    out = J.lookup(split, tadig_ref, {"home_tadig": "tadig"}, {f"h_{k}": v for k, v in ref.items()})
    out = J.lookup(out, tadig_ref, {"visited_tadig": "tadig"}, {f"v_{k}": v for k, v in ref.items()})
    out = out.select(
        F.col("name").alias("operator_name_id"), "home_tadig", F.col("h_region").alias("home_region"),
        "visited_tadig", F.col("v_region").alias("visited_region"), "product", "relationship_direction", "status",
        F.col("type").alias("operator_type"), "home_contract_type", "visited_contract_type", "open_date",
        M.best_name("h_sfc_operator", "h_syn_operator", "h_abs_operator").alias("home_operator"),
        M.best_name("v_sfc_operator", "v_syn_operator", "v_abs_operator").alias("visited_operator"),
        M.best_name("h_sfc_country", "h_syn_country", "h_abs_country").alias("home_country"),
        M.best_name("v_sfc_country", "v_syn_country", "v_abs_country").alias("visited_country"),
        "vplmn_shutdown_date", "hplmn_shutdown_date",
        F.col("h_network_name").alias("home_network_name"), F.col("v_network_name").alias("tadig_network_name"))
    return P.require(out, "home_country", "visited_country").select(*OPENINGS_COLUMNS)


# C04 -------------------------------------------------------------------------------
EXTENDED_COLUMNS = ("operator_name_id", "home_tadig", "home_operator", "home_country", "home_region", "visited_tadig",
                    "visited_operator", "visited_country", "visited_region", "product", "relationship_direction",
                    "status", "operator_type", "home_contract_type", "visited_contract_type", "open_date",
                    "target_capture_rate", "steering_settings", "extended_coverage", "vplmn_shutdown_date",
                    "hplmn_shutdown_date")


def service_openings_extended(t: Tables, steering: DataFrame, openings: DataFrame, tadig_ref: DataFrame,
                              cfg: SteeringConfig = SteeringConfig()) -> DataFrame:
    """Service openings plus extended coverage, with the latest steering setting."""
    asp = P.require(steering, "destination_tadig", "source_tadig")
    asp = P.month_bound(asp, "call_year_month", ">=", cfg.extended_floor_month)
    sp = M.steering_setting(asp, cfg.source_renames)
    latest = J.lookup(openings, sp, {"home_tadig": "source_tadig", "visited_tadig": "destination_tadig"},
                      {"target_capture_rate": "target_capture_rate", "steering_settings": "steering_settings"})
    latest = P.with_constants(latest, {"extended_coverage": "No"})

    ext = P.filter_eq(P.active(t["crm_extended_coverage"]), "is_main_operator", "false")
    region = t["code_region"]
    # The region look-ups add no output column but can repeat rows; keep them.
    ext = J.lookup_expr(ext, region, "lm_operator_tadig", "tadig", {"__h_region": "region_name"}, S.trim)
    ext = J.lookup_expr(ext, region, "tadig", "tadig", {"__v_region": "region_name"}, S.trim)
    ref = {"op": "sfc_operator", "country": "sfc_country", "region": "sfc_region"}
    ext = J.lookup(ext, tadig_ref, {"lm_operator_tadig": "tadig"}, {f"h_{k}": v for k, v in ref.items()})
    ext = J.lookup(ext, tadig_ref, {"tadig": "tadig"}, {f"v_{k}": v for k, v in ref.items()})
    ext = ext.select(
        F.col("id").alias("operator_name_id"), F.col("lm_operator_tadig").alias("home_tadig"),
        F.col("h_op").alias("home_operator"), F.upper("h_country").alias("home_country"),
        F.upper("h_region").alias("home_region"), F.col("tadig").alias("visited_tadig"),
        F.col("v_op").alias("visited_operator"), F.upper("v_country").alias("visited_country"),
        F.upper("v_region").alias("visited_region"), F.col("asset").alias("product"),
        F.lit("Unilateral Outbound").alias("relationship_direction"), S.map_status("status").alias("status"),
        F.col("is_main_operator").alias("operator_type"),
        F.lit(None).cast("string").alias("home_contract_type"), F.lit(None).cast("string").alias("visited_contract_type"),
        F.lit(None).cast("date").alias("open_date"), F.lit(None).cast("double").alias("target_capture_rate"),
        F.lit(None).cast("string").alias("steering_settings"), F.lit("Yes").alias("extended_coverage"),
        F.lit(None).cast("date").alias("vplmn_shutdown_date"), F.lit(None).cast("date").alias("hplmn_shutdown_date"))
    return U.union_distinct(latest.select(*EXTENDED_COLUMNS), ext.select(*EXTENDED_COLUMNS))


# C05 / C06 ---------------------------------------------------------------------------
def _valued(usage: DataFrame, t: Tables, cfg: ValuedConfig, as_of, direction: str,
            dates: DataFrame | None = None, stage: Stage | None = None) -> DataFrame:
    """``dates``: a table with the same call dates as ``usage`` to take the latest
    settled date and the country names from (the raw rows of an aggregate: their own
    columns, no aggregation).  With ``stage``, INITCAP runs once a distinct name."""
    biz = t["code_business"].withColumn("country_cap", S.initcap("country"))
    max_d = A.global_max(usage if dates is None else dates, "call_date", "__max_date",
                         where=F.col("call_date") < F.date_sub(S.as_of_date(as_of), cfg.settle_days))
    df = P.settled(P.since(usage, "call_date", cfg.history_floor), "call_date", as_of, cfg.settle_days)
    df = J.lookup(df, biz, {"my_pmn_tadig_code": "tadig"},
                  {"my_pmn_country": "country_cap", "b_traffic_type": "traffic_type", "b_intragroup_eligible": "intragroup_eligible"})
    df = J.lookup(df, biz, {"their_pmn_tadig_code": "tadig"},
                  {"c_traffic_type": "traffic_type", "c_intragroup_eligible": "intragroup_eligible"})
    df = J.with_scalar(df, max_d)
    inbound = direction == "inbound"
    isr = (F.upper("b_traffic_type") == "ISR") | (F.upper("c_traffic_type") == "ISR")
    df = M.rate_lookup(df, M.rate_table(t["rate_card"], cfg), "curr_in_final_iot" if inbound else "curr_out_final_iot",
                       isr, cfg.fallback_months, month_as_text=inbound, months=M.months_until(cfg.history_floor, as_of), stage=stage)
    caps = {"their_pmn_country": "their_country_name", "__serving": "serving_country_name"}
    if stage is None:
        df = df.withColumns({out: S.initcap(c) for out, c in caps.items()})
    else:
        names = J.value_map(usage if dates is None else dates, list(caps.values()), S.initcap)
        df = J.with_mapped(df, stage(names, "country_names"), caps)
    df = df.select(
        "*",
        M.intragroup().alias("intragroup"),
        M.traffic_type(direction, capped=("my_pmn_country", "their_pmn_country")).alias("traffic_type"),
        M.recent_flag("call_date", "__max_date", cfg.recent_days,
                      cfg.inbound_year_ago if inbound else cfg.outbound_year_ago).alias("last_28_days"),
        M.value_usage(direction).alias("estimated_revenue" if inbound else "estimated_cost"),
    ).drop("serving_country_name").withColumnRenamed("__serving", "serving_country_name")
    return df


INBOUND_COLUMNS = ("call_date", "call_month", "call_year", "my_pmn_tadig_code", "my_pmn_country", "my_operator_name",
                   "their_pmn_tadig_code", "their_pmn_country", "intragroup", "traffic_type", "last_28_days",
                   "serving_country_name", "serving_network", "subscriber_type", "call_type", "number_of_calls",
                   "total_real_volume_mb", "real_duration_minutes", "total_charged_volume_mb",
                   "charged_duration_minutes", "total_charges_local_currency", "iot_rate", "iot_call_year_month",
                   "estimated_revenue")
OUTBOUND_COLUMNS = tuple(c for c in INBOUND_COLUMNS if c not in ("number_of_calls", "estimated_revenue")) + (
    "estimated_cost",)
OUTBOUND_KEYS = ("call_date", "call_month", "call_year", "my_pmn_tadig_code", "my_operator_name", "their_country_name",
                 "their_pmn_tadig_code", "serving_country_name", "serving_network", "subscriber_type", "call_type")
OUTBOUND_MEASURES = ("total_real_volume_mb", "real_duration_minutes", "total_charged_volume_mb",
                     "charged_duration_minutes", "total_charges_local_currency")


def inbound_valued(t: Tables, cfg: ValuedConfig = ValuedConfig(), as_of: dt.date | str | None = None,
                   stage: Stage | None = None) -> DataFrame:
    """Inbound aggregate classified and valued with the rate card (revenue), plus region."""
    df = _valued(t["inbound_aggregate"], t, cfg, as_of, "inbound", stage=stage).select(*INBOUND_COLUMNS)
    return J.lookup(df, t["code_business"], {"their_pmn_tadig_code": "tadig"}, {"region": "region"})


def outbound_valued(t: Tables, cfg: ValuedConfig = ValuedConfig(), as_of: dt.date | str | None = None,
                    stage: Stage | None = None) -> DataFrame:
    """Outbound usage summed, classified and valued (cost), spliced onto frozen history."""
    agg = A.group_sum(t["outbound_usage"], OUTBOUND_KEYS, OUTBOUND_MEASURES)
    live = _valued(agg, t, cfg, as_of, "outbound", dates=t["outbound_usage"], stage=stage).select(*OUTBOUND_COLUMNS)
    hist = t["outbound_history"].withColumn("iot_call_year_month", F.col("iot_call_year_month").cast("bigint"))
    code = F.col("my_pmn_tadig_code")
    # The two live branches (other codes; the frozen code after its history
    # ends) are disjoint and both drop NULL codes, so one predicate selects the
    # same rows and the live rows are built once instead of once per branch.
    keep = (code != cfg.frozen_code) | ((F.col("call_date") > F.lit(cfg.frozen_until)) & (code == cfg.frozen_code))
    out = U.splice(hist.select(*OUTBOUND_COLUMNS), live, keep)
    return J.lookup(out, t["code_business"], {"their_pmn_tadig_code": "tadig"}, {"region": "region"})


# C07 -------------------------------------------------------------------------------
MTD_MEASURES = ("traffic_volume_dst_tadig", "country_traffic", "actual_capture_rate", "target_capture_rate",
                "target_based_outbound_costs", "actual_outbound_costs", "cost_delta", "iot_rate")


def steering_mtd(t: Tables) -> DataFrame:
    """Month-to-date steering with source names back-filled from the business reference."""
    df = J.lookup(t["steering_mtd"], t["code_business"], {"source_tadig": "tadig"},
                  {"__con_operator": "operator_name", "__con_country": "country"})
    blanks = ("discount_period_id", "period_from", "period_to", "discount_model", "commitment_type", "created_by",
              "created_date", "last_updated_by", "last_updated_date", "parent_id", "level_number")
    return df.select(
        "call_date", "call_year_month", "call_type", "source_tadig",
        S.backfill("source_operator_name", "__con_operator", S.initcap).alias("source_operator_name"),
        "source_group_name",
        S.backfill("source_country_name", "__con_country", S.initcap).alias("source_country_name"),
        S.backfill("source_country_name", "__con_country", F.upper).alias("home_country"),
        "destination_tadig", "target_operator_name",
        S.initcap("target_group_name").alias("target_group_name"),
        S.initcap("target_country_name").alias("target_country_name"),
        F.upper("target_country_name").alias("visited_country"),
        *MTD_MEASURES, *[F.lit("").alias(b) for b in blanks], "subscriber_type",
        *[x[0] for x in STEERING_TOTALS], *[x[2] for x in STEERING_TOTALS])


# C08 -------------------------------------------------------------------------------
MONTHLY_COLUMNS = ("count_imsi", "count_data_active", "hmcc", "hmnc", "home_country", "home_operator", "home_tadig",
                   "vmcc", "vmnc", "visited_country", "visited_operator", "visited_tadig", "visited_in_group",
                   "extract_year_month")


def monthly_counts(t: Tables, cfg: MonthlyCountsConfig = MonthlyCountsConfig()) -> DataFrame:
    """The 14 columns of frozen history plus live monthly counts (excluded home codes dropped from live only)."""
    return U.splice(t["monthly_counts_history"].select(*MONTHLY_COLUMNS), t["monthly_counts_live"].select(*MONTHLY_COLUMNS),
                    ~F.col("home_tadig").isin(list(cfg.excluded_home)))


# C09 -------------------------------------------------------------------------------
CONTRACT_PASSTHROUGH = ("risk", "contract_status", "report_status")


def contract_register(t: Tables) -> DataFrame:
    """Contracts with negotiator, fiscal year and people names, minus deleted deals."""
    neg = A.group_max(P.active(t["crm_negotiator"]), ["id", "contract_name", "negotiator_email", "contract_category"],
                      "name", "employee_num")
    neg = neg.select("id", "contract_category", M.name_from_email("negotiator_email").alias("negotiator"))
    sec = P.active(t["crm_contract"])
    df = J.lookup(sec, neg, {"ecas": "id"}, {"negotiator": "negotiator", "contract_category": "contract_category"})
    df = df.withColumn("__start_date", S.parse_crm_date("start_date"))
    df = J.assign_period(df, t["fiscal_year"], "__start_date", "fy_start_date", "fy_end_date", {"fiscal_year": "fy"})
    users = t["crm_user"]
    df = J.lookup(df, users, {"contract_manager": "id"}, {"email_id": "email_id", "__cm_name": "name"})
    df = J.lookup(df, users, {"commercial_manager": "id"}, {"__com_name": "name"})
    df = J.not_in(df, "iot_contract_index", t["crm_deleted_deal"], "deal_index")
    return df.select(
        F.col("name").alias("deal_id"), "contract_name", *CONTRACT_PASSTHROUGH,
        S.parse_crm_date("effective_date").alias("effective_date"), "negotiator", "contract_type", "contract_category",
        "fiscal_year", "lawyer", F.col("__start_date").alias("start_date"), "ecas", "entity_name", "contract_doc_link",
        "contract_document", "amendment_to_be_reported", "amendment_type", "is_split_contract", "main_contract",
        "isr_deal", "discounted_charges_ib_revenue", "discounted_charges_ob_revenue", "contract_manager", "action",
        "email_id", F.col("__cm_name").alias("name"), "contract_complexity",
        F.col("__com_name").alias("commercial_manager"))


# C10 -------------------------------------------------------------------------------
def traffic_deviation(t: Tables, cfg: DeviationConfig = DeviationConfig()) -> DataFrame:
    """Daily traffic of the last months per pair and class, tap rate and unique roamers."""
    def recent(df: DataFrame) -> DataFrame:
        # A scalar subquery: no job while the plan is built, and at run time the bound
        # reaches the Parquet scan, so row groups outside the last months are skipped.
        df = df.where(F.col("call_date") >= M.month_floor(df, months=cfg.months_back).scalar())
        df = P.filter_in(df, "call_type", cfg.call_types)
        df = df.withColumn("subscriber_type", M.subscriber_class(cfg))
        return df.withColumn("my_pmn_tadig_code", M.split_code(cfg))

    usage = recent(t["outbound_usage"])
    t03 = A.group_sum(usage, ["call_date", "call_type", "my_pmn_tadig_code", "their_pmn_tadig_code",
                              "their_country_name", "my_country_name", "subscriber_type"],
                      ["number_of_calls", "real_duration_minutes", "total_real_volume_mb", "total_charges_sdr"])
    roamers = A.group_sum(recent(t["unique_roamers_daily"]),
                          ["call_date", "my_pmn_tadig_code", "their_pmn_tadig_code", "call_type", "subscriber_type"],
                          ["number_of_unique_roamers"])
    keys = ["call_date", "my_pmn_tadig_code", "their_pmn_tadig_code", "call_type", "subscriber_type"]
    df = J.left_join(t03, roamers, {k: k for k in keys}, {"number_of_unique_roamers": "number_of_unique_roamers"})
    df = df.withColumn("tap_rate_sdr", M.tap_rate())
    biz = t["code_business"]
    df = J.lookup(df, biz, {"my_pmn_tadig_code": "tadig"}, {"home_operator": "operator_name"})
    df = J.lookup(df, biz, {"their_pmn_tadig_code": "tadig"}, {"visited_operator": "operator_name"})
    return df.select("call_date", "call_type", "my_pmn_tadig_code", "home_operator", "my_country_name",
                     "their_pmn_tadig_code", "visited_operator", "their_country_name",
                     M.traffic_type("deviation", cfg=cfg).alias("traffic_type"), "subscriber_type", "number_of_calls",
                     "real_duration_minutes", "total_real_volume_mb", "total_charges_sdr", "tap_rate_sdr",
                     "number_of_unique_roamers")


# C11 - C13 ---------------------------------------------------------------------------
PRICE_ALERT_COLUMNS = ("my_pmn_tadig_code", "their_pmn_tadig_code", "call_type", "total_charged_volume_mb",
                       "total_charges_sdr", "total_charges_eur", "total_charges_eur_30", "call_date", "call_date_30",
                       "iot_rate_eur", "iot_rate_eur_30", "percentage")
ROLLING_ALERT_COLUMNS = ("call_date", "my_pmn_tadig_code", "their_pmn_tadig_code", "total_charged_volume_mb",
                         "total_charges_eur", "rolling_avg")
PRICE_ALERT_KEYS = ("call_date", "call_date_30", "my_pmn_tadig_code", "their_pmn_tadig_code", "call_type")
ROLLING_ALERT_KEYS = ("call_date", "my_pmn_tadig_code", "their_pmn_tadig_code")


def price_changes(usage: DataFrame, fx: DataFrame, cfg: AlertConfig, as_of, stage=None) -> DataFrame:
    """Shared alert stages: daily sums, EUR conversion, month-on-month change.

    Both sides of the month-on-month join come from the same daily table
    (days x pairs rows).  ``stage(df, name) -> DataFrame`` writes it once, so
    the usage table is scanned once per run instead of once per side.
    """
    base = M.alert_base(usage, cfg, as_of)
    eur = M.to_currency(base, fx, cfg.currency)
    if stage is not None:
        eur = stage(eur, "alert_daily_eur")
    return M.price_change(eur, report_from=F.date_sub(S.as_of_date(as_of), cfg.report_days))


def empty_ledger(spark, columns: tuple[str, ...], like: DataFrame) -> DataFrame:
    types = dict(like.dtypes)
    return spark.createDataFrame([], ", ".join(f"`{c}` {types[c]}" for c in columns) + ", latest_flag string")


def price_alert(t: Tables, prev: DataFrame | None, cfg: AlertConfig = AlertConfig(), as_of=None,
                usage: str = "inbound_usage", stage=None) -> DataFrame:
    """Month-on-month price alert ledger: new alerts '1' plus the previous ledger '0'."""
    chg = price_changes(t[usage], t["fx_rates"], cfg, as_of, stage)
    alerts = P.alert_filter(chg, cfg.pct_threshold, cfg.unit_price_threshold, cfg.charge_threshold,
                            cfg.volume_threshold).select(*PRICE_ALERT_COLUMNS)
    if prev is None:
        prev = empty_ledger(alerts.sparkSession, PRICE_ALERT_COLUMNS, alerts)
    return U.merge_ledger(alerts, prev.select(*PRICE_ALERT_COLUMNS, "latest_flag"), PRICE_ALERT_KEYS, null_safe=cfg.null_safe)


def rolling_alert(t: Tables, prev: DataFrame | None, cfg: AlertConfig = AlertConfig(), as_of=None,
                  direction: str = "inbound", stage=None) -> DataFrame:
    """7-row rolling-average alert ledger for inbound or outbound usage."""
    usage = t["inbound_usage" if direction == "inbound" else "outbound_usage"]
    chg = price_changes(usage, t["fx_rates"], cfg, as_of, stage)
    keys = ["my_pmn_tadig_code", "their_pmn_tadig_code"]
    rolled = A.rolling_avg(chg, keys, "call_date", "total_charges_eur", "rolling_avg", cfg.rolling_rows - 1)
    alerts = rolled.where(F.col("rolling_avg") > cfg.rolling_threshold)
    if direction == "outbound":
        alerts = P.lookback(alerts, "call_date", as_of, cfg.report_days)
    alerts = alerts.select(*ROLLING_ALERT_COLUMNS)
    if prev is None:
        prev = empty_ledger(alerts.sparkSession, ROLLING_ALERT_COLUMNS, alerts)
    return U.merge_ledger(alerts, prev.select(*ROLLING_ALERT_COLUMNS, "latest_flag"),
                          ROLLING_ALERT_KEYS, null_safe=cfg.null_safe)
