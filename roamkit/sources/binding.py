"""Telecom-shaped input tables derived from the driver's TPC-H-like tables.

The report builds read roaming inputs (usage, rate cards, CRM records ...).
The test data is a TPC-H-like star schema, so each input is *derived* from it
by one SQL text written in the subset both Spark and DuckDB understand.  Spark
runs the text once per data set, when a query first asks for the table, and
writes the result as Parquet under the shared checkpoint folder
(``spark.checkpoint.dir``); every report then reads those tables, so its work
grows with the source tables.  The DuckDB oracle inlines the same texts as CTEs,
which gives both engines identical inputs.  Only the joins of line items with
their dimensions are written otherwise for Spark: once, for all that read them.

Mapping (one row per line item unless stated):
  usage            lineitem x orders x customer/nation/region x supplier/nation/region;
                   inbound: home = supplier region, partner = customer region;
                   outbound: the roles swapped.  Codes are region names.
  fx_rates         one validity window per order month, EUR and USD.
  rate_card        unit price per (partner, home, call type, month) in quarter-end
                   ("Actual") and quarter-start ("Budget") months only, so exact
                   matches miss often and the fallback rate is exercised.
  capture_rate_performance  outbound traffic shares per month, type, home, partner.
  CRM tables       orders / suppliers / customers re-read as contracts, assets,
                   footprint services (one per order, from all its lines),
                   negotiators and users.
  landing / audit / dag_run  ``events`` by day and event type.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamkit.operators.joins import bounded_broadcast
from roamkit.session import checkpoint_dir

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

#: Line items joined with their order, customer and supplier: written once by Spark, read by the usage tables.
LINES = "line_rows"

#: Bytes of source files for each shuffle partition while inputs are written.
_PARTITION_BYTES = 16 << 20


@dataclass(frozen=True)
class Dialect:
    name: str

    def t(self, table: str) -> str:
        """A table reference."""
        return "{" + table + "}" if self.name == "spark" else table

    def line_aliases(self) -> tuple[str, str, str]:
        """Aliases under which ``lines`` has the columns of orders, customer and supplier."""
        return ("l", "l", "l") if self.name == "spark" else ("o", "c", "s")

    def lines(self) -> str:
        """The line items with both sides' nations and regions; Spark reads the joined rows that it wrote (``_line_rows``)."""
        source, (_, c, s) = self.t("lineitem"), self.line_aliases()
        joins = f"""
join {self.t('orders')} o on l.l_orderkey = o.o_orderkey
join {self.t('customer')} c on o.o_custkey = c.c_custkey"""
        supplier = f"\njoin {self.t('supplier')} s on l.l_suppkey = s.s_suppkey"
        if self.name == "spark":
            source, joins, supplier = self.t(LINES), "", ""
        return f"""from {source} l{joins}
join {self.t('nation')} nc on {c}.c_nationkey = nc.n_nationkey
join {self.t('region')} rc on nc.n_regionkey = rc.r_regionkey{supplier}
join {self.t('nation')} ns on {s}.s_nationkey = ns.n_nationkey
join {self.t('region')} rs on ns.n_regionkey = rs.r_regionkey"""

    def fmt(self, x: str, spark_pattern: str, duck_pattern: str) -> str:
        if self.name == "spark":
            return f"date_format({x}, '{spark_pattern}')"
        return f"strftime({x}, '{duck_pattern}')"

    def crm(self, x: str) -> str:
        """CRM timestamp text, e.g. ``Tue Mar 01 00:00:00 GMT 2022``."""
        return f"{self.fmt(x, 'EEE MMM dd', '%a %b %d')} || ' 00:00:00 GMT ' || cast(year({x}) as string)"

    def crm_padded(self, x: str) -> str:
        """The same with a space-padded day: ``Tue Mar  1 00:00:00 GMT 2022``."""
        return (f"{self.fmt(x, 'EEE MMM', '%a %b')} || ' ' || lpad(cast(day({x}) as string), 2, ' ')"
                f" || ' 00:00:00 GMT ' || cast(year({x}) as string)")

    def ts_text(self, x: str) -> str:
        return self.fmt(x, "yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S")


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


def _money(x: str) -> str:
    """Order-independent sum of a double measure."""
    return f"cast(sum(cast({x} as decimal(38,6))) as double)"


def _usage(d: Dialect, outbound: bool) -> str:
    # home side / partner side aliases
    h, p = ("c", "s") if outbound else ("s", "c")
    hn, pn = ("nc", "ns") if outbound else ("ns", "nc")
    hr, pr = ("rc", "rs") if outbound else ("rs", "rc")
    home_country = f"lower({hr}.r_name) || '-land'"
    partner_country = f"lower({pr}.r_name) || '-land'"
    o, c, sup = d.line_aliases()
    return f"""
select cast({o}.o_orderdate as date) as call_date,
       cast(year({o}.o_orderdate) * 100 + month({o}.o_orderdate) as bigint) as call_month,
       cast(year({o}.o_orderdate) as bigint) as call_year,
       {hr}.r_name as my_pmn_tadig_code,
       'op ' || lower({hr}.r_name) as my_operator_name,
       {home_country} as my_country_name,
       {pr}.r_name as their_pmn_tadig_code,
       case when {o}.o_orderpriority = '5-LOW' then '' else 'op ' || lower({pr}.r_name) end as their_operator_name,
       'op ' || lower({pr}.r_name) as their_primary_operator_name,
       {partner_country} as their_country_name,
       case when l.l_linestatus = 'F' then {partner_country} else {home_country} end as serving_country_name,
       {sup}.s_name as serving_network,
       case {c}.c_mktsegment when 'MACHINERY' then 'NLM2M' when 'BUILDING' then 'xIOTy'
            when 'AUTOMOBILE' then 'postpaid' when 'FURNITURE' then 'prepaid' else 'M2M' end as subscriber_type,
       case when l.l_returnflag = 'N' then 'GPRS'
            when l.l_returnflag = 'A' and l.l_linestatus = 'F' then 'MOC'
            when l.l_returnflag = 'A' then 'MTC'
            when l.l_linestatus = 'F' then 'SMS-MO' else 'SMS-MT' end as call_type,
       cast(l.l_linenumber as bigint) as number_of_calls,
       l.l_quantity as total_real_volume_mb,
       l.l_quantity as total_charged_volume_mb,
       l.l_quantity * 1.5 as real_duration_minutes,
       l.l_quantity * 2.0 as charged_duration_minutes,
       l.l_extendedprice * (1 - l.l_discount) as total_charges_sdr,
       l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) as total_charges_local_currency,
       {o}.o_custkey as subscriber_key
{d.lines()}"""


def _inbound_aggregate(d: Dialect) -> str:
    return f"""
select call_date, call_month, call_year, my_pmn_tadig_code, my_operator_name, their_pmn_tadig_code,
       their_country_name, serving_country_name, serving_network, subscriber_type, call_type,
       cast(sum(number_of_calls) as bigint) as number_of_calls,
       {_money('total_real_volume_mb')} as total_real_volume_mb,
       {_money('real_duration_minutes')} as real_duration_minutes,
       {_money('total_charged_volume_mb')} as total_charged_volume_mb,
       {_money('charged_duration_minutes')} as charged_duration_minutes,
       {_money('total_charges_local_currency')} as total_charges_local_currency
from {d.t('inbound_usage')}
group by call_date, call_month, call_year, my_pmn_tadig_code, my_operator_name, their_pmn_tadig_code,
         their_country_name, serving_country_name, serving_network, subscriber_type, call_type"""


def _unique_roamers(d: Dialect) -> str:
    return f"""
select call_date, my_pmn_tadig_code, their_pmn_tadig_code, call_type, subscriber_type,
       count(distinct subscriber_key) as number_of_unique_roamers
from {d.t('outbound_usage')}
group by call_date, my_pmn_tadig_code, their_pmn_tadig_code, call_type, subscriber_type"""


def _fx(d: Dialect) -> str:
    months = f"(select distinct cast(date_trunc('month', o_orderdate) as date) as m from {d.t('orders')})"
    return f"""
select 'EUR' as currency_code, m as effective_date, last_day(m) as end_date,
       cast(100 + month(m) as double) / cast(100 as double) as sdr_to_local_currency_exchange_rate
from {months} eur
union all
select 'USD' as currency_code, m as effective_date, last_day(m) as end_date,
       cast(200 + month(m) as double) / cast(100 as double) as sdr_to_local_currency_exchange_rate
from {months} usd"""


def _rate_card(d: Dialect) -> str:
    return f"""
select dst_tadig, src_tadig, call_year_month, call_type, traffic_type,
       case when call_type = 'SMS-MT' then cast(null as double) else unit_price end as curr_in_final_iot,
       case when call_type = 'SMS-MT' then cast(null as double) else unit_price * 0.8 end as curr_out_final_iot
from (
  select their_pmn_tadig_code as dst_tadig, my_pmn_tadig_code as src_tadig,
         cast(call_month as string) as call_year_month, call_type,
         case when month(call_date) in (3, 6, 9, 12) then 'Actual' when month(call_date) in (1, 4, 7, 10) then 'Budget' else 'Forecast' end as traffic_type,
         {_money('total_charges_sdr')} / {_money('total_charged_volume_mb')} as unit_price
  from {d.t('inbound_usage')}
  group by their_pmn_tadig_code, my_pmn_tadig_code, call_month, call_type,
           case when month(call_date) in (3, 6, 9, 12) then 'Actual' when month(call_date) in (1, 4, 7, 10) then 'Budget' else 'Forecast' end
) r"""


def _capture(d: Dialect) -> str:
    return f"""
select cast(call_month as string) || '-' || call_type || '-' || src || '-' || dst as capture_rate_performance_id,
       cast(call_month as string) as call_year_month, call_type, src as src_tadig, dst as dst_tadig,
       lower(dst) || ' land' as country_description,
       cast(traffic as double) as traffic_volume_dst_tadig,
       cast(country_traffic as double) as country_traffic,
       cast(traffic as double) / cast(country_traffic as double) as actual_capture_rate,
       case when dst = 'AFRICA' then 0.0e0 when dst = 'AMERICA' and call_type = 'MTC' then cast(null as double)
            else floor(cast(traffic as double) / cast(country_traffic as double) * 10) / 10 end as target_capture_rate,
       cast(traffic as double) * 1.5 as target_based_outbound_costs,
       cast(traffic as double) * 2.0 as actual_outbound_costs,
       'DP' || cast(call_month as string) as discount_period_id,
       cast(call_month as string) || '01' as period_from,
       cast(call_month as string) || '28' as period_to,
       'flat' as discount_model, 'volume' as commitment_type, 'system' as created_by,
       cast(call_month as string) as created_date, 'system' as last_updated_by,
       cast(call_month as string) as last_updated_date, src as parent_id, '1' as level_number
from (
  select call_month, call_type, src, dst, traffic,
         sum(traffic) over (partition by call_month, call_type, src) as country_traffic
  from (
    select call_month, call_type, my_pmn_tadig_code as src, their_pmn_tadig_code as dst,
           sum(cast(total_real_volume_mb as decimal(38,6))) as traffic
    from {d.t('outbound_usage')} group by call_month, call_type, my_pmn_tadig_code, their_pmn_tadig_code
    union all
    select call_month, 'TOTAL' as call_type, my_pmn_tadig_code as src, their_pmn_tadig_code as dst,
           sum(cast(total_real_volume_mb as decimal(38,6))) as traffic
    from {d.t('outbound_usage')} group by call_month, my_pmn_tadig_code, their_pmn_tadig_code
  ) g
) w"""


def _operator(d: Dialect) -> str:
    return f"""
select n_name as tap_code, 'abs ' || lower(n_name) as operator_name, cast(n_nationkey as bigint) as fk_country_id
from {d.t('nation')}
union all
select r_name as tap_code, 'abs ' || lower(r_name) as operator_name, cast(r_regionkey + 100 as bigint) as fk_country_id
from {d.t('region')}"""


def _country(d: Dialect) -> str:
    return f"""
select cast(n_nationkey as bigint) as country_id, lower(n_name) || ' country' as country_description
from {d.t('nation')}"""


def _crm_account(d: Dialect) -> str:
    return f"""
select r.r_name as tadig_code, r.r_name as country_region, lower(n.n_name) as country,
       'sfc ' || lower(n.n_name) as name, 'net-' || lower(n.n_name) as network_name,
       case when n.n_nationkey < 5 then 1 else 0 end as bdp_active_flag
from {d.t('nation')} n join {d.t('region')} r on n.n_regionkey = r.r_regionkey"""


def _code_region(d: Dialect) -> str:
    return f"""
select case when r_regionkey = 2 then r_name || ' ' else r_name end as tadig,
       'op ' || lower(r_name) as operator_name, 'group ' || lower(r_name) as group_name,
       lower(r_name) || '-land' as country_name, r_name as region_name
from {d.t('region')}"""


def _code_business(d: Dialect) -> str:
    return f"""
select r_name as tadig, 'biz ' || lower(r_name) as operator_name,
       lower(r_name) || ' land' as country,
       case when r_regionkey in (1) then 'AMER' when r_regionkey in (2) then 'APAC' else 'EMEA' end as region,
       case r_regionkey when 0 then 'IOT' when 1 then 'other' when 2 then 'isr' when 3 then 'IOT' else 'm2m' end as traffic_type,
       case when r_regionkey in (0, 3) then true when r_regionkey = 4 then cast(null as boolean) else false end as intragroup_eligible
from {d.t('region')}"""


def _footprint(d: Dialect) -> str:
    return f"""
select 'SO-' || cast(l.l_orderkey as string) as name,
       rc.r_name as hplmn_operator_tadig,
       case when rs.r_regionkey = 2 then ' ' || rs.r_name else rs.r_name end as vplmn_operator_tadig,
       case when l.l_linestatus = 'F' then 'Voice' else 'Data' end as product,
       case l.l_returnflag when 'A' then 'Bilateral' when 'N' then 'Inbound' else cast(null as string) end as relationship_direction,
       case o.o_orderpriority when '1-URGENT' then 'Live' when '2-HIGH' then 'CLL' when '3-MEDIUM' then 'Hold'
            when '4-NOT SPECIFIED' then 'NA' else 'Pretest' end as status,
       o.o_orderstatus as so_type,
       c.c_mktsegment as hp_contract_type,
       'standard' as vp_contract_type,
       case when o.o_orderpriority = '1-URGENT' then cast(null as string) else {d.crm('o.o_orderdate')} end as cll_date,
       {d.crm_padded('l.l_shipdate')} as commercial_migration_date,
       case when o.o_orderpriority = '2-HIGH' then {d.crm('o.o_orderdate')} else cast(null as string) end as open_date_formula,
       'A' || cast(l.l_suppkey as string) as vplmn_asset_service,
       'C' || cast(o.o_custkey as string) as hplmn_account_asset_service,
       case when o.o_orderstatus = 'P' and l.l_linestatus = 'O' then 0 else 1 end as bdp_active_flag
from (select l_orderkey, min(l_suppkey) as l_suppkey, max(l_shipdate) as l_shipdate,
             min(l_returnflag) as l_returnflag, max(l_linestatus) as l_linestatus
      from {d.t('lineitem')} group by l_orderkey) l
join {d.t('orders')} o on l.l_orderkey = o.o_orderkey
join {d.t('customer')} c on o.o_custkey = c.c_custkey
join {d.t('nation')} nc on c.c_nationkey = nc.n_nationkey
join {d.t('region')} rc on nc.n_regionkey = rc.r_regionkey
join {d.t('supplier')} s on l.l_suppkey = s.s_suppkey
join {d.t('nation')} ns on s.s_nationkey = ns.n_nationkey
join {d.t('region')} rs on ns.n_regionkey = rs.r_regionkey"""


def _asset(d: Dialect) -> str:
    return f"""
select 'A' || cast(s_suppkey as string) as id,
       case when s_acctbal < 0 then {d.crm_padded("make_date(2002, 1 + cast(floor(s_nationkey / 5) as int), 1 + s_nationkey)")}
            else cast(null as string) end as shutdown_date,
       case when s_acctbal < -900 then 0 else 1 end as bdp_active_flag
from {d.t('supplier')}
union all
select 'C' || cast(c_custkey as string) as id,
       case when c_acctbal < 0 then {d.crm("make_date(2003, 1 + cast(floor(c_nationkey / 5) as int), 2 + c_nationkey)")}
            else cast(null as string) end as shutdown_date,
       case when c_acctbal < -950 then 0 else 1 end as bdp_active_flag
from {d.t('customer')}"""


def _extended_coverage(d: Dialect) -> str:
    return f"""
select 'EC-' || cast(s.s_suppkey as string) as id,
       case when s.s_acctbal > 5000 then 'Data' else 'Voice' end as asset,
       lower(n.n_name) as country, 'Outbound' as direction,
       case when s.s_acctbal > 9000 then 'true' else 'false' end as is_main_operator,
       case when s.s_acctbal >= 0 then 'EUROPE' else 'AMERICA' end as lm_operator_tadig,
       'lm ' || lower(r.r_name) as lm_operator, s.s_name as operator_name,
       case n.n_nationkey when 0 then 'NA' when 1 then 'Not Started' when 2 then '0' when 3 then 'CLL'
            when 4 then 'FD' when 5 then 'Impl' when 6 then 'Leg HP Done' when 7 then 'Pretest'
            when 8 then 'Hold' when 9 then 'Awaiting' when 10 then 'Live' when 11 then 'Frozen'
            when 12 then cast(null as string) else 'Live' end as status,
       case when r.r_regionkey = 2 then r.r_name || ' ' else r.r_name end as tadig,
       case when s.s_acctbal < -990 then 0 else 1 end as bdp_active_flag
from {d.t('supplier')} s join {d.t('nation')} n on s.s_nationkey = n.n_nationkey
join {d.t('region')} r on n.n_regionkey = r.r_regionkey"""


def _negotiator(d: Dialect) -> str:
    return f"""
select 'E' || cast(s_suppkey as string) as id,
       'contract ' || cast(s_suppkey as string) as contract_name,
       case when s_acctbal > 9000 then cast(null as string)
            when s_acctbal < 0 then lower(replace(s_name, '#', '')) || '@example.com'
            else lower(replace(s_name, '#', '.')) || '@example.com' end as negotiator_email,
       case when s_acctbal > 5000 then 'Roaming' else 'Wholesale' end as contract_category,
       'EMP' || cast(s_nationkey as string) as name,
       case when s_acctbal < -980 then 0 else 1 end as bdp_active_flag
from {d.t('supplier')}
union all
select 'E' || cast(s_suppkey as string) as id,
       'contract ' || cast(s_suppkey as string) as contract_name,
       case when s_acctbal > 9000 then cast(null as string)
            when s_acctbal < 0 then lower(replace(s_name, '#', '')) || '@example.com'
            else lower(replace(s_name, '#', '.')) || '@example.com' end as negotiator_email,
       case when s_acctbal > 5000 then 'Roaming' else 'Wholesale' end as contract_category,
       'EMP' || cast(s_suppkey as string) as name,
       1 as bdp_active_flag
from {d.t('supplier')}"""


def _contract(d: Dialect) -> str:
    return f"""
select 'K' || cast(o_orderkey as string) as id,
       'DEAL-' || cast(o_orderkey as string) as name,
       'contract ' || cast(o_custkey as string) as contract_name,
       case when o_totalprice > 300000 then 'High' else 'Low' end as risk,
       o_orderstatus as contract_status, o_orderpriority as report_status,
       {d.crm('o_orderdate')} as effective_date,
       case when o_orderstatus = 'F' then 'Bilateral' else 'Unilateral' end as contract_type,
       'lawyer ' || cast(o_custkey as string) as lawyer,
       {d.crm_padded('o_orderdate')} as start_date,
       'E' || cast(o_custkey as string) as ecas,
       'entity ' || cast(o_custkey as string) as entity_name,
       'http://docs/' || cast(o_orderkey as string) as contract_doc_link,
       'doc-' || cast(o_orderkey as string) as contract_document,
       'No' as amendment_to_be_reported, 'None' as amendment_type, 'false' as is_split_contract,
       'main' as main_contract, 'false' as isr_deal,
       cast(o_totalprice as string) as discounted_charges_ib_revenue,
       cast(o_totalprice as string) as discounted_charges_ob_revenue,
       'U' || cast(o_custkey as string) as contract_manager, 'review' as action,
       'IDX' || cast(o_custkey as string) as iot_contract_index,
       case when o_totalprice > 200000 then 'Complex' else 'Simple' end as contract_complexity,
       'U' || cast(o_custkey + 1 as string) as commercial_manager,
       'party ' || cast(o_custkey as string) as second_contract_party,
       case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 0 else 1 end as bdp_active_flag
from {d.t('orders')}"""


def _deleted_deal(d: Dialect) -> str:
    return f"""
select 'IDX' || cast(c_custkey as string) as deal_index from {d.t('customer')} where c_acctbal < 0"""


def _fiscal_year(d: Dialect) -> str:
    return f"""
select 'FY' || cast(y + 1 as string) as fy, make_date(y, 4, 1) as fy_start_date, make_date(y + 1, 3, 31) as fy_end_date
from (select distinct cast(year(o_orderdate) as int) - 1 as y from {d.t('orders')}
      union select distinct cast(year(o_orderdate) as int) as y from {d.t('orders')}) years"""


def _crm_user(d: Dialect) -> str:
    return f"""
select 'U' || cast(c_custkey as string) as id, lower(replace(c_name, '#', '.')) || '@example.com' as email_id,
       c_name as name
from {d.t('customer')}"""


def _outbound_history(d: Dialect) -> str:
    return f"""
select call_date, call_month, call_year, my_pmn_tadig_code, lower(my_pmn_tadig_code) as my_pmn_country,
       my_operator_name, their_pmn_tadig_code, their_country_name as their_pmn_country,
       'No' as intragroup, 'IOT' as traffic_type, 'N' as last_28_days,
       serving_country_name, serving_network, subscriber_type, call_type,
       total_real_volume_mb, real_duration_minutes, total_charged_volume_mb, charged_duration_minutes,
       total_charges_local_currency, cast(null as double) as iot_rate,
       cast(call_month as string) as iot_call_year_month, 0.0e0 as estimated_cost
from {d.t('outbound_usage')}
where my_pmn_tadig_code = 'EUROPE' and call_date <= date '1998-08-02'"""


def _steering_mtd(d: Dialect) -> str:
    return f"""
select call_date, cast(call_month as string) as call_year_month, call_type,
       my_pmn_tadig_code as source_tadig,
       case when my_pmn_tadig_code = 'ASIA' then cast(null as string) else 'src ' || lower(my_operator_name) end as source_operator_name,
       'group ' || lower(my_pmn_tadig_code) as source_group_name,
       case when my_pmn_tadig_code = 'AMERICA' then cast(null as string) else my_country_name end as source_country_name,
       their_pmn_tadig_code as destination_tadig, their_operator_name as target_operator_name,
       'group ' || lower(their_pmn_tadig_code) as target_group_name, their_country_name as target_country_name,
       subscriber_type,
       total_real_volume_mb as traffic_volume_dst_tadig, total_charged_volume_mb as country_traffic,
       0.5e0 as actual_capture_rate, 0.25e0 as target_capture_rate,
       total_charges_sdr as target_based_outbound_costs, total_charges_local_currency as actual_outbound_costs,
       total_charges_sdr - total_charges_local_currency as cost_delta, 0.8e0 as iot_rate,
       total_charges_sdr as total_target_country_cost_delta, total_charges_sdr as total_source_country_cost_delta,
       total_charges_sdr as total_call_type_cost_delta, total_charges_sdr as total_source_tadig_cost_delta,
       total_charges_sdr as total_dest_tadig_cost_delta,
       number_of_calls as total_target_country_rank, number_of_calls as total_source_country_rank,
       number_of_calls as total_call_type_rank, number_of_calls as total_source_tadig_rank,
       number_of_calls as total_dest_tadig_rank
from {d.t('outbound_usage')}"""


def _monthly_counts(d: Dialect, live: bool) -> str:
    o, _, _ = d.line_aliases()
    cond = f"{o}.o_orderdate >= timestamp '2000-01-01 00:00:00'" if live else f"{o}.o_orderdate < timestamp '2000-01-01 00:00:00'"
    return f"""
select cast(count(distinct {o}.o_custkey) as bigint) as count_imsi, cast(count(*) as bigint) as count_data_active,
       cast(nc.n_nationkey as string) as hmcc, cast(rc.r_regionkey as string) as hmnc,
       lower(nc.n_name) as home_country, 'op ' || lower(nc.n_name) as home_operator, rc.r_name as home_tadig,
       cast(ns.n_nationkey as string) as vmcc, cast(rs.r_regionkey as string) as vmnc,
       lower(ns.n_name) as visited_country, 'op ' || lower(ns.n_name) as visited_operator, rs.r_name as visited_tadig,
       case when rs.r_regionkey = 3 then 'Y' else 'N' end as visited_in_group,
       cast(year({o}.o_orderdate) * 100 + month({o}.o_orderdate) as string) as extract_year_month
{d.lines()}
where {cond}
group by nc.n_nationkey, rc.r_regionkey, nc.n_name, rc.r_name, ns.n_nationkey, rs.r_regionkey, ns.n_name, rs.r_name,
         year({o}.o_orderdate) * 100 + month({o}.o_orderdate)"""


def _landing(d: Dialect) -> str:
    return f"""
select event_type as source_table_name, cast(ts as date) as partition_year_month_day,
       event_id, user_id, value, props
from {d.t('events')}"""


def _load_audit(d: Dialect) -> str:
    return f"""
select source_table_name as SOURCE_TABLE_NAME, 'staging_load' as DAG_NAME,
       'scheduled__' || cast(partition_year_month_day as string) || 'T23:00:00+00:00' as DAG_RUN_ID,
       'job_' || source_table_name as SCRIPT_LOG,
       cast(partition_year_month_day as string) || ' 23:00:00' as START_DATE_TIME,
       cast(partition_year_month_day as string) || ' 23:30:00' as END_DATE_TIME,
       'staging.' || source_table_name as TARGET_TABLE_NAME,
       n as SOURCE_COUNT, n as TARGET_COUNT, 'success' as STATUS,
       'Data is successfully loaded in staging' as LOGS,
       cast(partition_year_month_day as string) as PARTITION_VAL
from (
  select source_table_name, partition_year_month_day, cast(count(*) as bigint) as n,
         max(partition_year_month_day) over (partition by source_table_name) as last_day
  from {d.t('landing')} group by source_table_name, partition_year_month_day
) a
where partition_year_month_day < last_day"""


def _dag_run(d: Dialect) -> str:
    return f"""
select 'load_' || event_type as dag_id,
       case when value < 20 then 'build' when value < 60 then 'publish' else 'audit' end as task_id,
       {d.fmt('ts', 'yyyy-MM-dd HH:mm:ss.SSSSSS', '%Y-%m-%d %H:%M:%S.%f')} || '+00:00' as execution_date,
       {d.ts_text('ts')} as start_date,
       {d.ts_text('ts')} as end_date,
       case when value < 3 then 'failed' when value < 6 then 'running' when value < 8 then 'queued' else 'success' end as state
from {d.t('events')}
union all
select 'staging_load' as dag_id, case when value < 10 then 'do_not_load_' else 'load_data_' end || event_type as task_id,
       cast(cast(ts as date) as string) || ' 23:00:00+00:00' as execution_date,
       {d.ts_text('min(ts)')} as start_date, {d.ts_text('max(ts)')} as end_date, 'success' as state
from {d.t('events')} group by event_type, cast(ts as date), case when value < 10 then 'do_not_load_' else 'load_data_' end"""


# name -> (builder, dependencies)
BINDING: dict[str, tuple] = {
    "inbound_usage": (lambda d: _usage(d, outbound=False), RAW_TABLES),
    "outbound_usage": (lambda d: _usage(d, outbound=True), RAW_TABLES),
    "inbound_aggregate": (_inbound_aggregate, ("inbound_usage",)),
    "unique_roamers_daily": (_unique_roamers, ("outbound_usage",)),
    "fx_rates": (_fx, ("orders",)),
    "rate_card": (_rate_card, ("inbound_usage",)),
    "capture_rate_performance": (_capture, ("outbound_usage",)),
    "operator": (_operator, ("nation", "region")),
    "country": (_country, ("nation",)),
    "crm_account": (_crm_account, ("nation", "region")),
    "code_region": (_code_region, ("region",)),
    "code_business": (_code_business, ("region",)),
    "crm_footprint_service": (_footprint, RAW_TABLES),
    "crm_asset": (_asset, ("supplier", "customer")),
    "crm_extended_coverage": (_extended_coverage, ("supplier", "nation", "region")),
    "crm_negotiator": (_negotiator, ("supplier",)),
    "crm_contract": (_contract, ("orders",)),
    "crm_deleted_deal": (_deleted_deal, ("customer",)),
    "fiscal_year": (_fiscal_year, ("orders",)),
    "crm_user": (_crm_user, ("customer",)),
    "outbound_history": (_outbound_history, ("outbound_usage",)),
    "steering_mtd": (_steering_mtd, ("outbound_usage",)),
    "monthly_counts_history": (lambda d: _monthly_counts(d, live=False), RAW_TABLES),
    "monthly_counts_live": (lambda d: _monthly_counts(d, live=True), RAW_TABLES),
    "landing": (_landing, ("events",)),
    "load_audit": (_load_audit, ("landing",)),
    "dag_run": (_dag_run, ("events",)),
}

# Aggregates by date are sorted within their files, so that Parquet's page statistics let date
# predicates skip most of them; the usage tables keep the date order of the line rows.
_DATE_SORTED = {"inbound_aggregate": "call_date", "unique_roamers_daily": "call_date"}
_PARTITIONED = {"landing": "partition_year_month_day"}


def closure(names) -> list[str]:
    """Binding tables needed for ``names``, dependencies first."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in RAW_TABLES or n in out:
            return
        for dep in BINDING[n][1]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def duck_ctes(names) -> list[str]:
    """``name as (sql)`` CTE items for DuckDB, dependencies first."""
    return [f"{n} as ({BINDING[n][0](DUCK)})" for n in closure(names)]


def _fingerprint(sf_dir: str) -> str:
    h = hashlib.sha1(open(__file__, "rb").read())
    for t in RAW_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        st = os.stat(p)
        h.update(f"{os.path.realpath(p)}:{st.st_size}:{int(st.st_mtime)}".encode())
    return h.hexdigest()[:16]


_lock = threading.RLock()
_memo: dict[tuple[str, str], Inputs] = {}


class Inputs(Mapping):
    """Source and binding tables of one data set; a binding table is written when it is first asked for, with what it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir
        self._root = f"{checkpoint_dir(spark)}/roamkit_inputs/{_fingerprint(sf_dir)}"
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        """Where the binding table ``name`` is kept (written if it was not)."""
        self[name]
        return f"{self._root}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        with _lock:
            if name not in self._frames:
                if name in RAW_TABLES:
                    self._frames[name] = self._spark.read.parquet(os.path.join(self._dir, f"{name}.parquet"))
                elif name == LINES or name in BINDING:
                    self._frames[name] = self._written(name)
                else:
                    raise KeyError(name)
            return self._frames[name]

    def __contains__(self, name: object) -> bool:
        return name in RAW_TABLES or name in BINDING

    def __iter__(self):
        return iter([*RAW_TABLES, *closure(BINDING)])

    def __len__(self) -> int:
        return len(RAW_TABLES) + len(BINDING)

    def _written(self, name: str) -> DataFrame:
        path = f"{self._root}/{name}"
        if not _exists(self._spark, f"{path}/_SUCCESS"):
            with _sized_shuffles(self._spark, self._dir):
                df = _line_rows(self) if name == LINES else self._derived(name)
                if name in _DATE_SORTED:
                    df = df.sortWithinPartitions(_DATE_SORTED[name])
                if name in _PARTITIONED:
                    df = df.repartition(_PARTITIONED[name])
                # Write beside the final path and rename: a concurrent or failed
                # writer never leaves a half-written table at ``path``.
                tmp = f"{path}.tmp-{uuid.uuid4().hex}"
                w = df.write.mode("errorifexists")
                if name in _PARTITIONED:
                    w = w.partitionBy(_PARTITIONED[name])
                w.parquet(tmp)
                _rename(self._spark, tmp, path)
        return self._spark.read.parquet(path)

    def _derived(self, name: str) -> DataFrame:
        sql = BINDING[name][0](SPARK)
        read = {field for _, field, _, _ in Formatter().parse(sql) if field}
        return self._spark.sql(sql, **{t: self[t] for t in read})


def _line_rows(t: Mapping[str, DataFrame]) -> DataFrame:
    """Line items with the columns of their order, customer and supplier that the usage tables read, in date order.

    Customers join the orders, so the lines are shuffled once by order and once, still
    without the usage tables' texts, by date: both usage tables keep this order.
    """
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customers = t["customer"].select("c_custkey", "c_nationkey", "c_mktsegment")
    suppliers = bounded_broadcast(t["supplier"].select("s_suppkey", "s_name", "s_nationkey"))
    lines = t["lineitem"].select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                                 "l_tax", "l_returnflag", "l_linestatus")
    orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")
    rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey")
    return rows.repartitionByRange("o_orderdate").sortWithinPartitions("o_orderdate")


@contextmanager
def _sized_shuffles(spark: SparkSession, sf_dir: str):
    """At least one shuffle partition per ``_PARTITION_BYTES`` of source files, so that a task's memory doesn't grow with the input."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    size = sum(_file_bytes(os.path.join(sf_dir, f"{t}.parquet")) for t in RAW_TABLES)
    spark.conf.set(key, str(max(int(before), -(-size // _PARTITION_BYTES))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _file_bytes(path: str) -> int:
    """Size of a file, or of the files in a folder."""
    if os.path.isfile(path):
        return os.stat(path).st_size
    return sum(os.stat(os.path.join(d, f)).st_size for d, _, files in os.walk(path) for f in files)


def lazy_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The binding tables for ``sf_dir``; none is written before it is asked for."""
    key = (spark.sparkContext.applicationId, os.path.realpath(sf_dir))
    with _lock:
        if key not in _memo:
            _memo[key] = Inputs(spark, sf_dir)
        return _memo[key]


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All binding tables for ``sf_dir``, materialised once under the checkpoint folder."""
    return dict(lazy_inputs(spark, sf_dir))


def input_paths(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Where ``inputs`` keeps each derived table (materialising them if needed)."""
    t = lazy_inputs(spark, sf_dir)
    return {name: t.path(name) for name in closure(BINDING)}


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    """Move ``src`` to ``dst``; if another writer got there first, keep theirs."""
    jvm = spark.sparkContext._jvm
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(d) and not fs.exists(jvm.org.apache.hadoop.fs.Path(dst + "/_SUCCESS")):
        fs.delete(d, True)  # leftover of a writer that died before committing
    if not fs.rename(s, d):
        fs.delete(s, True)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
