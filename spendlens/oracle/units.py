"""Oracle SQL for the operator-level queries."""

from __future__ import annotations

from .. import fixed_values as fv
from ..config import ReportConfig
from . import branding as ob
from .common import (budget_logic_reduced_sql, budget_logic_sql, budget_share_sql, d, q, rule_value_sql,
                     with_)
from .units_rules import RULE_SETS


def sql(cfg: ReportConfig) -> dict[str, str]:
    out = {}
    h = with_(["fx_map"])
    out["planning_context"] = f"""{h}
SELECT camp_id, channel, planning_context_code, planning_context_name, CAST(ctx_rows AS INTEGER) AS ctx_rows
FROM (SELECT channel_name AS channel, planning_context_code, planning_context_name, camp_id,
  row_number() OVER (PARTITION BY camp_id ORDER BY channel_name NULLS LAST, planning_context_code NULLS LAST,
   planning_context_name NULLS LAST) AS rn,
  count(*) OVER (PARTITION BY camp_id) AS ctx_rows
 FROM fx_map WHERE camp_id IS NOT NULL) x WHERE rn = 1"""
    h = with_(["fx_fixcost"])
    out["ambiguous_context"] = f"""{with_(["fx_map"])}
SELECT camp_id, count(*) AS mapping_rows,
 count(DISTINCT (ifnull(channel_name, ''), ifnull(planning_context_code, ''), ifnull(planning_context_name, ''))) AS contexts
FROM fx_map WHERE camp_id IS NOT NULL GROUP BY camp_id HAVING count(*) > 1"""
    out["date_spine"] = f"""{h}
SELECT CAST(g AS DATE) AS datum FROM (SELECT greatest(min(start_date), {d(cfg.fixcost_calendar_start)}) AS lo,
  least(max(end_date), {d(cfg.fixcost_calendar_end)}) AS hi FROM fx_fixcost) b,
 generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g)"""
    h = with_(["fx_perf"])
    camps = "(SELECT DISTINCT camp_id FROM fx_perf)"
    out["budget_logic"] = f"{h}\nSELECT camp_id, CAST({budget_logic_sql('camp_id')} AS INTEGER) AS budget_logic FROM {camps} c"
    out["budget_share"] = f"""{h}
SELECT camp_id, CAST(budget_logic AS INTEGER) AS budget_logic,
 CAST({budget_share_sql('camp_id', 'budget_logic')} AS DOUBLE) AS budget_logic_share
FROM (SELECT camp_id, {budget_logic_sql('camp_id')} AS budget_logic FROM {camps} c) x"""
    out["budget_logic_reduced"] = (f"{h}\nSELECT camp_id, CAST({budget_logic_reduced_sql('camp_id')} AS INTEGER)"
                                   f" AS budget_logic FROM {camps} c")
    out["budget_share_ws"] = f"""{h}
SELECT camp_id, CAST(budget_logic AS INTEGER) AS budget_logic,
 CAST({budget_share_sql('camp_id', 'budget_logic', with_fs=False)} AS DOUBLE) AS budget_logic_share
FROM (SELECT camp_id, {budget_logic_sql('camp_id')} AS budget_logic FROM {camps} c) x"""
    h = with_(["fx_actual"])
    out["budget_from_name"] = f"""{h}
SELECT campaign_name,
 CAST(CASE WHEN instr(upper(campaign_name), '_WKZ_') > 0 THEN 3 ELSE 1 END AS INTEGER) AS logic_upper,
 CASE WHEN instr(upper(campaign_name), '_VERTRIEB_') > 0 THEN 'VERTRIEB' ELSE 'BRANDING' END AS type_upper,
 CAST(CASE WHEN instr(campaign_name, '_WKZ_') > 0 THEN 3 ELSE 1 END AS INTEGER) AS logic_raw,
 CASE WHEN instr(campaign_name, '_VERTRIEB_') > 0 THEN 'VERTRIEB' ELSE 'BRANDING' END AS type_raw
FROM (SELECT DISTINCT campaign_name FROM fx_actual) n"""
    h = with_(["fx_plan"])
    out["budget_from_attr"] = f"""{h}
SELECT budget_origin, CAST(budget_logic AS INTEGER) AS budget_logic, campaign_type,
 CAST(CASE WHEN budget_logic = 1 THEN 1.0 WHEN budget_logic = 3 THEN 0.0 END AS DOUBLE) AS budget_logic_share
FROM (SELECT budget_origin, CASE WHEN upper(budget_origin) = 'WKZ' THEN 3 ELSE 1 END AS budget_logic,
  CASE WHEN upper(budget_origin) = 'VERTRIEB' THEN 'VERTRIEB' ELSE 'BRANDING' END AS campaign_type
 FROM (SELECT DISTINCT budget_origin FROM fx_plan) o) x"""
    h = with_(["fx_tiktok"])
    parts = []
    for name, rules in RULE_SETS.items():
        code = rule_value_sql(rules, "campaign_name", "account_id", cfg, "code")
        nm = rule_value_sql(rules, "campaign_name", "account_id", cfg, "name")
        parts.append(f"SELECT {q(name)} AS rule_set, campaign_name, account_id, {code} AS planning_context_code,"
                     f" {nm} AS planning_context_name FROM (SELECT DISTINCT campaign_name, account_id FROM fx_tiktok) p")
    out["context_fallback"] = h + "\n" + "\nUNION ALL\n".join(parts)
    h = with_(ob.BINDINGS, *ob.shared(cfg))
    out["actual_vs_plan"] = f"""{h}
SELECT day AS reporting_date, CAST(class AS INTEGER) AS budget_logic, type AS campaign_type, is_plan,
 CAST(cost AS DOUBLE) AS media_cost, CAST(base AS DOUBLE) AS infra_base, CAST(volume AS DOUBLE) AS impressions
FROM ({ob.reconciled(cfg, "tv_days", fv.PLAN_TV)}) r"""
    out["agency_fee"] = f"""{h}
SELECT day AS reporting_date, sub AS sub_channel, CAST(cost_euro_nnn AS DOUBLE) AS cost_euro_nnn, CAST(fee AS DOUBLE) AS fee,
 CAST(discount AS DOUBLE) AS discount, CAST(managed_fee AS DOUBLE) AS managed_fee, CAST(dsp_fee AS DOUBLE) AS dsp_fee
FROM (SELECT CAST(planning_date AS DATE) AS day, cost_euro_nnn,
  CASE WHEN contains(upper(cost_type), {q(fv.DOOH_PROGRAMMATIC_MARK)}) THEN {q(fv.DOOH_PROGRAMMATIC)} ELSE {q(fv.DOOH_PLAIN)} END AS sub
 FROM fx_dooh)
LEFT JOIN fees f ON f.month = year(day) * 100 + month(day) AND upper(f.channel_branding) = {q(fv.FEE_DOOH)}
 AND upper(f.sub_channel_branding) = sub"""
    out["effective_media_cost"] = f"""{h}
SELECT reporting_date, campaign_scope, adgap_ids, channel, CAST(kosten_nnn AS DOUBLE) AS kosten_nnn,
 CAST(kosten_nnn_eff AS DOUBLE) AS kosten_nnn_eff, CAST(media_cost AS DOUBLE) AS media_cost, CAST(fee AS DOUBLE) AS fee
FROM digital_capped WHERE reporting_date <= {d(cfg.yesterday)}"""
    out["last_actual_date"] = f"""{h}
SELECT actual_date, campaign_name, max(actual_date) OVER (PARTITION BY campaign_name) AS max_actual_date,
 CAST(cost AS DOUBLE) AS cost
FROM (SELECT actual_date, upper(campaign_name) AS campaign_name, SUM(cost_euro_nnn) AS cost
 FROM fx_actual GROUP BY actual_date, upper(campaign_name)) t"""
    return out
