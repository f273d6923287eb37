"""DuckDB oracle SQL: shared fragments.

The oracle queries are written in the *as-written* shape of the reports
(join first, then aggregate; calendars; nested aggregation), so that they check
the rewrites done on the Spark side. They read the raw test tables through the
fixture bindings inlined as CTEs.
"""

from __future__ import annotations

import datetime as dt

from .. import fixed_values as fv
from ..config import ReportConfig
from ..sources.bindings import duckdb_with_clause


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# False when the fx_* tables already exist in the DuckDB session (timing runs)
INLINE_BINDINGS = True


def with_(bindings, *ctes: str) -> str:
    if not INLINE_BINDINGS:
        # a no-op CTE keeps the "WITH ..., x AS (...)" shape of every query
        return "WITH _none AS (SELECT 1)" + "".join(",\n" + c for c in ctes)
    head = duckdb_with_clause(bindings)
    return head + "".join(",\n" + c for c in ctes)


def instr(col: str, m: str) -> str:
    return f"instr({col}, {q(m)}) > 0"


def budget_logic_sql(c: str) -> str:
    return (
        f"CASE WHEN {instr(c, fv.MARK_TW)} OR {instr(c, fv.MARK_PF)} THEN 2"
        f" WHEN {instr(c, fv.MARK_W)} OR {instr(c, fv.MARK_F)} OR ({instr(c, fv.MARK_SS_AG)} AND {instr(c, fv.MARK_D_C)})"
        f" OR {instr(c, fv.MARK_SES)} THEN 3 ELSE 1 END"
    )


def budget_logic_reduced_sql(c: str) -> str:
    return (
        f"CASE WHEN {instr(c, fv.MARK_TW)} THEN 2"
        f" WHEN {instr(c, fv.MARK_W)} OR ({instr(c, fv.MARK_SS_AG)} AND {instr(c, fv.MARK_D_C)})"
        f" OR {instr(c, fv.MARK_SES)} THEN 3 ELSE 1 END"
    )


def _pct(c: str, pattern: str) -> str:
    inner = f"nullif(regexp_extract({c}, {q(pattern)}, 0), '')"
    return f"CAST(nullif(regexp_extract({inner}, {q(fv.DIGITS_RE)}, 0), '') AS DOUBLE)"


def budget_share_sql(c: str, logic: str, with_fs: bool = True) -> str:
    s = (f"CASE WHEN {logic} = 1 THEN 1.0 WHEN {logic} = 3 THEN 0.0"
         f" WHEN {instr(c, fv.SHARE_WS_MARK)} THEN 1 - {_pct(c, fv.SHARE_WS_RE)} / 100")
    if with_fs:
        s += f" WHEN {instr(c, fv.SHARE_FS_MARK)} THEN 1 - {_pct(c, fv.SHARE_FS_RE)} / 100"
    return s + " END"


def context_ctes(distinct: bool) -> list[str]:
    dist = "DISTINCT " if distinct else ""
    return [
        f"cte_pc AS (SELECT {dist}channel_name AS channel, planning_context_code, planning_context_name, camp_id FROM fx_map)",
        "pc AS (SELECT *, row_number() OVER (PARTITION BY camp_id ORDER BY channel NULLS LAST,"
        " planning_context_code NULLS LAST, planning_context_name NULLS LAST) AS ctx_rank FROM cte_pc)",
    ]


def rule_arm_sql(rules: dict, name: str, account: str | None, cfg: ReportConfig) -> str:
    text = f"upper({name})" if rules["upper"] else name
    arms = []
    for i, arm in enumerate(rules["arms"]):
        conds = [f"instr({text}, {q(m)}) > 0" for m in arm.get("has", ())]
        conds += [f"instr({text}, {q(m)}) = 0" for m in arm.get("lacks", ())]
        cond = " AND ".join(conds) if conds else None
        accts = [str(getattr(cfg, a)) for a in arm.get("accounts", ())]
        if accts:
            a = f"{account} IN ({', '.join(accts)})"
            cond = a if cond is None else f"({cond}) OR {a}"
        arms.append(f"WHEN {cond} THEN {i}")
    return f"CASE {' '.join(arms)} ELSE {len(rules['arms'])} END"


def rule_value_sql(rules: dict, name: str, account: str | None, cfg: ReportConfig, field: str) -> str:
    """The reference's CASE: the first matching arm's constant, else NULL."""
    text = f"upper({name})" if rules["upper"] else name
    arms = []
    for arm in rules["arms"]:
        conds = [f"instr({text}, {q(m)}) > 0" for m in arm.get("has", ())]
        conds += [f"instr({text}, {q(m)}) = 0" for m in arm.get("lacks", ())]
        cond = " AND ".join(conds) if conds else None
        accts = [str(getattr(cfg, a)) for a in arm.get("accounts", ())]
        if accts:
            a = f"{account} IN ({', '.join(accts)})"
            cond = a if cond is None else f"({cond}) OR {a}"
        arms.append(f"WHEN {cond} THEN {q(arm[field])}")
    return f"CASE {' '.join(arms)} END"


def first_value(expr: str, key: str) -> str:
    """FIRST_VALUE made deterministic: value at the smallest pick key."""
    return f"arg_min_null({expr}, {key})"


def channel_branch_sql(
    *, table: str, date: str, camp: str, metrics: dict, where: str, channel: str, label: str,
    code: str | None = None, name: str | None = None, rules: dict | None = None,
    rule_name: str | None = None, rule_account: str | None = None, cfg: ReportConfig | None = None,
    joins: str = "", ctx_on: str | None = None, group: str | None = None,
) -> str:
    """One channel-view branch, as written: fact LEFT JOIN context, GROUP BY day and campaign.

    metrics: output name -> SQL aggregate expression.
    """
    key = "coalesce(pc.ctx_rank, 0)"
    if rules is not None:
        key = f"coalesce(pc.ctx_rank, 0) * 100 + {rule_arm_sql(rules, rule_name, rule_account, cfg)}"
        code_e = f"coalesce(pc.planning_context_code, {rule_value_sql(rules, rule_name, rule_account, cfg, 'code')})"
        name_e = f"coalesce(pc.planning_context_name, {rule_value_sql(rules, rule_name, rule_account, cfg, 'name')})"
    elif code is not None:
        code_e = f"coalesce(pc.planning_context_code, {q(code)})"
        name_e = f"coalesce(pc.planning_context_name, {q(name)})"
    else:
        code_e, name_e = "pc.planning_context_code", "pc.planning_context_name"
    ms = ",\n ".join(f"{e} AS {n}" for n, e in metrics.items())
    return f"""SELECT {date} AS reporting_date,
 {first_value(f"coalesce(pc.channel, {q(channel)})", key)} AS channel,
 {camp} AS camp_id,
 {first_value(code_e, key)} AS planning_context_code,
 {first_value(name_e, key)} AS planning_context_name,
 {q(label)} AS source_system,
 {ms}
FROM {table} {joins}
LEFT JOIN pc ON {ctx_on or f"dat.camp_id = pc.camp_id"}
WHERE {where}
GROUP BY {group or f"{date}, {camp}"}"""


VIEW_SELECT = (
    "reporting_date, planning_context_code, planning_context_name, channel, camp_id, source_system,"
    " CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks,"
    " CAST(cost_euro AS DOUBLE) AS cost_euro"
)


def view_sql(head: str, union_body: str, final_where: str = "TRUE") -> str:
    """Channel view: union of branches, budget logic and share, final filter."""
    return f"""{head},
u AS ({union_body}),
b AS (SELECT *, {budget_logic_sql('camp_id')} AS budget_logic FROM u)
SELECT {VIEW_SELECT}, CAST(budget_logic AS INTEGER) AS budget_logic,
 CAST({budget_share_sql('camp_id', 'budget_logic')} AS DOUBLE) AS budget_logic_share
FROM b WHERE {final_where}"""


def branch_only_sql(head: str, body: str) -> str:
    return f"{head}\nSELECT {VIEW_SELECT} FROM ({body}) x"
