"""Property tests: the Spark rewrites against the as-written SQL on random tables.

O6 (actual vs plan without calendar), O7 (interval spread by explode instead of a
calendar range join) and O8 (one DISTINCT instead of four) are checked on random
small source tables: the same rows go to a Spark catalog and to DuckDB tables,
and the query key's Spark result must equal its oracle SQL.
"""

import datetime as dt
import math
import re
from decimal import Decimal

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendlens.oracle import common as oracle_common
from spendlens.plans import registry
from spendlens.sources.catalog import SOURCES, Catalog

D = dt.date
FX_SCHEMAS = {
    "fx_actual": "actual_date date, end_date date, campaign_name string, cost_euro_nnn decimal(18,2), contacts decimal(18,4)",
    "fx_plan": "planning_date date, campaign_name string, budget_origin string, channel string, "
               "cost_euro_nnn_planned decimal(18,2), gross_contacts_planned bigint",
    "fx_fee": "year_month string, channel_branding string, sub_channel_branding string, fee decimal(9,4), "
              "discount decimal(9,4), managed_fee decimal(9,4), dsp_fee decimal(9,4)",
    "fx_fixcost": "campaign string, cost_euro decimal(18,2), duration_in_days int, start_date date, end_date date, "
                  "additional_costs string",
    "fx_map": "camp_id string, planning_context_code string, planning_context_name string, channel_name string",
    "fx_print": "initiative_name string, project_name string, shipping_type string, season_year string, opp_wbkz string, "
                "ppc_wbkz string, wbkz string, pages_total int, circulation_plan int, circulation_actual int, is_test bigint, "
                "height double, width double, content_weight double, content_pages double, cover_weight double, "
                "cover_pages double",
    "fx_print_cost": "auftrag string, kostenartenbes string, wert_overall decimal(18,2)",
}
# tables of their own with the same columns
LIKE = {"fx_radio": "fx_actual", "fx_webradio": "fx_actual", "fx_creative_cost": "fx_print_cost",
        "fx_shipping_cost": "fx_print_cost"}
FX_SCHEMAS |= {name: FX_SCHEMAS[of] for name, of in LIKE.items()}
DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "double": "DOUBLE"}


def _duck_type(t: str) -> str:
    return DUCK_TYPES.get(t, t.upper())


def run_both(spark, key: str, tables: dict[str, list[tuple]]):
    tables = tables | {name: tables[of] for name, of in LIKE.items() if of in tables and name not in tables}
    frames = {name: spark.createDataFrame(rows, FX_SCHEMAS[name]) for name, rows in tables.items()}

    def load(name):
        binding, cols = SOURCES[name]
        return frames[binding].select(*[F.col(src).alias(dst) for dst, src in cols.items()])

    cfg = pytest.cfg
    sdf = registry.builders()[key](Catalog(spark, load), cfg)
    cols = sorted(sdf.columns)
    srows = [tuple(r[c] for c in cols) for r in sdf.collect()]

    con = duckdb.connect()
    for name, rows in tables.items():
        spec = [c.strip().split(" ", 1) for c in re.split(r",\s*(?=[a-z_]+ )", FX_SCHEMAS[name])]
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{n} {_duck_type(t)}' for n, t in spec)})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' for _ in spec)})", rows)
    oracle_common.INLINE_BINDINGS = False
    try:
        res = con.execute(registry.oracle_sql(cfg)[key])
    finally:
        oracle_common.INLINE_BINDINGS = True
    names = [c[0] for c in res.description]
    orows = [tuple(dict(zip(names, r))[c] for c in cols) for r in res.fetchall()]
    return srows, orows


def same_rows(a, b) -> bool:
    def key(r):
        return tuple((0, repr(v)) if not isinstance(v, (float, Decimal)) else (1, round(float(v), 6)) for v in r)

    if len(a) != len(b):
        return False
    for ra, rb in zip(sorted(a, key=key), sorted(b, key=key)):
        for x, y in zip(ra, rb):
            if isinstance(x, (float, Decimal)) or isinstance(y, (float, Decimal)):
                if x is None or y is None:
                    if x is not y:
                        return False
                elif not math.isclose(float(x), float(y), rel_tol=1e-9, abs_tol=1e-9):
                    return False
            elif x != y:
                return False
    return True


@pytest.fixture(autouse=True)
def _cfg(cfg):
    pytest.cfg = cfg


money = st.one_of(st.none(), st.decimals(min_value=-500, max_value=5000, places=2, allow_nan=False))
days_around_floor = st.dates(min_value=D(1996, 12, 29), max_value=D(1997, 1, 4))
actual_rows = st.lists(st.tuples(
    days_around_floor, st.sampled_from([0, 1]), st.sampled_from(["Spot_WKZ_a", "spot_b", "Spot_VERTRIEB_c", None]),
    money, st.one_of(st.none(), st.decimals(min_value=0, max_value=9, places=4))), max_size=12)
plan_rows = st.lists(st.tuples(
    days_around_floor, st.sampled_from(["SPOT_wkz_a", "Spot_b", "spot_vertrieb_c", None]),
    st.sampled_from(["wkz", "Vertrieb", None]), st.sampled_from(["TV", "tv", "Hörfunk", "Webradio"]),
    money, st.one_of(st.none(), st.integers(0, 50))), max_size=12)
fee_rows = st.lists(st.tuples(
    st.sampled_from(["199612", "199701"]), st.sampled_from(["TV", "tv", "Funk"]), st.just(None),
    st.decimals(min_value=0, max_value=Decimal("0.1"), places=4), st.just(None), st.just(None), st.just(None)),
    max_size=4)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(actual=actual_rows, plan=plan_rows, fee=fee_rows, key=st.sampled_from(["bra_tv", "bra_radio", "bra_webradio", "actual_vs_plan"]))
def test_actual_vs_plan_rewrite(spark, actual, plan, fee, key):
    tables = {
        "fx_actual": [(d, d + dt.timedelta(days=e), n, c, v) for d, e, n, c, v in actual],
        "fx_plan": plan, "fx_fee": fee,
    }
    s, o = run_both(spark, key, tables)
    assert same_rows(s, o), (key, s, o)


spread_rows = st.lists(st.tuples(
    st.sampled_from(["c1-W.BC-", "c2-plain", None]), money, st.integers(0, 6),
    st.dates(min_value=D(1999, 6, 26), max_value=D(1999, 7, 3)), st.integers(-2, 6),
    st.sampled_from(["true", "false", None])), max_size=10)
map_rows = st.lists(st.tuples(
    st.sampled_from(["c1-W.BC-", "c2-plain"]), st.sampled_from(["P1", "P2", None]),
    st.sampled_from(["AWIN", "Private Network", None]), st.sampled_from(["Chan", None])), max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=spread_rows, mapping=map_rows)
def test_interval_spread_rewrite(spark, rows, mapping):
    tables = {"fx_fixcost": [(c, v, dur, s, s + dt.timedelta(days=k), add) for c, v, dur, s, k, add in rows],
              "fx_map": mapping}
    s, o = run_both(spark, "aff_fixcost_daily", tables)
    assert same_rows(s, o), (s, o)


print_rows = st.lists(st.tuples(
    st.sampled_from(["i1", "i2"]), st.sampled_from(["23GJ_Sommer_1", "23GJ_Sommer_2", "24GJ_Mode", "23GJ_", "Plain_x"]),
    st.sampled_from(["Package", "Mail", None]), st.sampled_from(["23/24", "FY23"]),
    st.sampled_from(["o1", "o2", None]), st.sampled_from(["o1", "o3", None]), st.sampled_from(["o2", "o3"]),
    st.one_of(st.none(), st.integers(1, 3)), st.integers(1, 3), st.integers(1, 3), st.integers(0, 1),
    st.sampled_from([20.0, 30.0]), st.sampled_from([10.0, 15.0]), st.sampled_from([60.0, None]),
    st.sampled_from([8.0, 16.0]), st.just(120.0), st.just(4.0)), max_size=10)
cost_rows = st.lists(st.tuples(st.sampled_from(["o1", "o2", "o3"]), st.sampled_from(["Druck", "Papier"]),
                               st.decimals(min_value=0, max_value=999, places=2)), max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(plan=print_rows, cost=cost_rows)
def test_single_distinct_rewrite(spark, plan, cost):
    s, o = run_both(spark, "report_seasonal_cost", {"fx_print": plan, "fx_print_cost": cost})
    assert same_rows(s, o), (s, o)
