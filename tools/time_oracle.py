"""Time the as-written oracle SQL of the reports in DuckDB (single-node reference point).

Like bench.py, the derived source tables are built once first (not timed).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from spendlens.oracle import common as oracle_common  # noqa: E402
from spendlens.plans.registry import oracle_sql  # noqa: E402
from spendlens.sources.bindings import BINDINGS, duckdb_with_clause  # noqa: E402

REPORTS = ("report_sea", "report_display", "report_social", "report_affiliate", "report_branding",
           "report_seasonal_cost")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(os.environ.get("BENCH_CPUS", "8"))
    con = duckdb.connect()
    con.execute(f"SET threads={threads}")
    con.execute("SET TimeZone='UTC'")
    for t in ("part", "orders", "lineitem", "supplier", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    # same setup as bench.py: derive the fx_* source tables once (not timed)
    t0 = time.perf_counter()
    for name in BINDINGS:
        con.execute(f"CREATE TABLE {name} AS {duckdb_with_clause([name])} SELECT * FROM {name}")
    prepare = time.perf_counter() - t0
    oracle_common.INLINE_BINDINGS = False
    sqls = oracle_sql()
    out = {}
    for k in REPORTS:
        samples = []
        for _ in range(3):
            t0 = time.perf_counter()
            # materialize every column, as Spark's noop sink computes every column
            con.execute(f"CREATE OR REPLACE TEMP TABLE _out AS {sqls[k]}")
            samples.append(time.perf_counter() - t0)
        out[k] = round(statistics.median(samples), 3)
    print(json.dumps({"engine": "duckdb", "threads": threads, "queries": out, "total": round(sum(out.values()), 3),
                      "fixture_prepare_sec": round(prepare, 3)}))


if __name__ == "__main__":
    main()
