"""Benchmark: the six reports on the fixture sources derived from $BENCH_SF_DIR.

The derived source tables are written once to Parquet under the session's
checkpoint folder before timing (``fixture_prepare_sec``), then every report
reads them like stored production tables.

Each report runs to completion through Spark's ``noop`` sink (full execution,
nothing collected to the driver). One warm-up run, then the median of
$BENCH_RUNS timed runs per report. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendlens.config import testing  # noqa: E402
from spendlens.plans import registry  # noqa: E402
from spendlens.session import checkpoint_dir, get_spark  # noqa: E402
from spendlens.sources.catalog import fixture_catalog  # noqa: E402

REPORTS = ("report_sea", "report_display", "report_social", "report_affiliate", "report_branding",
           "report_seasonal_cost")


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = sys.argv[1:] or list(REPORTS)
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      shared=tempfile.mkdtemp(prefix="spendlens-bench-"))  # local master: one machine
    cfg = testing()
    builders = registry.builders()
    # sources are derived from the test tables once and stored as Parquet in the
    # session's checkpoint folder (not timed), then read like production tables
    # a new folder per run: never read tables left by an earlier (or interrupted) run
    fixtures = (f"{checkpoint_dir(spark).rstrip('/')}/spendlens-fixtures/"
                f"{os.path.basename(sf_dir)}-{uuid.uuid4().hex[:12]}")
    t0 = time.perf_counter()
    catalog = lambda: fixture_catalog(spark, sf_dir, materialize_dir=fixtures)
    sources = catalog()
    for name in sources:
        sources[name]
    prepare = time.perf_counter() - t0
    times, rows = {}, {}
    for key in keys:
        def run():
            t0 = time.perf_counter()  # building the plan counts
            df = builders[key](catalog(), cfg)
            df.write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up: JIT, file listing, broadcast checks
        samples = [run() for _ in range(runs)]
        times[key] = round(statistics.median(samples), 3)
        rows[key] = builders[key](catalog(), cfg).count()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "reports_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows": rows, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "runs": runs, "fixture_prepare_sec": round(prepare, 3),
    }))


if __name__ == "__main__":
    main()
