"""Channel views from stored day sums: a batch of new fact files adds its own sums.

The sums of a branch per (day, campaign) are mergeable, so what has been read once is kept as sums
and never read again: a batch is summed by itself, stored as one more part, and the report is built
from the parts of the days it touched. A store's parts are named by its manifest together with the
batches they hold, so a batch that is delivered again after a failure counts once, and rows that
arrive late for an old day just add to it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import ReportConfig
from ..operators.rollup import SUM_COLUMNS, Branch, day_sums, merged_sums, view_rows
from ..plans import search, social
from ..plans.common import campaigns_for
from ..session import checkpoint_dir
from ..sources.catalog import Catalog
from ..sources.manifest import Manifest
from ..sources.sinks import on_days, touched_days, write_report

#: Columns of a store: decimals as wide as sums of DECIMAL(18,2) get.
SCHEMA = ("branch string, camp_id string, impressions bigint, clicks bigint, cost_euro decimal(38,2), _arm int,"
          " reporting_date date")
#: Views that can be built from sums, and the source of each of their branches.
VIEWS = {"report_sea": (search, {k: b[0] for k, b in search.BRANCHES.items()}),
         "report_social": (social, {k: f[1] for k, f in social.FACTS.items()})}


def _stored(branch: str, sums: DataFrame) -> DataFrame:
    """Day sums as rows of a store."""
    schema = StructType.fromDDL(SCHEMA)
    columns = [F.lit(branch).alias("branch") if f.name == "branch" else
               (F.col(f.name) if f.name in sums.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return sums.select(columns)


class SumStore:
    """Day sums of branches in parts of a dataset, one part per batch until they are compacted."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.manifest = spark, Manifest(spark, root)

    def _write(self, sums: DataFrame) -> str:
        folder = self.manifest.new_folder()
        sums.hint("rebalance", "reporting_date").write.partitionBy("reporting_date").parquet(self.manifest.data(folder))
        return folder

    def has(self, batch: str) -> bool:
        return batch in self.manifest.read()[1].get("batches", [])

    def add(self, batch: str, sums: DataFrame) -> bool:
        """Store a batch's sums; False (and nothing done) if the batch is there already."""
        number, state = self.manifest.read()
        if batch in state.get("batches", []):
            return False
        folder = self._write(sums)
        self.manifest.commit(number, {"parts": [*state.get("parts", []), folder], "batches": [*state.get("batches", []), batch]})
        return True

    def read(self, days: list | None = None) -> DataFrame:
        """Merged sums per branch, day and campaign, of some days or all."""
        _, state = self.manifest.read()
        folders = [self.manifest.data(f) for f in state.get("parts", [])]
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        parts = (self.spark.read.schema(SCHEMA + ", write_id string").option("basePath", f"{self.manifest.root}/data")
                 .parquet(*folders).drop("write_id"))
        return merged_sums(parts if days is None else parts.filter(on_days(days)), "branch")

    def compact(self) -> None:
        """Merge all parts into one; what the store holds doesn't change."""
        number, state = self.manifest.read()
        if len(state.get("parts", [])) > 1:
            self.manifest.commit(number, state | {"parts": [self._write(self.read())]})

    def vacuum(self, keep: int = 2) -> list[str]:
        return self.manifest.vacuum(lambda state: state.get("parts", []), keep)


def batch_sums(view: str, source: str, rows: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Sums of some rows of a source, for every branch of the view that reads it."""
    module, sources = VIEWS[view]
    only = Catalog(rows.sparkSession, lambda name: rows)
    found = None
    for key in [k for k, s in sources.items() if s == source]:
        sums = _stored(key, day_sums(module.facts(only, cfg, key)))
        found = sums if found is None else found.unionAll(sums)
    return found


def report_from_sums(view: str, stores: Mapping[str, SumStore], cat: Catalog, cfg: ReportConfig,
                     days: list | None = None) -> DataFrame:
    """The view's report, of some days or all, from the stores of its sources; ``cat`` gives the dimensions only."""
    module, sources = VIEWS[view]
    campaigns = campaigns_for(cat, distinct=False)
    rows = []
    for key, source in sources.items():
        shape = module.facts(_NoFacts(cat), cfg, key)
        sums = stores[source].read(days).filter(F.col("branch") == key)
        rows.append(view_rows(sums.select("reporting_date", "camp_id", *_columns(shape)), campaigns, shape))
    return module.view(rows)


def _columns(branch: Branch) -> list[str]:
    have = [*branch.facts.columns, *(["_arm"] if branch.fallback.rules is not None else [])]
    return [c for c in SUM_COLUMNS if c in have]


class _NoFacts:
    """A catalog whose sources are there for their columns only."""

    def __init__(self, cat: Catalog):
        self._cat = cat

    def __getitem__(self, name: str) -> DataFrame:
        from ..sources.catalog import reader_schema

        return self._cat.spark.createDataFrame([], reader_schema(name))


def start_sums_refresh(spark: SparkSession, view: str, source: str, fact_dir: str, fact_schema: StructType,
                       stores: Mapping[str, SumStore], cat: Catalog, cfg: ReportConfig, target: str, name: str,
                       available_now: bool = True) -> StreamingQuery:
    """Keep a view's report up to date with the files that arrive for one of its sources.

    A micro-batch reads its new files only: their sums are stored under the batch's name, and the
    report's touched days are rebuilt from stored sums and committed. A batch that failed in
    between runs again: its sums are not added twice, its days are rebuilt again.
    """
    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        delta = batch_sums(view, source, batch, cfg)
        stores[source].add(f"{name}-{epoch_id}", delta)
        days = touched_days(delta)
        if days:
            write_report(report_from_sums(view, stores, cat, cfg, days), target, days)

    writer = (spark.readStream.schema(fact_schema).parquet(fact_dir).writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/spendlens-sums/{name}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
