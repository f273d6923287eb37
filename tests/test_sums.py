"""Atomic sinks, stored day sums and refresh after changes of dimensions."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from spendlens.plans import affiliate, branding, search, social
from spendlens.sources import sinks
from spendlens.sources.catalog import Catalog, fixture_catalog
from spendlens.sources.manifest import Conflict, Manifest
from spendlens.sources.sinks import read_report, vacuum_report, write_report
from spendlens.streaming import changes, sums

DAYS = [dt.date(2024, 1, d) for d in range(1, 6)]


def rows(spark, *days):
    return spark.createDataFrame([(d, i) for i, d in enumerate(days)], "reporting_date date, n int")


def counts(spark, path, number=None):
    return {r.reporting_date: r["count"] for r in read_report(spark, path, number).groupBy("reporting_date").count().collect()}


def all_rows(df):
    names = sorted(df.columns)
    return sorted(map(tuple, df.select(names).collect()), key=str)


def test_days_without_rows_go_and_null_days_stay(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(rows(spark, DAYS[0], DAYS[1], None, None), path)
    write_report(rows(spark, DAYS[1], DAYS[1], DAYS[4]), path, [DAYS[0], DAYS[1]])
    assert counts(spark, path) == {DAYS[1]: 2, None: 2}
    write_report(rows(spark, None), path, [None])
    assert counts(spark, path) == {DAYS[1]: 2, None: 1}
    write_report(rows(spark, DAYS[0]), path, [])
    assert counts(spark, path) == {DAYS[1]: 2, None: 1}
    write_report(rows(spark).limit(0), path)
    assert counts(spark, path) == {} and read_report(spark, path).columns == ["reporting_date", "n"]


def test_a_write_that_fails_before_its_commit_shows_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    write_report(rows(spark, *DAYS[:3]), path)

    def broken(self, number, state):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Manifest, "commit", broken)
        with pytest.raises(RuntimeError):
            write_report(rows(spark, DAYS[1], DAYS[1]), path, [DAYS[0], DAYS[1]])
        assert len(os.listdir(path + "/data")) == 2
        assert counts(spark, path) == dict.fromkeys(DAYS[:3], 1)
    assert len(vacuum_report(spark, path)) == 1  # the lost write's folder
    assert counts(spark, path) == dict.fromkeys(DAYS[:3], 1)


def test_a_write_that_fails_while_writing_shows_nothing(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(rows(spark, *DAYS[:2]), path)
    with pytest.raises(Exception, match="lost"):
        write_report(rows(spark, DAYS[0]).withColumn("n", F.raise_error(F.lit("lost")).cast("int")), path, [DAYS[0]])
    assert counts(spark, path) == dict.fromkeys(DAYS[:2], 1)


def test_readers_keep_the_state_they_opened(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(rows(spark, *DAYS[:2]), path)
    opened = read_report(spark, path)
    write_report(rows(spark, DAYS[1], DAYS[1]), path, [DAYS[0], DAYS[1]])
    assert opened.count() == 2 and counts(spark, path) == {DAYS[1]: 2}
    assert counts(spark, path, 1) == dict.fromkeys(DAYS[:2], 1)
    assert vacuum_report(spark, path, keep=1) and counts(spark, path) == {DAYS[1]: 2}


def test_a_second_writer_is_told(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(rows(spark, *DAYS[:2]), path)
    manifest = Manifest(spark, path)
    number, state = manifest.read()
    write_report(rows(spark, DAYS[0]), path)
    with pytest.raises(Conflict):
        manifest.commit(number, state)
    assert counts(spark, path) == {DAYS[0]: 1}
    with pytest.raises(FileNotFoundError):
        read_report(spark, str(tmp_path / "none"))


# ------------------------------------------------------------------------- day sums
def refreshed(spark, cfg, tmp_path, view, source, batches, cat, stores, name, **kw):
    """Runs of the refresh, one per batch of files written into the fact folder."""
    facts = str(tmp_path / f"facts-{source}")
    for i, (file_name, df) in enumerate(batches):
        os.makedirs(facts, exist_ok=True)
        part = str(tmp_path / f"part-{uuid.uuid4().hex}")
        df.coalesce(1).write.parquet(part)
        made = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.rename(f"{part}/{made}", f"{facts}/{file_name}")
        sums.start_sums_refresh(spark, view, source, facts, df.schema, stores, cat, cfg, str(tmp_path / "report"), name).awaitTermination(300)


def test_report_from_sums_after_late_and_repeated_files(spark, cfg, tmp_path):
    base = fixture_catalog(spark, SF_SMALL)
    source = "google_keyword_perf"
    others = [s for s in sums.VIEWS["report_sea"][1].values() if s != source]
    stores = {s: sums.SumStore(spark, str(tmp_path / f"sums-{s}")) for s in {source, *others}}
    facts = base[source].filter(F.col("date_col").between(F.lit(dt.date(1997, 1, 1)), F.lit(dt.date(1997, 2, 20)))).cache()
    early, late = facts.filter(F.col("clicks") % 3 != 0), facts.filter(F.col("clicks") % 3 == 0)
    dims = Catalog(spark, lambda n: base[n] if n in ("planning_context_map", "campaign_persist") else pytest.fail(f"{n} was read"))
    name = f"late-{uuid.uuid4().hex}"
    # the second file holds rows for days that are there already; the third delivers the first again
    refreshed(spark, cfg, tmp_path, "report_sea", source, [("a.parquet", early), ("b.parquet", late), ("a.parquet", early)], dims, stores, name)
    full = Catalog(spark, lambda n: facts if n == source else base[n].limit(0) if n in others else base[n])
    want = all_rows(search.report(full, cfg))
    assert want and all_rows(read_report(spark, str(tmp_path / "report"))) == want
    assert len(stores[source].manifest.read()[1]["parts"]) == 2
    stores[source].compact()
    assert len(stores[source].manifest.read()[1]["parts"]) == 1 and stores[source].has(f"{name}-0")
    assert all_rows(sums.report_from_sums("report_sea", stores, dims, cfg)) == want


def test_a_batch_counts_once_when_the_report_failed(spark, cfg, tmp_path, monkeypatch):
    base = fixture_catalog(spark, SF_SMALL)
    source = "pinterest_pin_perf"
    stores = {s: sums.SumStore(spark, str(tmp_path / f"sums-{s}")) for s in set(sums.VIEWS["report_social"][1].values())}
    facts = base[source].filter(F.col("reporting_date").between(F.lit(dt.date(1997, 1, 1)), F.lit(dt.date(1997, 1, 20))))
    name, args = f"once-{uuid.uuid4().hex}", ([("a.parquet", facts)], base, stores)
    with monkeypatch.context() as m:
        m.setattr(sums, "write_report", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            refreshed(spark, cfg, tmp_path, "report_social", source, *args, name)
    assert stores[source].has(f"{name}-0")
    refreshed(spark, cfg, tmp_path, "report_social", source, *args, name)
    full = Catalog(spark, lambda n: facts if n == source else base[n].limit(0) if n.endswith("_perf") else base[n])
    assert all_rows(read_report(spark, str(tmp_path / "report"))) == all_rows(social.report(full, cfg))


@pytest.mark.parametrize("view, module", [("report_sea", search), ("report_social", social)])
def test_sums_of_all_facts_give_the_report(spark, cfg, tmp_path, view, module):
    base = fixture_catalog(spark, SF_SMALL)
    stores = {}
    for source in set(sums.VIEWS[view][1].values()):
        stores[source] = sums.SumStore(spark, str(tmp_path / source))
        month = F.col(base[source].columns[0])
        rows_ = base[source].filter(month.between(F.lit(dt.date(1996, 2, 1)), F.lit(dt.date(1996, 4, 1))))
        assert stores[source].add("all", sums.batch_sums(view, source, rows_, cfg))
        assert not stores[source].add("all", sums.batch_sums(view, source, rows_, cfg))
    part = Catalog(spark, lambda n: base[n].filter(F.col(base[n].columns[0]).between(F.lit(dt.date(1996, 2, 1)), F.lit(dt.date(1996, 4, 1))))
                   if n in stores else base[n])
    want = all_rows(module.report(part, cfg))
    assert want and all_rows(sums.report_from_sums(view, stores, base, cfg)) == want


# ---------------------------------------------------------------------- dimensions
def test_changed_rows_are_a_multiset_difference(spark):
    schema = "a int, b string"
    old = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], schema)
    new = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, None)], schema)
    got = {(r.a, r.b): r.n for r in changes.changed_rows(old, new).collect()}
    assert got == {(1, "x"): -1, (2, None): 1, (3, "z"): -1, (4, None): 1}


def test_fee_months(spark):
    days = changes.fee_months(dt.date(2024, 1, 30), dt.date(2024, 3, 2))(
        spark.createDataFrame([("202402",), ("202403",), ("202403",), (None,)], "year_month string"))
    got = sorted(r[0] for r in days.collect())
    assert got == [dt.date(2024, 2, 1) + dt.timedelta(days=i) for i in range(31)]


def changing(spark, base, **now):
    """A catalog whose sources can be replaced while it is open."""
    state = dict(now)
    return state, Catalog.__new__(type("Live", (Catalog,), {
        "__init__": lambda self: None, "spark": spark, "_cache": {}, "_buckets": {},
        "__getitem__": lambda self, n: state.get(n, base[n]) if n in state else base[n]}))


def test_a_late_link_refreshes_its_call_day(spark, cfg, tmp_path):
    base = fixture_catalog(spark, SF_SMALL)
    link = base["tracking_call_campaign_link"]
    late = F.col("external_call_h_sk") % 50 == 7
    state, cat = changing(spark, base, tracking_call_campaign_link=link.filter(~late))
    target, snapshots = str(tmp_path / "report"), changes.Snapshots(spark, str(tmp_path / "dims"))
    build = lambda: affiliate.report(cat, cfg)
    rules = {"tracking_call_campaign_link": changes.call_days(cat)}
    write_report(build(), target)
    snapshots.take({n: cat[n] for n in rules})
    assert changes.refresh_dimensions(cat, snapshots, rules, build, target) == []
    before = all_rows(read_report(spark, target))
    state["tracking_call_campaign_link"] = link
    days = changes.refresh_dimensions(cat, snapshots, rules, build, target)
    after = all_rows(read_report(spark, target))
    assert days and after != before and after == all_rows(build())
    assert changes.refresh_dimensions(cat, snapshots, rules, build, target) == []


def test_a_late_rate_and_mapping_refresh_their_days(spark, cfg, tmp_path):
    base = fixture_catalog(spark, SF_SMALL)
    day = dt.date(1997, 5, 5)
    state, cat = changing(spark, base, exchange_rates=base["exchange_rates"].filter(F.col("reporting_date") != F.lit(day)))
    target, snapshots = str(tmp_path / "report"), changes.Snapshots(spark, str(tmp_path / "dims"))
    build = lambda: branding.branch(cat, cfg, "bra_odin")
    pairs = lambda: build().select("reporting_date", "camp_id").distinct()
    rules = {"exchange_rates": changes.day_rows("reporting_date"), "campaign_persist": changes.campaign_days("campaign_id", pairs)}
    write_report(build(), target)
    snapshots.take({n: cat[n] for n in rules})
    state["exchange_rates"] = base["exchange_rates"]
    assert changes.refresh_dimensions(cat, snapshots, rules, build, target) == [day]
    assert all_rows(read_report(spark, target)) == all_rows(build())
    some = build().filter(F.col("camp_id").isNotNull()).first().camp_id
    state["campaign_persist"] = base["campaign_persist"].unionAll(spark.createDataFrame([(some,)], "campaign_id string"))
    days = changes.refresh_dimensions(cat, snapshots, rules, build, target)
    assert set(days) == {r[0] for r in pairs().filter(F.col("camp_id") == some).select("reporting_date").collect()}
    assert all_rows(read_report(spark, target)) == all_rows(build())


def test_days_reach_the_scans_as_literals(spark, cfg):
    cat = fixture_catalog(spark, SF_SMALL)
    plan = search.report(cat, cfg).filter(sinks.on_days(DAYS[:2]))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "l_shipdate" in line]
    assert scans and "Exchange" in plan
    for line in plan.split("\n"):
        if "Filter" in line and "l_shipdate" in line and "FileScan" not in line:
            assert "2024-01-01" in line
