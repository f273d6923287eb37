import datetime as dt
import os

import duckdb
import pytest

from test_decontamination import slow as slow_contamination
from test_exact_dedup import slow as slow_exact
from test_simhash import slow_components, slow_fingerprint

import __spark_entry__ as E
import corpus_pipeline as P
from spendlens.llm import queries as Q
from spendlens.llm.language_id import language_id
from spendlens.llm.sentencepiece_tokens import sentencepiece_tokens

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def stages(spark, docs):
    """(name, input, output) of each stage, outputs held as local rows."""
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        rows = spark.createDataFrame(out.collect(), out.schema)
        yield name, docs, rows
        docs = rows


def test_every_stage_on_its_own_input(spark, small):
    docs = small("documents")
    benchmark = [(r.item_id, r.text) for r in small("benchmark").collect()]
    for name, before, after in stages(spark, docs):
        rows = [(r.doc_id, r.text) for r in before.collect()]
        if name == "language id":
            want = [r.doc_id for r in language_id(before).collect() if r.accepted]
        elif name == "exact dedup":
            want = [r[0] for r in slow_exact(rows) if r[3]]
        elif name == "simhash near-dedup":
            component, _ = slow_components([(i, slow_fingerprint(t)) for i, t in rows])
            want = [i for i in component if component[i] == i]
        elif name == "benchmark decontamination":
            want = [r[0] for r in slow_contamination(rows, benchmark) if not r[5]]
        else:
            assert sorted(after.collect()) == sorted(sentencepiece_tokens(before).collect())
            continue
        assert after.columns == docs.columns
        assert ids(after) == sorted(want, key=str)
        kept = {r.doc_id: r for r in after.collect()}
        assert all(kept[r.doc_id] == r for r in before.collect() if r.doc_id in kept)


def test_run_equals_its_stages(spark, small):
    *_, (_, _, last) = stages(spark, small("documents"))
    assert sorted(P.run(spark, SF).collect()) == sorted(last.collect())


def test_odd_rows(spark, odd_docs, no_docs):
    columns = ("doc_id", "text", "lang", "source", "n_chars")
    seen = dict((name, out) for name, _, out in stages(spark, odd_docs.select(*columns)))
    assert not {1, 2, 3} & set(ids(seen["language id"]))
    assert ids(seen["exact dedup"]).count(5) == 0 and ids(seen["exact dedup"]).count(4) == 1
    assert [out.count() for _, _, out in stages(spark, no_docs.select(*columns))] == [0] * 5


@pytest.mark.parametrize("as_file", [False, True])
def test_rows_are_judged_by_themselves(spark, small, tmp_path, as_file):
    """Null and repeated ids: no row is kept or dropped for another's sake."""
    item = next(r.text for r in small("benchmark").collect() if len(r.text.split()) > 12)
    words = [f"{a}{b}" for a in "alpha bravo carol delta echo".split() for b in "abcdefgh"]
    one, two = " ".join(words), " ".join(words[::-1])

    def after(stage, rows):
        docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
        if as_file:
            docs.repartition(3).write.parquet(path := f"{tmp_path}/{stage.__name__}")
            docs = spark.read.parquet(path)
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    english = next(r.text for r in small("documents").where("lang = 'en'").orderBy("doc_id").collect())
    learnt = [(r.doc_id, r.text) for r in small("documents").where("lang = 'en'").collect()]
    kept = after(P.language, [*learnt, (None, english), (None, None), (None, "12 34"), (10**9, english), (10**9, "")])
    assert [r for r in kept if r[0] in (None, 10**9)] == [(10**9, english), (None, english)]
    assert after(P.exact, [(4, "word"), (None, "word"), (None, "only here"), (None, "only here"), (5, "a b"), (5, "a  b"), (5, "c")]) in [
        sorted([(4, "word"), (None, "only here"), (5, ab), (5, "c")], key=str) for ab in ("a b", "a  b")]
    null_only = [one, one + " ", one + "x"]  # linked with each other, and with no row that has an id
    assert after(P.near, [*((None, o) for o in null_only), (None, two), (7, two), (8, "other words"), (8, two)]) in [
        sorted([(None, o), (7, two), (8, "other words")], key=str) for o in null_only]
    assert after(P.clean_of_benchmark, [(None, one), (None, item), (3, two), (3, f"so {item} then")]) == [(3, two), (None, one)]


@pytest.mark.parametrize("key", sorted(Q.oracle_sql()))
def test_queries_equal_their_sql(spark, key):
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    got = E.queries()[key](spark, SF)
    result = con.execute(E.oracle_sql()[key])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(got.columns)
    plain = lambda v: v.date() if isinstance(v, dt.datetime) else v
    want = sorted(tuple(map(plain, r)) for r in result.fetchall())
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == want


def test_columns_that_clash(spark, odd_docs):
    """Columns named like the stages' own come through every filtering stage, rows judged as without them."""
    more = odd_docs.selectExpr("*", *[f"doc_id as {c}" for c in ("pipeline_row", "pipeline_row0", "Pipeline_File", "_pipeline_row",
                                                                "_id", "_rank", "_label", "gone", "row_key", "accepted")])
    plain = [ids(out) for _, _, out in stages(spark, odd_docs.select("doc_id", "text", "lang", "source", "n_chars"))]
    for (name, before, out), want in zip(stages(spark, more), plain):
        if name != P.STAGES[-1][0]:
            assert out.columns == more.columns
        assert ids(out) == want


def test_all_are_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert len(P.STAGES) == 5
