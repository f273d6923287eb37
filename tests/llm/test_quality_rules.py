import re
from collections import Counter

import duckdb
import pytest

from spendlens.llm import quality_rules as Q
from spendlens.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    """Measurements of one text, from their definitions."""
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered),
            len(lines), sum(c in Q.SHOUT for c in text))


def failed(m):
    n, chars, symbols, dups, repeats, lines, shouts = m
    tests = (n < 50, 100 * repeats > 50 * n, 10 * symbols > n, 10 * dups > 3 * lines, chars < 2 * n, chars > 16 * n,
             10 * shouts > 3 * n)
    return sum(1 << i for i, t in enumerate(tests) if t)


def held(df, rows, **kw):
    got = Q.rule_ledger(df, **kw).select("doc_id", *Q.MEASURES, "failed").collect()
    want = []
    for i, text in rows:
        m = slow(text)
        want.append((i, *m, failed(m)))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_small_table(spark, small):
    docs = small("documents")
    held(docs, docs.select("doc_id", "text").collect())


def test_windows_blanks_and_lines(spark):
    texts = ["a b c a b c", "a b c d a b c", "a a a a", "a a a", "a b", "x\x0by\x0cz x y z", "\n\n a \n a \na\na", "a\r\na\r",
             "ab c ab c a bc", "# * $ % & | < > ! ?", "é é 漢字 😀😀 é é", "one two three " * 3000, "\x00 \x00 \x00 \x00",
             " ".join(str(i % 977) for i in range(5000)), "#*" * 40 + " w" * 60, "A! " * 70, "q" * 20_000]
    rows = list(enumerate(texts))
    held(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_odd_rows(spark, odd_docs):
    clash = odd_docs.selectExpr("*", "1 as w", "2 as s", "3 as failed", "4 as lines", "5 as n_words", "6 as h")
    held(clash, [(r.doc_id, r.text) for r in odd_docs.collect()])
    got = Q.quality_rules(clash)
    assert got.count() == odd_docs.count()
    assert got.where("kept and base_failed").count() == 0


def test_no_rows(spark, no_docs):
    assert Q.quality_rules(no_docs).count() == 0
    assert Q.ablations(Q.rule_ledger(no_docs)).count() == 0


def test_policies_and_ablations(spark):
    bits = [0, 1, 2, 3, 4, 5, 5, 64, 68]
    ledger = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "doc_id long, failed long")
    strict, loose = Q.Policy("p", 1, ("few_words", "symbols")), Q.Policy("p", 2, ("few_words", "symbols"), allowed=1)
    kept = lambda p: [r.kept for r in Q.judged(ledger, p).orderBy("doc_id").collect()]
    assert kept(strict) == [b & 5 == 0 for b in bits]
    assert kept(loose) == [b & 5 != 5 for b in bits]
    got = {(r.policy, r.version, r.rule): (r.n_failed, r.n_dropped, r.n_only) for r in Q.ablations(ledger, (strict, loose)).collect()}
    for p in (strict, loose):
        for rule, bit in (("few_words", 1), ("symbols", 4)):
            drops = [b for b in bits if bin(b & 5).count("1") > p.allowed]
            only = [b for b in drops if bin(b & 5 & ~bit).count("1") <= p.allowed]
            assert got["p", p.version, rule] == (sum(b & bit > 0 for b in bits), len(drops), len(only))
    with pytest.raises(KeyError):
        Q.Policy("p", 1, ("unheard of",)).mask()


def test_labelled_quality(spark):
    """What is labelled poor goes, what is labelled good stays (short texts aside)."""
    folder = "/root/testdata/sf0.01"
    rows = queries.op11_quality_rules(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in rows.where("n_words >= 50").groupBy("quality", "kept").count().collect()}
    assert n.get((0, True), 0) <= 0.05 * n[0, False]
    assert n.get((1, False), 0) <= 0.02 * n[1, True]


def test_no_python(spark, small):
    plan = Q.rule_ledger(small("documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.sql(queries.oracle_sql()["op11_quality_rules"])
    got = queries.op11_quality_rules(spark, folder)
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.project(", ".join(names)).fetchall())
