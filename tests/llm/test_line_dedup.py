import random

import pytest
from pyspark.sql import functions as F

from spendlens.llm import line_dedup as D


def slow(rows, n=5, similarity=0.8):
    """Removed (doc, line) over all pairs; rows without an id come last."""
    lines = []
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            w = [x for x in line.replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").split(" ") if x]
            if w:
                s = frozenset(tuple(w[a:a + n]) for a in range(max(1, len(w) - n + 1)))
                lines.append(((D._LAST if i is None else i, k), s))
    removed = set()
    lines.sort(key=lambda x: x[0])
    for y, (key, b) in enumerate(lines):
        for other, a in lines[:y]:
            if other != key and 10 * len(a & b) >= 10 * similarity * len(a | b):
                removed.add(key)
                break
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        gone = [k for k in range(len(parts)) if (D._LAST if i is None else i, k) in removed]
        out.append((i, len(parts), len(gone), ",".join(map(str, gone))))
    return sorted(out, key=str)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def got(df, **options):
    return sorted(map(tuple, D.line_dedup(df, **options).collect()), key=str)


def test_whole_table(small):
    docs = small("documents")
    found = got(docs)
    assert found == slow(rows_of(docs)) and any(r[2] for r in found)


@pytest.mark.parametrize("share", [D.COMMON_SHARE, 0.05, 1.0])
def test_many_near_lines_and_odd_rows(spark, odd_docs, no_docs, share):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(8)
            w = base[a:a + rng.randrange(2, 30)]
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(5)}"
            lines.append(" ".join(w))
        rows.append((100 + i, "\n".join(lines)))
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(docs, common_share=share) == slow(rows_of(docs))
    assert D.line_dedup(no_docs).collect() == []


def test_common_shingle_in_many_lines(spark):
    rows = [(i, f"one and the same five words {i} {i + 1} {i + 2} {i + 3} {i + 4} {i + 5}") for i in range(1500)]
    rows += [(2000 + i, rows[i * 7][1]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = got(docs)
    assert {r[0] for r in found if r[2]} == {2000 + i for i in range(20)}


def test_rows_that_repeat_an_id_have_lines_of_their_own(spark):
    """Under one number, a copy and the original of a later line."""
    one, two, three = ("alpha beta gamma delta epsilon " + w for w in ("one", "two words", "and three more"))
    docs = spark.createDataFrame([(3, one), (5, one), (5, two), (7, two), (None, three), (None, two + " x y z"), (None, one)] +
                                 [(20 + i, f"{i} {three}") for i in range(4)], "doc_id long, text string").repartition(4)
    assert got(docs) == slow(rows_of(docs))


def test_copies_are_not_verified(spark, monkeypatch):
    """Prefix tokens are written once; of lines that only have copies, no text is fetched again."""
    kept, stored = [], D.stored
    monkeypatch.setattr(D, "stored", lambda df, label, **o: kept.append((label, stored(df, label, **o))) or kept[-1][1])
    docs = spark.createDataFrame([(i, "the very same line of words\n" + " ".join(f"w{i // 2}{c}" for c in "abcdefgh")) for i in range(40)],
                                 "doc_id long, text string")
    assert got(docs) == slow(rows_of(docs))
    tables = dict(kept)
    assert tables["line-copies"].count() == 39 + 20 and tables["line-bodies"].count() == 0
    assert "prefix-tokens" in tables


def test_a_line_is_written_once_with_few_grams(spark, monkeypatch):
    """One row per line, fewer grams than the prefix filter's 21 tokens; near lines are fetched."""
    kept, stored = [], D.stored
    monkeypatch.setattr(D, "stored", lambda df, label, **o: kept.append((label, stored(df, label, **o))) or kept[-1][1])
    lines = [[f"w{i}x{k}" for k in range(104)] for i in range(30)]
    for i in range(10):
        lines[i][40:45] = "five words that they share".split()
        lines[20 + i] = lines[10 + i][:60] + [f"other{i}"] + lines[10 + i][61:]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(lines)], "doc_id long, text string").repartition(3)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    found = got(docs)
    assert found == slow(rows_of(docs)) and [r[0] for r in found if r[2]] == list(range(20, 30))
    assert spark.conf.get(cleanup) == before
    tables = dict(kept)
    assert tables["prefix-tokens"].count() == 30
    assert tables["prefix-tokens"].selectExpr("max(size(grams))").first()[0] < 21
    assert {r.doc_id for r in tables["line-bodies"].collect()} >= set(range(10, 30))


def test_versions_of_a_line_that_are_not_similar_are_not_paired(spark, monkeypatch):
    """Lines of one group hold the same prefix tokens; sizes and places of tokens don't tell them apart, their bitmaps do."""
    kept, stored = [], D.stored
    monkeypatch.setattr(D, "stored", lambda df, label, **o: kept.append((label, stored(df, label, **o))) or kept[-1][1])
    rng = random.Random(3)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(80):
        w = list(base)
        for k in rng.sample(range(60), 3 if i % 8 else 1):
            w[k] = rng.choice(base)
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = got(docs)
    assert found == slow(rows_of(docs)) and any(r[2] for r in found)
    tables = dict(kept)
    assert tables["line-bodies"].count() == 80
    assert tables["line-pairs"].count() < 80  # 3,137 of the 3,160 pairs before


@pytest.mark.parametrize("n", [1, 40, 300, 3000])
def test_bitmaps_differ_in_no_more_bits_than_sets_in_tokens(spark, n):
    rng = random.Random(n)
    a = [rng.getrandbits(63) for _ in range(n)]
    rows = [(a, a[k:] + [rng.getrandbits(63) for _ in range(m)]) for k in (0, n // 10, n) for m in (0, 1, n)]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    bits = df.select("a", "b", F.array(*D._bitmap(F.col("a"))).alias("x"), F.array(*D._bitmap(F.col("b"))).alias("y")).collect()
    apart = [sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(r.x, r.y)) for r in bits]
    assert all(d <= len(set(r.a) ^ set(r.b)) for d, r in zip(apart, bits)) and apart[0] == 0 and (n > 1 or max(apart) == 2)


def test_a_sieve_keeps_what_is_wanted(spark, monkeypatch):
    rows, wanted = spark.range(5000).selectExpr("id", "id % 7 k"), spark.range(0, 5000, 50)
    kept = {r.id for r in D._sieved(rows, F.col("id"), wanted, F.col("id")).collect()}
    assert kept >= set(range(0, 5000, 50)) and len(kept) < 200
    monkeypatch.setattr(D, "SIEVE_LONGS", 1)
    assert {r.id for r in D._sieved(rows, F.col("id"), wanted, F.col("id")).collect()} >= set(range(0, 5000, 50))
    assert D._sieved(rows, F.col("id"), wanted.limit(0), F.col("id")).count() == 0


def test_lines_are_taken_out(spark):
    docs = spark.createDataFrame([(1, "a\nb\na\nc", "x"), (2, "b", "x"), (3, None, "x"), (4, "new", "x")],
                                 "doc_id long, text string, line string")
    out = D.without_lines(docs, D.similar_lines(docs))
    assert sorted(map(tuple, out.collect())) == [(1, "a\nb\nc", "x"), (2, "", "x"), (3, None, "x"), (4, "new", "x")]
