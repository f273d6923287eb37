import hashlib
import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spendlens.llm import queries
from spendlens.llm import vector_codes as V


def slow(rows, parts=16, entries=64, rounds=2):
    """(vec_id, vector, label) rows -> sorted (vec_id, code, error, label_error) and the digest, by plain loops."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v) and len(v) % parts == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    d = len(kept[0][1]) // parts
    cut = [[tuple(v[p * d:(p + 1) * d]) for p in range(parts)] for _, v, _ in kept]
    book = [[x[p] for x in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            of = [[] for _ in book[p]]
            for x in cut:
                of[nearest(p, x[p])[1]].append(x[p])
            new.append([tuple(sum(c) // len(xs) for c in zip(*xs)) if xs else old for xs, old in zip(of, book[p])])
        book = new
    found = [[nearest(p, x[p]) for p in range(parts)] for x in cut]
    error = [sum(e for e, _ in f) for f in found]
    by = {}
    for (_, _, label), e in zip(kept, error):
        by[label] = by.get(label, 0) + e
    out = [(i, "".join(f"{e:02x}" for _, e in f), err, by[label]) for (i, _, label), f, err in zip(kept, found, error)]
    return sorted(out, key=str), hashlib.sha256(",".join(str(x) for p in book for c in p for x in c).encode()).hexdigest()


def held(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1, b"") for r in rows],
                               "vec_id long, embedding array<float>, label int, code string, error int, v binary").repartition(3)
    coded, book = V.vector_codes(df, **kw)
    got = sorted(map(tuple, V.with_label_errors(coded).select("vec_id", "code", "error", "label_error").collect()), key=str)
    want, digest = slow([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows], **kw)
    assert got == want
    assert V.book_digest(book) == digest


def vectors(n, dims, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(0, spread, dims).astype(np.float32).tolist(), int(rng.integers(4))) for i in range(n)]


def test_small_table(spark, small):
    rows = [(r.vec_id, r.embedding, r.label) for r in small("embeddings").collect()]
    held(spark, rows)


def test_odd_rows(spark):
    rows = vectors(90, 32, 1)
    rows += [(3, rows[3][1], None), (3, rows[3][1], None), (None, rows[5][1], None), (None, None, 1), (200, None, 1),
             (201, [float("nan")] * 32, 1), (202, [float("inf")] + [0.0] * 31, 1), (203, [None] + [0.0] * 31, 1),
             (204, [], 2), (205, [0.5] * 31, 2), (206, [0.5] * 16, 2), (-5, rows[7][1], 0)]
    held(spark, rows)


def test_ties_and_few_rows(spark):
    same = [0.25] * 16
    held(spark, [(i, same, 1) for i in range(80)])
    held(spark, [(i, [float(i % 3)] * 16, i % 2) for i in range(150)], entries=7)
    held(spark, vectors(5, 48, 2))
    held(spark, [(1, same, None)])


def test_many_entries_and_parts(spark):
    held(spark, vectors(300, 24, 3), parts=4, entries=37, rounds=3)


def test_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    coded, book = V.vector_codes(df)
    assert V.with_label_errors(coded).count() == 0 and V.book_digest(book) == hashlib.sha256(b"").hexdigest()
    assert V.vector_codes(spark.createDataFrame([(1, None, 2)], df.schema))[0].count() == 0


def test_large_components(spark):
    df = spark.createDataFrame([(1, [1e30] * 16, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError):
        V.vector_codes(df)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 70), st.integers(1, 5), st.integers(1, 30), st.integers(0, 10 ** 6))
def test_trees_against_all_pairs(n, k, d, spread, seed):
    """Assignments, counts and sums of the walk, whole nodes included, are those of all pairs."""
    rng = np.random.default_rng(seed)
    points = rng.integers(-spread, spread + 1, (2, n, d)) + rng.integers(0, 3, (2, n, 1)) * 200
    entries = rng.integers(-spread, spread + 1, (2, k, d)) + rng.integers(0, 3, (2, k, 1)) * 200
    order = V.tree_order(points, V.LEAF)
    assert (np.sort(order, 1) == np.arange(n)).all()
    tree = V.Tree(np.take_along_axis(points, order[:, :, None], 1), V.LEAF)
    counts, sums = np.zeros((2, k), int), np.zeros((2, k, d), int)

    def whole(part, entry, level, at):
        np.add.at(counts, (part, entry), 1 if level is None else np.diff(tree.bounds[level])[at])
        np.add.at(sums, (part, entry), tree.points[part, at] if level is None else tree.sums[level][part, at])

    got = V.assigned(tree, V.Entries(entries), whole)
    want = ((tree.points[:, :, None] - entries[:, None]) ** 2).sum(3).argmin(2)
    assert (got == want).all()
    for p in range(2):
        for e in range(k):
            assert counts[p, e] == (want[p] == e).sum() and (sums[p, e] == tree.points[p][want[p] == e].sum(0)).all()


def test_whole_nodes_are_used():
    """Tight clusters are assigned by nodes, not by points."""
    rng = np.random.default_rng(0)
    points = (rng.integers(0, 8, (1, 4000, 1)) * 1000 + rng.integers(-3, 4, (1, 4000, 4))).astype(np.int64)
    order = V.tree_order(points, V.LEAF)
    tree = V.Tree(np.take_along_axis(points, order[:, :, None], 1), V.LEAF)
    single = []
    V.assigned(tree, V.Entries((np.arange(8) * 1000)[None, :, None] + np.zeros((1, 8, 4), np.int64)),
               lambda part, entry, level, at: single.append(len(part)) if level is None else None)
    assert sum(single) < 400


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = con.sql(queries.oracle_sql()["op13_vector_codes"])
    got = queries.op13_vector_codes(spark, folder)
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.project(", ".join(names)).fetchall())
