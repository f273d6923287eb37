import hashlib
import re
from collections import defaultdict

from spendlens.llm import exact_dedup as E


def slow(rows):
    """Sorted (doc_id, keep_id, group_size, kept, sha) of (doc_id, text) rows."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    out = []
    for body, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, keep, len(ids), first, hashlib.sha256(body.encode()).hexdigest()))
            first = False
    return sorted(out, key=str)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(small):
    docs = small("documents")
    assert got(E.exact_dedup(docs)) == slow(rows_of(docs))


def test_odd_rows(odd_docs, no_docs):
    assert got(E.exact_dedup(odd_docs)) == slow(rows_of(odd_docs))
    assert E.exact_dedup(no_docs).collect() == []


def test_spilling_gives_the_same(small, odd_docs):
    docs = small("documents").select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    assert got(E.exact_dedup(docs, table_bytes=3000)) == slow(rows_of(docs))


def test_equal_hashes_are_told_apart_by_content(tmp_path):
    records = [(7, k, k, k, 1, c) for k, c in enumerate([b"a", b"b", b"a", b"c", b"b", b"a"] * 5)]
    for budget in (1, 500, 1 << 20):
        entries = [e for key, _, e in E.grace(iter(records), budget, str(tmp_path), True) if key is None]
        assert sorted((e.content, e.rows, e.least) for e in entries) == [(b"a", 15, 0), (b"b", 10, 1), (b"c", 5, 3)]
    assert list(tmp_path.iterdir()) == []


def test_normalised():
    for t in ("", " ", "\t\n", "a", " a", "a \n b\x0b", " a  b", "\x1c a"):
        assert E.normalised(t.encode()) == re.sub("[\x20\x09-\x0d]+", " ", t).encode()
