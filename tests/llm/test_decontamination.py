import hashlib
import random
import re

import pytest

from spendlens.llm import decontamination as D
from spendlens.llm.words import WordIds, run_hashes, window_minima

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(len(w), 10)
        if n and i is not None:
            for a in range(len(w) - n + 1):
                windows.setdefault(n, {}).setdefault(tuple(w[a:a + n]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n, by in windows.items():
            for a in range(len(w) - n + 1):
                if ids := by.get(tuple(w[a:a + n])):
                    hit.update(range(a, a + n))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def pairs(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(small):
    docs, items = small("documents"), small("benchmark")
    found = got(D.contamination(docs, items))
    assert found == slow(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"))
    assert any(r[5] for r in found)


@pytest.fixture(scope="module")
def odd_items(spark):
    rng = random.Random(1)
    vocabulary = ["a", "b", "c", "été"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 16)))) for i in range(30)]
    rows += [(3, "a b c"), (None, "a a a"), (40, None), (41, " .,; "), (42, "word")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_odd_rows(spark, odd_docs, no_docs, odd_items):
    rng = random.Random(2)
    vocabulary = ["A", "b", "C,", "été", "x"]
    more = [(100 + i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60)))) for i in range(60)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    want = slow(pairs(docs, "doc_id", "text"), pairs(odd_items, "item_id", "text"))
    assert got(D.contamination(docs, odd_items)) == want
    # a crowded bitmap lets more through and changes nothing
    assert got(D.contamination(docs, odd_items, filter_bits=7)) == want
    assert D.contamination(no_docs, odd_items).collect() == []
    assert all(r.n_hit == 0 for r in D.contamination(odd_docs, odd_items.limit(0)).collect())


@pytest.mark.parametrize("length", range(1, 11))
def test_shared_windows_share_a_kept_gram(length):
    rng = random.Random(length)
    vocabulary = [b"a", b"b", b"c", b"d"]
    passage = rng.choices(vocabulary, k=length)
    ids = WordIds()
    for _ in range(30):
        sides = [rng.choices(vocabulary, k=rng.randrange(6)) + passage + rng.choices(vocabulary, k=rng.randrange(6))
                 for _ in range(2)]
        a, b = (set(D._kept(ids.of(s), length)[0].tolist()) for s in sides)
        assert a & b


def test_window_minima():
    rng = random.Random(3)
    ids = WordIds()
    for window in (1, 2, 5, 8, 9, 16, 31):
        hashes = run_hashes(ids.of([rng.choice([b"a", b"b", b"c"]) for _ in range(80)]), 3)
        want = [min(range(i, i + window), key=lambda j: (hashes[j], j)) for i in range(len(hashes) - window + 1)]
        assert window_minima(hashes, window).tolist() == want
