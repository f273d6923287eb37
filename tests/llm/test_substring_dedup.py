import hashlib
import random

import numpy as np
import pytest

from spendlens.llm import substring_dedup as S
from spendlens.llm.fm_index import FMIndex


def slow(rows, window=50):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for a in range(len(w) - window + 1):
                key = tuple(w[a:a + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for a in range(len(w) - window + 1):
                if first[tuple(w[a:a + window])] < i:
                    gone.update(range(a, a + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(small):
    docs = small("documents")
    found = got(S.substring_dedup(docs))
    assert found == slow(rows_of(docs))
    assert any(r[2] for r in found)


@pytest.fixture(scope="module")
def passages(spark, odd_docs):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(6)]
    common = rng.choices(vocabulary, k=30)
    rows = []
    for i in range(60):
        text = rng.choices(vocabulary, k=rng.randrange(40))
        for _ in range(rng.randrange(3)):
            a = rng.randrange(15)
            text += common[a:a + rng.randrange(5, 20)] + rng.choices(vocabulary, k=rng.randrange(10))
        rows.append((rng.randrange(50), " ".join(text)))
    return spark.createDataFrame(rows, "doc_id long, text string").union(odd_docs.select("doc_id", "text"))


@pytest.mark.parametrize("block_words", [300_000, 150])
def test_short_windows_and_odd_rows(passages, block_words):
    assert got(S.substring_dedup(passages, window=8, gram=3, block_words=block_words)) == slow(rows_of(passages), 8)


def test_empty(no_docs):
    assert S.substring_dedup(no_docs).collect() == []


def test_index_finds_every_window():
    rng = random.Random(5)
    segments = [np.array(rng.choices(range(1, 5), k=rng.randrange(6, 30))) for _ in range(40)]
    index = FMIndex(segments, 6)
    holder = index.least_by_class(np.arange(40))
    seen = set()
    for which, at, rows in index.matches(segments, 6):
        for s, a, r in zip(which.tolist(), at.tolist(), rows.tolist()):
            key = segments[s][a:a + 6].tolist()
            want = min(i for i, t in enumerate(segments)
                       for b in range(len(t) - 5) if t[b:b + 6].tolist() == key)
            assert holder[index.window_class[r]] == want
            seen.add((s, a))
    assert seen == {(s, a) for s, t in enumerate(segments) for a in range(len(t) - 5)}


def test_search_ends_where_nothing_matches():
    index = FMIndex([np.array([1, 2, 3, 4])], 2)
    found = [(w.tolist(), a.tolist()) for w, a, _ in index.matches([np.array([2, 3, 4]), np.array([1, 3, 4])], 2)]
    assert found == [([0, 1], [1, 1]), ([0], [0])]


def test_wide_keys_are_dealt_window_by_window(spark):
    """One passage in many surroundings: its key has more words than a block, and results stay the same."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(12)]
    rows = [(i, " ".join([f"a{rng.randrange(30)}" for _ in range(6)] + passage + [f"b{rng.randrange(30)}" for _ in range(6)]))
            for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for block_words in (40, 300, 10_000):
        assert got(S.substring_dedup(docs, window=8, gram=3, block_words=block_words)) == slow(rows, 8)


def test_word_numbers():
    from spendlens.llm.words import word_numbers

    rng = random.Random(2)
    texts = [b"", b" ", b"one", b" one  two\tone\n", "é é 漢字 é".encode(), b"\x00 \x00\x00 \x00", b"a\x1cb a\x85b"]
    texts += [bytes(rng.choice(b"ab \n\x0b\x0c\r\t\x00") for _ in range(rng.randrange(40))) for _ in range(200)]
    number = {}
    for t in texts:
        words, found = t.split(), word_numbers(t).tolist()
        assert len(words) == len(found)
        for w, n in zip(words, found):
            assert number.setdefault(w, n) == n
    assert len(set(number.values())) == len(number)
