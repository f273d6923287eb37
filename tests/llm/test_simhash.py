import random

import numpy as np
import pytest
import xxhash

from spendlens.llm import simhash as S


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints):
    """(id, fingerprint) rows -> id -> component, over all pairs."""
    ids = sorted({i for i, _ in prints if i is not None})
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = {}
    for i, f in prints:
        if i is not None:
            by.setdefault(f, []).append(i)
    fps = sorted(by)
    for f in fps:
        for i in by[f]:
            a, b = sorted((root(i), root(by[f][0])))
            parent[b] = a
    for x in range(len(fps)):
        for y in range(x):
            if (fps[x] ^ fps[y]).bit_count() <= 4:
                a, b = sorted((root(by[fps[x]][0]), root(by[fps[y]][0])))
                parent[b] = a
    return {i: root(i) for i in ids}, {f: root(by[f][0]) for f in by}


def check(docs, got):
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()]
    _, by_print = slow_components(rows)
    want = sorted(((i, f"{f:016x}", by_print.get(f)) for i, f in rows), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_whole_table(small):
    docs = small("documents")
    check(docs, S.simhash_components(docs))


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs, S.simhash_components(odd_docs))
    assert S.simhash_components(no_docs).collect() == []


@pytest.mark.parametrize("at_once", [1 << 19, 4000, 60])
def test_links_equal_all_pairs(at_once):
    rng = random.Random(at_once)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = set(base)
    for b in base:
        for _ in range(25):
            x = b
            for bit in rng.sample(range(64), rng.randrange(1, 9)):
                x ^= 1 << bit
            prints.add(x)
    prints = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    want = np.arange(len(prints))
    while True:
        step = np.array([want[n].min() for n in near])
        if (step == want).all():
            break
        want = step
    bits = 6
    forest = S.Forest(len(prints))
    for prefix in range(1 << bits):
        roots = S.links_under(prints, prefix, bits, 4, at_once)
        moved = np.flatnonzero(roots != np.arange(len(roots)))
        forest.join(moved, roots[moved])
    assert (forest.roots() == want).all()
