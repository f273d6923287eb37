"""Near-duplicates by SimHash fingerprints, linked by meet-in-the-middle ball hashing.

Two fingerprints differ in at most 2r bits exactly if some value lies within r bits of
both. So every distinct fingerprint emits all values within r bits (its variants; 2,081 for
r = 2), equal variants are brought together, and fingerprints that share one are linked.

The shuffle goes by a variant's first bits. A fingerprint's variants lie under few such
prefixes (29 for 7 bits), so one row a prefix travels and the task that owns the prefix
writes out those variants that belong to it; where they are too many for its memory it
goes on to longer prefixes. Nothing is left out: every variant of every fingerprint is made
exactly once. Within a task links are reduced to a spanning forest, so a large group of
near copies leaves as a star, not as all its pairs.

Defined cases: null text has no words; no words give fingerprint zero, linked like any
other; rows of one id are one node; a row with a null id belongs to the component of the
ids that share its fingerprint (null if there are none); an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import small_batches, stored, utf8
from spendlens.llm.graph import connected_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BITS = 64
#: Variants that a task holds at once.
VARIANTS_AT_ONCE = 1 << 19
#: Distinct fingerprints a prefix should own on average.
PER_PREFIX = 2048

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, words_each: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word shingles: a bit is set if over half of the shingles' XXH64 have it."""
    words = text.lower().split()  # on bytes both go by ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    n = len(words) - words_each + 1
    if n <= 1:
        return int.from_bytes(digest(joined, SEED), "big")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[words_each - 1:] - 1).tolist()
    hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops)]), np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(hashes[:, i], minlength=256) @ _BITS_OF_BYTE for i in range(8)])
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _fingerprints(words_each: int):
    def run(batches):
        for batch in batches:
            prints = [fingerprint(t, words_each) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64)), *batch.columns[2:]],
                names=["doc_id", "fp", *batch.schema.names[2:]])

    return run


@cache
def flips(bits: int, most: int) -> np.ndarray:
    """All values of ``bits`` bits with at most ``most`` set."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint64)


def _route(prefix_bits: int, radius: int):
    """A row for each prefix under which a fingerprint has variants."""
    masks = flips(prefix_bits, radius).astype(np.int64)

    def run(batches):
        for batch in batches:
            prints, nodes = (c.to_numpy() for c in batch.columns)
            home = (prints.view(np.uint64) >> np.uint64(BITS - prefix_bits)).astype(np.int64)
            prefix = (home[:, None] ^ masks[None, :]).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefix), pa.array(np.repeat(prints, len(masks))), pa.array(np.repeat(nodes, len(masks)))],
                names=["prefix", "fp", "node"])

    return run


class Forest:
    """Union of array positions, by the least position."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            while (up := self.parent[self.parent]).tobytes() != self.parent.tobytes():
                self.parent = up
            a, b = self.parent[a], self.parent[b]
            apart = a != b
            a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(self.parent, b, a)

    def roots(self) -> np.ndarray:
        while (up := self.parent[self.parent]).tobytes() != self.parent.tobytes():
            self.parent = up
        return self.parent


def _variants_under(prints: np.ndarray, at: np.ndarray, prefix: int, bits: int, radius: int,
                    at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(variants, positions of their fingerprints) under a prefix, in parts of bounded size.

    ``at``: positions of fingerprints that may have variants there."""
    low = BITS - bits
    apart = np.bitwise_count((prints[at] >> np.uint64(low)) ^ np.uint64(prefix)) if bits else np.zeros(len(at), np.uint8)
    at, apart = at[apart <= radius], apart[apart <= radius]
    if len(at) < 2:
        return  # a fingerprint alone meets no other
    left = radius - apart.astype(np.int64)
    size = {r: sum(comb(low, k) for k in range(r + 1)) for r in range(radius + 1)}
    if low > 0 and sum(int((left == r).sum()) * n for r, n in size.items()) > at_once:
        step = min(3, low)
        for digit in range(1 << step):
            yield from _variants_under(prints, at, (prefix << step) | digit, bits + step, radius, at_once)
        return
    top = np.uint64(prefix << low)
    below = np.uint64((1 << low) - 1)
    variants, owners = [], []
    for r in range(radius + 1):
        own = at[left == r]
        if len(own):
            masks = flips(low, r)
            variants.append((((prints[own] & below) | top)[:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(own, len(masks)))
    yield np.concatenate(variants), np.concatenate(owners)


def links_under(prints: np.ndarray, prefix: int, bits: int, max_bits: int, at_once: int) -> np.ndarray:
    """For each of a prefix's fingerprints the least position it is linked with there."""
    forest = Forest(len(prints))
    for variants, owners in _variants_under(prints, np.arange(len(prints)), prefix, bits, max_bits // 2, at_once):
        order = np.argsort(variants, kind="stable")
        variants, owners = variants[order], owners[order]
        meet = np.flatnonzero(variants[1:] == variants[:-1])
        pairs = np.unique((owners[meet] << 32) | owners[meet + 1])
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        near = np.bitwise_count(prints[a] ^ prints[b]) <= max_bits
        forest.join(a[near], b[near])
    return forest.roots()


def _link(prefix_bits: int, max_bits: int, at_once: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("node").to_numpy(), kind="stable")
        nodes = group.column("node").to_numpy()[order]
        prints = group.column("fp").to_numpy()[order].view(np.uint64)
        roots = links_under(prints, key[0].as_py(), prefix_bits, max_bits, at_once)
        linked = np.flatnonzero(roots != np.arange(len(roots)))
        return pa.table({"src": nodes[linked], "dst": nodes[roots[linked]]})

    return run


def _components(nodes: DataFrame, max_bits: int, at_once: int) -> DataFrame:
    """(node, component) of the nodes (fp, node) that have links."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: each side covers half of it")
    # the layout alone depends on the count: longer prefixes make more and smaller groups
    prefix_bits = max(6, min(24, (nodes.count() // PER_PREFIX).bit_length()))
    links = (nodes.mapInArrow(_route(prefix_bits, max_bits // 2), "prefix long, fp long, node long")
             .groupBy("prefix").applyInArrow(_link(prefix_bits, max_bits, at_once), "src long, dst long"))
    return connected_components(links)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                       at_once: int = VARIANTS_AT_ONCE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable over
    links of at most ``max_bits`` differing bits; an even number)."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: each side covers half of it")
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"))
    prints = stored(texts.mapInArrow(_fingerprints(shingle_words), "doc_id long, fp long"), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    found = _components(nodes.where("node is not null"), max_bits, at_once)
    named = (nodes.join(found, "node", "left")
             .select("fp", F.coalesce("component", "node").alias("component_id")))
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_firsts(docs: DataFrame, key_col: str, id_col: str = "doc_id", text_col: str = "text",
                   shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   at_once: int = VARIANTS_AT_ONCE) -> DataFrame:
    """``key_col`` (a unique long, never null) of one row of each group of linked texts: the one of the least id.

    Rows are linked by their texts alone, whatever their ids, so the nodes are the fingerprints themselves; a
    row with a null id stays only if its whole group has null ids."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"),
                        F.col(key_col).alias("row_key"))
    prints = texts.mapInArrow(_fingerprints(shingle_words), "doc_id long, fp long, row_key long")
    row = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row_key")
    firsts = stored(prints.groupBy("fp").agg(F.min(row).alias("first")), "simhash-firsts")
    found = _components(firsts.select("fp", F.col("fp").alias("node")), max_bits, at_once)
    return (firsts.join(found.withColumnRenamed("node", "fp"), "fp", "left")
            .groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("first").alias("first"))
            .select(F.col("first.row_key").alias(key_col)))
