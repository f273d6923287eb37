"""Exact deduplication of word passages with an FM-index per shard.

A passage is any window of ``window`` words that two documents share.

1. Candidates. The least k-gram hash of a window is the same wherever the window stands, so
   a window can recur in another document only if its least k-gram does. Documents name
   their least k-grams; those of one document alone are put aside. A window's run is cut out
   as a segment: consecutive windows with the same least k-gram.
2. Equal segments are brought together first, so copies travel and are searched once.
   After that a very common passage is the same few segments wherever it stands, and no shard
   grows with its copies. Of k-grams with very many segments only windows whose hash two
   documents have go on.
3. Shards. Segments are dealt by their least k-gram, so equal windows lie in one shard. The
   windows of a k-gram with more segments than a block holds are dealt one by one by their
   digest, as rows of their own, so no shard grows with a passage's many surroundings. A task
   indexes its shard in blocks of bounded size (suffix order, wavelet matrix) and streams the
   shard's segments through it by backward search. A match of at least ``window`` words lies in
   a class of rows with the same window; the class says which is the smallest document.
   Hashes only put aside what cannot match; what is removed is decided on the words.
4. A document loses the words of each window that a smaller document has too.

Defined cases: null text has no words; rows without an id keep all words and remove none;
rows of one id are one document (each loses what a smaller id has); texts shorter than a
window stay; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import small_batches, stored, utf8
from spendlens.llm.fm_index import FMIndex
from spendlens.llm.words import run_hashes, window_minima, word_numbers

WINDOW = 50
GRAM = 20
#: Words that a task indexes at once.
BLOCK_WORDS = 100_000


def _least_grams(ids: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window the position of its least k-gram, and that k-gram's hash."""
    hashes = run_hashes(ids, gram)
    at = window_minima(hashes, window - gram + 1)
    return at, hashes[at]


def _survey(window: int, gram: int):
    """Per document: words, digest of all words, its windows' least k-grams."""

    def run(batches):
        for batch in batches:
            ids, prints, texts = (c.to_pylist() for c in batch.columns)
            count, sha, grams = [], [], []
            for text in texts:
                words = text.split()
                count.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                grams.append(np.unique(_least_grams(word_numbers(text), window, gram)[1]).view(np.int64)
                             if len(words) >= window else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(grams, pa.list_(pa.int64()))], names=["doc_id", "fp", "n_words", "sha", "grams"])

    return run


_CUT = "doc_id long, fp long, start int, key long, digest binary, content binary, body binary"


def _cut(window: int, gram: int):
    """Per document with candidates a row with its words, and one for each segment.

    A segment's content comes along once a task."""

    def run(batches):
        seen = set()
        for batch in batches:
            out = [[] for _ in range(7)]

            def add(*row):
                for column, value in zip(out, row):
                    column.append(value)

            for doc_id, fp, text, shared in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.split()
                add(doc_id, fp, None, None, None, None, b" ".join(words))
                at, grams = _least_grams(word_numbers(text), window, gram)
                edges = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
                shared = np.isin(grams[edges[:-1]], np.array(shared, np.int64).view(np.uint64))
                for a, b, key in zip(edges[:-1][shared].tolist(), edges[1:][shared].tolist(),
                                     grams[edges[:-1]][shared].view(np.int64).tolist()):
                    content = b" ".join(words[a:b - 1 + window])
                    digest = hashlib.blake2b(content, digest_size=16).digest()
                    add(doc_id, fp, a, key, digest, None if digest in seen else content, None)
                    seen.add(digest)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["doc_id", "fp", "start", "key", "digest", "content", "body"])

    return run


def _numbered(window: int):
    """Segments with a number each, and how many windows they have."""

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            numbers = pa.array(range(number, number + batch.num_rows), pa.int64())
            number += batch.num_rows
            windows = [c.count(b" ") + 2 - window for c in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([numbers, *batch.columns, pa.array(windows, pa.int32())],
                                             names=["segment", *batch.schema.names, "windows"])

    return run


def _window_hashes(window: int):
    def run(batches):
        for batch in batches:
            segments, least, most, contents = (c.to_pylist() for c in batch.columns)
            hashes = [run_hashes(word_numbers(c), window) for c in contents]
            sizes = [len(h) for h in hashes]
            if sum(sizes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(x, np.int64), sizes)) for x in (segments, least, most)]
                    + [pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])),
                       pa.array(np.concatenate(hashes).view(np.int64))],
                    names=["segment", "least", "most", "at", "hash"])

    return run


def _single(window: int):
    """Windows of segments, at given places, as segments of their own."""

    def run(batches):
        for batch in batches:
            out = []
            for segment, key, least, content, places, words in zip(*(c.to_pylist() for c in batch.columns)):
                w = content.split()
                out += [(segment, a, key, least, b" ".join(w[a:a + window]), words) for a in places]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                names=["segment", "at", "key", "least", "content", "words"])

    return run


def _first_holders(block: list[tuple[bytes, int]], window: int) -> list[np.ndarray]:
    """For each (content, smallest document) of a block, in order, the smallest document of each of its windows."""
    words = [c.split() for c, _ in block]
    codes = {w: i for i, w in enumerate(set().union(*words), 1)}
    segments = [np.fromiter(map(codes.__getitem__, w), np.int64, len(w)) for w in words]
    index = FMIndex(segments, window)
    holder = index.least_by_class(np.array([least for _, least in block], np.int64))
    sizes = np.array([len(s) - window + 1 for s in segments])
    flat = np.zeros(sizes.sum(), np.int64)
    offset = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for which, at, rows in index.matches(segments, window):
        flat[offset[which] + at] = holder[index.window_class[rows]]
    return np.split(flat, offset[1:])


def _search(window: int, block_words: int):
    """Indexes a shard in blocks of whole (key, part) groups (the input is sorted by them) and streams it through them."""

    def run(batches):
        def blocks():
            held, size, last = [], 0, None
            for batch in batches:
                for key, part, segment, window_id, content, least in zip(*(c.to_pylist() for c in batch.columns)):
                    if (key, part) != last:
                        if size >= block_words:
                            yield held
                            held, size = [], 0
                        last = key, part
                    held.append((segment, window_id, content, least))
                    size += content.count(b" ") + 1
            if held:
                yield held

        for held in blocks():
            firsts = _first_holders([row[2:] for row in held], window)
            for i in range(0, len(held), 5000):
                segments, windows, _, _ = zip(*held[i:i + 5000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segments, pa.int64()), pa.array(windows, pa.binary()), pa.array(firsts[i:i + 5000], pa.list_(pa.int64()))],
                    names=["segment", "window", "first"])

    return run


def _remove(window: int):
    def run(batches):
        for batch in batches:
            removed, sha = [], []
            for _, _, body, starts in zip(*(c.to_pylist() for c in batch.columns)):
                words = body.split()
                edges = np.zeros(len(words) + window + 1, np.int64)
                starts = np.unique(np.array(starts))
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + window, -1)
                keep = np.cumsum(edges)[:len(words)] == 0
                removed.append(int(len(words) - keep.sum()))
                sha.append(hashlib.sha256(b" ".join([words[i] for i in np.flatnonzero(keep)])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                names=["doc_id", "fp", "n_removed", "kept_sha256"])

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    gram: int = GRAM, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by a space)."""
    small_batches(docs.sparkSession)
    gram = min(gram, window)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(utf8(F.col(text_col))).alias("fp"),
                        utf8(F.col(text_col)).alias("text"))
    survey = stored(texts.mapInArrow(_survey(window, gram), "doc_id long, fp long, n_words long, sha string, "
                                                            "grams array<long>"), "survey")
    named = survey.where("doc_id is not null and size(grams) > 0").select("doc_id", "fp", F.explode("grams").alias("gram"))
    shared = named.groupBy("gram").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("gram")
    wanted = named.join(shared, "gram").groupBy("doc_id", "fp").agg(F.collect_set("gram").alias("grams"))
    cut = stored(texts.join(wanted, ["doc_id", "fp"]).select("doc_id", "fp", "text", "grams")
                 .mapInArrow(_cut(window, gram), _CUT), "segments")
    holds = cut.where("key is not null")
    # equal segments are one
    distinct = stored(
        holds.groupBy("key", "digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
                                           F.max("content").alias("content"))
        .mapInArrow(_numbered(window), "segment long, key long, digest binary, least long, most long, content binary, "
                                       "windows int"), "distinct")
    # keys with more words than a block: few, or their share of the text would be larger
    words = F.col("windows") + F.lit(window - 1)
    wide = stored(distinct.groupBy("key").agg(F.sum(words).alias("words")).where(F.col("words") > block_words), "wide-keys")
    none = lambda kind: F.lit(None).cast(kind)
    fitting = distinct.join(wide.select("key"), "key", "left_anti").select(
        "key", F.lit(0).cast("long").alias("part"), "segment", none("binary").alias("window"), "content", "least")
    many = distinct.join(wide, "key").select("segment", "key", "least", "most", "content", "words")
    windows = stored(many.select("segment", "least", "most", "content")
                     .mapInArrow(_window_hashes(window), "segment long, least long, most long, at int, hash long"), "windows")
    twice = (windows.groupBy("hash").agg(F.min("least").alias("a"), F.max("most").alias("b"))
             .where("a < b").select("hash"))
    places = windows.join(twice, "hash").groupBy("segment").agg(F.collect_set("at").alias("places"))
    # a wide key's windows are dealt to as many parts as blocks would hold them all, equal ones as one
    parts = F.ceil(F.col("words") * window / block_words)
    single = stored(
        many.join(places, "segment").select("segment", "key", "least", "content", "places", "words")
        .mapInArrow(_single(window), "segment long, at int, key long, least long, content binary, words long")
        .withColumn("window", F.unhex(F.sha2("content", 256)))
        .withColumn("part", F.pmod(F.xxhash64("window"), parts).cast("long")), "single")
    apart = (single.groupBy("key", "part", "window").agg(F.min("least").alias("least"), F.max("content").alias("content"))
             .select("key", "part", none("long").alias("segment"), "window", "content", "least"))
    found = stored(fitting.union(apart).repartition("key", "part").sortWithinPartitions("key", "part")
                   .mapInArrow(_search(window, block_words), "segment long, window binary, first array<long>"), "found")
    found = (found.where("segment is not null").select("segment", F.lit(0).alias("at"), "first")
             .union(single.select("segment", "at", "window").join(found.where("window is not null").select("window", "first"), "window")
                    .select("segment", "at", "first")))
    found = distinct.select("segment", "key", "digest").join(found, "segment").select("key", "digest", "at", "first")
    starts = (holds.select("doc_id", "fp", "start", "key", "digest").distinct().join(found, ["key", "digest"])
              .select("doc_id", "fp", F.filter(
                  F.transform("first", lambda least, i: F.when(least < F.col("doc_id"), F.col("start") + F.col("at") + i)),
                  lambda start: start.isNotNull()).alias("starts"))
              .where("size(starts) > 0").groupBy("doc_id", "fp").agg(F.flatten(F.collect_list("starts")).alias("starts")))
    bodies = cut.where("body is not null").select("doc_id", "fp", "body").dropDuplicates(["doc_id", "fp"])
    lost = (bodies.join(starts, ["doc_id", "fp"]).select("doc_id", "fp", "body", "starts")
            .mapInArrow(_remove(window), "doc_id long, fp long, n_removed long, kept_sha256 string"))
    return survey.select("doc_id", "fp", "n_words", "sha").join(lost, ["doc_id", "fp"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
