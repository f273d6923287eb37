"""Benchmark decontamination by winnowing.

A window of t words holds t - k + 1 word k-grams. Keeping the least k-gram hash of every
window (winnowing) guarantees that two texts which share a window keep a common k-gram of
it. Both sides are winnowed, kept k-grams are joined on their hash, and each meeting place
is extended word by word to both sides; it counts where the shared run reaches t words.
A kept k-gram travels with the t - k words on either side, which is all that windows
through it can reach, so texts are not shuffled.

Windows have ``window`` words; an item of fewer words is one window. So there are at most
``window`` different lengths, each with its own k and its own winnowing.

Before the join the document side is sifted by a bitmap of the items' hashes. Its size is
fixed (``filter_bits``), so it is safe to broadcast however large the benchmark grows; it
only lets too much through when it is crowded.

Defined cases: null texts have no words; items without words or without id are no items;
an item id given twice counts once; repeated document rows are each judged; no items or
no documents give no hits or no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import small_batches, stored, utf8
from spendlens.llm.words import WordIds, run_hashes, window_minima

WINDOW = 10
FILTER_BITS = 25

#: Lower-cases A-Z and turns every other ASCII character but a-z and 0-9 into a space.
_TO_WORDS = bytes(c if c > 127 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if 65 <= c <= 90 else 32
                  for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def gram_and_span(window: int) -> tuple[int, int]:
    """(k, hashes in a window) for windows of so many words."""
    k = window // 2 + 1
    return k, window - k + 1


def _kept(ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the k-grams that winnowing keeps for windows of ``length`` words."""
    k, span = gram_and_span(length)
    hashes = run_hashes(ids, k) ^ np.uint64(length << 59 & (1 << 64) - 1)
    at = np.unique(window_minima(hashes, span))
    return hashes[at], at


def _context(words: list[bytes], at: int, length: int) -> tuple[bytes, int]:
    """The words that windows through the k-gram at ``at`` can reach, and where the k-gram starts in them."""
    reach = length - gram_and_span(length)[0]
    first = max(0, at - reach)
    return b" ".join(words[first:at + length]), at - first


_SEEDS = "row_key long, doc_id long, n_words long, length int, hash long, at long, context binary, offset int"


def _seeds(window: int, lengths: list[int] | None, bitmap, keyed: bool = False):
    """For documents (``lengths`` given): a row for each, and one for every kept k-gram that the bitmap knows.
    For items: a row for every kept k-gram of the item's own length."""

    def run(batches):
        numbers = WordIds()
        known = None if bitmap is None else np.frombuffer(bitmap.value, np.uint64)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = [[] for _ in range(8)]

            def add(*row):
                for column, value in zip(out, row):
                    column.append(value)

            for doc_id, text, *own in zip(*(c.to_pylist() for c in batch.columns)):
                key = own[0] if keyed else number
                words = words_of(text)
                ids = numbers.of(words)
                if lengths is None:
                    wanted = [min(len(words), window)] if words and doc_id is not None else []
                else:
                    wanted = lengths
                    add(key, doc_id, len(words), None, None, None, None, None)
                for length in wanted:
                    hashes, at = _kept(ids, length)
                    if known is not None:
                        place = hashes & np.uint64(64 * len(known) - 1)
                        hit = known[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1
                        hashes, at = hashes[hit], at[hit]
                    for h, a in zip(hashes.view(np.int64).tolist(), at.tolist()):
                        add(key, doc_id, None, length, h, a, *_context(words, a, length))
                number += 1
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["row_key", "doc_id", "n_words", "length", "hash", "at", "context", "offset"])

    return run


def extended(a: list[bytes], i: int, b: list[bytes], j: int, k: int) -> tuple[int, int]:
    """How far the runs through ``a[i:i+k]`` and ``b[j:j+k]`` agree to the left and from i to the right."""
    if a[i:i + k] != b[j:j + k]:
        return 0, 0
    left = 0
    while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
        left += 1
    right = k
    while right < min(len(a) - i, len(b) - j) and a[i + right] == b[j + right]:
        right += 1
    return left, right


def _extend(batches):
    for batch in batches:
        out = []
        for row_key, item, length, at, a, i, b, j in zip(*(c.to_pylist() for c in batch.columns)):
            left, right = extended(a.split(), i, b.split(), j, gram_and_span(length)[0])
            if left + right >= length:
                out.append((row_key, item, at - left, at + right))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                             names=["row_key", "item_id", "start", "end"])


def _bitmap(items: DataFrame, bits: int) -> bytes:
    """The items' hashes as a bitmap of fixed size: at most 2**bits / 64 rows reach the driver."""
    rows = (items.select(F.col("hash").bitwiseAND((1 << bits) - 1).alias("place"))
            .groupBy((F.col("place") / 64).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits")).collect())
    known = np.zeros(1 << bits - 6, np.int64)
    for word, value in rows:
        known[word] = value
    return known.tobytes()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  filter_bits: int = FILTER_BITS, key_col: str | None = None) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit (words inside shared windows), n_items, items_sha256
    (their ids, sorted as strings, comma-joined), contaminated.

    ``key_col``: a unique long of the documents that is never null; it comes first in the result."""
    spark = docs.sparkSession
    small_batches(spark)
    item_texts = items.select(F.col(item_id_col).cast("long").alias("doc_id"), utf8(F.col(item_text_col)).alias("text"))
    item_seeds = stored(item_texts.mapInArrow(_seeds(window, None, None), _SEEDS)
                        .select(F.col("doc_id").alias("item_id"), "length", "hash", F.col("context").alias("item_context"),
                                F.col("offset").alias("item_offset")).distinct(), "item-seeds")
    lengths = sorted(r.length for r in item_seeds.select("length").distinct().collect())  # at most ``window``
    bitmap = spark.sparkContext.broadcast(_bitmap(item_seeds, filter_bits))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"),
                        *([F.col(key_col).alias("row_key")] if key_col else []))
    seeds = stored(texts.mapInArrow(_seeds(window, lengths, bitmap, bool(key_col)), _SEEDS), "document-seeds")
    hits = (seeds.where("hash is not null").join(item_seeds, ["length", "hash"])
            .select("row_key", "item_id", "length", "at", "context", "offset", "item_context", "item_offset")
            .mapInArrow(_extend, "row_key long, item_id long, start long, end long"))
    hits = stored(hits, "hits")
    spans = (hits.select("row_key", "start", "end").distinct().groupBy("row_key")
             .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda acc, s: F.struct(
            (acc.n + F.greatest(F.lit(0), s.end - F.greatest(s.start, acc.upto))).cast("long").alias("n"),
            F.greatest(acc.upto, s.end).alias("upto")),
        lambda acc: acc.n)
    found = (hits.select("row_key", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("row_key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    hit = spans.select("row_key", covered.alias("n_hit")).join(found, "row_key")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return seeds.where("n_words is not null").select("row_key", "doc_id", "n_words").join(hit, "row_key", "left").select(
        *([F.col("row_key").alias(key_col)] if key_col else []), "doc_id", "n_words", n_hit.alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
