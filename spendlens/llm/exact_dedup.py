"""Exact deduplication of texts by Grace hash partitioning.

Two rounds of the same task-side algorithm:

1. Every input partition is deduplicated where it lies, so a text that a third of all
   rows hold leaves each task once.
2. The representatives are partitioned by the digest of their text and deduplicated again.

A task keeps an open-addressing table of complete contents within a byte budget. While
there is room a new content takes a slot. Afterwards the table is frozen: records equal to
one of its contents are still absorbed, the others go to spill files chosen by a digit of
their hash, and each file is treated the same way with the next digit. Equality is always
decided on the complete content, never on the hash.

Defined cases: null text counts as empty; a row with a null id stays only if its whole
group has null ids; of repeated rows (equal text and id) one stays; an empty table gives an
empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import small_batches, stored, utf8

#: Bytes of content that one task's table may hold.
TABLE_BYTES = 64 << 20
FANOUT = 16
NO_ID = (1 << 63) - 1

_HEAD = struct.Struct("<QqqqqI")


class Entry:
    """One distinct content of a table, with what is known of the rows that hold it."""

    __slots__ = ("content", "digest", "key", "least", "least_key", "rows", "members")

    def __init__(self, content: bytes, digest: int, key: int):
        self.content, self.digest, self.key = content, digest, key
        self.least, self.least_key, self.rows, self.members = NO_ID, NO_ID, 0, []


class ContentTable:
    """Open addressing with linear probing over (hash, complete content)."""

    def __init__(self, budget: int):
        self.budget, self.used, self.entries = budget, 0, []
        self.mask = 1023
        self.slots = [-1] * 1024

    def find(self, digest: int, content: bytes) -> tuple[int, Entry | None]:
        at = digest & self.mask
        while (e := self.slots[at]) >= 0:
            entry = self.entries[e]
            if entry.digest == digest and entry.content == content:
                return at, entry
            at = (at + 1) & self.mask
        return at, None

    def full(self, content: bytes) -> bool:
        return bool(self.entries) and self.used + len(content) + 200 > self.budget

    def insert(self, at: int, entry: Entry) -> None:
        self.slots[at] = len(self.entries)
        self.entries.append(entry)
        self.used += len(entry.content) + 200
        if 2 * len(self.entries) > self.mask:
            self.mask = 2 * self.mask + 1
            self.slots = [-1] * (self.mask + 1)
            for e, x in enumerate(self.entries):
                at = x.digest & self.mask
                while self.slots[at] >= 0:
                    at = (at + 1) & self.mask
                self.slots[at] = e


Record = tuple[int, int, int, int, int, bytes]  # digest, key, least id, least key, rows, content


def _spilled(path: str) -> Iterator[Record]:
    with open(path, "rb") as file:
        while head := file.read(_HEAD.size):
            *fields, size = _HEAD.unpack(head)
            yield (*fields, file.read(size))


def grace(records: Iterator[Record], budget: int, folder: str, hold_members: bool, depth: int = 0):
    """Yields ``(key, least, entry)`` for every record as it is matched and ``(None, None, entry)`` per finished entry."""
    contents = ContentTable(budget)
    files, paths = {}, []
    frozen = False
    for digest, key, least, least_key, rows, content in records:
        at, entry = contents.find(digest, content)
        if entry is None:
            frozen = frozen or contents.full(content)
            if frozen:
                # the hash's low bits choose slots, so digits are taken from the top
                digit = (digest >> (60 - 4 * (depth % 16))) % FANOUT
                if digit not in files:
                    paths.append(os.path.join(folder, f"{depth}-{len(os.listdir(folder))}-{digit}"))
                    files[digit] = open(paths[-1], "wb")  # noqa: SIM115
                files[digit].write(_HEAD.pack(digest, key, least, least_key, rows, len(content)) + content)
                continue
            contents.insert(at, entry := Entry(content, digest, key))
        if (least, least_key) < (entry.least, entry.least_key):
            entry.least, entry.least_key = least, least_key
        entry.rows += rows
        if hold_members:
            entry.members.append(key)
        yield key, least, entry
    for entry in contents.entries:
        yield None, None, entry
    del contents
    for file in files.values():
        file.close()
    for path in paths:
        yield from grace(_spilled(path), budget, folder, hold_members, depth + 1)
        os.unlink(path)


_LOCAL = pa.schema([("row_key", pa.int64()), ("doc_id", pa.int64()), ("rep_key", pa.int64()), ("rows", pa.int64()),
                    ("least", pa.int64()), ("least_key", pa.int64()), ("digest", pa.string()), ("content", pa.binary())])
_MERGED = pa.schema([("rep_key", pa.int64()), ("keep_id", pa.int64()), ("keep_key", pa.int64()),
                     ("group_size", pa.int64()), ("text_sha256", pa.string())])
_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def normalised(text: bytes) -> bytes:
    """Each run of ASCII white space becomes one space."""
    words = b" ".join(text.split())
    if not words:
        return b" " if text else b""
    return b" " * (text[0] in _BLANKS) + words + b" " * (text[-1] in _BLANKS)


def _rows_of(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows gathered to batches of bounded size; a bytes value, if any, is the last of a row."""
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    for row in rows:
        held.append(row)
        size += 64 + (len(row[-1]) if isinstance(row[-1], bytes) else 0)
        if size > most_bytes:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _first_round(budget: int, normalise: Callable[[bytes], bytes], keyed: bool):
    """Deduplicates an input partition: a row per record, and one more per distinct content."""

    def run(batches):
        start = TaskContext.get().partitionId() << 40

        def records():
            for key, (doc_id, text, *own) in enumerate(_rows_of(batches), start):
                key = own[0] if keyed else key
                content = normalise(text)
                digest = int.from_bytes(hashlib.sha256(content).digest()[:8], "big")
                yield digest, key, NO_ID if doc_id is None else doc_id, key, 1, content

        with tempfile.TemporaryDirectory() as folder:
            yield from _batches((
                (key, None if least == NO_ID else least, entry.key, None, None, None, None, None) if key is not None else
                (None, None, entry.key, entry.rows, entry.least, entry.least_key,
                 hashlib.sha256(entry.content).hexdigest(), entry.content)
                for key, least, entry in grace(records(), budget, folder, hold_members=False)), _LOCAL)

    return run


def _second_round(budget: int):
    """Deduplicates representatives: a row for each, with its whole group's result."""

    def run(batches):
        records = ((int(digest[:16], 16), key, least, least_key, rows, content)
                   for key, rows, least, least_key, digest, content in _rows_of(batches))
        with tempfile.TemporaryDirectory() as folder:
            yield from _batches((
                (member, None if entry.least == NO_ID else entry.least, entry.least_key, entry.rows, sha)
                for key, _, entry in grace(records, budget, folder, hold_members=True) if key is None
                for sha in [hashlib.sha256(entry.content).hexdigest()]
                for member in entry.members), _MERGED)

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES,
                normalise: Callable[[bytes], bytes] = normalised, key_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    ``key_col``: a unique long that is never null; it comes first in the result."""
    small_batches(docs.sparkSession)
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("content"),
                      *([F.col(key_col).alias("row_key")] if key_col else []))
    local = stored(ids.mapInArrow(_first_round(table_bytes, normalise, bool(key_col)),
                                  "row_key long, doc_id long, rep_key long, rows long, least long, least_key long, "
                                  "digest string, content binary"), "exact-dedup")
    merged = (local.where("digest is not null")
              .select("rep_key", "rows", "least", "least_key", "digest", "content")
              .repartition(F.col("digest"))
              .mapInArrow(_second_round(table_bytes), "rep_key long, keep_id long, keep_key long, group_size long, "
                                                      "text_sha256 string"))
    members = local.where("row_key is not null").select("row_key", "doc_id", "rep_key")
    return members.join(merged, "rep_key").select(
        *([F.col("row_key").alias(key_col)] if key_col else []), "doc_id", "keep_id", "group_size", (F.col("row_key") == F.col("keep_key")).alias("kept"), "text_sha256")
