"""Conversation structure repair by iterative-deepening A*.

Rows of a conversation, in order, are edited to the least cost that gives a well-formed
conversation: nothing, or an optional system turn and then pairs of user and assistant. The
search goes depth first, edits in ASCII order (Delete, Insert, Keep, Rerole), under a cost
bound that grows to the least cost by which the last round failed; so the first path it accepts
is a cheapest one, and of these the ASCII-least. A transposition table holds, for every place
and grammar state, the least cost still to come that failures there have shown; a state is left
at once when what is left of the bound doesn't reach it. The table starts with what faults cost
anyway. In long conversations rounds start at places further and further from the end, so that
each round meets the faults of one stretch only and the whole search stays linear in the rows.

Spark damages the rows, deals them out by conversation and sorts them; a task streams over its
partition, so a conversation's rows are never one value or group in memory: of a row its initial, its
fault and a digest are kept, and texts beyond ``SPOOL`` bytes wait in a temporary file of the
task. The SHA-256 of a conversation is one stream over all its texts, so one conversation is
one task's work whatever its size.

Defined cases: null ids, roles and texts count as one space (a null id is returned as null and
is a conversation of its own), null turns come first; rows of one turn are taken in the order of
role and text (bytes); a role is read by its first character, so an empty one never fits;
repeated rows are duplicates; a conversation all of whose rows are dropped gives zeros, an empty
audit and the hash of the empty string; an empty table gives an empty result; further columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import small_batches, utf8

# fixed values: costs, faults, white space and end marks of the contract
DELETE, INSERT, REROLE, UNFINISHED = 4, 3, 3, 3
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
WHITE, ENDS = b" \t\n\x0b\x0c\r", (b".", b"!", b"?")
LEGAL = (b"su", b"ua", b"au")
EDITS = "DIKR"
#: Grammar states: nothing yet, after the system turn, after a user turn, after a pair.
START, SYSTEM, ASKED, PAIRED = range(4)
KEPT = {(START, b"s"): SYSTEM, (START, b"u"): ASKED, (SYSTEM, b"u"): ASKED, (ASKED, b"a"): PAIRED, (PAIRED, b"u"): ASKED}
#: The role that a state needs next (Insert and Rerole have no choice), and the state after it.
NEXT = {START: (b"user", ASKED), SYSTEM: (b"user", ASKED), ASKED: (b"assistant", PAIRED), PAIRED: (b"user", ASKED)}
#: Rows between the places where rounds start, and bytes of a conversation's texts kept in memory.
STRETCH, SPOOL = 16, 8 << 20


# ------------------------------------------------------------------------------ search
class Search:
    """The cheapest edits of rows given as (role initial, fault)."""

    def __init__(self, rows: list[tuple[bytes, int]]):
        self.rows, n = rows, len(rows)
        self.n = n
        self.least = array("q", bytes(32 * (n + 1)))  # 4 * place + state -> least cost still to come
        for state, cost in ((SYSTEM, 2 * INSERT), (ASKED, INSERT)):
            self.least[4 * n + state] = cost
        self.anyway = array("q", bytes(8 * (n + 1)))  # what the faults from a place on cost whatever the edits
        for i in range(n - 1, -1, -1):
            fault = rows[i][1]
            self.anyway[i] = self.anyway[i + 1] + (0 if fault == SOUND else UNFINISHED if fault == TRUNCATED else DELETE)
            self.least[4 * i:4 * i + 4] = array("q", [self.anyway[i]] * 4)
        self.known = bytearray(4 * (n + 1))  # states whose least cost is exact

    def step(self, edit: int, i: int, state: int) -> tuple[int, int, int] | None:
        """Cost, place and state after an edit, None where it isn't allowed."""
        if edit == 1:
            return INSERT, i, NEXT[state][1]
        if i == self.n:
            return None
        if edit == 0:
            return DELETE, i + 1, state
        initial, fault = self.rows[i]
        if fault in (BLANK, DUPLICATE):
            return None
        more = UNFINISHED if fault == TRUNCATED else 0
        if edit == 2:
            after = KEPT.get((state, initial))
            return None if after is None else (more, i + 1, after)
        return REROLE + more, i + 1, NEXT[state][1]

    def round(self, i: int, state: int, bound: int, through: bool) -> list[int] | None:
        """The first path accepted within the bound, as edits; None if there is none.

        Unless ``through``, a state whose exact cost is known ends the path.
        """
        least = self.least
        path, frames = [], [[i, state, bound, 0, 1 << 60]]
        while frames:
            frame = frames[-1]
            i, state, left, edit, fail = frame
            if edit == 0 and (i == self.n and state in (START, PAIRED) or not through and self.known[4 * i + state]):
                return path
            while edit < 4:
                to = self.step(edit, i, state)
                edit += 1
                if to is None:
                    continue
                cost, j, after = to
                if least[4 * j + after] <= left - cost:
                    frame[3], frame[4] = edit, fail
                    frames.append([j, after, left - cost, 0, 1 << 60])
                    path.append(edit - 1)
                    break
                fail = min(fail, cost + least[4 * j + after])
            else:
                at = 4 * i + state
                least[at] = max(least[at], fail)
                frames.pop()
                if frames:
                    path.pop()
                    up = frames[-1]
                    up[4] = min(up[4], up[2] - left + least[at])
        return None

    def deepened(self, i: int, state: int, through: bool) -> list[int]:
        """Rounds under growing bounds until one accepts; the cost at the start is exact then."""
        at = 4 * i + state
        while True:
            path = self.round(i, state, self.least[at], through)
            if path is not None:
                self.known[at] = 1
                return path

    def cheapest(self) -> tuple[int, list[int]]:
        for i in range(self.n - STRETCH, 0, -STRETCH):
            for state in range(4):
                self.deepened(i, state, through=False)
            # every path passes this place, so places of the next stretch cost as much more as it does
            more = min(self.least[4 * i:4 * i + 4]) - self.anyway[i]
            for at in range(4 * max(0, i - STRETCH), 4 * i):
                self.least[at] += more
        path = self.deepened(0, START, through=True)
        return self.least[START], path


# ----------------------------------------------------------------------- conversations
class Conversation:
    """What is kept of a conversation while its rows stream by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.rows: list[tuple[bytes, int]] = []
        self.seen: set[bytes] = set()
        self.counts = [0, 0, 0, 0]
        self.illegal = 0
        self.low = self.high = None
        self.turns = 0
        self.texts: list[tuple[bytes, bytes]] = []
        self.bytes, self.spool = 0, None

    def add(self, turn, role: bytes, text: bytes) -> None:
        if turn is not None and turn != self.high:  # turns come in order
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        digest = hashlib.blake2b(len(role).to_bytes(8, "little") + role + text, digest_size=16).digest()
        words = text.rstrip(WHITE)
        fault = BLANK if not words else DUPLICATE if digest in self.seen else SOUND if words.endswith(ENDS) else TRUNCATED
        self.seen.add(digest)
        self.counts[fault] += 1
        initial = role.decode("utf-8", "replace")[:1].encode()
        if self.rows and self.rows[-1][0] + initial not in LEGAL:
            self.illegal += 1
        self.rows.append((initial, fault))
        self.bytes += len(role) + len(text)
        self.texts.append((role, text))
        if self.bytes > SPOOL:
            self.spool = self.spool or tempfile.TemporaryFile()
            for part in self.texts:
                for b in part:
                    self.spool.write(len(b).to_bytes(8, "little") + b)
            self.texts, self.bytes = [], 0

    def _turns(self) -> Iterator[tuple[bytes, bytes]]:
        if self.spool:
            self.spool.seek(0)
            read = lambda: self.spool.read(int.from_bytes(size, "little"))
            while size := self.spool.read(8):
                role = read()
                size = self.spool.read(8)
                yield role, read()
        yield from self.texts

    def repaired(self, path: list[int]) -> Iterator[tuple[str, bytes, bytes]]:
        """(edit, role, text) of the turns that the edits leave."""
        turns, state = self._turns(), START
        for edit in path:
            role, after = NEXT[state]
            if edit == 1:
                state = after
                yield "I", role, b""
                continue
            own, text = next(turns)
            if edit == 2:
                state = KEPT[state, own.decode("utf-8", "replace")[:1].encode()]
                yield "K", own, text
            elif edit == 3:
                state = after
                yield "R", role, text

    def report(self) -> tuple:
        cost, path = Search(self.rows).cheapest()
        digest, first = hashlib.sha256(), True
        for _, role, text in self.repaired(path):
            digest.update((b"" if first else b"\n") + role + b":")
            digest.update(text)
            first = False
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.counts[BLANK:], self.illegal, cost, "".join(EDITS[e] for e in path), digest.hexdigest())

    def turns_left(self) -> Iterator[tuple]:
        _, path = Search(self.rows).cheapest()
        for place, (edit, role, text) in enumerate(self.repaired(path)):
            yield self.conv_id, place, edit, role, text


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """The conversations of a sorted partition, one after another."""
    now = None
    for batch in batches:
        for conv_id, turn, role, text, times in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now
                now = Conversation(conv_id)
            for _ in range(times):
                now.add(turn, role, text)
    if now is not None:
        yield now


def _rows(schema: pa.Schema, of, most_bytes: int = 4 << 20):
    """A task that gives the rows ``of`` each conversation, in batches of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for conversation in _conversations(batches):
            for row in of(conversation):
                rows.append(row)
                held += 100 + sum(len(x) for x in row if isinstance(x, (str, bytes)))
                if held > most_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


# ---------------------------------------------------------------------------- operator
def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text (bytes; null as one space), times (1): the rows that the operator takes."""
    blank = lambda c: utf8(F.coalesce(F.col(c).cast("string"), F.lit(" ")))
    return conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                blank(role_col).alias("role"), blank(text_col).alias("text"), F.lit(1).alias("times"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``turns_of`` damaged by crc32(conv_id:turn) % 20; dropped rows stay with ``times`` 0."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text, none = F.col("text"), F.lit("").cast("binary")
    return turns.select("conv_id", "turn", kind.alias("kind"), "role", "text").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 0, none).when(F.col("kind") == 4, F.lit("user").cast("binary")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), none)
        .when(F.col("kind") == 2, F.translate(text.cast("string"), ".!?", "").cast("binary")).otherwise(text).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("times"))


def _dealt(turns: DataFrame) -> DataFrame:
    small_batches(turns.sparkSession)
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def repair_report(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv_id", _arrow(turns, "conv_id")), *((c, pa.int64()) for c in counts),
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return _dealt(turns).mapInArrow(
        _rows(schema, lambda conversation: [conversation.report()]),
        f"conv_id {dict(turns.dtypes)['conv_id']}, {', '.join(f'{c} long' for c in counts)}, audit string, repaired_sha256 string")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""
    schema = pa.schema([("conv_id", _arrow(turns, "conv_id")), ("place", pa.int64()), ("edit", pa.string()),
                        ("role", pa.binary()), ("text", pa.binary())])
    rows = _dealt(turns).mapInArrow(
        _rows(schema, Conversation.turns_left),
        f"conv_id {dict(turns.dtypes)['conv_id']}, place long, edit string, role binary, text binary")
    return rows.withColumns({c: F.col(c).cast("string") for c in ("role", "text")})
