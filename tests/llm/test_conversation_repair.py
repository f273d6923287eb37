import hashlib
import random
import zlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from spendlens.llm import conversation_repair as C
from spendlens.llm import queries

WHITE = " \t\n\x0b\f\r"


def well_formed(initials):
    """Fullmatch of (s?(ua)+)? on a list of initials."""
    rest = initials[1:] if initials[:1] == ["s"] else initials
    return not initials or (len(rest) > 0 and len(rest) % 2 == 0 and all(x == "ua"[i % 2] for i, x in enumerate(rest)))


def all_ways(rows):
    """(cost, audit, repaired) of the best of all edit sequences, enumerated (small inputs): rows are (role, text, fault)."""
    best = None
    most = 4 * len(rows)  # deleting everything is always allowed

    def go(i, cost, audit, kept, inserted):
        nonlocal best
        if cost > (most if best is None else best[0]):
            return
        if i == len(rows):
            if well_formed([r[:1] for r, _ in kept]):
                found = (cost, audit, kept)
                best = found if best is None or found[:2] < best[:2] else best
        else:
            role, text, fault = rows[i]
            go(i + 1, cost + 4, audit + "D", kept, 0)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                go(i + 1, cost + more, audit + "K", [*kept, (role, text)], 0)
                for new in ("user", "assistant"):
                    go(i + 1, cost + 3 + more, audit + "R", [*kept, (new, text)], 0)
        if inserted < 1 or i == len(rows) and inserted < 2:
            for new in ("user", "assistant"):
                go(i, cost + 3, audit + "I", [*kept, (new, "")], inserted + 1)

    go(0, 0, "", [], 0)
    return best


def by_table(rows):
    """(cost, audit, repaired) by a forward table of the least (cost, audit) per grammar state; any length."""
    need = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    now = {0: (0, "", [])}

    def put(to, state, found):
        if state not in to or found[:2] < to[state][:2]:
            to[state] = found

    def inserts(states):
        for _ in range(2):
            for s, (c, a, k) in list(states.items()):
                put(states, after[s], (c + 3, a + "I", [*k, (need[s], "")]))

    for role, text, fault in rows:
        inserts(now)
        new = {}
        for s, (c, a, k) in now.items():
            put(new, s, (c + 4, a + "D", k))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if role[:1] == "s" and s == 0:
                put(new, 1, (c + more, a + "K", [*k, (role, text)]))
            elif role[:1] == need[s][0]:
                put(new, after[s], (c + more, a + "K", [*k, (role, text)]))
            put(new, after[s], (c + 3 + more, a + "R", [*k, (need[s], text)]))
        now = new
    inserts(now)
    return min((now[s] for s in (0, 3) if s in now), key=lambda f: f[:2])


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        words = text.rstrip(WHITE)
        out.append((role, text, "blank" if not words else "duplicate" if (role, text) in seen else
                    "" if words[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    return out


def slow(table, best=by_table):
    """(conv_id, turn, role, text) rows -> sorted reports."""
    by = {}
    for conv, turn, role, text in table:
        rows = by.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in rows if t is not None]
        f = faults([r[1:] for r in rows])
        kinds = [x[2] for x in f]
        initials = [r[1][:1] for r in rows]
        cost, audit, kept = best(f)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"),
                    kinds.count("duplicate"), kinds.count("truncated"),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=str)


def held(df, best=by_table):
    got = C.repair_report(C.damaged(C.turns_of(df)))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == slow(df.select("conv_id", "turn", "role", "text").collect(), best)


def test_whole_tables(spark, small):
    held(small("conversations"))
    held(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))


def test_against_all_ways(spark, small):
    held(small("conversations").where("turn < 2"), all_ways)


ROW = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["", " ", "a.", "b", "c!", "d?\n", "e.x", "."]))


@settings(max_examples=100, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_search_against_all_ways(rows):
    f = faults(rows)
    cost, audit, _ = all_ways(f)
    assert by_table(f)[:2] == (cost, audit)
    names = {"": C.SOUND, "blank": C.BLANK, "duplicate": C.DUPLICATE, "truncated": C.TRUNCATED}
    got = C.Search([(r[:1].encode(), names[x]) for r, _, x in f]).cheapest()
    assert (got[0], "".join(C.EDITS[e] for e in got[1])) == (cost, audit)


def test_search_of_long_conversations():
    rng = random.Random(1)
    for n in (63, 64, 65, 200, 3000, 20_000):
        rows = [(rng.choice(["user", "assistant", "user", "assistant", "system"]), "", rng.choice(["", "", "", "blank", "duplicate", "truncated"]))
                for _ in range(n)]
        names = {"": C.SOUND, "blank": C.BLANK, "duplicate": C.DUPLICATE, "truncated": C.TRUNCATED}
        got = C.Search([(r[:1].encode(), names[x]) for r, _, x in rows]).cheapest()
        if n <= 3000:
            cost, audit, _ = by_table(rows)
            assert (got[0], "".join(C.EDITS[e] for e in got[1])) == (cost, audit)


ODD = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes"), (1, 1, "assistant", "Yes"), (1, 2, None, None), (1, None, "user", "First?"),
       (2, None, None, None), (None, None, None, None), (None, 3, "user", "x."), (None, 3, "assistant", "y."), (3, 7, "", ""),
       (4, 2, "system", "s" * 200_000 + "."), (4, 3, "user", "é漢😀!"), (4, 9, "assistant", " . "), (5, 0, "écho", "q."),
       (5, 1, "user", "\x00."), *[(6, i, ["user", "assistant"][i % 2], f"turn {i}.") for i in range(700)], (-7, -2, "user", "a?"), (-7, 5, "assistant", "b.")]


def test_odd_rows(spark, monkeypatch):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in ODD],
                               "conv_id long, turn long, role string, text string, times int, kind string, place int").repartition(3)
    held(df)
    monkeypatch.setattr(C, "SPOOL", 100)
    conversation = C.Conversation(1)
    for role, text in [(b"user", b"a" * 90 + b"."), (b"assistant", b"b" * 90 + b"."), (b"user", b"c."), (b"assistant", b"d.")]:
        conversation.add(1, role, text)
    assert conversation.spool is not None
    assert conversation.report()[-1] == hashlib.sha256(b"user:" + b"a" * 90 + b".\nassistant:" + b"b" * 90 + b".\nuser:c.\nassistant:d.").hexdigest()


def test_no_rows(spark, small):
    none = small("conversations").limit(0)
    assert C.repair_report(C.damaged(C.turns_of(none))).count() == 0
    assert C.repaired_turns(C.turns_of(none)).count() == 0


def test_repaired_turns(spark, small):
    turns = C.damaged(C.turns_of(small("conversations")))
    rows = {}
    for r in C.repaired_turns(turns).orderBy("conv_id", "place").collect():
        rows.setdefault(r.conv_id, []).append(r)
    for report in C.repair_report(turns).collect():
        left = rows.get(report.conv_id, [])
        assert well_formed([r.role[:1] for r in left])
        assert "".join(r.edit for r in left) == report.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in left).encode()).hexdigest() == report.repaired_sha256


def test_undamaged_rows_of_the_table(spark, small):
    """Without damage, sound conversations are kept as they are."""
    for r in C.repair_report(C.turns_of(small("conversations"))).collect():
        if (r.blank, r.duplicate, r.truncated, r.illegal) == (0, 0, 0, 0) and r.cost == 0:
            assert set(r.audit) <= {"K"}


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    want = con.sql(queries.oracle_sql()["op12_conversation_repair"])
    got = queries.op12_conversation_repair(spark, folder)
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.project(", ".join(names)).fetchall())
