"""Conversation repair against an enumeration of all edits, and its SQL twin."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from reviewkit.llm.queries import _repair_sql
from reviewkit.llm.turn_repair import apply_audit, repair_chats, search

SHAPE = re.compile("(s?(ua)+)?")
COLUMNS = "conv_id long, turn long, role string, text string, audit string"


def enumerated(rows, inserts=2):
    """All edit strings with up to ``inserts`` insertions before, between and after the rows."""
    best = None
    gaps = [["", *("".join(x) for n in range(1, inserts + 1) for x in itertools.product("ua", repeat=n))]] * (len(rows) + 1)
    choices = [[("D", "", 4)] + ([(f, c, w + 3 * (fault == 3)) for f, c, w in (("K", ch, 0), ("R", "u", 3), ("R", "a", 3))]
                                 if fault in (0, 3) else []) for ch, fault in rows]
    for ins in itertools.product(*gaps):
        for edits in itertools.product(*choices):
            roles = ins[0] + "".join(c + i for (_, c, _), i in zip(edits, ins[1:]))
            if all(c for f, c, _ in edits if f == "K") and SHAPE.fullmatch(roles):
                audit = "I" * len(ins[0]) + "".join(f + "I" * len(i) for (f, _, _), i in zip(edits, ins[1:]))
                label = (sum(w for *_, w in edits) + 3 * sum(map(len, ins)), audit)
                best = label if best is None else min(best, label)
    return best


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def least(rows):
    """Cheapest and least audit by labels (cost, audit) of every state, row after row."""
    step = {0: "u", 1: "u", 2: "a", 3: "u"}
    to = {"s": 1, "u": 2, "a": 3}

    def filled(at):
        for _ in range(3):
            for q, (c, a) in list(at.items()):
                t = to[step[q]]
                at[t] = min(at.get(t, (c + 3, a + "I")), (c + 3, a + "I"))
        return at

    at = filled({0: (0, "")})
    for ch, fault in rows:
        new = {}
        for q, (c, a) in at.items():
            more = 3 * (fault == 3)
            moves = [(q, c + 4, a + "D")]
            if fault in (0, 3):
                moves.append((to[step[q]], c + 3 + more, a + "R"))
                if ch == step[q] or (ch == "s" and q == 0):
                    moves.append((to[ch], c + more, a + "K"))
            for t, *label in moves:
                new[t] = min(new.get(t, tuple(label)), tuple(label))
        at = filled(new)
    return min(at[q] for q in (0, 3) if q in at)


def plain(rows, damage=True):
    out, ids = [], {c for c, *_ in rows}
    after = plain_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in ids:
        mine = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        codes, seen = [], set()
        for _, role, text in mine:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            codes.append((role[:1], 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0))
            seen.add((role, text))
        cost, audit = least(codes)
        fixed = apply_audit(audit, [r[1:] for r in mine])
        turns = [t for t, *_ in mine if t is not None]
        f = [x for _, x in codes]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count(1), f.count(2), f.count(3), illegal, cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
        assert SHAPE.fullmatch("".join(r[0] for r, _ in fixed))
    return sorted(out, key=str)


def chats(seed=5, n=300):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "usher"]
    said = ["Hi.", "Yes!", "no", " ", "", None, " ", "Was? \t\n", "A.b", "é…", "x\r\n.\x0b", "\x1c"]
    rows = [(rng.choice([*range(40), None]), rng.choice([*range(8), None]), rng.choice(roles), rng.choice(said)) for _ in range(n)]
    rows += [(1, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(10, 210)]  # a third of all rows in one conversation
    rows += [(50, 2 ** 40, "user", "far."), (50, -3, "user", "x" * 30_000)]
    return rows + [r for r in rows[:20]] + [(i, 0, "assistant", "One?") for i in range(100, 160)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], COLUMNS).repartition(3)


def test_search_finds_the_least_of_all_edits():
    rng = random.Random(2)
    for _ in range(250):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "x", ""]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 3))]
        assert search(rows) == enumerated(rows) == least(rows), rows


def test_search_equals_labels_on_longer_chats():
    rng = random.Random(3)
    for n in range(400):
        rows = [(rng.choice("suax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 60))]
        assert search(rows) == least(rows), rows


def test_a_very_long_conversation():
    rows = [("ua"[i % 2], 0) for i in range(40_000)]
    assert search(rows) == (0, "K" * 40_000)
    assert search(rows[1:])[0] == 3


@pytest.mark.parametrize("damage", [True, False])
def test_chats_equal_plain_version(spark, damage):
    rows = chats()
    got = repair_chats(frame(spark, rows), damage)
    assert sorted((tuple(r)[:9] for r in got.collect()), key=str) == plain(rows, damage)


def test_dropped_conversations_and_empty_tables(spark):
    key = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    got = repair_chats(frame(spark, [(9, key, "user", "gone.")]), True).collect()
    assert [tuple(r)[:9] for r in got] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair_chats(frame(spark, []), True).collect() == []


def test_sql_says_the_same():
    rows = chats()
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r) for r in rows])
    assert sorted(con.execute(_repair_sql()).fetchall(), key=str) == plain(rows)
