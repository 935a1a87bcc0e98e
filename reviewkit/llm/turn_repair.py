"""Conversation structure repair by a bidirectional Dijkstra search over the edit lattice.

A node of a conversation's lattice is (rows consumed, state): nothing written yet, after a system turn, after a user turn,
after an assistant turn. Edges keep, rerole or delete the next row, or insert an empty turn; the accepted sequences of
role initials are ``(s?(ua)+)?``. A forward heap starts at (0, nothing), a reverse heap at both accepting nodes. They meet;
the search goes on until no crossing of the same cost can be left, and the least audit is read along the edges that
lie on a cheapest path through a crossing.

Spark deals rows by conversation, orders them and finds blank and truncated texts; one task then walks the sorted
rows, a conversation at a time.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewkit.llm.packs import shuffle_partitions
from reviewkit.session import ship_package

#: Costs of the edits, and what a truncated row adds that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing written, after system, after user, after assistant; the role written next in each state.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT_ROLE = ("user", "user", "assistant", "user")
AFTER = {"user": USER, "assistant": ASSISTANT}
ACCEPTED = (START, ASSISTANT)
LEGAL_PAIRS = frozenset(("su", "ua", "au"))
#: A row's faults, as numbers.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)

RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string, repaired array<struct<role:string,text:string>>")


def keeps(initial: str, state: int) -> int | None:
    """State after a kept turn, None where the grammar forbids it."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == NEXT_ROLE[state][0]:
        return AFTER[NEXT_ROLE[state]]
    return None


def edges(rows: list[tuple[str, int]], at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, cost, rows consumed, state) of the edges out of a node, in the letters' order."""
    written = AFTER[NEXT_ROLE[state]]
    if at < len(rows):
        initial, fault = rows[at]
        yield "D", DELETE, at + 1, state
        yield "I", INSERT, at, written
        if fault in (SOUND, CUT_OFF):
            more = TRUNCATED if fault == CUT_OFF else 0
            kept = keeps(initial, state)
            if kept is not None:
                yield "K", KEEP + more, at + 1, kept
            yield "R", REROLE + more, at + 1, written
    else:
        yield "I", INSERT, at, written


#: States from which a turn of a kind leads into a state: (state before, written state).
_BEFORE = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,), SYSTEM: (), START: ()}


def edges_back(rows: list[tuple[str, int]], at: int, state: int) -> Iterator[tuple[int, int, int]]:
    """(cost, rows consumed, state) of the nodes with an edge into this one."""
    for before in _BEFORE[state]:
        yield INSERT, at, before
    if at:
        initial, fault = rows[at - 1]
        yield DELETE, at - 1, state
        if fault in (SOUND, CUT_OFF):
            more = TRUNCATED if fault == CUT_OFF else 0
            if state == SYSTEM and initial == "s":
                yield KEEP + more, at - 1, START
            for before in _BEFORE[state]:
                yield (KEEP if keeps(initial, before) == state else REROLE) + more, at - 1, before


def search(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of (role initial, fault) rows; equal costs give the least audit.

    Memory and time are linear in the nodes but for the heaps' logarithm.
    """
    n = len(rows)
    ahead, back = {(0, START): 0}, {(n, s): 0 for s in ACCEPTED}
    heap_a, heap_b = [(0, 0, START)], [(0, n, s) for s in ACCEPTED]
    done_a, done_b = set(), set()
    best = 0 if not n else None
    while heap_a and heap_b and (best is None or heap_a[0][0] + heap_b[0][0] <= best):
        if heap_a[0][0] <= heap_b[0][0]:
            heap, done, mine, other = heap_a, done_a, ahead, back
        else:
            heap, done, mine, other = heap_b, done_b, back, ahead
        cost, at, state = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        steps = edges_back(rows, at, state) if mine is back else ((w, i, s) for _, w, i, s in edges(rows, at, state))
        for w, i, s in steps:
            if cost + w < mine.get((i, s), cost + w + 1):
                mine[i, s] = cost + w
                heapq.heappush(heap, (cost + w, i, s))
            if (i, s) in other and (best is None or mine[i, s] + other[i, s] < best):
                best = mine[i, s] + other[i, s]
    # All crossings of the least cost; from them back along the forward side's edges without slack.
    crossings = [v for v, cost in ahead.items() if v in back and cost + back[v] == best]
    through, todo = set(crossings), crossings
    while todo:
        at, state = todo.pop()
        for w, i, s in edges_back(rows, at, state):
            if (i, s) in done_a and ahead[i, s] + w == ahead[at, state] and (i, s) not in through:
                through.add((i, s))
                todo.append((i, s))
    audit, cost, v = [], 0, (0, START)
    while v[0] < n or v[1] not in ACCEPTED or cost < best:
        for letter, w, i, s in edges(rows, *v):
            on = (i, s) in through and ahead[i, s] == cost + w
            if on or cost + w + back.get((i, s), best + 1) == best:
                audit.append(letter)
                cost, v = cost + w, (i, s)
                break
    return best, "".join(audit)


def apply_audit(audit: str, turns: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The repaired turns."""
    out, at, state = [], 0, START
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        role, text = NEXT_ROLE[state], ""
        if letter in "KR":
            role, text = (turns[at][0] if letter == "K" else role), turns[at][1]
            at += 1
        state = SYSTEM if state == START and role[:1] == "s" else AFTER[NEXT_ROLE[state]]
        out.append((role, text))
    return out


def damaged(chats: DataFrame) -> DataFrame:
    """Rows after the damage; a dropped row stays as a row with ``there`` false, so that no conversation is lost."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    out = chats.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), (kind != 0).alias("there"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("times"))
    return out.select("*", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times", "col")


def whole(chats: DataFrame) -> DataFrame:
    """Rows as they are: nothing is dropped or damaged."""
    return chats.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.lit(True).alias("there"),
                        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))


def _fault(text: Column) -> Column:
    """Blank or truncated; duplicates are found along the conversation."""
    return (F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK)
            .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT_OFF).otherwise(SOUND))


def repair(conv: int | None, turns: list[tuple[int | None, str, str, int]]) -> dict:
    """The result row of one conversation from its (turn, role, text, fault) rows in order."""
    seen, rows = set(), []
    for _, role, text, fault in turns:
        said = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        rows.append((role[:1], DUPLICATE if fault != BLANK and said in seen else fault))
        seen.add(said)
    cost, audit = search(rows)
    fixed = apply_audit(audit, [(role, text) for _, role, text, _ in turns])
    known = [t for t, *_ in turns if t is not None]
    body = "\n".join(f"{role}:{text}" for role, text in fixed)
    faults = [f for _, f in rows]
    return {"conv_id": conv, "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0, "blank": faults.count(BLANK),
            "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT_OFF),
            "illegal": sum(a + b not in LEGAL_PAIRS for (a, _), (b, _) in zip(rows, rows[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(body.encode("utf-8", "surrogatepass")).hexdigest(),
            "repaired": [{"role": role, "text": text} for role, text in fixed]}


_RESULT = pa.schema([
    ("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])
#: Result rows are passed on when their texts reach this many characters.
OUT_CHARS = 4_000_000


def repair_chats(chats: DataFrame, damage: bool = False) -> DataFrame:
    """Every conversation with its faults and its cheapest repair.

    ``chats`` needs conv_id, turn, role and text. Returns per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 and the repaired turns. With ``damage`` the rows are first damaged by the contract's rule.

    Rows are ordered by turn (nulls first; rows of one turn by role, then text, both by bytes). A row's first fault counts: blank
    (only white space), duplicate (role and text were there before), truncated (does not end with ``.!?``). Kept rows cost 0,
    reroled and inserted ones 3, deleted ones 4 (blank and duplicate rows must go), and a truncated row that stays costs 3 more. The
    cheapest edits give roles that match ``(s?(ua)+)?`` by initials; of several the audit that is least in ASCII is taken.

    A null role or text is one space, as are a null conv_id and turn in the damage's key. A role that begins with none of s, u, a (an
    empty one too) is never kept. Null conv_ids are one conversation. A conversation whose rows are all dropped gives zeros, an
    empty audit and the hash of the empty string. Repeated rows are duplicates. Extra columns are ignored; an empty
    table gives an empty result.

    Scale: one shuffle by conversation, sorted on disk where it must be. A conversation is repaired as a whole, so its
    rows pass one task, which holds the texts of one conversation at a time.
    """
    ship_package(chats.sparkSession)
    rows = damaged(chats) if damage else whole(chats)
    rows = rows.select("conv_id", "turn", "there", "role", "text", _fault(F.col("text")).cast("int").alias("fault"))
    rows = rows.repartition(shuffle_partitions(chats), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, out, held = None, None, [], 0

        def closed() -> None:
            nonlocal held
            out.append(repair(conv, turns))
            held += sum(len(t["text"]) for t in out[-1]["repaired"]) + 1000

        for b in batches:
            for c, turn, there, role, text, fault in zip(*(x.to_pylist() for x in b.columns)):
                if turns is None or c != conv:
                    if turns is not None:
                        closed()
                    conv, turns = c, []
                if there:
                    turns.append((turn, role, text, fault))
            if held >= OUT_CHARS:
                yield pa.RecordBatch.from_pylist(out, schema=_RESULT)
                out, held = [], 0
        if turns is not None:
            closed()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_RESULT)

    return rows.mapInArrow(run, RESULT)
