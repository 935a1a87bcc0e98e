"""Phrase collocation mining by relational set-oriented mining (SETM).

Texts become a sorted occurrence relation (piece, position, group): first every word is a group of its own. One level
of the mining

1. merge-joins the relation with itself on piece and adjacent position: two occurrences of k words that start at
   neighbouring positions are one occurrence of k + 1 words, a new group (the first level takes the words as they are),
2. counts the groups (partial counts per pack of text, summed per bucket of the hash space),
3. semi-joins the joined relation with the frequent groups,

and stores what is left for the next level. A group that is not frequent is gone before anything is extended by it.

The relation is kept pack by pack in columns: ``slots`` has one entry for each position of the pack's pieces in order
(a break between pieces is a position without a group), so that the merge-join compares neighbours. Groups are numbered
inside a pack, frequent ones first; between packs they are told apart by 80 bits of hash of language and words (at 10^10
distinct groups two of them agree with a chance below 10^-4). A group moves once per pack and level, however often it occurs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewkit.llm.packs import planes, shuffle_partitions, unplanes
from reviewkit.llm.words import WordIds, mix, rolling, texts
from reviewkit.operators.joins import materialize
from reviewkit.session import ship_package

#: Text bytes of a pack, and the longest stretch of one text that is split into words at once.
PACK_BYTES = 16_000_000
SLICE_BYTES = 2_000_000
#: Bytes of keys a bucket aims at.
BUCKET_BYTES = 16_000_000
#: Characters that end a piece: . , ; : ! ? and line breaks (fixed by the contract).
BREAK_BYTES = b".,;:!?\x0a\x0b\x0c\x0d"
#: Stands for a break: a byte that no UTF-8 text holds.
BREAK = b"\xff"

_TO_BREAK = bytes.maketrans(BREAK_BYTES, BREAK * len(BREAK_BYTES))
_TOKEN = re.compile(rb"[^\x20\x09\xff]+|\xff")

RELATION = ("pack long, lang string, k int, n_own long, words binary, n_groups long, groups binary, slots binary, "
            "context binary, phrase string, a long")
ASKED = "bucket int, pack long, keys binary, counts binary"
JUDGED = "pack long, bucket int, frequent binary, named binary, totals binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


_RELATION, _ASKED, _JUDGED = _schema(RELATION), _schema(ASKED), _schema(JUDGED)


def _pressed(a: np.ndarray) -> bytes:
    """Numbers as compressed byte planes, after their count and width."""
    head = np.array([len(a), a.dtype.itemsize], np.int64).tobytes()
    return head + pa.compress(planes(a), "zstd", asbytes=True) if len(a) else head


def _unpressed(b: bytes, kind: type) -> np.ndarray:
    n, wide = np.frombuffer(b[:16], np.int64).tolist()
    return unplanes(pa.decompress(b[16:], n * wide, "zstd", asbytes=True), kind) if n else np.empty(0, kind)


def press_keys(low: np.ndarray, high: np.ndarray) -> bytes:
    """Keys sorted by ``low``: its differences and ``high`` as byte planes."""
    return pa.compress(planes(np.diff(low, prepend=np.uint64(0))) + planes(high), "zstd", asbytes=True)


def unpress_keys(b: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    b = pa.decompress(b, 10 * n, "zstd", asbytes=True)
    return np.cumsum(unplanes(b[:8 * n], np.uint64), dtype=np.uint64), unplanes(b[8 * n:], np.uint16)


def _press_words(words: list[bytes]) -> bytes:
    body = b" ".join(words)
    return np.array([len(body)], np.int64).tobytes() + pa.compress(body, "zstd", asbytes=True) if words else b""


def _unpress_words(b: bytes) -> list[bytes]:
    if not b:
        return []
    return pa.decompress(b[8:], int(np.frombuffer(b[:8], np.int64)[0]), "zstd", asbytes=True).split(b" ")


def slices(text: bytes, width: int, size: int = SLICE_BYTES) -> Iterator[tuple[list[bytes], int]]:
    """(words and breaks, how many of the last of them only give context) of a text, about ``size`` bytes at a time.

    A text is cut at a break where it has one; else between two words, and then the words up to ``width - 1`` behind the cut
    are repeated as context, so that every phrase of up to ``width`` words starts in just one slice and is whole there.
    """
    body, at = text.lower().translate(_TO_BREAK), 0
    while len(body) - at > size:
        end = body.rfind(BREAK, at, at + size)
        if end > at:
            yield body[at:end].replace(BREAK, b" \xff ").split(), 0
            at = end + 1
            continue
        end = max(body.rfind(b" ", at, at + size), body.rfind(b"\t", at, at + size))
        if end <= at:  # one very long word: up to its end
            end = next((m.start() for m in re.compile(rb"[\x20\x09\xff]").finditer(body, at + size)), len(body))
        behind: list[bytes] = []
        for m in _TOKEN.finditer(body, end):
            if m[0] == BREAK or len(behind) == width - 1:
                break
            behind.append(m[0])
        yield body[at:end].replace(BREAK, b" \xff ").split() + behind, len(behind)
        at = end
    yield body[at:].replace(BREAK, b" \xff ").split(), 0


class _Pack:
    """The words of one language gathered from some texts."""

    def __init__(self) -> None:
        self.ids = WordIds()
        self.ids.ids([BREAK])  # number 0
        self.held: list[np.ndarray] = []
        self.context: list[np.ndarray] = []
        self.size = 0

    def add(self, tokens: list[bytes], context: int) -> None:
        ids = self.ids.ids(tokens)
        self.held += [ids.astype(np.int32), np.zeros(1, np.int32)]
        if context:
            end = self.size + len(ids)
            self.context.append(np.arange(end - context, end, dtype=np.int32))
        self.size += len(ids) + 1

    def row(self, pack: int, lang: str) -> dict:
        slots = np.concatenate(self.held) - 1 if self.held else np.empty(0, np.int32)
        context = np.concatenate(self.context) if self.context else np.empty(0, np.int32)
        groups, slots = by_count(np.arange(len(self.ids) - 1, dtype=np.int32)[:, None], slots)
        return _relation_row(pack, lang, 1, int((slots >= 0).sum()) - len(context), list(self.ids)[1:], groups, slots, context, len(groups))


def by_count(groups: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same relation with the most frequent groups first, so that most numbers are small."""
    order = np.argsort(-np.bincount(slots[slots >= 0], minlength=len(groups)), kind="stable")
    number = np.full(len(groups) + 1, -1, np.int32)  # the last entry serves the positions without a group
    number[order] = np.arange(len(groups), dtype=np.int32)
    return groups[order], number[slots]


def _relation_row(pack: int, lang: str, k: int, n_own: int | None, words: list[bytes], groups: np.ndarray, slots: np.ndarray,
                  context: np.ndarray, n_groups: int) -> dict:
    """A stored row that level ``k`` begins with; ``n_groups`` groups are to be counted there."""
    return {"pack": pack, "lang": lang, "k": k, "n_own": n_own, "words": _press_words(words), "n_groups": n_groups,
            "groups": _pressed(groups.astype(np.int32).ravel()), "slots": _pressed((slots + 1).astype(np.uint32)),
            "context": _pressed(context.astype(np.int32)), "phrase": None, "a": None}


def _batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _words_relation(docs: DataFrame, width: int) -> DataFrame:
    """The first relation: every word is a group. One row per language and pack; the texts are not shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, packs, held = TaskContext.get().partitionId() << 32, {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, packs, held
            for lang, p in packs.items():
                yield from _batches([p.row(first, lang)], _RELATION)
                first += 1
            packs, held = {}, 0

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                for tokens, context in slices(text, width):
                    packs.setdefault(lang, _Pack()).add(tokens, context)
                    held += sum(map(len, tokens)) + len(tokens)
                    if held >= PACK_BYTES:
                        yield from flush()
        yield from flush()

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, RELATION)


class _Relation:
    """One stored row, unpacked and joined for its level: its groups' hashes in bucket order."""

    def __init__(self, row: dict, buckets: int) -> None:
        self.pack, self.lang, self.k = row["pack"], row["lang"], row["k"]
        self.words = _unpress_words(row["words"])
        self.groups = _unpressed(row["groups"], np.int32).reshape(-1, max(self.k - 1, 1))
        self.slots = _unpressed(row["slots"], np.uint32).astype(np.int32) - 1
        if self.k > 1:
            self.groups, self.slots = extend(self.groups, self.slots)
        self.context = _unpressed(row["context"], np.int32)
        names = WordIds()
        names.ids(self.words)
        h1, h2 = names.hashes() if self.words else (np.empty(0, np.uint64),) * 2
        seed = xxhash.xxh3_64_intdigest(self.lang.encode())
        n = len(self.groups)
        key = [mix(rolling(h[self.groups].ravel(), self.k)[::self.k][:n] + np.uint64(seed)) if n else h[:0] for h in (h1, h2)]
        low, high = key
        bucket = ((low >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        self.order = np.lexsort((low, bucket))  # sorted keys inside each bucket
        self.low, self.high = low[self.order], (high[self.order] >> np.uint64(48)).astype(np.uint16)
        self.ends = np.searchsorted(bucket[self.order], np.arange(buckets + 1))

    def counts(self) -> np.ndarray:
        """Own occurrences of each group, in bucket order; a group seen as context only has none."""
        own = self.slots.copy()
        own[self.context] = -1
        return np.bincount(own[own >= 0], minlength=len(self.groups))[self.order]


def _asked(rel: DataFrame, buckets: int) -> DataFrame:
    """Distinct groups of every pack with their counts, one array per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                r = _Relation(row, buckets)
                counts, out = r.counts(), []
                for k in np.flatnonzero(np.diff(r.ends)).tolist():
                    s = slice(r.ends[k], r.ends[k + 1])
                    out.append({"bucket": k, "pack": r.pack, "keys": press_keys(r.low[s], r.high[s]),
                                "counts": _pressed(counts[s].astype(np.int32))})
                yield from _batches(out, _ASKED)

    return rel.mapInArrow(run, ASKED)


def judge(keys: list[bytes], counts: list[np.ndarray], least: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each array of distinct keys: which are frequent in all arrays together; the places it is to name and their totals.

    The first array that holds a frequent key names it.
    """
    sizes = np.array([len(c) for c in counts])
    low, high = map(np.concatenate, zip(*map(unpress_keys, keys, sizes.tolist())))
    n = np.concatenate(counts).astype(np.int64)
    order = np.lexsort((high, low))  # stable: the earliest array comes first among equals
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    total = np.add.reduceat(n[order], np.flatnonzero(new))
    ok = np.empty(len(order), bool)
    ok[order] = np.repeat(total >= least, np.diff(np.append(np.flatnonzero(new), len(order))))
    firsts = np.sort(order[new][total >= least])
    sums = np.zeros(len(order), np.int64)
    sums[order[new]] = total
    out, at = [], 0
    for size in sizes.tolist():
        mine = firsts[np.searchsorted(firsts, at):np.searchsorted(firsts, at + size)]
        out.append((ok[at:at + size], (mine - at).astype(np.int32), sums[mine]))
        at += size
    return out


def _judged(asked: DataFrame, least: int) -> DataFrame:
    """Answers to the packs: which of the asked groups are frequent, and which of them the pack names."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pack")
        at, packs = table.column("bucket")[0].as_py(), table.column("pack").to_pylist()
        found = judge(table.column("keys").to_pylist(), [_unpressed(c, np.int32) for c in table.column("counts").to_pylist()], least)
        return pa.Table.from_pylist([
            {"pack": p, "bucket": at, "frequent": np.packbits(ok).tobytes(), "named": _pressed(mine), "totals": _pressed(sums)}
            for p, (ok, mine, sums) in zip(packs, found) if ok.any()], schema=_JUDGED)

    return asked.groupBy("bucket").applyInArrow(run, JUDGED)


def extend(groups: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge-join of a relation with itself on piece and adjacent position: groups and slots one word longer."""
    at = np.flatnonzero((slots[:-1] >= 0) & (slots[1:] >= 0))
    out = np.full(len(slots), -1, np.int32)
    if not len(at):
        return np.empty((0, groups.shape[1] + 1), np.int32), out
    pairs, out[at] = np.unique(slots[at].astype(np.int64) * len(groups) + slots[at + 1], return_inverse=True)
    left, right = np.divmod(pairs, len(groups))
    return by_count(np.concatenate([groups[left], groups[right][:, -1:]], 1), out)


def _extended(rel: DataFrame, judged: DataFrame, buckets: int, width: int) -> DataFrame:
    """Frequent groups by name, and the relation semi-joined with them for the next level (none beyond ``width`` words)."""

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[dict] = []
        for row in rows.to_pylist() if answers.num_rows else []:
            r = _Relation(row, buckets)
            frequent = np.zeros(len(r.groups), bool)
            for a in answers.to_pylist():
                s = slice(r.ends[a["bucket"]], r.ends[a["bucket"] + 1])
                mine = r.order[s]
                frequent[mine] = np.unpackbits(np.frombuffer(a["frequent"], np.uint8), count=len(mine)).astype(bool)
                named = mine[_unpressed(a["named"], np.int32)]
                out += [{"lang": r.lang, "k": r.k, "a": n, "phrase": b" ".join(r.words[w] for w in g).decode(errors="replace")}
                        for g, n in zip(r.groups[named].tolist(), _unpressed(a["totals"], np.int64).tolist())]
            if r.k < width:
                there = np.zeros(len(r.slots) + 2, bool)
                there[1:-1] = (r.slots >= 0) & frequent[r.slots]
                # An occurrence without a neighbour has nothing to be joined with.
                slots = np.where(there[1:-1] & (there[:-2] | there[2:]), r.slots, -1)
                left, slots = np.unique(slots, return_inverse=True)
                groups, slots = by_count(r.groups[left[left >= 0]], slots.astype(np.int32) - int(left[0] < 0))
                n = len(extend(groups, slots)[0])
                if n:
                    used = np.unique(groups)
                    out.append(_relation_row(r.pack, r.lang, r.k + 1, None, [r.words[w] for w in used.tolist()],
                                             np.searchsorted(used, groups), slots, r.context, n))
        return pa.Table.from_pylist(out, schema=_RELATION)

    return rel.groupBy("pack").cogroup(judged.groupBy("pack")).applyInArrow(run, RELATION)


def frequent_phrases(docs: DataFrame, least: int = 100, width: int = 5) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, a) of all phrases of up to ``width`` words with ``least`` occurrences; (lang, n) words in all.

    Both are stored tables. One round per phrase length.
    """
    ship_package(docs.sparkSession)
    rel, found = materialize(_words_relation(docs, width)), None
    words = rel.groupBy("lang").agg(F.sum("n_own").alias("n")).where("n > 0")
    for k in range(1, width + 1):
        keys = rel.agg(F.sum("n_groups")).first()[0] or 0
        buckets = max(shuffle_partitions(docs), math.ceil(16 * keys / BUCKET_BYTES))
        level = materialize(_extended(rel, _judged(_asked(rel, buckets), least), buckets, width))
        named = level.where("phrase is not null").select("lang", "k", "phrase", "a")
        found = named if found is None else found.unionByName(named)
        rel = level.where("n_groups is not null")
    return found, words


def score_phrases(found: DataFrame, words: DataFrame, share: int = 100) -> DataFrame:
    """Candidates (lang, k, phrase, a, l, r, n, score) that no longer candidate covers.

    The parts of a frequent phrase are frequent, so both parts of every cut are in ``found``. A longer candidate that
    covers a phrase holds one that is just one word longer and at least as frequent, so only those are compared.
    """
    w = F.split("phrase", " ")
    text = lambda of, a, n: F.array_join(F.slice(of, a, n), " ")
    long = found.where("k > 1").withColumn("w", w)
    cuts = long.select("lang", "k", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "k", "phrase", "a", "cut", text(F.col("w"), F.lit(1), F.col("cut")).alias("first"),
                       text(F.col("w"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    part = found.select("lang", "phrase", "a")
    cuts = (cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
            .join(part.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
            .join(F.broadcast(words), "lang"))  # one row per language
    # Exact: both products have 38 digits.
    scored = cuts.withColumn("score", F.expr(
        "(cast(1000 * a as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    best = scored.groupBy("lang", "phrase", "k", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    covers = long.select("lang", F.col("a").alias("longer"), F.explode(F.array(
        text(F.col("w"), F.lit(1), F.col("k") - 1), text(F.col("w"), F.lit(2), F.col("k") - 1))).alias("phrase"))
    covers = covers.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = best.join(covers, ["lang", "phrase"], "left").where(
        "longer is null or cast(100 * longer as decimal(38,0)) < cast(a as decimal(19,0)) * " + str(int(share)))
    return left.select("lang", "k", "phrase", "a", "b.l", "b.r", "n", "b.score")


def mine_phrases(docs: DataFrame, least: int = 100, width: int = 5, share: int = 100, top: int = 2000) -> DataFrame:
    """Each language's ``top`` collocations by score: lang, rank, phrase, a, l, r, n, score.

    ``docs`` needs ``lang`` and ``text``. A text is lower-cased (A-Z) and split at ``[.,;:!?]`` and line breaks into pieces and those
    at spaces and tabs into words. Candidates are phrases of 2 to ``width`` words with ``least`` or more occurrences ``a`` inside
    pieces, overlaps included. l and r are the occurrences of the two parts at the cut with the lowest score, the
    first such cut; n is the number of words of the language. Candidates inside a longer one that has ``share`` percent of their
    occurrences are left out. Rank is by score, a (both descending), phrase (bytes).

    A null text is empty, a null lang is ``und``; texts without words, and languages without candidates, give no rows. Repeated
    rows count each. Extra columns are ignored. An empty table gives an empty result. Long texts are cut into slices that
    repeat the few words behind the cut.

    Scale: the texts are read once and never shuffled. A level moves each pack's distinct groups, and its relation by pack;
    both shrink with the level. Buckets are sized by the counted keys. No group of rows grows with a hot word, phrase or
    language: only the last ranking is by language, after each language was cut to ``top`` in parts.
    """
    found, words = frequent_phrases(docs, least, width)
    scored = materialize(score_phrases(found, words, share))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = scored.withColumn("part", part).withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = first.where(F.col("at") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
