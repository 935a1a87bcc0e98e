"""Substring dedup: repeated fixed-length token windows become removal intervals.

Every window of ``width`` consecutive words of one document is hashed
(Rabin-Karp, 96 bits: a 64-bit and an independent 32-bit polynomial). Documents
lie in packs ordered by id, so "starts in a document with a smaller id" means:
in an earlier pack, or earlier inside the pack. Packs send their distinct window
hashes to hash buckets, the buckets count in which packs a hash starts and answer
with one bit per hash; covered words merge into maximal intervals.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewkit.llm.packs import (hashed_pack, ordered_pack, pack_count, planes,
                                 shuffle_partitions, unplanes)
from reviewkit.llm.words import WordIds, rolling, texts
from reviewkit.session import ship_package

SENT = pa.schema([("bucket", pa.int32()), ("pack", pa.int32()), ("n", pa.int32()),
                  ("h1", pa.binary()), ("h2", pa.binary())])
ANSWER = pa.schema([("pack", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                    ("kept_sha256", pa.string()), ("intervals", pa.list_(pa.list_(pa.int64()))),
                    ("kept_text", pa.string())])
#: Rank of a document without id: after every id, and equal to one another.
NO_ID = np.iinfo(np.int64).max


class _Windows:
    """The documents of one pack, their words and their windows."""

    def __init__(self, table: pa.Table, width: int) -> None:
        ids = table.column("doc_id").to_pylist()
        self.texts = texts(table.column("text"))
        self.ids = ids
        order = sorted(range(len(ids)), key=lambda i: NO_ID if ids[i] is None else ids[i])
        self.order = order
        memo = WordIds()
        self.words = [(self.texts[i] or b"").split() for i in order]
        lengths = np.array([len(w) for w in self.words], np.int64)
        flat = np.concatenate([memo.ids(w) for w in self.words]) if len(order) else np.empty(0, np.int64)
        h1, h2 = memo.hashes()
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        rank = np.array([NO_ID if ids[i] is None else ids[i] for i in order], np.int64)
        doc = np.repeat(np.arange(len(order)), np.maximum(lengths - width + 1, 0))
        skip = np.cumsum(np.concatenate([[0], np.maximum(lengths - width + 1, 0)]))
        #: Start word of each window that lies in one document, and its document's rank.
        self.start = self.first[doc] + np.arange(len(doc)) - skip[doc]
        self.rank = rank[doc]
        w1, w2 = rolling(h1[flat], width)[self.start], rolling(h2[flat], width)[self.start]
        w2 = (w2 >> np.uint64(32)).astype(np.uint32)
        by = np.lexsort((w2, w1))
        w1, w2 = w1[by], w2[by]
        new = np.ones(len(by), bool)
        new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        self.by, self.group = by, np.cumsum(new) - 1
        #: The distinct window hashes, sorted.
        self.h1, self.h2 = w1[new], w2[new]
        heads = np.flatnonzero(new)
        self.least = np.minimum.reduceat(self.rank[by], heads) if len(heads) else self.rank[:0]

    def edges(self, n: int) -> np.ndarray:
        """Where each bucket's hashes begin; bucket = leading part of the 64-bit hash."""
        cuts = np.array([((i << 64) // n) for i in range(1, n)], np.uint64)
        return np.concatenate([[0], np.searchsorted(self.h1, cuts), [len(self.h1)]])


def _send(table: pa.Table, width: int, buckets: int) -> pa.Table:
    pack = table.column("pack")[0].as_py()
    w = _Windows(table, width)
    at = w.edges(buckets)
    out: dict[str, list] = {k: [] for k in SENT.names}
    for b in np.flatnonzero(np.diff(at)):
        lo, hi = at[b], at[b + 1]
        gaps = np.diff(w.h1[lo:hi], prepend=np.uint64(0))
        for k, v in zip(SENT.names, (b, pack, hi - lo, planes(gaps), planes(w.h2[lo:hi]))):
            out[k].append(v)
    return pa.Table.from_pydict(out, schema=SENT)


def _compare(table: pa.Table, last: int) -> pa.Table:
    """Marks, for each pack's array, the hashes that start in an earlier pack."""
    bucket = table.column("bucket")[0].as_py()
    packs = table.column("pack").to_numpy()
    sizes = table.column("n").to_numpy()
    h1 = np.concatenate([np.cumsum(unplanes(b, np.uint64)) for b in table.column("h1").to_pylist()])
    h2 = np.concatenate([unplanes(b, np.uint32) for b in table.column("h2").to_pylist()])
    rank = np.repeat(np.minimum(packs, last), sizes).astype(np.int32)
    by = np.lexsort((rank, h2, h1))
    a, b, r = h1[by], h2[by], rank[by]
    new = np.ones(len(by), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    hit = np.empty(len(by), bool)
    hit[by] = r > r[np.flatnonzero(new)][np.cumsum(new) - 1]
    ends = np.cumsum(sizes)
    out = [(int(p), bucket, np.packbits(x).tobytes())
           for p, e, n in zip(packs, ends, sizes) if (x := hit[e - n:e]).any()]
    return pa.Table.from_pylist([dict(zip(ANSWER.names, x)) for x in out], schema=ANSWER)


def _runs(covered: np.ndarray) -> np.ndarray:
    """Maximal runs of True as rows (begin, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    return edge.reshape(-1, 2)


def _apply(table: pa.Table, answers: pa.Table, width: int, buckets: int, keep_text: bool) -> pa.Table:
    if not table.num_rows:
        return RESULT.empty_table()
    w = _Windows(table, width)
    at = w.edges(buckets)
    earlier = np.zeros(len(w.h1), bool)
    for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()):
        n = at[b + 1] - at[b]
        earlier[at[b]:at[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
    gone = np.empty(len(w.by), bool)
    gone[w.by] = earlier[w.group] | (w.rank[w.by] > w.least[w.group])
    total = int(w.first[-1])
    change = np.bincount(w.start[gone], minlength=total + 1) - np.bincount(w.start[gone] + width, minlength=total + 1)
    covered = np.cumsum(change)[:total] > 0
    out: dict[str, list] = {k: [] for k in RESULT.names}
    for k, i in enumerate(w.order):
        lo, hi = w.first[k], w.first[k + 1]
        words, mask = w.words[k], covered[lo:hi]
        n = int(mask.sum())
        kept = b" ".join(words if not n else [x for x, m in zip(words, mask.tolist()) if not m])
        row = (w.ids[i], hi - lo, n, hashlib.sha256(kept).hexdigest(),
               _runs(mask).tolist() if n else [],
               kept.decode() if keep_text and w.texts[i] is not None else None)
        for name, v in zip(RESULT.names, row):
            out[name].append(v)
    return pa.Table.from_pydict(out, schema=RESULT)


def dedup_windows(docs: DataFrame, width: int = 13, keep_text: bool = False) -> DataFrame:
    """Remove every word covered by a window that also starts in a smaller ``doc_id``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Returns one
    row per document: doc_id, n_words, n_removed, kept_sha256 (kept words joined by
    one space), intervals (maximal removed [begin, end) word ranges), kept_text
    (only with ``keep_text``, null for a null text).

    Null text: no words. A null doc_id counts as larger than every id and equal to
    other nulls; rows with equal ids never remove one another's words. Texts shorter
    than ``width`` have no window. An empty table gives an empty result.

    Scale: text is shuffled once (packs), window hashes once (about 10 bytes per
    distinct window and pack), answers are one bit each. A window that is in every
    document moves once per pack.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n = pack_count(docs, "text")
    buckets = 2 * shuffle_partitions(docs)
    # Documents without id are all of the last rank, but need not share a pack.
    no_id = F.col("doc_id").isNull()
    packed = docs.select("doc_id", "text", F.when(no_id, n + hashed_pack(F.col("text"), n))
                         .otherwise(ordered_pack(docs, "doc_id", n)).alias("pack"))
    sent = packed.groupBy("pack").applyInArrow(lambda t: _send(t, width, buckets),
                                               "bucket int, pack int, n int, h1 binary, h2 binary")
    answers = sent.groupBy("bucket").applyInArrow(lambda t: _compare(t, n),
                                                  "pack int, bucket int, bits binary")
    return packed.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(
        lambda a, b: _apply(a, b, width, buckets, keep_text),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, "
        "intervals array<array<long>>, kept_text string")
