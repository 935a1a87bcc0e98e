"""Benchmark decontamination with suffix arrays over the training corpus.

Documents are read in shards of a few MB. A word that no benchmark item holds ends
every match, so a shard's suffix array holds the suffixes of its runs of benchmark
words (runs shorter than the shortest window cannot match and are left out); it
is built by prefix doubling to full depth. Every benchmark suffix is then searched
in it by binary search, word by word: the interval at window depth gives all
occurrences of that window, the deepest non-empty interval the longest verbatim
match and its locations. Equal texts of the benchmark are one, equal windows share one interval and one list of
items, and only (document, list) pairs are held: never a row per item and occurrence. Documents are never shuffled; the benchmark, a stated query
set, goes to the executors in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from reviewkit.llm.words import gathered, texts
from reviewkit.session import ship_package

#: Text bytes of a shard.
SHARD_BYTES = 8_000_000
#: Text bytes of one block of the benchmark (collected and sent to the executors).
BLOCK_BYTES = 16_000_000

# Word characters are 0-9, a-z and everything from U+0080 on; A-Z are lower-cased first.
_SEPARATORS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
                    else c + 0x20 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
    ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
    ("longest", pa.int64()), ("longest_item", pa.int64()), ("longest_at", pa.int64())])


def split(text: bytes) -> list[bytes]:
    return text.translate(_SEPARATORS).split()


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Positions of all suffixes of ``ids`` that start with a non-zero id, sorted.

    A suffix ends at the next 0 (the last element is one). Ranks double in length until the longest
    suffix is covered; equal suffixes keep one rank and stay in text order.
    """
    n = len(ids)
    ends = np.flatnonzero(ids == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # words before the end
    rank, step = ids.astype(np.int64), 1
    while n and step < left.max():
        ahead = np.zeros(n, np.int64)
        ahead[:n - step] = rank[step:]
        ahead[left <= step] = 0
        # 0 stays the rank of the ends alone.
        rank = np.unique(rank * (rank.max() + 1) + ahead, return_inverse=True)[1]
        step *= 2
    by = np.argsort(rank, kind="stable")
    return by[ids[by] != 0]


def _bound(at: np.ndarray, sa: np.ndarray, depth: int, lo: np.ndarray, hi: np.ndarray,
           want: np.ndarray, above: bool) -> np.ndarray:
    """Binary search in each [lo, hi) of the suffix array for the first word >= (or >) want at depth."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        # Closed intervals are looked at too, anywhere; their answers are not used.
        word = at[np.minimum(sa[np.minimum(mid, len(sa) - 1)] + depth, len(at) - 1)]
        right = open_ & ((word <= want) if above else (word < want))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)
    return lo


class Benchmark:
    """One block of items: word ids, and the suffixes to search."""

    def __init__(self, items: list[tuple[int | None, bytes]], width: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        words = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in split(t)] for _, t in items]
        # Equal texts are searched once, for all their ids; the first id names a match.
        held: dict[tuple[int, ...], list[int | None]] = {}
        for (i, _), w in zip(items, words):
            if w:
                held.setdefault(tuple(w), []).append(i)
        kept = [(ids[0], w) for w, ids in held.items()]
        self.item_ids = [i for i, _ in kept]
        #: Ids of each text, as they are listed.
        self.listed = [frozenset(str(i) for i in ids if i is not None) for ids in held.values()]
        lengths = np.array([len(w) for _, w in kept], np.int64)
        self.flat = np.array([x for _, w in kept for x in w] + [0], np.int64)
        self.shortest = int(min(width, lengths.min())) if len(lengths) else 0
        first = np.cumsum(lengths) - lengths
        #: Of each suffix: its begin in ``flat``, words left, its item (text), and its window's width (0: none).
        self.begin = np.arange(int(lengths.sum()))
        self.item = np.repeat(np.arange(len(kept)), lengths)
        self.left = np.repeat(first + lengths, lengths) - self.begin
        need = np.minimum(width, lengths)[self.item]
        self.need = np.where(self.left >= need, need, 0)

    def search(self, at: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, ...]:
        """Binary-search every suffix.

        Returns (suffix, lo, hi) of each window that occurs, and for every suffix its longest match
        length and the interval of its occurrences.
        """
        k = len(self.begin)
        longest, best_lo, best_hi = (np.zeros(k, np.int64) for _ in range(3))
        alive, lo, hi = np.arange(k), np.zeros(k, np.int64), np.full(k, len(sa))
        found, depth = [], 0
        while len(alive) and len(sa):
            want = self.flat[self.begin[alive] + depth]
            a = _bound(at, sa, depth, lo, hi, want, above=False)
            b = _bound(at, sa, depth, a, hi, want, above=True)
            ok = a < b
            alive, lo, hi = alive[ok], a[ok], b[ok]
            depth += 1
            longest[alive], best_lo[alive], best_hi[alive] = depth, lo, hi
            at_window = self.need[alive] == depth
            found.append((alive[at_window], lo[at_window], hi[at_window]))
            more = self.left[alive] > depth
            alive, lo, hi = alive[more], lo[more], hi[more]
        window = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 3
        return *window, longest, best_lo, best_hi


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [lo, hi), and the range each belongs to."""
    size = hi - lo
    of = np.repeat(np.arange(len(lo)), size)
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + lo[of], of


def _merged(lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row of each distinct (interval, depth), ordered, and the distinct one each row belongs to.

    Equal intervals at one depth are equal word sequences; different ones at one depth are disjoint.
    """
    _, first, of = np.unique(np.stack([depth, lo, hi], 1), axis=0, return_index=True, return_inverse=True)
    return first, of.ravel()


def _depths(lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, slots, interval of each slot) of distinct intervals, deepest first; a depth has a slot once at most."""
    for d in np.unique(depth)[::-1].tolist():
        at = np.flatnonzero(depth == d)
        slot, of = _ranges(lo[at], hi[at])
        yield d, slot, at[of]


class _Lists(dict):
    """Numbers of distinct lists of texts, and their (block, texts)."""

    def __init__(self) -> None:
        super().__init__()
        self.texts: list[tuple[int, list[int]]] = []

    def numbers(self, block: int, of: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The list of each distinct window, from the pairs (window, text)."""
        out = []
        pair = np.unique(np.stack([of, text], 1), axis=0)
        for x in np.split(pair[:, 1], np.flatnonzero(np.diff(pair[:, 0])) + 1) if len(of) else ():
            n = self.setdefault((block, x.tobytes()), len(self))
            if n == len(self.texts):
                self.texts.append((block, x.tolist()))
            out.append(n)
        return np.array(out, np.int64)


def _shard(table: pa.Table, blocks: list) -> pa.Table:
    doc_texts = texts(table.column("text"))
    words = [split(t or b"") for t in doc_texts]
    lengths = np.array([len(w) for w in words], np.int64)
    # A 0 after every document, so that no match crosses it.
    first = np.cumsum(lengths + 1) - (lengths + 1)
    total = int((lengths + 1).sum())
    covered = np.zeros(total + 1, np.int64)
    pairs: list[set] = [set() for _ in words]  # numbers of the lists that meet the document
    lists = _Lists()
    longest = np.zeros(len(words), np.int64)
    where: list[tuple] = [(None, None)] * len(words)
    for number, held in enumerate(blocks):
        block: Benchmark = held.value
        if not block.shortest:
            continue
        ids = np.zeros(total, np.int64)
        get = block.vocabulary.get
        for f, w in zip(first.tolist(), words):
            ids[f:f + len(w)] = np.fromiter(map(get, w, repeat(0)), np.int64, len(w))
        # Runs of benchmark words that are long enough for the shortest window.
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids != 0).view(np.int8), [0]]))).reshape(-1, 2)
        edge = edge[edge[:, 1] - edge[:, 0] >= block.shortest]
        if not len(edge):
            continue
        source, _ = _ranges(edge[:, 0], edge[:, 1] + 1)  # one 0 after each run
        at = np.where(source < total, ids[np.minimum(source, total - 1)], 0)
        sa = suffix_array(at)
        suffix, lo, hi, match, best_lo, best_hi = block.search(np.concatenate([at, [0]]), sa)
        window, of = _merged(lo, hi, block.need[suffix])
        listed = lists.numbers(number, of, block.item[suffix])
        for width, slot, of in _depths(lo[window], hi[window], block.need[suffix[window]]):
            place = source[sa[slot]]
            covered += np.bincount(place, minlength=total + 1) - np.bincount(place + width, minlength=total + 1)
            doc = np.searchsorted(first, place, side="right") - 1
            for x in np.unique(doc * len(lists) + listed[of]).tolist():
                d, i = divmod(x, len(lists))
                pairs[d].add(i)
        # The longest match of each document, among suffixes that match at least their window.
        hit = np.flatnonzero((block.need > 0) & (match >= np.maximum(block.need, 1)))
        hit = hit[_merged(best_lo[hit], best_hi[hit], match[hit])[0]]
        for size, slot, of in _depths(best_lo[hit], best_hi[hit], match[hit]):
            place = source[sa[slot]]
            doc = np.searchsorted(first, place, side="right") - 1
            by = np.lexsort((place, doc))
            by = by[np.diff(doc[by], prepend=-1) != 0]  # earliest place of each document
            for j in by[longest[doc[by]] < size].tolist():
                longest[doc[j]] = size
                where[doc[j]] = (block.item_ids[block.item[hit[of[j]]]], int(place[j] - first[doc[j]]))
    hits = np.add.reduceat((np.cumsum(covered)[:total] > 0).astype(np.int64), first) if len(first) else covered[:0]
    out: dict[str, list] = {k: [] for k in RESULT.names}
    known: dict[frozenset, tuple[int, str]] = {}  # documents that meet the same lists have the same items
    for k, i in enumerate(table.column("doc_id").to_pylist()):
        met = frozenset(pairs[k])
        if met not in known:
            items = sorted(set().union(*(blocks[b].value.listed[t] for b, t in
                                         {(b, t) for b, held in map(lists.texts.__getitem__, met) for t in held})))
            known[met] = len(items), hashlib.sha256(",".join(items).encode()).hexdigest()
        row = (i, lengths[k], hits[k], *known[met], bool(hits[k]), longest[k], *where[k])
        for name, v in zip(RESULT.names, row):
            out[name].append(v)
    return pa.Table.from_pydict(out, schema=RESULT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, keep: bool = False) -> DataFrame:
    """Verbatim benchmark windows in every document.

    A window is ``width`` consecutive words of an item; an item of fewer words is one
    window, an item without words has none. Returns one row per document: doc_id, n_words,
    n_hit (words inside any occurrence), n_items, items_sha256 (ids sorted as strings,
    comma-joined), contaminated, and the longest verbatim match: its length in words, item and
    word position (0 / null without a hit; ties: the earliest position). With ``keep``, the input's rows and columns and
    __contaminated, each row judged by its own text.

    Null or empty texts have no words, so they neither hit nor are hit. A null item_id's
    windows mark hits but are not listed; repeated item ids count once. Repeated
    documents give one row each. Other columns are ignored. Either table may be empty.

    Scale: one pass over the documents, no shuffle; a shard's memory is bounded by
    ``SHARD_BYTES`` (one longer document is a shard of its own).
    """
    spark = docs.sparkSession
    ship_package(spark)
    bench = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    size = bench.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_blocks = max(1, math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("text"), F.lit(n_blocks))
    blocks = [spark.sparkContext.broadcast(Benchmark([(r.item_id, r.text.encode()) for r in
                                                      bench.where(block == b).orderBy("item_id", "text").collect()], width))
              for b in range(n_blocks)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", SHARD_BYTES):
            yield from _shard(table, blocks).to_batches()

    if keep:
        own = [c for c in docs.columns if c.lower() != "__contaminated"]
        text = next(c for c in own if c.lower() == "text")
        rows = docs.select(*own).withColumn(text, F.col(text).cast("string"))

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in gathered(batches, text, SHARD_BYTES):
                judged = _shard(pa.table({"doc_id": pa.nulls(table.num_rows, pa.int64()), "text": table.column(text)}), blocks)
                yield from table.append_column("__contaminated", judged.column("contaminated")).to_batches()

        return rows.mapInArrow(mark, StructType([*rows.schema.fields, StructField("__contaminated", BooleanType())]))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
             "contaminated boolean, longest long, longest_item long, longest_at long")
