"""Exact set similarity join by partitioning the universe (pigeonhole).

Sets are the distinct word shingles of a document. Two sets with 100 * inter >=
t * union differ in at most H = floor((|r| + |s|) * (100 - t) / (100 + t)) elements.
Sizes are cut into bands; inside a band the hash of a shingle deals it to one of
m segments, and the segments form a budget: a segment that must be equal covers one
difference, a segment that may differ by one element (its one-deletion neighbourhood
is indexed) covers two. As the budget exceeds H, two linked sets agree on at
least one segment's signature.

Cost-based allocation: after the index is counted, each set leaves out, in each band it
signs in, the band's ``slack`` longest posting lists, if they are long; the budget has two
units more per list left out, since either side may do so. Deletion neighbourhoods cost a row per shingle, so they
go to segments only where sets are small and equality signatures would be short.

Equal sets are one class (its smallest document stands for it). The sets of one posting
list are compared by count sketches: the distance of two sketches is never above that of the
sets, so pairs it rules out are no links. Sketches are fine enough that unrelated sets are ruled out
in all but one of millions of pairs: were it one of hundreds, the pairs of a large corpus would chain unrelated sets
to one candidate group, whose cost is the square of its size. What is left connects sets to candidate groups,
inside which all sets are compared exactly, as blocks of matrix products in a task, never
as emitted pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewkit.llm.components import components, stored
from reviewkit.llm.packs import planes, shuffle_partitions, unplanes
from reviewkit.llm.words import WordIds, gathered, mix, rolling, texts
from reviewkit.session import ship_package

#: Shingles a block of candidate sets holds at most, about (a single larger set is a block).
BLOCK_SHINGLES = 2_000_000
#: Sets of a posting list from which it is costly, from which a batch spreads it, and which one task compares at once.
COSTLY, HOT, LIST_BLOCK = 32, 256, 4096
#: Stands for "many sets here" in place of a set.
MARK = np.int64(-(1 << 63))
#: Text bytes of a batch that packs its signatures before they are shuffled.
BATCH_BYTES = 32_000_000
#: Sets compared with sets at once, and shared shingles of one matrix product.
STRIP, COLUMNS = 1024, 2048
#: Cells of sketches compared at once; pairs held before they are folded.
STRIP_CELLS, FOLD = 1 << 20, 200_000
#: Shingles a cell of a sketch holds up to this many cells, about; beyond, and for a first look, four times as many.
CELL_SHINGLES, FINE_CELLS = 2.5, 128
#: Low byte of a signature: its band. No set has more shingles.
BAND, MOST_SHINGLES = 0xFF, 1 << 40
#: Words a word memo holds before it is renewed.
MEMO_WORDS = 200_000
#: Hash of the band, segment and kind into a signature (odd, fixed).
_SALT = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3))


def bands(limit: int) -> list[int]:
    """Lower ends of the size bands up to above ``limit``: one by one to 10, then by a quarter."""
    out = list(range(1, 11))
    while out[-1] <= limit:
        out.append(out[-1] * 5 // 4 if out[-1] > 12 else out[-1] + 2)
    return out


def skips(size: int, t: int) -> int:
    """Posting lists that a set of at most ``size`` shingles may leave out in one band."""
    h = 2 * size * (100 - t) // (100 + t)
    return (h + 8) // 16 if h >= 8 else 0


def scheme(low: int, high: int, t: int) -> tuple[int, int, int]:
    """(segments, of them with deletion neighbourhoods, skips) of the band [low, high)."""
    h = 2 * (high - 1) * (100 - t) // (100 + t)
    slack = skips(high, t)
    budget = h + 1 + 2 * slack
    # Short sets leave nothing out and pay for deletions while segments would hold fewer than eight shingles.
    deletions = 0
    while not slack and deletions < budget // 2 and low < 8 * (budget - deletions):
        deletions += 1
    return budget - deletions, deletions, slack


class _Signer:
    def __init__(self, t: int) -> None:
        self.t = t
        self.lows: list[int] = bands(64)
        self.schemes: dict[int, tuple[int, int, int]] = {}

    def signatures(self, s: np.ndarray) -> np.ndarray:
        """Of a set of 64-bit hashes: signatures in its own band, and in larger ones where a partner may lie."""
        n = len(s)
        while self.t * self.lows[-2] <= 100 * n:
            self.lows = bands(2 * self.lows[-1])
        b = int(np.searchsorted(self.lows, n, side="right")) - 1
        out = [self._in(b, s)]
        while 100 * n >= self.t * self.lows[b + 1]:
            b += 1
            out.append(self._in(b, s))
        return np.concatenate(out)

    def _in(self, b: int, s: np.ndarray) -> np.ndarray:
        if b not in self.schemes:
            self.schemes[b] = scheme(self.lows[b], self.lows[b + 1], self.t)
        m, deletions, _ = self.schemes[b]
        e = mix(s + _SALT[0])
        segment = ((e >> np.uint64(33)) % np.uint64(m)).astype(np.int64)
        # Sums of 32-bit halves stay exact in double precision.
        x = mix(e ^ _SALT[1])
        low = np.bincount(segment, (x & np.uint64(0xFFFFFFFF)).astype(np.float64), m).astype(np.uint64)
        high = np.bincount(segment, (x >> np.uint64(32)).astype(np.float64), m).astype(np.uint64)
        size = np.bincount(segment, minlength=m)
        tag = (np.uint64(b) << np.uint64(32)) + np.arange(m, dtype=np.uint64)
        sign = lambda lo, hi, n, tag: mix(mix(lo + _SALT[0]) ^ mix(hi + _SALT[2] + (n.astype(np.uint64) << np.uint64(40)))
                                          ^ mix(tag * _SALT[1] + _SALT[2]))
        out = [sign(low, high, size, tag)]
        if deletions:
            one = segment < deletions
            of = segment[one]
            out.append(sign(low[of] - (x[one] & np.uint64(0xFFFFFFFF)), high[of] - (x[one] >> np.uint64(32)),
                            size[of] - 1, tag[of]))
        return np.concatenate(out) & ~np.uint64(BAND) | np.uint64(b)


def _lower_words(t: bytes | None) -> list[bytes]:
    return (t or b"").lower().split()


class _Shingler:
    """Distinct hashed shingles (sorted) of a text."""

    def __init__(self, k: int) -> None:
        self.k, self.memo = k, WordIds()

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = _lower_words(text)
        if not words:
            return np.empty(0, np.uint64)
        if len(self.memo) > MEMO_WORDS:
            self.memo = WordIds()
        ids = self.memo.ids(words)
        h = self.memo.hashes()[0][ids]
        # The number of words is hashed too, so a short text never equals a shingle of another size.
        n = min(self.k, len(h))
        return np.unique(mix(rolling(h, n) + np.uint64(n)))


def _set_name(s: np.ndarray) -> bytes:
    """128-bit name of a set."""
    a, b = mix(s ^ _SALT[0]), mix(s + _SALT[2])
    return np.array([a.sum(), b.sum() + np.uint64(len(s))], np.uint64).tobytes()


def _short(names: list[bytes]) -> np.ndarray:
    """First half of each name as a number."""
    return np.frombuffer(b"".join(names), np.int64)[::2].copy()


def _cells(size: int, each: float) -> int:
    """Power of two from which a cell holds at most ``each`` shingles."""
    return 1 << int(np.ceil(np.log2(max(size / each, 1))))


def _coarse(size: int) -> int:
    return max(32, _cells(size, 4 * CELL_SHINGLES))


def sketch(s: np.ndarray) -> bytes:
    """Counts of the shingles in hashed cells, capped at 255; cells are a power of two.

    The sum of absolute differences of two sketches (the longer folded to the shorter) is at most the number of
    shingles that only one of the sets has.
    """
    cells = max(64, _coarse(len(s)), min(FINE_CELLS, _cells(len(s), CELL_SHINGLES)))
    n = np.bincount((mix(s + _SALT[1]) & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.minimum(n, 255).astype(np.uint8).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Rows of one length: the shortest. Folding adds the halves, which can only lower a distance."""
    rows = [np.frombuffer(b, np.uint8) for b in sketches]
    cells = min(map(len, rows))
    return np.stack([r if len(r) == cells else np.minimum(r.reshape(-1, cells).sum(0, dtype=np.int64), 255) for r in rows]).astype(np.int16)


NAMED = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_shingles", pa.int64()),
                   ("set", pa.binary()), ("short", pa.int64()), ("sketch", pa.binary()), ("text_hash", pa.int64())])


def _named(docs: DataFrame, k: int) -> DataFrame:
    """Every document with the size and the name of its set; name null for an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _Shingler(k)
        for b in batches:
            found = [shingles(t) for t in texts(b.column(2))]
            names = [_set_name(s) if len(s) else None for s in found]
            short = _short([n or bytes(16) for n in names])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in found], pa.int64()),
                 pa.array(names, pa.binary()), pa.array(short, pa.int64()),
                 pa.array([sketch(s) if len(s) else None for s in found], pa.binary()), b.column(3)], schema=NAMED)

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, key long, n_shingles long, set binary, short long, sketch binary, text_hash long")


SIGNED = pa.schema([("bucket", pa.int32()), ("hot", pa.bool_()), ("n", pa.int32()), ("sigs", pa.binary()), ("sets", pa.binary())])


def _packed(bucket: int, hot: bool, sig: np.ndarray, sets: np.ndarray) -> tuple:
    return bucket, hot, len(sig), planes(np.diff(sig, prepend=np.uint64(0))), sets.tobytes()


def _signed(docs: DataFrame, k: int, t: int, buckets: int) -> DataFrame:
    """(signature, set) pairs of a batch of documents, one array for each bucket of signatures.

    A set that repeats in the batch is signed once. A signature that very many sets of the batch have sends one marker to
    its bucket; its sets are spread over all buckets, so a hot signature does not fill one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, signer = _Shingler(k), _Signer(t)
        for table in gathered(batches, "text", BATCH_BYTES):
            seen: dict[bytes, np.ndarray] = {}
            for text in texts(table.column("text")):
                s = shingles(text)
                if len(s) and (name := _set_name(s)) not in seen:
                    seen[name] = signer.signatures(s)
            if not seen:
                continue
            sig = np.concatenate(list(seen.values()))
            sets = np.repeat(_short(list(seen)), [len(x) for x in seen.values()])
            by = np.argsort(sig, kind="stable")
            sig, sets = sig[by], sets[by]
            size = np.diff(np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1], [True]])))
            hot = np.repeat(size >= HOT, size)
            marker = hot & np.concatenate([[True], sig[1:] != sig[:-1]])
            out = []
            rest = ~hot | marker
            one, of = sig[rest], np.where(marker, MARK, sets)[rest]
            at = np.searchsorted(one, np.array([((i << 64) // buckets) for i in range(1, buckets)], np.uint64))
            at = np.concatenate([[0], at, [len(one)]])
            out += [_packed(b, False, one[at[b]:at[b + 1]], of[at[b]:at[b + 1]]) for b in range(buckets) if at[b + 1] > at[b]]
            if hot.any():
                where = (mix(sets[hot].view(np.uint64) ^ sig[hot]) % np.uint64(buckets)).astype(np.int64)
                for b in np.unique(where).tolist():
                    out.append(_packed(b, True, sig[hot][where == b], sets[hot][where == b]))
            yield from pa.Table.from_pydict(dict(zip(SIGNED.names, zip(*out))), schema=SIGNED).to_batches()

    return docs.select("text").mapInArrow(run, "bucket int, hot boolean, n int, sigs binary, sets binary")


MEMBERS = pa.schema([("gid", pa.int64()), ("short", pa.int64()), ("costly", pa.bool_())])


def _meet(table: pa.Table) -> pa.Table:
    """One bucket of signatures: the members of every posting list of two sets or more.

    A short list is named by its members, so lists of the same sets become one; a costly list by its signature.
    """
    hot = np.repeat(table.column("hot").to_numpy(), table.column("n").to_numpy())
    sig = np.concatenate([np.cumsum(unplanes(b, np.uint64)) for b in table.column("sigs").to_pylist()])
    sets = np.frombuffer(b"".join(table.column("sets").to_pylist()), np.int64)
    passed = np.unique(np.stack([sig[hot].view(np.int64), sets[hot]], 1), axis=0) if hot.any() else np.empty((0, 2), np.int64)
    sig, sets = sig[~hot], sets[~hot]
    by = np.lexsort((sets, sig))
    sig, sets = sig[by], sets[by]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (sets[1:] != sets[:-1])
    sig, sets = sig[new], sets[new]
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])[:len(sig)])
    size = np.diff(np.concatenate([first, [len(sig)]]))
    marked = np.add.reduceat((sets == MARK).astype(np.int64), first) > 0 if len(first) else np.empty(0, bool)
    costly = np.repeat((size >= COSTLY) | marked, size)
    name = np.repeat(np.add.reduceat(mix(sets.view(np.uint64)), first), size).view(np.int64) if len(first) else sets
    keep = np.repeat((size > 1) | marked, size) & (sets != MARK)
    gid = np.where(costly, sig.view(np.int64), name)
    short = np.unique(np.stack([gid, sets], 1)[keep & ~costly], axis=0)
    long = np.concatenate([np.stack([gid, sets], 1)[keep & costly], passed])
    rows = np.concatenate([short, long])
    flag = np.arange(len(rows)) >= len(short)
    return pa.Table.from_arrays([pa.array(np.ascontiguousarray(rows[:, 0])), pa.array(np.ascontiguousarray(rows[:, 1])),
                                 pa.array(flag)], schema=MEMBERS)


def _lists(members: DataFrame, t: int) -> DataFrame:
    """(gid, short, k) of the posting lists that are compared: short ones, and costly ones less what sets leave out.

    In each band it signs in, a set leaves out as many of its longest costly lists as the band's budget allows.
    """
    short = members.where("not costly").select("gid", "short").distinct()
    costly = stored(members.where("costly").select("gid", "short").distinct(), "costly")
    lengths = stored(costly.groupBy("gid").agg(F.count(F.lit(1)).alias("k")), "lengths")
    band = F.col("gid").bitwiseAND(BAND)
    allowed = F.get(F.array(*[F.lit(skips(high, t)) for high in bands(MOST_SHINGLES)[1:]]), band.cast("int"))
    rank = F.row_number().over(Window.partitionBy("short", band).orderBy(F.desc("k"), "gid"))
    kept = costly.join(lengths, "gid").withColumn("rank", rank).where(F.col("rank") > allowed).select("gid", "short", "k")
    return short.select("gid", "short", F.lit(1).cast("long").alias("k")).union(kept)


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


class _Connected:
    """Connected numbers 0 ... n - 1. Pairs are folded to one edge a number whenever many have come."""

    def __init__(self, n: int) -> None:
        self.n, self.held, self.size = n, [], 0

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        self.held.append(np.stack([u, v], 1))
        self.size += len(u)
        if self.size > max(FOLD, 4 * self.n):
            label = self.labels()
            self.held, self.size = [np.stack([np.arange(self.n), label], 1)], self.n

    def labels(self) -> np.ndarray:
        """Smallest number that each is connected with."""
        label = np.arange(self.n)
        u, v = np.concatenate(self.held).T if self.held else (label[:0], label[:0])
        while len(u):
            now = label.copy()
            np.minimum.at(now, u, label[v])
            np.minimum.at(now, v, label[u])
            now = now[now]
            if (now == label).all():
                break
            label = now
        return label


def _near(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray, t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) that may link, some rows at a time: sizes and sketches within the distance of the threshold.

    All pairs are looked at in coarse sketches first, and what is left in the whole ones.
    """
    cells = min(a.shape[1], _coarse(max(size_a.max(), size_b.max())))
    low_a, low_b = (x.reshape(len(x), -1, cells).sum(1, dtype=np.int16) for x in (a, b))
    step = max(1, STRIP_CELLS // max(1, low_b.size))
    for at in range(0, len(a), step):
        x, y = size_a[at:at + step, None], size_b[None, :]
        far = np.abs(low_a[at:at + step, None, :] - low_b[None, :, :]).sum(2, dtype=np.int64)
        ok = ((100 + t) * far <= (100 - t) * (x + y)) & (100 * np.minimum(x, y) >= t * np.maximum(x, y))
        i, j = np.nonzero(ok)
        i += at
        if cells < a.shape[1]:
            near = np.empty(len(i), bool)
            for k in range(0, len(i), pairs := max(1, STRIP_CELLS // a.shape[1])):
                p, q = i[k:k + pairs], j[k:k + pairs]
                near[k:k + pairs] = (100 + t) * np.abs(a[p] - b[q]).sum(1, dtype=np.int64) <= (100 - t) * (size_a[p] + size_b[q])
            i, j = i[near], j[near]
        yield i, j


def _connect(sketches: np.ndarray, size: np.ndarray, side: np.ndarray | None, t: int) -> np.ndarray:
    """What the near pairs of a list connect, as rows (member, smallest member); ``side``: pairs across two blocks only.

    As long as a member is near to a good part of the others, these join it at once and are compared with the rest
    only; then everything left is compared with everything.
    """
    union = _Connected(len(size))

    def compare(x: np.ndarray, y: np.ndarray) -> None:
        if len(x) and len(y):
            for i, j in _near(sketches[x], size[x], sketches[y], size[y], t):
                union.add(x[i], y[j])

    if side is not None:
        compare(np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    else:
        left, groups = np.arange(len(size)), []
        while len(left) > 1:
            (_, hit), = _near(sketches[left[:1]], size[left[:1]], sketches[left[1:]], size[left[1:]], t)
            if len(hit) < len(left) / 8:
                break
            joined = np.concatenate([left[:1], left[hit + 1]])
            union.add(np.full(len(joined), left[0]), joined)
            groups.append(joined)
            left = np.setdiff1d(left, joined, assume_unique=True)
        for a, x in enumerate(groups):
            for y in [*groups[a + 1:], left]:
                compare(x, y)
        compare(left, left)
    label = union.labels()
    other = np.flatnonzero(label != np.arange(len(size)))
    return np.stack([other, label[other]], 1)


def _compare_lists(table: pa.Table, t: int) -> pa.Table:
    """Candidate edges of many posting lists (or blocks of long ones)."""
    order = table.sort_by([("gid", "ascending"), ("p", "ascending"), ("q", "ascending"), ("side", "ascending"), ("short", "ascending")])
    gid, p, q, side, short, size = (order.column(c).to_numpy() for c in ("gid", "p", "q", "side", "short", "n"))
    sketches = order.column("sketch").to_pylist()
    new = np.ones(len(gid), bool)
    new[1:] = (gid[1:] != gid[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
    first = np.concatenate([np.flatnonzero(new), [len(gid)]])
    edges = [np.empty((0, 2), np.int64)]
    for a, b in zip(first, first[1:]):
        if b - a > 1:
            hit = _connect(folded(sketches[a:b]), size[a:b], side[a:b] if p[a] != q[a] else None, t)
            edges.append(short[a:b][hit])
    out = np.unique(np.concatenate(edges), axis=0)
    return pa.Table.from_arrays([pa.array(np.ascontiguousarray(out[:, i])) for i in (0, 1)], schema=EDGES)


def _blocked(df: DataFrame, blocks: str, block: Column) -> DataFrame:
    """Rows dealt into ``blocks`` blocks by ``block``; a block meets itself (p = q, side 0) and every other (sides 0, 1)."""
    return (df.withColumn("__blk", block.cast("int"))
            .withColumn("__o", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
            .withColumn("p", F.least("__blk", "__o")).withColumn("q", F.greatest("__blk", "__o"))
            .withColumn("side", (F.col("__blk") > F.col("__o")).cast("int")).drop("__blk", "__o", blocks))


def _rows(elements: np.ndarray, owner: np.ndarray, part: np.ndarray, n: int) -> np.ndarray:
    """0/1 matrix: which owner holds which element of ``part``."""
    at = np.searchsorted(part, elements)
    ok = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == elements)
    out = np.zeros((n, len(part)), np.float32)
    out[owner[ok], at[ok]] = 1
    return out


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all ``left`` sets with all ``right`` ones.

    Products of 0/1 matrices over the shared elements, some columns at a time; exact in single
    precision below 2**24 elements. The diagonal of a list with itself counts shared elements only.
    """
    total = np.zeros((len(left), len(right)), np.float32)
    e1, e2 = np.concatenate(left), np.concatenate(right)
    o1 = np.repeat(np.arange(len(left)), [len(s) for s in left])
    o2 = np.repeat(np.arange(len(right)), [len(s) for s in right])
    if left is right:
        values, n = np.unique(e1, return_counts=True)
        shared = values[n > 1]
    else:
        shared = np.intersect1d(e1, e2)
    for i in range(0, len(shared), COLUMNS):
        part = shared[i:i + COLUMNS]
        total += _rows(e1, o1, part, len(left)) @ _rows(e2, o2, part, len(right)).T
    return total.astype(np.int64)


LINKS = pa.schema([("u", pa.binary()), ("v", pa.binary()), ("links", pa.int64())])


def _block_links(table: pa.Table, k: int, t: int) -> pa.Table:
    """Exact links inside a block pair: each linked set, the head of its component there, its linked documents."""
    shingles = _Shingler(k)
    rows: dict[bytes, tuple] = {}
    for name, side, copies, text in zip(table.column("set").to_pylist(), table.column("side").to_pylist(),
                                        table.column("copies").to_pylist(), texts(table.column("text"))):
        if name not in rows and _set_name(s := shingles(text)) == name:  # else another text under the same id
            rows[name] = (side, copies, s)
    names = sorted(rows, key=lambda n: (len(rows[n][2]), n))
    side = np.array([rows[n][0] for n in names])
    copies = np.array([rows[n][1] for n in names], np.int64)
    sets = [rows[n][2] for n in names]
    size = np.array([len(s) for s in sets], np.int64)
    one = table.column("p")[0].as_py() == table.column("q")[0].as_py()
    a = np.flatnonzero(side == 0)
    b = a if one else np.flatnonzero(side == 1)
    union, degree = _Connected(len(names)), np.zeros(len(names))
    for i in range(0, len(a), STRIP):
        x = a[i:i + STRIP]
        for j in range(i if one else 0, len(b), STRIP):
            y = b[j:j + STRIP]
            # Strips are in order of size; strips that differ too much in size hold no link.
            if 100 * size[x[-1]] < t * size[y[0]] or 100 * size[y[-1]] < t * size[x[0]]:
                continue
            left = [sets[q] for q in x]
            right = left if one and i == j else [sets[q] for q in y]
            inter = intersections(left, right)
            p, q = np.nonzero(100 * inter >= t * (size[x][:, None] + size[y][None, :] - inter))
            new = x[p] < y[q] if one else np.ones(len(p), bool)
            u, v = x[p][new], y[q][new]
            union.add(u, v)
            degree += np.bincount(u, copies[v], len(names)) + np.bincount(v, copies[u], len(names))
    label = union.labels()
    some = np.flatnonzero(degree > 0)
    return pa.Table.from_pydict({"u": [names[i] for i in some], "v": [names[label[i]] for i in some],
                                 "links": degree[some].astype(np.int64)}, schema=LINKS)


def _one_each(docs: DataFrame, named: DataFrame, classed: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the empty set, and one row of each component.

    A row's set follows from its text, so rows are told apart by id and text hash; rows equal in both by their other columns.
    """
    own = [F.col(c) for c in docs.columns]
    rows = stored(named.where("set is not null").groupBy("doc_id", "text_hash", "set").agg(
        F.count(F.lit(1)).alias("rows")), "rows")
    rooted = stored(rows.join(classed.select("set", "root"), "set").select("doc_id", "text_hash", "rows", "root"), "rooted")
    first = stored(rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "rows")).alias("f"))
                   .select("root", F.col("f.doc_id").alias("first_id"), F.col("f.text_hash").alias("first_hash")), "first")
    stays = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    judged = stored(rooted.join(first, "root").select(F.col("doc_id").alias("__of_id"), F.col("text_hash").alias("__of_hash"),
                                                      stays.alias("__stays"), "rows")
                    .where("not __stays or rows > 1").select("__of_id", "__of_hash", "__stays"), "judged")
    keyed = docs.select(F.struct(*own).alias("row"), F.col("doc_id").cast("long").alias("__id"),
                        F.xxhash64(F.col("text").cast("string")).alias("__hash"))
    same = F.col("__id").eqNullSafe(F.col("__of_id")) & (F.col("__hash") == F.col("__of_hash"))
    single = keyed.join(judged, same, "left_anti").select("row.*")
    repeated = judged.where("__stays")
    if repeated.isEmpty():
        return single
    # Folded before the shuffle, so a row with many copies is one row a task.
    once = (keyed.join(repeated, same, "left_semi").groupBy("__id", "__hash")
            .agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*"))
    return single.union(once)


def jaccard_components(docs: DataFrame, k: int = 3, t: int = 90, keep: bool = False) -> DataFrame:
    """Documents whose shingle sets satisfy 100 * intersection >= ``t`` * union, and their components.

    Words are the text's runs without white space, A-Z lower-cased; the set holds the distinct
    ``k``-word shingles (as 64-bit hashes), or the whole sequence when there are fewer words. Returns one row
    per document: doc_id, n_shingles, n_links (other documents directly linked), component_id (smallest
    doc_id reachable, itself included). With ``keep``, the input's rows that stay, with their columns: one row of each
    component (smallest id, null ids last, then text hash), whether its ids are null or repeat, and all rows with the empty set.

    Null and empty texts have the empty set and link with nothing. A document without id takes part in
    links and gets the smallest id of its component, null if there is none. Repeated rows are documents of
    their own. Other columns are ignored; an empty table gives an empty result.

    Scale: signatures (about a quarter of the words at 90, two thirds at 80) move once as packed arrays; texts move
    once, for the join with the candidates; posting lists and candidate groups are split into blocks of bounded size
    that are compared block against block.
    """
    ship_package(docs.sparkSession)
    given, docs = docs, docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # A row is known by id and text: an id that many texts share brings each of them to its own set only.
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    named = stored(_named(docs, k), "sets")
    classes = named.where("set is not null").groupBy("set").agg(
        F.min("doc_id").alias("id"), F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"),
        F.first("n_shingles").alias("n"), F.first("short").alias("short"))

    buckets = 2 * shuffle_partitions(docs)
    met = stored(_signed(docs, k, t, buckets).groupBy("bucket").applyInArrow(_meet, "gid long, short long, costly boolean"), "met")
    sketches = stored(named.where("set is not null").groupBy("short").agg(
        F.min("n_shingles").alias("n"), F.min_by("sketch", "n_shingles").alias("sketch")), "sketches")
    lists = _lists(met, t).join(sketches, "short").withColumn("blocks", F.ceil(F.col("k") / LIST_BLOCK))
    lists = _blocked(lists, "blocks", F.pmod(F.xxhash64("short"), F.col("blocks")))
    spread = F.pmod(F.xxhash64("gid", "p", "q"), F.lit(4 * buckets)).cast("int")
    near = (lists.withColumn("b", spread).select("b", "gid", "p", "q", "side", "short", "n", "sketch")
            .groupBy("b").applyInArrow(lambda x: _compare_lists(x, t), "u long, v long"))
    group = components(near).select(F.col("node").alias("short"), F.col("component").alias("grp"))

    # Members of candidate groups, dealt into blocks of bounded size; a block meets itself and every other one.
    members = stored(group.join(classes, "short"), "members")
    blocks = stored(members.groupBy("grp").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / LIST_BLOCK)).cast("int").alias("blocks")), "blocks")
    paired = _blocked(members.join(blocks, "grp"), "blocks", F.pmod(F.xxhash64("set"), F.col("blocks"))).select(
        "grp", "p", "q", "side", "set", "copies", "key")
    held = paired.join(docs.select("key", "text"), "key")
    links = stored(held.groupBy("grp", "p", "q").applyInArrow(lambda x: _block_links(x, k, t),
                                                             "u binary, v binary, links long"), "links")

    joined = components(links.select("u", "v"))
    least = stored(joined.join(classes, joined.node == classes.set).groupBy("component").agg(F.min("id").alias("least")), "least")
    found = (joined.join(least, "component")
             .join(links.groupBy("u").agg(F.sum("links").alias("links")), F.col("node") == F.col("u"))
             .select(F.col("node").alias("set"), F.col("component").alias("root"), "least", "links"))
    # Stored, so that both sides of the next join are plain shuffles: a set with many copies is split.
    classed = stored(classes.join(found, "set", "left").select(
        "set", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least", "id").alias("component"), F.coalesce("root", "set").alias("root")), "classed")
    if keep:
        return _one_each(given, named, classed)
    return named.join(classed, "set", "left").select(
        "doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "doc_id").alias("component_id"))
