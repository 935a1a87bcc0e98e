"""LM scoring by online logistic context mixing.

A document is the byte stream of its lower-cased words, each closed by a space, and an end byte. Every bit of every
token is predicted by hashed-context predictors: the last two, three, four and six bytes, which run on over the space
into the word before, the word so far, and the word so far with the whole previous word. A predictor is a pair
of counts per hashed (context, bits of the byte so far). The predictions are mixed in the logistic domain with weights
chosen by a gate (how often the two word contexts were seen), and the mix is refined by an adaptive probability
map over (bit position, gate, mixed probability). Weights and map are learned online over the training tokens, each
occurrence predicted from counts without itself. ``score`` is the sum over all bits of all tokens: the text can be
decoded from that many bits.

All contexts of a token are cut at the word before the previous one, so its code length is a function of (previous word,
word). Equal pairs of the corpus are therefore gathered in Spark by hash bucket of the previous word (the lexicon) and the
mixer runs once for each distinct pair of a bucket, weighted by its count; each occurrence adds its pair's length.

What grows: the lexicon, and the tables of the predictor that sees the previous word. These are kept by bucket, each as
large as its bucket's training pairs ask for, and there are as many buckets as the text's bytes ask for. The
tables of the other five predictors go to every executor and so have a fixed number of slots (``SLOT_BITS``).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewkit.llm.components import stored
from reviewkit.llm.packs import hashed_pack, pack_count, planes, unplanes
from reviewkit.llm.words import WordIds, gathered, mix, table_batches, texts
from reviewkit.session import ship_package, shuffles_dropped

#: Byte contexts, and bits of the slot number of each shared table: 2, 3, 4, 6 bytes, word so far.
ORDERS = (2, 3, 4, 6)
SLOT_BITS = (20, 20, 21, 21, 21)
HEAD = max(ORDERS)
#: A longer word is predicted in pieces, so that memory follows the piece.
PIECE = 1 << 15
#: Text bytes a bucket of the lexicon aims at; lexicon bytes that one task of the training reads, about.
BUCKET_BYTES, TRAIN_BYTES = 1_000_000, 8_000_000
#: Slots of a bucket's own table for each bit of its distinct pairs, at least.
SPARE = 2
#: Text bytes a counting task holds at once; bytes predicted at once.
COUNT_BYTES, CHUNK = 24_000_000, 1 << 15
#: Texts of a batch turned to bytes at once; bytes of a counting task's output batch, about.
TEXTS, BATCH_BYTES = 256, 4_000_000
#: Slots of a bucket's own table from which on its counts take a byte each, with the few larger ones aside.
LARGE = 1 << 24
#: Gates of the mixer and bins of the refining map.
GATES, BINS = 64, 33
#: Slots of a table block in the shuffle; a block's counts of all tasks are summed at once.
BLOCK = 1 << 13
PRIOR, RATE = 0.4, 2.0
INPUTS = len(SLOT_BITS) + 2
_OFFSETS = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])]).astype(np.int64)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                               0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


@dataclass
class Bits:
    """Bits of the distinct (previous word, word so far, byte) nodes of a run of tokens: of every node the hashes of its shared
    contexts (none if only pairs are counted), that of the context with the previous word, and the byte; and of every byte of the run
    its node and token. Tokens that begin alike after one word share the nodes of their beginning."""
    contexts: list[np.ndarray]
    pair: np.ndarray
    byte: np.ndarray
    node: np.ndarray
    token: np.ndarray

    def halves(self) -> Iterator[Half]:
        """The nodes' bits, half byte by half byte: its four bits lie in one group of 16 slots, the context's place changed in its
        last four bits, and are looked up together."""
        for half in (0, 4):
            high = (self.byte >> np.uint64(4)) * _ODD[5] if half else np.uint64(0)
            part = (self.byte >> np.uint64(4 - half)).astype(np.uint8) & np.uint8(15)
            so_far = np.concatenate([part >> np.uint8(4 - j) | np.uint8(1 << j) for j in range(4)]).astype(np.int64)
            bit = np.concatenate([part >> np.uint8(3 - j) & np.uint8(1) for j in range(4)])
            slots = [(((c + high) * _ODD[0] >> np.uint64(64 - width)).view(np.int64) + at ^ so_far.reshape(4, -1)).ravel()
                     for c, width, at in zip(self.contexts, SLOT_BITS, _OFFSETS.tolist())]
            yield Half(slots, (mix(self.pair + high) ^ so_far.view(np.uint64).reshape(4, -1)).ravel(), bit)

    @property
    def slots(self) -> np.ndarray:
        """(shared predictor, bit), bit position by bit position."""
        return np.concatenate([np.stack(x.slots) for x in self.halves()], 1)

    @property
    def bit(self) -> np.ndarray:
        return np.concatenate([x.bit for x in self.halves()])

    def weights(self, weight: np.ndarray) -> np.ndarray:
        """Of every (bit position, node), from those of the tokens (whole numbers)."""
        return np.broadcast_to(np.bincount(self.node, weight[self.token], len(self.byte)), (8, len(self.byte)))


@dataclass
class Half:
    """Four bit positions of the nodes, one after another: slots in each shared table, the hash of the context with the previous
    word, and the bits."""
    slots: list[np.ndarray]
    own: np.ndarray
    bit: np.ndarray


def split_key(key: bytes) -> tuple[bytes, bytes]:
    """(previous word, word); words hold no space."""
    prev, _, word = key.partition(b" ")
    return prev, word


def joined(pairs: Iterable[tuple[bytes, bytes]]) -> bytes:
    """A line for each run of one previous word: that word and the words after it."""
    lines: list[list[bytes]] = []
    last = None
    for prev, word in pairs:
        if prev != last:
            lines.append([prev])
            last = prev
        lines[-1].append(word)
    return b"\n".join([b" ".join(line) for line in lines])


def parted(blob: bytes) -> list[bytes]:
    return [prev + b" " + w for line in blob.split(b"\n") for prev, *words in [line.split(b" ")] for w in words]


def _units(keys: list[bytes]) -> Iterator[tuple[int, bytes, bytes, int]]:
    """(token, last bytes before it, bytes, hash of the previous word) of every token, long words in pieces.

    The closing byte of a word is a space; the empty word is the end, one newline byte. Before the first word stands the
    last document's end.
    """
    last, h = None, 0
    for i, key in enumerate(keys):
        prev, word = split_key(key)
        if prev != last:
            last, h = prev, xxhash.xxh3_64_intdigest(prev)
            head = (b"\n" * HEAD + (prev + b" " if prev else b""))[-HEAD:]
        body = word + b" " if word else b"\n"
        if len(body) <= PIECE:
            yield i, head, body, h
        else:
            for at in range(0, len(body), PIECE):
                yield i, body[at - HEAD:at] if at else head, body[at:at + PIECE], h ^ at


def _shared_nodes(unit: np.ndarray, place: np.ndarray, size: np.ndarray, first: np.ndarray, b: np.ndarray,
                  h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of every node, node of every byte): a token shares nodes with the one before it as far as both begin alike."""
    before = np.maximum(unit - 1, 0)
    other = np.minimum(first[before] + place, len(b) - 1)
    follows = np.zeros(len(size), bool)
    follows[1:] = h[1:] == h[:-1]
    apart = np.flatnonzero(~(follows[unit] & (place < size[before]) & (b == b[other])))
    begin = apart[np.diff(unit[apart], prepend=-1) != 0]  # of every unit the first byte that differs
    alike = size.copy()
    alike[unit[begin]] = place[begin]
    new = place >= alike[unit]
    at = np.flatnonzero(new)
    # A byte that is no new node has that of the last new one before it in the same place.
    by = np.argsort(place.astype(np.uint16), kind="stable")
    last = np.maximum.accumulate(np.where(new[by], np.arange(len(by)), 0))
    node = np.empty(len(by), np.int64)
    node[by] = (np.cumsum(new) - 1)[by[last]]
    return at, node


def bits_of(units: list[tuple[int, bytes, bytes, int]], shared: bool = True) -> Bits:
    token, heads, bodies, h = zip(*units)
    stream = np.frombuffer(b"".join([x for pair in zip(heads, bodies) for x in pair]), np.uint8)
    size = np.fromiter(map(len, bodies), np.int64, len(units))
    begin = np.cumsum(size + HEAD) - size
    return _bits(stream, begin, size, begin - HEAD, np.array(h, np.uint64), np.array(token, np.int64), shared)


def _bits_of_keys(keys: list[bytes], token: int, shared: bool) -> Bits:
    """The bits of keys without long words, numbered from ``token``: their bytes are read where they stand in the keys."""
    stream = np.frombuffer(bytearray(b"\n".join(keys) + b"\n"), np.uint8)
    space, end = np.flatnonzero(stream == 32), np.flatnonzero(stream == 10)  # one of each in every key
    floor = np.concatenate([[0], end[:-1] + 1])
    stream[end[end > space + 1]] = 32  # the closing byte of a word
    stream[space[space == floor]] = 10  # nothing stands before the first word
    prevs = [k.partition(b" ")[0] for k in keys]
    memo = {prev: xxhash.xxh3_64_intdigest(prev) for prev in set(prevs)}
    h = np.fromiter(map(memo.__getitem__, prevs), np.uint64, len(keys))
    return _bits(stream, space + 1, end - space, floor, h, np.arange(token, token + len(keys)), shared)


def _bits(stream: np.ndarray, begin: np.ndarray, size: np.ndarray, floor: np.ndarray, h: np.ndarray, token: np.ndarray, shared: bool) -> Bits:
    """Of units of ``size`` bytes that begin at a place of the stream; before ``floor`` stand only ends. ``h`` is the hash of the
    previous word."""
    unit = np.repeat(np.arange(len(size)), size)
    first = np.cumsum(size) - size
    flat = np.arange(len(unit))
    place = flat - first[unit]
    at = flat + (begin - first)[unit]
    b = stream[at]
    # The word so far: running sum of byte times a power of its place, within the unit.
    power = np.cumprod(np.full(int(size.max()) + 1, _ODD[3]))
    run = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(mix((b + np.uint64(1)) * power[place]), out=run[1:])
    new, node = _shared_nodes(unit, place, size, first, b, h)
    unit_new = unit[new]
    prefix = mix(run[new] - run[first][unit_new] + place[new].astype(np.uint64))
    contexts = []
    if shared:
        back, near, low = np.zeros(len(new), np.uint64), at[new], floor[unit_new]
        for k in range(1, HEAD + 1):
            near -= 1
            byte = np.where(near < low, np.uint8(10), stream.take(near, mode="clip"))
            back |= byte.astype(np.uint64) << np.uint64(8 * (k - 1))
            if k in ORDERS:
                contexts.append(mix(back + _ODD[k - 1 if k < 6 else 0]))
        contexts.append(prefix)
    own = mix(prefix + h[unit_new] * _ODD[1])
    return Bits(contexts, own, b[new].astype(np.uint64), node, token[unit])


def runs(keys: list[bytes], shared: bool = True) -> Iterator[Bits]:
    """The bits of all tokens, about ``CHUNK`` bytes at a time."""
    size = np.fromiter((len(k) - k.index(b" ") for k in keys), np.int64, len(keys))
    if len(keys) and size.max() > PIECE:
        held, n = [], 0
        for u in _units(keys):
            held.append(u)
            n += len(u[2])
            if n >= CHUNK:
                yield bits_of(held, shared)
                held, n = [], 0
        if held:
            yield bits_of(held, shared)
        return
    upto, i = np.cumsum(size), 0
    while i < len(keys):
        j = int(np.searchsorted(upto, (upto[i - 1] if i else 0) + CHUNK)) + 1
        yield _bits_of_keys(keys[i:j], i, shared)
        i = j


class Counts:
    """How often each slot of the shared tables saw a 0 and a 1."""

    def __init__(self) -> None:
        self.n = np.zeros((int(_OFFSETS[-1]), 2), np.uint32)
        self.bits = 0  # counted so far; no slot saw more

    def add(self, keys: list[bytes], weight: np.ndarray) -> None:
        self.bits += 8 * sum((len(k) - k.index(b" ")) * n for k, n in zip(keys, weight.tolist()))
        if self.bits >= 1 << 32:
            self.n = self.n.astype(np.int64, copy=False)
        flat = self.n.ravel()
        for x in runs(keys):
            w = x.weights(weight)[:4].ravel().astype(self.n.dtype)
            for half in x.halves():
                for s in half.slots:
                    np.add.at(flat, s * 2 + half.bit, w)


class PairCounts:
    """The table of the contexts with the previous word, of one bucket and as large as it asks for."""

    def __init__(self, keys: list[bytes], weight: np.ndarray) -> None:
        size = SPARE * 8 * sum(len(k) - k.index(b" ") for k in keys)
        self.mask = np.uint64((1 << max(10, math.ceil(math.log2(size + 1)))) - 1)
        slots = int(self.mask) + 1
        self.n = np.zeros(2 * slots, np.uint8 if slots > LARGE else np.uint32 if weight.sum() < 1 << 32 else np.int64)
        self.over: dict[int, int] = {}  # counts that a byte does not hold; it says 255
        for x in runs(keys, shared=False):
            w = x.weights(weight)[:4].ravel()
            for half in x.halves():
                at = self.at(half) * 2 + half.bit
                if self.n.dtype == np.uint8:
                    self._add_to_bytes(at, w)
                else:
                    np.add.at(self.n, at, w.astype(self.n.dtype))

    def _add_to_bytes(self, at: np.ndarray, w: np.ndarray) -> None:
        at, back = np.unique(at, return_inverse=True)
        more = np.bincount(back, w).astype(np.int64)
        now = self.n[at] + more
        self.n[at] = np.minimum(now, 255)
        large = now >= 255
        for i, n, m in zip(at[large].tolist(), now[large].tolist(), more[large].tolist()):
            self.over[i] = self.over[i] + m if i in self.over else n

    def at(self, half: Half) -> np.ndarray:
        return (half.own & self.mask).view(np.int64)

    def look(self, half: Half, loo: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ln odds of a 1, level of how often seen) of every bit, for learning without the bit's own occurrence."""
        at = self.at(half)
        n0, n1 = seen = self.n.reshape(-1, 2).take(at, axis=0).T.astype(np.float32, order="C")
        if self.over:
            for bit, n in enumerate(seen):
                large = np.flatnonzero(n == 255)
                n[large] = [self.over[i] for i in (at[large] * 2 + bit).tolist()]
        if loo:
            one = half.bit.astype(np.float32)
            n1 -= one
            n0 -= 1 - one
        return np.log((n1 + np.float32(PRIOR)) / (n0 + np.float32(PRIOR))), level(n0 + n1)


def level(seen: np.ndarray) -> np.ndarray:
    return np.minimum(7, np.log2(np.maximum(seen, 0) + 1) / 1.5 + 1e-3).astype(np.uint8)  # 7 and 63 are borders


class Mixer:
    """Shared tables (as logarithms), gated weights and the refining map."""

    def __init__(self, log_counts: np.ndarray, loo: bool = False) -> None:
        #: ln(odds of a 1) of each slot, and how often it was seen; for learning (``loo``) without one 0 and without
        #: one 1 instead. Made block by block, so only the tables in use take memory.
        slots = log_counts.shape[1]
        self.stretch = np.empty((slots, 2 if loo else 1), np.float32)
        self.seen = np.empty(slots, np.uint8)
        for at in range(0, slots, BLOCK):
            part = slice(at, at + BLOCK)
            n0, n1 = np.exp2(log_counts[:, part].astype(np.float32)) - 1
            for less, column in zip((1, -1), self.stretch.T):
                one, zero = (np.maximum(n1 - (loo and less < 0), 0), np.maximum(n0 - (loo and less > 0), 0))
                column[part] = np.log((one + PRIOR) / (zero + PRIOR))
            self.seen[part] = level(n0 + n1 - loo)
        self.loo = loo
        self.weights = np.full((GATES, INPUTS), 0.3, np.float32)
        self.weights[:, -1] = 0
        self.hits, self.total = np.zeros(8 * 8 * BINS), np.zeros(8 * 8 * BINS)

    def predict(self, half: Half, pairs: PairCounts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(inputs, gate, mixed logit) of every bit; a learning mixer's counts leave out the bit's own occurrence."""
        inputs = np.empty((INPUTS, len(half.bit)), np.float32)
        inputs[-1] = 1
        flat = self.stretch.ravel()
        for s, row in zip(half.slots, inputs):
            flat.take(s * 2 + half.bit if self.loo else s, out=row, mode="clip")  # no slot is outside
        inputs[-2], level_pair = pairs.look(half, self.loo)
        gate = level_pair.astype(np.int64) * 8 + self.seen.take(half.slots[-1])
        logit = np.zeros(len(half.bit), np.float32)
        for w, of in zip(np.ascontiguousarray(self.weights.T), inputs):
            logit += w.take(gate) * of
        return inputs, gate, np.clip(logit, -11, 11)

    @staticmethod
    def _bins(gate: np.ndarray, logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower bin of the half byte's map and the share of the upper one."""
        at = (np.clip(logit, -8, 7.999) + 8) * (BINS - 1) / 16
        low = at.astype(np.int64)
        position = np.arange(4)[:, None] * 8
        return ((position + (gate >> 3).reshape(4, -1)) * BINS).ravel() + low, at - low

    def probability(self, x: Bits, pairs: PairCounts) -> np.ndarray:
        """Of the bits that occur, bit position by bit position."""
        return np.concatenate([self._probability(half, of, pairs) for half, of in zip(x.halves(), self.map.reshape(2, -1))])

    def _probability(self, half: Half, of: np.ndarray, pairs: PairCounts) -> np.ndarray:
        _, gate, logit = self.predict(half, pairs)
        p = 1 / (1 + np.exp(-logit))
        low, share = self._bins(gate, logit)
        refined = of.take(low) * (1 - share) + of.take(low + 1) * share
        p = np.clip(0.5 * (p + refined), 1e-5, 1 - 1e-5)
        return np.abs(p - (1 - half.bit))

    @property
    def map(self) -> np.ndarray:
        if not hasattr(self, "_map"):
            centre = 1 / (1 + np.exp(-(np.arange(BINS) * 16 / (BINS - 1) - 8)))
            prior = np.tile(centre, 64)
            self._map = (self.hits + 20 * prior) / (self.total + 20)
        return self._map

    def learn(self, keys: list[bytes], weight: np.ndarray, pairs: PairCounts) -> None:
        """Online: every run is predicted, then the weights of its gates and the map are updated."""
        curve = np.full(GATES, 1e-3)
        hits, total = self.hits.reshape(2, -1), self.total.reshape(2, -1)
        for x in runs(keys):
            w = x.weights(weight)[:4].ravel()
            slope = np.zeros((INPUTS, GATES))
            for i, half in enumerate(x.halves()):
                inputs, gate, logit = self.predict(half, pairs)
                p = 1 / (1 + np.exp(-logit))
                low, share = self._bins(gate, logit)
                at = low + (share > 0.5)
                hits[i] += np.bincount(at, w * half.bit, hits.shape[1])
                total[i] += np.bincount(at, w, hits.shape[1])
                # Steps of a gate shrink with the curvature (summed over its inputs) that it has seen so far.
                curve += np.bincount(gate, w * np.maximum(p * (1 - p), 1e-4) * np.einsum("ij,ij->j", inputs, inputs), GATES)
                error = w * (half.bit - p)
                for of, row in zip(slope, inputs):
                    of += np.bincount(gate, error * row, GATES)
            self.weights += (RATE * slope / curve).clip(-0.2, 0.2).T

    def log10(self, keys: list[bytes], pairs: PairCounts) -> np.ndarray:
        """log10 probability of the word of each (previous word, word), closing byte included."""
        out = np.zeros(len(keys))
        maps = self.map.reshape(2, -1)
        for x in runs(keys):
            lo, hi = int(x.token.min()), int(x.token.max()) + 1
            of_node = sum(np.log10(self._probability(half, of, pairs)).reshape(4, -1).sum(0) for half, of in zip(x.halves(), maps))
            out[lo:hi] += np.bincount(x.token - lo, of_node[x.node], hi - lo)
        return out


# Gathering the lexicon.

def held_out(doc_id: Column, k: int = 7, r: int = 2) -> Column:
    """crc32 of the id as text leaves remainder ``r``; so does, by definition, a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % k == r, F.lit(True))


def _one_by_one(column: pa.ChunkedArray) -> Iterator[bytes | None]:
    """The texts of a column, a few of them copied at once."""
    for chunk in column.chunks:
        for at in range(0, len(chunk), TEXTS):
            yield from texts(chunk.slice(at, TEXTS))


def _in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``BATCH_BYTES``, so that neither side of the pipe holds all rows at once."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= BATCH_BYTES:
            yield from table_batches(dict(zip(schema.names, zip(*held))), schema)
            held, size = [], 0
    if held:
        yield from table_batches(dict(zip(schema.names, zip(*held))), schema)


class _Tokens:
    """Tokens of documents and their distinct (previous word, word) pairs; the end is the empty word.

    The words of one text are held at a time; of the rest only their numbers. ``places``: the pair of every token too.
    """

    def __init__(self, column: pa.ChunkedArray, places: bool = False) -> None:
        memo = WordIds()
        memo[b""]  # the end has number 0
        ids, sizes = [], []
        for t in _one_by_one(column):
            words = (t or b"").lower().split()
            words.append(b"")
            ids.append(memo.ids(words).astype(np.int32))
            sizes.append(len(words))
        self.ids = np.concatenate(ids)
        del ids
        self.words = list(memo)
        code = np.zeros(len(self.ids), np.int64)
        code[1:] = self.ids[:-1]
        code *= len(memo)
        code += self.ids
        if places:
            code, self.pair, self.count = np.unique(code, return_inverse=True, return_counts=True)
        else:
            code.sort()
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            code, self.count = code[first], np.diff(first, append=len(code))
        self.prev, self.word = (x.astype(np.int32) for x in np.divmod(code, len(memo)))
        del code
        self.hash = memo.hashes()[0]
        self.sizes = np.array(sizes, np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes

    def buckets(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, its pairs, by previous word); the bucket is the leading part of the previous word's hash."""
        of = ((self.hash >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)[self.prev]
        by = np.argsort(of, kind="stable")
        at = np.flatnonzero(np.diff(of[by], prepend=-1))
        for i, j in zip(at.tolist(), [*at[1:].tolist(), len(by)]):
            yield int(of[by[i]]), by[i:j]

    def keys(self, pairs: np.ndarray) -> bytes:
        w = self.words
        return joined(zip(map(w.__getitem__, self.prev[pairs].tolist()), map(w.__getitem__, self.word[pairs].tolist())))


def _counted(docs: DataFrame, buckets: int) -> DataFrame:
    """Counts of the pairs of a batch, one array for each bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches, "text", COUNT_BYTES):
            t = _Tokens(table.column("text"))
            del table
            yield from _in_batches(((b, t.keys(pairs), planes(t.count[pairs])) for b, pairs in t.buckets(buckets)), schema)
            del t

    return docs.select("text").mapInArrow(run, "bucket int, keys binary, counts binary")


LEXICON = pa.schema([("bucket", pa.int32()), ("distinct", pa.int64()), ("tokens", pa.int64()), ("keys", pa.binary()),
                     ("counts", pa.binary())])


def _union(column: pa.ChunkedArray) -> tuple[list[bytes], list[np.ndarray]]:
    """Distinct keys in byte order, and the place of every key of every blob."""
    blobs = [parted(b) for b in column.to_pylist()]
    keys = sorted(set().union(*blobs))
    at = {k: i for i, k in enumerate(keys)}
    return keys, [np.fromiter(map(at.__getitem__, b), np.int64, len(b)) for b in blobs]


def _merge(table: pa.Table) -> pa.Table:
    """One bucket of the lexicon, pairs in byte order; as every token is followed by one, previous words count all tokens."""
    keys, places = _union(table.column("keys"))
    total = np.zeros(len(keys), np.int64)
    for at, counts in zip(places, table.column("counts").to_pylist()):
        total[at] += unplanes(counts, np.int64)
    return pa.Table.from_pylist([{"bucket": table.column("bucket")[0].as_py(), "distinct": len({split_key(k)[0] for k in keys}),
                                  "tokens": int(total.sum()), "keys": joined(map(split_key, keys)), "counts": planes(total)}], schema=LEXICON)


def _entries(keys: bytes, counts: bytes) -> tuple[list[bytes], np.ndarray]:
    return parted(keys), unplanes(counts, np.int64)


TABLE = pa.schema([("block", pa.int32()), ("slots", pa.binary()), ("n0", pa.binary()), ("n1", pa.binary())])


def _train_counts(lexicon: DataFrame, tasks: int) -> np.ndarray:
    """log2(count + 1) of zeros and ones of every shared slot, summed over all training tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for b in batches:
            for keys, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts = counts or Counts()
                counts.add(*_entries(keys, n))
        if counts is None:
            return
        for i, at in enumerate(range(0, len(counts.n), BLOCK)):
            block = counts.n[at:at + BLOCK]
            slots = np.flatnonzero(block.any(1))
            if len(slots):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([planes(slots.astype(np.uint16))], pa.binary()),
                     *[pa.array([planes(x[slots])], pa.binary()) for x in block.T]], schema=TABLE)

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((2, BLOCK), np.int64)
        for s, *n in zip(*(table.column(c).to_pylist() for c in ("slots", "n0", "n1"))):
            at = unplanes(s, np.uint16)
            for k in (0, 1):
                total[k][at] += unplanes(n[k], np.uint32 if len(n[k]) == 4 * len(at) else np.int64)
        logs = np.log2(total + 1).astype(np.float16)
        return pa.Table.from_pylist([{"block": table.column("block")[0].as_py(), "logs": logs.tobytes()}],
                                    schema=pa.schema([("block", pa.int32()), ("logs", pa.binary())]))

    tables = (lexicon.select("keys", "counts", "bucket").repartition(tasks, "bucket").select("keys", "counts")
              .mapInArrow(run, "block int, slots binary, n0 binary, n1 binary")
              .groupBy("block").applyInArrow(add, "block int, logs binary"))
    out = np.zeros((2, int(_OFFSETS[-1]) + BLOCK), np.float16)
    for r in tables.collect():  # a fixed number of slots, whatever the corpus
        out[:, r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.logs, np.float16).reshape(2, -1)
    return out[:, :int(_OFFSETS[-1])]


def _train_weights(lexicon: DataFrame, tasks: int, logs) -> tuple[np.ndarray, ...]:
    """Weights averaged over the tasks by tokens, and the summed hits and totals of the refining map."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, tokens = None, 0
        for b in batches:
            for blob, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                mixer = mixer or Mixer(logs.value, loo=True)
                keys, weight = _entries(blob, n)
                mixer.learn(keys, weight, PairCounts(keys, weight))
                tokens += int(weight.sum())
        if mixer is not None:
            x = np.concatenate([mixer.weights.ravel() * tokens, mixer.hits, mixer.total, [tokens]])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], names=["sums"])

    sums = (lexicon.select("keys", "counts", "bucket").repartition(tasks, "bucket").select("keys", "counts")
            .mapInArrow(run, "sums binary").collect())  # a row of fixed size per task
    total = sum(np.frombuffer(x, np.float64) for x in sorted(bytes(r.sums) for r in sums))
    w, hits, seen = np.split(total[:-1], [GATES * INPUTS, GATES * INPUTS + 64 * BINS])
    return (w / max(total[-1], 1)).reshape(GATES, INPUTS).astype(np.float32), hits, seen


@dataclass
class Model:
    """What the mixer has learned, and the broadcast tables it belongs to."""
    logs: object
    learned: tuple[np.ndarray, ...] | None

    def mixer(self) -> Mixer:
        m = Mixer(self.logs.value)
        if self.learned is not None:
            m.weights, m.hits, m.total = self.learned
        return m


ASKED = pa.schema([("bucket", pa.int32()), ("pack", pa.int32()), ("keys", pa.binary())])
TOLD = pa.schema([("pack", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("scores", pa.binary())])
RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("base_sum", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())])


def _ask(table: pa.Table, buckets: int) -> pa.Table:
    t = _Tokens(table.column("text"))
    pack = table.column("pack")[0].as_py()
    rows = [(b, pack, t.keys(pairs)) for b, pairs in t.buckets(buckets)]
    return pa.Table.from_pydict(dict(zip(ASKED.names, zip(*rows))), schema=ASKED)


_MIXERS: dict[str, Mixer] = {}


def _tell(asked: pa.Table, lexicon: pa.Table, model: Model, name: str) -> pa.Table:
    """Training count of the previous word and code length of every asked pair; each pair is computed once a bucket."""
    if not asked.num_rows:
        return TOLD.empty_table()
    seen, weight, known = [], np.zeros(0, np.int64), {}
    for blob, n in zip(lexicon.column("keys").to_pylist(), lexicon.column("counts").to_pylist()):
        seen, weight = _entries(blob, n)
        lines = blob.split(b"\n")  # one for each previous word
        followers = np.fromiter((line.count(b" ") for line in lines), np.int64, len(lines))
        known = dict(zip((line.partition(b" ")[0] for line in lines), np.add.reduceat(weight, np.cumsum(followers) - followers).tolist()))
    pairs = PairCounts(seen, weight)
    keys, places = _union(asked.column("keys"))
    count = np.fromiter((known.get(k.partition(b" ")[0], 0) for k in keys), np.int64, len(keys))
    if name not in _MIXERS:  # tables are decoded once a worker
        _MIXERS.clear()
        _MIXERS[name] = model.mixer()
    score = _MIXERS[name].log10(keys, pairs)
    bucket = asked.column("bucket")[0].as_py()
    rows = [(p, bucket, planes(count[i]), planes(score[i].astype(np.float32))) for p, i in zip(asked.column("pack").to_pylist(), places)]
    return pa.Table.from_pydict(dict(zip(TOLD.names, zip(*rows))), schema=TOLD)


def _score(table: pa.Table, told: pa.Table, buckets: int) -> pa.Table:
    if not table.num_rows:
        return RESULT.empty_table()
    t = _Tokens(table.column("text"), places=True)
    answers = dict(zip(told.column("bucket").to_pylist(), zip(*(told.column(c).to_pylist() for c in ("counts", "scores")))))
    count, score = np.zeros(len(t.words), np.int64), np.zeros(len(t.prev))
    for b, pairs in t.buckets(buckets):
        counts, scores = answers[b]
        count[t.prev[pairs]] = unplanes(counts, np.int64)  # every word of a pack is some token's previous word
        score[pairs] = unplanes(scores, np.float32)
    # The last token of the pack is an end, the previous word of the first one.
    total = lambda x: np.add.reduceat(x, t.first)
    size = np.array([len(w) + 1 for w in t.words], np.int64)
    return pa.Table.from_pydict({
        "doc_id": table.column("doc_id").to_pylist(), "held_out": table.column("held_out").to_pylist(), "n_tokens": t.sizes,
        "n_known": total((count[t.ids] > 0).astype(np.int64)), "base_sum": total(np.log10(count[t.ids] + 1.0)),
        "score": total(score[t.pair]), "n_bytes": total(size[t.ids])}, schema=RESULT)


def score_texts(docs: DataFrame) -> DataFrame:
    """log10 probability of every whole text under the mixing model and the add-one unigram base.

    Learns from documents that are not held out (crc32 of doc_id as text, modulo 7, is not 2). Tokens: the lower-cased
    (A-Z) words and one end. Returns one row per document: doc_id, held_out, n_tokens, n_known (tokens seen in training),
    train_tokens, base_score, score (all bits of all tokens) and bits_per_byte (its bits over the bytes of the word stream).

    Null text: empty, only the end. Null ids are held out. Without training documents every word is unknown, every bit
    has about the probability 1/2, and every base count is 0. Repeated rows score alike (and count each in training); an id
    that many rows share is no group. A word of any length is predicted in pieces. Other columns are ignored; an empty table gives
    an empty result.

    Scale: pair counts move once per counting batch and distinct pair; texts move once, into packs that ask for each of
    their distinct pairs once; buckets follow the text's bytes, except that one previous word's followers are one
    bucket, at most one entry a distinct word; the shared tables have a fixed size and are sent to the executors.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id").cast("long")).alias("held_out"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    buckets = pack_count(docs, "text", BUCKET_BYTES)
    with shuffles_dropped(spark):
        lexicon = stored(_counted(docs.where("not held_out"), buckets).groupBy("bucket").applyInArrow(
            _merge, "bucket int, distinct long, tokens long, keys binary, counts binary"), "lexicon")
        distinct, train_tokens, size = (int(x or 0) for x in lexicon.agg(
            F.sum("distinct"), F.sum("tokens"), F.sum(F.length("keys"))).first())
        tasks = max(1, math.ceil(size / TRAIN_BYTES))
        shared = spark.sparkContext.broadcast(_train_counts(lexicon, tasks))
        model = Model(shared, _train_weights(lexicon, tasks, shared) if train_tokens else None)
    name = uuid.uuid4().hex

    n = pack_count(docs, "text")
    packed = docs.withColumn("pack", hashed_pack(F.struct("doc_id", "text"), n))
    asked = packed.groupBy("pack").applyInArrow(lambda t: _ask(t, buckets), "bucket int, pack int, keys binary")
    told = asked.groupBy("bucket").cogroup(lexicon.groupBy("bucket")).applyInArrow(
        lambda a, b: _tell(a, b, model, name), "pack int, bucket int, counts binary, scores binary")
    scored = packed.groupBy("pack").cogroup(told.groupBy("pack")).applyInArrow(
        lambda a, b: _score(a, b, buckets),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_sum double, score double, n_bytes long")
    base = F.col("base_sum") - F.col("n_tokens") * F.lit(math.log10(train_tokens + distinct + 1))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
                         base.alias("base_score"), "score", (-F.col("score") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"))
