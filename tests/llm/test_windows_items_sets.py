"""Window dedup, decontamination and the Jaccard join against brute force."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from reviewkit.llm import partition_join, suffix_decontam
from reviewkit.llm.components import components
from reviewkit.llm.partition_join import bands, folded, intersections, jaccard_components, scheme, sketch, skips
from reviewkit.llm.suffix_decontam import decontaminate, suffix_array
from reviewkit.llm.window_dedup import dedup_windows
from tests.llm import brute

DOCS = "doc_id long, text string"


def corpus(seed=1, n=60):
    """Copies, near copies, shared passages, short, empty, null and long texts, ties, repeated rows, null ids."""
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(40)] + ["Été,", "ein.", "THE", "a b", "x-y"]
    words = lambda k: [r.choice(vocabulary) for _ in range(k)]
    base, passage = words(120), words(20)
    texts = [None, "", " \n\t ", "one", "one two", "One  TWO", "a b c", "a b c d"]
    for k in range(n):
        kind = k % 6
        if kind == 0:
            texts.append(" ".join(base))
        elif kind == 1:
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w))
        elif kind == 2:
            texts.append("\n".join(words(r.randint(1, 30)) + passage + words(r.randint(0, 30))))
        else:
            texts.append(" ".join(words(r.randint(1, 40))))
    texts.append(" ".join(words(30_000)))
    rows = list(zip(range(1000, 1000 + 7 * len(texts), 7), texts))
    r.shuffle(rows)
    rows += rows[:5] + [(None, " ".join(base)), (None, " ".join(base)), (None, "only here " * 20), (2 ** 50, " ".join(base[:50]))]
    return rows, passage


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, docs):
    """With columns named like results and helpers."""
    df = spark.createDataFrame(docs, DOCS)
    return df.selectExpr("doc_id", "text", "1 AS pack", "'x' AS bucket", "2.0 AS n_words", "null AS key", "3 AS u", "4 AS set")


def test_window_dedup(spark, rows):
    got = dedup_windows(frame(spark, rows[0]), keep_text=True).collect()
    assert brute.by_text(tuple(r)[:4] for r in got) == brute.window_dedup(rows[0])
    for r in got:
        assert sum(b - a for a, b in r.intervals) == r.n_removed
        assert all(x[1] < y[0] for x, y in zip(r.intervals, r.intervals[1:]))  # maximal
        assert r.kept_text is None or len(r.kept_text.encode().split()) == r.n_words - r.n_removed


def test_window_dedup_many_null_ids_and_equal_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = [(None, text)] * 50 + [(5, text), (5, text), (9, text)]
    assert brute.by_text(tuple(r)[:4] for r in dedup_windows(frame(spark, docs)).collect()) == brute.window_dedup(docs)


@pytest.mark.parametrize("n,ranges", [(1, 8), (8, 8), (64, 4), (7, 3), (64, 4096)])
def test_ordered_packs_keep_the_order_of_ids(spark, n, ranges):
    from pyspark.sql import functions as F

    from reviewkit.llm.packs import ordered_pack
    ids = [*range(0, 3000, 3), *range(10 ** 12, 10 ** 12 + 500), -5, 2 ** 62, -2 ** 62, 7, 7, None, None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = [(r.doc_id, r.p) for r in df.select("doc_id", ordered_pack(df, "doc_id", n, ranges).alias("p")).collect()]
    assert {p for i, p in got if i is None} == {n}
    known = sorted((i, p) for i, p in got if i is not None)
    packs = [p for _, p in known]
    assert packs == sorted(packs) and min(packs) >= 0 and max(packs) < n
    if n == 8:  # even, though the ids are not
        assert max(packs.count(p) for p in set(packs)) < 3 * len(packs) / n


def test_decontaminate(spark, rows):
    docs, passage = rows
    bench = [(1, " ".join(passage)), (10, "x ".join(passage[:14])), (2, "one two"), (2, None), (3, ""), (None, " ".join(docs[0][1].split()[:12]) if docs[0][1] else "one"),
             (4, "ONE"), (5, "w1 w2"), (5, "w1 w2"), (6, "never seen words at all")]
    items = spark.createDataFrame(bench, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS block")
    got = decontaminate(frame(spark, docs), items).collect()
    assert brute.by_text(tuple(r)[:6] for r in got) == brute.decontaminate(docs, bench)
    text = {str(i): brute.ALNUM.findall(brute.lower(t)) for i, t in docs}
    item = {i: [brute.ALNUM.findall(brute.lower(t)) for j, t in bench if j == i] for i, _ in bench}
    for r in got:
        if r.contaminated and list(text).count(str(r.doc_id)) == 1:
            match = text[str(r.doc_id)][r.longest_at:r.longest_at + r.longest]
            assert any(match == w[k:k + r.longest] for w in item[r.longest_item] for k in range(len(w)))


def test_decontaminate_in_blocks_gives_the_same(spark, rows, monkeypatch):
    bench = [(i, " ".join(rows[1][:10 + i])) for i in range(8)] + [(20, "one two")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    monkeypatch.setattr(suffix_decontam, "BLOCK_BYTES", 100)
    got = decontaminate(frame(spark, rows[0]), items).collect()
    assert brute.by_text(tuple(r)[:6] for r in got) == brute.decontaminate(rows[0], bench)


@pytest.mark.parametrize("same", [True, False])
def test_copies_on_both_sides_are_not_multiplied(same, monkeypatch):
    """Items and documents that share a passage: rows grow with their sum, not with their product."""
    passage = ["p%d" % i for i in range(40)]
    bench = [(i, " ".join(passage + ([] if same else ["own%d" % i]))) for i in range(300)]
    docs = [(i, " ".join(["d%d" % i] + passage)) for i in range(200)]
    block = suffix_decontam.Benchmark([(i, t.encode()) for i, t in bench], 10)
    most, ranges = [0], suffix_decontam._ranges

    def counted(lo, hi):
        most.append(int((hi - lo).sum()))
        return ranges(lo, hi)

    monkeypatch.setattr(suffix_decontam, "_ranges", counted)
    table = pa.table({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]})
    got = suffix_decontam._shard(table, [SimpleNamespace(value=block)]).to_pylist()
    assert brute.by_text(tuple(r.values())[:6] for r in got) == brute.decontaminate(docs, bench)
    assert {(r["longest"], r["longest_item"], r["longest_at"]) for r in got} == {(40, 0, 1)}
    assert max(most) <= 2 * 42 * len(docs)


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_is_sorted(seed):
    ids = np.random.default_rng(seed).integers(0, 4, 300)
    ids = np.concatenate([ids, [0]])
    suffix = lambda p: ids[p:p + np.flatnonzero(ids[p:] == 0)[0]].tolist()
    sa = suffix_array(ids)
    assert sorted(sa.tolist()) == np.flatnonzero(ids).tolist()
    assert all((suffix(a), a) <= (suffix(b), b) for a, b in zip(sa, sa[1:]))


def test_jaccard(spark, rows):
    got = jaccard_components(frame(spark, rows[0])).collect()
    assert brute.by_text(tuple(r) for r in got) == brute.jaccard(rows[0])


def test_jaccard_at_pipeline_parameters_and_small_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(partition_join, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(partition_join, "STRIP", 3)
    monkeypatch.setattr(partition_join, "COLUMNS", 16)
    got = jaccard_components(frame(spark, rows[0]), 5, 80).collect()
    assert brute.by_text(tuple(r) for r in got) == brute.jaccard(rows[0], 5, 80)


@pytest.mark.parametrize("t", [80, 90])
def test_every_linked_pair_shares_a_signature(t):
    """Sets at the edge of the threshold, of many sizes, next to the bands' ends."""
    rng = np.random.default_rng(t)
    signer = partition_join._Signer(t)
    for n in [*range(1, 40), 60, 97, 150, 400, 1500]:
        for _ in range(20):
            union = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
            lost = rng.permutation(n)[:n * (100 - t) // 100]  # at most this many of the union are not shared
            to = rng.integers(0, 2, len(lost)).astype(bool)
            a, b = (np.unique(np.delete(union, lost[to])), np.unique(np.delete(union, lost[~to])))
            if len(a) and len(b):
                assert np.intersect1d(signer.signatures(a), signer.signatures(b)).size, (n, len(a), len(b))


def test_bands_and_schemes_cover_the_distance():
    lows = bands(5000)
    assert all(a < b for a, b in zip(lows, lows[1:]))
    for low, high in zip(lows, lows[1:]):
        for t in (80, 90):
            m, deletions, slack = scheme(low, high, t)
            assert m + deletions >= 2 * (high - 1) * (100 - t) // (100 + t) + 1 + 2 * slack and deletions + slack <= m
            assert not (deletions and slack)  # a list left out is one unit of the budget
            assert all(skips(n, t) <= slack for n in range(low, high))


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 400, rng.integers(1, 2000)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(2))
        rows = folded([sketch(a), sketch(b)])
        assert np.abs(rows[0] - rows[1]).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("size", [60, 120, 200, 320, 350, 600, 1500])
def test_sketches_of_unrelated_sets_are_far(size):
    """No pair of 1,000 sets is near: a few in a thousand would chain a large corpus to one candidate group."""
    rng = np.random.default_rng(size)
    sets = [rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in rng.integers(size * 9 // 10, size, 1000)]
    of, n = folded([sketch(s) for s in sets]), np.array([len(s) for s in sets])
    assert sum(len(i) for i, _ in partition_join._near(of[:500], n[:500], of[500:], n[500:], 80)) == 0
    (i, j), = partition_join._near(of[:1], n[:1], of[:1], n[:1], 80)
    assert (i.tolist(), j.tolist()) == ([0], [0])


def test_each_band_leaves_out_its_own_lists(spark):
    """A set that signs in two bands leaves out as many long lists in each as that band allows, whatever its own size."""
    band = int(np.searchsorted(bands(400), 350, side="right")) - 1
    allowed = [skips(bands(400)[band + i + 1], 80) for i in (0, 1)]
    rows = [((list_ << 8) | (band + i), s, True) for i in (0, 1) for list_ in range(12) for s in range(4)]
    kept = partition_join._lists(spark.createDataFrame(rows, "gid long, short long, costly boolean"), 80).collect()
    for i in (0, 1):
        assert sum(r.gid & 255 == band + i for r in kept) == 4 * (12 - allowed[i])


@pytest.mark.parametrize("hot", [4, 10 ** 6])
def test_long_and_hot_posting_lists(spark, monkeypatch, hot):
    """Families whose lists are costly, spread, cut into blocks and partly left out."""
    r = random.Random(9)
    docs = []
    for f in range(4):
        base = [f"f{f}w{i}" for i in range(300)]
        for v in range(60):
            w = list(base)
            for _ in range(r.choice([0, 1, 3, 8, 12])):
                w[r.randrange(300)] = f"x{r.randrange(10 ** 6)}"
            docs.append((f * 1000 + v, " ".join(w + [f"tail{v % 7}"] * (v % 3))))
    monkeypatch.setattr(partition_join, "COSTLY", 3)
    monkeypatch.setattr(partition_join, "HOT", hot)
    monkeypatch.setattr(partition_join, "LIST_BLOCK", 8)
    monkeypatch.setattr(partition_join, "BATCH_BYTES", 50_000)
    for k, t in ((3, 90), (5, 80)):
        got = jaccard_components(frame(spark, docs).repartition(5), k, t).collect()
        assert brute.by_text(tuple(x) for x in got) == brute.jaccard(docs, k, t)


def test_jaccard_of_rows_that_share_an_id(spark, rows):
    """A third of all rows under one id, each with a near copy: every text is held once in a block, and no link is lost."""
    r = random.Random(11)
    docs = []
    for i in range(60):
        words = ["t%d" % r.randrange(400) for _ in range(80)]
        docs.append((7 if i % 3 == 0 else 100 + i, " ".join(words)))
        docs.append((1000 + i if i % 3 else 7, " ".join(words[:-1] + ["end%d" % i])))
    got = jaccard_components(frame(spark, docs), 3, 90).collect()
    assert brute.by_text(tuple(x) for x in got) == brute.jaccard(docs, 3, 90)
    keyed = frame(spark, docs).selectExpr("xxhash64(doc_id, text) AS key")
    assert keyed.distinct().count() == len(set(docs))


def test_intersections():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 50, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets[:10]] for a in sets])
    assert (intersections(sets, sets[:10]) == want).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (3, 1), (1, 3), (2, 3), (None, 4)]
    hub = [(500, 500 + i) for i in range(1, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + hub, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in (1, 2, 3)}, **{i: 500 for i in range(500, 700)}}


def test_empty_tables(spark):
    empty, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert dedup_windows(empty).count() == jaccard_components(empty).count() == decontaminate(empty, items).count() == 0
    docs = frame(spark, [(1, "a b"), (2, None)])
    assert [r.n_hit for r in decontaminate(docs, items).collect()] == [0, 0]
    assert [r.n_shingles for r in jaccard_components(docs).orderBy("doc_id").collect()] == [1, 0]
