"""Quality classifier, LM scoring: rules of the contracts, brute-force base, held-out gain, proper probabilities."""

import math
import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from reviewkit.llm import mixing_lm, pu_quality
from reviewkit.llm.mixing_lm import Counts, Mixer, PairCounts, bits_of, runs, score_texts
from reviewkit.llm.packs import hashed_pack
from reviewkit.llm.pu_quality import FEATURES, estimate_prior, features, fit, score_quality
from tests.llm import brute


def held(i, k, r):
    return i is None or zlib.crc32(str(i).encode()) % k == r


def good_and_bad(n=400, seed=2):
    r = random.Random(seed)
    parts = ["ta", "ren", "so", "li", "mo", "ke", "dun", "ar"]
    word = lambda: "".join(r.choice(parts) for _ in range(r.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(r.randint(5, 120))]
        good = r.random() < 0.7
        docs.append((i, " ".join(w).capitalize() + "." if good else " ".join(x.upper() + "!!" for x in w)))
        if r.random() < 0.4:
            labels.append((i, int(good), 0))
    return docs, labels


def test_quality_separates_held_out_documents(spark):
    docs, labels = good_and_bad()
    extra = docs + [(None, docs[0][1]), (5000, None), (5001, ""), docs[3], docs[3], (5002, docs[1][1] * 300)]
    df = spark.createDataFrame(extra, "doc_id long, text string").selectExpr("*", "9.0 AS score", "1 AS p", "'x' AS source")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'clash' AS text")
    got = score_quality(df, lab).collect()
    assert len(got) == len(extra)
    good = {i: t.endswith(".") for i, t in docs}
    for r in got:
        assert r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    judged = [r for r in got if r.held_out and r.doc_id in good]
    assert np.mean([r.predicted == good[r.doc_id] for r in judged]) > 0.95
    assert len({r.score for r in got if r.doc_id in (5000, 5001)}) == 1
    assert len({r.score for r in got if r.doc_id == docs[3][0]}) == 1
    assert 0.55 < got[0].prior < 0.85
    kept = score_quality(df, lab, keep=True)
    assert kept.columns[:5] == df.columns and kept.count() == len(extra)


def test_quality_never_reads_held_out_labels_other_columns_or_negatives(spark):
    docs, labels = good_and_bad(200)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    schema = "doc_id long, quality int, toxic int"
    one = {r.doc_id: r.score for r in score_quality(df, spark.createDataFrame(labels, schema)).collect()}
    flipped = [(i, 1 - q if held(i, 5, 0) else q, 1) for i, q, _ in labels if held(i, 5, 0) or q == 1]
    two = {r.doc_id: r.score for r in score_quality(df, spark.createDataFrame(flipped, schema)).collect()}
    assert one == two


def test_quality_is_fitted_on_one_row_of_an_id(spark, monkeypatch):
    docs, labels = good_and_bad(200)
    hot = next(i for i, q, _ in labels if q == 1 and not held(i, 5, 0))
    rows = docs + [(hot, "copy %d of the id" % k) for k in range(100)]
    seen = []
    monkeypatch.setattr(pu_quality, "fit", lambda p, u: seen.append((len(p), len(u))) or fit(p, u))
    score_quality(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    ids = {i for i, _ in docs if not held(i, 5, 0)}
    assert seen == [(sum(q == 1 and i in ids for i, q, _ in labels), len(ids))]


def test_quality_without_positives_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, quality int")
    assert {r.score for r in score_quality(df, none).collect()} == {0.5}
    assert score_quality(df.where("false"), none).count() == 0


def test_features_are_finite_on_any_text():
    for t in (None, b"", b"\n", b" ", "é".encode() * 3, b"\x00", b"A" * 100_000, b"a b\n" * 50_000):
        x = features(t)
        assert x.shape == (FEATURES,) and np.isfinite(x).all()


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.8])
def test_prior_and_non_negative_risk(prior):
    rng = np.random.default_rng(1)
    make = lambda n, at: rng.normal(at, 1, (n, 4))
    positive = make(3000, 1.5)
    n = int(6000 * prior)
    unlabelled = np.concatenate([make(n, 1.5), make(6000 - n, -1.5)])
    model = fit(positive, unlabelled)
    assert abs(model.prior - prior) < 0.06
    s = model.score(unlabelled)
    assert ((s >= 0.5) == (np.arange(6000) < n)).mean() > 0.97
    assert abs(estimate_prior(positive[:, 0], unlabelled[:, 0]) - prior) < 0.12


def test_lm_base_counts_and_gain(spark):
    docs, _ = good_and_bad(300, 4)
    docs += [(900, None), (901, ""), (902, " \n"), (None, docs[0][1]), docs[5], docs[5], (903, docs[7][1] * 200), (904, "zzz Été zzz")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS pack", "'x' AS score", "2 AS kinds")
    got = score_texts(df).collect()
    assert len(got) == len(docs)
    tokens = lambda t: brute.WORD.findall(brute.lower(t)) + [b""]
    count = Counter()
    for i, t in docs:
        if not held(i, 7, 2):
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(x), sum(count[w] > 0 for w in x), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x), 6))
                  for i, t in docs for x in [tokens(t)])
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.held_out == held(r.doc_id, 7, 2) and r.score < 0 for r in got)
    assert len({(r.score, r.bits_per_byte) for r in got if r.doc_id == docs[5][0]}) == 1


def test_lm_without_training_and_empty(spark):
    only_held = next(i for i in range(100) if held(i, 7, 2))
    df = spark.createDataFrame([(only_held, "a b"), (None, "c")], "doc_id long, text string")
    for r in score_texts(df).collect():
        assert r.train_tokens == r.n_known == 0 and r.base_score == 0 and r.score < 0
    assert score_texts(df.where("false")).count() == 0


def model(keys, n):
    counts = Counts()
    n = np.array(n)
    counts.add(keys, n)
    pairs = PairCounts(keys, n)
    learner = Mixer(np.log2(counts.n.T + 1).astype(np.float16), loo=True)
    learner.learn(keys, n, pairs)
    m = Mixer(np.log2(counts.n.T + 1).astype(np.float16))
    m.weights, m.hits, m.total = learner.weights, learner.hits, learner.total
    return m, pairs


def test_lm_probabilities_sum_to_one():
    keys, n = [b" the", b"of the", b"the ", b"the of", b"the then", b"then x"], [5, 40, 5, 20, 2, 1]
    m, pairs = model(keys, n)
    # The 256 values of a word's first byte, after the same word, share exactly one.
    x = bits_of([(c, b"\n\nthe ", bytes([c]), xxhash.xxh3_64_intdigest(b"the")) for c in range(256)])
    p = m.probability(x, pairs).reshape(8, -1)[:, x.node].astype(float).prod(0)
    assert abs(p.sum() - 1) < 1e-4
    first = dict(zip(x.token.tolist(), p))
    assert first[ord("o")] > first[ord("q")]
    score = dict(zip(keys, m.log10(keys, pairs)))
    assert (np.array(list(score.values())) < 0).all() and score[b"the of"] > score[b"the then"]


def test_pairs_of_one_word_are_one_line():
    keys = [b" ", b" a", b"a ", b"a b", b"a c", b"a\x01 b", b"b "]
    blob = mixing_lm.joined(map(mixing_lm.split_key, keys))
    assert mixing_lm.parted(blob) == keys and blob.count(b"\n") == 3
    assert mixing_lm.parted(mixing_lm.joined([(b"", b"")])) == [b" "]


def test_tokens_hold_the_words_of_one_text_at_a_time():
    r = random.Random(5)
    said = [" ".join(r.choice(["La", "mi", "do", "re"]) + str(r.randint(0, 40)) for _ in range(400)) for _ in range(700)] + [None, ""]
    column = pa.chunked_array([pa.array(said[:300]), pa.array(said[300:])])
    mixing_lm._Tokens(column)
    tracemalloc.start()
    t = mixing_lm._Tokens(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 * len(t.ids)  # a word held as an object takes about 40 bytes more
    want, prev = Counter(), b""
    for text in said:
        for w in [*(text or "").lower().encode().split(), b""]:
            want[prev, w] += 1
            prev = w
    got = {(t.words[p], t.words[w]): n for p, w, n in zip(t.prev.tolist(), t.word.tolist(), t.count.tolist())}
    assert got == want
    placed = mixing_lm._Tokens(column, places=True)
    assert placed.prev.tolist() == t.prev.tolist() and placed.word[placed.pair].tolist() == placed.ids.tolist()


def test_counts_leave_in_batches_of_bounded_size(monkeypatch):
    monkeypatch.setattr(mixing_lm, "BATCH_BYTES", 100)
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary())])
    batches = list(mixing_lm._in_batches(((i, b"x" * 40) for i in range(10)), schema))
    assert [b.num_rows for b in batches] == [3, 3, 3, 1]
    assert [i for b in batches for i in b.column(0).to_pylist()] == list(range(10))


def test_fit_holds_the_sample_once():
    x = np.random.default_rng(3).random((3000, FEATURES), np.float32)
    tracemalloc.start()
    model = fit(x[:1000] + np.float32(0.2), x[1000:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4.5 * x.nbytes  # in double precision: the sample (2) and half of it (1), and the shifted rows (1/3)
    both = np.concatenate([x[:1000] + np.float32(0.2), x[1000:]]).astype(np.float64)
    assert np.allclose(model.mean, both.mean(0)) and np.allclose(model.scale, np.maximum(both.std(0), 1e-3))


def test_bits_rebuild_the_bytes(monkeypatch):
    keys = [b" ab", b"ab ", b"ab abc", b"ab abd", "ab é".encode(), b"x " + b"z" * 300]
    stream = b"ab \nabc abd \xc3\xa9 " + b"z" * 300 + b" "
    read = lambda x: np.packbits(x.bit.reshape(8, -1).T, axis=1).ravel()[x.node].tobytes()
    (x,) = runs(keys)
    assert read(x) == stream and len(x.bit) // 8 == len(stream) - 2  # abc and abd share two nodes
    assert x.slots.min() >= 0 and x.slots.max() < sum(1 << b for b in mixing_lm.SLOT_BITS)
    assert x.weights(np.array([1, 1, 5, 7, 1, 2])).sum() == 8 * (3 + 1 + 20 + 28 + 3 + 602)
    # A pair's bits do not depend on its neighbours; pieces of a long word carry all its bytes.
    (alone,) = runs([keys[3]])
    at = x.node[x.token == 3]
    assert (x.slots.reshape(5, 8, -1)[:, :, at] == alone.slots.reshape(5, 8, -1)[:, :, alone.node]).all()
    monkeypatch.setattr(mixing_lm, "PIECE", 64)
    monkeypatch.setattr(mixing_lm, "CHUNK", 100)
    parts = list(runs(keys))
    assert b"".join(map(read, parts)) == stream and max(len(p.node) for p in parts) < 164
    assert sum(int((p.token == 5).sum()) for p in parts) == 301


def test_bits_of_keys_are_those_of_their_units():
    r = random.Random(9)
    word = lambda: "".join(r.choice("ab\u00e9\x01-") for _ in range(r.randint(1, 9))).encode()
    keys = sorted({b" ".join([p, w]) for p in [b"", b"a", b"ab", *(word() for _ in range(40))] for w in [b"", *(word() for _ in range(30))]})
    x, y = mixing_lm._bits_of_keys(keys, 0, True), mixing_lm.bits_of(list(mixing_lm._units(keys)))
    assert (x.slots == y.slots).all() and (x.pair == y.pair).all() and (x.byte == y.byte).all()
    assert (x.node == y.node).all() and (x.token == y.token).all()
    # Nodes are the distinct beginnings of a word after one previous word.
    stems = {(p, (w + b" " if w else b"\n")[:i + 1]) for p, w in map(mixing_lm.split_key, keys) for i in range(len(w) + 1)}
    assert len(x.byte) == len(stems)


def test_a_buckets_own_table_hashes_no_shared_context(monkeypatch):
    keys = sorted({b"a %d" % i for i in range(3000)})
    weight = np.ones(len(keys), np.int64)
    hashed, plain = [], mixing_lm.mix
    monkeypatch.setattr(mixing_lm, "mix", lambda x: hashed.append(len(x)) or plain(x))
    own = PairCounts(keys, weight)
    assert sum(hashed) < 5.1 * sum(len(k) - k.index(b" ") for k in keys)  # of every byte; with the shared contexts 7.9
    assert own.n.sum() == 8 * sum(len(k) - k.index(b" ") for k in keys)


def test_shared_counts_are_small_numbers_until_they_do_not_fit():
    counts, keys = Counts(), [b" the", b"the "]
    counts.add(keys, np.array([3, 2]))
    few = counts.n.copy()
    assert counts.n.dtype == np.uint32 and few.sum() == 5 * 8 * (4 * 3 + 1 * 2)
    counts.add(keys, np.array([3, 2]) << 30)
    assert counts.n.dtype == np.int64 and (counts.n == few.astype(np.int64) * ((1 << 30) + 1)).all()


def test_a_large_own_table_takes_a_byte_a_count(monkeypatch):
    keys = sorted({b"a %d" % i for i in range(9000)})
    weight = np.where(np.arange(len(keys)) % 50 == 0, 1 << 20, 1) + np.arange(len(keys)) % 7
    wide = PairCounts(keys, weight)
    monkeypatch.setattr(mixing_lm, "LARGE", 1 << 10)
    tracemalloc.start()
    narrow = PairCounts(keys, weight)
    narrow_peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert narrow.n.nbytes == wide.n.nbytes // 4 and narrow_peak < wide.n.nbytes + 24_000_000
    exact = narrow.n.astype(np.int64)
    for i, n in narrow.over.items():
        exact[i] = n
    assert (exact == wide.n).all() and 0 < len(narrow.over) < 0.2 * np.count_nonzero(exact)
    for x in runs(keys):
        for half in x.halves():
            for loo in (False, True):
                assert all((a == b).all() for a, b in zip(narrow.look(half, loo), wide.look(half, loo)))


def test_lm_training_leaves_no_shuffle_files(spark, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen, train = [], mixing_lm._train_weights
    monkeypatch.setattr(mixing_lm, "_train_weights", lambda *a: seen.append(spark.conf.get(key)) or train(*a))
    df = spark.createDataFrame([(i, "a b c") for i in range(20)], "doc_id long, text string")
    assert score_texts(df).count() == 20 and seen == ["true"] and spark.conf.get(key) == "false"


WRAP = (1 << 64) - 1


def scrambled(x):
    x &= WRAP
    for _ in range(2):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & WRAP
    return x ^ x >> 32


def walked(text):
    """Every bit of a text, occurrence by occurrence: ([(table, slot)], hash of the context with the previous word, bit)."""
    odd = [int(x) for x in mixing_lm._ODD]
    prev = b""
    for word in brute.WORD.findall(brute.lower(text)) + [b""]:
        body = word + b" " if word else b"\n"
        past = (b"\n" * 6 + (prev + b" " if prev else b"") + body)
        begin, run = len(past) - len(body), 0
        for place, byte in enumerate(body):
            contexts = []
            for k in mixing_lm.ORDERS:
                back = int.from_bytes(past[begin + place - k:begin + place], "big")
                contexts.append(scrambled(back + odd[k - 1 if k < 6 else 0]))
            contexts.append(scrambled(run + place))
            own = scrambled(contexts[-1] + xxhash.xxh3_64_intdigest(prev) * odd[1])
            for j in range(8):
                half = j // 4 * 4
                high = (byte >> 4) * odd[5] if half else 0
                so_far = (1 << j - half) | (byte >> 8 - j & (1 << j - half) - 1)
                slots = [(k, ((c + high) * odd[0] & WRAP) >> 64 - w ^ so_far) for k, (c, w) in enumerate(zip(contexts, mixing_lm.SLOT_BITS))]
                yield slots, scrambled(own + high) ^ so_far, byte >> 7 - j & 1, j
            run = (run + scrambled((byte + 1) * pow(odd[3], place + 1, 1 << 64))) & WRAP
        prev = word


def test_lm_agrees_with_a_walk_over_every_occurrence(spark, monkeypatch):
    """One bucket and given weights: the query's lengths by distinct pair equal a plain mixer's, bit by bit over the texts."""
    docs, _ = good_and_bad(20, 7)
    docs = [(i, t[:160]) for i, t in docs] + [(50, None), (51, docs[3][1][:160]), (52, "Été the the été"), (None, "the the")]
    rng = np.random.default_rng(3)
    weights = rng.uniform(0, 0.6, (mixing_lm.GATES, mixing_lm.INPUTS)).astype(np.float32)
    none = np.zeros(64 * mixing_lm.BINS)
    monkeypatch.setattr(mixing_lm, "pack_count", lambda *a: 1)
    monkeypatch.setattr(mixing_lm, "_train_weights", lambda *a: (weights, none, none))
    got = score_texts(spark.createDataFrame(docs, "doc_id long, text string")).collect()

    shared, own, pairs = Counter(), Counter(), set()
    train = [t or "" for i, t in docs if not held(i, 7, 2)]
    for t in train:
        words = [b""] + brute.WORD.findall(brute.lower(t)) + [b""]
        pairs.update(zip(words, words[1:]))
    mask = (1 << max(10, math.ceil(math.log2(mixing_lm.SPARE * 8 * sum(len(w) + 1 for _, w in pairs) + 1)))) - 1
    for t in train:
        for slots, place, bit, _ in walked(t):
            shared.update((s, bit) for s in slots)
            own[place & mask, bit] += 1
    logged = lambda n: np.exp2(np.float32(np.float16(np.log2(n + 1)))) - 1
    level = lambda n: int(min(7, np.log2(n + 1) / 1.5 + 1e-3))

    def plain(text):
        total = 0.0
        for slots, place, bit, j in walked(text):
            n = [(logged(shared[s, 0]), logged(shared[s, 1])) for s in slots] + [(own[place & mask, 0], own[place & mask, 1])]
            inputs = [math.log((b + mixing_lm.PRIOR) / (a + mixing_lm.PRIOR)) for a, b in n] + [1.0]
            gate = level(sum(n[-1])) * 8 + level(sum(n[-2]))
            logit = min(11, max(-11, sum(float(w) * x for w, x in zip(weights[gate], inputs))))
            p = 1 / (1 + math.exp(-logit))
            at = (min(7.999, max(-8, logit)) + 8) * 2
            knots = [1 / (1 + math.exp(8 - (int(at) + i) / 2)) for i in (0, 1)]
            p = min(1 - 1e-5, max(1e-5, (p + knots[0] * (1 - at % 1) + knots[1] * (at % 1)) / 2))
            total += math.log10(p if bit else 1 - p)
        return total

    by_text = {t: plain(t or "") for t in {t for _, t in docs}}
    text_of = dict(docs)
    assert len(got) == len(docs)
    for r in got:
        assert r.score == pytest.approx(by_text[text_of[r.doc_id]], rel=1e-4)


def test_lm_score_sees_the_order_of_words_and_the_length_of_gibberish(spark):
    r = random.Random(5)
    lines = [" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(40)) for _ in range(12)]
    trained = [i for i in range(400) if not held(i, 7, 2)]
    docs = [(i, " ".join(r.choice(lines) for _ in range(3))) for i in trained[:150]]
    kept = [i for i in range(400) if held(i, 7, 2)]
    words = lines[0].split()
    junk = "".join(r.choice("jkqxz") for _ in range(70_000))
    tests = {kept[0]: " ".join(words), kept[1]: " ".join(r.sample(words, len(words))), kept[2]: junk[:20], kept[3]: junk[:200], kept[4]: junk}
    got = {x.doc_id: x for x in score_texts(spark.createDataFrame(docs + list(tests.items()), "doc_id long, text string")).collect()}
    s = [got[k].score for k in kept[:5]]
    assert s[0] > 0.8 * s[1] and s[0] > got[kept[0]].base_score
    assert s[2] > 5 * s[2] / 4 > s[3] > s[4] and -6 * 70_000 < s[4] < -0.3 * 70_000


def test_lm_packs_spread_rows_of_one_id(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 1, id) AS doc_id", "cast(id AS string) AS text")
    sizes = [r["count"] for r in df.groupBy(hashed_pack(F.struct("doc_id", "text"), 16)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.3 * 9000 / 16


def test_held_out_flag(spark):
    df = spark.range(50).select("id", mixing_lm.held_out(F.col("id")).alias("h"))
    assert all(r.h == held(r.id, 7, 2) for r in df.collect())
