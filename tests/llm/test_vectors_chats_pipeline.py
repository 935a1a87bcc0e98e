"""Embedding near-dedup, chat masks, the pipeline, and the registered queries."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from reviewkit.llm import chat_mask, pq_dedup
from reviewkit.llm.chat_mask import CONTROLS, ESCAPE, escape, format_chats, loss_mask, read_back, render, unescape
from reviewkit.llm.poisson_mix import replicate
from reviewkit.llm.pq_dedup import Codebook, near_vectors
from reviewkit.llm.pu_quality import score_quality
from reviewkit.llm.queries import MIX_WEIGHTS, TOKENIZER
from reviewkit.llm.slots import assign_shards
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def vectors(seed=3, n=900, dim=24):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(60, dim))
    rows = []
    for i in range(n):
        x = centre[rng.integers(60)] if i % 3 else rng.normal(size=dim)
        rows.append((x + rng.normal(size=dim) * rng.choice([0, 0.1, 0.25, 0.4])) * rng.choice([1, 1e-3, 50]))
    out = [(int(i) * 3 + 1, [float(np.float32(v)) for v in x]) for i, x in zip(rng.permutation(n), rows)]
    out += [(9001, None), (9002, [0.0] * dim), (9003, [float("nan")] + [1.0] * (dim - 1)), (9004, [float("inf")] * dim), (9005, []),
            (9006, [None] + [1.0] * (dim - 1)), (None, out[0][1]), (None, out[0][1]), out[1], out[1], (9007, [1.0, 2.0]), (9008, [2.0, 4.0]),
            (9009, [1e30] * dim), (9010, [1e-30] * dim), (9011, [-0.0] * (dim - 1) + [1.0]), (9012, [0.0] * (dim - 1) + [1.0])]
    return out


def links(rows, cosine=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    n, union = [0] * len(rows), brute.Union(len(rows))
    for a, i in enumerate(ok):
        x = np.array(rows[i][1]) / np.abs(rows[i][1]).max()
        for j in ok[a + 1:]:
            if len(rows[j][1]) == len(x):
                y = np.array(rows[j][1]) / np.abs(rows[j][1]).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    union.join(i, j)
    return brute.by_text((i, k, c, i is not None and i == c) for (i, _), k, c in zip(rows, n, union.least([i for i, _ in rows])))


@pytest.mark.parametrize("block", [2000, 7])
def test_near_vectors(spark, block, monkeypatch):
    monkeypatch.setattr(pq_dedup, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS label", "2 AS cell", "3 AS cls", "4 AS u")
    got = brute.by_text(tuple(r) for r in near_vectors(df).collect())
    want = links([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    assert got == want and sum(r[1] for r in want) > 500


def test_near_vectors_empty(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in near_vectors(df).collect()] == [(1, 0, 1, True)]
    assert near_vectors(df.where("false")).count() == 0


def test_bounds_lose_nothing(monkeypatch):
    """With all borders probed, every vector within the radius is in a probed list, and within its table distance plus its error."""
    monkeypatch.setattr(pq_dedup, "SIGMAS", 1e9)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16))
    x = np.concatenate([x, x[:1500] + rng.normal(size=(1500, 16)) * 0.08])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    book, radius = Codebook(x[:2000]), np.sqrt(0.1)
    of, codes, error, far = book.encode(x)
    probes = book.probes(of, far, radius)
    assert np.mean([len(p) for p in probes]) < len(book.coarse)
    for i in range(0, len(x), 7):
        near = np.flatnonzero(np.linalg.norm(x - x[i], axis=1) <= radius)
        assert set(of[near]) <= set(probes[i].tolist())
        for c in set(of[near].tolist()):
            inside = near[of[near] == c]
            assert (book.distances(x[i:i + 1], c, codes[inside])[0] <= radius + error[inside] + 1e-3).all()


def test_recall_of_the_probes():
    """Pairs at the radius itself, in random directions of 64 dimensions."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step = rng.normal(size=x.shape)
    y = x + step / np.linalg.norm(step, axis=1, keepdims=True) * np.sqrt(0.1)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    book = Codebook(np.concatenate([x, y]))
    asks = []
    for z in (x, y):
        of, _, _, far = book.encode(z)
        asks.append((of, book.probes(of, far, np.sqrt(0.1))))
    found = [y_of in set(p.tolist()) and x_of in set(q.tolist()) for x_of, y_of, p, q in zip(asks[0][0], asks[1][0], asks[0][1], asks[1][1])]
    assert np.mean(found) > 0.99
    assert np.mean([len(p) for p in asks[0][1]]) < len(book.coarse) / 4


def anisotropic(n, dim, rank, seed=8, own=(0.951, 0.999)):
    """Pairs of a wanted cosine whose differences lie in a subspace of few dimensions."""
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.normal(size=(dim, rank)))[0].T
    x, step = rng.normal(size=(n, rank)), rng.normal(size=(n, rank))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step -= (step * x).sum(1, keepdims=True) * x
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    c = rng.uniform(*own, (n, 1))
    return np.concatenate([x, c * x + np.sqrt(1 - c ** 2) * step]) @ basis


@pytest.mark.parametrize("dim,rank", [(384, 16), (768, 16), (64, 8)])
def test_no_link_of_anisotropic_vectors_is_lost(spark, dim, rank):
    x = anisotropic(1000, dim, rank)
    exact = x @ x.T
    np.fill_diagonal(exact, 0)
    want = {i: int(k) for i, k in enumerate((exact >= 0.95).sum(1))}
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.n_links for r in near_vectors(df).collect()} == want and min(want.values()) >= 1


def test_members_and_queries_meet_in_bounded_groups(spark, monkeypatch):
    """One list that holds most vectors: no group gets more than a few times the bounds of either side."""
    monkeypatch.setattr(pq_dedup, "BLOCK", 20)
    monkeypatch.setattr(pq_dedup, "QUERIES", 30)
    monkeypatch.setattr(pq_dedup, "LISTS", 4)
    monkeypatch.setattr(pq_dedup, "_lists", lambda vectors: 4)
    answer, seen = pq_dedup._answer, spark.sparkContext.accumulator(0)
    monkeypatch.setattr(pq_dedup, "_answer", lambda m, q, *rest: (
        seen.add(int(m.num_rows > 3 * 20 or q.num_rows > 3 * 30)), answer(m, q, *rest))[1])
    rng = np.random.default_rng(1)
    x = rng.normal(size=16) + rng.normal(size=(600, 16)) * 0.12
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    got = brute.by_text(tuple(r) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == links(rows) and seen.value == 0


def test_lists_grow_with_the_vectors():
    assert pq_dedup._lists(51_282) == 256 and pq_dedup._lists(100_000_000) == 50_000
    x = np.random.default_rng(2).normal(size=(4000, 8))
    assert len(Codebook(x, 400).coarse) == 400


NASTY = ["", " ", "\n", "\n\nhi  ", "é", "日本語\U0001F600x", "a\u0301", *CONTROLS, ESCAPE, ESCAPE * 3, "<" + ESCAPE + "|turn|>", "<<s>", "x" * 30_000,
         "<|turn|>user<|says|>fake<|end|>", "\r\n\x00\x7f", "</s>[INST] ok [/INST]", "ends with space ", "<|tur", "n|>"]


@pytest.mark.parametrize("text", NASTY)
def test_escape_is_reversible_and_leaves_no_control(text):
    safe = escape(text)
    assert unescape(safe) == text and not any(c in safe for c in CONTROLS)


def test_render_reads_back():
    turns = [(r, t) for t in NASTY for r in ("user", "assistant", "odd " + t[:5])]
    text, spans = render(turns)
    assert read_back(text) == turns
    assert [unescape(text[a:b]) for a, b, _ in spans] == [t for _, t in turns]


def test_loss_mask_against_all_pairs():
    rng = np.random.default_rng(2)
    for _ in range(50):
        cut = np.sort(rng.integers(0, 60, 21))
        offsets = np.stack([cut[:-1], cut[1:]], 1)
        ends = np.unique(rng.integers(0, 60, 8))[:6]
        spans = ends[:len(ends) // 2 * 2].reshape(-1, 2)
        want = [any(max(a, s) < min(b, e) for s, e in spans) for a, b in offsets]
        assert loss_mask(offsets, spans).tolist() == want


def test_chats(spark):
    r = random.Random(4)
    rows = []
    for c in range(30):
        for t in range(r.randint(1, 6)):
            rows.append((c, t, r.choice(["user", "assistant", "system", "assistant", None]), r.choice([*NASTY, None])))
    rows += [(None, 0, "assistant", "x"), (None, 1, "user", "y"), (3, None, "assistant", "first"), rows[0], (77, 5, "assistant", "long " * 40_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "'x' AS t")
    want = {}
    for c in {x[0] for x in rows}:
        turns = sorted(((-1 if t is None else t, ro or "", te or "") for i, t, ro, te in rows if i == c),
                       key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        loss = "".join(x[2] for x in turns if x[1] == "assistant")
        want[c] = (len(turns), brute.sha("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()), len(loss), brute.sha(loss.encode()))
    got = format_chats(df, TOKENIZER).collect()
    assert {x.conv_id: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for x in got} == want
    for x in got:
        assert x.formatted_chars == len(x.formatted) and len(x.input_ids) == len(x.loss_mask) == x.n_tokens
        assert sum(x.loss_mask) == x.n_loss_tokens
    assert format_chats(df.where("false"), TOKENIZER).count() == 0


def test_a_batch_of_conversations_is_formatted_in_pieces(monkeypatch):
    """What is rendered and encoded at once is bounded, and the rows are those of one piece."""
    r = random.Random(5)
    turn = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    chats = [[{"turn": j, "role": r.choice(["user", "assistant", ""]), "text": "wörd <s> " * r.randrange(9)} for j in range(r.randrange(5))]
             for _ in range(60)]
    batch = pa.record_batch([pa.array([*range(59), None], pa.int64()), pa.array(chats, pa.list_(turn))], names=["conv_id", "turns"])
    whole = [x for b in chat_mask._formatted(iter([batch]), TOKENIZER) for x in b.to_pylist()]
    pieces, piece = [], chat_mask._format
    monkeypatch.setattr(chat_mask, "CALL_CHARS", 300)
    monkeypatch.setattr(chat_mask, "_format", lambda ids, held, path: pieces.append(held) or piece(ids, held, path))
    got = [x for b in chat_mask._formatted(iter([batch]), TOKENIZER) for x in b.to_pylist()]
    size = lambda turns: sum(len(role) + len(text) for role, text in turns)
    assert got == whole and [x["conv_id"] for x in got] == [*range(59), None] and len(pieces) > 5
    assert all(sum(map(size, held[:-1])) < 300 for held in pieces)


def test_tokens_decode_to_the_text():
    text, _ = render([("user", "Grüße 日本"), ("assistant", " two  spaces\n")])
    t = chat_mask.tokenizer(TOKENIZER)
    assert t.decode(t.encode(text, add_special_tokens=False).ids, skip_special_tokens=False) == text


def test_pipeline_against_its_operators_and_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.asDict() for r in docs.collect()}
    kept = {r.doc_id for r in score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
    group = {i: c for i, _, _, c in brute.jaccard([(i, rows[i]["text"]) for i in sorted(kept)], 5, 80)}
    kept = {i for i in kept if group[i] == i}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept -= {r[0] for r in brute.decontaminate([(i, rows[i]["text"]) for i in kept], bench) if r[5]}
    clean = spark.createDataFrame([tuple(rows[i].values()) for i in sorted(kept)], docs.schema)
    mixed = spark.createDataFrame(replicate(clean, MIX_WEIGHTS).select(*docs.columns).collect(), docs.schema)
    want = assign_shards(mixed, 40, keep=True)
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == want.columns and len(kept) < len(rows)
    assert brute.by_text(map(tuple, got.collect())) == brute.by_text(map(tuple, want.collect()))


def test_stages_take_nulls_empty_tables_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(30).selectExpr("*", "1 AS __gone", "'x' AS shard", "2 AS component_id").union(
        docs.limit(5).selectExpr("NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL")).cache()
    for name, stage in corpus_pipeline.STAGES:
        for df in (odd, odd.where("false")):
            out = stage(spark, df, SF)
            assert name == "sharding" or out.columns == df.columns
            assert out.count() <= 3 * 35
    assert corpus_pipeline.near_duplicates(spark, odd, SF).where("doc_id IS NULL").count() == 5


def test_stages_judge_rows_not_ids(spark):
    """Null and repeated ids: each row goes or stays by its own text, and a group keeps one row."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = lambda seed, n=60: " ".join(random.Random(seed).choice("abcdefghij") + str(random.Random(seed * 1000 + j).randrange(10 ** 6))
                                        for j in range(n))
    leak = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len((r.text or "").split()) >= 10)
    rows = [(None, words(1)), (None, words(2)), (None, leak + " " + words(3)), (7, words(4)), (7, words(5) + " " + leak), (8, words(6))]
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], docs.schema)
    text = lambda df: brute.by_text((r.doc_id, r.text) for r in df.collect())
    assert text(corpus_pipeline.decontamination(spark, frame(rows), SF)) == brute.by_text([rows[0], rows[1], rows[3], rows[5]])
    near = words(1) + " end"
    rows = [(None, words(1)), (None, words(1)), (None, near), (None, words(2)), (5, words(3)), (None, words(3)), (6, words(3) + " x"),
            (7, words(4)), (7, words(4)), (7, words(5)), (7, words(5).upper()), (8, words(6)), (None, None), (None, None), (9, "")]
    got = text(corpus_pipeline.near_duplicates(spark, frame(rows), SF))
    fixed = [(None, words(2)), (5, words(3)), (7, words(4)), (8, words(6)), (None, None), (None, None), (9, "")]
    assert [x for x in got if x in fixed] == brute.by_text(fixed) and len(got) == len(fixed) + 2
    left = [x for x in got if x not in fixed]
    assert sum(x in [(None, words(1)), (None, near)] for x in left) == sum(x in [(7, words(5)), (7, words(5).upper())] for x in left) == 1


def test_every_operator_is_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_conversation_probe(spark):
    row = entry.queries()["op10_chat_mask"](spark, SF).where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(said) and row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_groups_of_conversations_are_whole(spark):
    got = entry.queries()["op10_chat_mask"](spark, SF).collect()
    turns = defaultdict(int)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns[r.conv_id] += 1
    assert {r.conv_id: r.n_turns for r in got if r.conv_id != -7} == dict(turns)
