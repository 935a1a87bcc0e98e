"""Phrase collocations against a plain count of every phrase."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from reviewkit.llm import phrases
from reviewkit.llm.phrases import extend, judge, mine_phrases, press_keys, slices
from reviewkit.llm.queries import _phrase_sql
from tests.llm.brute import lower


def plain(docs, least, width, share, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, width + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang in f:
        cand = {p: a for p, a in f[lang].items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            inside = any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                         for q, b in cand.items())
            if not inside:
                cuts = [(1000 * a * n[lang] // (f[lang][p[:k]] * f[lang][p[k:]]), k, f[lang][p[:k]], f[lang][p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                rows.append((-score, -a, b" ".join(p), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(n=400, seed=3):
    rng = np.random.default_rng(seed)
    words = ["a", "B", "c", "dé", "é", "Ñ", "x-y", "the", "of", "A", "\x00", "\x1c", " ", " ", "ÿ"]
    rows = []
    for i in range(n):
        w = rng.choice(words, rng.integers(0, 40))
        w = "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b"]) for x in w)
        rows.append((["en", "de", None, "und", ""][min(i % 9, 4)], None if i % 31 == 7 else w + ("new york city hall now " * (i % 3))))
    return rows + [("en", ""), ("en", None), (None, None), ("xx", "one two"), ("en", "a " * 500), ("en", "q" * 30_000)]


def frame(spark, rows):
    return spark.createDataFrame([(7, a, b, "clash") for a, b in rows], "doc_id long, lang string, text string, phrase string").repartition(4)


@pytest.mark.parametrize("least,width,share,top", [(5, 5, 100, 2000), (3, 3, 60, 7), (2, 1, 100, 5)])
def test_phrases_equal_plain_counts(spark, least, width, share, top, monkeypatch):
    monkeypatch.setattr(phrases, "PACK_BYTES", 3000)
    rows = corpus()
    got = mine_phrases(frame(spark, rows), least, width, share, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, least, width, share, top)


def test_one_text_holds_all_rows_and_is_cut(spark, monkeypatch):
    # A third of the words in one text without breaks, cut between words; the words at the cuts are counted once.
    monkeypatch.setattr(phrases.slices, "__defaults__", (500,))
    rows = [("en", " ".join(f"w{i % 7} v{i % 3}" for i in range(1500)))] + corpus(60) + [("en", "same text here, " * 300)] * 5
    assert sorted(map(tuple, mine_phrases(frame(spark, rows), 4).collect())) == plain(rows, 4, 5, 100, 2000)


def test_slices_repeat_the_words_behind_a_cut():
    text = b"A b c d e f. g h " + b"z" * 40 + b" i j k l m n"
    got = list(slices(text, 3, 8))
    words = [w for t, c in got for w in (t[:-c] if c else t)]
    assert [w for w in words if w != b"\xff"] == text.lower().replace(b".", b" ").split()
    assert all(len(t) - c for t, c in got[:-1]) and any(c for _, c in got)


def test_extend_and_judge():
    groups, slots = np.array([[0], [1]], np.int32), np.array([0, 1, 0, 1, -1, 1, 0], np.int32)
    g, s = extend(groups, slots)
    assert [tuple(x) for x in g] == [(0, 1), (1, 0)] and s.tolist() == [0, 1, 0, -1, -1, 1, -1]
    g, s = extend(g, s)
    assert [tuple(x) for x in g] == [(0, 1, 0), (1, 0, 1)] and s.tolist() == [0, 1, -1, -1, -1, -1, -1]
    key = lambda *v: press_keys(np.array(v, np.uint64), np.zeros(len(v), np.uint16))
    (a, na, ta), (b, nb, tb) = judge([key(1, 5), key(5, 9)], [np.array([3, 1]), np.array([1, 2])], 2)
    assert a.tolist() == [True, True] and b.tolist() == [True, True]
    assert na.tolist() == [0, 1] and ta.tolist() == [3, 2] and nb.tolist() == [1] and tb.tolist() == [2]


def test_no_rows(spark):
    assert mine_phrases(frame(spark, []), 2).collect() == []
    assert mine_phrases(frame(spark, [("en", None), (None, " . ")]), 1).collect() == []


def test_sql_says_the_same():
    rows = [r for r in corpus() if r[1] is None or "\x00" not in r[1]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows])
    assert sorted(con.execute(_phrase_sql(5, 5, 100, 9)).fetchall()) == plain(rows, 5, 5, 100, 9)
