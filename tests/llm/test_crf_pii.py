"""Personal data: base patterns against plain expressions, the chain against enumeration."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from reviewkit.llm import crf_pii
from reviewkit.llm.crf_pii import (LABELS, WORD, Model, _Words, added_spans, decode, find_personal_data, labelled_rows, likelihood, made_rows,
                                   scores, text_spans, train)
from reviewkit.llm.pii_patterns import KINDS, base_spans, luhn, spans_text

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                    "card": 14 <= len(d) <= 19 and plain_luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def test_base_equals_plain_expressions():
    rng = random.Random(4)
    parts = ["a", "b@", "@", ".", "1", "23", "255", "256", "+", "-", " ", "(", ")", "é", "\n", "4111111111111111", "a.b@c.d", "1.2.3.4",
             "+1 (212) 555-0187", "%", "_", "0001", "٣", "x@y", ".com", "4111 1111-1111 1111"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert base_spans(text) == plain_base(text), text
    for d in ("4111111111111111", "4111111111111112", "0", "18", "79927398713"):
        assert luhn(d) == plain_luhn(d)


def test_base_is_linear_in_long_runs():
    for run in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "a." * 200_000 + "@", "+1" * 200_000, "+1" + "(" * 400_000, "@" * 300_000,
                "1 " * 200_000):
        base_spans(run)


def test_gradient_of_the_likelihood():
    rng = np.random.default_rng(1)
    size = np.array([4, 1, 3])
    there = np.arange(4)[None] < size[:, None]
    score, moves, truth = rng.normal(size=(3, 4, 5)), rng.normal(size=(5, 5)), rng.integers(0, 5, (3, 4)) * there
    value, g_score, g_moves = likelihood(score, truth, there, moves)

    def path(r, ys):
        return sum(score[r, t, y] for t, y in enumerate(ys)) + sum(moves[a, b] for a, b in zip((0, *ys), (*ys, 0)))

    want = sum(path(r, truth[r, :n]) - np.log(sum(np.exp(path(r, ys)) for ys in itertools.product(range(5), repeat=n))) for r, n in enumerate(size))
    assert value == pytest.approx(want)
    for x, g in ((score, g_score), (moves, g_moves)):
        for at in itertools.product(*map(range, x.shape)):
            x[at] += 1e-5
            up = likelihood(score, truth, there, moves)[0]
            x[at] -= 2e-5
            down = likelihood(score, truth, there, moves)[0]
            x[at] += 1e-5
            assert (up - down) / 2e-5 == pytest.approx(g[at], abs=1e-6)


def plain_viterbi(score, moves):
    """Best path of one chain that begins and ends beside label 0."""
    best, came = score[0] + moves[0], []
    for t in range(1, len(score)):
        step = best[:, None] + moves
        came.append(step.argmax(0))
        best = step.max(0) + score[t]
    path = [int((best + moves[:, 0]).argmax())]
    for c in reversed(came):
        path.append(int(c[path[-1]]))
    return path[::-1]


def test_decoding_equals_whole_chains_and_enumeration():
    rng = np.random.default_rng(7)
    for n in range(60):
        moves = rng.normal(size=(5, 5))
        model = Model({}, np.zeros((3, 0, 5)), moves)
        sizes = rng.integers(1, 30, 5) if n % 2 else rng.integers(1, 6, 3)
        chains = [rng.normal(size=(k, 5)) * 3 + np.where(rng.random((k, 1)) < 0.6, [[6, 0, 0, 0, 0]], 0) for k in sizes]
        gap = np.array([[0, *[-np.inf] * 4]])
        got = decode(model, np.concatenate([x for c in chains for x in (c, gap)]))
        at = 0
        for c in chains:
            path = got[at:at + len(c)].tolist()
            assert path == plain_viterbi(c, moves)
            if len(c) < 6:
                value = lambda ys: sum(c[t, y] for t, y in enumerate(ys)) + sum(moves[a, b] for a, b in zip((0, *ys), (*ys, 0)))  # noqa: E731, B023
                assert value(path) == pytest.approx(max(map(value, itertools.product(range(5), repeat=len(c)))))
            at += len(c) + 1


@pytest.fixture(scope="module")
def model():
    cards = ("4111111111111111", "5500 0000 0000 0004", "3714-4963-5398-431", "6011000990139424", "30569309025904")
    return train(labelled_rows(["plain words here and there", *(f"text a{i}.b@c{i}.example and on 10.{i}.2.3 or +1 (212) 555-0{i}87 here, then {c} too"
                                                                for i, c in enumerate(cards * 3))]))


def test_held_out_rows_and_clean_text(model):
    found = lambda x: [(k, x[i:j]) for i, j, k in text_spans([x.encode()], _Words(model))[0][1]]
    assert found("you can ring (212) 555-0145 for it") == [("phone", "(212) 555-0145")]
    assert found("mail tom(at)site.example.org soon") == [("email", "tom(at)site.example.org")]
    assert found("zahl 5105.1051.0510.5100 bitte") == [("card", "5105.1051.0510.5100")]
    for x in ("on 1999-12-31 we met", "version 4.11.2 is out", "the year 2020 had 366 days", "price 1,299.00 or 13.50", "at at at", "over.There he went"):
        assert found(x) == [], x
    # Rows with other digits, names and words around them.
    words = right = marked = nothing = 0
    for text, spans in made_rows(12, 99):
        want = [y for _, y in crf_pii.labelled_words(text, spans)]
        known = _Words(model)
        ids = np.array([known[w.encode()] for w in text.split()])
        got = decode(model, scores(np.array(known.emit), ids)).tolist()
        words, right = words + len(want), right + sum(a == b for a, b in zip(want, got))
        marked += sum(a == b for a, b in zip(want, got) if a)
        nothing += want.count(0)
    assert right / words > max(0.95, nothing / words + 0.08) and marked / (words - nothing) > 0.85


TEXTS = ["write to a.b@c.example or bob[at]example[dot]net", "", None, " \n ", "é😀 from 10.0.0.1, +44 20 7946 0958!", "(415) 555-0132" * 3, "x" * 5_000,
         "clean text. " * 5000, "pay 4111 1111 1111 1111 or 4111.1111.1111.1112 now", "\x1c  1.2.3.4 5.6.7.8", "1 " * 2000, "tel 020 7946 0958 " * 200]


def test_texts_equal_plain_version(spark, model, monkeypatch):
    monkeypatch.setattr(crf_pii, "BATCH_BYTES", 40_000)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0]), (3, TEXTS[0])] + [(77, TEXTS[8])] * 9
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, spans string, n_email long").repartition(3)
    want = []
    for i, t in rows:
        t = t or ""
        base = plain_base(t)
        w = [m[0] for m in WORD.finditer(t)]
        emit = [model.emissions(x) for x in w]
        score = np.array([emit[k][1] + (emit[k - 1][0] if k else 0) + (emit[k + 1][2] if k + 1 < len(w) else 0) for k in range(len(w))])
        labels = np.array(plain_viterbi(score, model.moves)) if w else np.zeros(0, int)
        added = added_spans(t, labels, base)
        both = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))
        want.append((i, *(sum(k == kind for *_, k in base) for kind in KINDS), hashlib.sha256(spans_text(base).encode()).hexdigest(),
                     spans_text(both), len(added)))
    got = [tuple(r) for r in find_personal_data(df, model).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[-1] for r in got) > 10


def test_fit_on_a_table_and_no_rows(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], schema)
    assert find_personal_data(df).count() == len(TEXTS)
    assert find_personal_data(spark.createDataFrame([], schema)).collect() == []
    assert len(LABELS) == 5
