"""F8 tokens, vocabulary and encoding cases."""

import pytest
from pyspark.sql import functions as F

from reviewkit.operators.encode import encode, encode_framed, encode_to_longest, with_mask
from reviewkit.operators.tokens import remove_stopwords
from reviewkit.operators.vocab import build_vocabulary, word_counts

TOKENS = [(0, ["b", "a", "b"]), (1, ["c", "a", "<pad>"]), (2, [])]


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(TOKENS, "rid long, tokens array<string>")


def vocab_of(rows, min_freq):
    return build_vocabulary(word_counts(rows, "tokens"), min_freq)


def as_dict(vocab):
    return {r.token: r.token_id for r in vocab.collect()}


def test_vocab_min_freq_1(rows):
    assert as_dict(vocab_of(rows, 1)) == {"<unk>": 0, "<pad>": 1, "a": 2, "b": 3, "c": 4}


def test_vocab_min_freq_2(rows):
    assert as_dict(vocab_of(rows, 2)) == {"<unk>": 0, "<pad>": 1, "a": 2, "b": 3}


def test_vocab_ids_dense_from_two(spark):
    words = [(i, [f"w{j}" for j in range(i % 37 + 1)]) for i in range(300)]
    df = spark.createDataFrame(words, "rid long, tokens array<string>")
    v = vocab_of(df, 1).filter(F.col("token_id") >= 2).orderBy("token_id").collect()
    assert [r.token_id for r in v] == list(range(2, 2 + len(v)))
    keys = [(-r.freq, r.token) for r in v]
    assert keys == sorted(keys)


@pytest.mark.parametrize("length,want", [
    (2, {0: [3, 2], 1: [0, 2], 2: [1, 1]}),
    (4, {0: [3, 2, 3, 1], 1: [0, 2, 1, 1], 2: [1, 1, 1, 1]}),
])
def test_encode_exact_length(rows, length, want):
    enc = encode(rows, vocab_of(rows, 2), "rid", length=length)
    assert {r.rid: list(r.input_ids) for r in enc.collect()} == want


def test_pad_to_longest(rows):
    enc = encode_to_longest(rows, vocab_of(rows, 2), "rid", length=64)
    assert {len(r.input_ids) for r in enc.collect()} == {3}


def test_mask(spark):
    df = spark.createDataFrame([([3, 2, 3, 1],)], "input_ids array<long>")
    assert list(with_mask(df).first().attention_mask) == [1, 1, 1, 0]


def test_framed_keeps_two_body_tokens(spark):
    df = spark.createDataFrame([(0, "t", ["a", "a", "b", "a", "b"], 1)],
                               "rid long, text string, tokens array<string>, label int")
    vocab = build_vocabulary(word_counts(df, "tokens"), 1, specials=("<unk>", "<pad>", "<s>", "</s>"))
    ex = encode_framed(df, vocab, "rid", "text", "label", length=4, start_id=2, end_id=3).first()
    ids = list(ex.example.input_ids)
    assert len(ids) == 4 and ids[0] == 2 and ids[-1] == 3
    assert ids[1:3] == [4, 4]  # 'a' is the most frequent word
    assert list(ex.example.attention_mask) == [1, 1, 1, 1]


def test_stopwords_case(spark):
    df = spark.createDataFrame([(["The", "cat", "The"],)], "tokens array<string>")
    ci = remove_stopwords(df, "tokens", ["the"], case_sensitive=False).first().tokens
    ex = remove_stopwords(df, "tokens", ["the"], case_sensitive=True).first().tokens
    assert list(ci) == ["cat"]
    assert list(ex) == ["The", "cat", "The"]


def test_stopwords_keep_duplicates(spark):
    df = spark.createDataFrame([(["a", "a", "b"],)], "tokens array<string>")
    assert list(remove_stopwords(df, "tokens", ["b"]).first().tokens) == ["a", "a"]


def test_examples_aligned_and_misaligned(spark):
    from reviewkit.operators.encode import assemble_examples
    enc = spark.createDataFrame([(1, [2, 3]), (2, [4, 1])], "rid long, input_ids array<long>")
    ok = spark.createDataFrame([(1, 5), (2, 3)], "rid long, star int")
    got = {r.rid: r.label for r in assemble_examples(enc, ok, "rid").collect()}
    assert got == {1: 2, 2: 1}
    bad = spark.createDataFrame([(1, 5), (3, 3)], "rid long, star int")
    with pytest.raises(ValueError, match="not aligned"):
        assemble_examples(enc, bad, "rid")
    with pytest.raises(ValueError, match="out of range"):
        assemble_examples(enc, spark.createDataFrame([(1, 6), (2, 3)], "rid long, star int"), "rid")


def test_stop_list_is_taken_as_written(spark):
    """Only the token is lower-cased: an upper-case entry matches nothing."""
    df = spark.createDataFrame([(["the", "The", "nba", "NBA"],), ([],), (None,)], "tokens array<string>")
    words = ["The", "NBA"]
    for stop in (words, spark.createDataFrame([(w,) for w in words], "word string")):
        got = [r.tokens for r in remove_stopwords(df, "tokens", stop).collect()]
        assert sorted(map(str, got)) == sorted(map(str, [["the", "The", "nba", "NBA"], [], None]))
        exact = [r.tokens for r in remove_stopwords(df, "tokens", stop, case_sensitive=True).collect()]
        assert sorted(map(str, exact)) == sorted(map(str, [["the", "nba"], [], None]))


def test_reviews_of_two_sources_with_equal_ids_stay_apart(spark):
    from reviewkit.operators.encode import mean_vectors
    df = spark.createDataFrame([("A", 1, ["a"]), ("B", 1, ["b"]), ("B", 2, ["b", "a"])], "source string, review_id long, tokens array<string>")
    key = ["source", "review_id"]
    vocab = vocab_of(df, 1)
    got = {(r.source, r.review_id): list(r.input_ids) for r in encode(df, vocab, key, length=3).collect()}
    assert got == {("A", 1): [2, 1, 1], ("B", 1): [3, 1, 1], ("B", 2): [3, 2, 1]}
    vec = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(4)], "vec_key long, vec array<double>")
    enc = encode(df, vocab, key, length=3)
    mean = {(r.source, r.review_id): list(r.mean_vec) for r in mean_vectors(enc, vec, key, dim=2).collect()}
    assert mean[("B", 2)] == pytest.approx([2.0, 1.0]) and mean[("A", 1)] == pytest.approx([4 / 3, 1.0])


def test_corpus_plan(spark):
    from reviewkit.plans.corpus import prepare, working_reviews
    rows = [("A", 1, "good film film", 5), ("B", 1, "bad film", 1), ("B", 2, "good film film", 5), ("B", 3, None, 2), ("B", 4, "x", None)]
    reviews = spark.createDataFrame(rows, "source string, review_id long, comment string, star int")
    c = prepare(working_reviews(reviews), ["bad"], 1)
    got = {(r.source, r.review_id): (list(r.input_ids), r.label) for r in c.examples(4).collect()}
    assert got == {("A", 1): ([3, 2, 2, 1], 2), ("B", 1): ([2, 1, 1, 1], 0)}
    assert c.coverage(2).first().n_short == 1
