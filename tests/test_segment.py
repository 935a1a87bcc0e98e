"""F12 segmentation cases on a CJK toy dictionary."""

import pytest
from pyspark.sql import functions as F

from reviewkit.operators import segment as S

DICT = [("北京", 50), ("清华", 20), ("清华大学", 30), ("大学", 60), ("我", 100),
        ("来到", 40), ("来", 30), ("到", 30), ("华大", 1)]
TEXT = "我来到北京清华大学"


def _dict(spark, rows=DICT):
    return spark.createDataFrame(rows, "word string, weight long")


def _rows(spark, mode, d, texts=(TEXT,)):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    out = S.segment_rows(df, "id", "text", d, mode)
    return {r.id: list(r.tokens) for r in out.collect()}


def test_exact(spark):
    assert _rows(spark, "exact", _dict(spark))[0] == ["我", "来到", "北京", "清华大学"]


def test_full(spark):
    assert _rows(spark, "full", _dict(spark))[0] == ["我", "来到", "北京", "清华", "清华大学", "华大", "大学"]


def test_search(spark):
    got = _rows(spark, "search", _dict(spark))[0]
    assert got == ["我", "来到", "北京", "清华", "华大", "大学", "清华大学"]


def test_empty_and_mixed(spark):
    got = _rows(spark, "exact", _dict(spark), ["", "我 abc 北京12"])
    assert got[0] == []
    assert got[1] == ["我", "abc", "北京", "12"]


def test_dictionary_edits(spark):
    d = _dict(spark)
    added = S.add_words(d, spark.createDataFrame([("清华大", 5)], "word string, weight long"))
    assert "清华大" in _rows(spark, "full", added)[0]
    deleted = S.delete_words(d, spark.createDataFrame([("华大",)], "word string"))
    assert "华大" not in _rows(spark, "full", deleted)[0]


def test_user_dictionary_latest_wins(spark):
    d = _dict(spark)
    u1 = spark.createDataFrame([("北京", 7), ("新词", 3)], "word string, weight long")
    u2 = spark.createDataFrame([("北京", 9)], "word string, weight long")
    m = {r.word: r.weight for r in S.load_user_dictionary(d, u1, u2).collect()}
    assert m["北京"] == 9 and m["新词"] == 3 and m["大学"] == 60


def _full_reference(s, words):
    """Sequential rendering of the full-mode rule for cross-checking."""
    maxlen = max(len(w) for w in words)
    out, old = [], -1
    for k in range(len(s)):
        ends = [k + l - 1 for l in range(2, maxlen + 1) if k + l <= len(s) and s[k:k + l] in words]
        if ends:
            out += [s[k:e + 1] for e in ends]
            old = ends[-1]
        elif k > old:
            out.append(s[k])
            old = k
    return out


def test_full_mode_random_strings(spark):
    import random
    rnd = random.Random(7)
    alphabet = "我来到北京清华大学"
    words = {w for w, _ in DICT}
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 25))) for _ in range(150)]
    got = _rows(spark, "full", _dict(spark), texts)
    for i, t in enumerate(texts):
        assert got[i] == _full_reference(t, words), t


def test_counts_weighted_by_occurrence(spark):
    df = spark.createDataFrame([(TEXT,), (TEXT,), ("北京",)], "text string")
    c = {r.piece: r.freq for r in S.segment_counts(df, "text", _dict(spark), "exact").collect()}
    assert c["北京"] == 3 and c["清华大学"] == 2 and c["我"] == 2


def test_whitespace_tokens_optional(spark):
    df = spark.createDataFrame([(0, "我来到 北京\r\n好　ok")], "id long, text string")
    d = _dict(spark)
    off = S.segment_rows(df, "id", "text", d, "exact").first().tokens
    on = S.segment_rows(df, "id", "text", d, "exact", keep_whitespace_tokens=True).first().tokens
    assert list(off) == ["我", "来到", "北京", "好", "ok"]
    assert list(on) == ["我", "来到", " ", "北京", "\r\n", "好", "　", "ok"]
    counts = {r.piece: r.freq for r in S.segment_counts(df, "text", d, "exact",
                                                       keep_whitespace_tokens=True).collect()}
    assert counts[" "] == 1 and counts["\r\n"] == 1 and counts["　"] == 1


def test_mixed_script_without_spaces(spark):
    d = _dict(spark, [("手机", 10), ("不错", 10), ("好看", 10), ("很", 5)])
    texts = ["iPhone手机不错", "T恤很好看", "3手机x不错9", "手机iPhone不错"]
    want = [["iPhone", "手机", "不错"], ["T", "恤", "很", "好看"], ["3", "手机", "x", "不错", "9"], ["手机", "iPhone", "不错"]]
    for mode in ("exact", "full", "search"):
        got = _rows(spark, mode, d, texts)
        assert [got[i] for i in range(4)] == want, mode


def test_long_dictionary_words_are_kept(spark):
    from reviewkit.operators.segment import dictionary_from_counts
    counts = spark.createDataFrame([("一二三四五六七八", 20), ("一二", 99), ("三", 1)], "token string, freq long")
    d = dictionary_from_counts(counts, 16)
    assert _rows(spark, "exact", d, ["一二三四五六七八"])[0] == ["一二三四五六七八"]
    assert {r.word for r in d.collect()} == {"一二三四五六七八", "一二"}


def test_a_very_long_word_adds_hardly_any_candidates(spark):
    import random
    rnd = random.Random(3)
    text = ["".join(rnd.choice("我来到北京清华大学") for _ in range(60)) for _ in range(300)]
    blocks = spark.createDataFrame([(t, 1) for t in text], "block string, n long")
    long = "学" + "".join(rnd.choice("一丁七万") for _ in range(149))
    few, many = _dict(spark), _dict(spark, [*DICT, (long, 40)])

    def candidates(d):
        pos = blocks.select("*", F.explode(F.sequence(F.lit(0), F.length("block") - 1)).alias("i"))
        return S._with_lengths(pos, S.matcher(d)).agg(F.sum(F.size("lens"))).first()[0]

    a, b = candidates(few), candidates(many)
    assert a <= b <= 1.01 * a
    key = lambda r: (r.block, r.i, r.l, r.weight)
    assert sorted(map(key, S.dictionary_hits(blocks, few).collect())) == sorted(map(key, S.dictionary_hits(blocks, many).collect()))
    whole = spark.createDataFrame([("我" + long + "大学", 1)], "block string, n long")
    assert S.exact_mode_pieces(whole, many).first().pieces == ["我", long, "大学"]


def _exact_reference(s, weights):
    """Best path by plain dynamic programming; equal sums go to the longer word."""
    import math
    total = math.log(sum(weights.values()))
    units = {w: round((math.log(n) - total) * 1e9) for w, n in weights.items()}
    longest = max(map(len, weights))
    best = {len(s): (0, 0)}
    for i in range(len(s) - 1, -1, -1):
        options = [(units[s[i:i + n]] + best[i + n][0], n) for n in range(1, min(longest, len(s) - i) + 1) if s[i:i + n] in weights]
        best[i] = max(options or [(round(-total * 1e9) + best[i + 1][0], 1)])
    out, i = [], 0
    while i < len(s):
        out.append(s[i:i + best[i][1]])
        i += best[i][1]
    return out


def test_exact_mode_random_strings(spark):
    import random
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("我来到北京清华大学们") for _ in range(rnd.randint(1, 40))) for _ in range(150)]
    texts.append("清华大学我来到" * 200)  # one block of 1,400 characters
    got = _rows(spark, "exact", _dict(spark), texts)
    for i, t in enumerate(texts):
        assert got[i] == _exact_reference(t, dict(DICT)), t[:60]


def test_empty_dictionary(spark):
    none = spark.createDataFrame([], "word string, weight long")
    assert _rows(spark, "exact", none)[0] == list(TEXT) == _rows(spark, "full", none)[0]


def test_rows_of_two_sources(spark):
    df = spark.createDataFrame([("A", 1, "北京"), ("B", 1, "大学"), ("B", 2, "")], "source string, id long, text string")
    got = {(r.source, r.id): list(r.tokens) for r in S.segment_rows(df, ["source", "id"], "text", _dict(spark), "exact").collect()}
    assert got == {("A", 1): ["北京"], ("B", 1): ["大学"], ("B", 2): []}


def test_flagship_job(spark):
    from reviewkit.plans.high_frequency import cleaned_units, high_frequency_job
    df = spark.createDataFrame([("我来到北京iPhone <b>THE</b> the",), ("北京大学the",)], "comment string")
    got = [(r.token, r.freq) for r in high_frequency_job(cleaned_units(df), _dict(spark), ["the", "IPHONE"], ["我"], 1).collect()]
    assert got == [("北京", 2), ("iPhone", 1), ("大学", 1), ("来到", 1)]


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_rows_shuffle_only_occurrences_of_cut_blocks(spark, bound):
    """units stay in their row's array; a whole word is in no join. Same rows with broadcast and shuffled pieces."""
    from reviewkit.operators import segment as S
    d = spark.createDataFrame([("的一", 50), ("是", 40), ("不", 30)], "word string, weight long")
    rows = [("a", 1, "的一 x 的一是不 y"), ("a", 2, "的一是"), ("a", 3, ""), ("a", 4, None), ("b", 5, "的一 是"), ("b", 5, "不是 z"), (None, 6, "的一")]
    df = spark.createDataFrame(rows, "source string, rid long, t string")
    split = S.materialize(df.select("source", "rid", S.split_units(F.col("t")).alias("__units"), F.monotonically_increasing_id().alias("__row")))
    units = S.explode_rows(split, ["source", "rid", "__row"], F.col("__units"), "block", pos_name="upos")
    m = S.matcher(d)
    blocks = units.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    han = blocks.where(F.col("block").rlike(f"^{S.HAN_RE}$"))
    cuts = S.checked_blocks(S.exact_mode_pieces(han, m, dict_checked=True).select("block", "pieces"), m, bound)
    assert {r.block: r.pieces for r in cuts.pieces.collect()} == {"的一是不": ["的一", "是", "不"], "的一是": ["的一", "是"], "不是": ["不", "是"]}
    assert (cuts.whole is None) == bool(bound)
    if not bound:
        assert {r.block for r in cuts.whole.collect()} == {"的一", "是"}
    got = sorted(((r.source, r.rid, r.tokens) for r in S._rows_of_pieces(split, units, cuts, ["source", "rid"], "tokens").collect()), key=str)
    both = ["不", "是", "的一", "z", "是"]  # rows of one key: place by place, as before
    assert got == sorted([("a", 1, ["的一", "x", "的一", "是", "不", "y"]), ("a", 2, ["的一", "是"]), ("a", 3, []), ("a", 4, []),
                          ("b", 5, both), ("b", 5, both), (None, 6, [])], key=str)
