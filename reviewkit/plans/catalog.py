"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole driver tables (or tables Spark derives from them). Keys are
``<inventory id>_<short name>``. Column names and types match between the Spark
result and the SQL; arrays are rendered as comma-joined text and floating
results are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewkit.functions.labels import sql_sentiment
from reviewkit.functions.text import NON_SPACE_RE, sql_clean, sql_letter_tokens, sql_step
from reviewkit.plans.sqlbits import sql_list
from reviewkit.sources import driver
from reviewkit.sources.stopwords import builtin_stopwords

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- shared parts

def reviews(spark: SparkSession, d: str) -> DataFrame:
    """K3: both review sources, A then B (order carried by (source, review_id))."""
    return driver.reviews_a(spark, d).unionByName(driver.reviews_b(spark, d))


STOP = builtin_stopwords()
SQL_STOP = sql_list(STOP)
SQL_REVIEWS = f"({driver.SQL_REVIEWS_A} UNION ALL {driver.SQL_REVIEWS_B})"


def sql_tokens(text_expr: str, profile: str = "full", stop: str | None = "ci") -> str:
    """DuckDB rendering of tokenize(): clean -> letter runs -> stop filter."""
    toks = sql_letter_tokens(sql_clean(text_expr, profile))
    if stop == "ci":
        toks = f"list_filter({toks}, lambda t: NOT list_contains({SQL_STOP}, lower(t)))"
    elif stop == "exact":
        toks = f"list_filter({toks}, lambda t: NOT list_contains({SQL_STOP}, t))"
    return toks


# ---------------------------------------------------------------- more shared parts

KEY = ("source", "review_id")


def doc_tokens(spark: SparkSession, d: str, stop: str | None = "ci",
               profile: str = "full") -> DataFrame:
    """Both review sources with token arrays (source, review_id, star, tokens)."""
    from reviewkit.operators.tokens import tokenize
    r = reviews(spark, d).select("source", "review_id", "star", "comment")
    return tokenize(r, profile=profile,
                    stopwords=STOP if stop == "ci" else None,
                    exact_stopwords=STOP if stop == "exact" else None).drop("comment")


def stored_tokens(spark: SparkSession, d: str) -> DataFrame:
    """The tokens with the case-insensitive stop filter, stored: a query reads them twice or more."""
    from reviewkit.operators.joins import materialize
    return materialize(doc_tokens(spark, d))


def corpus_tokens(spark: SparkSession, d: str) -> DataFrame:
    return doc_tokens(spark, d)


def sql_doc_tokens(stop: str | None = "ci") -> str:
    return (f"(SELECT source, review_id, star, {sql_tokens('comment', 'full', stop)} AS tokens "
            f"FROM {SQL_REVIEWS} r)")


SQL_CORPUS_TOKENS = sql_doc_tokens()


def sql_vocab(tokens_table: str, min_freq: int, specials=("<unk>", "<pad>")) -> str:
    """DuckDB vocabulary: specials first, then freq desc, token asc."""
    spec = " UNION ALL ".join(
        f"SELECT '{s}' AS token, CAST(0 AS BIGINT) AS freq, CAST({i} AS BIGINT) AS token_id"
        for i, s in enumerate(specials))
    quoted = ", ".join(f"'{s}'" for s in specials)
    return f"""(
  WITH c AS (SELECT unnest(tokens) AS token FROM {tokens_table} tt),
  f AS (SELECT token, CAST(count(*) AS BIGINT) AS freq FROM c GROUP BY token)
  {spec}
  UNION ALL
  SELECT token, freq, CAST(row_number() OVER (ORDER BY freq DESC, token) + {len(specials) - 1} AS BIGINT)
  FROM f WHERE freq >= {min_freq} AND token NOT IN ({quoted})
)"""


# ---------------------------------------------------------------- relational basics

@register("k3_union", f"""
SELECT source, review_id, star, CAST(length(comment) AS INTEGER) AS comment_len FROM {SQL_REVIEWS} r
""")
def k3_union(spark, d):
    return reviews(spark, d).select("source", "review_id", "star",
                                    F.length("comment").alias("comment_len"))


@register("p1_project", f"SELECT comment, star FROM {SQL_REVIEWS} r")
def p1_project(spark, d):
    return reviews(spark, d).select("comment", "star")


_PROFILE_COLS = ("doc_id", "text", "lang", "source", "quality", "toxic")


@register("p2_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS rows, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM ({driver.SQL_LABELLED}) x"
    for c in _PROFILE_COLS))
def p2_profile(spark, d):
    from reviewkit.operators.quality import profile
    return profile(driver.labelled_documents(spark, d).select(*_PROFILE_COLS))


@register("p2_observed_profile", ORACLE["p2_profile"])
def p2_observed_profile(spark, d):
    """P2 counted while the table is stored: one scan, no pass for the profile."""
    from reviewkit.operators.observed import stored_profile
    return stored_profile(driver.labelled_documents(spark, d).select(*_PROFILE_COLS))[1]


@register("p3_preview", f"""
SELECT review_id, star, comment FROM ({driver.SQL_REVIEWS_A}) a ORDER BY review_id LIMIT 5
""")
def p3_preview(spark, d):
    from reviewkit.operators.quality import preview
    return preview(driver.reviews_a(spark, d).select("review_id", "star", "comment"), "review_id")


@register("p4_drop_nulls", f"""
SELECT doc_id, quality, toxic FROM ({driver.SQL_LABELLED}) x
WHERE text IS NOT NULL AND quality IS NOT NULL
""")
def p4_drop_nulls(spark, d):
    from reviewkit.operators.quality import drop_nulls
    return drop_nulls(driver.labelled_documents(spark, d), ["text", "quality"]) \
        .select("doc_id", "quality", "toxic")


@register("p5_exclude_stars", f"SELECT source, review_id, star FROM {SQL_REVIEWS} r WHERE star NOT IN (1, 5)")
def p5_exclude_stars(spark, d):
    from reviewkit.operators.quality import exclude_values
    return exclude_values(reviews(spark, d), "star", [1, 5]).select("source", "review_id", "star")


@register("p6_star_range", f"""
SELECT min(star) AS min_value, max(star) AS max_value,
       CAST(count(*) FILTER (WHERE NOT (star BETWEEN 1 AND 5)) AS BIGINT) AS violations
FROM {SQL_REVIEWS} r
""")
def p6_star_range(spark, d):
    from reviewkit.operators.quality import range_summary
    return range_summary(reviews(spark, d), "star")


@register("p7_alignment", """
SELECT CAST(count(*) FILTER (WHERE d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE l.doc_id IS NULL) AS BIGINT) AS left_only,
       CAST(count(*) FILTER (WHERE d.doc_id IS NULL) AS BIGINT) AS right_only
FROM (SELECT doc_id FROM documents) d FULL OUTER JOIN (SELECT doc_id FROM labels) l ON d.doc_id = l.doc_id
""")
def p7_alignment(spark, d):
    from reviewkit.operators.quality import alignment
    return alignment(driver.table(spark, d, "documents"), driver.table(spark, d, "labels"), "doc_id")


RANGES = ((1, 5), (2, 4), (1, 3))


@register("p6_observed_range", " UNION ALL ".join(f"""
SELECT {lo} AS lo, {hi} AS hi, min(star) AS min_value, max(star) AS max_value,
       CAST(count(*) FILTER (WHERE NOT (star BETWEEN {lo} AND {hi})) AS BIGINT) AS violations FROM {SQL_REVIEWS} r""" for lo, hi in RANGES))
def p6_observed_range(spark, d):
    """P6 for several bounds, observed while the reviews are stored; the narrower ones have violations."""
    from reviewkit.operators.observed import range_measures, store_observed, values_table
    measures = {f"{name}:{lo}:{hi}": m for lo, hi in RANGES for name, m in range_measures("star", lo, hi).items()}
    _, seen = store_observed(reviews(spark, d), measures)
    rows = [(lo, hi, *(seen[f"{name}:{lo}:{hi}"] for name in ("min_value", "max_value", "violations"))) for lo, hi in RANGES]
    return values_table(spark, rows, "lo int, hi int, min_value int, max_value int, violations long")


@register("p7_observed_alignment", """
SELECT d.doc_id, l.quality, CAST(length(d.text) AS INTEGER) AS n_chars, a.matched, a.left_only, a.right_only
FROM documents d JOIN labels l ON d.doc_id = l.doc_id,
(SELECT CAST(count(*) FILTER (WHERE d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS BIGINT) AS matched,
        CAST(count(*) FILTER (WHERE l.doc_id IS NULL) AS BIGINT) AS left_only,
        CAST(count(*) FILTER (WHERE d.doc_id IS NULL) AS BIGINT) AS right_only
 FROM (SELECT doc_id FROM documents) d FULL OUTER JOIN (SELECT doc_id FROM labels) l ON d.doc_id = l.doc_id) a
""")
def p7_observed_alignment(spark, d):
    """The zipped rows of documents and labels and, from the same write, the counts of the check."""
    from reviewkit.operators.observed import alignment_measures, store_observed
    left = driver.table(spark, d, "documents").select("doc_id", F.length("text").alias("n_chars"), F.lit(True).alias("l"))
    right = driver.table(spark, d, "labels").select("doc_id", "quality", F.lit(True).alias("r"))
    both, seen = store_observed(left.join(right, "doc_id", "full_outer"), alignment_measures("l", "r"))
    return both.where("l AND r").select("doc_id", "quality", "n_chars", *[F.lit(v).alias(k) for k, v in seen.items()])


@register("p8_short_reviews", f"""
SELECT source, review_id, CAST(len(tokens) AS INTEGER) AS n_tokens FROM {sql_doc_tokens()} t WHERE len(tokens) < 64
""")
def p8_short_reviews(spark, d):
    from reviewkit.operators.quality import keep_shorter
    return keep_shorter(doc_tokens(spark, d), "tokens", 64) \
        .select("source", "review_id", F.size("tokens").alias("n_tokens"))


@register("a1_row_count", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT DISTINCT comment, star FROM {SQL_REVIEWS} r
WHERE comment IS NOT NULL AND star IS NOT NULL) x
""")
def a1_row_count(spark, d):
    """A1 on the reference's working table: union -> drop nulls -> dedup -> count."""
    from reviewkit.operators.quality import dedup_pairs, drop_nulls
    w = dedup_pairs(drop_nulls(reviews(spark, d), ["comment", "star"]),
                    order_cols=("source", "review_id"))
    return w.agg(F.count(F.lit(1)).alias("n_rows"))


@register("a2_dedup_pairs", f"""
SELECT CAST(length(comment) AS INTEGER) AS comment_len, star,
       min({{'s': source, 'r': review_id}}).s AS source,
       min({{'s': source, 'r': review_id}}).r AS review_id,
       CAST(count(*) AS BIGINT) AS copies
FROM {SQL_REVIEWS} r GROUP BY comment, star
""")
def a2_dedup_pairs(spark, d):
    from reviewkit.operators.quality import dedup_pairs
    return dedup_pairs(reviews(spark, d), order_cols=("source", "review_id"),
                       count_col="copies") \
        .select(F.length("comment").alias("comment_len"), "star", "source", "review_id", "copies")


@register("a3_star_distribution", f"""
SELECT s.star, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(range AS INTEGER) AS star FROM range(1, 6)) s
LEFT JOIN (SELECT star, count(*) AS n FROM {SQL_REVIEWS} r GROUP BY star) c ON s.star = c.star
""")
def a3_star_distribution(spark, d):
    from reviewkit.operators.quality import star_distribution
    return star_distribution(reviews(spark, d), "star")


@register("j1_zip_columns", """
SELECT c.doc_id, c.text AS comment, CAST(1 + s.doc_id % 5 AS INTEGER) AS star
FROM documents c JOIN documents s ON c.doc_id = s.doc_id
""")
def j1_zip_columns(spark, d):
    """The comment column and the star column zipped back on the row key."""
    from reviewkit.operators.quality import zip_columns
    docs = driver.table(spark, d, "documents")
    comments = docs.select("doc_id", F.col("text").alias("comment"))
    stars = docs.select("doc_id", driver.synthetic_star(F.col("doc_id")).alias("star"))
    return zip_columns(comments, stars, "doc_id")


@register("s2_first_rows", f"""
SELECT review_id, star FROM ({driver.SQL_REVIEWS_A}) a ORDER BY review_id LIMIT 100
""")
def s2_first_rows(spark, d):
    """The first N rows in key order; N is the feature (100 here, below every table's size)."""
    from reviewkit.sources.reviews_csv import first_rows
    return first_rows(driver.reviews_a(spark, d).select("review_id", "star"), 100, "review_id")


# ---------------------------------------------------------------- cleaning T0-T6

def _clean_query(name: str, step, sql_step: str, table: str, id_col: str, text_expr):
    from reviewkit.functions import text as T

    def q(spark, d):
        t = driver.table(spark, d, table)
        return t.select(F.col(id_col), getattr(T, step)(text_expr(t)).alias("cleaned"))

    sql = f"SELECT {id_col}, {sql_step} AS cleaned FROM {table}"
    register(name, sql)(q)


_PAGE_TEXT = "url || ' ' || html"
for _name, _step, _table, _id, _expr, _sqlexpr in [
    # Full stops become ideographic ones and commas full-width ones; list items get the marker.
    ("t1_cjk_punct", "replace_cjk_punct", "documents", "doc_id", lambda t: F.translate(t.text, ".,", "\u3002\uff0c"),
     "translate(text, '.,', '\u3002\uff0c')"),
    ("t2_html_marker", "remove_html_marker", "pages", "page_id",
     lambda t: F.replace(t.html, F.lit("<p>"), F.lit("{html}<p>")), "replace(html, '<p>', '{html}<p>')"),
    ("t3_strip_tags", "strip_tags", "pages", "page_id", lambda t: t.html, "html"),
    ("t4_strip_urls", "strip_urls", "pages", "page_id",
     lambda t: F.concat_ws(" ", t.url, t.html), _PAGE_TEXT),
    ("t5_strip_digits", "strip_digits", "documents", "doc_id", lambda t: t.text, "text"),
    ("t6_strip_space", "strip_space", "conversations", "conv_id",
     lambda t: F.concat(t.text, F.lit(" \n")), "text || ' ' || chr(10)"),
]:
    _clean_query(_name, _step, sql_step(_sqlexpr, _step), _table, _id, _expr)


@register("t0_cast_text", f"SELECT source, review_id, CAST(star AS VARCHAR) AS star_text FROM {SQL_REVIEWS} r")
def t0_cast_text(spark, d):
    from reviewkit.functions.text import to_text
    return reviews(spark, d).select("source", "review_id", to_text(F.col("star")).alias("star_text"))


@register("t11_clean_full", f"""
SELECT page_id, {sql_clean(_PAGE_TEXT, 'full')} AS cleaned FROM pages
""")
def t11_clean_full(spark, d):
    """Full cleaning profile (T1 -> T6 in order) on raw web pages."""
    from reviewkit.functions.text import clean_text
    p = driver.table(spark, d, "pages")
    return p.select("page_id", clean_text(F.concat_ws(" ", p.url, p.html), "full").alias("cleaned"))


@register("t11_tokenize", f"""
SELECT source, review_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS tokens_text
FROM {sql_doc_tokens(None)} t
""")
def t11_tokenize(spark, d):
    """Clean + tokenize without stop words."""
    t = doc_tokens(spark, d, stop=None)
    return t.select(*KEY, F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens_text"))


@register("j3_stop_ci", f"""
SELECT source, review_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS tokens_text
FROM {sql_doc_tokens('ci')} t
""")
def j3_stop_ci(spark, d):
    t = doc_tokens(spark, d, stop="ci")
    return t.select(*KEY, F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens_text"))


@register("j4_stop_exact", f"""
SELECT source, review_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS tokens_text
FROM {sql_doc_tokens('exact')} t
""")
def j4_stop_exact(spark, d):
    t = doc_tokens(spark, d, stop="exact")
    return t.select(*KEY, F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens_text"))


@register("t12_token_count", f"""
SELECT source, review_id, CAST(len(tokens) AS INTEGER) AS n_tokens FROM {sql_doc_tokens()} t
""")
def t12_token_count(spark, d):
    from reviewkit.functions.text import token_count
    return doc_tokens(spark, d).select(*KEY, token_count(F.col("tokens")).alias("n_tokens"))


@register("t13_tokens_json", f"SELECT source, review_id, to_json(tokens)::VARCHAR AS tokens_json FROM {sql_doc_tokens()} t")
def t13_tokens_json(spark, d):
    from reviewkit.functions.text import tokens_to_json
    return doc_tokens(spark, d).select(*KEY, tokens_to_json(F.col("tokens")).alias("tokens_json"))


CHUNK = 100
SQL_CHUNKS = f"""(SELECT *, CAST(floor((row_number() OVER (ORDER BY source, review_id) - 1) / {CHUNK}) * {CHUNK} AS BIGINT) AS chunk
  FROM {SQL_CORPUS_TOKENS} t)"""


@register("s4_chunk_counts", f"SELECT chunk, source, review_id FROM {SQL_CHUNKS} c")
def s4_chunk_counts(spark, d):
    """S4 chunk assignment: start row of the chunk (of 100 rows here) each review goes to."""
    from reviewkit.sources.chunks import assign_chunks
    return assign_chunks(reviews(spark, d).select(*KEY), KEY, CHUNK).select("chunk", *KEY)


@register("s5_chunk_round_trip", f"""
SELECT chunk, source, review_id, star, array_to_string(tokens, ' ') AS tokens_text FROM {SQL_CHUNKS} c
""")
def s5_chunk_round_trip(spark, d):
    """S4 + S5: token chunks written as CSV in the shared folder and read back."""
    from reviewkit.session import scratch_path
    from reviewkit.sources.chunks import read_token_chunks, write_token_chunks
    path = scratch_path(spark, "chunks")
    write_token_chunks(doc_tokens(spark, d), path, KEY, chunk_rows=CHUNK)
    back = read_token_chunks(spark, path, "source string, review_id long")
    return back.select("chunk", *KEY, "star", F.array_join("tokens", " ").alias("tokens_text"))


def _csv_comment(text, key):
    """A comment with quotes, a line break, or a missing-value token, by key."""
    return F.when(key % 10 == 3, F.lit("None")).when(key % 10 == 4, F.concat(F.lit('say "hi", '), text)) \
        .when(key % 10 == 5, F.concat(F.lit("two\nlines,"), text)).otherwise(text)


SQL_DUMP = """
WITH c AS (SELECT doc_id AS review_id, CAST(1 + doc_id % 5 AS INTEGER) AS star,
  CASE doc_id % 10 WHEN 3 THEN NULL WHEN 4 THEN 'say "hi", ' || text WHEN 5 THEN 'two' || chr(10) || 'lines,' || text ELSE text END AS comment
  FROM documents)
SELECT review_id, star, comment, CAST(0 AS BIGINT) AS n_corrupt FROM c
"""


def written_dump(spark, d):
    """Source A written as a CSV dump (quotes, line breaks, NA tokens): its path."""
    from reviewkit.session import scratch_path
    from reviewkit.sources.reviews_csv import SCHEMA_A
    a = driver.reviews_a(spark, d)
    given = {"ID": F.col("review_id"), "Star": F.col("star"), "Comment": _csv_comment(F.col("comment"), F.col("review_id")),
             "Username": F.lit('a "b"')}
    rows = a.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMA_A.fields])
    path = scratch_path(spark, "dump")
    rows.write.options(header=True, quote='"', escape='"', quoteAll=False).csv(path)
    return path


def _with_corrupt(read):
    """The rows of a scan and, on each, the number of its corrupt records."""
    from reviewkit.sources.reviews_csv import corrupt_records
    bad = corrupt_records(read).select(F.col("n_corrupt").alias("n_corrupt"))
    return read.select(F.col("ID").alias("review_id"), F.col("Star").alias("star"), F.col("Comment").alias("comment")) \
        .crossJoin(F.broadcast(bad))  # one row


@register("s1_csv_round_trip", SQL_DUMP)
def s1_csv_round_trip(spark, d):
    """A review dump scanned with the declared schema, a task a file."""
    from reviewkit.sources.reviews_csv import SCHEMA_A, read_reviews_csv
    return _with_corrupt(read_reviews_csv(spark, written_dump(spark, d), SCHEMA_A, keep_corrupt=True))


@register("s1_split_scan", SQL_DUMP)
def s1_split_scan(spark, d):
    """The same dump by the scan that splits files, its multi-line records stitched."""
    from reviewkit.operators.joins import materialize
    from reviewkit.sources.csv_split import read_reviews_split
    from reviewkit.sources.reviews_csv import SCHEMA_A
    return _with_corrupt(materialize(read_reviews_split(spark, written_dump(spark, d), SCHEMA_A, keep_corrupt=True)))


@register("s1_split_records", """
SELECT CAST(count(*) AS BIGINT) AS n_records, CAST(count(*) FILTER (WHERE doc_id % 10 = 5) AS BIGINT) AS n_long,
       CAST(sum(length(text)) AS BIGINT) AS text_chars FROM documents
""")
def s1_split_records(spark, d):
    """Records of a dump that holds only ids and texts, all texts quoted, some over several lines."""
    from reviewkit.session import scratch_path
    from reviewkit.sources.csv_split import csv_records
    docs = driver.table(spark, d, "documents")
    broken = F.when(docs.doc_id % 10 == 5, F.concat(docs.text, F.lit('\n"\n,"'))).otherwise(docs.text)
    path = scratch_path(spark, "dump")
    docs.select(broken.alias("text")).write.options(header=True, quote='"', escape='"', quoteAll=True).csv(path)
    record = F.col("record")
    bare = F.regexp_replace(F.substring(record, F.lit(2), F.length(record) - 2), '""', '"')
    extra = F.when(F.endswith(bare, F.lit('\n"\n,"')), 5).otherwise(0)
    return csv_records(spark, path).agg(
        F.count(F.lit(1)).alias("n_records"), F.count_if(extra > 0).alias("n_long"), F.sum(F.length(bare) - extra).cast("long").alias("text_chars"))


_KEPT = ("the", "of")


@register("s3_stopword_files", f"""
SELECT DISTINCT token AS word FROM (
  SELECT unnest({sql_letter_tokens(sql_clean('text'))}) AS token FROM benchmark
  UNION ALL SELECT lang FROM documents UNION ALL SELECT role FROM conversations) t
WHERE token NOT IN {_KEPT!r}
""")
def s3_stopword_files(spark, d):
    """S3 + K4: word files with blanks around the words, read, stripped, united, minus the words to keep."""
    from reviewkit.operators.tokens import tokenize
    from reviewkit.session import scratch_path
    from reviewkit.sources.stopwords import read_stopword_files
    words = tokenize(driver.reviews_b(spark, d)).select(F.explode("tokens").alias("w"))
    lists = [words, driver.table(spark, d, "documents").select(F.col("lang").alias("w")),
             driver.table(spark, d, "conversations").select(F.col("role").alias("w"))]
    paths = []
    for k, one in enumerate(lists):
        paths.append(scratch_path(spark, f"stop-{k}"))
        one.distinct().select(F.concat(F.lit(" \u3000"), "w", F.lit("\t"))).write.text(paths[-1])
    return read_stopword_files(spark, paths, keep=_KEPT)


# ---------------------------------------------------------------- labels T14-T16, T17

for _rule, _key in [("canonical", "t14_sentiment"), ("shifted", "t15_sentiment_shifted"),
                    ("top_star", "t16_sentiment_top_star")]:
    def _q(spark, d, _rule=_rule):
        from reviewkit.functions.labels import sentiment
        return reviews(spark, d).select("source", "review_id", "star",
                                        sentiment(F.col("star"), _rule).alias("label"))
    from reviewkit.functions.labels import sql_sentiment as _ss
    register(_key, f"SELECT source, review_id, star, {_ss('star', _rule)} AS label FROM {SQL_REVIEWS} r")(_q)


def _sql_class_score(k: int) -> str:
    parts = f"list_filter(embedding, lambda x, i: (i - 1) % 3 = {k})"
    return f"list_sum(list_transform({parts}, lambda x: CAST(x AS DOUBLE))) / len({parts})"


SQL_PRED = (f"(SELECT vec_id, [{', '.join(_sql_class_score(k) for k in range(3))}] AS scores, label % 3 AS label "
            "FROM embeddings)")
SQL_ARGMAX = "CAST(list_position(scores, list_max(scores)) - 1 AS INTEGER)"


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Deterministic class scores from all components: score k = mean of the components i with i % 3 = k; label % 3."""
    from reviewkit.operators.metrics import with_prediction
    e = driver.table(spark, d, "embeddings")

    def mean(k: int):
        parts = F.transform(F.filter("embedding", lambda x, i: i % 3 == k), lambda x: x.cast("double"))
        return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts)

    return with_prediction(e.select("vec_id", F.array(*[mean(k) for k in range(3)]).alias("scores"),
                                    (F.col("label") % 3).alias("label")))


@register("t17_argmax", f"SELECT vec_id, {SQL_ARGMAX} AS pred FROM {SQL_PRED} p")
def t17_argmax(spark, d):
    return predictions(spark, d).select("vec_id", "pred")


# ---------------------------------------------------------------- words and vocabulary

@register("a4_word_count", f"""
WITH t AS (SELECT unnest(tokens) AS token FROM {SQL_CORPUS_TOKENS} c)
SELECT token, CAST(count(*) AS BIGINT) AS freq FROM t GROUP BY token
""")
def a4_word_count(spark, d):
    from reviewkit.operators.vocab import word_counts
    return word_counts(corpus_tokens(spark, d))


@register("k1_top_words", f"""
WITH t AS (SELECT unnest(tokens) AS token FROM {SQL_CORPUS_TOKENS} c)
SELECT token, CAST(count(*) AS BIGINT) AS freq FROM t GROUP BY token ORDER BY freq DESC, token LIMIT 100
""")
def k1_top_words(spark, d):
    """K1 top-k report (k = 100): the limit is the feature."""
    from reviewkit.operators.vocab import most_common, word_counts
    return most_common(word_counts(corpus_tokens(spark, d)), 100)


VOCAB_MIN_FREQ = 16  # make_vocab default


@register("a6_vocabulary", f"SELECT * FROM {sql_vocab(SQL_CORPUS_TOKENS, VOCAB_MIN_FREQ)} v")
def a6_vocabulary(spark, d):
    from reviewkit.operators.vocab import build_vocabulary, word_counts
    return build_vocabulary(word_counts(corpus_tokens(spark, d)), VOCAB_MIN_FREQ)


@register("a7_vocab_size", f"""
SELECT CAST(count(*) AS BIGINT) AS vocab_size FROM {sql_vocab(SQL_CORPUS_TOKENS, VOCAB_MIN_FREQ)} v
""")
def a7_vocab_size(spark, d):
    from reviewkit.operators.vocab import build_vocabulary, vocabulary_size, word_counts
    return vocabulary_size(build_vocabulary(word_counts(corpus_tokens(spark, d)), VOCAB_MIN_FREQ))


@register("s6_vocabulary_round_trip", f"SELECT * FROM {sql_vocab(SQL_CORPUS_TOKENS, VOCAB_MIN_FREQ)} v")
def s6_vocabulary_round_trip(spark, d):
    """The vocabulary saved to the shared folder and loaded."""
    from reviewkit.operators.vocab import build_vocabulary, load_vocabulary, save_vocabulary, word_counts
    from reviewkit.session import scratch_path
    path = scratch_path(spark, "vocabulary")
    save_vocabulary(build_vocabulary(word_counts(corpus_tokens(spark, d)), VOCAB_MIN_FREQ), path, VOCAB_MIN_FREQ)
    return load_vocabulary(spark, path)


@register("s7_word_list_round_trip", f"""
WITH t AS (SELECT unnest(tokens) AS token FROM {SQL_CORPUS_TOKENS} c),
f AS (SELECT token, count(*) AS freq FROM t GROUP BY token HAVING count(*) >= 20)
SELECT CAST(row_number() OVER (ORDER BY freq DESC, token) AS BIGINT) AS line, token FROM f
""")
def s7_word_list_round_trip(spark, d):
    """The frequent words written one per line, most frequent first, and read back with their line numbers."""
    from reviewkit.operators.vocab import high_frequency_words, read_word_list, word_counts, write_word_list
    from reviewkit.session import scratch_path
    path = scratch_path(spark, "words")
    write_word_list(high_frequency_words(word_counts(corpus_tokens(spark, d)), 20), path)
    return read_word_list(spark, path)


# ---------------------------------------------------------------- encoding E1-E5, J2

ENCODE_MIN_FREQ = 2   # notebook / first training script
ENCODE_LEN = 64       # training length
SQL_DOC_TOK = sql_doc_tokens()


def prepared(spark, d, specials=("<unk>", "<pad>")):
    """Both sources: tokens stored once and the vocabulary over them (plans/corpus.py)."""
    from reviewkit.plans.corpus import prepare
    return prepare(reviews(spark, d), STOP, ENCODE_MIN_FREQ, specials)


def sql_encoded(length: int, tokens_table: str = SQL_DOC_TOK, min_freq: int = ENCODE_MIN_FREQ,
                width_expr: str | None = None) -> str:
    """DuckDB E1/E2: ids of the first `width` tokens, right-padded with 1 to `width`."""
    w = width_expr or str(length)
    return f"""(
  WITH tok AS (SELECT * FROM {tokens_table} t0),
  vocab AS (SELECT * FROM {sql_vocab(tokens_table, min_freq)} v0),
  ex AS (SELECT source, review_id, unnest(list_slice(tokens, 1, {w})) AS token,
                generate_subscripts(list_slice(tokens, 1, {w}), 1) AS pos FROM tok),
  ids AS (SELECT source, review_id, list(coalesce(vocab.token_id, 0) ORDER BY pos) AS ids
          FROM ex LEFT JOIN vocab ON ex.token = vocab.token GROUP BY source, review_id)
  SELECT source, review_id, list_resize(coalesce(ids.ids, []::BIGINT[]), {w}, 1) AS input_ids
  FROM tok LEFT JOIN ids USING (source, review_id)
)"""


@register("j2_vocab_lookup", f"""
WITH vocab AS (SELECT * FROM {sql_vocab(SQL_DOC_TOK, ENCODE_MIN_FREQ)} v0),
ex AS (SELECT source, review_id, unnest(tokens) AS token FROM {SQL_DOC_TOK} t)
SELECT source, review_id, CAST(count(*) AS BIGINT) AS n_tokens,
       CAST(count(*) FILTER (WHERE vocab.token_id IS NULL) AS BIGINT) AS n_unknown,
       CAST(sum(coalesce(vocab.token_id, 0)) AS BIGINT) AS id_sum
FROM ex LEFT JOIN vocab ON ex.token = vocab.token GROUP BY source, review_id
""")
def j2_vocab_lookup(spark, d):
    """J2 over every token: per review, tokens, unknown tokens and the sum of ids."""
    from reviewkit.operators.encode import lookup_ids
    from reviewkit.operators.tokens import explode_tokens
    c = prepared(spark, d)
    j = lookup_ids(explode_tokens(c.tokens, KEY), c.vocabulary)
    return j.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.count_if(F.col("token_id") == 0).cast("long").alias("n_unknown"),
        F.sum("token_id").cast("long").alias("id_sum"))


@register("e1_encode", f"""
SELECT source, review_id, array_to_string(input_ids, ',') AS input_ids FROM {sql_encoded(ENCODE_LEN)} e
""")
def e1_encode(spark, d):
    from reviewkit.functions.arrays import ids_text
    return prepared(spark, d).encoded(ENCODE_LEN).select(*KEY, ids_text(F.col("input_ids")).alias("input_ids"))


@register("e2_pad_longest", f"""
SELECT source, review_id, array_to_string(input_ids, ',') AS input_ids
FROM {sql_encoded(ENCODE_LEN, width_expr=f"(SELECT least(max(len(tokens)), {ENCODE_LEN}) FROM {SQL_DOC_TOK} w)")} e
""")
def e2_pad_longest(spark, d):
    from reviewkit.functions.arrays import ids_text
    from reviewkit.operators.encode import encode_to_longest
    c = prepared(spark, d)
    e = encode_to_longest(c.tokens, c.vocabulary, KEY, length=ENCODE_LEN)
    return e.select(*KEY, ids_text(F.col("input_ids")).alias("input_ids"))


@register("e3_mask", f"""
SELECT source, review_id, array_to_string(list_transform(input_ids, lambda x: CASE WHEN x = 1 THEN 0 ELSE 1 END), ',')
       AS attention_mask, CAST(list_sum(list_transform(input_ids, lambda x: CASE WHEN x = 1 THEN 0 ELSE 1 END))
       AS INTEGER) AS n_valid
FROM {sql_encoded(ENCODE_LEN)} e
""")
def e3_mask(spark, d):
    from reviewkit.functions.arrays import ids_text
    from reviewkit.operators.encode import with_mask
    e = with_mask(prepared(spark, d).encoded(ENCODE_LEN))
    return e.select(*KEY, ids_text(F.col("attention_mask")).alias("attention_mask"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_valid"))


FRAMED_SPECIALS = ("<unk>", "<pad>", "<s>", "</s>")


@register("e4_framed", f"""
WITH tok AS (SELECT * FROM {SQL_DOC_TOK} t0),
vocab AS (SELECT * FROM {sql_vocab(SQL_DOC_TOK, ENCODE_MIN_FREQ, FRAMED_SPECIALS)} v0),
ex AS (SELECT source, review_id, unnest(list_slice(tokens, 1, {ENCODE_LEN - 2})) AS token,
              generate_subscripts(list_slice(tokens, 1, {ENCODE_LEN - 2}), 1) AS pos FROM tok),
ids AS (SELECT source, review_id, list(coalesce(vocab.token_id, 0) ORDER BY pos) AS ids
        FROM ex LEFT JOIN vocab ON ex.token = vocab.token GROUP BY source, review_id),
fr AS (SELECT source, review_id, tok.star,
              list_resize(list_concat([2::BIGINT], coalesce(ids.ids, []::BIGINT[]), [3::BIGINT]), {ENCODE_LEN}, 1) AS x
       FROM tok LEFT JOIN ids USING (source, review_id))
SELECT source, review_id, r.comment AS review_text, array_to_string(x, ',') AS input_ids,
       array_to_string(list_transform(x, lambda v: CASE WHEN v = 1 THEN 0 ELSE 1 END), ',') AS attention_mask,
       {sql_sentiment('fr.star')} AS labels
FROM fr JOIN {SQL_REVIEWS} r USING (source, review_id)
""")
def e4_framed(spark, d):
    from reviewkit.functions.arrays import ids_text
    from reviewkit.functions.labels import sentiment
    from reviewkit.operators.encode import encode_framed
    c = prepared(spark, d, FRAMED_SPECIALS)
    sides = reviews(spark, d).select(*KEY, "comment", sentiment(F.col("star")).alias("label"))
    e = encode_framed(c.tokens, c.vocabulary, KEY, "comment", "label", length=ENCODE_LEN, sides=sides)
    return e.select(*KEY, "example.review_text",
                    ids_text(F.col("example.input_ids")).alias("input_ids"),
                    ids_text(F.col("example.attention_mask")).alias("attention_mask"),
                    "example.labels")


@register("e5_examples", f"""
SELECT source, review_id, array_to_string(e.input_ids, ',') AS input_ids, {sql_sentiment('r.star')} AS label
FROM {sql_encoded(ENCODE_LEN)} e JOIN {SQL_REVIEWS} r USING (source, review_id)
""")
def e5_examples(spark, d):
    from reviewkit.functions.arrays import ids_text
    ex = prepared(spark, d).examples(ENCODE_LEN)
    return ex.select(*KEY, ids_text(F.col("input_ids")).alias("input_ids"), "label")


SQL_WORKING = f"""(SELECT first.source AS source, first.review_id AS review_id, star, comment FROM (
  SELECT comment, star, min({{'source': source, 'review_id': review_id}}) AS first
  FROM {SQL_REVIEWS} r WHERE comment IS NOT NULL AND star IS NOT NULL GROUP BY comment, star) g)"""
SQL_WORKING_TOKENS = f"(SELECT source, review_id, star, {sql_tokens('comment')} AS tokens FROM {SQL_WORKING} w)"


@register("e5_corpus_examples", f"""
SELECT source, review_id, array_to_string(e.input_ids, ',') AS input_ids, {sql_sentiment('r.star')} AS label
FROM {sql_encoded(ENCODE_LEN, SQL_WORKING_TOKENS)} e JOIN {SQL_WORKING} r USING (source, review_id)
""")
def e5_corpus_examples(spark, d):
    """The whole preparation: union, null drop, dedup, clean, tokens, vocabulary, encoding, labels."""
    from reviewkit.functions.arrays import ids_text
    from reviewkit.plans.corpus import prepare, working_reviews
    ex = prepare(working_reviews(reviews(spark, d)), STOP, ENCODE_MIN_FREQ).examples(ENCODE_LEN)
    return ex.select(*KEY, ids_text(F.col("input_ids")).alias("input_ids"), "label")


@register("e10_mean_vectors", f"""
WITH ex AS (SELECT source, review_id, unnest(input_ids) AS token_id FROM {sql_encoded(ENCODE_LEN)} e),
j AS (SELECT ex.source, ex.review_id, emb.embedding FROM ex
      JOIN embeddings emb ON emb.vec_id = ex.token_id % (SELECT count(*) FROM embeddings)),
dims AS (SELECT source, review_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM j)
SELECT source, review_id, CAST(dim AS INTEGER) AS dim, round(sum(CAST(v AS DOUBLE)) / count(*), 6) AS value
FROM dims GROUP BY source, review_id, dim
""")
def e10_mean_vectors(spark, d):
    """Mean token vector per review over the 64 encoded positions, pads included.

    Token id t uses vector t % (number of vectors) of the embeddings table.
    """
    from reviewkit.operators.encode import mean_vectors
    from reviewkit.operators.joins import checked_broadcast
    emb = driver.table(spark, d, "embeddings")
    n_vec = emb.select(F.count(F.lit(1))).scalar()
    vec = checked_broadcast(emb.select(F.col("vec_id").alias("vec_key"), F.col("embedding").alias("vec")),
                            max_rows=500_000, materialized=True)
    m = mean_vectors(prepared(spark, d).encoded(ENCODE_LEN), vec, KEY, vec_key=lambda t: t % n_vec)
    return m.select(*KEY, F.posexplode("mean_vec").alias("dim", "value")) \
        .select(*KEY, "dim", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- sampling W4, K2, E6-E9

SEED = 42
SQL_HASH = "md5('{seed}:' || {id})"
SQL_KEY_TEXT = "source || ':' || CAST(review_id AS VARCHAR)"
SQL_ORDER = f"{SQL_HASH.format(seed=SEED, id=SQL_KEY_TEXT)}, source, review_id"


@register("w4_row_index", """
SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_index FROM labels
""")
def w4_row_index(spark, d):
    """W4 on the labelled subset (sparse ids): dense 0-based index in id order."""
    from reviewkit.operators.sampling import row_index
    return row_index(driver.table(spark, d, "labels").select("doc_id"), "doc_id")


@register("k2_shuffle", f"""
SELECT source, review_id, CAST(row_number() OVER (ORDER BY {SQL_ORDER}) - 1 AS BIGINT) AS position FROM {SQL_REVIEWS} r
""")
def k2_shuffle(spark, d):
    from reviewkit.operators.sampling import shuffle_order
    return shuffle_order(reviews(spark, d).select(*KEY), KEY, SEED)


@register("e6_split", f"""
SELECT source, review_id, CASE WHEN row_number() OVER (ORDER BY {SQL_ORDER})
                 <= floor(CAST(count(*) OVER () AS DOUBLE) * 0.9) THEN 'train' ELSE 'valid' END AS split
FROM {SQL_REVIEWS} r
""")
def e6_split(spark, d):
    """Exact 90/10 split (train = floor(n * 0.9))."""
    from reviewkit.operators.sampling import exact_split
    return exact_split(reviews(spark, d).select(*KEY), KEY, SEED, 0.9)


@register("e7_approx_split", f"""
SELECT source, review_id,
       CASE WHEN CAST(('0x' || substr({SQL_HASH.format(seed=SEED, id=SQL_KEY_TEXT)}, 1, 8))::BIGINT AS DOUBLE)
                 / 4294967296.0 < 0.9 THEN 'train' ELSE 'valid' END AS split
FROM {SQL_REVIEWS} r
""")
def e7_approx_split(spark, d):
    from reviewkit.operators.sampling import approx_split
    return approx_split(reviews(spark, d).select(*KEY), KEY, SEED, 0.9)


K_FOLDS, FOLD_I = 10, 0


@register("e8_k_fold", f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM labels),
f AS (SELECT doc_id, CAST(floor((rn - 1) / floor(n / {K_FOLDS})) AS BIGINT) AS fold FROM r)
SELECT doc_id, fold, CASE WHEN fold = {FOLD_I} THEN 'valid' ELSE 'train' END AS role FROM f WHERE fold < {K_FOLDS}
""")
def e8_k_fold(spark, d):
    """Fold 0 of 10 over the labelled subset; the last n % 10 rows are in no fold."""
    from reviewkit.operators.sampling import k_fold
    return k_fold(driver.table(spark, d, "labels").select("doc_id"), "doc_id", K_FOLDS, FOLD_I)


BATCH = 128


@register("e9_batches", f"""
WITH r AS (SELECT source, review_id, row_number() OVER (ORDER BY {SQL_ORDER}) - 1 AS p FROM {SQL_REVIEWS} r0)
SELECT source, review_id, CAST(floor(p / {BATCH}) AS BIGINT) AS batch_id, CAST(p % {BATCH} AS BIGINT) AS batch_pos
FROM r
""")
def e9_batches(spark, d):
    """Shuffled mini-batches of 128 (the last one short)."""
    from reviewkit.operators.sampling import mini_batches
    return mini_batches(reviews(spark, d).select(*KEY), KEY, BATCH, SEED)


# ---------------------------------------------------------------- lengths A8, A9

@register("a8_length_hist", f"""
WITH l AS (SELECT len(tokens) AS n FROM {SQL_DOC_TOK} t),
b AS (SELECT min(n) AS lo, max(n) AS hi FROM l),
c AS (SELECT CASE WHEN b.hi = b.lo THEN 15 ELSE least(29, floor((l.n - b.lo) * 30 / (b.hi - b.lo))) END AS bin,
             count(*) AS n FROM l, b GROUP BY 1),
e AS (SELECT CASE WHEN hi = lo THEN lo - 0.5 ELSE CAST(lo AS DOUBLE) END AS f,
             CASE WHEN hi = lo THEN hi + 0.5 ELSE CAST(hi AS DOUBLE) END AS t FROM b)
SELECT CAST(r.range AS INTEGER) AS bin, round(e.f + r.range * (e.t - e.f) / 30, 6) AS lo_edge,
       round(e.f + (r.range + 1) * (e.t - e.f) / 30, 6) AS hi_edge, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM range(30) r CROSS JOIN e LEFT JOIN c ON c.bin = r.range
""")
def a8_length_hist(spark, d):
    from reviewkit.operators.metrics import length_histogram
    t = doc_tokens(spark, d)
    return length_histogram(t.select(F.size("tokens").alias("n_tokens")), "n_tokens", 30)


@register("a9_length_coverage", f"""
SELECT CAST(count(*) FILTER (WHERE len(tokens) < 64) AS BIGINT) AS n_short, CAST(count(*) AS BIGINT) AS n_rows,
       round(100.0 * count(*) FILTER (WHERE len(tokens) < 64) / count(*), 6) AS pct_short
FROM {SQL_DOC_TOK} t
""")
def a9_length_coverage(spark, d):
    from reviewkit.operators.metrics import length_coverage
    t = doc_tokens(spark, d)
    return length_coverage(t.select(F.size("tokens").alias("n_tokens")), "n_tokens", 64)


# ---------------------------------------------------------------- accuracy, loss A10-A16

SQL_PRED_B = f"""(SELECT vec_id, scores, label, {SQL_ARGMAX} AS pred,
  CAST(floor((row_number() OVER (ORDER BY vec_id) - 1) / 4) AS BIGINT) AS batch_id FROM {SQL_PRED} p0)"""
SQL_BATCH_ACC = f"""(SELECT batch_id, CAST(sum(CASE WHEN pred = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
  CAST(count(*) AS BIGINT) AS total, round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
  FROM {SQL_PRED_B} pb GROUP BY batch_id)"""


def batched_predictions(spark, d):
    from reviewkit.operators.sampling import mini_batches
    return mini_batches(predictions(spark, d), "vec_id", 4)


@register("a10_pooled_accuracy", f"""
SELECT round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(100.0 * avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy_pct,
       CAST(count(*) AS BIGINT) AS total
FROM (SELECT label, {SQL_ARGMAX} AS pred FROM {SQL_PRED} p) x
""")
def a10_pooled_accuracy(spark, d):
    from reviewkit.operators.metrics import pooled_accuracy
    return pooled_accuracy(predictions(spark, d))


@register("a11_batch_accuracy", f"SELECT * FROM {SQL_BATCH_ACC} b")
def a11_batch_accuracy(spark, d):
    from reviewkit.operators.metrics import batch_accuracy
    return batch_accuracy(batched_predictions(spark, d))


@register("a12_mean_batch_accuracy", f"""
SELECT round(avg(correct / total), 6) AS mean_batch_accuracy, CAST(count(*) AS BIGINT) AS batches FROM {SQL_BATCH_ACC} b
""")
def a12_mean_batch_accuracy(spark, d):
    from reviewkit.operators.metrics import batch_accuracy, mean_batch_accuracy
    return mean_batch_accuracy(batch_accuracy(batched_predictions(spark, d)))


@register("a13_truncated_eval", f"""
SELECT round(avg(correct / total), 6) AS mean_batch_accuracy, CAST(count(*) AS BIGINT) AS batches
FROM {SQL_BATCH_ACC} b WHERE batch_id <= 100
""")
def a13_truncated_eval(spark, d):
    """The reference stops after 101 batches (len > 100 tested after append)."""
    from reviewkit.operators.metrics import batch_accuracy, mean_batch_accuracy
    return mean_batch_accuracy(batch_accuracy(batched_predictions(spark, d)), max_batch=100)


@register("a14_cross_entropy", f"""
WITH x AS (SELECT scores, label, list_max(scores) AS m FROM {SQL_PRED} p)
SELECT round(avg(m + ln(list_sum(list_transform(scores, lambda s: exp(s - m)))) - scores[label + 1]), 6)
       AS cross_entropy, CAST(count(*) AS BIGINT) AS total FROM x
""")
def a14_cross_entropy(spark, d):
    from reviewkit.operators.metrics import mean_cross_entropy
    return mean_cross_entropy(predictions(spark, d))


@register("a16_class_report", f"""
WITH conf AS (SELECT label, {SQL_ARGMAX} AS pred, count(*) AS n FROM {SQL_PRED} p GROUP BY 1, 2),
per AS (SELECT cls, sum(tp) AS tp, sum(n) AS support, sum(pn) AS predicted FROM (
          SELECT label AS cls, n, CASE WHEN label = pred THEN n ELSE 0 END AS tp, 0 AS pn FROM conf
          UNION ALL SELECT pred AS cls, 0 AS n, 0 AS tp, n AS pn FROM conf) u GROUP BY cls),
pr AS (SELECT cls, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM per)
SELECT CAST(cls AS INTEGER) AS class, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1, CAST(support AS BIGINT) AS support
FROM pr
""")
def a16_class_report(spark, d):
    from reviewkit.operators.metrics import class_report
    return class_report(predictions(spark, d))


# ---------------------------------------------------------------- training history A15, W1-W3

SQL_HISTORY = """(
  WITH e AS (SELECT event_id, ts, value, event_type,
                    CAST(date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS INTEGER) AS epoch
             FROM events),
  r AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY ts, event_id) AS rn FROM e)
  SELECT epoch, CAST(floor((rn - 1) / 32) AS BIGINT) AS batch, avg(value) AS loss,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS correct, CAST(count(*) AS BIGINT) AS total
  FROM r GROUP BY 1, 2)"""
SQL_EPOCH_ACC = f"""(SELECT epoch, round(100.0 * sum(correct) / sum(total) + 1e-9, 6) AS accuracy
  FROM {SQL_HISTORY} h GROUP BY epoch)"""


def history(spark, d):
    from reviewkit.operators.metrics import metric_history
    return metric_history(driver.table(spark, d, "events"), 32)


@register("a15_epoch_loss", f"""
SELECT epoch, round(avg(loss) + 1e-9, 6) AS epoch_loss, CAST(count(*) AS BIGINT) AS batches FROM {SQL_HISTORY} h GROUP BY epoch
""")
def a15_epoch_loss(spark, d):
    from reviewkit.operators.metrics import epoch_loss
    return epoch_loss(history(spark, d))


@register("w1_running_metrics", f"""
SELECT epoch, batch,
  round(avg(loss) OVER (PARTITION BY epoch ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1e-9, 6)
    AS running_loss,
  round(100.0 * sum(correct) OVER (PARTITION BY epoch ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    / sum(total) OVER (PARTITION BY epoch ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1e-9, 6)
    AS running_accuracy
FROM {SQL_HISTORY} h
""")
def w1_running_metrics(spark, d):
    from reviewkit.operators.metrics import running_metrics
    return running_metrics(history(spark, d))


@register("w2_new_best", f"""
SELECT epoch, accuracy,
       accuracy > coalesce(max(accuracy) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)
       AS is_best
FROM {SQL_EPOCH_ACC} a
""")
def w2_new_best(spark, d):
    from reviewkit.operators.metrics import epoch_accuracy, new_best
    return new_best(epoch_accuracy(history(spark, d)))


@register("w3_every_20th", f"SELECT epoch, accuracy FROM {SQL_EPOCH_ACC} a WHERE (epoch + 1) % 20 = 0")
def w3_every_20th(spark, d):
    from reviewkit.operators.metrics import epoch_accuracy, every_nth_epoch
    return every_nth_epoch(epoch_accuracy(history(spark, d)), 20)


# ---------------------------------------------------------------- segmentation T7-T10, J5
# Both review sources. Driver texts hold no Han characters. Frequent letters are mapped to Han ones (one translate on both sides), so
# that words become runs of Han and Latin letters, segmented with the default patterns.

HAN_FROM, HAN_TO = "etnhorsiad", "的一是不了在人有我他"
SQL_HAN = r"[\x{4e00}-\x{9fd5}]+"
SQL_OTHER = r"[\p{Latin}\p{N}]+"   # the driver's other letters are Latin
DICT_MIN_FREQ = 16


def cleaned_docs(spark, d):
    """The reviews of both sources with Han letters, cleaned."""
    from reviewkit.functions.text import clean_text
    text = F.translate("comment", HAN_FROM, HAN_TO)
    return reviews(spark, d).select(*KEY, clean_text(text).alias("text"))


def han_units(docs):
    """Counts of the texts' units (Han blocks and other runs), stored: dictionary and segmentation read them."""
    from reviewkit.operators.segment import unit_counts
    return unit_counts(docs, "text")


def block_dictionary(units):
    """Dictionary of the frequent Han blocks, whatever their length."""
    from reviewkit.operators.segment import HAN_RE, dictionary_from_counts
    blocks = units.where(F.col("block").rlike(f"^{HAN_RE}$"))
    return dictionary_from_counts(blocks.select(F.col("block").alias("token"), F.col("n").alias("freq")), DICT_MIN_FREQ)


SQL_HAN_TEXT = sql_clean(f"translate(comment, '{HAN_FROM}', '{HAN_TO}')")
SQL_UNIT_COUNTS = f"""(SELECT u AS block, count(*) AS n, regexp_full_match(u, '{SQL_HAN}') AS han
  FROM (SELECT unnest(regexp_extract_all({SQL_HAN_TEXT}, '{SQL_HAN}|{SQL_OTHER}')) AS u FROM {SQL_REVIEWS} r) uu GROUP BY u)"""
SQL_DICT = f"(SELECT block AS word, CAST(n AS BIGINT) AS weight FROM units WHERE han AND n >= {DICT_MIN_FREQ})"
SQL_SEG_BASE = f"""
units AS MATERIALIZED (SELECT * FROM {SQL_UNIT_COUNTS} u0),
dict AS MATERIALIZED (SELECT * FROM {SQL_DICT} d0),
mx AS (SELECT max(length(word)) AS m FROM dict),
blocks AS (SELECT block, n FROM units WHERE han),
pos AS (SELECT block, n, unnest(range(0, length(block))) AS i FROM blocks),
cand AS (SELECT block, n, i, unnest(range(1, least((SELECT m FROM mx), length(block) - i) + 1)) AS l FROM pos),
hits AS MATERIALIZED (SELECT block, n, i, l, word, weight FROM cand JOIN dict ON substring(cand.block, cand.i + 1, cand.l) = dict.word)"""
# Pieces (block, n, piece) of the modes.
SQL_FULL = """
per AS (SELECT p.block, p.n, p.i, max(h.l) AS maxl FROM pos p
        LEFT JOIN hits h ON p.block = h.block AND p.i = h.i AND h.l >= 2 GROUP BY p.block, p.n, p.i),
w AS (SELECT *, coalesce(last_value(CASE WHEN maxl IS NOT NULL THEN i + maxl - 1 END IGNORE NULLS)
        OVER (PARTITION BY block ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS old FROM per),
pieces AS (SELECT block, n, substring(block, i + 1, l) AS piece FROM hits WHERE l >= 2
           UNION ALL SELECT block, n, substring(block, i + 1, 1) FROM w WHERE maxl IS NULL AND i > old)"""
# Best path from the last character to the first: each step adds one position's best (log probability in 10^-9, end); of equal
# ones the later end. ``p`` and ``e`` hold the positions done so far, the latest first.
SQL_EXACT = """
total AS (SELECT ln(CAST(sum(weight) AS DOUBLE)) AS t FROM dict),
options AS MATERIALIZED (SELECT block, i, list({'l': l, 'w': CAST(round((ln(CAST(weight AS DOUBLE)) - (SELECT t FROM total)) * 1e9) AS BIGINT)} ORDER BY l) AS o
            FROM hits GROUP BY block, i),
walk(block, n, i, p, e) AS (
  SELECT block, n, length(block), [0::BIGINT], []::BIGINT[] FROM blocks
  UNION ALL
  SELECT block, n, i - 1, list_prepend(best.p, p), list_prepend(best.l, e) FROM (
    SELECT s.block, s.n, s.i, s.p, s.e, list_max(list_transform(
             coalesce(o.o, [{'l': 1::BIGINT, 'w': CAST(round((0.0::DOUBLE - (SELECT t FROM total)) * 1e9) AS BIGINT)}]),
             lambda x: {'p': x.w + s.p[x.l], 'l': x.l})) AS best
    FROM walk s LEFT JOIN options o ON o.block = s.block AND o.i = s.i - 1 WHERE s.i > 0) step),
paths AS (SELECT block, n, e FROM walk WHERE i = 0),
cut(block, n, e, i) AS (
  SELECT block, n, e, 0::BIGINT FROM paths UNION ALL SELECT block, n, e, i + e[i + 1] FROM cut WHERE i + e[i + 1] < length(block)),
exact AS MATERIALIZED (SELECT block, n, i, substring(block, i + 1, e[i + 1]) AS piece FROM cut)"""


def _sql_words(parts: str, pieces: str) -> str:
    return f"""
WITH RECURSIVE {SQL_SEG_BASE},{parts}
SELECT piece, CAST(sum(n) AS BIGINT) AS freq FROM (
  SELECT piece, n FROM {pieces} UNION ALL SELECT block, n FROM units WHERE NOT han) x GROUP BY piece"""


SQL_SEARCH = SQL_EXACT + """,
grams AS (SELECT block, n, piece, g, unnest(range(0, length(piece) - g + 1)) AS off
          FROM exact, (VALUES (2), (3)) v(g) WHERE length(piece) > g),
searched AS (SELECT n, piece FROM exact
             UNION ALL SELECT n, substring(piece, off + 1, g) FROM grams JOIN dict ON substring(piece, off + 1, g) = word)"""


def _segmented(spark, d, mode):
    from reviewkit.operators.segment import pieces_of_units
    units = han_units(cleaned_docs(spark, d))
    return pieces_of_units(units, block_dictionary(units), mode)


@register("t8_full_mode", _sql_words(SQL_FULL, "pieces"))
def t8_full_mode(spark, d):
    """Full-mode segmentation of the mixed-script corpus, then word counts."""
    return _segmented(spark, d, "full")


@register("t7_exact_mode", _sql_words(SQL_EXACT, "exact"))
def t7_exact_mode(spark, d):
    """Exact-mode (best path) segmentation of the corpus, word counts."""
    return _segmented(spark, d, "exact")


@register("t9_search_mode", _sql_words(SQL_SEARCH, "searched"))
def t9_search_mode(spark, d):
    """Search-mode segmentation of the corpus, word counts."""
    return _segmented(spark, d, "search")


@register("t7_exact_rows", f"""
WITH RECURSIVE {SQL_SEG_BASE},{SQL_EXACT},
parts AS (SELECT block, list(piece ORDER BY i) AS pieces FROM exact GROUP BY block),
rows AS (SELECT source, review_id, regexp_extract_all({SQL_HAN_TEXT}, '{SQL_HAN}|{SQL_OTHER}') AS us FROM {SQL_REVIEWS} r),
long AS (SELECT source, review_id, unnest(us) AS u, generate_subscripts(us, 1) AS k FROM rows),
text AS (SELECT source, review_id, string_agg(coalesce(array_to_string(pieces, ' '), u), ' ' ORDER BY k) AS t,
                sum(coalesce(len(pieces), 1)) AS c FROM long LEFT JOIN parts ON u = block GROUP BY source, review_id)
SELECT source, review_id, CAST(coalesce(c, 0) AS INTEGER) AS n_tokens, coalesce(t, '') AS tokens_text
FROM rows LEFT JOIN text USING (source, review_id)
""")
def t7_exact_rows(spark, d):
    """T7 per review: token arrays in text order."""
    from reviewkit.operators.segment import segment_rows
    docs = cleaned_docs(spark, d)
    seg = segment_rows(docs, KEY, "text", block_dictionary(han_units(docs)), "exact")
    return seg.select(*KEY, F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens_text"))


@register("j5_dictionary_hits", f"""
WITH {SQL_SEG_BASE} SELECT word, CAST(sum(n) AS BIGINT) AS occurrences FROM hits GROUP BY word
""")
def j5_dictionary_hits(spark, d):
    """Occurrences of each dictionary word as a substring of corpus blocks."""
    from reviewkit.operators.segment import HAN_RE, dictionary_hits
    units = han_units(cleaned_docs(spark, d))
    hits = dictionary_hits(units.where(F.col("block").rlike(f"^{HAN_RE}$")), block_dictionary(units), 1)
    return hits.groupBy(F.substring("block", F.col("i") + 1, F.col("l")).alias("word")) \
        .agg(F.sum("n").cast("long").alias("occurrences"))


@register("t10_dictionary", f"""
WITH base AS (SELECT token AS word, CAST(count(*) AS BIGINT) AS weight
  FROM (SELECT unnest({sql_tokens('text', 'full', None)}) AS token FROM documents) t GROUP BY token HAVING count(*) >= {DICT_MIN_FREQ}),
usr AS (SELECT token AS word, CAST(count(*) AS BIGINT) AS weight
        FROM (SELECT unnest({sql_tokens('text', 'full', None)}) AS token FROM benchmark) t GROUP BY token),
u AS (SELECT word, weight, 0 AS ld FROM base UNION ALL SELECT word, weight, 1 AS ld FROM usr)
SELECT word, CAST(arg_max(weight, ld) AS BIGINT) AS weight FROM u
WHERE NOT list_contains({SQL_STOP}, word) GROUP BY word
""")
def t10_dictionary(spark, d):
    """Base dictionary, then a user dictionary load (later wins), then deletions."""
    from reviewkit.operators.segment import delete_words, dictionary_from_counts, load_user_dictionary
    from reviewkit.operators.tokens import tokenize
    from reviewkit.operators.vocab import word_counts
    from reviewkit.sources.stopwords import stopword_table
    base = dictionary_from_counts(word_counts(tokenize(driver.reviews_a(spark, d))), DICT_MIN_FREQ)
    usr = word_counts(tokenize(driver.reviews_b(spark, d))).select(F.col("token").alias("word"), F.col("freq").alias("weight"))
    return delete_words(load_user_dictionary(base, usr), stopword_table(spark, STOP))


# ---------------------------------------------------------------- flagship A5
# Stop words of the mapped corpus, as the two lists of the job: one compared with the lower-cased word, one exactly.

def mapped(words):
    return [w.translate(str.maketrans(HAN_FROM, HAN_TO)) for w in words]


STOP_CI, STOP_EXACT = mapped(STOP[:60]) + ["The", "NBA"], mapped(STOP[60:])


def _sql_flagship(min_count: int) -> str:
    return f"""
WITH RECURSIVE {SQL_SEG_BASE},{SQL_FULL},
words AS (SELECT piece, CAST(sum(n) AS BIGINT) AS freq FROM (
  SELECT piece, n FROM pieces UNION ALL SELECT block, n FROM units WHERE NOT han) x GROUP BY piece)
SELECT piece AS token, freq FROM words WHERE NOT list_contains({sql_list(STOP_CI)}, lower(piece))
  AND NOT list_contains({sql_list(STOP_EXACT)}, piece) AND freq >= {min_count}"""


def _flagship(spark, d, min_count):
    from reviewkit.plans.high_frequency import cleaned_units, high_frequency_job
    units = cleaned_units(reviews(spark, d).select(F.translate("comment", HAN_FROM, HAN_TO).alias("comment")))
    return high_frequency_job(units, block_dictionary(units), STOP_CI, STOP_EXACT, min_count)


@register("a5_high_frequency_words", _sql_flagship(1000))
def a5_high_frequency_words(spark, d):
    """Both sources: clean, segment in full mode, drop both stop lists, count, keep words seen 1,000 times."""
    return _flagship(spark, d, 1000)


@register("a5_frequent_words", _sql_flagship(20))
def a5_frequent_words(spark, d):
    """The same job at a threshold of 20."""
    return _flagship(spark, d, 20)


@register("u1_python_tokenizer", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{NON_SPACE_RE}+')) AS INTEGER) AS n_tokens FROM documents
""")
def u1_python_tokenizer(spark, d):
    """A caller's tokenizer as a column expression (runs without white space)."""
    from reviewkit.operators.tokens import tokenize
    docs = driver.reviews_a(spark, d)
    t = tokenize(docs, profile="none", tokenizer=lambda c: F.regexp_extract_all(c, F.lit(f"{NON_SPACE_RE}+"), 0))
    return t.select(F.col("review_id").alias("doc_id"), F.size("tokens").alias("n_tokens"))


# ---------------------------------------------------------------- classifier M1-M4, S8, X1
# Labels: labels.quality joined to documents; split 90/10 by E6 (seed 42) over the labelled ids.

def labelled_split(spark, d):
    """The split is marked on the ids alone; the text is joined once."""
    from reviewkit.operators.sampling import exact_split
    lab = driver.table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = driver.table(spark, d, "documents").select("doc_id", F.col("text").alias("comment"))
    return exact_split(lab, "doc_id", SEED, 0.9).join(docs, "doc_id")


SQL_LABELLED_SPLIT = f"""(SELECT d.doc_id, d.text, l.quality AS label, CASE WHEN row_number() OVER (
    ORDER BY {SQL_HASH.format(seed=SEED, id='l.doc_id')}, CAST(l.doc_id AS VARCHAR)) <= floor(CAST(count(*) OVER () AS DOUBLE) * 0.9)
    THEN 'train' ELSE 'valid' END AS split FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""
_MODELS: dict[tuple[str, str], str] = {}


def saved_model(spark, d):
    """The fitted model, trained once for an application and table folder, saved in the shared folder and loaded."""
    from reviewkit.plans.model import load_model, save_model, train
    from reviewkit.session import scratch_path
    key = (spark.sparkContext.applicationId, d)
    if key not in _MODELS:
        path = scratch_path(spark, "model")
        save_model(train(labelled_split(spark, d).where("split = 'train'"), STOP), path)
        _MODELS[key] = path
    return load_model(_MODELS[key])


@register("m1_train")
def m1_train(spark, d):
    """M1: fit clean -> tokens -> hashed counts -> multinomial LR; one row per class."""
    from reviewkit.plans.model import train
    lr = train(labelled_split(spark, d).where("split = 'train'"), STOP).stages[-1]
    coef = lr.coefficientMatrix.toArray()
    rows = [(k, float(lr.interceptVector[k]), int((coef[k] != 0).sum())) for k in range(coef.shape[0])]
    return spark.createDataFrame(rows, "class int, intercept double, nonzero_weights int")


@register("m1_features", f"""
SELECT doc_id, split, label, CAST(len(tokens) AS BIGINT) AS n_terms
FROM (SELECT doc_id, split, label, {sql_tokens('text')} AS tokens FROM {SQL_LABELLED_SPLIT} s) t
""")
def m1_features(spark, d):
    """M1's input: the split, and the number of terms in each labelled document's feature vector."""
    from pyspark.ml.functions import vector_to_array
    from reviewkit.plans.model import feature_vectors
    v = feature_vectors(labelled_split(spark, d), STOP, ("doc_id", "split", "label"), num_features=1024)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return v.select("doc_id", "split", "label", total.cast("long").alias("n_terms"))


def _score_checks(scored, keys):
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    best = (F.array_position("scores", F.array_max("scores")) - 1).cast("int")
    return scored.select(*keys, F.size("scores").alias("n_scores"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
                         (best == F.col("prediction")).alias("is_argmax"))


@register("m1_mean_embedding", """
SELECT d.doc_id, CAST(2 AS INTEGER) AS n_scores, true AS sums_to_one, true AS is_argmax
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""")
def m1_mean_embedding(spark, d):
    """M1 with learned mean embeddings: fitted on the training rows, every labelled document scored."""
    from reviewkit.plans.model import embedding_pipeline, score, train
    data = labelled_split(spark, d)
    model = train(data.where("split = 'train'"), STOP, pipeline=embedding_pipeline, num_features=1 << 10, dim=16, max_iter=20)
    return _score_checks(score(model, data, keep=("doc_id",)), ["doc_id"])


@register("m2_score")
def m2_score(spark, d):
    """M2: score every document with the saved pipeline."""
    from reviewkit.plans.model import score
    docs = driver.table(spark, d, "documents").select("doc_id", F.col("text").alias("comment"))
    return score(saved_model(spark, d), docs, keep=("doc_id",))


@register("m2_score_checks", """
SELECT doc_id, CAST(2 AS INTEGER) AS n_scores, true AS sums_to_one, true AS is_argmax FROM documents
""")
def m2_score_checks(spark, d):
    """M2's exact part: every document is scored, its two probabilities sum to 1, the prediction is their argmax."""
    return _score_checks(m2_score(spark, d), ["doc_id"])


@register("m3_evaluate")
def m3_evaluate(spark, d):
    """M3: accuracy, loss and the class report of the validation rows."""
    from reviewkit.plans.model import evaluate
    return evaluate(saved_model(spark, d), labelled_split(spark, d).where("split = 'valid'"))


@register("m3_support", f"""
SELECT CAST(label AS INTEGER) AS class, CAST(count(*) AS BIGINT) AS support,
       CAST(sum(count(*)) OVER () AS BIGINT) AS n_rows FROM {SQL_LABELLED_SPLIT} s WHERE split = 'valid' GROUP BY label
""")
def m3_support(spark, d):
    """M3's exact part: held-out rows in all and of each class."""
    return m3_evaluate(spark, d).where("support > 0").select("class", "support", "n_rows")


@register("m4_select", """
SELECT CAST(3 AS BIGINT) AS candidates, CAST(1 AS BIGINT) AS best, true AS best_is_highest FROM (SELECT count(*) FROM labels)
""")
def m4_select(spark, d):
    """M4: regParam chosen by validation accuracy: one of the candidates is the best, and none is above it."""
    from reviewkit.plans.model import select_model
    _, table = select_model(labelled_split(spark, d).where("split = 'train'"), STOP, num_features=1 << 14, max_iter=20)
    return table.agg(F.count(F.lit(1)).alias("candidates"), F.count_if("is_best").cast("long").alias("best"),
                     (F.max(F.when(F.col("is_best"), F.col("accuracy"))) == F.max("accuracy")).alias("best_is_highest"))


@register("x1_stream_score", """
SELECT conv_id, turn, CAST(2 AS INTEGER) AS n_scores, true AS sums_to_one, true AS is_argmax, true AS equals_batch FROM conversations
""")
def x1_stream_score(spark, d):
    """Conversation turns arrive as parquet files and are scored by a stream; compared with M2 in batch."""
    import os

    from reviewkit.plans.model import score
    from reviewkit.session import scratch_path
    from reviewkit.streaming.score import read_sink, run_to_end, score_stream
    model = saved_model(spark, d)
    base = scratch_path(spark, "x1")
    src = os.path.join(base, "in")
    conv = driver.table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("comment"))
    conv.write.parquet(src)
    q = score_stream(spark, model, src, "conv_id long, turn long, comment string",
                     os.path.join(base, "out"), os.path.join(base, "ckpt"), keep=("conv_id", "turn"))
    run_to_end(q)
    streamed = read_sink(spark, os.path.join(base, "out"))
    batch = score(model, conv, keep=("conv_id", "turn")).select(
        "conv_id", "turn", F.col("scores").alias("b"), F.col("prediction").alias("bp"))
    same = F.coalesce((F.col("b") == F.col("scores")) & (F.col("bp") == F.col("prediction")), F.lit(False))
    return _score_checks(streamed.join(batch, ["conv_id", "turn"], "full_outer"), ["conv_id", "turn", same.alias("equals_batch")])


# ---------------------------------------------------------------- naive Bayes on the three star classes M1-M3, S8

BAYES_CLASSES = 3


def bayes_rows(spark, d):
    """Tokens of both sources with T14's class and E7's split, stored."""
    from reviewkit.functions.labels import sentiment
    from reviewkit.operators.joins import materialize
    from reviewkit.operators.sampling import approx_split
    rows = doc_tokens(spark, d).select(*KEY, sentiment(F.col("star")).alias("label"), "tokens")
    return materialize(approx_split(rows, KEY, SEED, 0.9))


def bayes_model(spark, d, rows):
    """M1 on the training rows, saved and loaded."""
    from reviewkit.plans.bayes import load_bayes, train_bayes
    from reviewkit.session import scratch_path
    path = scratch_path(spark, "bayes")
    train_bayes(rows.where("split = 'train'"), BAYES_CLASSES).save(path)
    return load_bayes(spark, path)


SQL_BAYES = f"""
rows AS MATERIALIZED (SELECT source, review_id, {sql_sentiment('star')} AS label, tokens,
  CASE WHEN CAST(('0x' || substr({SQL_HASH.format(seed=SEED, id=SQL_KEY_TEXT)}, 1, 8))::BIGINT AS DOUBLE)
            / 4294967296.0 < 0.9 THEN 'train' ELSE 'valid' END AS split FROM {SQL_DOC_TOK} t),
seen AS (SELECT label, unnest(tokens) AS token FROM rows WHERE split = 'train'),
counted AS MATERIALIZED (SELECT token, count(*) FILTER (label = 0) AS n_0, count(*) FILTER (label = 1) AS n_1,
                                count(*) FILTER (label = 2) AS n_2 FROM seen GROUP BY token),
sums AS (SELECT count(*) AS v, sum(n_0) AS t_0, sum(n_1) AS t_1, sum(n_2) AS t_2 FROM counted),
model AS MATERIALIZED (SELECT token, n_0, n_1, n_2, ln((n_0 + 1.0::DOUBLE) / (t_0 + 1.0::DOUBLE * v)) AS l_0,
  ln((n_1 + 1.0::DOUBLE) / (t_1 + 1.0::DOUBLE * v)) AS l_1, ln((n_2 + 1.0::DOUBLE) / (t_2 + 1.0::DOUBLE * v)) AS l_2 FROM counted, sums),
classes AS (SELECT CAST(c.range AS INTEGER) AS class, count(r.label) AS n_rows,
  ln((count(r.label) + 1.0::DOUBLE) / ((SELECT count(*) FROM rows WHERE split = 'train') + 3.0::DOUBLE)) AS log_prior
  FROM range(3) c LEFT JOIN (SELECT label FROM rows WHERE split = 'train') r ON r.label = c.range GROUP BY 1),
priors AS (SELECT max(log_prior) FILTER (class = 0) AS p_0, max(log_prior) FILTER (class = 1) AS p_1,
                  max(log_prior) FILTER (class = 2) AS p_2 FROM classes),
used AS (SELECT source, review_id, unnest(tokens) AS token FROM rows),
sums_of AS (SELECT source, review_id, sum(l_0) AS x_0, sum(l_1) AS x_1, sum(l_2) AS x_2 FROM used JOIN model USING (token) GROUP BY ALL),
scored AS (SELECT source, review_id, label, split, coalesce(x_0, 0) + p_0 AS s_0, coalesce(x_1, 0) + p_1 AS s_1, coalesce(x_2, 0) + p_2 AS s_2
           FROM rows LEFT JOIN sums_of USING (source, review_id), priors),
predicted AS (SELECT *, CASE WHEN s_0 >= s_1 AND s_0 >= s_2 THEN 0 WHEN s_1 >= s_2 THEN 1 ELSE 2 END AS pred FROM scored)"""


@register("m1_bayes_tokens", f"""
WITH {SQL_BAYES}
SELECT token, n_0, n_1, n_2, round(l_0, 6) AS l_0, round(l_1, 6) AS l_1, round(l_2, 6) AS l_2 FROM model
""")
def m1_bayes_tokens(spark, d):
    """M1: each token's counts and log likelihoods in the three classes."""
    t = bayes_model(spark, d, bayes_rows(spark, d)).tokens
    return t.select("token", *[F.get("counts", k).alias(f"n_{k}") for k in range(BAYES_CLASSES)],
                    *[F.round(F.get("log_likelihood", k), 6).alias(f"l_{k}") for k in range(BAYES_CLASSES)])


@register("m1_bayes_classes", f"""
WITH {SQL_BAYES}
SELECT class, CAST(n_rows AS BIGINT) AS n_rows, CAST(CASE class WHEN 0 THEN t_0 WHEN 1 THEN t_1 ELSE t_2 END AS BIGINT) AS n_tokens,
       CAST(v AS BIGINT) AS vocabulary, round(log_prior, 6) AS log_prior FROM classes, sums
""")
def m1_bayes_classes(spark, d):
    """M1: rows, tokens, vocabulary and log prior of the three classes."""
    c = bayes_model(spark, d, bayes_rows(spark, d)).classes
    return c.withColumn("log_prior", F.round("log_prior", 6))


@register("m2_bayes_score", f"""
WITH {SQL_BAYES}
SELECT source, review_id, split, round(s_0, 3) AS s_0, round(s_1, 3) AS s_1, round(s_2, 3) AS s_2, CAST(pred AS INTEGER) AS prediction FROM predicted
""")
def m2_bayes_score(spark, d):
    """M2: every review scored by the loaded model."""
    from reviewkit.plans.bayes import score_bayes
    rows = bayes_rows(spark, d)
    s = score_bayes(bayes_model(spark, d, rows), rows, KEY, ("split",))
    return s.select(*KEY, "split", *[F.round(F.get("scores", k), 3).alias(f"s_{k}") for k in range(BAYES_CLASSES)], "prediction")


@register("m3_bayes_evaluate", f"""
WITH {SQL_BAYES},
v AS (SELECT label, pred, greatest(s_0, s_1, s_2) AS m, s_0, s_1, s_2 FROM predicted WHERE split = 'valid'),
whole AS (SELECT round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(avg(m + ln(exp(s_0 - m) + exp(s_1 - m) + exp(s_2 - m)) - CASE label WHEN 0 THEN s_0 WHEN 1 THEN s_1 ELSE s_2 END), 6) AS log_loss,
  count(*) AS n_rows FROM v),
conf AS (SELECT label, pred, count(*) AS n FROM v GROUP BY 1, 2),
per AS (SELECT cls, sum(tp) AS tp, sum(n) AS support, sum(pn) AS predicted FROM (
          SELECT label AS cls, n, CASE WHEN label = pred THEN n ELSE 0 END AS tp, 0 AS pn FROM conf
          UNION ALL SELECT pred AS cls, 0 AS n, 0 AS tp, n AS pn FROM conf) u GROUP BY cls),
pr AS (SELECT cls, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM per)
SELECT CAST(cls AS INTEGER) AS class, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1, CAST(support AS BIGINT) AS support,
       accuracy, log_loss, CAST(n_rows AS BIGINT) AS n_rows FROM pr, whole
""")
def m3_bayes_evaluate(spark, d):
    """M3: accuracy, loss and class report of the held-out reviews."""
    from reviewkit.plans.bayes import evaluate_bayes
    rows = bayes_rows(spark, d)
    return evaluate_bayes(bayes_model(spark, d, rows), rows.where("split = 'valid'"), KEY)


# ---------------------------------------------------------------- features by vocabulary id M1, J2

@register("m1_vocab_features", f"""
WITH vocab AS MATERIALIZED (SELECT * FROM {sql_vocab(SQL_DOC_TOK, ENCODE_MIN_FREQ)} v0),
used AS (SELECT source, review_id, unnest(tokens) AS token FROM {SQL_DOC_TOK} t),
n AS (SELECT source, review_id, coalesce(token_id, 0) AS id, count(*) AS c FROM used LEFT JOIN vocab USING (token) GROUP BY ALL)
SELECT t.source, t.review_id, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS size,
       coalesce(string_agg(id || ':' || c, ',' ORDER BY id), '') AS features
FROM {SQL_DOC_TOK} t LEFT JOIN n ON n.source = t.source AND n.review_id = t.review_id GROUP BY t.source, t.review_id
""")
def m1_vocab_features(spark, d):
    """Sparse count vectors over the stored vocabulary, one slot for each of its ids."""
    from reviewkit.operators.encode import vocabulary_counts
    c = prepared(spark, d)
    v = vocabulary_counts(c.tokens, c.vocabulary, KEY)
    return v.select(*KEY, "size", F.array_join(F.zip_with("indices", "values", lambda i, x: F.concat_ws(
        ":", i.cast("string"), x.cast("long").cast("string"))), ",").alias("features"))


@register("m1_vocab_model", f"""
WITH vocab AS (SELECT * FROM {sql_vocab(SQL_DOC_TOK, ENCODE_MIN_FREQ)} v0)
SELECT CAST(3 AS INTEGER) AS classes, CAST((SELECT count(*) FROM vocab) AS BIGINT) AS n_features,
       CAST(count(*) AS BIGINT) AS n_rows FROM {SQL_REVIEWS} r
""")
def m1_vocab_model(spark, d):
    """M1: a multinomial classifier whose features are the vocabulary's ids; every review gets a prediction."""
    from reviewkit.operators.encode import vocabulary_vectors
    from reviewkit.plans.model import fit_vectors
    from reviewkit.functions.labels import sentiment
    c = prepared(spark, d)
    v = vocabulary_vectors(c.tokens.withColumn("label", sentiment(F.col("star"))), c.vocabulary, KEY, keep=("label",))
    model = fit_vectors(v, max_iter=5)
    scored = model.transform(v)
    return scored.agg(F.lit(model.numClasses).cast("int").alias("classes"), F.lit(model.numFeatures).cast("long").alias("n_features"),
                      F.count_if(F.col("prediction").isin(0.0, 1.0, 2.0)).cast("long").alias("n_rows"))


# ---------------------------------------------------------------- learned word vectors E10, M1

@register("e10_learned_vectors", f"""
SELECT source, review_id, CAST(least(len(tokens), {ENCODE_LEN}) AS INTEGER) AS n_valid, CAST(64 AS INTEGER) AS dim,
       true AS equals_model, true AS equals_padded FROM {SQL_DOC_TOK} t
""")
def e10_learned_vectors(spark, d):
    """E10 over learned word vectors, with and without pads, compared with the model's own mean of every review."""
    from reviewkit.operators.encode import mean_vectors
    from reviewkit.operators.joins import checked_broadcast
    from reviewkit.plans.vectors import model_means, train_word_vectors, vector_table
    c = prepared(spark, d)
    model = train_word_vectors(c.tokens, 64, ENCODE_MIN_FREQ, partitions=spark.sparkContext.defaultParallelism)
    vec = checked_broadcast(vector_table(model, c.vocabulary), materialized=True)
    ids = c.encoded(ENCODE_LEN)
    means = mean_vectors(ids, vec, KEY, include_pad=False)
    padded = mean_vectors(ids, vec, KEY).withColumnRenamed("mean_vec", "padded_vec")
    own = model_means(model, c.tokens, ENCODE_LEN).select(*KEY, F.size("tokens").alias("n_valid"), "model_vec")
    j = own.join(padded, list(KEY)).join(means, list(KEY), "left")

    def near(a, b):
        return F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) < 1e-6), lambda x: x)

    zeros = F.transform("model_vec", lambda x: F.lit(0.0))
    return j.select(*KEY, "n_valid", F.size("model_vec").alias("dim"), near(F.coalesce("mean_vec", zeros), "model_vec").alias("equals_model"),
                    near("padded_vec", F.transform("model_vec", lambda x: x * F.col("n_valid") / ENCODE_LEN)).alias("equals_padded"))


# ---------------------------------------------------------------- selection over folds M4, E8, S8

SELECT_FOLDS = 5


@register("m4_folds", f"""
WITH r AS (SELECT row_number() OVER (ORDER BY l.doc_id) AS rn, count(*) OVER () AS n FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
f AS (SELECT CAST(floor((rn - 1) / floor(n / {SELECT_FOLDS})) AS INTEGER) AS fold FROM r)
SELECT fold, CAST(count(*) AS BIGINT) AS n_rows, CAST(3 AS BIGINT) AS candidates, CAST(1 AS BIGINT) AS best, true AS best_is_highest,
       CAST(0 AS BIGINT) AS changed_by_saving FROM f WHERE fold < {SELECT_FOLDS} GROUP BY fold
""")
def m4_folds(spark, d):
    """M4: regParam by cross-validation over E8's folds; the best model is saved, loaded and scores like the fitted one."""
    from pyspark.ml.classification import LogisticRegressionModel
    from reviewkit.operators.encode import vocabulary_vectors
    from reviewkit.operators.joins import materialize
    from reviewkit.operators.tokens import tokenize
    from reviewkit.operators.vocab import build_vocabulary, word_counts
    from reviewkit.plans.model import save_model, select_by_folds
    from reviewkit.session import scratch_path, shuffles_dropped
    lab = driver.table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = driver.table(spark, d, "documents").select("doc_id", F.col("text").alias("comment"))
    with shuffles_dropped(spark):
        tokens = materialize(tokenize(docs.join(lab, "doc_id"), stopwords=STOP).drop("comment"))
        vectors = vocabulary_vectors(tokens, build_vocabulary(word_counts(tokens), ENCODE_MIN_FREQ), "doc_id", keep=("label",))
        best, table, folds = select_by_folds(vectors, "doc_id", SELECT_FOLDS)
    path = scratch_path(spark, "best")
    save_model(best, path)
    loaded = LogisticRegressionModel.load(path)
    a = best.transform(vectors).select("doc_id", F.col("probability").alias("p"), F.col("prediction").alias("q"))
    both = loaded.transform(vectors).join(a, "doc_id")
    changed = both.agg(F.count_if((F.col("p") != F.col("probability")) | (F.col("q") != F.col("prediction"))).cast("long").alias("changed_by_saving"))
    chosen = table.agg(F.count(F.lit(1)).alias("candidates"), F.count_if("is_best").cast("long").alias("best"),
                       (F.max(F.when(F.col("is_best"), F.col("accuracy"))) == F.max("accuracy")).alias("best_is_highest"))
    return folds.crossJoin(F.broadcast(chosen)).crossJoin(F.broadcast(changed))  # one row each


# ---------------------------------------------------------------- packed mini-batches E9

@register("e9_packed_batches", f"""
WITH e AS (SELECT source, review_id, e0.input_ids, {sql_sentiment('r.star')} AS label
           FROM {sql_encoded(ENCODE_LEN)} e0 JOIN {SQL_REVIEWS} r USING (source, review_id)),
p AS (SELECT *, row_number() OVER (ORDER BY {SQL_ORDER}) - 1 AS place FROM e)
SELECT CAST(floor(place / {BATCH}) AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS n_rows, CAST(sum(list_sum(input_ids)) AS BIGINT) AS id_sum,
       CAST(sum(list_sum(list_transform(input_ids, lambda x: CASE WHEN x = 1 THEN 0 ELSE 1 END))) AS BIGINT) AS n_valid,
       string_agg(label, ',' ORDER BY place) AS labels, string_agg(input_ids[1], ',' ORDER BY place) AS first_ids FROM p GROUP BY 1
""")
def e9_packed_batches(spark, d):
    """The encoded examples in shuffled batches of 128, a row per batch, written for a trainer and read again."""
    from reviewkit.functions.arrays import ids_text
    from reviewkit.operators.joins import materialize
    from reviewkit.operators.sampling import packed_batches
    b = materialize(packed_batches(prepared(spark, d).examples(ENCODE_LEN), KEY, BATCH, SEED))

    def total(col):
        return F.aggregate(F.flatten(col), F.lit(0).cast("long"), lambda a, x: a + x)

    return b.select("batch_id", "n_rows", total("input_ids").alias("id_sum"), total("attention_mask").alias("n_valid"), ids_text(F.col("labels")).alias("labels"),
                    ids_text(F.transform("input_ids", lambda x: F.get(x, F.lit(0)))).alias("first_ids"))


# ---------------------------------------------------------------- a stream that was stopped and restarted X1, S8

@register("x1_stream_recovered", """
SELECT conv_id, turn, CAST(count(*) AS BIGINT) AS times, true AS equals_batch FROM conversations GROUP BY conv_id, turn
""")
def x1_stream_recovered(spark, d):
    """The scoring stream fails after its second batch was written, is restarted, and gives each turn once, as the batch does."""
    import os

    from pyspark.errors import StreamingQueryException
    from reviewkit.plans.model import score
    from reviewkit.session import scratch_path
    from reviewkit.streaming.score import read_sink, run_to_end, score_stream_by_batch
    model = saved_model(spark, d)
    base = scratch_path(spark, "x1-recovered")
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    conv = driver.table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("comment"))
    conv.repartition(4, "conv_id", "turn").write.parquet(src)

    def fail(batch):
        if batch == 1:
            raise RuntimeError("stopped after a batch was written")

    def start(after):
        return score_stream_by_batch(spark, model, src, "conv_id long, turn long, comment string", out, ckpt, ("conv_id", "turn"), 1, after)

    try:
        run_to_end(start(fail))
    except StreamingQueryException:
        pass
    run_to_end(start(None))
    streamed = read_sink(spark, out).groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("scores", "prediction")).alias("s"), F.max(F.struct("scores", "prediction")).alias("t"))
    batch = score(model, conv, keep=("conv_id", "turn")).groupBy("conv_id", "turn").agg(F.min(F.struct("scores", "prediction")).alias("b"))
    same = F.coalesce((F.col("s") == F.col("b")) & (F.col("s") == F.col("t")), F.lit(False))
    return streamed.join(batch, ["conv_id", "turn"], "full_outer").select("conv_id", "turn", "times", same.alias("equals_batch"))
