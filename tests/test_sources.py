"""CSV parsing (F3), stop lists (F4), chunks, vocabulary, word list, model files."""

import os

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from reviewkit.sources import reviews_csv as R
from reviewkit.sources.chunks import read_token_chunks, write_token_chunks
from reviewkit.sources.stopwords import read_stopword_files

F3 = ('ID,Username,Star,Comment\n'
      '0,u,5,"a ""q"", b\nline2"\n'
      '1,NA,3,NA\n'
      '2,,2,\n'
      '3,x,1,""\n'
      '4,y,4,None\n'
      '5,z,2,null\n'
      '6,w,3,back\\"x\n'
      '7,v,1,"ends \\"\n'
      '8,k,2,  sp  \n')
SCHEMA = StructType([StructField("ID", LongType()), StructField("Username", StringType()),
                     StructField("Star", IntegerType()), StructField("Comment", StringType())])


def _write(tmp_dir, name, text):
    p = os.path.join(tmp_dir, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_csv_pandas_na(spark, tmp_dir):
    p = _write(tmp_dir, "a.csv", F3)
    got = {r.ID: r.Comment for r in R.read_reviews_csv(spark, p, SCHEMA).collect()}
    assert got[0] == 'a "q", b\nline2'
    for i in range(1, 6):
        assert got[i] is None, i
    assert got[6] == 'back\\"x' and got[7] == 'ends \\' and got[8] == '  sp  '


def test_csv_spark_na(spark, tmp_dir):
    p = _write(tmp_dir, "a.csv", F3)
    got = {r.ID: r.Comment for r in R.read_reviews_csv(spark, p, SCHEMA, pandas_na=False).collect()}
    assert got[1] == "NA" and got[4] == "None" and got[5] == "null"
    assert got[2] is None and got[3] is None


def test_working_table_and_first_rows(spark, tmp_dir):
    a = R.read_reviews_csv(spark, _write(tmp_dir, "a.csv", F3), SCHEMA)
    b = R.read_reviews_csv(spark, _write(tmp_dir, "b.csv", F3), SCHEMA)
    w = R.working_table({"A": a, "B": b})
    assert w.count() == 8  # rows 0, 6, 7, 8 from each dump
    d = R.working_table({"A": a, "B": b}, dedup=True)
    assert sorted((r.source, r.review_id) for r in d.collect()) == [("A", 0), ("A", 6), ("A", 7), ("A", 8)]
    assert [r.ID for r in R.first_rows(a, 3).collect()] == [0, 1, 2]


def test_stopword_files(spark, tmp_dir):
    p1 = _write(tmp_dir, "s1.txt", "the\n of \n\nthe\n")
    p2 = _write(tmp_dir, "s2.txt", "of\n不\n")
    got = {r.word for r in read_stopword_files(spark, [p1, p2]).collect()}
    assert got == {"the", "of", "", "不"}
    kept = {r.word for r in read_stopword_files(spark, [p1, p2], keep=["不"]).collect()}
    assert kept == {"the", "of", ""}


def test_chunks_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(i, ["a", "b'\"", "é"][: i % 4], 1 + i % 5) for i in range(25)],
                               "review_id long, tokens array<string>, star int")
    path = os.path.join(tmp_dir, "chunks")
    write_token_chunks(df, path, "review_id", chunk_rows=10)
    back = read_token_chunks(spark, path)
    rows = {r.review_id: (r.chunk, list(r.tokens), r.star) for r in back.collect()}
    assert len(rows) == 25
    assert rows[0][0] == 0 and rows[10][0] == 10 and rows[24][0] == 20
    assert all(rows[i][1] == ["a", "b'\"", "é"][: i % 4] for i in range(25))
    assert sorted(x for x in os.listdir(path) if x.startswith("chunk=")) == ["chunk=0", "chunk=10", "chunk=20"]


def test_vocab_save_load_and_word_list(spark, tmp_dir):
    from reviewkit.operators.vocab import (build_vocabulary, load_vocabulary, save_vocabulary,
                                           word_counts, write_word_list)
    df = spark.createDataFrame([(["b", "a", "b"],), (["c", "a", "<pad>"],), ([],)], "tokens array<string>")
    v = build_vocabulary(word_counts(df), 1)
    p = os.path.join(tmp_dir, "vocab")
    save_vocabulary(v, p, min_freq=1)
    back = load_vocabulary(spark, p)
    assert sorted((r.token, r.token_id) for r in back.collect()) == \
        [("<pad>", 1), ("<unk>", 0), ("a", 2), ("b", 3), ("c", 4)]
    assert back.schema["token"].metadata == {"min_freq": 1}
    wl = os.path.join(tmp_dir, "words")
    write_word_list(word_counts(df), wl)
    lines = spark.read.text(wl).collect()
    assert [r.value for r in lines] == ["a", "b", "<pad>", "c"]


def test_first_source_wins_whatever_its_name(spark):
    rows = [(1, "u", 5, "same")]
    frame = lambda: spark.createDataFrame(rows, SCHEMA)
    kept = R.working_table({"2M": frame(), "10M": frame()}, dedup=True).collect()
    assert [(r.source, r.review_id) for r in kept] == [("2M", 1)]
    assert R.working_table({"2M": frame()}).columns == ["source", "review_id", "comment", "star"]


def test_corrupt_records_are_counted(spark, tmp_dir):
    text = "ID,Username,Star,Comment\n0,u,5,fine\nx,u,notastar,broken\n2,u,3,fine,one,too,many\n"
    read = R.read_reviews_csv(spark, _write(tmp_dir, "bad.csv", text), SCHEMA, keep_corrupt=True)
    r = R.corrupt_records(read).first()
    assert (r.n_rows, r.n_corrupt) == (3, 2)


def test_word_list_keeps_its_order(spark, tmp_dir):
    from reviewkit.operators.vocab import read_word_list, write_word_list
    words = spark.createDataFrame([(f"w{i:04d}", 5000 - i // 3) for i in range(3000)], "token string, freq long").repartition(7)
    path = os.path.join(tmp_dir, "words")
    write_word_list(words, path)
    got = [r.token for r in read_word_list(spark, path).orderBy("line").collect()]
    assert got == [f"w{i:04d}" for i in range(3000)]
