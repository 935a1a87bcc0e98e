"""S1 as a splittable scan: equal to the multi-line scan wherever the splits fall."""

import os

import pytest
from pyspark.sql import functions as F

from reviewkit.sources import csv_split as C
from reviewkit.sources import reviews_csv as R

from test_sources import F3, SCHEMA, _write

TEXTS = ['plain', 'a ""q"", b', 'two\nlines', '\n\nblank lines\n\n', 'ends with a break\n', '""', ',', 'a,b\n"",""\nc', '', 'é "" 不\n', ' x ',
         'crlf\r\nin quotes', 'None']


@pytest.fixture()
def small_splits(spark):
    """Splits of 64 bytes, so that they begin inside quotes, fields and empty lines."""
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _dump(n):
    return "ID,Username,Star,Comment\n" + "".join(f'{i},"u{i}",{1 + i % 5},"{TEXTS[i % len(TEXTS)]}"\n' for i in range(n))


def _rows(df):
    return sorted(map(str, df.collect()))


def test_equals_the_multi_line_scan(spark, tmp_dir, small_splits):
    paths = [_write(tmp_dir, "a.csv", _dump(150)), _write(tmp_dir, "b.csv", F3), _write(tmp_dir, "c.csv", _dump(40))]
    for na in (True, False):
        want = R.read_reviews_csv(spark, paths, SCHEMA, pandas_na=na)
        got = C.read_reviews_split(spark, paths, SCHEMA, pandas_na=na)
        assert got.columns == want.columns
        assert _rows(got) == _rows(want)
    assert spark.read.text(paths[0]).rdd.getNumPartitions() > 20


def test_splits_start_in_either_state(spark, tmp_dir, small_splits):
    path = _write(tmp_dir, "a.csv", _dump(60))
    states = C._split_states(C._numbered_lines(spark, [path])).collect()
    assert len(states) > 10 and {r.state for r in states} == {0, 1}


def test_crlf_file_and_a_record_over_many_splits(spark, tmp_dir, small_splits):
    long = "word \n" * 200
    text = f'ID,Username,Star,Comment\r\n0,u,1,"{long}"\r\n\r\n1,"v",2,end\r\n'
    path = os.path.join(tmp_dir, "crlf.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    got = {r.ID: r.Comment for r in C.read_reviews_split(spark, path, SCHEMA).collect()}
    assert got == {0: long, 1: "end"}


def test_corrupt_records_and_no_rows(spark, tmp_dir):
    text = "ID,Username,Star,Comment\n0,u,5,fine\nx,u,notastar,broken\n2,u,3,fine,one,too,many\n"
    read = C.read_reviews_split(spark, _write(tmp_dir, "bad.csv", text), SCHEMA, keep_corrupt=True)
    r = R.corrupt_records(read).first()
    assert (r.n_rows, r.n_corrupt) == (3, 2)
    only = _write(tmp_dir, "header.csv", "ID,Username,Star,Comment\n")
    assert C.read_reviews_split(spark, [only, _write(tmp_dir, "none.csv", "")], SCHEMA).collect() == []


def test_bare_quotes_do_not_shift_the_rest(spark, tmp_dir, small_splits):
    odd = ['5" disk', 'say "hi', 'a "b" c', '"closed"rest', '"two\nlines ""and"" more"', 'x"', '" x"', '"a" b,c"']
    text = "ID,Username,Star,Comment\n" + "".join(f"{i},u,{1 + i % 5},{odd[i * 5 % len(odd)]}\n" for i in range(80))
    path = _write(tmp_dir, "bare.csv", text)
    assert _rows(C.read_reviews_split(spark, path, SCHEMA)) == _rows(R.read_reviews_csv(spark, path, SCHEMA))


def test_line_states_against_a_walk(spark):
    """Every line of up to five characters, from both states, against a walk over its characters."""
    import itertools
    lines = ["".join(c) for n in range(6) for c in itertools.product('",a', repeat=n)]

    def walk(line, inside):
        fresh, at = not inside, 0
        while at < len(line):
            c = line[at]
            if inside:
                if c == '"' and line[at + 1:at + 2] == '"':
                    at += 1
                elif c == '"':
                    inside = False
            elif c == '"' and fresh:
                inside = True
            fresh = not inside and c == ","
            at += 1
        return int(inside)

    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = df.select("line", C._ends_inside(F.col("line")).alias("o"), C._ends_inside(F.concat(F.lit('"'), "line")).alias("i")).collect()
    assert [(r.line, r.o, r.i) for r in got] == [(x, walk(x, False), walk(x, True)) for x in lines]


def test_very_long_line(spark, tmp_dir):
    text = "ID,Username,Star,Comment\n0,u,5,\"" + '"",\n x' * 200_000 + "\"\n1,v,4," + "y" * 1_000_000 + "\n"
    got = {r.ID: len(r.Comment) for r in C.read_reviews_split(spark, _write(tmp_dir, "long.csv", text), SCHEMA).collect()}
    assert got == {0: 5 * 200_000, 1: 1_000_000}


def test_one_task_a_split_and_no_python(spark, tmp_dir, small_splits):
    df = C.read_reviews_split(spark, _write(tmp_dir, "a.csv", _dump(30)), SCHEMA).agg(F.count("Comment"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
