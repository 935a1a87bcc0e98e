"""Physical-plan shape of headline queries (what .explain shows)."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(p, key):
    return len(re.findall(r"Exchange hashpartitioning\(" + key, p))


def test_word_count_prunes_and_shuffles_once(spark):
    p = plan(E.queries()["a4_word_count"](spark, SF))
    # only the text is read from each source
    assert re.findall(r"ReadSchema: (struct<[^>]*>)", p) == ["struct<text:string>"] * 2
    # one shuffle on the token (partial count before it), none of the texts
    assert exchanges(p, "token") == 1 and len(re.findall("Exchange hashpartitioning", p)) == 1
    assert "partial_count" in p
    # tokens are computed once: no inferred size(...) filter re-running them
    assert "size(UDF(regexp_extract_all" not in p


def test_word_count_explode_is_outer(spark):
    p = plan(E.queries()["a4_word_count"](spark, SF))
    assert "Generate explode" in p and ", true, [token" in p


def test_full_mode_reads_corpus_once(spark):
    p = plan(E.queries()["t8_full_mode"](spark, SF))
    # distinct-unit counts are stored when the query is built, so the plan
    # holds no corpus scan, and segmentation adds no shuffle before the final count
    assert "documents.parquet" not in p
    assert exchanges(p, "block") == 1  # the window clusters the stored blocks
    assert "ObjectHashAggregate" not in p
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2


def test_split_moves_no_row(spark):
    from reviewkit.operators.sampling import exact_split
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert "Exchange" not in plan(exact_split(docs, "doc_id", 1))


def test_search_mode_walks_the_paths_once(spark):
    p = plan(E.queries()["t9_search_mode"](spark, SF))
    assert "Python" not in p
    # The candidates are marked by one window chain, and folded in one place.
    assert len(re.findall(r"max\(\(i#", p)) <= 2 and len(re.findall(r"reverse\(", p)) == 1


def test_segmentation_runs_without_python(spark):
    for name in ("t7_exact_mode", "t8_full_mode", "t7_exact_rows", "j5_dictionary_hits"):
        assert "Python" not in plan(E.queries()[name](spark, SF)), name


def test_queries_read_no_cap(spark):
    """Both entry points give rows at the smallest size."""
    assert E.entry(spark).count() > 0
