"""URL rules, virtual slots and Poisson mixing."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewkit.llm import poisson_mix, slots, url_rules
from reviewkit.llm.poisson_mix import rates, replicate
from reviewkit.llm.queries import ORACLE, URL_RULES
from reviewkit.llm.slots import assign_shards, deal, grow, grow_map, load_version
from reviewkit.llm.url_rules import judge_urls, literal_tokens

URLS = ["https://EXAMPLE.org/es/x?y=/en/1", "http://a.b.example.org/en/12#t", "http://example.org/en/2", "http://example.org",
        "http://example.org?x=/es/", "http://badexample.org/es/", "https://x.com/fr/1", "https://x.com/de/1", "https://com/de/",
        "https://x.com/de", "no scheme/org/", "", None, "://org/", "http://", "ftp://org/es/", "https://user@x.org:80/es/",
        "http://Ünï.org/ä/es/", "http://www.org/a?b://c.com/de/", "x://y://com/de/", "http://com/FR/", "http://x.com/fr/" + "a/" * 20_000]


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = (None, default)
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = (rule, verdict)
            break
    return host, path, *best


@pytest.mark.parametrize("rules", [URL_RULES, [], [("block", "x.com/f.r"), ("block", "org/%s/"), ("allow", "example.org/en/12"), ("block", "com/")],
                                   [("block", f"h{i}.com/{i}/") for i in range(200)] + [("block", "-/"), ("allow", "ünï.org/ä/")]])
def test_urls(spark, rules, monkeypatch):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[0]), (3, URLS[2]), (3, URLS[2])]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'h' AS host", "'p' AS path", "1 AS token", "'' AS html")
    want = sorted((str(i), *map(str, plain(u, rules))) for i, u in rows)
    for limit in (10 ** 6, 200):
        monkeypatch.setattr(url_rules, "RULES_BYTES", limit)
        got = judge_urls(df, rules).collect()
        assert sorted(tuple(map(str, r))[:5] for r in got) == want
    # Rules filed under a token that is not in the url are never tried.
    assert all(r.rules_tried <= 3 for r in got)


def test_url_sql_says_the_same(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    for i, host, path, rule, verdict in con.execute(ORACLE["op2_url_rules"]).fetchall():
        assert (host, path, rule, verdict) == plain(URLS[i], URL_RULES)


def test_urls_empty_and_wrong_rules(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(df, URL_RULES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(df, [("deny", "org/")])


def test_literal_tokens():
    assert literal_tokens("example.org/en/1") == ["example", "org", "en"]
    assert literal_tokens("Example.org/en/1/") == ["example", "org", "en", "1"]
    assert literal_tokens("org/") == ["org"]
    assert literal_tokens("-/") == []


def documents(spark, n=600):
    rows = [(i, None if i % 97 == 5 else "é" * (i % 50) + "x" * (i % 13) * (20 if i % 61 == 0 else 1), f"s{i % 3 if i % 2 else 0}", i) for i in range(n)]
    rows += [(None, "a", "s0", 1), (None, "b", None, 2), (None, "b", None, 2), (7, "dup", "s1", 3), (7, "dup", "s1", 3), (n, "", "s9", 0), (n + 1, "y" * 40_000, "s0", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").selectExpr(
        "*", "5 AS shard", "6 AS slot", "7 AS size", "'z' AS offset", "8 AS rate", "9 AS copies", "1 AS n", "2 AS __mix_copy")


def test_shards(spark):
    df = documents(spark)
    rows, got = df.collect(), assign_shards(df, 8).collect()
    size = lambda r: len((r.text or "").encode()) + 16
    assert sorted((str(r.doc_id), size(r), zlib.crc32((r.text or "").encode())) for r in rows) == sorted(
        (str(r.doc_id), r.size, r.text_crc32) for r in got)
    by_shard, where = defaultdict(list), {}
    for r in got:
        by_shard[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
        assert where.setdefault(r.vslot, (r.shard, r.next_shard)) == (r.shard, r.next_shard)
        assert r.next_shard in (r.shard, 8)  # growing moves slots to the new shard only
    assert sorted(by_shard) == list(range(8))
    for rs in by_shard.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    assert len({r.vslot for r in got if r.doc_id is None}) > 1
    without = [sum(r.size for r in rs) for rs in by_shard.values()]
    long = max(r.size for r in got)
    rest = sorted(without)[:-1]  # the long document fills a shard of its own
    assert max(without) < long + 200 and max(rest) - min(rest) <= 0.05 * max(rest)
    kept = assign_shards(df, 8, keep=True)
    assert [c for c in df.columns if c not in ("shard", "slot")] + ["shard", "slot", "vslot"] == kept.columns
    assert sorted((str(r.doc_id), r.shard, r.slot) for r in got) and Counter(
        (str(r.doc_id), r.shard) for r in kept.collect()) == Counter((str(r.doc_id), r.shard) for r in got)


def shared_id(spark, n=3000):
    """A third of all rows under one id, with different texts."""
    return spark.range(n).selectExpr("if(id % 3 = 0, -1L, id) AS doc_id", "concat('text ', id, repeat('x', int(id % 40))) AS text",
                                     "concat('s', id % 2) AS source")


def test_rows_that_share_an_id_spread_over_slots_and_shards(spark):
    got = assign_shards(shared_id(spark), 8).collect()
    shared = Counter(r.vslot for r in got if r.doc_id == -1)
    assert sum(shared.values()) == 1000 and max(shared.values()) < 6
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) < 0.02 * max(sizes.values())


def test_rows_that_share_an_id_draw_by_their_texts(spark):
    got = replicate(shared_id(spark), {"*": 1.0}, 6000.0).where("doc_id = -1")
    counts = Counter(r.text for r in got.collect())
    assert len(set(counts.values())) > 4 and 1800 < sum(counts.values()) < 2200
    assert got.select("__mix_order").distinct().count() == sum(counts.values())


def test_stored_map_places_later_records_and_grows_by_a_version(spark, tmp_path):
    path = str(tmp_path / "map")
    docs = documents(spark)
    place = lambda df, **k: {(r.doc_id, r.text_crc32): (r.vslot, r.shard, r.next_shard, r.map_version) for r in assign_shards(
        df, 8, map_path=path, **k).collect()}
    first = place(docs)
    assert {v[3] for v in first.values()} == {1} and load_version(spark, path)[1].count() == slots.SLOTS
    more = docs.unionByName(spark.range(10_000, 10_500).selectExpr("id AS doc_id", "repeat('z', int(id % 90)) AS text"), allowMissingColumns=True)
    later = place(more)
    assert all(later[k][:2] == v[:2] for k, v in first.items()) and {v[3] for v in later.values()} == {1}
    assert {v[1] for v in later.values()} == set(range(8))

    assert grow_map(more, path) == 2
    grown = place(more)
    assert {v[3] for v in grown.values()} == {2} and 8 in {v[1] for v in grown.values()}
    assert all(v[1] == later[k][2] and v[1] in (later[k][1], 8) for k, v in grown.items())
    assert place(more, version=1) == later
    before, after = ({r.vslot: r.shard for r in load_version(spark, path, v)[1].collect()} for v in (1, 2))
    assert len(after) == slots.SLOTS and all(after[s] in (before[s], 8) for s in before)
    with pytest.raises(ValueError):
        place(more, version=9)
    with pytest.raises(ValueError):
        grow_map(more, path + "-none")


def test_deal_is_largest_first_to_the_least_loaded(spark):
    sizes = {i: (i * 7919) % 1000 + 1 for i in range(300)}
    by_slot = spark.createDataFrame([(i, s, 1) for i, s in sizes.items()], "vslot int, bytes long, n long")
    load, want = [0] * 7, {}
    for i in sorted(sizes, key=lambda i: (-sizes[i], i)):
        to = load.index(min(load))
        want[i] = to
        load[to] += sizes[i]
    mapped = deal(by_slot, 7)
    assert {r.vslot: r.shard for r in mapped.collect()} == want
    grown = {r.vslot: r.shard for r in grow(by_slot, mapped, 7).collect()}
    new = [0] * 8
    for i, s in grown.items():
        assert s in (want[i], 7)
        new[s] += sizes[i]
    assert max(new) - min(new) < 0.05 * sum(new) / 8 * 8 and new[7] > 0.9 * sum(new) / 8 - 1000


def test_shards_are_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (assign_shards(docs, 8), assign_shards(docs, 8, keep=True), replicate(docs, {"src0": 2.0})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


def poisson(rate, u):
    p = c = math.exp(-rate)
    k = 0
    while c <= u and k < 80:
        k += 1
        p *= rate / k
        c += p
    return k


def draw(key, parts, rate, seed=17):
    return sum(poisson(rate / parts, int(hashlib.md5(f"{seed}:{key}:{i}".encode()).hexdigest()[:13], 16) / 2 ** 52) for i in range(1, parts + 1))


@pytest.mark.parametrize("budget", [None, 5000.0, 40_000.0])
def test_replication(spark, budget):
    df, weights = documents(spark), {"s0": 3.0, "s1": 0.5, "s2": 0.0, "*": 1.0}
    rows, got = df.collect(), replicate(df, weights, budget).collect()
    n = Counter(r.source for r in rows)
    w = {s: weights.get(s, 1.0) if s else 1.0 for s in n}
    rate = {s: w[s] / sum(w.values()) * (budget or len(rows)) / n[s] for s in n}
    assert {r.source: round(r.rate, 9) for r in rates(df, weights, budget).collect()} == {s: round(x, 9) for s, x in rate.items()}
    want = Counter()
    for r in rows:
        key = f"{'~' if r.doc_id is None else r.doc_id}:{'~' if r.text is None else hashlib.md5(r.text.encode()).hexdigest()}"
        want[str(r.doc_id), r.text] += draw(key, max(1, math.ceil(rate[r.source] / 16)), rate[r.source])
    assert Counter((str(r.doc_id), r.text) for r in got) == +want
    assert all(r["__mix_copy"] < r["__mix_count"] for r in got)
    keys = [r["__mix_order"] for r in got]
    assert keys == sorted(keys)
    share = Counter(r.source for r in got)
    if budget:
        assert abs(share["s0"] / len(got) - 3 / sum(w.values())) < 0.05
    assert share["s2"] == 0


def test_replication_is_independent_of_partitions(spark):
    df = documents(spark)
    one, two = (sorted(map(str, replicate(df.repartition(k), {"s0": 2.0}).select("doc_id", "__mix_copy", "__mix_order").collect())) for k in (1, 7))
    assert one == two


def test_draws_follow_the_distribution(spark):
    for rate in (0.3, 2.5, 12.0):
        k = np.array([r[0] for r in spark.range(20_000).select(poisson_mix.draw(
            poisson_mix.distribution(F.lit(rate)), poisson_mix.uniform(1, F.col("id"), F.lit(1)))).collect()])
        assert abs(k.mean() - rate) < 0.04 * max(rate, 1) and abs(k.var() - rate) < 0.06 * max(rate, 1)


def test_empty(spark):
    df = documents(spark).where("false")
    assert assign_shards(df, 4).count() == replicate(df, {"s0": 1.0}).count() == 0
    with pytest.raises(ValueError):
        rates(df, {"a": -1.0})


def test_slot_count_is_fixed():
    assert slots.SLOTS == 4096
