"""The dealt operators' registered queries and their DuckDB twins.

Each query reads whole tables and derives its contract's columns from the operator's own output.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewkit.llm.chat_mask import format_chats
from reviewkit.llm.crf_pii import find_personal_data
from reviewkit.llm.mixing_lm import score_texts
from reviewkit.llm.partition_join import jaccard_components
from reviewkit.llm.phrases import mine_phrases
from reviewkit.llm.poisson_mix import replicate
from reviewkit.llm.pq_dedup import near_vectors
from reviewkit.llm.pu_quality import score_quality
from reviewkit.llm.slots import assign_shards
from reviewkit.llm.suffix_decontam import decontaminate
from reviewkit.llm.turn_repair import repair_chats
from reviewkit.llm.url_rules import judge_urls
from reviewkit.llm.window_dedup import dedup_windows

#: Target shares of the sources in the mix; a source that is not listed has the share of '*'.
MIX_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5, "*": 1.0}
SHARDS = 40
#: Byte-level tokenizer of the chat formatting (a public vocabulary file every machine has).
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES).drop("rules_tried")


def op3_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_windows(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", "intervals")


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(_table(spark, sf_dir, "documents"), SHARDS)


def op5_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op6_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_suffix_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_partition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replicated corpus: every copy with its document's columns, in global random order."""
    return replicate(_table(spark, sf_dir, "documents"), MIX_WEIGHTS).select(
        "doc_id", "text", "lang", "source", "n_chars", F.col("__mix_copy").alias("copy"),
        F.col("__mix_count").alias("copies"), F.col("__mix_order").alias("shuffle_key"))


def op10_chat_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold other formats' control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.sql("SELECT -7L AS conv_id, turn, role, text FROM VALUES (0L, 'user', :said), (1L, 'assistant', :said) "
                      "AS t(turn, role, text)", {"said": said})
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    return format_chats(chats, TOKENIZER).drop("formatted", "input_ids", "loss_mask")


def op11_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(_table(spark, sf_dir, "documents"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by the contract's rule and repaired."""
    return repair_chats(_table(spark, sf_dir, "conversations"), damage=True).drop("repaired")


def op13_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pu_quality, op2_url_rules, op3_window_dedup, op4_virtual_slots, op5_mixing_lm, op6_pq_dedup,
                               op7_suffix_decontam, op8_partition_join, op9_poisson_mix, op10_chat_mask, op11_setm_phrases,
                               op12_turn_repair, op13_crf_pii)
}

def _url_sql() -> str:
    """The same rules as a join of rules and urls, longest fitting rule first."""
    rules = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in URL_RULES)
    return f"""
WITH rest AS (
  SELECT page_id, row_number() OVER () AS k,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, k, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(verdict, rule, rule_host, prefix) AS (VALUES {rules}),
fit AS (
  SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts, rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, prefix) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fit USING (k)"""


def _mix_sql(seed: int = 17) -> str:
    """Rates by source, the same digest as the draw, and the Poisson distribution as a recursive table."""
    weight = "CASE " + " ".join(f"WHEN source = '{k}' THEN {v!r}::DOUBLE" for k, v in sorted(MIX_WEIGHTS.items()) if k != "*")
    weight += f" ELSE {MIX_WEIGHTS['*']!r}::DOUBLE END"
    return f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n, {weight} AS w FROM documents GROUP BY source),
rates AS (SELECT source, w / sum(w) OVER () * sum(n) OVER () / n AS rate FROM sizes),
parts AS (SELECT source, rate / greatest(1, ceil(rate / 16)) AS r, greatest(1, ceil(rate / 16))::BIGINT AS parts FROM rates),
steps(source, r, k, p, c) AS (
  SELECT source, r, 0, exp(-r), exp(-r) FROM parts
  UNION ALL SELECT source, r, k + 1, p * r / (k + 1), c + p * r / (k + 1) FROM steps WHERE k < 80),
cdf AS (SELECT source, list(c ORDER BY k) AS cdf FROM steps GROUP BY source),
draws AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, list_sum(list_transform(range(1, parts + 1), lambda i: len(list_filter(cdf,
    lambda c: c <= ('0x' || substr(md5('{seed}:' || coalesce(d.doc_id::VARCHAR, '~') || ':' || coalesce(md5(d.text), '~') || ':' || i), 1, 13))::BIGINT / {float(1 << 52)!r})))) AS copies
  FROM documents d JOIN parts ON d.source IS NOT DISTINCT FROM parts.source JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source),
copied AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(0, copies::BIGINT)) AS copy, copies FROM draws)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, copies::INTEGER AS copies,
       md5('order {seed}:' || coalesce(doc_id::VARCHAR, '~') || ':' || coalesce(md5(text), '~') || ':' || copy) AS shuffle_key FROM copied"""


def _phrase_sql(least: int = 100, width: int = 5, share: int = 100, top: int = 2000) -> str:
    """Every phrase of every piece written out and counted; the covering test over all sub-phrases of all lengths."""
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, {width + 1}) AS t(k)),
f AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS a FROM starts
      GROUP BY ALL HAVING count(*) >= {least}),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM cand),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.a AS l, y.a AS r, n, ((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(w, 1, cut), ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(w, cut + 1, c.k), ' ') JOIN sizes s ON s.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored),
inner_starts AS (SELECT lang, a, k, w, m, unnest(range(1, k - m + 2)) AS i FROM cand, range(2, {width}) AS t(m) WHERE m < k),
covered AS (SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, max(a) AS longer FROM inner_starts GROUP BY ALL),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
  FROM best b LEFT JOIN covered c ON c.lang = b.lang AND c.phrase = b.phrase
  WHERE nth = 1 AND (longer IS NULL OR 100 * longer < {share} * a))
SELECT * FROM ranked WHERE rank <= {top}"""


def _repair_sql() -> str:
    """Damage and faults by expressions; the cheapest audit for every state, row after row, in a recursive table."""
    return r"""
WITH RECURSIVE crc_bits(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8),
source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
keyed AS (
  SELECT key, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT key FROM source), crc_table),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM source JOIN keyed USING (key)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM damaged),
chat_rows AS (
  SELECT coalesce(conv_id::VARCHAR, '') AS c, i, turn, role, text, CASE WHEN role = '' THEN ' ' ELSE role[1] END AS ch,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM placed),
sizes AS (SELECT DISTINCT coalesce(s.conv_id::VARCHAR, '') AS c, s.conv_id, coalesce(n, 0) AS n FROM source s
          LEFT JOIN (SELECT c, count(*) AS n FROM chat_rows GROUP BY c) x ON x.c = coalesce(s.conv_id::VARCHAR, '')),
-- States: 0 nothing written, 1 after system, 2 after user, 3 after assistant.
added(q0, q, letters) AS (VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (1, 2, 'I'), (3, 2, 'I'), (2, 3, 'I'),
                                 (0, 3, 'II'), (1, 3, 'II')),
used(q0, letter, ch, q, price) AS (VALUES
  (0, 'D', NULL, 0, 4), (1, 'D', NULL, 1, 4), (2, 'D', NULL, 2, 4), (3, 'D', NULL, 3, 4), (0, 'R', NULL, 2, 3), (1, 'R', NULL, 2, 3),
  (2, 'R', NULL, 3, 3), (3, 'R', NULL, 2, 3), (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0),
  (2, 'K', 'a', 3, 0)),
moves AS (SELECT a.q0, u.q, a.letters || u.letter AS letters, u.letter, u.ch, u.price + 3 * length(a.letters) AS price
          FROM added a JOIN used u ON u.q0 = a.q),
walk(c, i, q, cost, audit) AS (
  SELECT c, 0::BIGINT, 0, 0::BIGINT, '' FROM sizes
  UNION ALL
  SELECT c, i, q, cost, audit FROM (
    SELECT r.c, r.i, m.q, w.cost + m.price + CASE WHEN r.fault = 3 AND m.letter <> 'D' THEN 3 ELSE 0 END AS cost, w.audit || m.letters AS audit,
           row_number() OVER (PARTITION BY r.c, m.q ORDER BY w.cost + m.price + CASE WHEN r.fault = 3 AND m.letter <> 'D' THEN 3 ELSE 0 END,
                              w.audit || m.letters) AS nth
    FROM walk w JOIN chat_rows r ON r.c = w.c AND r.i = w.i + 1 JOIN moves m ON m.q0 = w.q
    WHERE (m.letter = 'D' OR r.fault IN (0, 3)) AND (m.ch IS NULL OR m.ch = r.ch)) WHERE nth = 1),
ends AS (SELECT s.c, w.cost + 3 * length(a.letters) AS cost, w.audit || a.letters AS audit
         FROM sizes s JOIN walk w ON w.c = s.c AND w.i = s.n JOIN added a ON a.q0 = w.q AND a.q IN (0, 3)),
best AS (SELECT c, cost, audit FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY cost, audit) AS nth FROM ends) WHERE nth = 1),
apply(c, p, i, q, role, text) AS (
  SELECT c, 0::BIGINT, 0::BIGINT, 0, NULL::VARCHAR, NULL::VARCHAR FROM best
  UNION ALL
  SELECT a.c, a.p + 1, a.i + CASE WHEN l = 'I' THEN 0 ELSE 1 END,
         CASE WHEN l = 'D' THEN a.q WHEN l = 'K' AND a.q = 0 AND r.ch = 's' THEN 1 WHEN a.q = 2 THEN 3 ELSE 2 END,
         CASE WHEN l = 'D' THEN NULL WHEN l = 'K' THEN r.role WHEN a.q = 2 THEN 'assistant' ELSE 'user' END,
         CASE WHEN l = 'D' THEN NULL WHEN l = 'I' THEN '' ELSE r.text END
  FROM (SELECT a.*, b.audit[a.p + 1] AS l FROM apply a JOIN best b ON b.c = a.c AND a.p < length(b.audit)) a
  LEFT JOIN chat_rows r ON r.c = a.c AND r.i = a.i + 1),
fixed AS (SELECT c, string_agg(role || ':' || text, chr(10) ORDER BY p) AS body FROM apply WHERE role IS NOT NULL GROUP BY c),
pairs AS (SELECT *, lag(ch) OVER (PARTITION BY c ORDER BY i) || ch AS pair FROM chat_rows),
faults AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                  count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                  count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY c)
SELECT s.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, cost::BIGINT AS cost, audit,
       sha256(coalesce(body, '')) AS repaired_sha256
FROM sizes s JOIN best USING (c) LEFT JOIN fixed USING (c) LEFT JOIN faults USING (c)"""


ORACLE: dict[str, str] = {"op2_url_rules": _url_sql(), "op9_poisson_mix": _mix_sql(), "op11_setm_phrases": _phrase_sql(),
                          "op12_turn_repair": _repair_sql()}
