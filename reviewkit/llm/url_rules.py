"""URL filter rules, indexed by their rarest literal token.

A rule is ``host/path-prefix``; it fits the host and its subdomains when the url's path starts with the
prefix. Every rule has literal tokens that a fitting url must contain as whole tokens (its host labels and the
closed parts of its path). The corpus counts those tokens; each rule is filed under its rarest one. A url's tokens
fetch the rules filed under them, and only those run their regular expression; the longest fitting rule wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewkit.session import ship_package

#: Most bytes of rules that are sent to the executors at once; more rules go in several passes of this size.
RULES_BYTES = 64_000_000
_WORD = re.compile(r"[0-9A-Za-z]+")

RESULT = "page_id long, host string, path string, rule string, verdict string, rules_tried int"


def _ascii_lower(s: str) -> str:
    return s.encode().lower().decode()


def literal_tokens(rule: str) -> list[str]:
    """Tokens that every fitting url contains whole: the host's, and the path's but an open last one."""
    host, slash, path = rule.partition("/")
    closed = _WORD.findall(path)
    if closed and _WORD.fullmatch(path[-1]):
        closed.pop()
    return list(dict.fromkeys(_WORD.findall(_ascii_lower(host)) + closed))


def rule_pattern(rule: str) -> str:
    """Regular expression over ``host + '\\0' + path``."""
    host, slash, path = rule.partition("/")
    return "(?s)(?:.*\\.)?" + re.escape(_ascii_lower(host)) + "\0" + re.escape(slash + path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to
    ``?``, ``#`` or the end. Null url or none of ``://``: both empty."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substr(url, begin + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def _rarest(parts: DataFrame, rules: Sequence[tuple[str, str]]) -> dict[str, str]:
    """rule -> its literal token with the fewest urls (ties: the first in the alphabet)."""
    wanted = sorted({t for _, r in rules for t in literal_tokens(r)})
    tokens = F.array_distinct(F.concat(F.split("host", "[^0-9A-Za-z]+"), F.split("path", "[^0-9A-Za-z]+")))
    spark = parts.sparkSession
    listed = spark.createDataFrame([(t,) for t in wanted] or [("",)], "token string")
    counts = {r.token: r["count"] for r in parts.select(F.explode(tokens).alias("token")).join(
        F.broadcast(listed), "token", "left_semi").groupBy("token").count().collect()}
    return {r: min(literal_tokens(r), key=lambda t: (counts.get(t, 0), t), default="") for _, r in rules}


class _Index:
    """Rules by rarest token; those without a literal token are tried on every url."""

    def __init__(self, rules: Sequence[tuple[str, str]], filed: dict[str, str]) -> None:
        self.by_token: dict[str, list[tuple[int, str, str, str]]] = {}
        # Longest first; of equal rules the first given.
        for verdict, rule in sorted(rules, key=lambda x: -len(x[1])):
            self.by_token.setdefault(filed[rule], []).append((len(rule), rule, verdict, rule_pattern(rule)))

    def judge(self, host: str, path: str, compiled: dict[str, re.Pattern]) -> tuple[str | None, str | None, int]:
        best, tried, subject = (-1, None, None), 0, f"{host}\0{path}"
        for token in {"", *_WORD.findall(host), *_WORD.findall(path)}:
            for size, rule, verdict, pattern in self.by_token.get(token, ()):
                if size <= best[0]:
                    break
                tried += 1
                if pattern not in compiled:
                    compiled[pattern] = re.compile(pattern)
                if compiled[pattern].match(subject):
                    best = (size, rule, verdict)
                    break
        return best[1], best[2], tried


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], default: str = "allow") -> DataFrame:
    """The verdict of ``rules`` - (``allow`` or ``block``, ``host/prefix``) - on every page's url.

    Returns one row per page: page_id, host, path, rule (the longest fitting; null if none), verdict (the rule's,
    else ``default``), rules_tried (regular expressions run). Only ``page_id`` and ``url`` are read. A null url and one
    without ``://`` have an empty host and path and fit no rule with a host. Repeated rows are judged alike; of two
    equal rules the first given holds. No rules: every page gets ``default``. Empty table: empty result.

    Scale: no shuffle but the count of the rules' own tokens; the rule index, whose size the rules fix, is sent
    to the executors in parts of ``RULES_BYTES``.
    """
    if any(v not in ("allow", "block") for v, _ in rules):
        raise ValueError("a rule's verdict is allow or block")
    ship_package(pages.sparkSession)
    parts = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    parts = parts.select("page_id", host.alias("host"), path.alias("path"))
    filed = _rarest(parts, rules)
    size, groups = 0, [[]]
    for r in sorted(rules, key=lambda x: -len(x[1])):  # longer rules first, so an earlier part's match stands
        size += len(r[1].encode()) + 64
        if size > RULES_BYTES:
            size = 0
            groups.append([])
        groups[-1].append(r)
    indexes = [pages.sparkSession.sparkContext.broadcast(_Index(g, filed)) for g in groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[str, re.Pattern] = {}
        for b in batches:
            rules_, verdicts, tried = [], [], np.zeros(b.num_rows, np.int32)
            for k, (h, p) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                rule = verdict = None
                for index in indexes:
                    if rule is None:
                        rule, verdict, n = index.value.judge(h, p, compiled)
                        tried[k] += n
                rules_.append(rule)
                verdicts.append(verdict or default)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(rules_, pa.string()), pa.array(verdicts, pa.string()),
                 pa.array(tried)], names=["page_id", "host", "path", "rule", "verdict", "rules_tried"])

    return parts.mapInArrow(run, RESULT)
