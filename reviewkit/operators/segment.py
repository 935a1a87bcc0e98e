"""Dictionary word segmentation as Spark jobs.

Text is split into *blocks* (runs matching ``block_re``, by default Han
characters) that are segmented against a dictionary table (word, weight); other
runs (letters/digits) pass through as one token each. Whitespace and
punctuation are not emitted (the reference's segmenter emits them as tokens,
which then only add noise to counts and lengths).

Work is done once per distinct block: the corpus is first reduced to
(block, occurrences). Per block:

* candidates: a position is extended while its next 1, 2, 4, 8, ... characters are the
  beginning of a word (equi joins with a table of word beginnings, :class:`Matcher`), and only
  the lengths of words that begin so are candidates, which are matched by an equi join with
  the dictionary. Work follows the matches, not the longest word; both tables are broadcast
  after a size check;
* full mode (T8): all words of length >= 2 starting at i; the single character
  at i only when no such word starts there and i lies past the end of the last
  emitted word group, ``old = last(end) OVER (PARTITION BY block ORDER BY i
  ROWS UNBOUNDED PRECEDING TO 1 PRECEDING)``;
* exact mode (T7): best path by summed log probability over the candidates;
  ties go to the longer word. Log probabilities are whole numbers of 10^-9, so that
  sums are exact and equal paths tie on any engine. A block is cut where no word spans, and the path of each
  segment is a fold from its last candidate to its first, on the JVM;
* search mode (T9): exact words plus their dictionary sub-words of length 2
  and 3, found by the same join.

All per-block steps keep the hash partitioning on ``block`` from the first
aggregate, so they add no shuffle; the only other shuffles are the final
count or the join back to rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewkit.functions.arrays import explode_rows
from reviewkit.functions.text import WHITESPACE_RANGES
from reviewkit.functions.text import _char_class as _ws_class
from reviewkit.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, checked_broadcast, materialize, table_size
from reviewkit.operators.ranking import as_list

HAN_RE = "[\\x{4e00}-\\x{9fd5}]+"
WS_CLASS_RE = _ws_class(WHITESPACE_RANGES)
# Letters and digits that are not Han: a Latin letter or digit before Han text ends its own run.
OTHER_RE = "[\\p{L}\\p{N}&&[^\\x{4e00}-\\x{9fd5}]]+"
DICT_MAX_ROWS = 5_000_000
LOG_UNITS = 1e9  # log probabilities are summed in units of 10^-9


# ---------------------------------------------------------------- dictionary

def dictionary_from_counts(counts: DataFrame, min_freq: int = 16) -> DataFrame:
    """Dictionary (word, weight) from word counts: freq >= min_freq, words of any length."""
    return counts.filter(F.col("freq") >= min_freq) \
        .select(F.col("token").alias("word"), F.col("freq").cast("long").alias("weight"))


def load_user_dictionary(base: DataFrame, *loads: DataFrame) -> DataFrame:
    """Later loads win per word (``max_by`` over the load number, no window)."""
    parts = [base.select("word", F.col("weight").cast("long"), F.lit(0).alias("__load"))]
    parts += [d.select("word", F.col("weight").cast("long"), F.lit(k + 1).alias("__load"))
              for k, d in enumerate(loads)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("word").agg(F.max_by("weight", "__load").alias("weight"))


def add_words(dictionary: DataFrame, words: DataFrame) -> DataFrame:
    """T10 add_word: insert or overwrite (word, weight)."""
    return load_user_dictionary(dictionary, words)


def delete_words(dictionary: DataFrame, words: DataFrame) -> DataFrame:
    """T10 del_word: remove the listed words (anti join)."""
    return dictionary.join(words.select("word"), "word", "left_anti")


# ---------------------------------------------------------------- blocks

def split_units(text: Column, block_re: str = HAN_RE, other_re: str = OTHER_RE,
                keep_whitespace: bool = False) -> Column:
    """Array of units in text order: blocks (to segment) and other runs.

    ``keep_whitespace`` also emits every whitespace character as its own unit
    (``\\r\\n`` as one), as the reference's segmenter does; those units then
    reach counts and lengths. Off by default.
    """
    pattern = f"{block_re}|{other_re}"
    if keep_whitespace:
        pattern += f"|\\r\\n|{WS_CLASS_RE}"
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def block_counts(df: DataFrame, blocks_col: str = "blocks") -> DataFrame:
    """Distinct blocks with their number of occurrences (partial + final aggregate)."""
    return (explode_rows(df, [], F.col(blocks_col), "block")
            .groupBy("block").agg(F.count(F.lit(1)).alias("n")))


@dataclass
class Matcher:
    """A dictionary (word, weight), its table of word beginnings, and how many beginnings of a word there are at most.

    ``beginnings`` has the first 1, 2, 4, 8, ... characters of every word: (prefix, lens, more). ``lens`` are the lengths, from the
    prefix's own to below twice that, of the words that begin so; ``more`` tells whether longer ones do. Both tables are
    broadcast within the size bounds and are shuffle joins beyond them.
    """

    dictionary: DataFrame
    beginnings: DataFrame
    levels: int


def matcher(dictionary: DataFrame | Matcher, checked: bool = False) -> Matcher:
    """The tables that matching needs, stored. A word without characters is left out."""
    if isinstance(dictionary, Matcher):
        return dictionary
    stored = dictionary.select("word", "weight")
    stored = stored if checked else materialize(stored)
    n = F.length("word")
    powers = F.transform(F.sequence(F.lit(0), F.floor(F.log2(n.cast("double"))).cast("int")), lambda k: F.call_function("shiftleft", F.lit(1), k))
    parts = stored.where(n > 0).select(n.alias("n"), "word", F.explode(powers).alias("p"))
    grouped = parts.groupBy(F.substring(F.col("word"), F.lit(1), F.col("p")).alias("prefix")).agg(
        F.sort_array(F.collect_set(F.when(F.col("n") < 2 * F.col("p"), F.col("n")))).alias("lens"),
        F.max(F.col("n") >= 2 * F.col("p")).alias("more"))
    grouped = materialize(grouped)
    longest = grouped.agg(F.max(F.length("prefix"))).first()[0] or 0
    return Matcher(stored if checked else checked_broadcast(stored, DICT_MAX_ROWS, materialized=True),
                   checked_broadcast(grouped, DICT_MAX_ROWS, materialized=True), longest.bit_length())


def _with_lengths(pos: DataFrame, m: Matcher) -> DataFrame:
    """``lens`` of every position: lengths of the words that may begin there, by beginnings of 1, 2, 4, ... characters."""
    found, more = F.array().cast("array<int>"), F.lit(True)
    own = pos.columns
    for k in range(m.levels):
        size = 1 << k
        # A position whose beginning is no word's any more has no key and finds nothing.
        key = F.when(more & (F.length("block") - F.col("i") >= size), F.substring(F.col("block"), F.col("i") + 1, F.lit(size)))
        side = m.beginnings.select(F.col("prefix").alias("__p"), F.col("lens").alias("__lens"), F.col("more").alias("__m"))
        pos = pos.withColumn("__key", key)
        pos = pos.join(side, pos["__key"] == side["__p"], "left").select(
            *own, F.concat(found, F.coalesce(F.col("__lens"), F.array().cast("array<int>"))).alias("__found"),
            F.coalesce(F.col("__m"), F.lit(False)).alias("__more"))
        found, more = F.col("__found"), F.col("__more")
    return pos.select(*own, found.alias("lens"))


def _positions(blocks: DataFrame, m: Matcher, min_len: int, marker: bool) -> DataFrame:
    """(block, n, i, l[, weight]) of every dictionary match; with ``marker`` a row l = 0 for every position, too."""
    n = F.length("block")
    pos = blocks.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    pos = _with_lengths(pos.where(n > 0), m)
    own = [c for c in pos.columns if c != "lens"]
    zero = F.array(F.lit(0)) if marker else F.array().cast("array<int>")
    cand = pos.select(*own, F.explode(F.concat(zero, F.col("lens"))).alias("l"))
    # A plain filter after the explode, not a lambda before it: it stays in generated code.
    cand = cand.where((F.col("l") == 0) | ((F.col("l") >= min_len) & (F.col("i") + F.col("l") <= n)))
    d = m.dictionary
    sub = F.substring(F.col("block"), F.col("i") + 1, F.col("l"))
    if not marker:
        return cand.join(d, sub == d["word"]).drop("word")
    j = cand.join(d, (cand["l"] > 0) & (sub == d["word"]), "left")
    return j.where((F.col("l") == 0) | F.col("word").isNotNull()).drop("word")


def dictionary_hits(blocks: DataFrame, dictionary: DataFrame | Matcher, min_len: int = 1,
                    dict_checked: bool = False) -> DataFrame:
    """(block, i, l, weight) for every dictionary word at 0-based position i."""
    return _positions(blocks, matcher(dictionary, dict_checked), min_len, marker=False)


# ---------------------------------------------------------------- full mode

def full_mode_pieces(blocks: DataFrame, dictionary: DataFrame | Matcher,
                     dict_checked: bool = False) -> DataFrame:
    """T8 per distinct block: (block, n, i, l, piece) in emission order (i, l)."""
    m = matcher(dictionary, dict_checked)
    # Cluster the distinct blocks before exploding them: the window below needs
    # all rows of a block together, and the explode, the broadcast joins and the
    # filter keep this partitioning, so one row per block is shuffled instead
    # of one row per (position, length).
    keep = _positions(blocks.select("block", "n").repartition("block"), m, 2, marker=True).select("block", "n", "i", "l")
    # One window over (block; i, l): the marker row (l = 0) of a position comes
    # before its words, so the preceding rows are the words of earlier
    # positions, and the last of them ends the last emitted group ("old"); the
    # next row has the same i exactly when the position has a word.
    order = Window.partitionBy("block").orderBy("i", "l")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    end = F.when(F.col("l") >= 2, F.col("i") + F.col("l") - 1)
    old = F.coalesce(F.last(end, ignorenulls=True).over(before), F.lit(-1))
    has_word = F.coalesce(F.lead("i").over(order) == F.col("i"), F.lit(False))
    marked = keep.select("block", "n", "i", "l", old.alias("__old"), has_word.alias("__hw"))
    out = marked.filter((F.col("l") >= 2) | (~F.col("__hw") & (F.col("i") > F.col("__old")))) \
        .select("block", "n", "i", F.when(F.col("l") >= 2, F.col("l")).otherwise(F.lit(1)).alias("l"))
    return out.withColumn("piece", F.substring(F.col("block"), F.col("i") + 1, F.col("l")))


# ---------------------------------------------------------------- exact mode

def _units(log_p: Column) -> Column:
    return F.round(log_p * LOG_UNITS).cast("long")


def _path(unknown: Column, rows: Column) -> Column:
    """Lengths of the best path's step at each position of a segment, first position first.

    ``rows`` are a segment's candidates (i, l, logp), sorted; l = 0 marks a position and comes before its words. Folded from
    the last to the first: ``p`` holds the best sums of the positions done so far, the latest first, so the sum behind a word
    of l characters is ``p[l - 1]``; at a position's mark its best word is added. A position without words is a
    word of one character and weight 1.
    """
    none = F.struct(F.lit(-(1 << 62)).cast("long").alias("p"), F.lit(0).alias("l"))
    start = F.struct(F.array(F.lit(0).cast("long")).alias("p"), F.array().cast("array<int>").alias("e"), none.alias("best"))

    def step(acc: Column, row: Column) -> Column:
        best, p = acc["best"], acc["p"]
        here = row["logp"] + F.get(p, row["l"] - 1)
        better = (here > best["p"]) | ((here == best["p"]) & (row["l"] > best["l"]))
        done = F.when(best["l"] > 0, best).otherwise(F.struct((unknown + F.get(p, F.lit(0))).alias("p"), F.lit(1).alias("l")))
        return F.when(row["l"] == 0, F.struct(F.concat(F.array(done["p"]), p).alias("p"), F.concat(F.array(done["l"]), acc["e"]).alias("e"),
                                              none.alias("best"))) \
            .otherwise(F.struct(p.alias("p"), acc["e"].alias("e"),
                                F.when(better, F.struct(here.alias("p"), row["l"].alias("l"))).otherwise(best).alias("best")))

    return F.aggregate(F.reverse(rows), start, step, lambda acc: acc["e"])


def _steps(lengths: Column) -> Column:
    """(at, l) of the steps that a path really takes, from the lengths at all positions."""
    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<at:int,l:int>>").alias("out"))

    def step(acc: Column, at: Column) -> Column:
        l = F.get(lengths, at)
        return F.when(acc["next"] != at, acc).otherwise(F.struct(
            (at + l).alias("next"), F.concat(acc["out"], F.array(F.struct(at.alias("at"), l.alias("l")))).alias("out")))

    return F.aggregate(F.sequence(F.lit(0), F.size(lengths) - 1), start, step, lambda acc: acc["out"])


def exact_mode_pieces(blocks: DataFrame, dictionary: DataFrame | Matcher,
                      dict_checked: bool = False) -> DataFrame:
    """T7 per distinct block: (block, n, pieces array<string>).

    A block is cut at every position that no earlier word reaches over: all paths pass there, so the best
    path is the best paths of the segments, which are short however long the block is.
    """
    m = matcher(dictionary, dict_checked)
    total = m.dictionary.agg(F.sum("weight").alias("t"))
    log_total = F.log(F.col("__total").cast("double"))
    rows = _positions(blocks.select("block", "n").repartition("block"), m, 1, marker=True)
    rows = rows.crossJoin(F.broadcast(total.select(F.col("t").alias("__total"))))  # one row
    rows = rows.select("block", "n", "i", "l", _units(F.log(F.col("weight").cast("double")) - log_total).alias("logp"),
                       _units(F.lit(0.0) - log_total).alias("unknown"))  # log(1) - log(total): a character not in the dictionary
    order = Window.partitionBy("block").orderBy("i", "l")
    reach = F.max(F.col("i") + F.col("l")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = ((F.col("l") == 0) & (F.coalesce(reach, F.lit(0)) <= F.col("i"))).cast("int")
    rows = rows.withColumn("__cut", cut)
    rows = rows.withColumn("seg", F.sum("__cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    segments = rows.groupBy("block", "n", "seg").agg(
        F.sort_array(F.collect_list(F.struct("i", "l", "logp"))).alias("c"), F.min("i").alias("begin"),
        F.coalesce(F.max("unknown"), F.lit(0)).cast("long").alias("unknown"))
    # Each array is a column of its own, so that the path is folded once and read twice.
    paths = segments.select("block", "n", "seg", "begin", _path(F.col("unknown"), F.col("c")).alias("lengths"))
    steps = paths.select("block", "n", "seg", "begin", _steps(F.col("lengths")).alias("s"))
    pieces = steps.select("block", "n", "seg", F.transform("s", lambda x: F.substring(
        F.col("block"), F.col("begin") + x["at"] + 1, x["l"])).alias("pieces"))
    return pieces.groupBy("block", "n").agg(F.sort_array(F.collect_list(F.struct("seg", "pieces"))).alias("p")).select(
        "block", "n", F.flatten(F.col("p.pieces")).alias("pieces"))


# ---------------------------------------------------------------- search mode

def search_mode_pieces(exact: DataFrame, dictionary: DataFrame | Matcher,
                       dict_checked: bool = False) -> DataFrame:
    """T9 from exact-mode pieces: (block, n, piece) with 2- and 3-char dictionary sub-words.

    For every exact word longer than 2 (3) characters its 2-grams (3-grams) that are
    dictionary words are emitted before the word itself.
    """
    d = matcher(dictionary, dict_checked).dictionary
    words = explode_rows(exact, ["block", "n"], F.col("pieces"), "w", pos_name="wpos")
    wl = F.length("w")

    def starts(g: int) -> Column:
        """(kind, gpos) of every g-gram of a word longer than g."""
        at = F.when(wl > g, F.sequence(F.lit(0), wl - g)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(F.lit(g).alias("kind"), i.alias("gpos")))

    # One explode of all sub-words and the word itself (kind 9), so the best paths are computed once.
    whole = F.array(F.struct(F.lit(9).alias("kind"), F.lit(0).alias("gpos")))
    parts = words.select("block", "n", "wpos", "w", F.explode(F.concat(starts(2), starts(3), whole)).alias("__p"))
    parts = parts.select("block", "n", "wpos", "__p.kind", "__p.gpos", F.when(F.col("__p.kind") == 9, F.col("w")).otherwise(
        F.substring(F.col("w"), F.col("__p.gpos") + 1, F.col("__p.kind"))).alias("piece"))
    hit = parts.join(d.select(F.col("word").alias("__w")).distinct() if not dict_checked else
                     d.select(F.col("word").alias("__w")), F.col("piece") == F.col("__w"), "left")
    return hit.where((F.col("kind") == 9) | F.col("__w").isNotNull()).drop("__w")


# ---------------------------------------------------------------- corpus-level jobs

def unit_counts(df: DataFrame, text_col: str, block_re: str = HAN_RE, other_re: str = OTHER_RE,
                keep_whitespace_tokens: bool = False) -> DataFrame:
    """(block, n): occurrences of every distinct unit of the texts, stored.

    One pass over the texts serves the dictionary, the segmentation and the counts of the
    other runs; each of them would otherwise split the texts again.
    """
    units = df.select(split_units(F.col(text_col), block_re, other_re, keep_whitespace_tokens).alias("u"))
    return materialize(block_counts(units, "u"))


def pieces_of_units(counts: DataFrame, dictionary: DataFrame, mode: str = "full",
                    block_re: str = HAN_RE) -> DataFrame:
    """(piece, freq) from unit counts: blocks segmented once each, other runs as they are."""
    is_block = F.col("block").rlike(f"^(?:{block_re})$")
    blocks = counts.filter(is_block)
    others = counts.filter(~is_block).select(F.col("block").alias("piece"), "n")
    d = matcher(dictionary)
    if mode == "full":
        p = full_mode_pieces(blocks, d, dict_checked=True).select("piece", "n")
    elif mode == "exact":
        p = explode_rows(exact_mode_pieces(blocks, d, dict_checked=True), ["n"], F.col("pieces"), "piece") \
            .select("piece", "n")
    elif mode == "search":
        ex = exact_mode_pieces(blocks, d, dict_checked=True)
        p = search_mode_pieces(ex, d, dict_checked=True).select("piece", "n")
    else:
        raise ValueError("mode must be 'full', 'exact' or 'search'")
    return p.unionByName(others).groupBy("piece").agg(F.sum("n").cast("long").alias("freq"))


def segment_counts(df: DataFrame, text_col: str, dictionary: DataFrame, mode: str = "full",
                   block_re: str = HAN_RE, other_re: str = OTHER_RE,
                   keep_whitespace_tokens: bool = False) -> DataFrame:
    """Word counts of the segmented corpus: (piece, freq).

    Blocks are segmented once per distinct block and weighted by occurrences;
    other runs count as themselves.
    """
    return pieces_of_units(unit_counts(df, text_col, block_re, other_re, keep_whitespace_tokens), dictionary, mode, block_re)


def segment_rows(df: DataFrame, key: str | Sequence[str], text_col: str, dictionary: DataFrame,
                 mode: str = "exact", block_re: str = HAN_RE, other_re: str = OTHER_RE,
                 out_col: str = "tokens", keep_whitespace_tokens: bool = False) -> DataFrame:
    """Per-row token arrays in text order (word segmentation of each review).

    Distinct blocks are segmented once. A row's units stay one array; only occurrences of blocks that
    are cut into pieces are joined on the block (size-checked broadcast, else a shuffle join without the words that
    stay whole) and put in their places by row.
    """
    key = as_list(key)
    split = df.select(*key, split_units(F.col(text_col), block_re, other_re, keep_whitespace_tokens).alias("__units"))
    # Read twice below, for the distinct blocks and for the rows; rows that share a key are told apart.
    split = materialize(split.withColumn("__row", F.monotonically_increasing_id()))
    units = explode_rows(split, [*key, "__row"], F.col("__units"), "block", pos_name="upos")
    counts = units.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    is_block = F.col("block").rlike(f"^(?:{block_re})$")
    d = matcher(dictionary)
    blocks = counts.filter(is_block)
    if mode == "full":
        pieces = full_mode_pieces(blocks, d, dict_checked=True) \
            .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("i", "l", "piece")))
                                  .alias("__p")).select("block", F.col("__p.piece").alias("pieces"))
    elif mode == "exact":
        pieces = exact_mode_pieces(blocks, d, dict_checked=True).select("block", "pieces")
    elif mode == "search":
        ex = exact_mode_pieces(blocks, d, dict_checked=True)
        pieces = search_mode_pieces(ex, d, dict_checked=True) \
            .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("wpos", "kind", "gpos", "piece")))
                                  .alias("__p")).select("block", F.col("__p.piece").alias("pieces"))
    else:
        raise ValueError("mode must be 'full', 'exact' or 'search'")
    return _rows_of_pieces(split, units, checked_blocks(pieces, d), key, out_col)


@dataclass
class Cuts:
    """Pieces of the blocks that are more than themselves, and, if those are no broadcast, the words that stay whole (or None)."""

    pieces: DataFrame
    whole: DataFrame | None


def checked_blocks(pieces: DataFrame, m: Matcher, max_rows: int = DEFAULT_BROADCAST_ROWS) -> Cuts:
    """Pieces (block, pieces) stored; a block that is its own only piece needs no row.

    Beyond the broadcast bounds the words of the dictionary that stay whole, most occurrences of a natural text, are taken out of the
    join by a broadcast of their own, so that only occurrences of rare blocks are shuffled.
    """
    stored = materialize(pieces)
    same = (F.size("pieces") == 1) & (F.get("pieces", F.lit(0)) == F.col("block"))
    cuts = stored.where(~same)
    n, size = table_size(cuts)
    if n <= max_rows and size <= DEFAULT_BROADCAST_BYTES:
        return Cuts(F.broadcast(cuts), None)
    words = m.dictionary.select(F.col("word").alias("block")).join(stored.where(same).select("block"), "block", "left_semi")
    words = materialize(words)
    n, size = table_size(words)
    return Cuts(cuts, F.broadcast(words) if n <= DICT_MAX_ROWS and size <= DEFAULT_BROADCAST_BYTES else None)


def _rows_of_pieces(split: DataFrame, units: DataFrame, cuts: Cuts, key: list[str], out_col: str) -> DataFrame:
    """Units of every row with the blocks of ``cuts`` in pieces.

    Units stay in their row's array: only the occurrences of cut blocks are joined, gathered by key and put in their places. Rows
    that share a key get the units of all of them, place by place; a null key gets none.
    """
    seen = units if cuts.whole is None else units.join(cuts.whole, "block", "left_anti")
    cut = seen.join(cuts.pieces, "block").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("__row", "upos", "pieces"))).alias("__cut"))
    rows = split.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), F.collect_list(
        F.when(F.col("__units").isNotNull(), F.struct("__row", "__units"))).alias("__all"))
    j = rows.join(cut, key, "left")
    none = F.array().cast("array<string>")
    made = F.coalesce(F.col("__cut"), F.array().cast(cut.schema["__cut"].dataType))

    def places(u: Column) -> Column:
        """One row: the units between two cut ones as they are, then the pieces of the next."""
        def part(k: Column) -> Column:
            begin = F.coalesce(F.get(made, k - 1)["upos"], F.lit(-1)) + 1
            end = F.coalesce(F.get(made, k)["upos"], F.size(u))
            return F.concat(F.slice(u, begin + 1, end - begin), F.coalesce(F.get(made, k)["pieces"], none))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(made)), part))

    def merged(rows: Column) -> Column:
        """Rows of one key: (place, pieces) of all, sorted."""
        def of(r: Column) -> Column:
            own = F.map_from_entries(F.transform(F.filter(made, lambda x: x["__row"] == r["__row"]), lambda x: F.struct(x["upos"], x["pieces"])))
            return F.transform(r["__units"], lambda u, i: F.named_struct(
                F.lit("upos"), i, F.lit("s"), F.coalesce(F.try_element_at(own, i), F.array(u))))
        return F.flatten(F.transform(F.sort_array(F.flatten(F.transform(rows, of))), lambda x: x["s"]))

    known = F.lit(True)
    for c in key:
        known = known & F.col(c).isNotNull()
    tokens = F.when(known & (F.size("__all") == 1), places(F.get("__all", F.lit(0))["__units"])).when(
        known & (F.size("__all") > 1), merged(F.col("__all"))).otherwise(none)
    return j.select(*key, tokens.alias(out_col), F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias("__k")).drop("__k")
