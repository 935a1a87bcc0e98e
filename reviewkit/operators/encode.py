"""Encoding token lists as fixed-length id arrays.

Plan of :func:`encode` (E1): cut each list to L first (``slice``: no lookup of
tokens that would be cut anyway), ``posexplode_outer`` so an empty list still
yields a row, look ids up by an equi join with the vocabulary (broadcast when its
size is checked), then rebuild the ordered array per review. Rows of one review
sit next to each other in the same task, so the partial ``collect_list`` folds
them before the shuffle: one row per review crosses the network. With a
vocabulary past the broadcast bound the lookup is a shuffle join on the token (hot
tokens are split by AQE), and the regrouping is a second shuffle of the positions.

Reviews are keyed by one column or a list, (source, review_id) in the working table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewkit.functions.arrays import pad_to, padding_mask
from reviewkit.functions.labels import sentiment
from reviewkit.operators import observed
from reviewkit.operators.joins import materialize
from reviewkit.operators.ranking import as_list
from reviewkit.session import scratch_path

Key = str | Sequence[str]
UNK_ID, PAD_ID = 0, 1


def lookup_ids(exploded: DataFrame, vocab: DataFrame, token_col: str = "token",
               unk_id: int = UNK_ID) -> DataFrame:
    """Token -> token_id by left equi join; unknown -> ``unk_id``.

    ``vocab`` should come through :func:`reviewkit.operators.joins.checked_broadcast`.
    """
    v = vocab.select(F.col("token").alias("__vt"), F.col("token_id").alias("__vid"))
    j = exploded.join(v, exploded[token_col] == v["__vt"], "left")
    return j.drop("__vt").withColumn(
        "token_id", F.when(F.col(token_col).isNull(), F.lit(None).cast("long"))
        .otherwise(F.coalesce(F.col("__vid"), F.lit(unk_id).cast("long")))).drop("__vid")


def encode_ids(df: DataFrame, vocab: DataFrame, key: Key, tokens_col: str = "tokens",
               max_tokens: Column | int | None = None, out_col: str = "ids") -> DataFrame:
    """Token arrays -> id arrays in the same order (no padding), one row per input row."""
    t = F.col(tokens_col)
    if max_tokens is not None:
        n = F.lit(max_tokens) if isinstance(max_tokens, int) else max_tokens
        t = F.slice(t, 1, n)
    key = as_list(key)
    ex = df.select(*key, F.posexplode_outer(t).alias("pos", "token"))
    looked = lookup_ids(ex, vocab)
    item = F.when(F.col("pos").isNotNull(), F.struct(F.col("pos"), F.col("token_id")))
    grouped = looked.groupBy(*key).agg(F.sort_array(F.collect_list(item)).alias("__s"))
    return grouped.select(*key, F.col("__s.token_id").alias(out_col))


def encode(df: DataFrame, vocab: DataFrame, key: Key, tokens_col: str = "tokens",
           length: int = 32, out_col: str = "input_ids", pad_id: int = PAD_ID) -> DataFrame:
    """Ids right-padded with ``<pad>`` / truncated to exactly ``length``."""
    enc = encode_ids(df, vocab, key, tokens_col, length, "__ids")
    return enc.select(*as_list(key), pad_to(F.col("__ids"), length, pad_id).alias(out_col))


def encode_to_longest(df: DataFrame, vocab: DataFrame, key: Key,
                      tokens_col: str = "tokens", length: int = 32,
                      out_col: str = "input_ids", pad_id: int = PAD_ID) -> DataFrame:
    """Pad to the longest list, then cut to ``length``: width = min(longest, length).

    The ids of the first ``length`` tokens are computed once and stored;
    the longest of them is exactly min(longest list, length), so the width is
    a scalar over the stored ids and the text is not tokenized a second time.
    """
    enc = materialize(encode_ids(df, vocab, key, tokens_col, length, "__ids"))
    width = F.coalesce(enc.agg(F.max(F.size("__ids")).alias("m")).select("m").scalar(), F.lit(0))
    return enc.select(*as_list(key), pad_to(F.col("__ids"), width, pad_id).alias(out_col))


def with_mask(df: DataFrame, ids_col: str = "input_ids", out_col: str = "attention_mask",
              pad_id: int = PAD_ID) -> DataFrame:
    """Validity mask, 1 where id != pad."""
    return df.withColumn(out_col, padding_mask(F.col(ids_col), pad_id))


def encode_framed(df: DataFrame, vocab: DataFrame, key: Key, text_col: str,
                  label_col: str, tokens_col: str = "tokens", length: int = 64,
                  start_id: int = 2, end_id: int = 3, pad_id: int = PAD_ID, sides: DataFrame | None = None) -> DataFrame:
    """[start] + body (cut to length-2) + [end], padded to ``length``, with mask.

    Output: key, struct(review_text, input_ids, attention_mask, labels). The
    vocabulary must reserve ``start_id`` / ``end_id`` among its specials. Text and label
    come from ``sides`` where given, else from ``df``, and are joined once to the ids.
    """
    key = as_list(key)
    body = encode_ids(df, vocab, key, tokens_col, length - 2, "__ids")
    framed = F.concat(F.array(F.lit(start_id).cast("long")), F.col("__ids"),
                      F.array(F.lit(end_id).cast("long")))
    enc = body.select(*key, pad_to(framed, length, pad_id).alias("input_ids"))
    enc = with_mask(enc, "input_ids", "attention_mask", pad_id)
    side = (df if sides is None else sides).select(*key, F.col(text_col).alias("review_text"), F.col(label_col).alias("labels"))
    return enc.join(side, key).select(
        *key, F.struct("review_text", "input_ids", "attention_mask", "labels").alias("example"))


def assemble_examples(encoded: DataFrame, reviews: DataFrame, key: Key,
                      star_col: str = "star", rule: str = "canonical",
                      check: bool = True) -> DataFrame:
    """E5: (key, input_ids, label) with the star-range (P6) and alignment (P7) checks.

    Both checks are observed while the full outer join of ids and stars is stored, so nothing is scanned for them alone
    and the encoding is computed once. The matched rows are returned.
    """
    key = as_list(key)
    if not check:
        lab = reviews.select(*key, sentiment(F.col(star_col), rule).alias("label"))
        return encoded.join(lab, key)
    lab = reviews.select(*key, F.col(star_col).alias("__star"), F.lit(True).alias("__r"))
    both, seen = observed.store_observed(
        encoded.withColumn("__l", F.lit(True)).join(lab, key, "full_outer"),
        {**observed.range_measures("__star"), **observed.alignment_measures("__l", "__r")})
    observed.check_range(seen)
    observed.check_alignment(seen)
    return both.select(*encoded.columns, sentiment(F.col("__star"), rule).alias("label"))


def row_counts(df: DataFrame, by: Sequence[str], tokens_col: str, out_col: str) -> DataFrame:
    """(by..., token, ``out_col``): how often each token occurs in a row; a row without tokens has one null token.

    The token arrays are shuffled once, dealt by ``by``. Counting by (by, token), and by ``by`` again after a broadcast join,
    needs no further shuffle: a row crosses the network as an array and never as one record per token.
    """
    dealt = df.select(*by, F.col(tokens_col).alias("__t")).repartition(*by)
    return dealt.select(*by, F.explode_outer("__t").alias("token")).groupBy(*by, "token").agg(F.count(F.lit(1)).alias(out_col))


def vocabulary_counts(df: DataFrame, vocab: DataFrame, key: Key, tokens_col: str = "tokens", keep: Sequence[str] = (),
                      unk_id: int = UNK_ID) -> DataFrame:
    """(key, keep..., size, indices, values): how often each vocabulary id occurs in a row, by id.

    ``size`` is the vocabulary's (A7). Unknown tokens count for ``unk_id``; a row without tokens has no entries. Tokens are
    counted by row before the look-up, so a row brings each distinct token once. Rows are told apart by key and ``keep``.
    """
    by = [*as_list(key), *keep]
    size = vocab.agg(F.coalesce(F.max("token_id") + 1, F.lit(0)).cast("int").alias("n")).select("n").scalar()
    counted = row_counts(df, by, tokens_col, "__c")
    found = lookup_ids(counted, vocab, unk_id=unk_id).groupBy(*by, "token_id").agg(F.sum("__c").alias("__c"))
    pair = F.when(F.col("token_id").isNotNull(), F.struct(F.col("token_id").cast("int").alias("i"), F.col("__c").cast("double").alias("v")))
    grouped = found.groupBy(*by).agg(F.sort_array(F.collect_list(pair)).alias("__p"))
    return grouped.select(*by, size.alias("size"), F.col("__p.i").alias("indices"), F.col("__p.v").alias("values"))


def vocabulary_vectors(df: DataFrame, vocab: DataFrame, key: Key, tokens_col: str = "tokens", keep: Sequence[str] = (),
                       out_col: str = "features") -> DataFrame:
    """(key, keep..., features): :func:`vocabulary_counts` as Spark ML sparse vectors, stored.

    The table is written with the vectors' storage layout and read as vectors, so that no Python worker and no vocabulary on
    the driver is needed. There are no slots to collide in: a feature is a vocabulary id.
    """
    from pyspark.ml.linalg import VectorUDT

    counts = vocabulary_counts(df, vocab, key, tokens_col, keep)
    by = [*as_list(key), *keep]
    sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), F.col("size"), F.col("indices"), F.col("values"))
    path = scratch_path(df.sparkSession, "vectors")
    stored = counts.select(*by, sparse.alias(out_col))
    stored.write.parquet(path)
    schema = T.StructType([*(stored.schema[c] for c in by), T.StructField(out_col, VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)


def mean_vectors(encoded: DataFrame, vectors: DataFrame, key: Key,
                 ids_col: str = "input_ids", dim: int = 64, include_pad: bool = True,
                 pad_id: int = PAD_ID, vec_key: Callable[[Column], Column] | None = None) -> DataFrame:
    """Mean of token vectors over positions.

    ``vectors`` has (vec_key, vec array<float>) and should be size-checked for
    broadcast by the caller; ``vec_key`` maps a token id to its ``vec_key``
    (identity by default). ``include_pad=True`` averages over every position,
    pads included (the reference's mean has no mask); ``False`` averages over
    non-pad positions. Positions are counted per (review, vector) first, so a review
    brings one row per distinct token to the join, not one per position; the
    per-dimension sums are plain ``sum`` aggregates (partial before the shuffle).
    """
    key = as_list(key)
    ex = encoded.select(*key, F.posexplode(ids_col).alias("pos", "token_id"))
    if not include_pad:
        ex = ex.filter(F.col("token_id") != pad_id)
    ex = ex.select(*key, (vec_key(F.col("token_id")) if vec_key else F.col("token_id")).alias("vec_key"))
    counted = ex.groupBy(*key, "vec_key").agg(F.count(F.lit(1)).alias("__c"))
    j = counted.join(vectors, "vec_key")
    aggs = [F.sum(F.get(F.col("vec"), i).cast("double") * F.col("__c")).alias(f"__s{i}") for i in range(dim)]
    aggs.append(F.sum("__c").alias("__n"))
    g = j.groupBy(*key).agg(*aggs)
    return g.select(*key, F.array(*[F.col(f"__s{i}") / F.col("__n") for i in range(dim)])
                    .alias("mean_vec"))
