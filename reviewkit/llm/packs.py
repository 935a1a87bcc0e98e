"""Packs of documents and the bucket exchange.

Operators that look up something for every word or window of the corpus would
move one row per word. Instead documents are dealt into *packs* of a few MB of
text; a pack sends, for each *bucket* of the hash space, one packed array of its
distinct keys (so a key moves once per pack, however often it occurs), the bucket
side compares the packs' arrays, and answers each array with one aligned array.
The pack then reads its documents again through the same shuffle and applies the
answers. A key that is in every document costs one entry per pack.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text bytes a pack aims at.
PACK_BYTES = 8_000_000
#: Quantile ranges of ordered packs, at most.
RANGES = 4096


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pack_count(docs: DataFrame, text: str, pack_bytes: int = PACK_BYTES) -> int:
    """Packs for all text at ``pack_bytes``, and at least two per shuffle partition."""
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(math.ceil(total / pack_bytes), 2 * shuffle_partitions(docs), 1)


def hashed_pack(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def ordered_pack(docs: DataFrame, key: str, n: int, ranges: int = RANGES) -> Column:
    """Pack number by range of ``key``: a smaller key never lies in a later pack.

    Approximate quantiles over all rows cut the keys into at most ``ranges`` ranges of
    even size, whatever the ids (that many numbers on the driver); where more packs are
    wanted, a range is cut further into equal widths. Null keys get the pack ``n``.
    """
    ranges = min(n, ranges)
    at = docs.select(F.percentile_approx(key, [i / ranges for i in range(ranges + 1)], 20 * ranges)).first()[0]
    bounds = np.unique(np.array(at or [0], np.int64))
    parts = n // ranges

    @F.pandas_udf("int")
    def pack(ids: pd.Series) -> pd.Series:
        out = np.full(len(ids), n, np.int32)
        ok = ids.notna().to_numpy()
        x = ids[ok].to_numpy(np.int64)
        # The range of the first bound that is not below the id; the first and last range are open.
        r = np.clip(np.searchsorted(bounds, x, side="left") - 1, 0, max(len(bounds) - 2, 0))
        if parts == 1 or len(bounds) < 2:
            out[ok] = r * parts
        else:
            low, high = bounds[r].astype(np.float64), bounds[r + 1].astype(np.float64)
            inside = np.clip(((x - low) / (high - low) * parts).astype(np.int64), 0, parts - 1)
            out[ok] = r * parts + inside
        return pd.Series(out)

    return pack(F.col(key))


def planes(a: np.ndarray) -> bytes:
    """Fixed-width numbers byte plane by byte plane; leading zero planes compress away."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


def unplanes(b: bytes, kind: type) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(wide, -1).T).view(kind).ravel()
