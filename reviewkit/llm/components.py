"""Connected components of an edge table, by alternating star contraction.

Each round makes every node point to smaller neighbours only: the large-star
step links a node's larger neighbours to its smallest one, the small-star step
links a node and its smaller neighbours to the smallest. Both are one grouped
minimum (combined before the shuffle) and one join on the node, whose hot
partitions adaptive execution splits; rows never exceed twice the edges. The
number of rounds grows with the logarithm of the longest path. Edges of a round
are written to the shared folder, which cuts the lineage and survives lost
executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewkit.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet in the shared folder, and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _star(links: DataFrame) -> DataFrame:
    """Stored links (u, v) -> (u, v, smallest of u's v and u).

    The minima are stored, so that both sides of the join are plain shuffles and adaptive execution can split a hub.
    """
    least = stored(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    return (links.join(least, "u")
            .select("u", "v", F.least("u", "m").alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """Undirected ``edges(u, v)`` -> ``(node, component)``, component = smallest node.

    Nodes that only occur in self links are left out; null ends are ignored.
    Repeated edges and both directions of an edge are allowed. Empty edges give
    an empty table.
    """
    now = stored(edges.where("u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large")
        small = _star(large)
        now = stored(small.select("u", F.col("m").alias("v"))
                     .union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
                     .where("u <> v").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
