"""Star rating -> sentiment class.

Three rules exist in the reference scripts; ``canonical`` is the one its README
states. The other two shift the star down by one before comparing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: class per star, per rule ----------------------------------
# canonical: 1-2 -> 0, 3 -> 1, 4-5 -> 2, anything else is an error
# shifted:   1-3 -> 0, 4 -> 1, 5 -> 2
# top_star:  1-4 -> 0, 5 -> 2 (class 1 is never produced)
# -----------------------------------------------------------------------------
RULES = ("canonical", "shifted", "top_star")


def sentiment(star: Column, rule: str = "canonical") -> Column:
    if rule == "canonical":
        return (F.when(star.between(1, 2), F.lit(0))
                .when(star == 3, F.lit(1))
                .when(star.between(4, 5), F.lit(2))
                .otherwise(F.raise_error(F.concat(F.lit("Unknown value! star="),
                                                  star.cast("string"))).cast("int")))
    s = star - 1
    if rule == "shifted":
        return F.when(s <= 2, F.lit(0)).when(s == 3, F.lit(1)).otherwise(F.lit(2))
    if rule == "top_star":
        return F.when(s <= 3, F.lit(0)).otherwise(F.lit(2))
    raise ValueError(f"unknown label rule {rule!r}; use one of {RULES}")


def sql_sentiment(star: str, rule: str = "canonical") -> str:
    if rule == "canonical":
        return (f"CASE WHEN {star} BETWEEN 1 AND 2 THEN 0 WHEN {star} = 3 THEN 1 "
                f"WHEN {star} BETWEEN 4 AND 5 THEN 2 ELSE error('Unknown value!') END")
    if rule == "shifted":
        return f"CASE WHEN {star} - 1 <= 2 THEN 0 WHEN {star} - 1 = 3 THEN 1 ELSE 2 END"
    return f"CASE WHEN {star} - 1 <= 3 THEN 0 ELSE 2 END"
