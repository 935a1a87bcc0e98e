"""Stop lists (S3, K4) and the built-in list used with the driver tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewkit.functions.text import WS_CHARS

# --- fixed values: built-in stop list for the four driver languages -----------
# Frequent function words of English, French, German and Spanish, lower case.
BUILTIN_STOPWORDS = """
a an and are as at be but by for from has have he her his i in is it its of on or
she that the their them there they this to was were which with you your
au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais
ne nous on ou par pas pour qui que sa se ses son sur un une vous
aber auch auf aus bei das dem den der des die du ein eine einem einen einer es für
hat ich im ist mit nicht noch nur sich sie sind und von war wie wir zu zum zur
al como con del el ella ellos era es esta este las lo los mas mi muy no para pero
por se su sus una uno y ya
""".split()
# -----------------------------------------------------------------------------


def builtin_stopwords() -> list[str]:
    """Distinct built-in stop words, in the order written above."""
    return list(dict.fromkeys(BUILTIN_STOPWORDS))


def stopword_table(spark: SparkSession, words: Iterable[str] | None = None) -> DataFrame:
    """One-column table ``word`` from a literal list (default: the built-in list)."""
    words = builtin_stopwords() if words is None else list(dict.fromkeys(words))
    return spark.createDataFrame([(w,) for w in words], "word string")


def read_stopword_files(spark: SparkSession, paths: Sequence[str],
                        keep: Iterable[str] = ()) -> DataFrame:
    """S3 + K4: read text files (one word per line), strip each line, union, distinct.

    Blank lines give the empty string, as ``line.strip()`` does. ``keep`` lists
    words that must stay in the text (stop lists hold sentiment words such as
    negations); they are subtracted from the set.
    """
    lines = spark.read.text(list(paths))
    words = lines.select(F.btrim(F.col("value"), F.lit(WS_CHARS)).alias("word")).distinct()
    keep = list(keep)
    if keep:
        words = words.join(spark.createDataFrame([(k,) for k in keep], "word string"),
                           "word", "left_anti")
    return words
