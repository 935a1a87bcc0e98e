"""S1 as a splittable scan: multi-line review CSV read in many tasks a file.

A quoted field may hold line breaks, so a line of the file need not be a record, and Spark's multi-line CSV scan
reads each file in one task. Here the file is scanned as plain lines, which splits anywhere, and records are put
together again from the quotes. A reader at the end of a line is either outside or inside a quoted field, so a line is a
function of these two states: it keeps the state, turns it (an odd number of quotes), or leads to one
state from both (a bare quote in an unquoted field may). Such functions are composed by prefix sums: the last
line that leads to one state, and the parity of the turns since.

1. Lines with their file, split and place, one task a split. Running sums compose the lines of the split; as its
   own first state is not known yet, both are followed, and the last line that begins a record is kept for both.
   The lines are stored with these numbers.
2. One row a split: its function and its last beginnings. The same composition over the splits of a file gives the state in which
   each one starts and the record that runs into it. A few numbers a split are the only data that one task sees of a whole file.
3. A line that begins a record and ends outside quotes is the whole record and moves no more. Only the lines of
   records that span lines are grouped and joined, so one shuffle carries the texts and a second only those records.
4. Each record is parsed by Spark's own CSV expression with the declared schema.

A field is quoted when its first character is a quote; a doubled quote inside is a quote, and what follows the closing
quote runs to the next comma. A quote that is opened and never closed takes the rest of its file, as in any CSV reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewkit.operators.joins import checked_broadcast, materialize
from reviewkit.sources.reviews_csv import CORRUPT, null_tokens

_SPLIT = ("file", "split")
# A line, read from outside quotes, that ends inside: whole fields with their commas, then a quote that is not closed.
# The quantifiers give nothing back, so a long line takes linear time and no stack.
_QUOTED = '"(?:[^"]++|"")*+'
_OPEN = rf'(?s)\A(?:{_QUOTED}"[^,]*+,|[^",][^,]*+,|,)*+{_QUOTED}\z'


def _ends_inside(line: Column) -> Column:
    return F.when(F.contains(line, F.lit('"')), line.rlike(_OPEN)).otherwise(False).cast("int")


def _composed(rows: DataFrame, part: Sequence[str], order: str) -> DataFrame:
    """Adds from_out and from_in: the state before each row if its group starts outside or inside quotes (1: inside).

    ``rows`` carry their function as to_out (the state it leads to from outside) and to_in (from inside).
    """
    past = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.when((F.col("to_out") == 1) & (F.col("to_in") == 0), 1).otherwise(0)
    rows = rows.withColumn("turns", F.coalesce(F.sum(turns).over(past), F.lit(0)))
    one = F.when(F.col("to_out") == F.col("to_in"), F.struct("to_out", "turns"))
    rows = rows.withColumn("fixed", F.last(one, ignorenulls=True).over(past))
    known = (F.col("fixed.to_out") + F.col("turns") - F.col("fixed.turns")) % 2
    return rows.withColumn("from_out", F.coalesce(known, F.col("turns") % 2).cast("int")) \
        .withColumn("from_in", F.coalesce(known, (F.col("turns") + 1) % 2).cast("int")).drop("turns", "fixed")


def _numbered_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, split, at, line, to_out, to_in, from_out, from_in, begin_out, begin_in), stored.

    ``at`` orders the lines of a split. ``begin_out`` and ``begin_in`` are the last line up to this one that begins a
    record if the split starts outside or inside quotes.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    # A line read from inside quotes is that line behind an opening quote.
    quoted = F.contains("line", F.lit('"'))
    lines = lines.withColumn("to_out", _ends_inside(F.col("line"))).withColumn(
        "to_in", F.when(quoted, _ends_inside(F.concat(F.lit('"'), F.col("line")))).otherwise(1))
    composed = _composed(lines, _SPLIT, "at")
    upto = Window.partitionBy(*_SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for start in ("out", "in"):
        composed = composed.withColumn(f"begin_{start}", F.max(F.when(F.col(f"from_{start}") == 0, F.col("at"))).over(upto))
    return materialize(composed)


def _split_states(lines: DataFrame) -> DataFrame:
    """(file, split, state, carried, header): the state in which each split starts (1: inside quotes); one row a split.

    ``carried`` is the record that runs into the split, ``header`` the first line of the file that is not empty.
    """
    blank = F.col("line").isin("", "\r")

    def after(start: str) -> Column:
        return F.max_by(F.when(F.col(f"from_{start}") == 1, F.col("to_in")).otherwise(F.col("to_out")), "at")

    splits = lines.groupBy(*_SPLIT).agg(
        after("out").alias("to_out"), after("in").alias("to_in"), F.max("begin_out").alias("begin_out"),
        F.max("begin_in").alias("begin_in"), F.min(F.when(~blank, F.struct("split", "at"))).alias("first"))
    states = _composed(splits, ["file"], "split").withColumn("state", F.col("from_out"))
    last = F.when(F.col("state") == 0, F.col("begin_out")).otherwise(F.col("begin_in"))
    whole = Window.partitionBy("file")
    past = whole.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return states.withColumn("last", last).select(
        *_SPLIT, "state", F.last("last", ignorenulls=True).over(past).alias("carried"), F.min("first").over(whole)["at"].alias("header"))


def csv_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(record): the text of every record of the files but their header, line breaks inside quotes included.

    Empty lines between records are skipped, an empty file has no records, and a file whose last quote is never closed
    ends in one record. The header is the first line of each file that is not empty; a header of several lines counts as one
    record. A carriage return at the end of a record goes, others stay.
    """
    lines = _numbered_lines(spark, [paths] if isinstance(paths, str) else paths)
    states = checked_broadcast(_split_states(lines))
    begins = F.when(F.col("state") == 0, F.col("begin_out")).otherwise(F.col("begin_in"))
    placed = lines.join(states, list(_SPLIT)).withColumn("record_at", F.coalesce(begins, F.col("carried")))
    placed = placed.where(F.col("record_at") != F.col("header"))
    alone = (F.col("record_at") == F.col("at")) & (F.col("to_out") == 0)
    single = placed.where(alone).select(F.col("line").alias("record"))
    rest = placed.where(~alone).groupBy("file", "record_at").agg(
        F.array_sort(F.collect_list(F.struct("split", "at", "line"))).alias("parts"))
    joined = rest.select(F.array_join(F.col("parts.line"), "\n").alias("record"))
    records = single.unionByName(joined).select(F.regexp_replace("record", r"\r\z", "").alias("record"))
    return records.where(F.col("record") != "")


def read_reviews_split(spark: SparkSession, paths: str | Sequence[str], schema: StructType, pandas_na: bool = True,
                       keep_corrupt: bool = False) -> DataFrame:
    """The rows of ``read_reviews_csv`` by a scan that splits each file.

    Same parameters and same rows. The number of tasks follows ``spark.sql.files.maxPartitionBytes``.
    """
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())]) if keep_corrupt else schema
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": CORRUPT}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    parsed = csv_records(spark, paths).select(F.from_csv("record", ddl, options).alias("row"))
    rows = parsed.select(*[F.col("row")[f.name].alias(f.name) for f in full.fields])
    return null_tokens(rows) if pandas_na else rows
