"""Streaming scoring of arriving comments.

The reference reads one comment at a time from a console loop, tokenizes,
pads, scores and prints. Here comments arrive as files in a directory; a
Structured Streaming query applies the fitted ``PipelineModel`` (stateless, so
batch and stream results are equal) and appends scores to a parquet sink. The
checkpoint lives in the shared work folder, so a restarted query resumes where
it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def score_stream(spark: SparkSession, model: PipelineModel, source_dir: str, schema: StructType | str,
                 sink_dir: str, checkpoint_dir: str, keep: tuple[str, ...] = (),
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the scoring stream: parquet files in ``source_dir`` -> scores in ``sink_dir``."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_dir)
    scored = model.transform(src).select(
        *keep, vector_to_array("probability").alias("scores"),
        F.col("prediction").cast("int").alias("prediction"))
    w = (scored.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir).option("path", sink_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def score_stream_by_batch(spark: SparkSession, model: PipelineModel, source_dir: str, schema: StructType | str, sink_dir: str,
                          checkpoint_dir: str, keep: tuple[str, ...] = (), max_files_per_trigger: int | None = None,
                          after: Callable[[int], None] | None = None) -> StreamingQuery:
    """Like :func:`score_stream`, with a sink that any later writer or table format can take over: one folder per micro-batch.

    A batch replaces its own folder, ``batch=<id>``. The checkpoint fixes which files a batch id holds, so a batch that was
    written but not committed when the query stopped is written again by the restarted query and still counted once.
    ``after`` is called when a batch has been written (a hook for callers that publish it).
    """
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write(rows: DataFrame, batch: int) -> None:
        scored = model.transform(rows).select(*keep, vector_to_array("probability").alias("scores"),
                                              F.col("prediction").cast("int").alias("prediction"))
        scored.write.mode("overwrite").parquet(f"{sink_dir}/batch={batch}")
        if after:
            after(batch)

    return (reader.load(source_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def run_to_end(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query to drain its input; a timeout is the caller's choice."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError("stream did not finish in time")
    if query.exception():
        raise RuntimeError(str(query.exception()))


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.parquet(sink_dir)
