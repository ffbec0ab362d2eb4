"""The stateless jobs on a folder that keeps receiving files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

Job = Callable[[DataFrame], DataFrame]


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    kind: str = "parquet",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """New files of a folder or glob as a stream; the schema is fixed."""
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def run_stream(
    stream: DataFrame,
    job: Job,
    path: str,
    checkpoint: str,
    kind: str = "parquet",
    partition_by: Sequence[str] = (),
    continuous_every: str | None = None,
) -> StreamingQuery:
    """Apply a job to a stream and append the result to files.

    Every job of the package that is one projection works here unchanged.  Roles
    of columns cannot be detected on a stream, so they are given by the job.
    Without ``continuous_every`` all present files are processed, then it stops.
    """
    writer = job(stream).writeStream.format(kind).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if continuous_every:
        return writer.trigger(processingTime=continuous_every).start()
    return writer.trigger(availableNow=True).start()


def drop_stream_duplicates(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str
) -> DataFrame:
    """Rows seen before within the delay are dropped; state is bounded by it.

    A watermark needs a time with a zone; a local time is read in the session's.
    """
    stream = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def drop_repeated_arrivals(stream: DataFrame, keys: Sequence[str], time_to_live: str) -> DataFrame:
    """Rows whose keys arrived before are dropped, for streams without a time of their own.

    A key is remembered for ``time_to_live`` after the micro-batch that first
    brought it and then forgotten, so the state holds the keys of that span and
    no more.  Null keys are equal to each other.
    """
    arrived = "_arrived"
    while arrived in stream.columns:
        arrived += "_"
    # The time of the micro-batch, which is fixed when a batch is run again.
    stamped = stream.withColumn(arrived, F.current_timestamp()).withWatermark(arrived, time_to_live)
    return stamped.dropDuplicatesWithinWatermark(list(keys)).drop(arrived)
