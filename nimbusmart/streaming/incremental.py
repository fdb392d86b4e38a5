"""Incremental bronze feed with Structured Streaming.

The batch feed re-reads every weather file on each run. When daily files keep
arriving in a folder, the same bronze transformation can run as a stream over
that folder: each trigger processes only new files, the geo dimension is a
static side whose size is checked for each batch, and the
checkpoint under the shared checkpoint folder makes restarts and lost executors
resume exactly where the last committed batch ended. ``available_now`` drains
what is there and stops, so it can run from a scheduler like a batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nimbusmart.operators.geo import feed_bronze
from nimbusmart.session import checkpoint_dir
from nimbusmart.sinks.files import write_partitioned_parquet


# Files per micro-batch: at ~128 MB a file, about 128 GB per batch.
MAX_FILES_PER_TRIGGER = 1000


def weather_stream(
    spark: SparkSession, folder: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def start_bronze_stream(
    spark: SparkSession,
    weather_folder: str,
    weather_schema: T.StructType,
    cities: DataFrame,
    countries: DataFrame,
    out: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Start the stream: new weather files -> bronze rows under ``out``, a folder
    per batch, partitioned by year. Returns the running query.

    ``max_files_per_trigger`` bounds each micro-batch, also under
    ``availableNow``, which then drains a backlog as several committed batches:
    a failure re-runs one batch, not the whole backlog."""
    source = weather_stream(spark, weather_folder, weather_schema, max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The batch writer's layout, in a folder per batch: a batch that is run
        # again replaces what its first attempt left. The size of the static
        # side is checked anew for each batch.
        write_partitioned_parquet(feed_bronze(batch, cities, countries), f"{out}/batch={batch_id}", "year")

    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/bronze"
    writer = source.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def read_bronze_stream(spark: SparkSession, out: str) -> DataFrame:
    """What the stream has written so far."""
    return spark.read.parquet(out).drop("batch")
