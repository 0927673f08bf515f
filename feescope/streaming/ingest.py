"""Incremental cleaning: raw Parquet chunks -> cleaned zone, as a stream.

The extract step lands numbered Parquet chunks in the raw folder; this
Structured Streaming query applies exactly the batch cleaning operators to
each new file and appends to the date-partitioned cleaned zone.  The
checkpoint (file offsets + sink log) lives in the shared checkpoint folder,
so a restarted or relocated driver resumes without reprocessing or loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from feescope.config import DEFAULT_SPEC, ChainSpec
from feescope.operators.clean import clean
from feescope.sources.raw import RAW_SCHEMA


def raw_stream(spark: SparkSession, raw_dir: str, schema: T.StructType = RAW_SCHEMA,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """The raw folder as a stream of new files (explicit schema, no inference)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(raw_dir)


def start_clean_stream(
    spark: SparkSession,
    raw_dir: str,
    clean_dir: str,
    checkpoint_location: str,
    spec: ChainSpec = DEFAULT_SPEC,
    schema: T.StructType = RAW_SCHEMA,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental cleaning query.

    ``available_now`` processes everything present and stops (scheduled
    runs); otherwise it keeps running with the default micro-batch trigger.
    """
    cleaned = clean(raw_stream(spark, raw_dir, schema, max_files_per_trigger), spec)
    writer = (
        cleaned.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_location)
        .partitionBy("date")
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(clean_dir)
