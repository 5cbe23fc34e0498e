"""File-triggered incremental landing with Structured Streaming.

A stream over the *listing* of a bronze folder (no file is opened) wakes up for files it has
not seen, and each micro-batch runs the incremental load of the dataset. What is pending is
decided by the load's own ledger (``ecoflux.plans.pipeline.load_series``), so a micro-batch that
is replayed, or that holds only part of a delivery, changes nothing: the stream says when to
load, never what. It has no cap on files and no age limit. A run processes everything pending
and stops, so it can be scheduled like a batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ecoflux.plans.pipeline import Lake, load_series
from ecoflux.sources import sinks
from ecoflux.sources.readers import PARQUET_GLOB

#: Longer than any file's age: the default of a week would skip late files for ever.
NO_AGE_LIMIT = "36500d"


def arrivals(spark: SparkSession, lake: Lake, ds: str) -> DataFrame:
    """Streaming listing (path, time, length) of a bronze folder."""
    files = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", PARQUET_GLOB)
    files = files.schema("path string, modificationTime timestamp, length long, content binary").option("maxFileAge", NO_AGE_LIMIT)
    return files.load(lake.src(ds)).select("path", "modificationTime", "length")


def land_series(spark: SparkSession, lake: Lake, ds: str, checkpoint: str | None = None) -> StreamingQuery:
    """Start an AvailableNow stream that lands new bronze files of ``ds`` into silver."""
    sinks.create_database(spark, lake.database, f"{lake.gold.rstrip('/')}/_database")

    def batch(new_files: DataFrame, batch_id: int) -> None:  # noqa: ARG001 - Spark callback
        load_series(spark, lake, ds)

    stream = arrivals(spark, lake, ds).writeStream.foreachBatch(batch)
    return stream.option("checkpointLocation", checkpoint or lake.state(f"streams/{ds}")).trigger(availableNow=True).start()


def land_series_now(spark: SparkSession, lake: Lake, ds: str, checkpoint: str | None = None) -> None:
    """Run :func:`land_series` to completion."""
    q = land_series(spark, lake, ds, checkpoint)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
