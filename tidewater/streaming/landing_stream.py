"""Incremental landing ingestion with Structured Streaming.

A file stream over the landing directory lists new ``yellow_tripdata_*``
files (paths only; ``binaryFile`` content is pruned away). Each micro-batch
hands its file paths to the batch ingest, which still skips months already
done and writes quarantine → Bronze → run-log. The stream's checkpoint
records which files were offered, so a restarted run continues where it
stopped; the ingest's dynamic partition overwrite makes a replayed
micro-batch harmless.

``available_now=True`` processes everything that has landed and stops (the
scheduled-job mode); otherwise the stream polls ``processing_time``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.plans import bronze
from tidewater.plans.common import LakePaths
from tidewater.schemas import LANDING_GLOB
from tidewater.sources.landing import LandingFile, parse_period


# The binaryFile source's fixed layout (a stream source needs it up front).
BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)


@dataclass
class StreamProgress:
    """Counters and the last batch: as large after a year of polling as at the
    start."""

    batches: int = 0
    files: int = 0
    records_processed: int = 0
    last: bronze.IngestResult | None = None

    def add(self, result: bronze.IngestResult) -> None:
        self.batches += 1
        self.files += result.landing_files
        self.records_processed += result.records_processed
        self.last = result


def landing_file_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", LANDING_GLOB)
        .option("recursiveFileLookup", "false")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing_dir).select("path")


def ingest_stream(
    spark: SparkSession,
    paths: LakePaths,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = 1000,
    dedup: bool = False,
):
    """Start the stream; returns (query, progress). With ``available_now`` the
    caller can ``query.awaitTermination()`` for a run-to-completion job."""
    progress = StreamProgress()

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # one row per new file (bounded by maxFilesPerTrigger), not per trip
        files = []
        for row in batch.collect():
            year, month = parse_period(row.path.rsplit("/", 1)[-1])
            files.append(LandingFile(row.path, year, month))
        if files:
            session = batch.sparkSession
            progress.add(bronze.ingest_files(session, files, paths, dedup=dedup))

    writer = landing_file_stream(spark, paths.landing, max_files_per_trigger).writeStream.foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start(), progress
