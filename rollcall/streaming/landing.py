"""Incremental ingest of newly landed snapshot files with Structured Streaming.

The file stream (``binaryFile`` with only the path selected, so contents are
not read by the stream itself) notices files not seen before and records
progress in its checkpoint. A micro-batch says that something new is there; what
is loaded is planned on the landing folder by the same rule as everywhere else,
in whole snapshots, whatever files the trigger's limit put into the batch. So a
rerun, a retried batch, a folder whose part files fall into several batches or a
second file for a loaded date loads nothing twice and loses nothing. By default the plan
sees the whole folder, so that the first name of a date wins; ``incremental`` plans on what
arrived, for landing folders too long to list again and again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.plans.ingest import load_landing


# The schema of Spark's binaryFile source.
BINARY_FILE_SCHEMA = ("path string, modificationTime timestamp, length bigint, content binary")


def _ingest_batch(spark: SparkSession, landing: str, store: str, ext: str, cluster_by: str | None, fmt: str, incremental: bool):
    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            load_landing(spark, landing, store, ext, fmt, cluster_by, batch if incremental else None)
    return run


def stream_new_snapshots(spark: SparkSession, landing_dir: str, store: str, checkpoint: str,
                         ext: str = ".csv", max_files_per_trigger: int | None = 1000,
                         cluster_by: str | None = "region_name", fmt: str = "csv", incremental: bool = False):
    """Start an ``availableNow`` stream that loads every not-yet-seen file in
    ``landing_dir`` into the raw store at ``store`` and then stops. Returns the
    StreamingQuery (call ``awaitTermination()``). With ``incremental`` a micro-batch
    plans on its own files' snapshots instead of the whole landing folder."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_dir).select("path")
    return (stream.writeStream.foreachBatch(_ingest_batch(spark, landing_dir, store, ext, cluster_by, fmt, incremental))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
