"""Incremental ingest of incident CSV drops into year-partitioned Parquet.

A file-source stream with a checkpoint: each new CSV file is parsed exactly
once, a restarted or failed run resumes from the checkpoint, and the output
is the same table :func:`cityscan.sources.csv.ingest_incidents` writes in
batch. ``availableNow`` processes what is there and stops, so it runs as a
scheduled job; ``processing_time`` keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cityscan.functions.clean import EVENT_TS_FORMAT
from cityscan.sources.csv import INCIDENT_SCHEMA, ingest_columns

_CORRUPT = "_corrupt_record"


def start_incident_ingest(
    spark: SparkSession,
    source_dir: str,
    out_path: str,
    checkpoint_location: str,
    ts_format: str = EVENT_TS_FORMAT,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; returns the running query (call ``awaitTermination``).

    ``checkpoint_location`` must be a fixed shared folder that belongs to this
    stream: a restart, also by another session, finds there which files are
    done. A folder that changes from session to session (such as one under
    ``SparkContext.getCheckpointDir()``) would lose files.
    """
    if not checkpoint_location:
        raise ValueError("checkpoint_location is required")
    reader = spark.readStream.schema(INCIDENT_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    parsed = ingest_columns(reader.csv(source_dir), ts_format)
    writer = (
        parsed.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_location)
        .partitionBy("year")
        .outputMode("append")
    )
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def write_batch(batch: DataFrame, batch_id: int, out_path: str, quarantine_path: str, ts_format: str = EVENT_TS_FORMAT) -> None:
    """One micro-batch: good rows to ``out_path``, rows with a cell that does not parse to ``quarantine_path``.

    Each batch has a folder of its own in both, which a rerun of the batch writes
    anew: a stream that stops between the two writes, or after both, repeats nothing and loses nothing.
    """
    good = batch.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT, "_file")
    ingest_columns(good, ts_format).write.mode("overwrite").partitionBy("year").parquet(f"{out_path}/batch_id={batch_id}")
    # all columns are kept, since the reader finds bad cells only in those it is asked for
    bad = batch.where(F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("line"), F.col("_file").alias("file"), F.struct(
        *[F.col(f"`{f.name}`") for f in INCIDENT_SCHEMA.fields]).alias("parsed"))
    bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")


def start_incident_ingest_checked(
    spark: SparkSession,
    source_dir: str,
    out_path: str,
    quarantine_path: str,
    checkpoint_location: str,
    ts_format: str = EVENT_TS_FORMAT,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """:func:`start_incident_ingest` with bad rows kept apart: the whole line, its file and what did parse.

    Both tables have a ``batch_id`` column from their folders.
    """
    if not checkpoint_location:
        raise ValueError("checkpoint_location is required")
    schema = T.StructType([*INCIDENT_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = (spark.readStream.schema(schema).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", _CORRUPT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(source_dir).select("*", F.col("_metadata.file_path").alias("_file"))
    writer = rows.writeStream.option("checkpointLocation", checkpoint_location).foreachBatch(
        lambda batch, batch_id: write_batch(batch, batch_id, out_path, quarantine_path, ts_format))
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
