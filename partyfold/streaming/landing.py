"""Incremental landing of feed files with Structured Streaming.

Upstream systems drop CSV files into a folder every day. A file-source
stream with ``trigger(availableNow=True)`` lands every file not landed
before, exactly once (the stream's checkpoint records which files were
taken), then stops: a batch job with streaming bookkeeping. The checkpoint
must sit in shared storage so a re-run after a lost driver or executor
resumes instead of landing files twice.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.landing import text_schema, typed_columns


def land_new_files(spark: SparkSession, feed: str, drop_dir: str, lake_path: str,
                   checkpoint_path: str, max_files_per_trigger: int | None = None) -> None:
    """Land all not-yet-landed CSV files of ``feed`` from ``drop_dir`` into the
    parquet lake at ``lake_path``. Rows are stamped with the micro-batch time.

    Streaming file sources need a fixed schema: the files carry the feed's
    columns in the documented order (``functions.fixed.CSV_COLUMNS``), and a file
    whose header says otherwise fails instead of landing in the wrong columns."""
    reader = spark.readStream.schema(text_schema(feed)).options(
        header="true", enforceSchema="false", multiLine="true", escape='"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(drop_dir)
    now = F.current_timestamp().cast("timestamp_ntz")
    landed = stream.select(*typed_columns(feed), now.alias("insert_datetime"), now.alias("update_datetime"))
    query = (landed.writeStream.format("parquet")
             .option("checkpointLocation", checkpoint_path)
             .outputMode("append")
             .trigger(availableNow=True)
             .start(lake_path))
    query.awaitTermination()
