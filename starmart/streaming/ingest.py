"""Incremental ingest with Structured Streaming.

The reference reloads its whole CSV each time.  The same cleaning (T-1) can
run as a file-source stream: each new CSV file in a landing folder is parsed
by header name, cleaned, and appended to the staging parquet table;
the stream's checkpoint (in the shared folder) records which files are done,
so a restarted job neither skips nor repeats a file.  ``availableNow``
processes what is there and stops, which suits scheduled batch loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starmart.params import Params
from starmart.sources import csv_ingest


def staging_stream(spark: SparkSession, landing: str, params: Params,
                   max_files_per_trigger: int = 100) -> DataFrame:
    raw = (csv_ingest.csv_options(spark.readStream.schema(csv_ingest.text_schema(spark, landing)))
           .option("enforceSchema", False).option("columnNameOfCorruptRecord", csv_ingest.CORRUPT)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(landing))
    return csv_ingest.clean(csv_ingest.typed(csv_ingest.by_name(raw)), params)


def start_staging_load(spark: SparkSession, landing: str, target: str, checkpoint: str,
                       params: Params, available_now: bool = True) -> StreamingQuery:
    """Append cleaned lines of new files to the parquet table at ``target``."""
    w = (staging_stream(spark, landing, params).writeStream.format("parquet")
         .option("path", target).option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
