"""S1 + S3 as a stream: new JSON-lines files -> bronze Parquet, once each."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.session import CODEC
from starloom.sources.bronze import normalize_columns, stamp_ingestion


def source_schema(names: list[str]) -> T.StructType:
    """File streams need a schema up front: every field as text, as bronze keeps it."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def ingest_sales_files(spark: SparkSession, source_dir: str, bronze_path: str,
                       checkpoint_path: str, names: list[str],
                       max_files_per_trigger: int | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Append every JSON-lines file that appears under ``source_dir`` to the
    bronze Parquet folder, stamped with its ingestion time.

    The checkpoint records which files were taken, so a restart (or a lost
    executor) neither skips nor repeats a file.  ``available_now`` processes
    what is there and stops; otherwise the query keeps running.
    """
    # a malformed line stops the stream instead of becoming a row of NULLs
    reader = spark.readStream.schema(source_schema(names)).option("primitivesAsString", True) \
        .option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = stamp_ingestion(normalize_columns(reader.json(source_dir)))
    writer = (stream.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint_path)
              .option("compression", CODEC)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start(bronze_path)
