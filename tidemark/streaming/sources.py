"""Streaming inputs.

``readStream`` over a directory of parquet/CSV files (Kafka is the
production drop-in: the same adapters apply to the parsed ``value``).
Watermarks need a TIMESTAMP (not TIMESTAMP_NTZ) column: ``event_time``
casts it; with the session zone at UTC the instant is unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def event_time(df: DataFrame, col: str = "ts", delay: str = "0 seconds") -> DataFrame:
    """Cast ``col`` to TIMESTAMP and declare the watermark ``max(col) - delay``."""
    return df.withColumn(col, F.col(col).cast("timestamp")).withWatermark(col, delay)
