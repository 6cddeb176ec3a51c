"""Message streams: ``value BINARY, publish_time TIMESTAMP`` whatever the transport."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def message_stream(
    spark: SparkSession,
    transport: str,
    path: str | None = None,
    schema: T.StructType | None = None,
    payload: str | Column = "value",
    published: str | Column = "timestamp",
    **options,
) -> DataFrame:
    """A stream of payloads from any streaming format: ``kafka`` as it is, files with a schema and column names."""
    reader = spark.readStream.format(transport).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path) if path else reader.load()
    payload = F.col(payload) if isinstance(payload, str) else payload
    published = F.col(published) if isinstance(published, str) else published
    return rows.select(payload.cast("binary").alias("value"), published.cast("timestamp").alias("publish_time"))


def table_stream(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of files."""
    one = path.rstrip("/")
    return spark.readStream.schema(schema).options(**options).parquet(f"{one[:-1]}[{one[-1]}]")
