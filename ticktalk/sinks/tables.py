"""Catalog tables with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery


def create_tables(spark: SparkSession, database: str, tables: dict[str, T.StructType], location: str | None = None) -> None:
    """The database and its tables, where they are not there yet."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, schema in tables.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def append_typed(df: DataFrame, table: str, schema: T.StructType, checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery | None:
    """Append in the declared columns and types; the table is made if missing, and a row that does not fit fails."""
    typed = df.to(schema)
    if not df.isStreaming:
        typed.write.mode("append").format("parquet").saveAsTable(table)
        return None
    writer = typed.writeStream.option("checkpointLocation", checkpoint).format("parquet")
    return writer.trigger(**(trigger or {"availableNow": True})).toTable(table)


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append one micro-batch to files; a replay of the batch replaces what it wrote before."""
    rows = df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
    rows.write.partitionBy("batch_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
