"""File writers. Rewrites touch only the partitions they bring rows for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ticktalk.functions.messages import shard_of
from ticktalk.functions.times import HOUR_PARTS, path_parts, with_hour_parts
from ticktalk.sources.files import CSV
from ticktalk.streaming.windows import window_start

# Folders of landed messages. Minute and shard stay columns: a folder for each would make files of a few rows, and
# opening files would then cost more than writing rows. Pass SHARD_PARTS where other readers rely on such folders.
HOUR_FOLDERS = ("date", "hour")
SHARD_PARTS = ("date", "hour", "minute", "shard")

# Microseconds, which the default text forms cut off.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _evened(df: DataFrame, *columns: str) -> DataFrame:
    """Gather the rows of a partition before writing it; Spark splits partitions that turn out too large."""
    return df.hint("rebalance", *columns)


def _replace_partitions(df: DataFrame, *columns: str):
    return _evened(df, *columns).write.partitionBy(*columns).mode("overwrite").option("partitionOverwriteMode", "dynamic")


def with_shard_parts(
    df: DataFrame, published: str = "publish_time", key: Column | str = "message_id", minutes: float = 1.0, shards: int = 3
) -> DataFrame:
    """Add the place of a message: window start as date, hour and minute, and a shard number."""
    start = window_start(published, minutes)
    return df.withColumns(path_parts(start) | {"shard": shard_of(key, shards)})


def write_shards(
    df: DataFrame,
    path: str,
    published: str = "publish_time",
    key: Column | str = "message_id",
    minutes: float = 1.0,
    shards: int = 3,
    folders: tuple[str, ...] = HOUR_FOLDERS,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery | None:
    """JSON lines with the window and shard of every message, without the publish time. Streams are written as they
    come: the window is a plain column, so that no late row is dropped and no window is gathered in memory."""
    laid_out = with_shard_parts(df, published, key, minutes, shards).drop(published)
    if not df.isStreaming:
        _replace_partitions(laid_out, *folders).options(**JSON_TIMES).json(path)
        return None
    writer = laid_out.writeStream.partitionBy(*folders).format("json").options(**JSON_TIMES).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def write_hourly_parquet(df: DataFrame, path: str, source: str, ts: str = "timestamp") -> None:
    """Snappy Parquet by source and hour; only the hours at hand are replaced, other sources stay."""
    laid_out = with_hour_parts(df, ts).withColumn("source", F.lit(source))
    _replace_partitions(laid_out, "source", *HOUR_PARTS).option("compression", "snappy").parquet(path)


def write_snapshot(df: DataFrame, path: str, taken_at: Column | None = None) -> None:
    """JSON of the whole batch below the date and hour it was taken; a rerun in the hour replaces it."""
    parts = path_parts(F.current_timestamp() if taken_at is None else taken_at)
    snapshot = df.withColumns({name: parts[name] for name in HOUR_FOLDERS})
    _replace_partitions(snapshot, *HOUR_FOLDERS).options(**JSON_TIMES).json(path)


def write_csv_table(df: DataFrame, path: str) -> None:
    """All values quoted; null is ``\\N``, so only a text of these two characters comes back changed."""
    df.write.mode("overwrite").options(**CSV).option("quoteAll", True).option("lineSep", "\n").csv(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One value per line."""
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def write_message_csv(df: DataFrame, column: str, path: str) -> None:
    write_csv_table(df.select(F.col(column).alias("Message")), path)


def write_centres(centres: DataFrame, path: str) -> None:
    centres.coalesce(1).write.mode("overwrite").json(path)


def append_with(df: DataFrame, format_name: str, **options) -> None:
    """Append through any connector. Convert ML vectors to arrays first."""
    df.write.format(format_name).options(**options).mode("append").save()
