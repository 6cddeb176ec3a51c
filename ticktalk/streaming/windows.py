"""Fixed windows over publish time. They start at multiples of their length since 1970."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticktalk.functions.messages import shard_of

WINDOW_MINUTES = 1.0
SHARDS = 3


def fixed_window(published: Column | str, minutes: float = WINDOW_MINUTES) -> Column:
    return F.window(published, f"{int(minutes * 60)} seconds")


def window_start(published: str, minutes: float = WINDOW_MINUTES) -> Column:
    """Start of the row's window as a plain, stateless column."""
    seconds = F.unix_seconds(F.col(published).cast("timestamp"))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(int(minutes * 60))))


def window_shards(
    df: DataFrame,
    key: Column | str,
    published: str = "publish_time",
    minutes: float = WINDOW_MINUTES,
    shards: int = SHARDS,
    delay: str = "0 seconds",
) -> DataFrame:
    """Size and time span of every (window, shard) batch. The batches themselves are files: see ``write_shards``.

    Streams keep state only until the watermark, ``delay`` behind the newest publish time, passes the window.
    """
    marked = df.withWatermark(published, delay) if df.isStreaming else df
    return (
        marked.groupBy(fixed_window(published, minutes).alias("window"), shard_of(key, shards).alias("shard"))
        .agg(F.count("*").alias("messages"), F.min(published).alias("first"), F.max(published).alias("last"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "shard", "messages", "first", "last")
    )


def drop_redelivered(df: DataFrame, key: str = "message_id", published: str = "publish_time", within: str = "10 minutes") -> DataFrame:
    """One row per key among deliveries less than ``within`` apart; in batch, one row per key."""
    if not df.isStreaming:
        return df.dropDuplicates([key])
    return df.withWatermark(published, within).dropDuplicatesWithinWatermark([key])
