"""Joins with small dimensions and between keyed tables, and the latest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ticktalk.operators.runs import last_of_groups
from ticktalk.session import settle

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SALTS = 64


def measured(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """Rows, and bytes as JSON text. Sizes are taken only if there are at most ``max_rows`` rows."""
    rows = df.count()
    if rows > max_rows:
        return rows, -1
    return rows, df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()[0]


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if counting shows that it is small; else as it was, for a shuffle join."""
    rows, size = measured(df, max_rows)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def in_channels(df: DataFrame, channels: DataFrame, key: str = "channel_id") -> DataFrame:
    """Rows whose channel is listed."""
    return df.join(small_side(channels.select(key)), key, "left_semi")


def with_details(df: DataFrame, details: DataFrame, key: str = "channel_id") -> DataFrame:
    """Add the columns of a dimension, NULL where the key is unknown."""
    return df.join(small_side(details), key, "left")


def join_complete(left: DataFrame, right: DataFrame, key: str = "message_id") -> DataFrame:
    """Left join, then only rows without any null: the same as an inner join of complete rows."""
    return left.dropna("any").join(right.dropna("any"), key)


def latest_per_channel(df: DataFrame, channel: str, order: Sequence[str], n: int = 10, salts: int | None = None) -> DataFrame:
    """The last ``n`` rows of each channel.

    Up to the number of rows that Spark's own limit per group takes (``spark.sql.optimizer.windowGroupLimitThreshold``), each
    task cuts its rows to ``n`` per channel before the shuffle. For more, or with ``salts``, rows of a channel are dealt over
    ``salts`` parts by a hash, every part cuts its own to ``n``, and the parts of a channel are then ranked along runs of its
    order, so that neither step puts a hot channel into one task.
    """
    newest = Window.partitionBy(channel).orderBy(*[F.desc(c) for c in order])
    few = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= few and salts is None:
        return df.withColumn("__n", F.row_number().over(newest)).where(F.col("__n") <= n).drop("__n")
    salt = F.pmod(F.xxhash64(*order), F.lit(salts or SALTS))
    part = Window.partitionBy(channel, "__salt").orderBy(*[F.desc(c) for c in order])
    cut = df.withColumn("__salt", salt).withColumn("__n", F.row_number().over(part)).where(F.col("__n") <= n).drop("__n", "__salt")
    return last_of_groups(settle(cut, "channel-parts"), channel, order, n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, all columns. Tasks reduce their own rows before the shuffle."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")
    return df.groupBy(*keys).agg(last).select(*[F.col(c) if c in keys else F.col("__r")[c].alias(c) for c in df.columns])
