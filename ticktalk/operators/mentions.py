"""Mentions found in text by a pattern, and the leaderboard of the most mentioned ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ticktalk.functions.messages import TICKER


def extract_mentions(df: DataFrame, keep: Sequence[str] = (), text: str = "text", pattern: str = TICKER, out: str = "ticker") -> DataFrame:
    """One row per match, upper-cased, with the ``keep`` columns of its message."""
    return df.select(*keep, F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("__m")).select(
        *keep, F.upper("__m").alias(out)
    )


def mention_totals(df: DataFrame, text: str = "text", channel: str = "channel_id", pattern: str = TICKER, approximate: bool = False) -> DataFrame:
    """Per ticker: all mentions, and the channels that mention it."""
    channels = F.approx_count_distinct(channel) if approximate else F.count_distinct(channel)
    return (
        extract_mentions(df, [channel], text, pattern)
        .groupBy("ticker")
        .agg(F.count("*").alias("total_mentions"), channels.alias("unique_channel_count"))
    )


def mention_leaderboard(df: DataFrame, text: str = "text", channel: str = "channel_id", pattern: str = TICKER, top: int = 20, approximate: bool = False) -> DataFrame:
    totals = mention_totals(df, text, channel, pattern, approximate)
    return totals.orderBy(F.desc("total_mentions"), "ticker").limit(top)


def value_counts(df: DataFrame, column: str, out: str = "count") -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(out)).orderBy(F.desc(out), column)
