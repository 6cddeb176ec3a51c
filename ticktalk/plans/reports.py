"""The tables behind the dashboard and the exploratory notebooks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ticktalk.functions.messages import differs
from ticktalk.functions.vectors import cluster_from_text, list_from_text
from ticktalk.operators import clusters, mentions, picks, profile, runs
from ticktalk.session import settle

SAMPLE_COLUMNS = ("text", "username", "channel_name", "timestamp")


def price_line(quotes: DataFrame, without_symbol: str | None = None) -> DataFrame:
    """Quotes in order of time, test symbols left out; rows without a symbol stay."""
    kept = quotes if without_symbol is None else quotes.where(differs("symbol", without_symbol))
    return picks.sort_rows(kept, ["timestamp", "symbol", "price"])


def dashboard_tables(scored: DataFrame, quotes: DataFrame, without_symbol: str | None = None) -> dict[str, DataFrame]:
    """Everything the dashboard shows. ``scored`` holds embeddings and cluster numbers as text."""
    messages = scored.withColumns({"embedding": list_from_text("embedding"), "cluster": cluster_from_text("cluster")})
    return {
        "latent_space": clusters.latent_map(messages.where("embedding IS NOT NULL"), ["text", "username", "channel_name", "cluster"]),
        "price_line": price_line(quotes, without_symbol),
        "top_tickers": mentions.mention_leaderboard(messages),
        "example_messages": picks.random_sample(messages.select(*SAMPLE_COLUMNS), 10),
        "volume": profile.volume_kpi(messages),
    }


def price_changes(quotes: DataFrame, symbol: str | None = None, ts: str = "timestamp", price: str = "price", tie: str = "symbol", **size) -> DataFrame:
    kept = quotes if symbol is None else quotes.where(F.col("symbol") == symbol)
    return runs.gap_changes(kept, [ts, tie], ts, price, **size)


def price_report(quotes: DataFrame, symbol: str, tie: str = "price", bins: int = 100) -> dict[str, DataFrame]:
    """Daily statistics, and how price changes are spread: overall, per date, per price level, and after recent ones."""
    # Each table reads the changes again, so they are written once.
    changes = settle(price_changes(quotes, symbol, tie=tie).withColumn("date", F.to_date("timestamp")), "changes")
    moved = changes.where(differs("price_change", 0.0))
    levels = profile.with_equal_bins(changes, "price", 5)
    return {
        "daily": profile.daily_stats(changes),
        "summary": profile.describe(changes, "price_change"),
        "histogram": profile.histogram(changes, "price_change", bins),
        "per_date": profile.spread_per_group(changes, "price_change", ["date"]),
        "per_level": profile.spread_per_group(levels, "price_change", ["bin"]),
        "recent_mean": runs.moving_mean_before(moved, "price_change", "mean_before", ["timestamp", tie]),
    }


def message_report(messages: DataFrame) -> dict[str, DataFrame]:
    """Completeness, variety, bots, longest texts and text lengths; the last three without bots."""
    people = messages.where(~F.col("is_bot"))
    lengths = people.select(F.length("text").alias("text_length"))
    return {
        "nulls": profile.null_counts(messages),
        "distinct": profile.distinct_counts(messages),
        "bots": profile.true_share(messages, "is_bot"),
        "longest": picks.longest_texts(people),
        "lengths": profile.histogram(lengths, "text_length", 500),
        "top_tickers": mentions.mention_leaderboard(people),
    }
