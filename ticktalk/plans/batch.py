"""The batch jobs: raw JSON to hourly Parquet with prices, and embeddings to clusters and centres."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticktalk.functions.messages import BOT_TAGS, bot_flag, lacks_tags, one_line, price_of
from ticktalk.functions.times import parse_time
from ticktalk.operators.asof import asof_join, split_untimed
from ticktalk.operators.clusters import CLUSTERS, EMBEDDING_WIDTH, centres_of, clean_embeddings, fit_clusters
from ticktalk.operators.picks import newest_rows, sort_rows
from ticktalk.operators.runs import drop_repeats, fill_forward
from ticktalk.schemas import MESSAGE_WIRE, QUOTE_WIRE
from ticktalk.session import settle
from ticktalk.sinks.files import write_centres, write_csv_table, write_hourly_parquet, write_message_csv
from ticktalk.sources.files import read_drifting_parquet, read_json_tree


def prepare_messages(raw: DataFrame, strict_flag: bool = True) -> DataFrame:
    """Times parsed, bot flag as 0 or 1, names dropped."""
    return raw.withColumns({"timestamp": parse_time("timestamp"), "is_bot": bot_flag("is_bot", strict_flag)}).drop("first_name", "last_name")


def prepare_quotes(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"timestamp": parse_time("timestamp"), "price": price_of("price")})


def messages_with_prices(messages: DataFrame, quotes: DataFrame, fill: bool = True, **size) -> DataFrame:
    """The nearest quote in time for every message; gaps in any column then take the value before them."""
    priced = asof_join(messages, quotes, "timestamp", left_tie="message_id", quote_tie="symbol", **size)
    if not fill:
        return priced
    # The fill needs several passes over the joined rows.
    return fill_forward(settle(priced, "priced"), ["timestamp", "message_id"], **size)


def hourly_batch(spark: SparkSession, message_path: str, quote_path: str, out: str, source: str = "telegram") -> DataFrame:
    """Land one source as hourly Parquet; returns the rows that have no readable time."""
    messages, rejects = split_untimed(prepare_messages(read_json_tree(spark, message_path, MESSAGE_WIRE)))
    quotes = prepare_quotes(read_json_tree(spark, quote_path, QUOTE_WIRE))
    write_hourly_parquet(messages_with_prices(messages, quotes), out, source)
    return rejects


def clean_export(messages: DataFrame, path: str, order: Sequence[str], n: int = 10_000, tags: Sequence[str] = BOT_TAGS, text: str = "text", **size) -> None:
    """The newest ``n`` messages as a one-column CSV in order of time: posts of bots left out, newlines spelled out, and texts that repeat the one
    kept before them dropped. ``order`` ends with a tie-break. Messages without text are left out."""
    newest = newest_rows(messages.select(*order, text), n, order, **size)
    # The filter and the comparison with the row before both read what was picked.
    kept = settle(newest.where(lacks_tags(text)).withColumn(text, one_line(text)), "newest")
    once = drop_repeats(kept, text, order, **size)
    write_message_csv(sort_rows(once, order), text, path)


def hourly_quotes(spark: SparkSession, quote_path: str, out: str, source: str = "bitcoin") -> None:
    quotes = prepare_quotes(read_json_tree(spark, quote_path, QUOTE_WIRE)).where(F.col("timestamp").isNotNull())
    write_hourly_parquet(fill_forward(settle(quotes, "quotes"), ["timestamp", "symbol"], ["price"]), out, source)


def cluster_batch(
    spark: SparkSession,
    parquet_path: str,
    assignments: str,
    centres: str,
    k: int = CLUSTERS,
    width: int = EMBEDDING_WIDTH,
    max_iter: int = 20,
) -> None:
    """Cluster all embeddings; write message to cluster as CSV, and the centres for live scoring as JSON lines."""
    vectors = settle(clean_embeddings(read_drifting_parquet(spark, parquet_path), width).select("message_id", "embedding"), "vectors")
    model, labelled = fit_clusters(vectors, k=k, max_iter=max_iter)
    write_csv_table(labelled.select("message_id", "cluster"), assignments)
    write_centres(centres_of(model, spark), centres)
