"""From raw payloads to sinks. Every step also takes a batch DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ticktalk.functions.messages import as_boolean, price_of
from ticktalk.functions.times import ingest_time, parse_time
from ticktalk.functions.wire import RAW, decode_utf8, default_when_absent, holds_keys, parse_object
from ticktalk.operators.clusters import attach_nearest, hashed_embedding
from ticktalk.schemas import MESSAGE, MESSAGE_FIELDS, MESSAGE_WIRE, QUOTE, QUOTE_FIELDS, QUOTE_WIRE
from ticktalk.sinks.files import HOUR_FOLDERS, JSON_TIMES, with_shard_parts
from ticktalk.sinks.keyed import upsert
from ticktalk.sinks.tables import append_batch

Sink = Callable[[DataFrame, int], None]
Embed = Callable[[DataFrame], DataFrame]


def parse_messages(payloads: DataFrame, embed: Embed = hashed_embedding, mode: str = "drop", check_fields: bool = True) -> DataFrame:
    """``value, publish_time`` to typed messages with an embedding; incomplete messages are left out."""
    text = payloads.withColumn(RAW, decode_utf8(RAW))
    if check_fields:
        complete = holds_keys(RAW, MESSAGE_FIELDS)
        # In fail mode payloads that are no objects have to reach the parser.
        text = text.where(complete if mode == "drop" else complete | F.json_object_keys(RAW).isNull())
    wire = parse_object(text, MESSAGE_WIRE, mode=mode, checked=check_fields)
    wire = wire.withColumn("text", default_when_absent(RAW, "text", F.col("text"))).drop(RAW)
    typed = wire.withColumns({"is_bot": as_boolean("is_bot"), "timestamp": parse_time("timestamp")})
    return embed(typed)


def parse_quotes(payloads: DataFrame, now: Column | None = None, mode: str = "fail") -> DataFrame:
    """``value, publish_time`` to quotes. The time of a quote is the time it is taken in."""
    text = payloads.withColumn(RAW, decode_utf8(RAW))
    complete = holds_keys(RAW, [f for f in QUOTE_FIELDS if f != "timestamp"])
    text = text.where(complete if mode == "drop" else complete | F.json_object_keys(RAW).isNull())
    wire = parse_object(text, QUOTE_WIRE, mode=mode, checked=True).drop(RAW)
    return wire.withColumns({"price": price_of("price", mode), "timestamp": ingest_time() if now is None else now})


def fan_out(stream: DataFrame, sinks: dict[str, Sink], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Send every micro-batch to all sinks. The batch is computed once; sinks get its id to make replays harmless.

    ``trigger`` holds the arguments of Spark's trigger, such as ``{"processingTime": "1 minute"}`` for a query without end; by default
    what is there is taken once."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks.values():
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def message_sinks(root: str, minutes: float = 1.0, shards: int = 3) -> dict[str, Sink]:
    """The four destinations of messages: raw JSON by window and shard, two append tables, and the keyed table."""
    def raw(batch: DataFrame, batch_id: int) -> None:
        parts = with_shard_parts(batch, minutes=minutes, shards=shards).drop("publish_time")
        rows = parts.withColumn("batch_id", F.lit(batch_id))
        writer = rows.hint("rebalance", *HOUR_FOLDERS).write.partitionBy(*HOUR_FOLDERS, "batch_id").mode("overwrite")
        writer.options(**JSON_TIMES).option("partitionOverwriteMode", "dynamic").json(f"{root}/raw")

    def chatrooms(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.select(*MESSAGE.names), f"{root}/chatrooms", batch_id)

    def embeddings(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.where("embedding IS NOT NULL").select("message_id", "embedding"), f"{root}/embeddings", batch_id)

    def keyed(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, f"{root}/messages_by_key", ["message_id"], ["publish_time", "text"], "messages", batch_id)

    return {"raw": raw, "chatrooms": chatrooms, "embeddings": embeddings, "keyed": keyed}


def quote_sinks(root: str) -> dict[str, Sink]:
    """Append table of all quotes, and the keyed table with the last quote of each symbol."""

    def quotes(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.select(*QUOTE.names), f"{root}/quotes", batch_id)

    def last(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.select(*QUOTE.names), f"{root}/quotes_by_symbol", ["symbol"], ["timestamp", "price"], "quotes", batch_id)

    return {"quotes": quotes, "last": last}


def score_messages(payloads: DataFrame, centres: DataFrame, embed: Embed = hashed_embedding) -> DataFrame:
    """Messages with their embedding and nearest centre. Missing keys are allowed, malformed payloads are not."""
    return attach_nearest(parse_messages(payloads, embed, mode="fail", check_fields=False), centres)


def score_sink(root: str) -> dict[str, Sink]:
    def scored(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, f"{root}/scored", ["message_id"], ["publish_time", "text"], "scored", batch_id)

    return {"scored": scored}
