"""Streams over the test tables. Each runs over all rows that are there, into files."""

from pyspark.sql import functions as F

from ticktalk.catalog.registry import query, table
from ticktalk.catalog.vector_queries import LABEL_MEANS, label_means
from ticktalk.functions.vectors import list_from_text, text_from_list
from ticktalk.session import scratch_path
from ticktalk.sinks.files import write_shards
from ticktalk.sinks.keyed import read_keyed, upsert
from ticktalk.sources.streams import table_stream
from ticktalk.streaming import closing, flows, windows

_MESSAGE_ROWS = "(SELECT * FROM events WHERE event_type NOT IN ('signup', 'error'))"


def _stream(spark, d, name):
    return table_stream(spark, f"{d}/{name}.parquet", table(spark, d, name).schema)


def _published(events):
    return events.withColumn("publish_time", F.col("ts").cast("timestamp"))


def message_payloads(events):
    """Events as message payloads; those of signups miss a field, those of errors are cut off."""
    fields = [
        F.col("event_id").cast("string").alias("message_id"),
        F.col("props").alias("text"),
        *[F.lit(None).cast("string").alias(c) for c in ("username", "first_name", "last_name")],
        F.col("user_id"),
        (F.col("event_type") == "view").alias("is_bot"),
        F.col("event_type").alias("channel_name"),
        F.lit("7").alias("channel_id"),
    ]
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS'+00:00'").alias("timestamp")
    keep_nulls = {"ignoreNullFields": "false"}
    whole, lacking = F.to_json(F.struct(*fields, stamp), keep_nulls), F.to_json(F.struct(*fields), keep_nulls)
    raw = F.when(F.col("event_type") == "signup", lacking).when(F.col("event_type") == "error", F.substr(whole, F.lit(1), F.lit(40)))
    return _published(events).select(F.encode(F.coalesce(raw, whole), "UTF-8").alias("value"), "publish_time")


@query("""
    SELECT time_bucket(INTERVAL '90 seconds', ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS messages,
           min(ts) AS first, max(ts) AS last
    FROM events GROUP BY 1""")
def stream_windows(spark, d):
    """Every (window, shard) batch is kept under its key as it grows; the shards of a window are then added up."""
    counts = windows.window_shards(_published(_stream(spark, d, "events")), "event_id", minutes=1.5)
    path = scratch_path(spark, "windows")
    sink = lambda batch, _: upsert(batch, path, ["window_start", "shard"], ["messages"])
    started = counts.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", scratch_path(spark, "state"))
    started.trigger(availableNow=True).start().awaitTermination()
    total = read_keyed(spark, path).groupBy("window_start").agg(F.sum("messages").alias("messages"), F.min("first").alias("first"), F.max("last").alias("last"))
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "first", "last")}
    return total.withColumns(ntz)


@query("""
    SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour,
           CAST(minute(ts) AS INTEGER) AS minute, CAST(CAST('0x' || md5(CAST(event_id AS VARCHAR))[1:8] AS BIGINT) % 3 AS INTEGER) AS shard FROM events""")
def stream_shards(spark, d):
    path = scratch_path(spark, "stream-shards")
    events = _published(_stream(spark, d, "events")).select("event_id", "value", "publish_time")
    write_shards(events, path, key="event_id", checkpoint=scratch_path(spark, "state")).awaitTermination()
    back = spark.read.schema("event_id BIGINT, value DOUBLE, date STRING, hour INT, minute STRING, shard INT").json(path)
    return back.withColumn("minute", F.col("minute").cast("int"))


@query("""
    SELECT CASE WHEN event_type = 'error' THEN 'late' ELSE 'published' END AS outcome, event_id,
           time_bucket(INTERVAL '90 seconds', ts, TIMESTAMP '1970-01-01') AS window_start,
           CAST(CAST('0x' || md5(CAST(event_id AS VARCHAR))[1:8] AS BIGINT) % 3 AS INTEGER) AS shard,
           CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS publications FROM events""")
def stream_closed_windows(spark, d):
    """Events in three micro-batches by time, then the errors once more, when all windows are published. Each window and
    shard has to be published once, with all rows but the errors."""
    path = scratch_path(spark, "closed")
    rows = _published(table(spark, d, "events")).select("event_id", "event_type", "publish_time")
    on_time, thirds = rows.where("event_type <> 'error'"), rows.agg(F.expr("approx_percentile(publish_time, array(0.33D, 0.66D), 1000)").alias("t")).first()["t"]
    options = {"key": "event_id", "minutes": 1.5, "delay_seconds": 600}
    at = F.col("publish_time")
    for n, part in enumerate([at < thirds[0], (at >= thirds[0]) & (at < thirds[1]), at >= thirds[1]]):
        closing.close_windows(on_time.where(part), n, path, **options)
    closing.close_all(spark, path, **{k: options[k] for k in ("key", "minutes")})
    closing.close_windows(rows.where("event_type = 'error'"), 4, path, **options)
    times = closing.read_windows(spark, path).groupBy("window_start", "shard").agg(F.count("*").cast("int").alias("publications"))
    found = closing.read_published(spark, path, "event_id BIGINT, window_start TIMESTAMP, shard INT").join(times, ["window_start", "shard"])
    late = closing.read_late(spark, path).select("event_id", "window_start", "shard", F.lit(0).alias("publications"))
    both = [part.select(F.lit(name).alias("outcome"), "event_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "shard", "publications") for name, part in (("published", found), ("late", late))]
    return both[0].union(both[1])


@query(f"""
    SELECT s AS sink, CAST(event_id AS VARCHAR) AS message_id FROM {_MESSAGE_ROWS},
    (SELECT unnest(['raw', 'chatrooms', 'embeddings', 'keyed']) AS s)""")
def stream_fanout(spark, d):
    root = scratch_path(spark, "fanout")
    embed = lambda rows: rows.withColumn("embedding", F.array(F.length("text").cast("float")))
    parsed = flows.parse_messages(message_payloads(_stream(spark, d, "events")), embed)
    flows.fan_out(parsed, flows.message_sinks(root), scratch_path(spark, "state")).awaitTermination()
    found = {
        "raw": spark.read.schema("message_id STRING").json(f"{root}/raw").select("message_id"),
        "chatrooms": spark.read.parquet(f"{root}/chatrooms"),
        "embeddings": spark.read.parquet(f"{root}/embeddings"),
        "keyed": read_keyed(spark, f"{root}/messages_by_key"),
    }
    parts = [rows.select(F.lit(name).alias("sink"), "message_id") for name, rows in found.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query(f"""
    SELECT CAST(event_id AS VARCHAR) AS message_id, props AS text, CAST(user_id AS VARCHAR) AS user_id,
           event_type = 'view' AS is_bot, event_type AS channel_name, ts AS "timestamp" FROM {_MESSAGE_ROWS}""")
def stream_messages(spark, d):
    root = scratch_path(spark, "messages")
    parsed = flows.parse_messages(message_payloads(_stream(spark, d, "events")), lambda rows: rows)
    sinks = {"chatrooms": flows.message_sinks(root)["chatrooms"]}
    flows.fan_out(parsed, sinks, scratch_path(spark, "state")).awaitTermination()
    columns = ["message_id", "text", "user_id", "is_bot", "channel_name", F.col("timestamp").cast("timestamp_ntz").alias("timestamp")]
    return spark.read.parquet(f"{root}/chatrooms").select(*columns)


@query("""
    SELECT event_type AS symbol, value AS price, ts AS "timestamp" FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, value DESC) = 1""")
def stream_quotes(spark, d):
    """The keyed table of quotes: the last one of each symbol. Event time stands in for the time of intake."""
    root = scratch_path(spark, "quotes")
    raw = F.to_json(F.struct(F.col("event_type").alias("symbol"), F.col("value").cast("string").alias("price")))
    payloads = _published(_stream(spark, d, "events")).select(F.encode(raw, "UTF-8").alias("value"), "publish_time")
    quotes = flows.parse_quotes(payloads, now=F.col("publish_time"))
    flows.fan_out(quotes, flows.quote_sinks(root), scratch_path(spark, "state")).awaitTermination()
    return read_keyed(spark, f"{root}/quotes_by_symbol").select("symbol", "price", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@query(f"WITH {LABEL_MEANS} SELECT CAST(vec_id AS VARCHAR) AS message_id, cluster FROM scored")
def stream_score(spark, d):
    """Messages whose text spells their vector, scored against the mean vector of each label."""
    root = scratch_path(spark, "scored")
    raw = F.to_json(F.struct(F.col("vec_id").cast("string").alias("message_id"), text_from_list("embedding").alias("text")))
    payloads = _stream(spark, d, "embeddings").select(F.encode(raw, "UTF-8").alias("value"), F.lit(0).cast("timestamp").alias("publish_time"))
    embed = lambda rows: rows.withColumn("embedding", list_from_text("text", "float"))
    scored = flows.score_messages(payloads, label_means(spark, d), embed)
    flows.fan_out(scored, flows.score_sink(root), scratch_path(spark, "state")).awaitTermination()
    return read_keyed(spark, f"{root}/scored").select("message_id", "cluster")


@query("SELECT event_id, ts FROM events")
def stream_dedup(spark, d):
    """Every event is delivered twice and kept once."""
    once = _published(_stream(spark, d, "events")).select("event_id", "ts", "publish_time")
    twice = once.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    kept = windows.drop_redelivered(twice, "event_id").select("event_id", "ts")
    path = scratch_path(spark, "kept")
    writer = kept.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "state"))
    writer.trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.parquet(path)
