"""Readers, writers and whole batch jobs: what was written is read back."""

import uuid

from pyspark.sql import functions as F, types as T

from ticktalk.catalog.order_queries import NEAREST
from ticktalk.catalog.registry import query, table
from ticktalk.functions.vectors import text_from_list
from ticktalk.operators import sets
from ticktalk.plans.batch import clean_export as write_clean_export, hourly_batch
from ticktalk.schemas import EMBEDDING_CSV
from ticktalk.session import scratch_path
from ticktalk.sinks import files as out, tables
from ticktalk.sinks.keyed import read_keyed, upsert
from ticktalk.sources import files as source

_EVENTS = "SELECT event_id, user_id, event_type, value, ts FROM events"


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "ts")


@query("""
    SELECT DISTINCT text, lang, source, CAST(CASE WHEN lang = 'en' THEN n_chars END AS DOUBLE) AS n_chars FROM documents
    """)
def union_drift_dedup(spark, d):
    documents = table(spark, d, "documents")
    root = scratch_path(spark, "drift")
    documents.where("lang = 'en'").select("text", "lang", "source", "n_chars").write.parquet(f"{root}/shape=1")
    documents.where("lang <> 'en'").select("source", "lang", "text").write.parquet(f"{root}/shape=2")
    return sets.drop_copies(source.read_drifting_parquet(spark, root).drop("shape")).withColumn("n_chars", F.col("n_chars").cast("double"))


@query("""
    SELECT doc_id AS id, text, lang, NULL AS role FROM documents
    UNION ALL SELECT conv_id, text, NULL, role FROM conversations""")
def union_by_name(spark, d):
    documents = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    turns = table(spark, d, "conversations").select("role", "text", F.col("conv_id").alias("id"))
    return sets.union_tables([documents, turns])


@query("""
    SELECT event_id, user_id, event_type, value, ts, event_type AS source, CAST(year(ts) AS INTEGER) AS year,
           CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour
    FROM events""")
def hourly_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "hourly")
    for name in ("purchase", "view", "click", "error", "signup"):  # sources share hours; none overwrites another
        out.write_hourly_parquet(_events(spark, d).where(F.col("event_type") == name), path, name, "ts")
    return spark.read.parquet(path)


@query("""
    SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour,
           CAST(minute(ts) AS INTEGER) AS minute, CAST(CAST('0x' || md5(CAST(event_id AS VARCHAR))[1:8] AS BIGINT) % 3 AS INTEGER) AS shard FROM events""")
def sharded_json_roundtrip(spark, d):
    path = scratch_path(spark, "shards")
    events = _events(spark, d).select("event_id", "event_type", "value", F.col("ts").alias("publish_time"))
    out.write_shards(events, path, key="event_id")
    back = spark.read.schema("event_id BIGINT, event_type STRING, value DOUBLE, date STRING, hour INT, minute STRING, shard INT").json(path)
    return back.withColumn("minute", F.col("minute").cast("int"))


@query("""
    SELECT CAST(vec_id AS VARCHAR) AS message_id, len(embedding) AS width, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total,
           round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * i)), 6) AS weighted FROM embeddings""")
def csv_roundtrip(spark, d):
    """Whole vectors as text and back; a sum weighted by place tells their order."""
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("message_id"), text_from_list("embedding").alias("embedding"))
    out.write_csv_table(rows, path)
    back = source.read_csv_table(spark, path, EMBEDDING_CSV)
    back = back.select("message_id", F.transform(F.from_json("embedding", "array<float>"), lambda x: x.cast("double")).alias("v"))
    add = lambda values: F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6)
    weighted = F.transform("v", lambda x, i: x * (i + 1))
    return back.select("message_id", F.size("v").cast("bigint").alias("width"), add(F.col("v")).alias("total"), add(weighted).alias("weighted"))


@query(_EVENTS)
def json_tree_roundtrip(spark, d):
    path = scratch_path(spark, "snapshot")
    events = _events(spark, d)
    for kind, hour in (("purchase", "2024-01-01 05:00:00"), ("other", "2024-01-02 23:00:00")):
        part = events.where((F.col("event_type") == "purchase") == (kind == "purchase"))
        out.write_snapshot(part, path, F.lit(hour).cast("timestamp"))
    return source.read_json_tree(spark, path, events.schema)


@query(_EVENTS + " UNION ALL " + _EVENTS)
def typed_append_roundtrip(spark, d):
    events = _events(spark, d)
    database = f"ticktalk_{uuid.uuid4().hex}"
    tables.create_tables(spark, database, {"events": events.schema}, scratch_path(spark, "database"))
    for _ in range(2):
        tables.append_typed(events.select("ts", "value", "event_type", "event_id", "user_id"), f"{database}.events", events.schema)
    return source.read_serving_table(spark, f"{database}.events")


@query("SELECT event_id, value FROM events")
def connector_append(spark, d):
    path = scratch_path(spark, "connector")
    out.append_with(_events(spark, d).select("event_id", "value"), "orc", path=path)
    return spark.read.orc(path)


@query("SELECT CAST(doc_id AS VARCHAR) AS line FROM documents")
def lines_roundtrip(spark, d):
    path = scratch_path(spark, "lines")
    out.write_lines(table(spark, d, "documents"), "doc_id", path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query('SELECT text AS "Message" FROM documents')
def message_csv_roundtrip(spark, d):
    path = scratch_path(spark, "messages")
    out.write_message_csv(table(spark, d, "documents"), "text", path)
    return source.read_csv_table(spark, path, T.StructType().add("Message", "string"), multi_line=True)


@query("""
    WITH newest AS (SELECT event_id, ts, event_type || chr(10) || CASE WHEN event_id % 7 = 0 THEN '@RickBurpBot' ELSE '' END AS text
        FROM events ORDER BY ts DESC, event_id DESC LIMIT 5000),
    kept AS (SELECT event_id, ts, replace(text, chr(10), '\\n ') AS text FROM newest WHERE NOT contains(text, '@RickBurpBot'))
    SELECT text AS "Message" FROM kept QUALIFY text IS DISTINCT FROM lag(text) OVER (ORDER BY ts, event_id)""")
def clean_export(spark, d):
    """The newest messages cleaned and written as one column, read back."""
    path = scratch_path(spark, "clean")
    tag = F.when(F.col("event_id") % 7 == 0, "@RickBurpBot").otherwise("")
    messages = table(spark, d, "events").select("event_id", "ts", F.concat("event_type", F.lit("\n"), tag).alias("text"))
    write_clean_export(messages, path, ["ts", "event_id"], n=5000)
    return source.read_csv_table(spark, path, T.StructType().add("Message", "string"))


@query("SELECT s_name AS name, CAST(s_suppkey AS VARCHAR) AS channel_id FROM supplier WHERE s_nationkey <> 3")
def channel_dimension(spark, d):
    path = scratch_path(spark, "channels")
    comment = F.when(F.col("s_nationkey") == 3, "# ").otherwise("")
    line = F.concat(comment, F.translate("s_name", "#", "@"), F.lit(": "), "s_suppkey")
    out.write_lines(table(spark, d, "supplier").select(line.alias("line")), "line", path)
    return source.read_channels(spark, path).withColumn("name", F.translate("name", "@", "#"))


@query("""
    SELECT event_id, user_id, event_type, value, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type IN ('purchase', 'view'), ts DESC, event_id DESC) = 1""")
def keyed_upsert(spark, d):
    path = scratch_path(spark, "keyed")
    events = _events(spark, d)
    first = F.col("event_type").isin("purchase", "view")
    for batch in (events.where(first), events.where(~first)):  # the second write wins, whatever its times
        upsert(batch, path, ["user_id"], ["ts", "event_id"])
    return read_keyed(spark, path).select("event_id", "user_id", "event_type", "value", "ts")


@query(f"""
    WITH {NEAREST}
    SELECT CAST(n.event_id AS VARCHAR) AS message_id, n.ts AS "timestamp", CAST(e.event_type = 'error' AS INTEGER) AS is_bot, n.price,
           CAST(year(n.ts) AS INTEGER) AS year, CAST(month(n.ts) AS INTEGER) AS month, CAST(day(n.ts) AS INTEGER) AS day,
           CAST(hour(n.ts) AS INTEGER) AS hour
    FROM nearest n JOIN events e ON n.event_id = e.event_id""")
def hourly_message_batch(spark, d):
    """The whole batch job: JSON in, nearest price, forward fill, hourly Parquet out."""
    root = scratch_path(spark, "batch")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp")
    events = table(spark, d, "events")
    messages = events.where("event_type <> 'purchase'").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("props").alias("text"),
        F.col("user_id").cast("string"),
        F.when(F.col("event_type") == "error", "true").otherwise("false").alias("is_bot"),
        stamp,
    )
    quotes = events.where("event_type = 'purchase'").select(F.lit("BTC").alias("symbol"), F.col("value").cast("string").alias("price"), stamp)
    messages.write.json(f"{root}/messages")
    quotes.write.json(f"{root}/quotes")
    hourly_batch(spark, f"{root}/messages", f"{root}/quotes", f"{root}/hourly")
    landed = spark.read.parquet(f"{root}/hourly")
    return landed.select("message_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "is_bot", "price", "year", "month", "day", "hour")
