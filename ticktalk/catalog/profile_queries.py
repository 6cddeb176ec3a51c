"""Text, cleaning and profiling queries."""

from pyspark.sql import functions as F, types as T

from ticktalk.catalog.registry import query, table
from ticktalk.functions import messages as M, times, vectors, wire
from ticktalk.operators import enrich, mentions, picks, profile, rollups, sets
from ticktalk.operators.runs import gap_changes
from ticktalk.schemas import MESSAGE
from ticktalk.session import scratch_path, settle

WORDS = r"\b[A-Z][a-z]+"  # stands in for tickers, which the test texts lack


@query(rf"""
    SELECT upper(m) AS ticker, count(*) AS total_mentions, count(DISTINCT source) AS unique_channel_count
    FROM (SELECT source, unnest(regexp_extract_all(text, '{WORDS}')) AS m FROM documents)
    GROUP BY 1 ORDER BY total_mentions DESC, ticker LIMIT 20""")
def mention_leaderboard(spark, d):
    return mentions.mention_leaderboard(table(spark, d, "documents"), channel="source", pattern=WORDS)


@query(rf"""
    SELECT upper(m) AS ticker, count(*) AS mentions
    FROM (SELECT unnest(regexp_extract_all(text, '{WORDS}')) AS m FROM documents) GROUP BY 1""")
def mention_counts(spark, d):
    return mentions.value_counts(mentions.extract_mentions(table(spark, d, "documents"), pattern=WORDS), "ticker", "mentions")


@query(r"""
    SELECT upper(m) AS ticker, count(*) AS total_mentions, count(DISTINCT source) AS unique_channel_count
    FROM (SELECT source, unnest(regexp_extract_all(text, '\$[A-Za-z]+')) AS m FROM documents)
    GROUP BY 1 ORDER BY total_mentions DESC, ticker LIMIT 20""")
def ticker_leaderboard(spark, d):
    return mentions.mention_leaderboard(table(spark, d, "documents"), channel="source")


_PAYLOAD = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user", T.LongType()), T.StructField("text", T.StringType())])


def raw_messages(spark, d):
    """Events as wire payloads. Signups lack the user key, views carry a null, clicks have no text, errors are cut off."""
    events = table(spark, d, "events")
    kind = F.col("event_type")
    text = F.concat(F.lit("value "), F.col("value").cast("string"))
    full = F.to_json(F.struct("event_id", F.col("user_id").alias("user"), text.alias("text")))
    no_user = F.to_json(F.struct("event_id", text.alias("text")))
    no_text = F.to_json(F.struct("event_id", F.col("user_id").alias("user")))
    null_user = F.to_json(F.struct("event_id", F.lit(None).cast("bigint").alias("user"), text.alias("text")), {"ignoreNullFields": "false"})
    cut = F.substr(full, F.lit(1), F.length(full) - 1)
    raw = F.when(kind == "signup", no_user).when(kind == "view", null_user).when(kind == "click", no_text).when(kind == "error", cut)
    return events.select(F.encode(F.coalesce(raw, full), "UTF-8").alias("value"), F.col("ts").cast("timestamp").alias("publish_time"))


@query("""
    SELECT event_id, CAST(CASE WHEN event_type <> 'view' THEN user_id END AS DOUBLE) AS "user",
           event_type = 'click' AS text_was_absent, ts AS published
    FROM events WHERE event_type NOT IN ('signup', 'error')""")
def json_required_keys(spark, d):
    raw = raw_messages(spark, d).withColumn("value", wire.decode_utf8("value"))
    rows = wire.parse_object(raw.where(wire.holds_keys("value", ["event_id", "user"])), _PAYLOAD, checked=True)
    text = wire.default_when_absent("value", "text", F.col("text"))
    return rows.select("event_id", F.col("user").cast("double"), (text == "").alias("text_was_absent"), F.col("publish_time").cast("timestamp_ntz").alias("published"))


@query("""
    SELECT event_type = 'error' AS malformed, count(*) AS payloads FROM events
    WHERE event_type IN ('signup', 'error') GROUP BY 1""")
def json_rejects(spark, d):
    raw = raw_messages(spark, d).withColumn("value", wire.decode_utf8("value"))
    _, rejects = wire.split_rejects(raw, ["event_id", "user"])
    return rejects.groupBy((~wire.is_object("value")).alias("malformed")).agg(F.count("*").alias("payloads"))


@query("""
    SELECT 'conversations' AS origin, conv_id AS id, turn FROM conversations
    WHERE length(text) > 0 AND NOT (contains(lower(text), 'que') AND length(text) < 120)
    UNION ALL
    SELECT 'documents', doc_id, 0 FROM documents
    WHERE length(text) > 0 AND NOT (contains(lower(text), 'gm') AND length(text) < 15)""")
def spam_filter(spark, d):
    turns = table(spark, d, "conversations").where(M.worth_keeping("text", "que", 120))
    documents = table(spark, d, "documents").where(M.worth_keeping("text"))
    return sets.union_tables([
        turns.select(F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"), "turn"),
        documents.select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn")),
    ])


_TAGS = ("@", "http", "License", "tion la")


@query("SELECT doc_id FROM documents WHERE NOT (" + " OR ".join(f"contains(text, '{tag}')" for tag in _TAGS) + ")")
def bot_tag_filter(spark, d):
    return table(spark, d, "documents").where(M.lacks_tags("text", _TAGS)).select("doc_id")


@query("""
    SELECT source || d.doc_id AS message_id, replace(text, chr(10), '\\n ') AS line, length(text) AS text_length,
           CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS is_bot, CAST(quality AS DOUBLE) AS quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def normalise_messages(spark, d):
    documents = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").drop("lang", "n_chars")
    flag = F.when(F.col("toxic") == 1, "true").when(F.col("toxic") == 0, "false")
    return documents.select(
        M.message_key("source", "doc_id").alias("message_id"),
        M.one_line("text").alias("line"),
        M.text_length("text").alias("text_length"),
        M.bot_flag(flag, strict=True).alias("is_bot"),
        F.col("quality").cast("double"),
    )


@query("""
    SELECT source || doc_id AS message_id, text, lang AS username, CAST(NULL AS VARCHAR) AS first_name,
           CAST(NULL AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS user_id, FALSE AS is_bot,
           CAST(NULL AS VARCHAR) AS channel_name, source AS channel_id, CAST(NULL AS TIMESTAMP) AS "timestamp"
    FROM documents WHERE lang IS NOT NULL""")
def shape_messages(spark, d):
    documents = table(spark, d, "documents").where(M.has_sender("lang"))
    given = {"message_id": M.message_key("source", "doc_id"), "text": F.col("text"), "username": F.col("lang"), "channel_id": F.col("source")}
    return M.shape_messages(documents, given, names_known=False).select(*MESSAGE.names[:-1], F.col("timestamp").cast("timestamp_ntz"))


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS stamp, strftime(ts, '%Y-%m-%d %H:%M:%S') AS whole,
           CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
           CAST(hour(ts) AS INTEGER) AS hour, strftime(ts, '%Y-%m-%d/%H/%M') AS folder
    FROM events""")
def time_parts(spark, d):
    events = times.with_hour_parts(table(spark, d, "events"), "ts")
    folder = F.concat_ws("/", *times.path_parts("ts").values())
    return events.select("event_id", times.publish_stamp("ts").alias("stamp"), times.whole_seconds("ts").alias("whole"), *times.HOUR_PARTS, folder.alias("folder"))


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS whole,
           CASE WHEN event_type <> 'error' THEN ts END AS parsed FROM events""")
def ts_reformat(spark, d):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    zulu = F.concat(F.replace(stamp, F.lit(" "), F.lit("T")), F.lit("Z"))
    text = F.when(F.col("event_type") == "purchase", zulu).when(F.col("event_type") == "error", F.col("event_type"))
    events = table(spark, d, "events").select("event_id", F.coalesce(text, F.concat(stamp, F.lit("+00:00"))).alias("text"))
    parsed = events.withColumn("parsed", times.parse_time("text"))
    return parsed.select("event_id", times.whole_seconds("parsed").alias("whole"), F.col("parsed").cast("timestamp_ntz").alias("parsed"))


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS price,
           sha256(event_type || chr(31) || event_id) AS row_key FROM events""")
def price_cast(spark, d):
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select("event_id", M.price_of(text).alias("price"), M.replay_key("event_type", "event_id").alias("row_key"))


@query("""
    SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 10 HOURS""")
def trailing_range(spark, d):
    events = table(spark, d, "events").select("event_id", "ts")
    return events.where(M.newer_than("ts", events.agg(F.max("ts")).scalar(), 10))


@query("""
    SELECT d.doc_id, CAST(quality AS DOUBLE) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS DISTINCT FROM 1""")
def null_safe_filter(spark, d):
    documents = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return documents.where(M.differs("quality", 1)).select("doc_id", F.col("quality").cast("double"))


@query("""
    SELECT d.doc_id, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE quality IS NOT NULL AND toxic IS NOT NULL AND source IS NOT NULL AND d.doc_id IS NOT NULL""")
def left_join_dropna(spark, d):
    return enrich.join_complete(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query("""
    SELECT c_custkey, c_nationkey FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def channel_semi(spark, d):
    listed = table(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return enrich.in_channels(table(spark, d, "customer").select("c_custkey", "c_nationkey"), listed, "c_nationkey")


@query("""
    SELECT c_custkey, c_nationkey, n_name AS channel_name FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 2""")
def channel_enrich(spark, d):
    details = table(spark, d, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("channel_name"))
    return enrich.with_details(table(spark, d, "customer").select("c_custkey", "c_nationkey"), details, "c_nationkey")


@query("""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std
    FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def daily_stats(spark, d):
    quotes = table(spark, d, "events").where("event_type = 'purchase'")
    return profile.daily_stats(quotes, "ts", "value").select(F.col("date").cast("string"), F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


_SUMMARY = ("mean", "std", "min", "p25", "p50", "p75", "max")


def _rounded_summary(df, *keys):
    return df.select(*keys, "count", *[F.round(c, 6).alias(c) for c in _SUMMARY if c in df.columns])


@query("""
    SELECT count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
           round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
           round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max FROM events""")
def describe_value(spark, d, **size):
    return _rounded_summary(profile.describe(table(spark, d, "events"), "value", **size))


CHANGES = """
    changes AS (
        SELECT event_id, ts, value, gap_s,
               CASE WHEN gap_s > 3600 THEN 0 WHEN CAST(ts AS DATE) = CAST(ts0 AS DATE) THEN value - value0 END AS price_change
        FROM (SELECT *, coalesce((epoch_us(ts) - epoch_us(ts0)) / 1e6, 0) AS gap_s FROM (
            SELECT event_id, ts, value, lag(ts) OVER w AS ts0, lag(value) OVER w AS value0
            FROM events WHERE event_type = 'purchase' WINDOW w AS (ORDER BY ts, event_id))))"""


def quote_changes(spark, d, **size):
    quotes = table(spark, d, "events").where("event_type = 'purchase'").select("event_id", "ts", "value")
    return gap_changes(quotes, ["ts", "event_id"], "ts", "value", **size)


@query(f"""
    WITH {CHANGES}
    SELECT count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min,
           round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
           round(quantile_cont(x, 0.75), 6) AS p75, round(max(x), 6) AS max
    FROM (SELECT price_change AS x FROM changes)""")
def describe_change(spark, d, **size):
    changes = settle(quote_changes(spark, d, **size).select("price_change"), "changes")
    return _rounded_summary(profile.describe(changes, "price_change", **size))


def _histogram_sql(source, value, bins):
    return f"""
    SELECT b AS bin, round(lo + b * (hi - lo) / {bins}, 6) AS low, round(lo + (b + 1) * (hi - lo) / {bins}, 6) AS high,
           count(x) AS count
    FROM (SELECT unnest(range({bins})) AS b) CROSS JOIN (SELECT CAST(min({value}) AS DOUBLE) AS lo, CAST(max({value}) AS DOUBLE) AS hi FROM {source})
    LEFT JOIN (SELECT CAST({value} AS DOUBLE) AS x FROM {source} WHERE {value} IS NOT NULL)
      ON least(floor((x - lo) / ((hi - lo) / {bins})), {bins} - 1) = b
    GROUP BY b, lo, hi"""


def _rounded_histogram(df):
    return df.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "count")


@query(f"WITH {CHANGES} " + _histogram_sql("changes", "price_change", 100))
def histogram_change(spark, d):
    changes = settle(quote_changes(spark, d).select("price_change"), "changes")
    return _rounded_histogram(profile.histogram(changes, "price_change", 100))


@query(_histogram_sql("documents", "length(text)", 500))
def histogram_length(spark, d):
    lengths = table(spark, d, "documents").select(F.length("text").alias("n"))
    return _rounded_histogram(profile.histogram(lengths, "n", 500))


_SPREAD = """count(x) AS count, round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS p25,
           round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.75), 6) AS p75, round(max(x), 6) AS max"""


@query(f"""
    WITH {CHANGES}, ends AS (SELECT min(value) AS lo, max(value) AS hi FROM changes)
    SELECT CAST(greatest(1, least(5, ceil((value - lo) / ((hi - lo) / 5)))) AS INTEGER) AS bin, {_SPREAD.replace("(x", "(price_change")}
    FROM changes, ends WHERE price_change IS NOT NULL GROUP BY 1""")
def binned_change(spark, d):
    changes = settle(quote_changes(spark, d).select("value", "price_change"), "changes")
    levels = profile.with_equal_bins(changes, "value", 5)
    return _rounded_summary(profile.spread_per_group(levels, "price_change", ["bin"]), "bin")


@query(f"""
    WITH {CHANGES}
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, {_SPREAD.replace("(x", "(price_change")} FROM changes WHERE price_change IS NOT NULL GROUP BY 1""")
def change_spread_by_date(spark, d, **size):
    changes = settle(quote_changes(spark, d, **size).select(F.to_date("ts").alias("date"), "price_change"), "changes")
    return _rounded_summary(profile.spread_per_group(changes, "price_change", ["date"], **size), F.col("date").cast("string"))


@query(f"SELECT event_type, {_SPREAD.replace('(x', '(value')} FROM events GROUP BY 1")
def value_spread_by_type(spark, d, **size):
    return _rounded_summary(profile.spread_per_group(table(spark, d, "events"), "value", ["event_type"], **size), "event_type")


_LABELLED = "(SELECT d.doc_id, text, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
_LABELLED_COLUMNS = ("doc_id", "text", "source", "quality", "toxic")


def labelled(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").select(*_LABELLED_COLUMNS)


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {_LABELLED}" for c in _LABELLED_COLUMNS))
def null_profile(spark, d):
    return profile.null_counts(labelled(spark, d))


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\", round(count(DISTINCT {c}) * 100.0 / count(*), 6) AS percent FROM {_LABELLED}"
    for c in _LABELLED_COLUMNS[:-1]
))
def distinct_profile(spark, d):
    return profile.distinct_counts(labelled(spark, d)).withColumn("percent", F.round("percent", 6))


@query(f"SELECT round(count(*) FILTER (WHERE toxic = 1) * 100.0 / count(*), 6) AS percent_true FROM {_LABELLED}")
def bot_share(spark, d):
    flags = labelled(spark, d).select((F.col("toxic") == 1).alias("is_bot"))
    return profile.true_share(flags, "is_bot").withColumn("percent_true", F.round("percent_true", 6))


@query("SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS count FROM events GROUP BY 1")
def hourly_counts(spark, d):
    return profile.rows_by_hour(table(spark, d, "events"), "ts")


@query("""
    SELECT count(*) AS messages, round(count(*) / 168.0, 6) AS per_hour, count(*) > 0 AS not_empty,
           count(*) / 168.0 > 10 AS enough_per_hour FROM events""")
def weekly_kpi(spark, d):
    return profile.volume_kpi(table(spark, d, "events")).withColumn("per_hour", F.round("per_hour", 6))


@query("SELECT doc_id, length(text) AS text_length FROM documents ORDER BY text_length DESC, doc_id LIMIT 100")
def longest_texts(spark, d):
    return picks.longest_texts(table(spark, d, "documents"), key="doc_id")


@query("SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 10000")
def newest_rows(spark, d):
    return picks.newest_rows(table(spark, d, "events").select("event_id", "ts", "value"), 10000, ["ts", "event_id"])


@query("SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 60")
def sorted_head(spark, d):
    return picks.sort_rows(table(spark, d, "events").select("event_id", "ts", "event_type"), ["ts", "event_id"]).limit(60)


@query("SELECT doc_id, source FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 100")
def keyed_sample(spark, d):
    return picks.keyed_sample(table(spark, d, "documents").select("doc_id", "source"), 100, "doc_id")


@query("SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def value_counts(spark, d):
    return mentions.value_counts(table(spark, d, "events"), "event_type")


@query("SELECT DISTINCT label FROM embeddings")
def distinct_clusters(spark, d):
    return profile.distinct_values(table(spark, d, "embeddings"), "label")


@query("""
    SELECT vec_id, len(embedding) AS width, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total, label AS cluster
    FROM embeddings WHERE len(embedding) = 64""")
def parse_vectors(spark, d):
    written = table(spark, d, "embeddings").select("vec_id", vectors.text_from_list("embedding").alias("e"), F.col("label").cast("string").alias("c"))
    parsed = written.select("vec_id", vectors.list_from_text("e").alias("e"), vectors.cluster_from_text("c").alias("cluster"))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return parsed.where(M.has_width("e", 64)).select("vec_id", F.size("e").cast("bigint").alias("width"), F.round(total, 4).alias("total"), "cluster")


@query("""
    SELECT event_type, count(*) AS messages, count(DISTINCT user_id) AS users, count(DISTINCT value) AS prices,
           TRUE AS users_are_near, TRUE AS prices_are_near FROM events GROUP BY event_type""")
def distinct_rollup(spark, d):
    """Hourly roll-ups stored batch by batch and merged; their estimates have to be within 6 % of the exact numbers."""
    events = table(spark, d, "events").withColumn("hour", F.date_trunc("hour", F.col("ts")))
    path, by, distinct = scratch_path(spark, "rollup"), ["event_type", "hour"], ["user_id", "value"]
    for part in range(3):
        rollups.add_to_rollup(events.where(F.pmod("event_id", F.lit(3)) == part), path, part, by, distinct)
    found = rollups.read_rollup(spark, path, ["event_type"], distinct)
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("value").alias("prices"))
    near = {f"{name}_are_near": F.abs(F.col(name) - F.col(c)) <= 0.06 * F.col(name) for name, c in (("users", "user_id"), ("prices", "value"))}
    return found.join(exact, "event_type").withColumns(near).select("event_type", F.col("rows").alias("messages"), "users", "prices", *near)
