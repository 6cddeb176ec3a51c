"""Queries that depend on the order of rows."""

from pyspark.sql import functions as F

from ticktalk.catalog.profile_queries import CHANGES, quote_changes
from ticktalk.catalog.registry import query, table
from ticktalk.functions.messages import differs
from ticktalk.operators import enrich, runs
from ticktalk.operators.asof import asof_join
from ticktalk.session import settle

ASOF = """
    m AS (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'purchase'),
    q AS (SELECT event_id AS quote_id, user_id AS q_user, ts AS quote_ts, value AS price FROM events WHERE event_type = 'purchase')"""
NEAREST = f"""
    {ASOF},
    b AS (SELECT m.*, q.* FROM m ASOF LEFT JOIN q ON m.ts >= q.quote_ts),
    f AS (SELECT m.event_id, q.* FROM m ASOF LEFT JOIN q ON m.ts <= q.quote_ts),
    both_sides AS (SELECT b.*, f.quote_id AS f_id, f.quote_ts AS f_ts, f.price AS f_price,
        f.quote_ts IS NULL OR coalesce(b.ts - b.quote_ts <= f.quote_ts - b.ts, FALSE) AS back
        FROM b JOIN f ON b.event_id = f.event_id),
    nearest AS (SELECT event_id, ts, CASE WHEN back THEN quote_id ELSE f_id END AS quote_id,
        CASE WHEN back THEN price ELSE f_price END AS price, CASE WHEN back THEN quote_ts ELSE f_ts END AS quote_ts
        FROM both_sides)"""


def _with_double_id(df):
    """Numbers with gaps compare as doubles."""
    return df.withColumn("quote_id", F.col("quote_id").cast("double"))


def sides(spark, d):
    events = table(spark, d, "events")
    messages = events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    quotes = events.where("event_type = 'purchase'").select("ts", "user_id", F.col("event_id").alias("quote_id"), F.col("value").alias("price"))
    return messages, quotes


@query(f"WITH {NEAREST} SELECT event_id, ts, CAST(quote_id AS DOUBLE) AS quote_id, price, quote_ts FROM nearest")
def asof_nearest(spark, d, **size):
    messages, quotes = sides(spark, d)
    return _with_double_id(asof_join(messages.drop("user_id"), quotes.drop("user_id"), "ts", "event_id", "quote_id", quote_time="quote_ts", **size))


@query(f"""
    WITH {ASOF}
    SELECT m.event_id, m.user_id, m.ts,
           CAST(CASE WHEN m.ts - quote_ts <= INTERVAL 2 DAYS THEN quote_id END AS DOUBLE) AS quote_id,
           CASE WHEN m.ts - quote_ts <= INTERVAL 2 DAYS THEN price END AS price
    FROM m ASOF LEFT JOIN q ON m.user_id = q.q_user AND m.ts >= q.quote_ts""")
def asof_backward_by_user(spark, d, **size):
    messages, quotes = sides(spark, d)
    return _with_double_id(asof_join(messages, quotes, "ts", "event_id", "quote_id", by=["user_id"], direction="backward", tolerance=2 * 86400, **size))


@query(f"""
    WITH {ASOF}
    SELECT m.event_id, m.user_id, m.ts, CAST(quote_id AS DOUBLE) AS quote_id, price FROM m ASOF LEFT JOIN q ON m.user_id = q.q_user AND m.ts <= q.quote_ts""")
def asof_forward_by_user(spark, d, **size):
    messages, quotes = sides(spark, d)
    return _with_double_id(asof_join(messages, quotes, "ts", "event_id", "quote_id", by=["user_id"], direction="forward", **size))


def _rounded_changes(df):
    return df.select("event_id", F.round("gap_s", 6).alias("gap_s"), F.round("price_change", 6).alias("price_change"))


@query(f"WITH {CHANGES} SELECT event_id, round(gap_s, 6) AS gap_s, round(price_change, 6) AS price_change FROM changes")
def gap_change(spark, d, **size):
    return _rounded_changes(quote_changes(spark, d, **size))


@query(f"""
    WITH {CHANGES} SELECT event_id, round(gap_s, 6) AS gap_s, round(price_change, 6) AS price_change
    FROM changes WHERE price_change IS DISTINCT FROM 0""")
def nonzero_changes(spark, d):
    return _rounded_changes(quote_changes(spark, d).where(differs("price_change", 0.0)))


@query(f"""
    WITH {CHANGES}
    SELECT event_id, round(price_change, 6) AS price_change,
           CASE WHEN count(price_change) OVER w = 4 THEN round(avg(price_change) OVER w, 6) END AS mean_before
    FROM changes WHERE price_change IS DISTINCT FROM 0
    WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""")
def rolling_prev4(spark, d, **size):
    changes = settle(quote_changes(spark, d, **size), "changes").where(differs("price_change", 0.0))
    means = runs.moving_mean_before(changes, "price_change", "mean_before", ["ts", "event_id"], **size)
    return means.select("event_id", F.round("price_change", 6).alias("price_change"), F.round("mean_before", 6).alias("mean_before"))


@query("""
    SELECT event_id, ts, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS price,
           last_value(CASE WHEN event_type = 'signup' THEN CAST(user_id AS DOUBLE) END IGNORE NULLS) OVER w AS newcomer
    FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def forward_fill(spark, d, **size):
    sparse = table(spark, d, "events").select(
        "event_id",
        "ts",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("price"),
        F.when(F.col("event_type") == "signup", F.col("user_id").cast("double")).alias("newcomer"),
    )
    return runs.fill_forward(sparse, ["ts", "event_id"], **size)


@query("""
    SELECT event_id, ts, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS price
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def forward_fill_by_user(spark, d, **size):
    price = F.when(F.col("event_type") == "purchase", F.col("value")).alias("price")
    return runs.fill_forward(table(spark, d, "events").select("event_id", "ts", "user_id", price), ["ts", "event_id"], by=["user_id"], **size)


@query("""
    SELECT event_id, event_type FROM (
        SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS n FROM events WINDOW w AS (ORDER BY ts, event_id))
    WHERE n = 1 OR event_type IS DISTINCT FROM before""")
def drop_consecutive(spark, d, **size):
    return runs.drop_repeats(table(spark, d, "events").select("event_id", "ts", "event_type"), "event_type", ["ts", "event_id"], **size).drop("ts")


@query("""
    SELECT event_id, user_id, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10""")
def latest_n_per_channel(spark, d):
    return enrich.latest_per_channel(table(spark, d, "events").select("event_id", "user_id", "ts"), "user_id", ["ts", "event_id"], 10)


@query("""
    SELECT event_id, event_type, ts FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 2000""")
def latest_2000_per_type(spark, d):
    """More rows per channel than one task should take."""
    return enrich.latest_per_channel(table(spark, d, "events").select("event_id", "event_type", "ts"), "event_type", ["ts", "event_id"], 2000)


@query("""
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark, d):
    return enrich.latest_per_key(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"])
