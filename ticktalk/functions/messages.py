"""Per-message rules: keys, flags, shapes, and the filters that clean chat text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ticktalk.schemas import MESSAGE

# The bots whose posts are left out, the greeting that is, and its length bound.
BOT_TAGS = ("@ProficyPriceBot", "@misstrenchbot", "@RickBurpBot", "@AlphaGardenersBot")
GREETING = "gm"
GREETING_BELOW = 15
# Fixed value: a dollar sign and latin letters.
TICKER = r"\$[A-Za-z]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def message_key(channel_id: Column | str, number: Column | str, strict: bool = False) -> Column:
    """Channel id followed by the message number. ``strict`` spells a missing channel as ``None``."""
    channel = _col(channel_id).cast("string")
    if strict:
        channel = F.coalesce(channel, F.lit("None"))
    return F.concat(channel, _col(number).cast("string"))


def one_line(text: Column | str) -> Column:
    """Newlines spelled as backslash, n, space."""
    return F.replace(_col(text), F.lit("\n"), F.lit("\\n "))


def bot_flag(flag: Column | str, strict: bool = False) -> Column:
    """1 for bots, else 0. ``strict`` takes only the lower-case text ``true``, and a boolean true as 0."""
    flag = _col(flag)
    if strict:
        return F.when(F.typeof(flag) == "boolean", 0).when(flag.cast("string") == "true", 1).otherwise(0)
    return F.when(F.lower(flag.cast("string")) == "true", 1).otherwise(0)


def as_boolean(flag: Column | str) -> Column:
    return _col(flag).try_cast("boolean")


def price_of(text: Column | str, mode: str = "drop") -> Column:
    """Price as a double: NULL on bad text, or an error with ``mode="fail"``. A missing price stays NULL."""
    price = _col(text).try_cast("double")
    if mode != "fail":
        return price
    bad = F.raise_error(F.concat(F.lit("not a price: "), _col(text).cast("string"))).cast("double")
    return F.when(price.isNull() & _col(text).isNotNull(), bad).otherwise(price)


def text_length(text: Column | str) -> Column:
    return F.length(text)


def shape_messages(df: DataFrame, given: dict[str, Column], names_known: bool = True) -> DataFrame:
    """The ten message fields in order: given expressions, NULL for the rest.

    ``names_known=False`` is the hourly path: names are blanked and nobody is marked as a bot.
    """
    given = dict(given)
    if not names_known:
        given |= {"first_name": F.lit(None), "last_name": F.lit(None), "is_bot": F.lit(False)}
    unknown = set(given) - set(MESSAGE.names)
    if unknown:
        raise ValueError(f"not message fields: {sorted(unknown)}")
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in MESSAGE.fields])


def random_key() -> Column:
    """A new random id per row; use ``replay_key`` for sinks that may see a row twice."""
    return F.expr("uuid()")


def replay_key(*columns: Column | str) -> Column:
    return F.sha2(F.concat_ws("\x1f", *[_col(c).cast("string") for c in columns]), 256)


def shard_of(key: Column | str, shards: int = 3) -> Column:
    """An even, retry-stable shard number in ``[0, shards)``: the first 32 bits of the key's MD5, so that other readers can
    compute it too. A missing key is that of the empty text."""
    digest = F.md5(F.coalesce(_col(key).cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")


# --- filters ---------------------------------------------------------------------------------------------------


def worth_keeping(text: Column | str, greeting: str = GREETING, below: int = GREETING_BELOW) -> Column:
    """False for null or empty text and for short greetings."""
    text = _col(text)
    greets = F.contains(F.lower(text), F.lit(greeting.lower())) & (F.length(text) < below)
    return F.coalesce((F.length(text) > 0) & ~greets, F.lit(False))


def has_sender(sender: Column | str) -> Column:
    return _col(sender).isNotNull()


def lacks_tags(text: Column | str, tags: Sequence[str] = BOT_TAGS) -> Column:
    """True where the text holds none of the tags."""
    text = _col(text)
    return ~reduce(lambda a, b: a | b, [F.contains(text, F.lit(tag)) for tag in tags])


def differs(column: Column | str, value) -> Column:
    """Inequality that keeps nulls."""
    return ~_col(column).eqNullSafe(F.lit(value))


def has_width(vector: Column | str, width: int) -> Column:
    return _col(vector).isNotNull() & (F.size(_col(vector)) == width)


def newer_than(ts: Column | str, reference: Column, hours: int) -> Column:
    return _col(ts) >= reference - F.expr(f"INTERVAL {int(hours)} HOURS")
