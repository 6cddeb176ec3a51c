"""What a stream reads beside its rows: versioned tables that change while it runs, and the last row of each key."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticktalk.operators.clusters import attach_nearest
from ticktalk.operators.enrich import latest_per_key
from ticktalk.operators.runs import drop_repeats, previous
from ticktalk.session import list_names, read_file, rename_new, settle, write_file
from ticktalk.sinks.keyed import read_keyed, upsert

Sink = Callable[[DataFrame, int], None]


def publish_version(table: DataFrame, path: str) -> int:
    """Write ``table`` as the next version below ``path``; readers see it by one rename, when it is whole."""
    spark = table.sparkSession
    place = f"data-{uuid.uuid4().hex}"
    table.write.parquet(f"{path}/{place}")
    version = _newest(spark, path) + 1
    aside = f"{path}/.{uuid.uuid4().hex}"
    write_file(spark, aside, place)
    if not rename_new(spark, aside, f"{path}/version-{version:09d}"):
        raise RuntimeError(f"version {version} of {path} was written by another writer")
    return version


def _newest(spark: SparkSession, path: str) -> int:
    return max((int(name.removeprefix("version-")) for name in list_names(spark, path) if name.startswith("version-")), default=0)


def newest_version(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """(number, rows) of the newest version; raises if there is none."""
    version = _newest(spark, path)
    if not version:
        raise FileNotFoundError(f"no version below {path}")
    return version, spark.read.parquet(f"{path}/{read_file(spark, f'{path}/version-{version:09d}')}")


def scored_by_version(sink: Sink, centres_path: str, vector: str = "embedding") -> Sink:
    """A sink that scores every micro-batch by the centres that are newest when it starts, and hands it on with ``cluster`` and
    ``centres_version``. Centres published while a stream runs count from its next micro-batch on."""

    def score(batch: DataFrame, batch_id: int) -> None:
        version, centres = newest_version(batch.sparkSession, centres_path)
        sink(attach_nearest(batch, centres, vector).withColumn("centres_version", F.lit(version)), batch_id)

    return score


def _with_last_rows(batch: DataFrame, state_path: str, key: str, order: Sequence[str], keep_seconds: float | None) -> tuple[DataFrame, DataFrame]:
    """(the batch, with the last row of its keys from earlier batches flagged in ``__old``; the last rows of its keys)."""
    spark = batch.sparkSession
    rows = settle(batch, "stream-rows")
    state = read_keyed(spark, state_path)
    both = rows.withColumn("__old", F.lit(False))
    if state is not None:
        recent = F.lit(True) if keep_seconds is None else F.col("__at") > F.unix_seconds(F.current_timestamp()) - keep_seconds
        held = state.where(recent).join(rows.select(key).distinct(), key, "left_semi")
        both = both.unionByName(held.select(*rows.columns).withColumn("__old", F.lit(True)))
    last = latest_per_key(rows, [key], order).withColumn("__at", F.unix_seconds(F.current_timestamp()))
    return both, last


def repeats_dropped(sink: Sink, state_path: str, value: str, key: str, order: Sequence[str], keep_seconds: float | None = None) -> Sink:
    """A sink for ``drop_repeats`` on a stream: a row that repeats the value of the row before it, of the same key, is left out, also
    where the one before came in an earlier micro-batch.

    The state is a keyed table with the last row of each key. A key that brought nothing for ``keep_seconds`` starts anew. Rows of a
    key arrive in order from one micro-batch to the next; within one they may come in any order. A replayed micro-batch meets the
    state that its first try left only if it had gone through, and then its rows were handed on already.
    """

    def drop(batch: DataFrame, batch_id: int) -> None:
        both, last = _with_last_rows(batch, state_path, key, order, keep_seconds)
        sink(drop_repeats(both, value, order, by=[key]).where(~F.col("__old")).drop("__old"), batch_id)
        upsert(last, state_path, [key], order, "repeats", batch_id)

    return drop


def changes_added(sink: Sink, state_path: str, columns: dict[str, str], key: str, order: Sequence[str], keep_seconds: float | None = None) -> Sink:
    """A sink for ``previous`` on a stream: ``{new: old}`` columns hold ``old`` of the row before of the same key, across micro-batches."""

    def add(batch: DataFrame, batch_id: int) -> None:
        both, last = _with_last_rows(batch, state_path, key, order, keep_seconds)
        sink(previous(both, columns, order, by=[key]).where(~F.col("__old")).drop("__old"), batch_id)
        upsert(last, state_path, [key], order, "changes", batch_id)

    return add
