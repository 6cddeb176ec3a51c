"""Windows that close: every (window, shard) batch is published once, when the watermark has passed it.

A micro-batch first lands its rows, by arrival, in a folder of its own. When the watermark - the newest publish time so far less
the delay - passes the end of a window, its rows are published from the folders that hold some, in the same files layout as
``write_shards``; a row of a window that has been published goes to the late table. So a row is written twice whatever the delay,
nothing is gathered in memory, and the state is a small file per micro-batch: watermark, and the time span of each open folder.
The file is renamed to its place when the rest is written, so a replayed micro-batch starts again from the state before it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ticktalk.functions.messages import shard_of
from ticktalk.functions.times import path_parts
from ticktalk.session import delete_path, list_names, read_file, rename_new, write_file
from ticktalk.sinks.files import HOUR_FOLDERS, JSON_TIMES
from ticktalk.streaming.windows import SHARDS, WINDOW_MINUTES, window_start

START, SHARD, END = "window_start", "shard", "__end"
_STATES = "_state"
_KEPT_STATES = 8


def _state(spark: SparkSession, path: str) -> dict:
    names = sorted(name for name in list_names(spark, f"{path}/{_STATES}") if name.startswith("b"))
    if not names:
        return {"batch_id": -1, "watermark": None, "open": []}
    return json.loads(read_file(spark, f"{path}/{_STATES}/{names[-1]}"))


def _commit(spark: SparkSession, path: str, state: dict) -> None:
    folder = f"{path}/{_STATES}"
    aside = f"{folder}/.{uuid.uuid4().hex}"
    write_file(spark, aside, json.dumps(state))
    if not rename_new(spark, aside, f"{folder}/b{state['batch_id']:012d}.json"):
        delete_path(spark, aside)
        raise RuntimeError(f"batch {state['batch_id']} of {path} was taken by another writer")
    for name in sorted(name for name in list_names(spark, folder) if name.startswith("b"))[:-_KEPT_STATES]:
        delete_path(spark, f"{folder}/{name}")


def _micros(seconds: Column) -> Column:
    return F.unix_micros(seconds.cast("timestamp"))


def _publish(rows: DataFrame, path: str, batch_id: int) -> None:
    """Rows as JSON by hour, and a line for each (window, shard) that is now complete."""
    parts = path_parts(F.col(START))
    laid_out = rows.drop(END).withColumns({name: parts[name] for name in HOUR_FOLDERS} | {"minute": parts["minute"]})
    laid_out.hint("rebalance", *HOUR_FOLDERS).write.partitionBy(*HOUR_FOLDERS).mode("overwrite").options(**JSON_TIMES).json(f"{path}/published/batch={batch_id}")
    windows = rows.groupBy(START, SHARD).agg(F.count("*").alias("messages"))
    windows.write.mode("overwrite").parquet(f"{path}/windows/batch={batch_id}")


def close_windows(
    batch: DataFrame,
    batch_id: int,
    path: str,
    published: str = "publish_time",
    key: Column | str = "message_id",
    minutes: float = WINDOW_MINUTES,
    shards: int = SHARDS,
    delay_seconds: float = 0,
    last: bool = False,
) -> None:
    """Take in one micro-batch: see the module. ``last`` closes all windows, whatever the watermark.

    Rows without publish time belong to no window and are late.
    """
    spark = batch.sparkSession
    state = _state(spark, path)
    if batch_id <= state["batch_id"]:
        return
    passed = state["watermark"]
    length = int(minutes * 60_000_000)
    placed = batch.withColumns({START: window_start(published, minutes), SHARD: shard_of(key, shards)})
    placed = placed.withColumn(END, _micros(F.col(START)) + length)
    folder = f"landed/{uuid.uuid4().hex}"
    placed.write.parquet(f"{path}/{folder}")
    schema = placed.schema
    landed = spark.read.schema(schema).parquet(f"{path}/{folder}")
    in_time = F.col(END).isNotNull() if passed is None else F.coalesce(F.col(END) > passed, F.lit(False))
    span = landed.agg(
        F.max(_micros(F.col(published))).alias("newest"),
        F.count("*").alias("rows"),
        F.count_if(in_time).alias("open"),
        F.min(F.when(in_time, F.col(END))).alias("first"),
        F.max(F.when(in_time, F.col(END))).alias("last"),
    ).first()
    if span["open"] < span["rows"]:
        landed.where(~in_time).drop(END).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
    folders = [*state["open"], *([{"path": folder, "first": span["first"], "last": span["last"]}] if span["open"] else [])]
    newest = [t for t in (passed, None if span["newest"] is None else span["newest"] - int(delay_seconds * 1e6)) if t is not None]
    watermark = max((f["last"] for f in folders), default=passed) if last else max(newest, default=None)
    closing = [f for f in folders if watermark is not None and f["first"] <= watermark]
    if closing:
        rows = spark.read.schema(schema).parquet(*[f"{path}/{f['path']}" for f in closing])
        due = (F.col(END) <= watermark) & (F.lit(True) if passed is None else F.col(END) > passed)
        _publish(rows.where(due), path, batch_id)
    # What stays open in a folder begins after the watermark.
    still = [f | {"first": max(f["first"], (watermark or f["first"] - 1) + 1)} for f in folders if watermark is None or f["last"] > watermark]
    _commit(spark, path, {"batch_id": batch_id, "watermark": watermark, "open": still})
    kept = {f["path"] for f in still}
    for gone in {f["path"] for f in folders} | {folder}:
        if gone not in kept:
            delete_path(spark, f"{path}/{gone}")


def close_all(spark: SparkSession, path: str, published: str = "publish_time", **options) -> None:
    """Publish what is still open, after the last micro-batch."""
    state = _state(spark, path)
    if state["open"]:
        rows = spark.read.parquet(f"{path}/{state['open'][0]['path']}").limit(0).drop(START, SHARD, END)
        close_windows(rows, state["batch_id"] + 1, path, published, last=True, **options)


def write_closed_windows(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **options) -> StreamingQuery:
    """Run ``close_windows`` on every micro-batch of a stream."""
    writer = stream.writeStream.foreachBatch(lambda batch, batch_id: close_windows(batch, batch_id, path, **options))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _committed(spark: SparkSession, path: str, table: str) -> list[str]:
    """Folders of finished micro-batches; a failed one may have left a folder that its replay replaces."""
    newest = _state(spark, path)["batch_id"]
    names = [name for name in list_names(spark, f"{path}/{table}") if name.startswith("batch=")]
    return [f"{path}/{table}/{name}" for name in names if int(name.removeprefix("batch=")) <= newest]


def read_windows(spark: SparkSession, path: str) -> DataFrame | None:
    """``window_start, shard, messages, batch``: one row per publication."""
    folders = _committed(spark, path, "windows")
    return spark.read.option("basePath", f"{path}/windows").parquet(*folders) if folders else None


def read_published(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Published rows; ``schema`` names the columns wanted, of ``date, hour, minute, shard, window_start, batch`` too."""
    folders = _committed(spark, path, "published")
    return spark.read.schema(schema).options(basePath=f"{path}/published", **JSON_TIMES).json(folders) if folders else None


def read_late(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows that came after their window was published, with the number of their micro-batch."""
    folders = _committed(spark, path, "late")
    return spark.read.option("basePath", f"{path}/late").parquet(*folders) if folders else None
