"""Shared by the operators of this package: words, Arrow chunks of bounded size, and the query registry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticktalk.session import settle

#: White space that separates words: the ASCII blanks. ``bytes.split()`` uses the same set.
BLANKS = r"[\x20\x09-\x0D]+"

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        LLM_QUERIES[function.__name__] = function
        if sql is not None:
            LLM_ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet."""
    while name in df.columns:
        name = "_" + name
    return name


def text_key(text: Column) -> Column:
    """Tells rows that share an id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANKS)
    return (F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - (F.when(F.size(parts) > 1, F.element_at(parts, -1) == "").otherwise(False)).cast("int")).cast("long")


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def may_meet(df: DataFrame, needed: DataFrame, key: Column, slots: int = 1 << 18) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be one of ``needed``: both are hashed to ``slots`` numbers, and those in use are broadcast,
    at most ``slots`` integers whatever the data. The join that follows then moves few other rows."""
    slot = F.pmod(F.xxhash64(key), F.lit(slots)).cast("int").alias("_slot")
    used = settle(needed.select(slot).distinct().coalesce(1), "slots")
    return df.withColumn("_slot", slot).join(F.broadcast(used), "_slot", "left_semi").drop("_slot")


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``limit`` bytes of ``column`` each, one row at least. All rows pass, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start = size = 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start)
