"""Batch readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ticktalk.operators.clusters import latest_centres
from ticktalk.schemas import CENTROID

# Values come back as they were: blanks at their ends stay, and null and the empty text differ.
CSV = {"header": True, "escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_json_tree(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, pretty: bool = False) -> DataFrame:
    """Every ``*.json`` below ``path``; arrays of records become rows. ``pretty`` is for records over several lines,
    whose files cannot be split."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return (reader.option("multiLine", True) if pretty else reader).json(path)


def read_drifting_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet files whose columns differ, united by name in one scan."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("mergeSchema", True).parquet(*paths)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """What ``write_csv_table`` wrote. ``multi_line`` is for values that hold newlines; such files cannot be split."""
    reader = spark.read.schema(schema).options(**CSV).option("multiLine", multi_line)
    return (reader if multi_line else reader.option("lineSep", "\n")).csv(path)


def read_centres(spark: SparkSession, path: str) -> DataFrame:
    """Centres from the JSON-lines part files below ``path``; a later file, and in a file a later line,
    overrides an earlier one."""
    rows = (
        spark.read.schema(CENTROID)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*part*.json")
        .json(path)
        .where(F.col("cluster").isNotNull())
        .select("cluster", "centroid", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    )
    # Lines of one block of a file are read in their order by one task.
    placed = rows.select("cluster", "centroid", F.struct("file_path", "file_block_start", "row").alias("place"))
    return latest_centres(placed, "place")


def read_channels(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(name, channel_id) from ``name: id`` lines; lines that start with ``#`` are comments. Ids stay text."""
    line = r"^\s*([^#:\s][^:]*?)\s*:\s*(\S.*?)\s*$"
    parts = spark.read.text(path).where(F.rlike("value", F.lit(line)))
    return parts.select(
        F.regexp_extract("value", line, 1).alias("name"), F.regexp_extract("value", line, 2).alias("channel_id")
    )


def read_serving_table(spark: SparkSession, name: str) -> DataFrame:
    """A whole catalog table, or Parquet files if ``name`` is a path; Spark reads only the columns used later."""
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)
