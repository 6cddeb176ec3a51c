"""Timestamps: parsing, text forms, and the date parts used as partition keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOUR_PARTS = ("year", "month", "day", "hour")


def parse_time(text: Column | str, mode: str = "drop") -> Column:
    """ISO times with ``Z`` or an offset, ``T`` or a blank between; bad text is NULL, or an error with ``mode="fail"``."""
    return F.to_timestamp(text) if mode == "fail" else F.try_to_timestamp(text)


def ingest_time() -> Column:
    return F.current_timestamp()


def publish_stamp(ts: Column | str) -> Column:
    """Text with microseconds."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def whole_seconds(ts: Column | str) -> Column:
    """Text cut to whole seconds."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def with_hour_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.day(ts), "hour": F.hour(ts)})


def path_parts(start: Column | str) -> dict[str, Column]:
    """``date``, ``hour`` and ``minute`` as zero-padded text, for folder names."""
    return {
        "date": F.date_format(start, "yyyy-MM-dd"),
        "hour": F.date_format(start, "HH"),
        "minute": F.date_format(start, "mm"),
    }


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds with their fraction, for either timestamp type."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(1e6)
