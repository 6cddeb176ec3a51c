"""Messages on the wire: byte payloads that hold one JSON object each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

RAW = "value"


def decode_utf8(payload: Column | str) -> Column:
    return F.decode(payload, "UTF-8")


def holds_keys(raw: Column | str, fields: Sequence[str]) -> Column:
    """True where ``raw`` is a JSON object with every key present; a key whose value is null is present.

    Presence has to be read off the raw text, as parsing turns both cases into NULL.
    """
    wanted = F.array(*[F.lit(name) for name in fields])
    missing = F.array_except(wanted, F.json_object_keys(raw))
    return F.coalesce(F.size(missing) == 0, F.lit(False))


def is_object(raw: Column | str) -> Column:
    return F.json_object_keys(raw).isNotNull()


def parse_object(df: DataFrame, schema: T.StructType, raw: str = RAW, mode: str = "drop", checked: bool = False) -> DataFrame:
    """Add one column per schema field.

    ``mode="drop"`` leaves out payloads that are not JSON objects, ``mode="fail"`` stops the job on them. ``checked``
    spares the check of rows that were already filtered by ``holds_keys``.
    """
    if mode == "drop":
        df, parser = df if checked else df.where(is_object(raw)), "PERMISSIVE"
    elif mode == "fail":
        parser = "FAILFAST"
    else:
        raise ValueError(f"mode is 'drop' or 'fail', not {mode!r}")
    kept = [F.col(name) for name in df.columns if name != raw and name not in schema.names]
    record = F.from_json(raw, schema, {"mode": parser})
    return df.select(*kept, F.col(raw), record.alias("__record")).select(*kept, F.col(raw), "__record.*")


def split_rejects(df: DataFrame, fields: Sequence[str], raw: str = RAW) -> tuple[DataFrame, DataFrame]:
    """(payloads with all keys, all other payloads)."""
    good = holds_keys(raw, fields)
    return df.where(good), df.where(~good)


def default_when_absent(raw: Column | str, key: str, value: Column, default: str = "") -> Column:
    """``value``, but ``default`` where the object lacks the key; an explicit null stays null."""
    return F.when(~F.array_contains(F.json_object_keys(raw), key), F.lit(default)).otherwise(value)
