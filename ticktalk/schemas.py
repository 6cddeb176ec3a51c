"""Declared schemas of the entities, and table schemas kept as JSON documents."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession, types as T

# The fields of messages and quotes on the wire, in table order.
MESSAGE_FIELDS = (
    "message_id", "text", "username", "first_name", "last_name",
    "user_id", "is_bot", "channel_name", "channel_id", "timestamp",
)
QUOTE_FIELDS = ("symbol", "price", "timestamp")


_TEXT, _TIME = T.StringType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


MESSAGE = _struct(**{name: _TEXT for name in MESSAGE_FIELDS} | {"is_bot": T.BooleanType(), "timestamp": _TIME})
# On the wire every field is text: ids come as numbers or strings, flags as booleans or strings, times in two forms.
MESSAGE_WIRE = _struct(**{name: _TEXT for name in MESSAGE_FIELDS})
EMBEDDING = _struct(message_id=_TEXT, embedding=T.ArrayType(T.FloatType()))
EMBEDDING_CSV = _struct(message_id=_TEXT, embedding=_TEXT)
QUOTE = _struct(symbol=_TEXT, price=T.DoubleType(), timestamp=_TIME)
QUOTE_WIRE = _struct(symbol=_TEXT, price=_TEXT, timestamp=_TEXT)
ASSIGNMENT = _struct(message_id=_TEXT, cluster=T.IntegerType())
CENTROID = _struct(cluster=T.IntegerType(), centroid=T.ArrayType(T.DoubleType()))
CHANNEL = _struct(name=_TEXT, channel_id=_TEXT)
SCORED = T.StructType(MESSAGE.fields + EMBEDDING.fields[1:] + ASSIGNMENT.fields[1:])

# Warehouse column types and the Spark type of each (fixed values).
_COLUMN_TYPES = {
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
}


def read_table_document(spark: SparkSession, path: str) -> dict:
    """One JSON table description, from any file system Spark can read."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def struct_from_document(document: dict) -> T.StructType:
    """``{"schema": {"fields": [{"name", "type", "mode"}]}}`` as a Spark schema; REPEATED becomes an array."""
    fields = []
    for column in document["schema"]["fields"]:
        kind = _COLUMN_TYPES[column["type"].upper()]
        mode = column.get("mode", "NULLABLE").upper()
        fields.append(T.StructField(column["name"], T.ArrayType(kind) if mode == "REPEATED" else kind, mode != "REQUIRED"))
    return T.StructType(fields)


def column_list(document: dict) -> str:
    """The ``name:TYPE,name:TYPE`` form of the same document."""
    return ",".join(":".join((column["name"], column["type"])) for column in document["schema"]["fields"])
