"""Keyed tables in Parquet: one row per key, the last write wins.

A table is a log. A write adds a *delta*, the rows of the batch, and changes no file; readers merge the deltas, the newer ones
first, with the *base*, which is split into buckets by a hash of the key. A *manifest* per version lists the files that belong
to the table; renaming it to its place is the only step that readers see, so a write that fails leaves the version before it.

Deltas of similar size are merged from time to time. Once they hold as many rows as the base (and ``least_rows``), the buckets they have keys in are
rewritten, and those that outgrow ``split_rows`` are split. Each table has one writer at a time; a second one is refused.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ticktalk.operators.enrich import latest_per_key
from ticktalk.session import delete_path, list_names, read_file, rename_new, write_file

SPLIT_ROWS = 4_000_000
MANY_DELTAS = 8
LEAST_ROWS = 100_000  # fewer rows in deltas are not worth rewriting the base
KEPT_VERSIONS = 4

_VERSION = "__version"
_LEAF = "bucket__"


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return sorted(name for name in list_names(spark, f"{path}/_manifest") if name.startswith("v"))


def _manifest(spark: SparkSession, path: str) -> dict | None:
    names = _manifests(spark, path)
    return json.loads(read_file(spark, f"{path}/_manifest/{names[-1]}")) if names else None


def _commit(spark: SparkSession, path: str, manifest: dict) -> dict:
    """Make the next version visible. Raises if another writer has made it first."""
    manifest = manifest | {"version": manifest["version"] + 1}
    aside = f"{path}/_manifest/.{uuid.uuid4().hex}"
    write_file(spark, aside, json.dumps(manifest))
    if not rename_new(spark, aside, f"{path}/_manifest/v{manifest['version']:012d}.json"):
        delete_path(spark, aside)
        raise RuntimeError(f"version {manifest['version']} of {path} was written by another writer")
    return manifest


def _schema(manifest: dict) -> T.StructType:
    return T.StructType.fromJson(manifest["schema"])


def _newest(spark: SparkSession, path: str, manifest: dict, deltas: list[dict]) -> DataFrame:
    """The last row of each key in these deltas, with the version that wrote it."""
    schema = T.StructType([*_schema(manifest).fields, T.StructField(_VERSION, T.LongType())])
    rows = spark.read.schema(schema).parquet(*[f"{path}/{d['path']}" for d in deltas])
    return latest_per_key(rows, manifest["keys"], [_VERSION]) if len(deltas) > 1 else rows


def _base(spark: SparkSession, path: str, manifest: dict, leaves: list[dict]) -> DataFrame | None:
    paths = [f"{path}/{leaf['path']}" for leaf in leaves if leaf["path"]]
    return spark.read.schema(_schema(manifest)).parquet(*paths) if paths else None


def _merged(base: DataFrame | None, newest: DataFrame, keys: Sequence[str]) -> DataFrame:
    newest = newest.drop(_VERSION)
    if base is None:
        return newest
    named = newest.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [base[k].eqNullSafe(named[f"__{i}"]) for i, k in enumerate(keys)])
    return base.join(named, same, "left_anti").unionByName(newest)


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of the table, or None if it was never written."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return None
    base = _base(spark, path, manifest, manifest["leaves"])
    if manifest["deltas"]:
        return _merged(base, _newest(spark, path, manifest, manifest["deltas"]), manifest["keys"])
    return base if base is not None else spark.createDataFrame([], _schema(manifest))


def _widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both; new ones are null in older rows. A column keeps its type."""
    known = {f.name: f.dataType for f in old.fields}
    changed = [f.name for f in new.fields if f.name in known and known[f.name] != f.dataType]
    if changed:
        raise ValueError(f"columns {changed} have other types than in the table")
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in old.fields], *[T.StructField(f.name, f.dataType) for f in new.fields if f.name not in known]])


def upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    writer: str | None = None,
    batch_id: int | None = None,
    split_rows: int = SPLIT_ROWS,
    many_deltas: int = MANY_DELTAS,
    least_rows: int = LEAST_ROWS,
) -> None:
    """Replace or add the rows of ``batch``; of equal keys within it the last by ``order`` counts. Null keys are keys.

    Only the rows of the batch are written, until merging is due. A ``batch_id`` that ``writer`` has already brought, or one
    before it, is left out, so a replayed micro-batch changes nothing.
    """
    spark, keys = batch.sparkSession, list(keys)
    manifest = _manifest(spark, path)
    if manifest is None:
        manifest = {"version": 0, "keys": keys, "schema": T.StructType([]).jsonValue(), "leaves": [{"bits": 0, "depth": 0, "path": None, "rows": 0}], "deltas": [], "writers": {}}
    if manifest["keys"] != keys:
        raise ValueError(f"{path} has the keys {manifest['keys']}")
    if writer is not None and batch_id is not None:
        if batch_id <= manifest["writers"].get(writer, -1):
            return
        manifest["writers"][writer] = batch_id
    manifest["schema"] = _widened(_schema(manifest), batch.schema).jsonValue()
    place = f"delta/{uuid.uuid4().hex}"
    rows = latest_per_key(batch, keys, order).withColumn(_VERSION, F.lit(manifest["version"] + 1).cast("long"))
    rows.write.parquet(f"{path}/{place}")
    count = spark.read.schema(rows.schema).parquet(f"{path}/{place}").count()
    if count and count <= split_rows and not manifest["deltas"] and not any(leaf["path"] for leaf in manifest["leaves"]):
        # The first rows are the base, as they are; readers leave the version column out.
        manifest["leaves"] = [{"bits": 0, "depth": 0, "path": place, "rows": count}]
    elif count:
        manifest["deltas"].append({"path": place, "rows": count})
    else:
        delete_path(spark, f"{path}/{place}")
        if writer is None:
            return
    manifest = _commit(spark, path, manifest)
    held, added = sum(leaf["rows"] for leaf in manifest["leaves"]), sum(d["rows"] for d in manifest["deltas"])
    if added >= max(held, least_rows):
        compact(spark, path, split_rows)
    elif len(manifest["deltas"]) >= many_deltas:
        _merge_deltas(spark, path, manifest)


def _merge_deltas(spark: SparkSession, path: str, manifest: dict) -> None:
    """Write the last deltas as one, back to the first that holds more rows than twice all after it."""
    deltas, some = manifest["deltas"], 1
    while some < len(deltas) and deltas[-some - 1]["rows"] <= 2 * sum(d["rows"] for d in deltas[-some:]):
        some += 1
    if some < 2:
        return
    place = f"delta/{uuid.uuid4().hex}"
    rows = _newest(spark, path, manifest, deltas[-some:])
    rows.write.parquet(f"{path}/{place}")
    count = spark.read.schema(rows.schema).parquet(f"{path}/{place}").count()
    _commit(spark, path, manifest | {"deltas": [*deltas[:-some], {"path": place, "rows": count}]})
    vacuum(spark, path)


def _in_leaves(rows: DataFrame, keys: Sequence[str], leaves: list[dict]) -> DataFrame:
    """Rows with the number ``__leaf`` of their bucket. A row has one candidate for each depth in use, and one of them is there."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(n, leaf["bits"], leaf["depth"]) for n, leaf in enumerate(leaves)], "__leaf int, __bits long, __depth int")
    depths = sorted({leaf["depth"] for leaf in leaves})
    hashed = F.xxhash64(*keys)
    tried = F.array(*[F.struct(F.lit(d).alias("d"), hashed.bitwiseAND(F.lit((1 << d) - 1)).alias("b")) for d in depths])
    candidates = rows.withColumn("__c", F.explode(tried))
    found = candidates.join(F.broadcast(table), (F.col("__c.d") == F.col("__depth")) & (F.col("__c.b") == F.col("__bits")))
    return found.drop("__c", "__bits", "__depth")


def compact(spark: SparkSession, path: str, split_rows: int = SPLIT_ROWS) -> None:
    """Merge all deltas into the buckets they have keys in, and split buckets that hold more than ``split_rows`` rows."""
    manifest = _manifest(spark, path)
    if manifest is None or not manifest["deltas"]:
        return
    keys, leaves = manifest["keys"], manifest["leaves"]
    newest = _newest(spark, path, manifest, manifest["deltas"])
    touched = {r["__leaf"]: r["count"] for r in _in_leaves(newest, keys, leaves).groupBy("__leaf").count().collect()}  # one row per bucket
    children = []
    for n, added in touched.items():
        leaf = leaves[n]
        more = max(0, math.ceil(math.log2(max(1, (leaf["rows"] + added) / split_rows))))
        children += [{"bits": leaf["bits"] | (k << leaf["depth"]), "depth": leaf["depth"] + more, "path": None, "rows": 0} for k in range(1 << more)]
    rows = _merged(_base(spark, path, manifest, [leaves[n] for n in touched]), newest, keys)
    place = f"base/{uuid.uuid4().hex}"
    laid_out = _in_leaves(rows, keys, children).withColumnRenamed("__leaf", _LEAF)
    laid_out.hint("rebalance", _LEAF).write.partitionBy(_LEAF).parquet(f"{path}/{place}")
    written = spark.read.schema(laid_out.schema).parquet(f"{path}/{place}").groupBy(_LEAF).count().collect()  # one row per bucket
    for row in written:
        children[row[_LEAF]] |= {"path": f"{place}/{_LEAF}={row[_LEAF]}", "rows": row["count"]}
    kept = [leaf for n, leaf in enumerate(leaves) if n not in touched]
    _commit(spark, path, manifest | {"leaves": kept + children, "deltas": []})
    vacuum(spark, path)


def vacuum(spark: SparkSession, path: str, versions: int = KEPT_VERSIONS) -> None:
    """Delete the files that none of the last ``versions`` versions lists, and the older manifests."""
    names = _manifests(spark, path)
    old, recent = names[:-versions], names[-versions:]

    def listed(some: list[str]) -> set[str]:
        found = [json.loads(read_file(spark, f"{path}/_manifest/{name}")) for name in some]
        return {p["path"] for m in found for p in [*m["leaves"], *m["deltas"]] if p["path"]}

    if old:
        for gone in listed(old) - listed(recent):
            delete_path(spark, f"{path}/{gone}")
        for name in old:
            delete_path(spark, f"{path}/_manifest/{name}")
