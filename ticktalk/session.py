"""Session helpers: a local session for tests and benches, and the shared folder for written intermediates."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "ticktalk", cpus: str | int = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A UTC session on this machine, for tests and benches. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    A machine-local folder is made only in local mode, and only when nothing is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ticktalk-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/ticktalk/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled", path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so that later passes and lost executors restart from
    files instead of the whole lineage. The files stay until ``discard`` is called on their path."""
    path = path or scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are done with: it does so when the driver's JVM drops the plans, which may be late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete what ``settle`` wrote to these paths. Only paths below the shared scratch folder are touched."""
    root = f"{shared_dir(spark)}/ticktalk/"
    for path in paths:
        if not path.startswith(root):
            raise ValueError(f"{path} is not below {root}")
        delete_path(spark, path)


# Small files of the shared file system, whatever store it is. Rows always go through Spark.


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if it is not there."""
    target, files = _file_system(spark, folder)
    return [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []


def read_file(spark: SparkSession, path: str) -> str:
    target, files = _file_system(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small new file."""
    target, files = _file_system(spark, path)
    stream = files.create(target, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def rename_new(spark: SparkSession, path: str, to: str) -> bool:
    """Move a file to a place where none is yet; False if there is one."""
    source, files = _file_system(spark, path)
    target, _ = _file_system(spark, to)
    return not files.exists(target) and files.rename(source, target)


def delete_path(spark: SparkSession, path: str) -> None:
    target, files = _file_system(spark, path)
    files.delete(target, True)
