"""File-system questions, answered by the Hadoop client so that any Spark path works."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = _file_system(spark, path)
    return bool(fs.globStatus(location))


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, location = _file_system(spark, path)
    return fs.exists(location) and fs.getFileStatus(location).isDirectory()


def path_size(spark: SparkSession, path: str) -> int:
    fs, location = _file_system(spark, path)
    return fs.getContentSummary(location).getLength()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    fs, location = _file_system(spark, path)
    return sorted(c.getPath().getName() for c in fs.listStatus(location)) if fs.exists(location) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, location = _file_system(spark, path)
    fs.delete(location, True)


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    """The first bytes of a file, or of the first data file with any in a folder, by name."""
    fs, location = _file_system(spark, path)
    for found in fs.globStatus(location) or []:
        if found.isDirectory():
            children = sorted(fs.listStatus(found.getPath()), key=lambda c: c.getPath().getName())
            for child in children:
                if not child.getPath().getName().startswith(("_", ".")):
                    held = first_bytes(spark, child.getPath().toString(), n)
                    if held:
                        return held
        elif found.getLen():
            stream = fs.open(found.getPath())
            try:
                held = [stream.read() for _ in range(min(n, found.getLen()))]
            finally:
                stream.close()
            return bytes(held)
    return b""


def require_path(spark: SparkSession, path: str) -> str:
    """Fail before any work is started if there is no input."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Input not found: {path}")
    return path


#: A session setting that names the working folder, for sessions without a checkpoint folder.
WORK_FOLDER = "pairloom.work.folder"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder all executors share: the one of spark.checkpoint.dir, else that of
    WORK_FOLDER. There is no local folder to fall back to."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(WORK_FOLDER, None)
    if not base:
        raise ValueError(f"Set spark.checkpoint.dir or {WORK_FOLDER} to a folder that all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: for a result that several jobs read and
    that is dear to compute. Readers then scan only the columns they need, and a lost executor
    costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
