"""Folders of a layer on the session's own file system: which exist, which partitions they hold, dropping some."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a NULL key


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, read) -> DataFrame:
    """``read()`` with its folders listed by a few tasks of many folders each. Left to itself Spark makes a task of
    every folder, up to 10,000 a level, and a layer of many units is listed again for each of its steps."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        return read()
    finally:
        spark.conf.set(key, before)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there."""
    at, fs = _path(spark, path)
    return fs.exists(at)


def drop_folders(spark: SparkSession, folders: list[str]) -> list[str]:
    """Delete folders with all they hold; returns those that were there. A folder already gone is no error,
    so a call that was cut off can be repeated."""
    gone = []
    for folder in folders:
        at, fs = _path(spark, folder)
        if fs.exists(at):
            if not fs.delete(at, True):
                raise OSError(f"{folder} could not be deleted")
            gone.append(folder)
    return gone


def key_of_path(path: Column, key: str) -> Column:
    """The value that a partition folder of ``path`` gives to ``key``."""
    text = F.regexp_extract(path, rf"/{key}=([^/]*)/", 1)
    value = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(text != NO_VALUE, value)


def partition_files(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """``keys.., folder, path, bytes`` of every data file, from the listing alone; no rows for a layer not yet written."""
    if not exists(spark, root):
        names = ", ".join(f"`{k}` string" for k in keys)
        return spark.createDataFrame([], f"{names}, folder string, path string, bytes bigint")
    reader = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
    )
    files = listed(spark, lambda: reader.load(root))
    path = F.col("path")
    return files.select(
        *[key_of_path(path, k).alias(k) for k in keys],
        F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("folder"),
        path,
        F.col("length").alias("bytes"),
    )
