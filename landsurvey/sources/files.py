"""Files in any store that Spark's file systems reach, written from the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _store(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one file, replacing an old one."""
    store, where = _store(spark, path)
    out = store.create(where, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def put_all(spark: SparkSession, rows: DataFrame, folder: str) -> int:
    """Write rows (name, content) as the only files of a folder; how many there are.

    One row at a time is on the driver. Rows are tiles of a grid, each bounded."""
    clear(spark, folder)
    n = 0
    for name, content in rows.select("name", "content").toLocalIterator():
        put(spark, f"{folder}/{name}", bytes(content))
        n += 1
    return n


def clear(spark: SparkSession, folder: str) -> None:
    store, where = _store(spark, folder)
    store.delete(where, True)
    store.mkdirs(where)


def get(spark: SparkSession, path: str) -> bytes:
    """The bytes of one file."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
