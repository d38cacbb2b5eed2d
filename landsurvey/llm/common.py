"""Helpers the corpus operators share: shared storage, row ids, byte kernels."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Largest side, in rows, that an operator broadcasts after counting it.
BROADCAST_ROWS = 10_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, set here only where unset
    and the driver is the only machine."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="landsurvey-shared-")
        spark.sparkContext.setCheckpointDir(known)
    return known.rstrip("/")


def map_batches(spark: SparkSession, df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow with this package at hand in the workers."""
    ship(spark)
    return df.mapInArrow(run, schema)


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused folder in the shared one; Hadoop removes it when the session ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    files, where = _files(spark, path)
    files.deleteOnExit(where)
    if _collecting:
        _collecting[-1].append(path)
    return path


def _files(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


_collecting: list[list[str]] = []


@contextmanager
def collected(paths: list[str]):
    """Note in paths the folders that fresh_path gives out meanwhile."""
    _collecting.append(paths)
    try:
        yield
    finally:
        _collecting.pop()


def release(spark: SparkSession, paths: list[str], needed: DataFrame) -> None:
    """Delete the noted folders, but for those that needed reads from."""
    read = needed.inputFiles() if paths else []
    kept = [p for p in paths if any(f"{p.split('/')[-1]}/" in f for f in read)]
    for p in paths:
        if p not in kept:
            files, where = _files(spark, p)
            files.delete(where, True)
    paths[:] = kept


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet in the shared folder and read it back."""
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Let the driver collect its garbage. Only then does Spark delete what finished jobs
    shuffled and broadcast, which fills the executors' disks until it does."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def plain_columns(df: DataFrame, **named: Column) -> DataFrame:
    """Only the named columns, so that extra ones with clashing names do no harm."""
    return df.select(*[c.alias(k) for k, c in named.items()])


def column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_row_ids(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """The rows of docs as a struct ``doc``, whatever its columns are called, with a
    ``row_id``; written to the shared folder, so that ids stay as they are."""
    whole = F.struct(*[column(c).alias(c) for c in docs.columns])
    return materialise(spark, docs.select(whole.alias("doc"), F.monotonically_increasing_id().alias("row_id")), name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A key with more than this share of all rows is hot; fewer than its inverse are.
HOT_SHARE = 0.001


def join_counted(rows: DataFrame, facts: DataFrame, key: str, total: int) -> DataFrame:
    """Join each row to the one fact of its key; facts.n counts the key's rows.

    Facts of hot keys, under 1 / HOT_SHARE of them whatever the input, are
    broadcast, so that no task gets all rows of one; the rest is joined by key.
    facts must be materialised: it is read three times.
    """
    is_hot = F.col("n") > max(1.0, HOT_SHARE * total)
    hot = F.broadcast(facts.filter(is_hot))
    of_hot = rows.join(hot, key)
    of_rest = rows.join(F.broadcast(facts.filter(is_hot).select(key)), key, "left_anti").join(facts.filter(~is_hot), key)
    return of_hot.unionByName(of_rest).drop("n")


def utf8_slices(column: pa.Array, most_bytes: int):
    """Cut a string column into runs of rows of about most_bytes together.

    Yields (first row, row bounds, bytes): a row longer than most_bytes comes
    alone and whole. Null rows are empty.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most_bytes, "right")) - 1)
        yield row, bounds[row : end + 1] - bounds[row], raw[bounds[row] : bounds[end]]
        row = end


def byte_powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; base is odd."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))
