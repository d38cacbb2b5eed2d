"""Record files and manifests, one folder per tile."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship


def _rounded(values: pa.Array, digits: int) -> pa.Array:
    """All doubles inside an array rounded as Python does."""
    kind = values.type
    if pa.types.is_floating(kind):
        return pa.array([None if v is None else round(v, digits) for v in values.to_pylist()], kind)
    if pa.types.is_list(kind):
        flat = _rounded(values.flatten(), digits)
        sizes = [len(v) if v.is_valid else 0 for v in values]
        ends = [0]
        for n in sizes:
            ends.append(ends[-1] + n)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=values.is_null())
    if pa.types.is_struct(kind):
        return pa.StructArray.from_arrays([_rounded(x, digits) for x in values.flatten()], fields=list(kind), mask=values.is_null())
    return values


def rounded(spark: SparkSession, records: DataFrame, digits: int = 2) -> DataFrame:
    """records with all doubles, in lists and structs too, rounded by their binary value,
    half to even (T1). For sinks."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_rounded(c, digits) for c in batch.columns], names=batch.schema.names)

    ship(spark)
    return records.mapInArrow(run, records.schema)


def write_tiles(records: DataFrame, path: str, order: list[str], digits: int | None = None) -> None:
    """JSON lines by tile_x and tile_y, nulls written, old tiles replaced."""
    records = records if digits is None else rounded(records.sparkSession, records, digits)
    ready = records.repartition("tile_x", "tile_y").sortWithinPartitions("tile_x", "tile_y", *order)
    ready.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("tile_x", "tile_y").json(path)


def read_tiles(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def manifest(**facts: Column) -> Column:
    """One JSON text of named aggregates, for ``df.agg(manifest(...))``."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in facts.items()]), {"ignoreNullFields": "false"}).alias("manifest")


def listed(columns: list[str], order: list[str]) -> Column:
    """A list of structs of columns, in order; for the few rows of a manifest."""
    rank = [F.col(c).alias(f"_{c}") for c in order]
    return F.transform(F.array_sort(F.collect_list(F.struct(*rank, *columns))), lambda r: F.struct(*[r[c].alias(c) for c in columns]))


def provenance(spark: SparkSession, pattern: str) -> DataFrame:
    """path, bytes, sha256 and time of every file."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.date_format(F.col("modificationTime"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("modified"))
