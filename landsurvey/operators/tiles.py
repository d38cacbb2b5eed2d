"""Per-tile summaries, missing tiles, fetch jobs and accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def grid(spark: SparkSession, nx: int, ny: int) -> DataFrame:
    """All tiles of the grid: tile_x, tile_y."""
    i = spark.range(nx).select(F.col("id").cast("int").alias("tile_x"))
    return i.crossJoin(spark.range(ny).select(F.col("id").cast("int").alias("tile_y")))


def fetch_jobs(spark: SparkSession, kinds: list[str], nx: int, ny: int) -> DataFrame:
    """One job per kind and tile; the grid is configuration."""
    return spark.createDataFrame([(k,) for k in kinds], "kind string").crossJoin(grid(spark, nx, ny))


def status_counts(results: DataFrame) -> DataFrame:
    """Count by status, and whether the status is a hard failure (EMPTY is legal)."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("files")).withColumn("fatal", F.col("status").isin("BAD", "ERR"))


def missing(wanted: DataFrame, have: DataFrame) -> DataFrame:
    return wanted.join(have.select("tile_x", "tile_y").distinct(), ["tile_x", "tile_y"], "left_anti")


def terrain_stats(cells: DataFrame) -> DataFrame:
    """Of filled cells with slope and nodata: ranges, slopes, steep cells by tile."""
    return cells.groupBy("tile_x", "tile_y").agg(
        F.min("z").alias("min_m"), F.max("z").alias("max_m"), F.count_if("nodata").alias("nodata_cells"), F.max("slope").alias("slope_max"),
        F.percentile("slope", F.lit(0.99)).alias("slope_p99"), F.count_if(F.col("slope") > 45).alias("over_45"),
    )


def covered(cells: DataFrame, least: float = 0.01) -> DataFrame:
    """Tiles with at least this share of measured cells, and their lowest height."""
    share = F.avg(F.col("z").isNotNull().cast("double"))
    return cells.groupBy("tile_x", "tile_y").agg(F.min("z").alias("low"), share.alias("share")).filter(F.col("share") >= least)


def water_tiles(cells: DataFrame, every: DataFrame, level: float, margin: float, missing_is_water: bool) -> DataFrame:
    """Tiles that reach down to the water, and tiles without ground if those count."""
    ok = covered(cells)
    wet = ok.filter(F.col("low") < level + margin).select("tile_x", "tile_y")
    return wet.union(missing(every, ok)).distinct() if missing_is_water else wet


def hectares(flag: str, cell_area: float):
    return F.count_if(flag) * (cell_area / 1e4)


def most_common(rows: DataFrame, key: str, k: int) -> DataFrame:
    """The k largest counts, ties by name."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), key).limit(k)
