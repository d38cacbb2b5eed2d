"""Parametric outlines for placed assets."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def superellipse(spark: SparkSession, half_width: float, exponent: float, z: float, count: int) -> DataFrame:
    """k, x, y, z: count vertices of |x|^n + |y|^n = half_width^n by angle."""
    angle = F.col("k") * (2.0 * math.pi / count)
    part = lambda v: F.signum(v) * F.pow(F.abs(v), F.lit(2.0 / exponent)) * half_width
    return spark.range(count).select(F.col("id").cast("int").alias("k")).select("k", part(F.cos(angle)).alias("x"), part(F.sin(angle)).alias("y"), F.lit(float(z)).alias("z"))


def arc_length(ring: DataFrame) -> DataFrame:
    """ring with u: share of the way around at each vertex. A ring is a few hundred rows."""
    w, every = Window.partitionBy(F.lit(1)).orderBy("k"), Window.partitionBy(F.lit(1))
    step = F.sqrt(F.pow(F.col("x") - F.lag("x").over(w), 2) + F.pow(F.col("y") - F.lag("y").over(w), 2))
    steps = ring.withColumn("step", F.coalesce(step, F.lit(0.0)))
    return steps.withColumn("u", F.sum("step").over(w) / F.sum("step").over(every)).drop("step")
