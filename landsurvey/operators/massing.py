"""Building heights: zonal statistics, storey calibration, the evidence ladder, records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Calibration, Tuning
from ..functions.scalar import first_true, height_tag, levels, seed, tag


def zonal(pixels: DataFrame) -> DataFrame:
    """idx, p25, p50, p90 of ndsm, npx, d15 and dmin of dtm, for zones with ground."""
    shares = F.percentile("ndsm", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.9)))  # one map of the values for all three
    found = pixels.groupBy("idx").agg(
        shares.alias("p"), F.count("ndsm").cast("int").alias("npx"), F.percentile("dtm", F.lit(0.15)).alias("d15"),
        F.min("dtm").alias("dmin"), F.count("dtm").alias("ground"),
    )
    return found.filter("ground > 0").select("idx", *[F.col("p")[k].alias(c) for k, c in enumerate(("p25", "p50", "p90"))], "npx", "d15", "dmin")


def evidence(footprints: DataFrame, stats: DataFrame) -> DataFrame:
    """Footprints (idx, osm_id, building, name, levels_tag, other_tags, ...) with their
    statistics; without a height pixel the percentiles are unknown, the ground is not."""
    out = footprints.join(stats, "idx", "left").withColumn("npx", F.coalesce("npx", F.lit(0)))
    for c in ("p25", "p50", "p90"):
        out = out.withColumn(c, F.when(F.col("npx") > 0, F.col(c)))
    return (
        out.withColumn("levels", levels(first_true("levels_tag", tag("other_tags", "building:levels"))))
        .withColumn("height_tag", tag("other_tags", "height"))
        .withColumn("gap", F.when(F.col("dmin").isNull(), "no_lidar").when(F.col("npx") == 0, "no_dsm").otherwise("none"))
    )


def calibrate(rows: DataFrame, tuning: Tuning, calibration: Calibration) -> DataFrame:
    """One row: intercept, m_per_level, source, n, rejected, rmse.

    Least squares of p50 by levels, one pass that drops what lies more than two
    deviations or 2 m off, and a second fit; numbers are rounded before use."""
    fixed, (a0, b0) = calibration.intercept is not None, calibration.fallback
    given = (calibration.intercept, calibration.m_per_level) if fixed else (a0, b0)
    least = calibration.min_buildings
    pairs = rows.filter((F.col("levels").between(1, 30)) & (F.col("npx") >= tuning.min_pixels) & F.col("height_tag").isNull() & F.col("p50").isNotNull()).select(
        F.col("levels").cast("double").alias("l"), F.col("p50").alias("h")
    )
    off = F.col("h") - (F.col("a") + F.col("b") * F.col("l"))
    rest = lambda b: F.sqrt(F.greatest((F.col("syy") - b * b * F.col("sxx")) / F.col("m"), F.lit(0.0)))
    sums = (F.regr_syy("h", "l").alias("syy"), F.regr_sxx("h", "l").alias("sxx"), F.count(F.lit(1)).alias("m"))
    one = pairs.agg(F.regr_slope("h", "l").alias("b"), F.regr_intercept("h", "l").alias("a"), *sums)
    one = one.select("a", "b", F.col("m").alias("n"), rest(F.col("b")).alias("sd"))
    near = pairs.join(F.broadcast(one)).filter(F.abs(off) <= F.greatest(2.0 * F.col("sd"), F.lit(2.0)))
    two = near.agg(F.regr_slope("h", "l").alias("b2"), F.regr_intercept("h", "l").alias("a2"), F.sqrt(F.avg(off * off)).alias("rmse1"), *sums)
    line = one.join(F.broadcast(two.withColumn("rmse2", rest(F.col("b2"))))).withColumn("again", F.col("m") >= max(3, least // 2))
    line = line.select(
        *[F.when(F.col("again"), F.col(y)).otherwise(F.col(x)).alias(z) for x, y, z in (("a", "a2", "a"), ("b", "b2", "b"), ("rmse1", "rmse2", "rmse"))], "n", F.col("m").alias("n2")
    )
    fitted = (F.col("n") >= least) if calibration.effective_mode == "auto" else F.lit(False)
    value = lambda c, i: F.when(fitted, F.floor(F.col(c) * 1000 + 0.5) / 1000).otherwise(F.lit(float(given[i])))
    return line.select(
        value("a", 0).alias("intercept"), value("b", 1).alias("m_per_level"),
        F.when(fitted, "fitted").otherwise("config" if fixed else "fallback").alias("source"),
        F.col("n2").alias("n"), (F.col("n") - F.col("n2")).alias("rejected"), F.col("rmse"),
    )


def ladder(rows: DataFrame, line: DataFrame, priors: DataFrame, landmarks: DataFrame, tuning: Tuning, dispute: float) -> DataFrame:
    """rows with h, src, roof: the first evidence that is there, and hand overrides.

    priors and landmarks are configuration, and line is one row; all are broadcast."""
    out = (
        rows.withColumn("type", first_true("building", F.lit("yes")))
        .join(F.broadcast(line.select("intercept", "m_per_level")))
        .join(F.broadcast(priors), "type", "left")
        .join(F.broadcast(landmarks.withColumn("is_landmark", F.lit(True))), "name", "left")
    )
    storeys = F.when(F.col("levels") != 0, F.col("intercept") + F.col("m_per_level") * F.col("levels"))
    tagged, enough = height_tag("height_tag"), F.col("npx") >= tuning.min_pixels
    disputed = F.coalesce(F.abs(F.col("p50") - storeys) > dispute, F.lit(False))
    rung = lambda h, src: F.struct(h.alias("h"), (F.lit(src) if isinstance(src, str) else src).alias("src"))
    steps = (
        F.when(tagged.isNotNull(), rung(tagged, "osm_height"))
        .when(enough & F.col("p50").isNotNull(), rung(F.col("p50"), F.when(disputed, "lidar_p50_disputed").otherwise("lidar_p50")))
        .when((F.col("npx") >= 1) & F.col("p50").isNotNull(), rung(F.col("p50"), "lidar_lowconf"))
        .when(storeys.isNotNull(), rung(storeys, "osm_levels"))
        .otherwise(rung(F.coalesce("prior_h", F.lit(tuning.type_prior_default)), "type_prior"))
    )
    roof = roof_form("other_tags", "type", tuning)
    override = F.coalesce(F.col("is_landmark"), F.lit(False))
    return out.withColumn("rung", steps).select(
        *[c for c in rows.columns], "type",
        F.coalesce(F.when(override, F.col("lm_h")), F.col("rung.h")).alias("h"),
        F.when(override, "landmark_override").otherwise(F.col("rung.src")).alias("src"),
        F.coalesce(F.when(override, F.col("lm_roof")), roof).alias("roof"),
    )


def roof_form(tags: Column | str, kind: Column | str, tuning: Tuning) -> Column:
    kind = F.col(kind) if isinstance(kind, str) else kind
    return F.coalesce(tag(tags, "roof:shape"), F.when(kind.isin(*tuning.flat_types), "flat").otherwise(tuning.default_roof))


def records(rows: DataFrame, tuning: Tuning) -> DataFrame:
    """The building record without its rings."""
    return rows.select(
        F.col("osm_id").alias("id"), "name", "type", "h", F.greatest(F.col("p90"), F.col("h")).alias("ridge"), F.col("p25").alias("eaves"),
        F.col("d15").alias("base_z"), (F.col("dmin") - tuning.skirt_below).alias("skirt"), F.col("npx").alias("lidar_px"), "levels", "roof", "src",
        seed("osm_id").alias("seed"),
    )


def outliers(rows: DataFrame, tuning: Tuning) -> DataFrame:
    """Few pixels, or a ridge far above the wall."""
    return rows.filter((F.col("npx") < tuning.min_pixels) | (F.col("p90") - F.col("p50") > tuning.ridge_spread)).select("osm_id", "name", F.col("npx").alias("px"), "p50", "p90")


def source_shares(rows: DataFrame, warn: float = 0.05) -> DataFrame:
    """Buildings and share by src, and whether guessing by type is too common."""
    total = F.sum(F.count(F.lit(1))).over(Window.partitionBy(F.lit(1)))
    return rows.groupBy("src").agg(F.count(F.lit(1)).alias("buildings"), (F.count(F.lit(1)) / total).alias("share")).withColumn("warn", (F.col("src") == "type_prior") & (F.col("share") > warn))
