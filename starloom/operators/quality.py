"""Measures of maps: coverage, peaks, convergence, per-detector centroids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.geometry import pixel_center
from starloom.operators.binning import Grid


def peak_pixel(map_px: DataFrame, *by: str) -> DataFrame:
    """The pixel of the largest value; of equals the first in row order."""
    seen = map_px.where("value is not null")
    best = F.max(F.struct(F.col("value").alias("v"), (-F.col("iy")).alias("y"), (-F.col("ix")).alias("x"))).alias("__b")
    return (seen.groupBy(*by) if by else seen).agg(best).select(*by, F.col("__b.v").alias("peak"), (-F.col("__b.y")).alias("iy"), (-F.col("__b.x")).alias("ix")).where("peak is not null")


def map_quality(map_px: DataFrame, grid: Grid) -> DataFrame:
    stats = map_px.agg(F.count_if(F.col("hits") > 0).alias("covered"), F.count("value").alias("finite"), F.expr("percentile(value, array(0.05, 0.5, 0.95))").alias("__q"))
    out = stats.crossJoin(F.broadcast(peak_pixel(map_px)))
    return out.select(
        "covered", F.lit(grid.nx * grid.ny).alias("total"), (F.col("covered") / (grid.nx * grid.ny)).alias("fraction"), "finite", "peak",
        pixel_center(grid.ra_lo, grid.step_ra, F.col("ix")).alias("peak_ra"), pixel_center(grid.dec_lo, grid.step_dec, F.col("iy")).alias("peak_dec"), F.col("__q")[1].alias("median"), F.col("__q")[0].alias("p05"), F.col("__q")[2].alias("p95"),
    )


def map_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """iy, ix, diff on pixels that both maps have."""
    return a.select("iy", "ix", F.col("value").alias("__a")).join(b.select("iy", "ix", F.col("value").alias("__b")), ["iy", "ix"]).select("iy", "ix", (F.col("__a") - F.col("__b")).alias("diff"))


def convergence(maps: DataFrame, final: str) -> DataFrame:
    """For maps (stage INT order, name, iy, ix, value): peak, RMS off and on source, RMS change to the stage before.

    Off source are the pixels below the final map's median.
    """
    seen = maps.where("value is not null")
    last = seen.where(F.col("name") == final)
    median = last.agg(F.expr("percentile(value, 0.5)").alias("__m"))
    part = last.crossJoin(F.broadcast(median)).select("iy", "ix", (F.col("value") < F.col("__m")).alias("__off"))
    tagged = seen.join(part, ["iy", "ix"], "left")
    rms = lambda c: F.sqrt(F.avg(F.when(c, F.col("value") * F.col("value"))))
    base = tagged.groupBy("stage", "name").agg(F.max("value").alias("peak"), rms(F.col("__off")).alias("rms_off"), rms(~F.col("__off")).alias("rms_on"))
    nxt = seen.select((F.col("stage") + 1).alias("stage"), "iy", "ix", F.col("value").alias("__p"))
    step = seen.join(nxt, ["stage", "iy", "ix"]).groupBy("stage").agg(F.sqrt(F.avg((F.col("value") - F.col("__p")) ** 2)).alias("rms_diff"))
    return base.join(step, "stage", "left")


def detector_centroids(det_maps: DataFrame, grid: Grid) -> DataFrame:
    """det_idx, peak position, RMS of the pixels below the detector's median, their ratio, and the hits of the peak.

    A detector's map, of at most the grid's pixels, is one group of a window, so pixels are exchanged once and joined to nothing, and
    the sums that the median is taken of are those that are held against it: made twice, they may differ in the last digit.
    """
    v = det_maps.withColumn("value", F.col("data") / F.col("hits")).where("value is not null")
    v = v.withColumn("__m", F.expr("percentile(value, 0.5)").over(Window.partitionBy("det_idx")))
    rms = F.sqrt(F.avg(F.when(F.col("value") < F.col("__m"), F.col("value") * F.col("value")))).alias("rms_off")
    best = F.max(F.struct(F.col("value").alias("v"), (-F.col("iy")).alias("y"), (-F.col("ix")).alias("x"), "hits")).alias("__b")
    c = v.groupBy("det_idx").agg(best, rms).select("det_idx", F.col("__b.v").alias("peak"), (-F.col("__b.y")).alias("iy"), (-F.col("__b.x")).alias("ix"), "rms_off", F.col("__b.hits").alias("hits"))
    return c.select(
        "det_idx", "peak", "iy", "ix", "hits", pixel_center(grid.ra_lo, grid.step_ra, F.col("ix")).alias("ra"), pixel_center(grid.dec_lo, grid.step_dec, F.col("iy")).alias("dec"), "rms_off", (F.col("peak") / F.col("rms_off")).alias("snr"),
    )


def flag_detectors(centroids: DataFrame, k: float = 3.0) -> DataFrame:
    """Detectors with an off-source RMS over k medians, and the ratio."""
    med = centroids.agg(F.expr("percentile(rms_off, 0.5)").alias("__m"))
    return centroids.crossJoin(F.broadcast(med)).withColumn("ratio", F.col("rms_off") / F.col("__m")).where(F.col("ratio") > k).drop("__m")


def top_k(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The k rows of the largest values; of equal ones, the first by the columns of ties."""
    return df.orderBy(F.desc(by), *ties).limit(k)

