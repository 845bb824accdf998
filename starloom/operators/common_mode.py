"""The signal that all detectors share at one time, and its removal, with the last map as sky model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.flags import is_finite
from starloom.operators.binning import Grid

SAMPLE = ("obs_id", "chunk_index", "sample_idx")


def common_mode(tod: DataFrame, column: str = "signal", name: str = "common") -> DataFrame:
    """Adds the mean over detectors of samples without input flags; 0 where there is none.

    The window is by sample, so detectors of a sample come together in one exchange of its own.
    """
    mean = F.avg(F.when(F.col("flags") == 0, F.col(column))).over(Window.partitionBy(*SAMPLE))
    return tod.withColumn(name, F.coalesce(mean, F.lit(0.0)))


def predict_signal(tod: DataFrame, sky: DataFrame, grid: Grid, name: str = "sky") -> DataFrame:
    """Adds the map's value at each sample's pixel: off the map the nearest edge pixel, 0 where unobserved or without finite pointing.

    The map is joined on its pixel; Spark broadcasts it when its size allows.
    """
    edge = lambda c, lo, step, n: F.when(is_finite(F.col(c)), F.floor(F.greatest(F.lit(0.0), F.least(F.lit(float(n - 1)), (F.col(c) - lo) / step))).cast("int"))
    ix, iy = edge("ra", grid.ra_lo, grid.step_ra, grid.nx), edge("dec", grid.dec_lo, grid.step_dec, grid.ny)
    px = sky.select(F.col("iy").alias("__iy"), F.col("ix").alias("__ix"), F.col("value").alias("__v"))
    return tod.withColumns({"__iy": iy, "__ix": ix}).join(px, ["__iy", "__ix"], "left").withColumn(name, F.coalesce("__v", F.lit(0.0))).drop("__iy", "__ix", "__v")


def subtract_common_mode(tod: DataFrame, sky: DataFrame | None = None, grid: Grid | None = None) -> DataFrame:
    """signal minus the common mode, which is estimated on signal minus the sky model if one is given."""
    if sky is None:
        return common_mode(tod).withColumn("signal", F.col("signal") - F.col("common")).drop("common")
    rest = predict_signal(tod, sky, grid).withColumn("__rest", F.col("signal") - F.col("sky"))
    return common_mode(rest, "__rest").withColumn("signal", F.col("signal") - F.col("common")).drop("common", "__rest", "sky")
