"""Pointing of samples and the map's centre."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import arrays
from starloom.functions import geometry as g


def detector_radec(tod: DataFrame, boresight: DataFrame, focalplane: DataFrame) -> DataFrame:
    """Adds ra, dec of each sample and detector: the detector's direction turned by the boresight's quaternion.

    The boresight has a row a time sample and the focal plane one a detector; Spark broadcasts either if small.
    """
    j = tod.join(boresight.select("obs_id", "sample_idx", "q"), ["obs_id", "sample_idx"]).join(focalplane.select("det_idx", "dir"), "det_idx")
    v = j.withColumn("__v", g.quat_rotate(F.col("q"), F.col("dir")))
    return v.withColumns({"ra": g.vec_ra(F.col("__v")), "dec": g.vec_dec(F.col("__v"))}).drop("q", "dir", "__v")


def boresight_to_radec(boresight: DataFrame) -> DataFrame:
    v = boresight.withColumn("__v", g.boresight_dir(F.col("q")))
    return v.withColumns({"ra_bore": g.vec_ra(F.col("__v")), "dec_bore": g.vec_dec(F.col("__v"))}).drop("__v")


def altaz_to_radec(boresight: DataFrame, lat: float, lon: float, dut1: float = 0.0) -> DataFrame:
    """Adds ra_bore, dec_bore from az, el and t; once a time sample, before any join with detectors."""
    return _with_pair(boresight, arrays.altaz_to_radec, ("az", "el"), ("ra_bore", "dec_bore"), lat, lon, dut1)


def radec_to_altaz(boresight: DataFrame, lat: float, lon: float, dut1: float = 0.0) -> DataFrame:
    """Adds az, el from ra_bore, dec_bore and t."""
    return _with_pair(boresight, arrays.radec_to_altaz, ("ra_bore", "dec_bore"), ("az", "el"), lat, lon, dut1)


def _with_pair(df: DataFrame, turn: Callable, given: tuple[str, str], made: tuple[str, str], lat: float, lon: float, dut1: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y, t = (b.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in (*given, "t"))
            yield pa.record_batch([*b.columns, *map(pa.array, turn(x, y, t, lat, lon, dut1))], names=[*b.schema.names, *made])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *(T.StructField(c, T.DoubleType()) for c in made)]))


def map_center(stats: DataFrame, targets: DataFrame | None = None, target: str | None = None, pair: tuple[float, float] | None = None) -> DataFrame:
    """ra, dec, origin: a given pair, else the named target of a table (name, ra, dec), else the mean boresight."""
    mean = stats.select("ra", "dec")
    if pair:
        return mean.limit(1).select(F.lit(float(pair[0])).alias("ra"), F.lit(float(pair[1])).alias("dec"), F.lit("config").alias("origin"))
    if targets is None or not target:
        return mean.withColumn("origin", F.lit("boresight"))
    named = targets.where(F.lower(F.trim("name")) == target.strip().lower()).agg(F.first("ra").alias("tra"), F.first("dec").alias("tdec"))
    return mean.crossJoin(F.broadcast(named)).select(F.coalesce("tra", "ra").alias("ra"), F.coalesce("tdec", "dec").alias("dec"), F.when(F.col("tra").isNotNull(), "target").otherwise("boresight").alias("origin"))
