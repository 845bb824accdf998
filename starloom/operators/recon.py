"""Detector positions on the focal plane from scans of a point source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import arrays
from starloom.functions import geometry as g
from starloom.functions.scans import BUCKET, bucketed, with_previous
from starloom.operators.binning import Grid, bin_per_detector
from starloom.operators.quality import detector_centroids
from starloom.operators.spectra import matrices

ARCSEC = 3600.0


def nominal_layout(focalplane: DataFrame) -> DataFrame:
    """det, det_idx, x, y in degrees from each detector's direction."""
    return focalplane.select("det", "det_idx", g.focalplane_x(F.col("dir")).alias("x"), g.focalplane_y(F.col("dir")).alias("y"))


def source_track(boresight: DataFrame, ra: float, dec: float) -> DataFrame:
    """Adds du, dv: where the source stands in the focal-plane frame at each time sample."""
    v = g.radec_vec(F.lit(ra), F.lit(dec))
    return boresight.withColumns({"du": g.source_du(F.col("q"), v), "dv": g.source_dv(F.col("q"), v)})


def focalplane_maps(tod: DataFrame, track: DataFrame, grid: Grid) -> DataFrame:
    """det_idx, iy, ix, data, hits in focal-plane coordinates, chunk medians taken off."""
    med = tod.where("flags = 0").groupBy("obs_id", "chunk_index", "det_idx").agg(F.expr("percentile(signal, 0.5)").alias("__m"))
    j = tod.join(med, ["obs_id", "chunk_index", "det_idx"]).withColumn("signal", F.col("signal") - F.col("__m")).join(track.select("obs_id", "sample_idx", "du", "dv"), ["obs_id", "sample_idx"])
    return bin_per_detector(j, grid, ra="du", dec="dv")


def pick_peaks(det_maps: DataFrame, grid: Grid, border: int = 5, min_hits: float = 5, min_snr: float = 5.0) -> DataFrame:
    """Centroids that are off the border, well hit and clear of the noise."""
    c = detector_centroids(det_maps, grid)
    inside = F.col("ix").between(border, grid.nx - 1 - border) & F.col("iy").between(border, grid.ny - 1 - border)
    return c.where(inside & (F.col("hits") >= min_hits) & (F.col("snr") >= min_snr))


def gauss_centroid(det_maps: DataFrame, peaks: DataFrame, grid: Grid, reach: int = 3, whole: bool = True, min_pixels: int = 10) -> DataFrame:
    """det_idx, amp, x, y, sigma, background, residual: a round Gaussian fitted to the pixels about each peak.

    With whole, all pixels of the window must be there, else at least min_pixels; a cut-out has at most
    (2 reach + 1) squared of them, and all cut-outs of a batch are fitted at once.  residual is the RMS of the fit over its amplitude.
    """
    p = peaks.select("det_idx", F.col("iy").alias("py"), F.col("ix").alias("px"))
    # neither side is sent to all tasks: maps that are exploded or made in tasks are larger than Spark takes them for
    near = det_maps.join(p.hint("merge"), "det_idx").where((F.abs(F.col("iy") - F.col("py")) <= reach) & (F.abs(F.col("ix") - F.col("px")) <= reach))
    cut = near.select("det_idx", g.pixel_center(grid.ra_lo, grid.step_ra, F.col("ix")).alias("x"), g.pixel_center(grid.dec_lo, grid.step_dec, F.col("iy")).alias("y"), (F.col("data") / F.col("hits")).alias("z"))
    least, step = max(6, (2 * reach + 1) ** 2 if whole else min_pixels), grid.step_ra
    packed = cut.where("z is not null").groupBy("det_idx").agg(F.array_sort(F.collect_list(F.struct("y", "x", "z"))).alias("c")).where(F.size("c") >= least).select("det_idx", *(F.col("c")[k].alias(k) for k in "xyz"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = np.full((batch.num_rows, 6), np.nan)
            for (at, x), (_, y), (_, z) in zip(*(matrices(batch.column(k)) for k in "xyz"), strict=True):
                fit = arrays.gauss2d_fits(x, y, z, step)
                model = fit[:, :1] * np.exp(-((x - fit[:, 1:2]) ** 2 + (y - fit[:, 2:3]) ** 2) / (2 * fit[:, 3:4] ** 2)) + fit[:, 4:]
                with np.errstate(divide="ignore", invalid="ignore"):
                    fits[at] = np.column_stack([fit, np.sqrt(((z - model) ** 2).mean(axis=1)) / fit[:, 0]])
            good = np.flatnonzero(fits[:, 0] > 0)
            yield pa.record_batch([batch.column("det_idx").take(pa.array(good)), *(pa.array(fits[good, k]) for k in range(6))], names=["det_idx", "amp", "x", "y", "sigma", "background", "residual"])

    return packed.mapInArrow(run, "det_idx int, amp double, x double, y double, sigma double, background double, residual double")


def fine_centroid(tod: DataFrame, track: DataFrame, coarse: DataFrame, res: float = 6 / ARCSEC, half: float = 0.05, reach: int = 5) -> DataFrame:
    """Positions from a finer grid about each detector's coarse centre (det_idx, x, y).

    The centres, a row a detector, go to all tasks: dealt by detector, all samples of one would go to one task.
    """
    n = int(round(2 * half / res))
    grid = Grid(-half, -half, res, res, n, n)
    j = tod.join(track.select("obs_id", "sample_idx", "du", "dv"), ["obs_id", "sample_idx"]).join(F.broadcast(coarse.select("det_idx", F.col("x").alias("cx"), F.col("y").alias("cy"))), "det_idx")
    m = bin_per_detector(j.withColumns({"du": F.col("du") - F.col("cx"), "dv": F.col("dv") - F.col("cy")}), grid, ra="du", dec="dv")
    fit = gauss_centroid(m, detector_centroids(m, grid), grid, reach, whole=False)
    return fit.join(coarse.select("det_idx", F.col("x").alias("cx"), F.col("y").alias("cy")), "det_idx").withColumns({"x": F.col("x") + F.col("cx"), "y": F.col("y") + F.col("cy")}).drop("cx", "cy")


def peak_sample(tod: DataFrame, *carry: str) -> DataFrame:
    """det_idx, the sample of the largest good signal (the first of equals) and other columns there."""
    good = tod.where("flags = 0 and signal is not null")
    best = F.max_by(F.struct("sample_idx", "signal", *carry), F.struct("signal", (-F.col("sample_idx")).alias("s"))).alias("b")
    return good.groupBy("det_idx").agg(best).select("det_idx", "b.*")


def peak_time_position(tod: DataFrame, track: DataFrame) -> DataFrame:
    """det_idx, x, y: the source's place in the focal plane when the detector saw it brightest."""
    return peak_sample(tod, "obs_id").join(track.select("obs_id", "sample_idx", "du", "dv"), ["obs_id", "sample_idx"]).select("det_idx", F.col("du").alias("x"), F.col("dv").alias("y"))


def raw_offsets(peaks: DataFrame, ra: float, dec: float) -> DataFrame:
    """Adds x, y: the source less the boresight at the peak, RA scaled by cos dec."""
    return peaks.withColumns({"x": (F.lit(ra) - F.col("ra_bore")) * F.cos(F.radians(F.lit(dec))), "y": F.lit(dec) - F.col("dec_bore")})


def rotate_offsets(offsets: DataFrame, angle_deg: float) -> DataFrame:
    c, s = F.cos(F.radians(F.lit(angle_deg))), F.sin(F.radians(F.lit(angle_deg)))
    return offsets.withColumns({"x": F.col("x") * c + F.col("y") * s, "y": F.col("y") * c - F.col("x") * s})


def position_angle(boresight: DataFrame) -> DataFrame:
    """Mean, deviation and range of the angle of the focal plane's x axis on the sky, degrees."""
    x = g.quat_rotate(F.col("q"), g.vec(F.lit(1.0), F.lit(0.0), F.lit(0.0)))
    d = boresight.withColumn("__x", x).withColumn("__z", g.boresight_dir(F.col("q")))
    ra, dec = F.atan2(F.col("__z.y"), F.col("__z.x")), F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("__z.z"))))
    east = -F.sin(ra) * F.col("__x.x") + F.cos(ra) * F.col("__x.y")
    north = -F.sin(dec) * (F.cos(ra) * F.col("__x.x") + F.sin(ra) * F.col("__x.y")) + F.cos(dec) * F.col("__x.z")
    a = d.withColumn("pa", F.degrees(F.atan2(north, east)))
    return a.agg(F.avg("pa").alias("mean"), F.stddev_pop("pa").alias("std"), (F.max("pa") - F.min("pa")).alias("range"))


def positions_from_centroids(centroids: DataFrame, ra: float, dec: float, min_snr: float = 3.0) -> DataFrame:
    """det, x, y from saved centroids (det, ra, dec, snr): their place less the source's, faint ones left out."""
    return centroids.where(F.col("snr") > min_snr).select("det", ((F.col("ra") - ra) * F.cos(F.radians(F.lit(dec)))).alias("x"), (F.col("dec") - dec).alias("y"))


def pointing_residuals(recon: DataFrame, nominal: DataFrame, key: str = "det") -> DataFrame:
    """key, dx, dy in arc seconds; detectors without a nominal place are left out."""
    n = nominal.select(key, F.col("x").alias("nx"), F.col("y").alias("ny"))
    return recon.join(n, key).select(key, ((F.col("x") - F.col("nx")) * ARCSEC).alias("dx"), ((F.col("y") - F.col("ny")) * ARCSEC).alias("dy"))


def common_valid(*methods: DataFrame, key: str = "det") -> DataFrame:
    """Detectors that all methods have."""
    out = methods[0].select(key).distinct()
    for m in methods[1:]:
        out = out.join(m, key, "left_semi")
    return out


def residual_stats(residuals: DataFrame, beam_sigma_arcsec: float) -> DataFrame:
    """By method: mean and deviation in x and y, RMS, and RMS as percent of the beam's full width at half height."""
    rms = F.sqrt(F.avg(F.col("dx") ** 2 + F.col("dy") ** 2))
    return residuals.groupBy("method").agg(F.count("*").alias("n"), F.avg("dx").alias("mean_x"), F.avg("dy").alias("mean_y"), F.stddev_pop("dx").alias("std_x"), F.stddev_pop("dy").alias("std_y"), rms.alias("rms"), (100 * rms / (2.355 * beam_sigma_arcsec)).alias("rms_pct_fwhm"))


def scan_direction(boresight: DataFrame, bucket: int = 4096) -> DataFrame:
    """Adds right: whether RA grows into the sample; the first sample of an observation counts as left.

    Runs over the per-time table in time order, on over chunks, in buckets of samples.
    """
    rows = with_previous(bucketed(boresight, "sample_idx", bucket), ["obs_id"], "sample_idx", "ra_bore", "__last")
    return rows.withColumn("right", F.coalesce(F.col("ra_bore") > F.col("__last"), F.lit(False))).drop("__last", BUCKET)


def scan_asymmetry(tod: DataFrame, boresight: DataFrame, *carry: str) -> DataFrame:
    """det_idx, x and y of right less left peaks (columns du, dv of boresight), for detectors with both."""
    d = scan_direction(boresight).select("obs_id", "sample_idx", "right", "du", "dv")
    j = tod.where("flags = 0 and signal is not null").join(d, ["obs_id", "sample_idx"])
    best = j.groupBy("det_idx", "right").agg(F.max_by(F.struct("du", "dv"), F.struct("signal", (-F.col("sample_idx")).alias("s"))).alias("b"))
    two = best.groupBy("det_idx").agg(F.max(F.when(F.col("right"), F.col("b"))).alias("r"), F.max(F.when(~F.col("right"), F.col("b"))).alias("l"))
    return two.where("r is not null and l is not null").select("det_idx", (F.col("r.du") - F.col("l.du")).alias("dx"), (F.col("r.dv") - F.col("l.dv")).alias("dy"))
