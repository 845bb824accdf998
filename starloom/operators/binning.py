"""Sky grids and the binning of samples into maps.

A map is one aggregation by pixel: tasks sum their own samples first, so what is shuffled is pixels, and a
pixel of very many samples costs one row a task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.flags import is_finite, usable


@dataclass(frozen=True)
class Grid:
    ra_lo: float
    dec_lo: float
    step_ra: float
    step_dec: float
    nx: int
    ny: int


def make_grid(ra: float, dec: float, xlen: float, ylen: float, res: float) -> Grid:
    """A centred grid of int(len / res) pixels a side, as wide as asked."""
    nx, ny = max(1, int(xlen / res)), max(1, int(ylen / res))
    return Grid(ra - xlen / 2, dec - ylen / 2, xlen / nx, ylen / ny, nx, ny)


def auto_grid(extent: DataFrame, ra: float, dec: float, res: float, xlen: float | None = None, ylen: float | None = None) -> Grid:
    """The grid round a centre that holds all kept detectors' positions; an axis with a length is fixed.  Without any position it is an error."""
    found = grid_round(extent, ra, dec, res, xlen, ylen)
    if found is None:
        raise ValueError("no pointing to take the map's extent from")
    return found


def grid_round(extent: DataFrame, ra: float, dec: float, res: float, xlen: float | None = None, ylen: float | None = None) -> Grid | None:
    """The same, or None without any position."""
    e = extent.agg(*(f(c).alias(c) for c, f in (("ra_min", F.min), ("ra_max", F.max), ("dec_min", F.min), ("dec_max", F.max)))).first()
    if e.ra_min is None:
        return None
    hx, hy = (math.ceil(max(abs(lo - c), abs(hi - c)) / res) + 1 for lo, hi, c in ((e.ra_min, e.ra_max, ra), (e.dec_min, e.dec_max, dec)))
    fixed = make_grid(ra, dec, xlen or res, ylen or res, res)
    g = Grid(ra - hx * res, dec - hy * res, res, res, 2 * hx, 2 * hy)
    return Grid(fixed.ra_lo if xlen else g.ra_lo, fixed.dec_lo if ylen else g.dec_lo, fixed.step_ra if xlen else res, fixed.step_dec if ylen else res, fixed.nx if xlen else g.nx, fixed.ny if ylen else g.ny)


def pixels(tod: DataFrame, grid: Grid, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Adds iy, ix and drops samples off the grid or without finite pointing; a pixel's right edge is the next one's."""
    ix, iy = spot((F.col(ra) - grid.ra_lo) / grid.step_ra, grid.nx), spot((F.col(dec) - grid.dec_lo) / grid.step_dec, grid.ny)
    return tod.withColumns({"iy": iy, "ix": ix}).where("ix is not null and iy is not null")


def spot(place: Column, n: int) -> Column:
    """The number of the pixel, of n on an axis, that holds a place in pixels; null off the axis and for what is not finite."""
    return F.when((place >= 0) & (place < n), F.floor(place).cast("int"))


def good_samples(tod: DataFrame) -> DataFrame:
    """Unflagged before and after cleaning, with a finite value."""
    return tod.where(usable(F.col("flags"), F.col("clean_flags") if "clean_flags" in tod.columns else None) & is_finite(F.col("signal")))


def weighted(tod: DataFrame, weights: DataFrame | None) -> DataFrame:
    if weights is None:
        return tod.withColumn("w", F.lit(1.0))
    return tod.join(weights.select("det_idx", F.col("weight").alias("w")), "det_idx").where("w <> 0")


def sums(x: str = "signal", w: str = "w", when: Column | None = None, tag: str = "") -> list[Column]:
    """data, hits and sumsq of one map, of the samples that a condition holds for."""
    pick = (lambda c: F.sum(F.when(when, c))) if when is not None else F.sum
    return [pick(F.col(w) * F.col(x)).alias(f"data{tag}"), pick(F.col(w)).alias(f"hits{tag}"), pick(F.col(w) * F.col(x) * F.col(x)).alias(f"sumsq{tag}")]


#: Steps that values are split by to be added without a rounding error.
_STEPS = (2.0**-10, 2.0**-42)


def steady_sum(x: str) -> Column:
    """The sum of a column of finite values, the same in whatever order they come.

    Each value is split into whole numbers of the steps.  Such parts add up exactly, up to sums of 8e12 and 4 million values of a group;
    what is left is under the smallest step.  So pixels that hold the same values have the same sum, and none is the larger by how it was added up.
    """
    rest, parts = F.col(x), []
    for step in _STEPS:
        part = F.rint(rest / step) * step
        parts.append(F.sum(part))
        rest = rest - part
    return reduce(add, [*parts, F.sum(rest)])


def bin_map(tod: DataFrame, grid: Grid, weights: DataFrame | None = None, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """iy, ix, data, hits, sumsq, n_samples: weighted sums for each pixel that has any."""
    return pixels(weighted(good_samples(tod), weights), grid, ra, dec).groupBy("iy", "ix").agg(*sums(), F.count("*").alias("n_samples")).where("hits <> 0")


def finish_map(sums_: DataFrame) -> DataFrame:
    """Adds value and its noise."""
    value = F.col("data") / F.col("hits")
    noise = F.sqrt(F.greatest(F.col("sumsq") / F.col("hits") - value * value, F.lit(0.0)) / F.col("hits"))
    return sums_.withColumns({"value": value, "noise": noise})


def bin_map_pair(tod: DataFrame, grid: Grid, weights: DataFrame | None, naive: str = "signal_naive") -> DataFrame:
    """The plain map of one column and the weighted map of signal, in one pass: five sums a pixel.

    The plain map has the samples of all detectors alike, also of those without a weight or of weight 0; each map leaves out
    what is not finite in its own column only.
    """
    one = weights if weights is None else weights.select("det_idx", F.col("weight").alias("w"))
    use = usable(F.col("flags"), F.col("clean_flags") if "clean_flags" in tod.columns else None)
    good = tod.where(use & (is_finite(F.col("signal")) | is_finite(F.col(naive))))
    px = pixels(good.withColumn("w", F.lit(1.0)) if one is None else good.join(one, "det_idx", "left"), grid)
    w = F.when(is_finite(F.col("signal")), F.coalesce("w", F.lit(0.0))).otherwise(0.0)
    signal = F.when(is_finite(F.col("signal")), F.col("signal")).otherwise(0.0)
    plain = is_finite(F.col(naive))
    return px.withColumns({"w": w, "signal": signal}).groupBy("iy", "ix").agg(F.sum(F.when(plain, F.col(naive))).alias("naive_data"), F.count_if(plain).alias("naive_hits"), *sums())


def bin_edges(tod: DataFrame, ra_edges: list[float], dec_edges: list[float], weights: DataFrame | None = None) -> DataFrame:
    """Bins of given edges, e[k] <= x < e[k + 1]; edges are the grid's own short lists."""
    bin_of = lambda c, edges: F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col(c))) - 1
    px = weighted(good_samples(tod), weights).withColumns({"ix": bin_of("ra", ra_edges), "iy": bin_of("dec", dec_edges)})
    px = px.where(F.col("ix").between(0, len(ra_edges) - 2) & F.col("iy").between(0, len(dec_edges) - 2))
    return px.groupBy("iy", "ix").agg(*sums(), F.count("*").alias("n_samples"))


def bin_per_detector(tod: DataFrame, grid: Grid, ra: str = "ra", dec: str = "dec") -> DataFrame:
    """det_idx, iy, ix, data, hits: unweighted; the last pixel of an axis holds its right edge as well."""
    at = lambda c, lo, step, n: F.when(F.abs(F.col(c) - (lo + n * step)) < 1e-12, n - 1).otherwise(spot((F.col(c) - lo) / step, n))
    px = good_samples(tod).withColumns({"ix": at(ra, grid.ra_lo, grid.step_ra, grid.nx), "iy": at(dec, grid.dec_lo, grid.step_dec, grid.ny)})
    px = px.where("ix is not null and iy is not null")
    return px.groupBy("det_idx", "iy", "ix").agg(steady_sum("signal").alias("data"), F.count("*").cast("double").alias("hits"))


def require_coverage(map_px: DataFrame, bounds: str = "") -> DataFrame:
    if map_px.where("hits > 0").isEmpty():
        raise ValueError(f"no pixel of the map has a sample; bounds: {bounds}")
    return map_px


def boresight_compare(tod: DataFrame, grid: Grid) -> DataFrame:
    """The map by detector positions beside the map by the boresight alone."""
    a = finish_map(bin_map(tod, grid)).select("iy", "ix", F.col("value").alias("value_det"), F.col("hits").alias("hits_det"))
    b = finish_map(bin_map(tod, grid, ra="ra_bore", dec="dec_bore")).select("iy", "ix", F.col("value").alias("value_bore"), F.col("hits").alias("hits_bore"))
    return a.join(b, ["iy", "ix"], "full_outer")
