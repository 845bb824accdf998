"""Cleaning of timestreams inside each (chunk, detector): gaps, cosmic rays, and an ordered list of steps.

All windows share one partitioning and one order, so a chain of steps plans one exchange and one sort.  The valid samples round a
gap are found by lag and lead without nulls, which go through a chunk once: a frame up to its end would be gone through anew for each
of its samples.  Windows name the detector first, as a sort compares numbers faster than the name of an observation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from starloom.functions.flags import COSMIC_RAY, GAP

KEYS = ("obs_id", "chunk_index", "det_idx")

def _whole() -> WindowSpec:
    return Window.partitionBy(*reversed(KEYS))


def _by() -> WindowSpec:
    return _whole().orderBy("sample_idx")


def _valid(side: str, k: int = 1) -> Column:
    """The k-th value of __v that is not null before ("lag") or after ("lead") a sample."""
    return F.expr(f"{side}(__v, {k}) ignore nulls over (partition by {', '.join(reversed(KEYS))} order by sample_idx)")


def gap_runs(tod: DataFrame) -> DataFrame:
    """One row for each run of missing samples: first and last sample and the length."""
    edge = F.when(F.col("signal").isNull() & (F.lag("signal").over(_by()).isNotNull() | (F.row_number().over(_by()) == 1)), 1).otherwise(0)
    runs = tod.withColumn("__e", edge).withColumn("__run", F.sum("__e").over(_by())).where("signal is null")
    return runs.groupBy(*KEYS, "__run").agg(F.min("sample_idx").alias("first_sample"), F.max("sample_idx").alias("last_sample"), F.count("*").alias("n")).drop("__run")


def _line(x: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return y0 + (y1 - y0) * (x - x0) / (x1 - x0)


def _through(x: Column, pts: list[tuple[Column, Column]]) -> Column:
    """The polynomial through points, in Lagrange's form."""
    total = F.lit(0.0)
    for j, (xj, yj) in enumerate(pts):
        w = yj
        for k, (xk, _) in enumerate(pts):
            if k != j:
                w = w * (x - xk) / (xj - xk)
        total = total + w
    return total


def gaussian(seed: int, *keys: str) -> Column:
    """A standard normal number that depends on the seed and the keys only, by MD5, so that any engine can repeat it."""
    text = lambda salt: F.concat_ws(":", F.lit(str(seed)), F.lit(str(salt)), *(F.col(k).cast("string") for k in keys))
    unit = lambda salt: (F.conv(F.substring(F.md5(text(salt)), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    return F.sqrt(-2 * F.log(unit(1))) * F.cos(2 * F.lit(3.141592653589793) * unit(2))


def with_flags(tod: DataFrame) -> DataFrame:
    """Has clean_flags, 0 where there were none."""
    return tod if "clean_flags" in tod.columns else tod.withColumn("clean_flags", F.lit(0))


def fill_gaps(tod: DataFrame, min_cubic: int = 4, noise: DataFrame | None = None, seed: int = 0) -> DataFrame:
    """Fills runs that have a valid sample on both sides; every missing sample gets the gap bit in clean_flags.

    Runs under min_cubic samples are filled along the line between their neighbours, longer ones along the
    polynomial through two valid samples on each side (fewer at the chunk's ends; with two in all, the
    line).  With noise (det_idx, noise), filled samples get a repeatable normal deviate of that size.
    """
    own = with_flags(tod)
    i = F.col("__p")
    at = F.when(F.col("signal").isNotNull(), F.struct(i.alias("p"), F.col("signal").alias("y")))
    placed = own.withColumn("__p", F.row_number().over(_by())).withColumn("__v", at)
    second = placed.withColumns({"__l": _valid("lag"), "__ll": _valid("lag", 2), "__r": _valid("lead"), "__rr": _valid("lead", 2)})
    l1, r1, l2, r2 = (F.col(c) for c in ("__l", "__r", "__ll", "__rr"))
    pt = lambda s: (s["p"], s["y"])
    straight = _line(i, *pt(l1), *pt(r1))
    curve = (
        F.when(l2.isNotNull() & r2.isNotNull(), _through(i, [pt(l2), pt(l1), pt(r1), pt(r2)]))
        .when(l2.isNotNull(), _through(i, [pt(l2), pt(l1), pt(r1)]))
        .when(r2.isNotNull(), _through(i, [pt(l1), pt(r1), pt(r2)]))
        .otherwise(straight)
    )
    length = r1["p"] - l1["p"] - 1
    value = F.when(length >= min_cubic, curve).otherwise(straight)
    if noise is not None:
        second = second.join(noise.select("det_idx", F.col("noise").alias("__noise")), "det_idx", "left")
        value = value + F.when(F.col("__noise") > 0, F.col("__noise") * gaussian(seed, "obs_id", "det_idx", "sample_idx")).otherwise(0.0)
    gap = F.col("signal").isNull()
    return second.withColumn("clean_flags", F.when(gap, F.col("clean_flags").bitwiseOR(F.lit(GAP))).otherwise(F.col("clean_flags"))).withColumn("signal", F.when(gap & l1.isNotNull() & r1.isNotNull(), value).otherwise(F.col("signal"))).drop("__p", "__v", "__l", "__r", "__ll", "__rr", "__noise")


def flag_cosmic_rays(tod: DataFrame, sigma: float = 3.5, max_width: int = 5, pad: int = 2) -> DataFrame:
    """Adds the cosmic-ray bit from pad samples before a sharp rise to max_width + pad after it.

    A rise over sigma deviations of the (chunk, detector) counts if a fall as steep comes within max_width
    samples.  Groups that still have missing samples, or would keep fewer than two good ones, are left alone.
    """
    own = with_flags(tod)
    d = own.withColumns({"__d": F.col("signal") - F.lag("signal").over(_by()), "__s": F.stddev_pop("signal").over(_whole()) * sigma, "__miss": F.max(F.when(F.col("signal").isNull(), 1).otherwise(0)).over(_whole())})
    fall = F.max(F.when(F.col("__d") < -F.col("__s"), 1).otherwise(0)).over(_by().rowsBetween(0, max_width))
    d = d.withColumn("__spike", F.when((F.col("__miss") == 0) & (F.col("__d") > F.col("__s")) & (fall == 1), 1).otherwise(0))
    d = d.withColumn("__hit", F.max("__spike").over(_by().rowsBetween(-(max_width + pad), pad)))
    d = d.withColumn("__good", F.sum(1 - F.col("__hit")).over(_whole()))
    bit = F.when((F.col("__hit") == 1) & (F.col("__good") >= 2), COSMIC_RAY).otherwise(0)
    return d.withColumn("clean_flags", F.col("clean_flags").bitwiseOR(bit)).drop("__d", "__s", "__miss", "__spike", "__hit", "__good")


def interp_flagged(tod: DataFrame, bit: int = COSMIC_RAY) -> DataFrame:
    """Samples with the bit take the line between their good neighbours, or the nearest good value at the ends."""
    bad = F.col("clean_flags").bitwiseAND(F.lit(bit)) != 0
    d = tod.withColumn("__p", F.row_number().over(_by()))
    d = d.withColumn("__v", F.when(~bad, F.struct(F.col("__p").alias("p"), F.col("signal").alias("y"))))
    d = d.withColumns({"__l": _valid("lag"), "__r": _valid("lead")})
    line = _line(F.col("__p"), F.col("__l.p"), F.col("__l.y"), F.col("__r.p"), F.col("__r.y"))
    return d.withColumn("signal", F.when(~bad, F.col("signal")).otherwise(F.coalesce(line, F.col("__l.y"), F.col("__r.y"), F.col("signal")))).drop("__p", "__v", "__l", "__r")


def unfillable(tod: DataFrame) -> DataFrame:
    """(chunk, detector) groups that a filter cannot run on: some sample is missing after filling."""
    return tod.where("signal is null").select(*KEYS).distinct()


Step = Callable[[DataFrame], DataFrame]


def cosmic_ray_step(sigma: float = 3.5, max_width: int = 5, pad: int = 2) -> Step:
    return lambda df: interp_flagged(flag_cosmic_rays(df, sigma, max_width, pad))


def clean_tod(tod: DataFrame, steps: list[Step] = ()) -> DataFrame:
    """Gaps are always filled first; then each step in order, a function from a frame to a frame.

    Adds clean_flags with the bits of all steps.  A step of one's own is passed like any other.
    """
    out = fill_gaps(tod)
    for step in steps:
        out = step(out)
    return out
