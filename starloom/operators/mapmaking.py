"""Iterated map-making: each map is the sky model with which the next turn tells the common mode from the sky.

Timestreams are cleaned once and stored, dealt and bucketed by sample, with both pixels (that of the map, and
the one the model is read at) worked out.  A turn then reads them, joins the last map (Spark broadcasts it if
its size allows), averages over detectors inside a sample without an exchange, and shuffles sums of pixels only.
Every map is committed before the next turn reads it back, so plans do not grow with turns, and a run that was
lost goes on behind its last committed map.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions.flags import is_finite, usable
from starloom.operators.binning import Grid, finish_map, require_coverage, spot, sums
from starloom.operators.clean import Step, clean_tod, with_flags
from starloom.operators.common_mode import SAMPLE
from starloom.operators.nulls import pass_stats
from starloom.sources import snapshots

NAIVE = "naive"
#: Splits of the data that each turn sums as well, for null maps: by chunk parity and by detector half.
SPLITS = {"_t0": "chunk_index % 2 = 0", "_t1": "chunk_index % 2 = 1", "_d0": "det_half = 0", "_d1": "det_half = 1"}


@dataclass(frozen=True)
class MapRun:
    """maps: stage, name, iy, ix, data, hits, sumsq, n_samples, value, noise and the sums of the splits; stage -1 is the naive map.

    changes: the RMS change of each turn's map from the one before; counts: one row with the samples flagged by each kind.
    """

    maps: DataFrame
    names: list[str]
    changes: list[float]
    counts: DataFrame
    folder: str

    def null(self, by: str = "time", turn: int = -1) -> DataFrame:
        """iy, ix, value, hits0, hits1 of a turn's null map (the last by default), by "time" or "detector"."""
        stage = len(self.names) - 2 if turn < 0 else turn
        a, b = ("_t0", "_t1") if by == "time" else ("_d0", "_d1")
        d, h = (F.col(f"data{a}"), F.col(f"data{b}")), tuple(F.coalesce(f"hits{x}", F.lit(0.0)) for x in (a, b))
        value = F.when((h[0] > 0) & (h[1] > 0), (d[0] / h[0] - d[1] / h[1]) / 2)
        return self.maps.where(F.col("stage") == stage).select("iy", "ix", value.alias("value"), h[0].alias("hits0"), h[1].alias("hits1"))


def _prepared(tod: DataFrame, grid: Grid, weights: DataFrame | None, halves: DataFrame | None, offsets: DataFrame | None, steps: list[Step]) -> DataFrame:
    """Cleaned samples with what every turn needs of them; a detector without a weight counts in the naive map only."""
    if offsets is not None:
        tod = tod.join(offsets.select("det_idx", "offset"), "det_idx").withColumn("signal", F.col("signal") - F.col("offset")).drop("offset")
    # without a step or a missing sample there is nothing to clean, and no chunk is put in order
    out = clean_tod(tod, steps) if steps or not tod.where("signal is null").isEmpty() else with_flags(tod)
    for side, column, none in ((weights, "weight", 0.0), (halves, "det_half", None)):
        if side is not None:
            out = out.join(side.select("det_idx", column), "det_idx", "left").withColumn(column, F.coalesce(column, F.lit(none)))
    ra, dec = (F.col("ra") - grid.ra_lo) / grid.step_ra, (F.col("dec") - grid.dec_lo) / grid.step_dec
    edge = lambda x, n: F.when(is_finite(x), F.floor(F.greatest(F.lit(0.0), F.least(F.lit(float(n - 1)), x))).cast("int"))
    pixel = lambda y, x: y * grid.nx + x
    return out.select(
        *SAMPLE, "det_idx", "signal", "flags", "clean_flags", (usable(F.col("flags"), F.col("clean_flags")) & is_finite(F.col("signal"))).alias("good"), pixel(spot(dec, grid.ny), spot(ra, grid.nx)).alias("px"),
        pixel(edge(dec, grid.ny), edge(ra, grid.nx)).alias("seen_at"), (F.col("weight") if weights is not None else F.lit(1.0)).alias("w"), (F.col("det_half") if halves is not None else F.lit(None).cast("int")).alias("det_half"),
    )


def _stored(df: DataFrame, path: str, buckets: int) -> str:
    """The name of a table of the cleaned samples, bucketed by sample: the exchange for all turns."""
    spark, name = df.sparkSession, f"cleaned_{uuid.uuid4().hex}"
    keys = ", ".join(SAMPLE)
    done = snapshots.versions(spark, path).get(0)
    if done:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({', '.join(reversed(SAMPLE))}) INTO {buckets} BUCKETS LOCATION '{done}'")
        return name
    folder = f"data-0-{uuid.uuid4().hex}"
    df.repartition(buckets, *SAMPLE).write.bucketBy(buckets, *SAMPLE).sortBy(*reversed(SAMPLE)).option("path", f"{path}/{folder}").format("parquet").saveAsTable(name)
    snapshots.commit(spark, path, 0, folder)
    return name


def turn(cleaned: DataFrame, sky: DataFrame | None) -> DataFrame:
    """px, data, hits, sumsq, n_samples and the splits' data and hits: one pass over cleaned samples.

    The common mode is the mean over detectors of what is left of their unflagged signal without the sky.
    """
    rest = F.col("signal")
    if sky is not None:
        cleaned = cleaned.join(sky.select(F.col("px").alias("seen_at"), F.col("value").alias("sky")), "seen_at", "left")
        rest = F.col("signal") - F.coalesce("sky", F.lit(0.0))
    common = F.avg(F.when(F.col("flags") == 0, rest)).over(Window.partitionBy(*reversed(SAMPLE)))  # numbers first: a faster sort
    px = cleaned.withColumn("signal", F.col("signal") - F.coalesce(common, F.lit(0.0))).where("good and px is not null and w <> 0")
    parts = [c for tag, when in SPLITS.items() for c in sums(when=F.expr(when), tag=tag)[:2]]
    return px.groupBy("px").agg(*sums(), F.count("*").alias("n_samples"), *parts)


def naive_map(cleaned: DataFrame) -> DataFrame:
    """px, data, hits, sumsq, n_samples of the cleaned signal as it is, all detectors alike whatever their weight."""
    return cleaned.where("good and px is not null").withColumn("w", F.lit(1.0)).groupBy("px").agg(*sums(), F.count("*").alias("n_samples"))


def change(new: DataFrame, old: DataFrame) -> float | None:
    """RMS change on the pixels that both maps have; None if there are none."""
    both = new.select("px", F.col("value").alias("a")).join(old.select("px", F.col("value").alias("b")), "px")
    return both.agg(F.sqrt(F.avg((F.col("a") - F.col("b")) ** 2))).first()[0]


def make_maps(
    tod: DataFrame, grid: Grid, iterations: int = 3, weights: DataFrame | None = None, halves: DataFrame | None = None, offsets: DataFrame | None = None, steps: list[Step] = (),
    tolerance: float | None = None, folder: str | None = None, buckets: int | None = None, may_be_empty: bool = False,
) -> MapRun:
    """A naive map, a map with the plain common mode removed (it_0), and up to ``iterations`` maps with the last one as sky model.

    tod has obs_id, chunk_index, sample_idx, det_idx, signal, flags, ra, dec; weights (det_idx, weight); halves (det_idx,
    det_half); offsets (det_idx, offset).  Turns end early when a map's RMS change is at most ``tolerance``.  With the folder of a
    run that was lost, and the same arguments, it goes on where that run stopped.  Without a sample in any pixel it is an error, unless
    maps may be empty.
    """
    spark: SparkSession = tod.sparkSession
    folder = folder or snapshots.shared_folder(spark)
    # as many buckets as the session's exchanges have parts
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = _stored(_prepared(tod, grid, weights, halves, offsets, steps), f"{folder}/cleaned", buckets)
    cleaned = spark.table(table)
    at = lambda name: f"{folder}/{name}"
    for name, made in ((NAIVE, lambda: finish_map(naive_map(cleaned))), ("counts", lambda: pass_stats(cleaned))):
        if not snapshots.versions(spark, at(name)):
            snapshots.publish(made(), at(name))
    names, changes, sky = [NAIVE], [], None
    for k in range(iterations + 1):
        name = f"it_{k}"
        if not snapshots.versions(spark, at(name)):
            snapshots.publish(finish_map(turn(cleaned, sky).where("hits <> 0")), at(name))
        new = snapshots.latest(spark, at(name))
        names.append(name)
        if sky is None and not may_be_empty:
            require_coverage(new, f"{grid.ra_lo}, {grid.dec_lo}, {grid.nx} x {grid.ny}")
        if sky is not None:
            changes.append(change(new, sky))
            if tolerance is not None and changes[-1] is not None and changes[-1] <= tolerance:
                break
        sky = new
    spark.sql(f"DROP TABLE {table}")  # the name only: the files are the run's
    maps = None
    for k, name in enumerate(names):
        one = snapshots.latest(spark, at(name)).select(F.lit(k - 1).alias("stage"), F.lit(name).alias("name"), F.floor(F.col("px") / grid.nx).cast("int").alias("iy"), (F.col("px") % grid.nx).cast("int").alias("ix"), "*").drop("px")
        maps = one if maps is None else maps.unionByName(one, allowMissingColumns=True)
    return MapRun(maps, names, changes, snapshots.latest(spark, at("counts")), folder)

