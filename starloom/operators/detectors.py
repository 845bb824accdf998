"""Detector statistics of the preparation pass, exclusion and weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_DET = ("obs_id", "chunk_index", "det_idx")


def first_difference(tod: DataFrame, name: str = "diff") -> DataFrame:
    """Adds the difference to the sample before in the same chunk, null where either is missing."""
    w = Window.partitionBy(*CHUNK_DET).orderBy("sample_idx")
    return tod.withColumn(name, F.col("signal") - F.lag("signal").over(w))


def detector_offsets(tod: DataFrame) -> DataFrame:
    """det_idx, offset: mean over chunks of the chunk's strided median.

    The stride, the power of two at or below n / 100, leaves 100 to 199 samples of a chunk
    of n > 100, so the median's buffer has a bound; chunks without a value do not count.
    """
    w = Window.partitionBy(*CHUNK_DET)
    stride = F.when(F.col("__n") > 100, F.pow(F.lit(2.0), F.floor(F.log2(F.col("__n") / 100)))).otherwise(1.0).cast("long")
    placed = tod.withColumn("__n", F.count("*").over(w)).withColumn("__i", F.row_number().over(w.orderBy("sample_idx")) - 1)
    medians = placed.where(F.col("__i") % stride == 0).groupBy(*CHUNK_DET).agg(F.expr("percentile(signal, 0.5)").alias("__m"))
    return medians.groupBy("det_idx").agg(F.avg("__m").alias("offset"))


def detector_noise(tod: DataFrame) -> DataFrame:
    """det_idx, noise: population deviation of good first differences over the square root of two."""
    d = first_difference(tod.withColumn("signal", F.when(F.col("flags") == 0, F.col("signal"))), "__d")
    return d.groupBy("det_idx").agg((F.stddev_pop("__d") / F.sqrt(F.lit(2.0))).alias("noise"))


def mean_boresight(boresight: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """Mean position over samples, without those of the wholly flagged chunks that are given; missing values play no part."""
    kept = boresight if flagged is None else boresight.join(flagged, ["obs_id", "chunk_index"], "left_anti")
    return kept.agg(F.avg("ra_bore").alias("ra"), F.avg("dec_bore").alias("dec"))


def pointing_extent(tod: DataFrame) -> DataFrame:
    """det_idx and the range of good samples' RA and Dec, of boresight and detector together."""
    good = tod.where("flags = 0")
    return good.groupBy("det_idx").agg(F.min(F.least("ra", "ra_bore")).alias("ra_min"), F.max(F.greatest("ra", "ra_bore")).alias("ra_max"), F.min(F.least("dec", "dec_bore")).alias("dec_min"), F.max(F.greatest("dec", "dec_bore")).alias("dec_max"))


def prep_stats(tod: DataFrame) -> DataFrame:
    """One row: samples, flagged samples, chunks, wholly flagged chunks, samples of PSD-sized chunks."""
    chunks = tod.groupBy("obs_id", "chunk_index").agg(F.count("*").alias("n"), F.count_if(F.col("flags") != 0).alias("bad"), F.countDistinct("sample_idx").alias("len"))
    first = chunks.where("bad < n").agg(F.min_by("len", F.struct("obs_id", "chunk_index")).alias("psd_len"))
    return chunks.crossJoin(F.broadcast(first)).agg(F.sum("n").alias("samples"), F.sum("bad").alias("flagged"), F.count("*").alias("chunks"), F.count_if(F.col("n") == F.col("bad")).alias("chunks_flagged"), F.sum(F.when(F.col("len") == F.col("psd_len"), F.col("n")).otherwise(0)).alias("psd_samples"))


def obs_info(tod: DataFrame) -> DataFrame:
    return tod.groupBy("obs_id").agg(
        F.min("t").alias("t_start"), F.max("t").alias("t_stop"), (F.max("t") - F.min("t")).alias("duration"), F.countDistinct("det_idx").alias("detectors"), F.countDistinct("chunk_index").alias("chunks"), ((F.countDistinct("t") - 1) / (F.max("t") - F.min("t"))).alias("rate")
    )


def select_detectors(dets: DataFrame, names: list[str] | None = None, indices: list[int] | None = None, n: int | None = None) -> DataFrame:
    """By name, else by index, else n evenly spaced ones, else all (det, det_idx); unknown ones drop out."""
    if names:
        return dets.where(F.col("det").isin(*names))
    if indices:
        return dets.where(F.col("det_idx").isin(*indices))
    if not n:
        return dets
    size = dets.agg(F.count("*").alias("m"))
    spots = size.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(i * (F.col("m") - 1) / max(1, n - 1)))).alias("det_idx")).distinct()
    return dets.join(F.broadcast(spots), "det_idx", "left_semi")


def unknown_detectors(dets: DataFrame, names: list[str]) -> DataFrame:
    asked = dets.sparkSession.createDataFrame([(x,) for x in names], "det string")
    return asked.join(dets, "det", "left_anti")


def keep_detectors(tod: DataFrame, excluded: DataFrame) -> DataFrame:
    """Without the excluded ones; the list has a row a detector, so Spark broadcasts it if it is small."""
    return tod.join(excluded.select("det_idx").distinct(), "det_idx", "left_anti")


def subtract_offset(tod: DataFrame, offsets: DataFrame) -> DataFrame:
    return tod.join(offsets.select("det_idx", "offset"), "det_idx", "left").withColumn("signal", F.col("signal") - F.coalesce("offset", F.lit(0.0))).drop("offset")


def exclude_noisy(state: DataFrame, k: float = 5.0) -> DataFrame:
    """det_idx, reason, cutoff: noise over k medians; k = 0 turns the cut off."""
    if not k:
        return state.limit(0).select("det_idx", F.lit("noise").alias("reason"), F.lit(0.0).alias("cutoff"))
    cut = state.agg((F.expr("percentile(noise, 0.5)") * k).alias("cutoff"))
    return state.crossJoin(F.broadcast(cut)).where("noise > cutoff").select("det_idx", F.lit("noise").alias("reason"), "cutoff")


def exclude_wnf(state: DataFrame, k: float = 3.0) -> DataFrame:
    """det_idx, reason, cutoff: white-noise floor missing, not positive, or k deviations above the median in log10."""
    if not k:
        return state.limit(0).select("det_idx", F.lit("wnf").alias("reason"), F.lit(0.0).alias("cutoff"))
    log = F.when(F.col("wnf") > 0, F.log10("wnf"))
    cut = state.select(log.alias("l")).agg(F.pow(F.lit(10.0), F.expr("percentile(l, 0.5)") + k * F.stddev_pop("l")).alias("cutoff"))
    return state.crossJoin(F.broadcast(cut)).where("wnf is null or wnf <= 0 or wnf > cutoff").select("det_idx", F.lit("wnf").alias("reason"), "cutoff")


def exclude_detectors(state: DataFrame, names: list[str] = (), indices: list[int] = (), noise_k: float = 5.0, wnf_k: float = 3.0) -> DataFrame:
    """det_idx, reasons: all cuts together, each detector once with its sorted reasons."""
    by_hand = state.where(F.col("det").isin(*names) | F.col("det_idx").isin(*indices)).select("det_idx", F.lit("manual").alias("reason")) if names or indices else None
    parts = exclude_noisy(state, noise_k).select("det_idx", "reason").unionByName(exclude_wnf(state, wnf_k).select("det_idx", "reason"))
    if by_hand is not None:
        parts = parts.unionByName(by_hand)
    return parts.groupBy("det_idx").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def detector_weights(state: DataFrame, cap: float = 5.0) -> DataFrame:
    """det_idx, weight: 1 / wnf, at most cap medians; the median where wnf is not valid; all 1 without any or cap 0."""
    raw = state.withColumn("__w", F.when(F.col("wnf") > 0, 1 / F.col("wnf")))
    med = raw.agg(F.expr("percentile(__w, 0.5)").alias("__m"))
    w = F.coalesce(F.least(F.coalesce("__w", "__m"), F.col("__m") * cap), F.lit(1.0)) if cap else F.lit(1.0)
    return raw.crossJoin(F.broadcast(med)).select("det_idx", w.alias("weight"))


def weight_summary(weights: DataFrame) -> DataFrame:
    return weights.agg(F.min("weight").alias("w_min"), F.expr("percentile(weight, 0.5)").alias("w_median"), F.max("weight").alias("w_max"))
