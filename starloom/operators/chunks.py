"""Chunks, time windows, sampling and other selections of timestreams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.medians import exact_median


def assign_chunks(samples: DataFrame, dur_s: float, rate: float, per_file: bool = False) -> DataFrame:
    """Adds chunk_index to a per-time table (obs_id, file_idx, sample_idx, ...).

    Fixed length over file borders, a short tail kept; per_file starts anew in each file; a duration of
    0 or less takes the frames (file_idx) as they are.  Order within an observation comes from counts of the
    files before, so only one file's samples are numbered in one place.
    """
    n = max(1, int(dur_s * rate)) if dur_s > 0 else None
    w = Window.partitionBy("obs_id", "file_idx").orderBy("sample_idx")
    numbered = samples.withColumn("__i", F.row_number().over(w) - 1)
    files = samples.groupBy("obs_id", "file_idx").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("obs_id").orderBy("file_idx").rowsBetween(Window.unboundedPreceding, -1)
    if n is None:
        place = files.withColumn("__c", F.dense_rank().over(Window.partitionBy("obs_id").orderBy("file_idx")) - 1)
        return numbered.join(place.drop("__n"), ["obs_id", "file_idx"]).withColumn("chunk_index", F.col("__c").cast("long")).drop("__i", "__c")
    if per_file:
        place = files.withColumn("__b", F.coalesce(F.sum(F.ceil(F.col("__n") / n)).over(before), F.lit(0)))
        return numbered.join(place.drop("__n"), ["obs_id", "file_idx"]).withColumn("chunk_index", (F.col("__b") + F.floor(F.col("__i") / n)).cast("long")).drop("__i", "__b")
    place = files.withColumn("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return numbered.join(place.drop("__n"), ["obs_id", "file_idx"]).withColumn("chunk_index", F.floor((F.col("__b") + F.col("__i")) / n).cast("long")).drop("__i", "__b")


def chunk_table(samples: DataFrame, rate: float, last_sample: bool = False) -> DataFrame:
    """obs_id, chunk_index, n_samples, t_start, t_stop; the stop is one period after the start of the last, or its time."""
    stop = F.max("t") if last_sample else F.min("t") + F.countDistinct("t") / F.lit(rate)
    return samples.groupBy("obs_id", "chunk_index").agg(F.countDistinct("t").alias("n_samples"), F.min("t").alias("t_start"), stop.alias("t_stop"))


def select_time_window(tod: DataFrame, chunks: DataFrame, start_s: float, max_s: float | None) -> DataFrame:
    """Whole chunks only: those that end after the start, and begin before start + max."""
    t0 = chunks.groupBy("obs_id").agg(F.min("t_start").alias("__t0"))
    c = chunks.join(t0, "obs_id").where(F.col("t_stop") - F.col("__t0") > start_s)
    if max_s is not None:
        c = c.where(F.col("t_start") - F.col("__t0") < start_s + max_s)
    return tod.join(c.select("obs_id", "chunk_index"), ["obs_id", "chunk_index"], "left_semi")


def subsample(samples: DataFrame, step: int) -> DataFrame:
    """Every step-th sample of the kept ones of an observation, the phase running on over chunks."""
    if isinstance(step, bool) or not isinstance(step, int) or step < 1:
        raise ValueError("step must be a positive whole number")
    counts = samples.groupBy("obs_id", "chunk_index").agg(F.countDistinct("sample_idx").alias("__n"))
    before = Window.partitionBy("obs_id").orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, -1)
    place = counts.withColumn("__b", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    rank = F.dense_rank().over(Window.partitionBy("obs_id", "chunk_index").orderBy("sample_idx")) - 1
    return samples.withColumn("__r", rank).join(place, ["obs_id", "chunk_index"]).where((F.col("__b") + F.col("__r")) % step == 0).drop("__r", "__b")


def sample_rate(samples: DataFrame) -> DataFrame:
    """obs_id, rate: samples of the first file over the time between its first and last."""
    first = samples
    if "file_idx" in samples.columns:  # a row an observation
        first = samples.join(samples.groupBy("obs_id").agg(F.min("file_idx").alias("file_idx")), ["obs_id", "file_idx"], "left_semi")
    return first.groupBy("obs_id").agg((F.countDistinct("t") / (F.max("t") - F.min("t"))).alias("rate"))


def median_cadence(stream: DataFrame, key: str, t: str = "t", bucket: float = 3600.0) -> DataFrame:
    """key, cadence: median step between neighbouring times.

    Steps are taken inside buckets of time, and the first of a bucket from the last time before it.
    """
    own = stream.select(key, F.col(t).alias("__t"), F.floor(F.col(t) / bucket).alias("__k"))
    ends = own.groupBy(key, "__k").agg(F.max("__t").alias("__end"))
    before = ends.withColumn("__before", F.lag("__end").over(Window.partitionBy(key).orderBy("__k"))).drop("__end")  # one row a bucket
    last = F.lag("__t").over(Window.partitionBy(key, "__k").orderBy("__t"))
    steps = own.join(before, [key, "__k"]).withColumn("__d", F.col("__t") - F.coalesce(last, F.col("__before")))
    return exact_median(steps.where("__d is not null"), [key], "__d").withColumnRenamed("__d", "cadence")


def fully_flagged(tod: DataFrame) -> DataFrame:
    """obs_id, chunk_index of chunks in which every sample of every detector is flagged."""
    return tod.groupBy("obs_id", "chunk_index").agg(F.bool_and(F.col("flags") != 0).alias("__all")).where("__all").select("obs_id", "chunk_index")


def drop_fully_flagged(tod: DataFrame) -> DataFrame:
    return tod.join(fully_flagged(tod), ["obs_id", "chunk_index"], "left_anti")


def time_slice(tod: DataFrame, a: float, b: float) -> DataFrame:
    """Samples from a to b seconds after the start of their observation."""
    t0 = tod.groupBy("obs_id").agg(F.min("t").alias("__t0"))
    return tod.join(F.broadcast(t0), "obs_id").where((F.col("t") - F.col("__t0") >= a) & (F.col("t") - F.col("__t0") < b)).drop("__t0")
