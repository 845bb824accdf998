"""The driver tables as detector timestreams, by arithmetic that SQL can repeat.

events: a detector for each event type, half-hour samples from the epoch to the last event's day, chunks of a day; a sample without
events is a gap.  The boresight scans a raster of 20 x 12 pixels, and detectors sit a pixel apart in RA.
orders: seven detectors (an order's lines), a sample for each order, chunks of 512 samples and some planted gaps: timestreams as
dense as an instrument's, whose length follows the table.
lineitem: a dense sample for each row, detector = supplier, for work whose size follows the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH, STEP_S, CHUNK = 1_704_067_200, 1800, 48
RATE = 1 / STEP_S


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sample() -> F.Column:
    return F.floor((F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - EPOCH) / STEP_S).cast("long")


def samples(seen: DataFrame) -> DataFrame:
    """sample_idx: every sample of the chunks from the epoch's, or the first that is seen before it, to the last that is seen."""
    chunk = F.floor(F.col("sample_idx") / CHUNK)
    ends = seen.agg(F.least(F.lit(0).cast("long"), F.min(chunk)).alias("a"), F.max(chunk).alias("b")).where("b is not null")
    return ends.select(F.explode(F.sequence(F.col("a") * CHUNK, (F.col("b") + 1) * CHUNK - 1)).alias("sample_idx"))


def tod_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs_id, chunk_index, sample_idx, t, det, det_idx, signal (null in gaps), flags."""
    e = read(spark, sf_dir, "events")
    sample = _sample()
    k = F.get_json_object("props", "$.k").cast("int")
    cells = e.groupBy(F.col("event_type").alias("det"), sample.alias("sample_idx")).agg(F.avg("value").alias("signal"), F.max(k).alias("top_k"))
    # five event types: the detector list is a handful of rows
    dets = e.select(F.col("event_type").alias("det")).distinct().withColumn("n", F.lit(1)).groupBy("n").agg(F.array_sort(F.collect_set("det")).alias("dets")).select(F.posexplode("dets").alias("det_idx", "det"))
    grid = dets.crossJoin(samples(cells))
    return grid.join(cells, ["det", "sample_idx"], "left").select(
        F.lit("ev").alias("obs_id"), F.floor(F.col("sample_idx") / CHUNK).cast("long").alias("chunk_index"), "sample_idx", (F.lit(float(EPOCH)) + F.col("sample_idx") * float(STEP_S)).alias("t"),
        "det", "det_idx", "signal", F.when(F.col("top_k") >= 97, 4).otherwise(0).alias("flags"),
    )


def raster_ra(sample_idx: F.Column) -> F.Column:
    return F.lit(10.0) + F.lit(0.05) * (sample_idx % 20)


def raster_dec(sample_idx: F.Column) -> F.Column:
    return F.lit(20.0) + F.lit(0.05) * (F.floor(sample_idx / 20) % 12)


def boresight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs_id, chunk_index, sample_idx, t, ra_bore, dec_bore of the events' raster."""
    s = samples(read(spark, sf_dir, "events").select(_sample().alias("sample_idx")))
    i = F.col("sample_idx")
    return s.select(F.lit("ev").alias("obs_id"), F.floor(i / CHUNK).cast("long").alias("chunk_index"), i, (F.lit(float(EPOCH)) + i * float(STEP_S)).alias("t"), raster_ra(i).alias("ra_bore"), raster_dec(i).alias("dec_bore"))


def pointed(tod: DataFrame) -> DataFrame:
    """Adds ra, dec (detectors 0.05 degrees apart in RA) and ra_bore, dec_bore."""
    i = F.col("sample_idx")
    return tod.withColumns({"ra_bore": raster_ra(i), "dec_bore": raster_dec(i)}).withColumn("ra", F.col("ra_bore") + F.lit(0.05) * (F.col("det_idx") - 2)).withColumn("dec", F.col("dec_bore"))


def tod_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample for each row: detector = supplier, chunk = order group, position from part and order keys."""
    return lineitem_samples(read(spark, sf_dir, "lineitem"))


def lineitem_samples(i: DataFrame) -> DataFrame:
    """The same for any frame of lineitem rows, a stream as well."""
    return i.select(
        F.lit("li").alias("obs_id"), (F.col("l_orderkey") % 64).alias("chunk_index"), F.col("l_orderkey").alias("sample_idx"), F.col("l_suppkey").alias("det_idx"), F.format_string("s%05d", "l_suppkey").alias("det"),
        F.col("l_extendedprice").alias("signal"), F.when(F.col("l_returnflag") == "R", 4).otherwise(0).alias("flags"),
        (F.lit(10.025) + F.lit(0.05) * (F.col("l_partkey") % 40)).alias("ra"), (F.lit(20.025) + F.lit(0.05) * (F.col("l_orderkey") % 30)).alias("dec"),
    )


DENSE_CHUNK, DENSE_DETECTORS = 512, 7


def tod_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs_id, chunk_index, sample_idx, t, det, det_idx, signal (null in planted gaps), flags, pointed on the events' raster."""
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("sample_idx"), (F.col("l_linenumber") - 1).cast("int").alias("det_idx")).agg(
        F.avg("l_extendedprice").alias("price"), F.max(F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 47), 4).otherwise(0)).alias("flagged")
    )
    i, d = F.col("sample_idx"), F.col("det_idx")
    grid = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sample_idx"), "o_totalprice", F.explode(F.sequence(F.lit(0), F.lit(DENSE_DETECTORS - 1))).alias("det_idx"))
    j = grid.join(lines, ["sample_idx", "det_idx"], "left")
    signal = F.when((i * 7 + d) % 97 >= 3, F.coalesce("price", F.col("o_totalprice") / 4))
    out = j.select(
        F.lit("or").alias("obs_id"), F.floor(i / DENSE_CHUNK).cast("long").alias("chunk_index"), "sample_idx", i.cast("double").alias("t"), F.concat(F.lit("d"), d.cast("string")).alias("det"), "det_idx", signal.alias("signal"), F.coalesce("flagged", F.lit(0)).alias("flags"),
    )
    return out.withColumns({"ra_bore": raster_ra(i), "dec_bore": raster_dec(i)}).withColumn("ra", F.col("ra_bore") + F.lit(0.05) * (d - 3)).withColumn("dec", F.col("dec_bore"))
