"""Maps and chunk statistics while an observation arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starloom.operators.binning import Grid, good_samples, pixels, sums, weighted
from starloom.sources import snapshots


def stream_map(samples: DataFrame, grid: Grid, weights: DataFrame | None = None) -> DataFrame:
    """Running sums for each pixel of a stream of pointed samples; in complete mode equal to the batch map in the end.

    Common mode needs all detectors of a time together, so a stream is binned as it is or with weights.
    """
    return pixels(weighted(good_samples(samples), weights), grid).groupBy("iy", "ix").agg(*sums(), F.count("*").alias("n_samples"))


def stream_chunk_stats(samples: DataFrame, duration: str, lateness: str, ts: str = "ts", by: str = "det") -> DataFrame:
    """Count, mean and deviation of each detector in tumbling windows; Spark drops rows later than the watermark, which ``run_with_late`` keeps."""
    return samples.withWatermark(ts, lateness).groupBy(F.window(ts, duration), by).agg(F.count("*").alias("n"), F.avg("signal").alias("mean"), F.stddev_pop("signal").alias("std")).select(F.col("window.start").alias("t_start"), F.col("window.end").alias("t_stop"), by, "n", "mean", "std")


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop; append results to files, with state and progress in the checkpoint folder."""
    q = df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_to_table(df: DataFrame, checkpoint: str, path: str) -> StreamingQuery:
    """Complete-mode results as a snapshot of each batch (``snapshots.latest`` reads the last): readers see a whole map or the
    one before, and a batch that is repeated after a failure changes nothing."""
    q = df.writeStream.outputMode("complete").foreachBatch(lambda part, batch: snapshots.publish(part, path, batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def split_late(rows: DataFrame, stops: DataFrame | None, key: str, ts: str, lateness: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a column late, stops after them): late is a row more than ``lateness`` before its key's stop, the largest time of the batches before."""
    seen = rows.groupBy(key).agg(F.max(ts).alias("stop"))
    if stops is None:
        return rows.withColumn("late", F.lit(False)), seen
    held = stops.select(F.col(key).alias("__key"), "stop")
    marked = rows.join(held, F.col(key) == F.col("__key"), "left").withColumn("late", F.coalesce(F.col(ts) < F.col("stop") - F.expr(f"INTERVAL {lateness}"), F.lit(False))).drop("__key", "stop")
    return marked, stops.unionByName(seen).groupBy(key).agg(F.max("stop").alias("stop"))


def run_with_late(samples: DataFrame, path: str, checkpoint: str, lateness: str, ts: str = "ts", key: str = "det") -> StreamingQuery:
    """Every row of a stream goes to one of two places: ``arrived(path)`` and, with late = true, those that came too late for windows.

    Each batch commits its rows and then the stops it leaves behind, a row a key, both numbered by the batch.  A batch repeated
    after a failure finds the stops of the batch before and writes only what is not committed yet.
    """
    spark = samples.sparkSession

    def write(part: DataFrame, batch: int) -> None:
        before = snapshots.versions(spark, f"{path}/stops")
        last = [f for v, f in before.items() if v < batch]
        marked, stops = split_late(part, spark.read.parquet(last[-1]) if last else None, key, ts, lateness)
        snapshots.publish(marked, f"{path}/rows", batch, keep=None)
        snapshots.publish(stops, f"{path}/stops", batch)

    q = samples.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def arrived(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches, with late."""
    return snapshots.everything(spark, f"{path}/rows")
