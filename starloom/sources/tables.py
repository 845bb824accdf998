"""Reading and writing of observations, maps, spectra and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.geometry import boresight_dir, finite
from starloom.sources import snapshots

TOD = T.StructType([
    T.StructField("obs_id", T.StringType()), T.StructField("file_idx", T.IntegerType()), T.StructField("chunk_index", T.LongType()), T.StructField("sample_idx", T.LongType()),
    T.StructField("t", T.DoubleType()), T.StructField("det", T.StringType()), T.StructField("det_idx", T.IntegerType()), T.StructField("signal", T.DoubleType()), T.StructField("flags", T.IntegerType()),
])


def read_tod(spark: SparkSession, paths: str | list[str], suffix: str = "parquet") -> DataFrame:
    """All files under the paths, directories gone through, as one observation; NaN becomes null."""
    df = spark.read.schema(TOD).option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").parquet(*([paths] if isinstance(paths, str) else paths))
    if not df.inputFiles():
        raise FileNotFoundError(f"no *.{suffix} under {paths}")
    return df.withColumn("signal", finite(F.col("signal")))


def input_manifest(df: DataFrame) -> DataFrame:
    """path, n_rows, read: the files of a frame; a file without rows is listed as not read."""
    seen = df.groupBy(F.col("_metadata.file_name").alias("path")).agg(F.count("*").alias("n_rows"))
    found = df.sparkSession.createDataFrame([(p.rsplit("/", 1)[-1],) for p in sorted(df.inputFiles())], "path string")
    return found.join(seen, "path", "left").select("path", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.col("n_rows").isNotNull().alias("read"))


def decompress_signal(raw: DataFrame, calib: DataFrame, keys: list[str]) -> DataFrame:
    """raw / gain + offset where a detector's frame has both, else raw."""
    both = F.col("gain").isNotNull() & F.col("offset").isNotNull()
    return raw.join(calib.select(*keys, "gain", "offset"), keys, "left").withColumn("signal", F.when(both, F.col("raw") / F.col("gain") + F.col("offset")).otherwise(F.col("raw").cast("double"))).drop("gain", "offset")


def load_focalplane(df: DataFrame) -> DataFrame:
    """Adds dir, the direction that each detector's offset quaternion turns the z axis to."""
    return df.withColumn("dir", boresight_dir(F.col("q")))


def unpack_blocks(df: DataFrame, first: str = "first_sample") -> DataFrame:
    """Array rows (det, first_sample, signal array, flags array) as one row for each sample."""
    each = F.posexplode(F.arrays_zip("signal", "flags"))
    keep = [c for c in df.columns if c not in ("signal", "flags", first)]
    return df.select(*keep, F.col(first).alias("__first"), each.alias("__i", "__x")).select(*keep, (F.col("__first") + F.col("__i")).alias("sample_idx"), F.col("__x.signal").alias("signal"), F.col("__x.flags").alias("flags"))


def pack_blocks(tod: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group of keys, its samples in order as arrays; groups are chunks, so bounded."""
    rows = F.array_sort(F.collect_list(F.struct("sample_idx", "signal", "flags")))
    return tod.groupBy(*keys).agg(rows.alias("__r")).select(*keys, F.col("__r")[0]["sample_idx"].alias("first_sample"), F.col("__r.signal").alias("signal"), F.col("__r.flags").alias("flags"))


def write_maps(maps: DataFrame, path: str, version: int = 0) -> None:
    """Maps (stage, iy, ix, ..) by stage, as a snapshot that ``snapshots.latest`` reads."""
    snapshots.publish(maps, path, version, partition_by=("stage",))


def write_psd(psd: DataFrame, path: str, version: int = 0) -> None:
    snapshots.publish(psd, path, version)


def metadata_json(df: DataFrame) -> DataFrame:
    """One JSON text a row; numbers that are not finite become null, times ISO texts."""
    cols = [finite(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType | T.FloatType) else F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss").alias(f.name) if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType) else F.col(f.name) for f in df.schema]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def write_metadata(df: DataFrame, path: str) -> None:
    metadata_json(df).write.mode("overwrite").text(path)


def write_centroids(df: DataFrame, path: str) -> None:
    """Centroids as JSON rows of a detector name and its values."""
    values = [c for c in df.columns if c != "det"]
    df.select(F.create_map(F.col("det"), F.struct(*values)).alias("detectors")).write.mode("overwrite").json(path)


def read_centroids(spark: SparkSession, path: str, values: str = "ra double, dec double, snr double") -> DataFrame:
    return spark.read.schema(f"detectors map<string, struct<{values.replace(' double', ': double')}>>").json(path).select(F.explode("detectors").alias("det", "v")).select("det", "v.*")
