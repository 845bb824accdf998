"""Results that readers see whole or not at all, whatever happens to a writer.

A result has numbered versions.  Each is written to a folder of its own and becomes visible by one rename
of a small commit file that names it; readers take the greatest committed version.  A writer lost half way
leaves an unnamed folder, and writing a version that is committed already does nothing, so a step or a
streaming batch may be repeated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name under spark.checkpoint.dir; only a session on one machine, as in tests, may do without the setting."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="starloom-")
    return f"{folder}/run-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """The folder of each committed version, oldest first."""
    fs, p = _at(spark, f"{path}/_commits")
    if not fs.exists(p):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return {int(v): f"{path}/{folder}" for v, folder in sorted((n.split("=", 1) for n in names if n[:1].isdigit()), key=lambda x: int(x[0]))}


def publish(df: DataFrame, path: str, version: int = 0, keep: int | None = 2, partition_by: tuple[str, ...] = ()) -> bool:
    """Write a version and commit it; False, and nothing done, if it is committed already.

    Of older versions the last ``keep - 1`` stay for readers that have begun (all with keep None); folders without a commit go with the others.
    """
    spark = df.sparkSession
    before = versions(spark, path)
    if version in before:
        return False
    folder = f"data-{version}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    commit(spark, path, version, folder)
    if keep is None:
        return True
    now = versions(spark, path)
    stay = {f.rsplit("/", 1)[-1] for f in list(now.values())[-keep:]}
    fs, p = _at(spark, path)
    for v, f in list(now.items())[:-keep]:
        fs.delete(_at(spark, f"{path}/_commits/{v}={f.rsplit('/', 1)[-1]}")[1], False)
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("data-") and name not in stay and int(name.split("-")[1]) <= version:
            fs.delete(s.getPath(), True)
    return True


def commit(spark: SparkSession, path: str, version: int, folder: str) -> None:
    """Make a folder that is written whole the given version: one rename."""
    fs, tmp = _at(spark, f"{path}/_commits/.{folder}")
    fs.create(tmp, True).close()
    fs.rename(tmp, _at(spark, f"{path}/_commits/{version}={folder}")[1])


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The greatest committed version."""
    found = list(versions(spark, path).values())
    if not found:
        raise FileNotFoundError(f"no committed version under {path}")
    return spark.read.parquet(found[-1])


def everything(spark: SparkSession, path: str) -> DataFrame:
    """All committed versions together, for results of which each version is a part."""
    found = list(versions(spark, path).values())
    if not found:
        raise FileNotFoundError(f"no committed version under {path}")
    return spark.read.schema(spark.read.parquet(found[-1]).schema).parquet(*found)
