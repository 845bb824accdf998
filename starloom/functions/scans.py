"""Ordered scans of long streams in two levels.

A window over a stream's whole order would put the stream in one task.  Here rows are cut into buckets of
their order column, windows run inside a bucket, and what passes a border comes from a window over one row
a bucket.  Rows are exchanged once, by key and bucket; keys and order are not null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "__bucket"


def bucketed(df: DataFrame, order: str, size: float) -> DataFrame:
    return df.withColumn(BUCKET, F.floor(F.col(order) / size))


def with_previous(rows: DataFrame, keys: list[str], order: str, column: str | Column, name: str) -> DataFrame:
    """Adds the column's value in the row before, over bucket borders too; null in a key's first row.  rows are bucketed."""
    value = F.struct((F.col(column) if isinstance(column, str) else column).alias("v"))
    rows = rows.withColumn("__value", value)
    ends = rows.groupBy(*keys, BUCKET).agg(F.max_by("__value", order).alias("__end"))
    before = ends.select(*keys, BUCKET, F.lag("__end").over(Window.partitionBy(*keys).orderBy(BUCKET)).alias("__before"))
    inside = F.lag("__value").over(Window.partitionBy(*keys, BUCKET).orderBy(order))
    out = rows.withColumn("__inside", inside).join(before, [*keys, BUCKET])
    return out.withColumn(name, F.coalesce("__inside", "__before")["v"]).drop("__value", "__inside", "__before")


def with_running_sum(rows: DataFrame, keys: list[str], order: str, column: str, name: str) -> DataFrame:
    """Adds the sum of a column up to each row.  rows are bucketed; nulls count as 0."""
    sums = rows.groupBy(*keys, BUCKET).agg(F.coalesce(F.sum(column), F.lit(0)).alias("__sum"))
    before = sums.select(*keys, BUCKET, (F.sum("__sum").over(Window.partitionBy(*keys).orderBy(BUCKET)) - F.col("__sum")).alias("__carry"))
    inside = F.sum(column).over(Window.partitionBy(*keys, BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("__inside", F.coalesce(inside, F.lit(0))).join(before, [*keys, BUCKET])
    return out.withColumn(name, F.col("__inside") + F.col("__carry")).drop("__inside", "__carry")


def with_rank(rows: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Adds the row's number in its key's order, from 1.  rows are bucketed."""
    return with_running_sum(rows.withColumn("__one", F.lit(1).cast("long")), keys, order, "__one", name).drop("__one")
