"""Exact medians of groups of any size and any spread of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rank error of the pivots, as a share of the group, is one in so many; the part that is put in order spans six of them.
ACCURACY = 10_000
#: Rows of one group meet its pivots under so many keys, so that no task gathers them.
SALTS = 16


def exact_median(df: DataFrame, keys: list[str], column: str, accuracy: int = ACCURACY) -> DataFrame:
    """keys, column: the median of each group's values (the mean of the middle two of an even number).

    Nulls and NaN are left out, infinities count.  A quantile sketch, merged from all tasks, gives two pivots round the
    middle; values below, between and above them are counted, and only the part (or two) that holds the middle ones is put
    in order, equal values as one row.  However values spread, that part is some 6 of ``accuracy`` parts of the group; the
    counts are exact, so the result is, too, whatever the sketch's error.
    """
    x = F.col(column).cast("double")
    rows = df.select(*keys, x.alias("__x")).where("__x is not null and not isnan(__x)")
    margin = min(0.5, 2.0 / accuracy)
    pivots = rows.groupBy(*keys).agg(F.percentile_approx("__x", [0.5 - margin, 0.5 + margin], accuracy).alias("__p"))
    spread = pivots.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = rows.withColumn("__salt", F.pmod(F.xxhash64("__x"), F.lit(SALTS)).cast("int")).join(spread, [*keys, "__salt"])
    placed = placed.withColumn("__part", F.when(F.col("__x") < F.col("__p")[0], 0).when(F.col("__x") <= F.col("__p")[1], 1).otherwise(2))
    counts = placed.groupBy(*keys, "__part").agg(F.count("*").alias("__m"))  # three rows a group
    group = Window.partitionBy(*keys)
    counts = counts.withColumns({"__all": F.sum("__m").over(group), "__before": F.sum("__m").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__m")})
    low, high = F.floor((F.col("__all") - 1) / 2), F.floor(F.col("__all") / 2)
    middle = counts.where((F.col("__before") <= high) & (F.col("__before") + F.col("__m") > low)).select(*keys, "__part", "__all", "__before")
    middle = middle.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    inside = placed.join(middle, [*keys, "__salt", "__part"]).groupBy(*keys, "__part", "__all", "__before", "__x").agg(F.count("*").alias("__n"))
    upto = F.col("__before") + F.sum("__n").over(Window.partitionBy(*keys, "__part").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0))
    ranked = inside.withColumn("__upto", upto).withColumn("__from", F.col("__upto") - F.col("__n"))
    pick = lambda rank: F.max(F.when((F.col("__from") <= rank) & (F.col("__upto") > rank), F.col("__x")))
    return ranked.groupBy(*keys).agg(((pick(low) + pick(high)) / 2).alias(column))
