"""Streams of different cadence on one time grid; checks of times.

An as-of join by ordered windows over a whole stream would put the stream on one task, so times are
cut into buckets, and each bucket also gets the last row before it and the first after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.flags import GAP, is_finite
from starloom.functions.geometry import shortest_arc
from starloom.functions.scans import BUCKET, bucketed, with_previous, with_rank, with_running_sum
from starloom.operators.chunks import median_cadence


def bracket_join(src: DataFrame, targets: DataFrame, value: str, factor: float = 1.5, bucket: float = 3600.0, tol: float = 0.0) -> DataFrame:
    """stream, t, t0, v0, t1, v1, valid: the last source row at or before each target time and the first at or after.

    src has (stream, t, value), targets (t), all times in one unit.  Not valid outside the source's range or
    where the bracket is wider than factor median cadences.  A source row within tol of the target is an exact hit, valid
    over any gap, and both ends of the bracket.  bucket and tol are time spans of the same unit.
    """
    s = src.select("stream", "t", F.col(value).alias("v")).where("v is not null")
    b = lambda c: F.floor(F.col(c) / bucket)
    own = s.withColumn("k", b("t"))
    edges = own.groupBy("stream", "k").agg(F.max(F.struct("t", "v")).alias("hi"), F.min(F.struct("t", "v")).alias("lo"))
    asked = targets.select("t").distinct().withColumn("k", b("t"))
    keys = asked.select("k").distinct().crossJoin(s.select("stream").distinct()).unionByName(edges.select("k", "stream")).distinct()
    w = Window.partitionBy("stream").orderBy("k")  # one row a bucket
    back = Window.partitionBy("stream").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    ends = keys.join(edges, ["stream", "k"], "left").withColumns({"before": F.last("hi", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), "after": F.last("lo", ignorenulls=True).over(back)})
    rows = own.select("stream", "k", F.struct("t", "v").alias("p"), "t", F.lit(False).alias("ask")).unionByName(asked.join(keys.select("k", "stream"), "k").select("stream", "k", F.lit(None).cast("struct<t: double, v: double>").alias("p"), F.col("t"), F.lit(True).alias("ask")))
    at = Window.partitionBy("stream", "k").orderBy("t").rangeBetween(Window.unboundedPreceding, 0)
    # what comes after is read in falling order of time: a frame up to a bucket's end would be gone through anew for each row
    up = Window.partitionBy("stream", "k").orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, 0)
    near = rows.withColumns({"l": F.last("p", ignorenulls=True).over(at), "r": F.last("p", ignorenulls=True).over(up)}).where("ask")
    full = near.join(ends.select("stream", "k", "before", "after"), ["stream", "k"], "left")
    full = full.select("stream", "t", F.coalesce("l", "before").alias("l"), F.coalesce("r", "after").alias("r")).join(median_cadence(s, "stream", bucket=bucket), "stream", "left")
    hit = F.when(F.col("t") - F.col("l.t") <= tol, F.col("l")).when(F.col("r.t") - F.col("t") <= tol, F.col("r"))
    full = full.withColumn("hit", hit).withColumns({c: F.coalesce("hit", c) for c in ("l", "r")})
    valid = F.col("l").isNotNull() & F.col("r").isNotNull() & ((F.col("r.t") - F.col("l.t")) <= factor * F.col("cadence"))
    return full.select("stream", "t", F.col("l.t").alias("t0"), F.col("l.v").alias("v0"), F.col("r.t").alias("t1"), F.col("r.v").alias("v1"), F.coalesce(valid, F.lit(False)).alias("valid"))


def align_streams(src: DataFrame, targets: DataFrame, value: str, factor: float = 1.5, bucket: float = 3600.0) -> DataFrame:
    """stream, t, value, flags: linear between the brackets; null with the gap flag where not valid."""
    j = bracket_join(src, targets, value, factor, bucket)
    line = F.when(F.col("t1") > F.col("t0"), F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("t") - F.col("t0")) / (F.col("t1") - F.col("t0"))).otherwise(F.col("v0"))
    return j.select("stream", "t", F.when(F.col("valid"), line).alias(value), F.when(F.col("valid"), 0).otherwise(GAP).alias("flags"))


def common_grid(streams: DataFrame, bucket: float = 3600.0) -> DataFrame:
    """t of the shared grid: latest start to earliest end, at the first stream's median step; error without overlap.

    bucket is a time span of the unit of t that holds some thousand rows of a stream.
    """
    span = streams.groupBy("stream").agg(F.min("t").alias("a"), F.max("t").alias("b")).agg(F.max("a").alias("origin"), F.min("b").alias("end"), F.min("stream").alias("stream"))
    cad = median_cadence(streams, "stream", bucket=bucket).withColumnRenamed("stream", "s")
    g = span.join(cad, F.col("stream") == F.col("s")).select("origin", "cadence", (F.floor((F.col("end") - F.col("origin")) / F.col("cadence") + 1e-9) + 1).cast("long").alias("n"))
    row = g.first()
    if row is None or row.n < 1:
        raise ValueError("the streams have no time in common")
    spark = streams.sparkSession
    return spark.range(row.n).select((F.lit(row.origin) + F.col("id") * F.lit(row.cadence)).alias("t"))


def unwrap(stream: DataFrame, column: str, key: str = "stream", t: str = "t", period: float = 360.0, bucket: float = 3600.0) -> DataFrame:
    """column without jumps of over half a period: whole turns are added, counted in two levels (buckets are spans of t)."""
    rows = with_previous(bucketed(stream, t, bucket), [key], t, column, "__last")
    step = F.col(column) - F.col("__last")
    rows = rows.withColumn("__turns", F.coalesce(F.round((shortest_arc(step, period) - step) / period), F.lit(0.0)))
    out = with_running_sum(rows, [key], t, "__turns", "__whole")
    return out.withColumn(column, F.col(column) + F.col("__whole") * period).drop("__last", "__turns", "__whole", BUCKET)


def order_housekeeping(blocks: DataFrame, bucket: float = 3600.0) -> DataFrame:
    """seq, t, az, el: the rows of all blocks (block, t, az, el) in the order of time, numbered from 1.

    Blocks may come in any order and overlap.  A time that several rows give with equal values is one row; where values differ, or are not
    finite or out of range, the time is left out here and reported by ``housekeeping_problems``.
    """
    sound = _housekeeping(blocks).where("not contradicts and not wrong")
    return with_rank(bucketed(sound.select("t", "az", "el"), "t", bucket), [], "t", "seq").select("seq", "t", "az", "el")


def housekeeping_problems(blocks: DataFrame) -> DataFrame:
    """t, problem, n_rows: times given more than once, with equal or contradicting values, and values that are no pointing."""
    kinds = F.array(F.when(F.col("contradicts"), F.lit("contradicting values")).when(F.col("n_rows") > 1, F.lit("repeated")), F.when(F.col("wrong"), F.lit("no pointing")))
    return _housekeeping(blocks).select("t", F.explode(F.filter(kinds, lambda p: p.isNotNull())).alias("problem"), "n_rows")


def _housekeeping(blocks: DataFrame) -> DataFrame:
    """t, az, el, n_rows, contradicts, wrong: one row a time; its first values are those of equal rows."""
    fine = is_finite(F.col("az")) & is_finite(F.col("el")) & (F.col("az") >= 0) & (F.col("az") < 360) & (F.abs("el") <= 90)
    values = F.struct(F.col("az"), F.col("el"))
    rows = blocks.where("t is not null").groupBy("t").agg(F.min(values).alias("a"), F.max(values).alias("b"), F.count("*").alias("n_rows"), F.bool_or(~F.coalesce(fine, F.lit(False))).alias("wrong"))
    return rows.select("t", F.col("a.az").alias("az"), F.col("a.el").alias("el"), "n_rows", (F.col("a") != F.col("b")).alias("contradicts"), "wrong")


def align_pointing(hk: DataFrame, targets: DataFrame, factor: float = 1.5, bucket: float = 3600.0) -> DataFrame:
    """t, az, el at the target times; azimuth is unwrapped before and brought to [0, 360) after; gaps are errors."""
    one = hk.withColumn("stream", F.lit("hk"))
    az, el = align_streams(unwrap(one, "az", bucket=bucket), targets, "az", factor, bucket), align_streams(one, targets, "el", factor, bucket)
    out = az.join(el.select("t", "el", F.col("flags").alias("f2")), "t")
    if not out.where("flags <> 0 or f2 <> 0").isEmpty():
        raise ValueError("pointing is missing or has a gap")
    return out.select("t", F.pmod("az", F.lit(360.0)).alias("az"), "el")


def validate_files(files: DataFrame, rel: float = 1e-4) -> DataFrame:
    """file_idx, problem for files (file_idx, t_start, t_stop, rate) that overlap, run back or change rate."""
    w = Window.orderBy("file_idx")  # a row a file
    d = files.withColumns({"p": F.lag("t_stop").over(w), "r0": F.first("rate").over(w)})
    tests = [(F.col("t_stop") < F.col("t_start"), "ends before it starts"), (F.col("t_start") <= F.col("p"), "starts before the last one ends"), (F.abs(F.col("rate") - F.col("r0")) > rel * F.abs(F.col("r0")), "rate differs")]
    return d.select("file_idx", F.explode(F.filter(F.array(*(F.when(t, F.lit(m)) for t, m in tests)), lambda p: p.isNotNull())).alias("problem"))


def validate_times(df: DataFrame, bucket: float = 4096.0) -> DataFrame:
    """stream, problem: times that do not rise, azimuth or elevation out of range; bucket is a span of row numbers."""
    d = with_previous(bucketed(df, "row", bucket), ["stream"], "row", "t", "p")
    tests = [(F.col("t") <= F.col("p"), "times do not rise")]
    if "az" in df.columns:
        tests += [((F.col("az") < 0) | (F.col("az") >= 360), "azimuth out of range"), (F.abs("el") > 90, "elevation out of range")]
    return d.select("stream", F.explode(F.filter(F.array(*(F.when(t, F.lit(m)) for t, m in tests)), lambda p: p.isNotNull())).alias("problem")).distinct()
