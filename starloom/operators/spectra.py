"""Fourier filters and power spectra.

A filter or spectrum needs the whole of one detector's chunk at once, so samples are packed into one row a (chunk,
detector), whose size is a chunk's.  Tasks take Arrow batches of such rows of all detectors and chunks that they have, and
make one transform of each length in a batch; means, medians and floors over spectra are plain aggregations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import arrays
from starloom.operators.clean import KEYS

#: Bytes of an Arrow batch, so that a task's matrices stay small whatever the length of chunks.
BATCH_BYTES = 8 << 20


def _packed(tod: DataFrame, *columns: str) -> DataFrame:
    """obs_id, chunk_index, det_idx and rows, an array of (sample_idx, columns) in order of samples."""
    tod.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return tod.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("sample_idx", *columns))).alias("rows"))


def matrices(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of the lists of numbers; a null is NaN."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    first = np.cumsum(size) - size
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, flat[first[at, None] + np.arange(n)]


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    """A list column; None is null."""
    return pa.array(rows, pa.list_(pa.float64()))


def _filtered(tod: DataFrame, run: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Each (chunk, detector) with its signal replaced by run(signal in sample order); a sample that is missing still is an error."""
    others = [c for c in tod.columns if c not in (*KEYS, "sample_idx", "signal")]
    packed = _packed(tod, "signal", *others).select(*KEYS, "rows", F.col("rows.signal").alias("x"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[np.ndarray | None] = [None] * batch.num_rows
            for at, x in matrices(batch.column("x")):
                bad = np.flatnonzero(~np.isfinite(x).all(axis=1))
                if len(bad):
                    raise ValueError(f"a filter cannot run over the unfillable gap in { {k: batch.column(k)[int(at[bad[0]])].as_py() for k in KEYS} }")
                for i, y in zip(at, run(x), strict=True):
                    out[i] = y
            yield pa.record_batch([*(batch.column(k) for k in KEYS), batch.column("rows"), _lists(out)], names=[*KEYS, "rows", "y"])

    schema = T.StructType([*packed.schema.fields[:-1], T.StructField("y", T.ArrayType(T.DoubleType()))])
    each = packed.mapInArrow(apply, schema).select(*KEYS, F.explode(F.arrays_zip("rows", "y")).alias("s"))
    own = {"signal": F.col("s.y")} | {c: F.col("s.rows")[c] for c in ("sample_idx", *others)}
    return each.select(*(own.get(c, F.col(c)).alias(c) for c in tod.columns))


def highpass(tod: DataFrame, rate: float, cutoff: float) -> DataFrame:
    return tod if cutoff <= 0 else _filtered(tod, lambda x: arrays.highpass(x, rate, cutoff))


def notch(tod: DataFrame, rate: float, freq: float, harmonics: int = 1, width: float = 1.0) -> DataFrame:
    return tod if freq <= 0 else _filtered(tod, lambda x: arrays.notch(x, rate, freq, harmonics, width))


def periodogram(tod: DataFrame, rate: float) -> DataFrame:
    """obs_id, chunk_index, det_idx, n, bin, freq_hz, power; a chunk with a missing sample, or of one sample, has no spectrum."""
    packed = _packed(tod, "signal").select(*KEYS, F.col("rows.signal").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            power: list[np.ndarray | None] = [None] * batch.num_rows
            for at, x in matrices(batch.column("x")):
                whole = np.isfinite(x).all(axis=1)
                if x.shape[1] > 1 and whole.any():
                    for i, p in zip(at[whole], arrays.periodogram(x[whole], rate), strict=True):
                        power[i] = p
            yield pa.record_batch([*(batch.column(k) for k in KEYS), batch.column("x").value_lengths().cast(pa.int64()), _lists(power)], names=[*KEYS, "n", "power"])

    got = packed.mapInArrow(run, "obs_id string, chunk_index long, det_idx int, n long, power array<double>").where("power is not null")
    return got.select(*KEYS, "n", F.posexplode("power").alias("bin", "power")).select(*KEYS, "n", "bin", (F.col("bin") * F.lit(rate) / F.col("n")).alias("freq_hz"), "power")


def mean_psd(spectra: DataFrame) -> DataFrame:
    """det_idx, bin, freq_hz, power: mean over chunks as long as the first; infinite spectra are left out."""
    first = spectra.agg(F.min_by("n", F.struct("obs_id", "chunk_index")).alias("__n"))
    same = spectra.crossJoin(F.broadcast(first)).where("n = __n and power < double('Infinity')")
    return same.groupBy("det_idx", "bin").agg(F.first("freq_hz").alias("freq_hz"), F.avg("power").alias("power"))


def white_noise_floor(psd: DataFrame, rate: float, lo: float = 0.4, hi: float = 0.9) -> DataFrame:
    """det_idx, wnf: median power between two shares of the Nyquist frequency."""
    nyq = rate / 2
    return psd.where((F.col("freq_hz") > lo * nyq) & (F.col("freq_hz") < hi * nyq)).groupBy("det_idx").agg(F.expr("percentile(power, 0.5)").alias("wnf"))


def psd_anomalies(psd: DataFrame, sigma: float = 5.0, width: int = 21, skip_hz: float = 0.05) -> DataFrame:
    """freq_hz, power_db (over the level round it) of narrow features of the detectors' median spectrum, strongest first.

    The level is the median of width neighbouring bins of the logarithm, where the end bins stand for those beyond
    them; neighbouring bins that stand out are one feature.  No features if there are fewer bins than
    width or the residuals do not spread.  Windows are over one row a bin of a chunk's spectrum.
    """
    half, last = width // 2, Window.unboundedFollowing
    by, whole = Window.partitionBy().orderBy("freq_hz"), Window.partitionBy()
    bins = psd.where(F.col("freq_hz") >= skip_hz).groupBy("freq_hz").agg(F.expr("percentile(power, 0.5)").alias("power"))
    logs = bins.withColumns({"log": F.when(F.col("power") > 0, F.log10("power")), "i": F.row_number().over(by) - 1, "n": F.count("*").over(whole)}).where(F.col("n") >= width)
    usual = logs.withColumn("y", F.coalesce("log", F.expr("percentile(log, 0.5)").over(whole)))
    around = F.collect_list("y").over(by.rowsBetween(-half, half))
    ends = {"first": F.first("y").over(by.rowsBetween(Window.unboundedPreceding, last)), "last": F.last("y").over(by.rowsBetween(Window.unboundedPreceding, last))}
    padded = F.concat(F.array_repeat("first", F.greatest(F.lit(0), half - F.col("i"))), F.col("around"), F.array_repeat("last", F.greatest(F.lit(0), half - (F.col("n") - 1 - F.col("i")).cast("int"))))
    level = usual.withColumns({"around": around, **ends}).withColumn("over", F.col("log") - F.array_sort(padded)[half])
    centred = level.withColumn("off", F.abs(F.col("over") - F.expr("percentile(over, 0.5)").over(whole)))
    hot = centred.withColumn("mad", F.expr("percentile(off, 0.5)").over(whole)).where((F.col("mad") > 0) & (F.col("over") > sigma * 1.4826 * F.col("mad")))
    island = hot.withColumn("island", F.col("i") - F.row_number().over(by))
    peak = island.groupBy("island").agg(F.max(F.struct("over", (-F.col("i")).alias("at"), "freq_hz")).alias("p"))
    return peak.select(F.col("p.freq_hz").alias("freq_hz"), (10 * F.col("p.over")).alias("power_db")).orderBy(F.desc("power_db"))


def psd_quartiles(psd: DataFrame) -> DataFrame:
    q = F.expr("percentile(power, array(0.25, 0.5, 0.75))")
    return psd.groupBy("bin").agg(F.first("freq_hz").alias("freq_hz"), q.alias("q")).select("bin", "freq_hz", F.col("q")[0].alias("p25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("p75"))


def psd_before_after(tod: DataFrame, rate: float, nperseg: int) -> DataFrame:
    """det_idx, bin, freq_hz, before, after, segments: mean Welch spectra of columns before and after.

    Segments of nperseg samples overlap by half inside a chunk; one with a flagged or missing sample is left out for
    its detector.  A row (chunk, detector) hands on the sums of its segments.
    """
    step = max(1, nperseg // 2)
    rows = _packed(tod, "flags", "before", "after")
    good = F.transform("rows", lambda r: F.when((r["flags"] == 0) & r["before"].isNotNull() & r["after"].isNotNull(), 1.0).otherwise(0.0))
    packed = rows.select("det_idx", good.alias("good"), F.col("rows.before").alias("before"), F.col("rows.after").alias("after"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, bins = batch.num_rows, nperseg // 2 + 1
            count, sums = np.zeros(m, dtype=np.int64), np.zeros((2, m, bins))
            for (at, good), (_, a), (_, b) in zip(*(matrices(batch.column(c)) for c in ("good", "before", "after")), strict=True):
                for start in range(0, good.shape[1] - nperseg + 1, step):
                    part = slice(start, start + nperseg)
                    use = good[:, part].all(axis=1)
                    if use.any():
                        count[at[use]] += 1
                        sums[0, at[use]] += arrays.welch_segment(a[use, part], rate)
                        sums[1, at[use]] += arrays.welch_segment(b[use, part], rate)
            has = np.flatnonzero(count)
            yield pa.record_batch([batch.column("det_idx").take(pa.array(has)), pa.array(count[has]), _lists(list(sums[0, has])), _lists(list(sums[1, has]))], names=["det_idx", "n", "a", "b"])

    got = packed.mapInArrow(run, "det_idx int, n long, a array<double>, b array<double>")
    each = got.select("det_idx", "n", F.posexplode(F.arrays_zip("a", "b")).alias("bin", "s")).groupBy("det_idx", "bin").agg(F.sum("s.a").alias("a"), F.sum("s.b").alias("b"), F.sum("n").alias("segments"))
    return each.select("det_idx", "bin", (F.col("bin") * F.lit(rate) / nperseg).alias("freq_hz"), (F.col("a") / F.col("segments")).alias("before"), (F.col("b") / F.col("segments")).alias("after"), "segments")
