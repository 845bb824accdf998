"""Queries on selection, detector state, maps, nulls and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.jobs.base import EVENTS_GRID, LINES, LINES_GRID, ON_GRID, PX, STATE, TOD, query, r, rounded
from starloom.operators import binning, chunks, detectors, nulls, quality
from starloom.operators import common_mode as cm
from starloom.sources.adapters import RATE, boresight, pointed, read, tod_from_events, tod_from_lineitem


def tod_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pointed(tod_from_events(spark, sf_dir))


def state_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = read(spark, sf_dir, "lineitem")
    k = F.col("l_suppkey")
    wnf = F.when(k % 23 != 5, F.var_pop("l_quantity") * F.pow(F.lit(10.0), (k % 7) / 4.0))
    return i.groupBy("l_suppkey").agg((F.stddev_pop("l_extendedprice") * (1 + k % 17)).alias("noise"), wnf.alias("wnf")).select(k.alias("det_idx"), F.format_string("s%05d", k).alias("det"), "noise", "wnf")


EVENT_MAP = f"""
px AS (SELECT *, {PX} FROM tod WHERE flags = 0 AND signal IS NOT NULL),
m AS (SELECT iy, ix, sum(signal) AS data, CAST(count(*) AS DOUBLE) AS hits, sum(signal * signal) AS sumsq, count(*) AS n_samples FROM px WHERE {ON_GRID} GROUP BY iy, ix),
fm AS (SELECT *, data / hits AS value, sqrt(greatest(sumsq / hits - (data / hits) * (data / hits), 0) / hits) AS noise FROM m)"""
FINAL = "round(data, 6) + 0.0 AS data, hits, n_samples, round(value, 6) + 0.0 AS value, round(noise, 5) + 0.0 AS noise"


def _final(m: DataFrame) -> DataFrame:
    return m.select("iy", "ix", r("data").alias("data"), "hits", "n_samples", r("value").alias("value"), r("noise", 5).alias("noise"))


@query(f"WITH {TOD}, {EVENT_MAP} SELECT iy, ix, {FINAL} FROM fm")
def map_events(spark, sf_dir):
    return _final(binning.finish_map(binning.bin_map(tod_of(spark, sf_dir), EVENTS_GRID)))


@query(f"""WITH {LINES}, m AS (SELECT iy, ix, sum(signal) AS data, CAST(count(*) AS DOUBLE) AS hits, sum(signal * signal) AS sumsq, count(*) AS n_samples FROM li WHERE flags = 0 GROUP BY iy, ix)
SELECT iy, ix, round(data, 2) + 0.0 AS data, hits, n_samples, round(data / hits, 4) + 0.0 AS value, round(sqrt(greatest(sumsq / hits - (data / hits) * (data / hits), 0) / hits), 3) + 0.0 AS noise FROM m""")
def map_lineitem(spark, sf_dir):
    m = binning.finish_map(binning.bin_map(tod_from_lineitem(spark, sf_dir), LINES_GRID))
    return m.select("iy", "ix", r("data", 2).alias("data"), "hits", "n_samples", r("value", 4).alias("value"), r("noise", 3).alias("noise"))


@query(f"""WITH {LINES}, {STATE}, w AS (SELECT det_idx, CASE WHEN wnf > 0 THEN 1 / wnf END AS w FROM state), md AS (SELECT median(w) AS m FROM w),
weights AS (SELECT det_idx, least(coalesce(w, m), 5 * m) AS weight FROM w, md)
SELECT iy, ix, count(*) AS n_samples, round(sum(weight), 6) + 0.0 AS hits, round(sum(weight * signal) / sum(weight), 4) + 0.0 AS value FROM li JOIN weights USING (det_idx) WHERE flags = 0 GROUP BY iy, ix""")
def map_lineitem_weighted(spark, sf_dir):
    w = detectors.detector_weights(state_of(spark, sf_dir))
    m = binning.finish_map(binning.bin_map(tod_from_lineitem(spark, sf_dir), LINES_GRID, w))
    return m.select("iy", "ix", "n_samples", r("hits").alias("hits"), r("value", 4).alias("value"))


@query(f"WITH {TOD} SELECT 'ev' AS obs_id, sample_idx // 50 AS chunk_index, count(DISTINCT t) AS n_samples, min(t) AS t_start, min(t) + count(DISTINCT t) * 1800.0 AS t_stop FROM tod GROUP BY sample_idx // 50")
def chunks_fixed(spark, sf_dir):
    t = tod_of(spark, sf_dir).drop("chunk_index")
    samples = t.select("obs_id", F.lit(0).alias("file_idx"), "sample_idx", "t").distinct()
    c = chunks.assign_chunks(samples, 90_000, RATE)
    return rounded(chunks.chunk_table(c, RATE), 3)


@query(f"""WITH {TOD}, s AS (SELECT DISTINCT sample_idx, sample_idx // 400 AS f, t FROM tod), n AS (SELECT f, CAST(ceil(count(*) / 50.0) AS BIGINT) AS k FROM s GROUP BY f),
b AS (SELECT f, coalesce(sum(k) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM n)
SELECT 'ev' AS obs_id, CAST(b + (sample_idx % 400) // 50 AS BIGINT) AS chunk_index, count(*) AS n_samples, min(t) AS t_start, max(t) AS t_stop FROM s JOIN b USING (f) GROUP BY 2""")
def chunks_per_file(spark, sf_dir):
    samples = tod_of(spark, sf_dir).select("obs_id", F.floor(F.col("sample_idx") / 400).cast("int").alias("file_idx"), "sample_idx", "t").distinct()
    return rounded(chunks.chunk_table(chunks.assign_chunks(samples, 90_000, RATE, per_file=True), RATE, last_sample=True), 3)


@query(f"WITH {TOD} SELECT 'ev' AS obs_id, sample_idx // 400 AS chunk_index, count(DISTINCT sample_idx) AS n_samples FROM tod GROUP BY sample_idx // 400")
def chunks_by_frame(spark, sf_dir):
    samples = tod_of(spark, sf_dir).select("obs_id", F.floor(F.col("sample_idx") / 400).cast("int").alias("file_idx"), "sample_idx").distinct()
    return chunks.assign_chunks(samples, 0, RATE).groupBy("obs_id", "chunk_index").agg(F.count("*").alias("n_samples"))


WINDOWED = "SELECT * FROM tod WHERE (chunk_index + 1) * 48 * 1800 > 200000 AND chunk_index * 48 * 1800 < 200000 + 900000"


@query(f"WITH {TOD}, w AS ({WINDOWED}) SELECT chunk_index, count(*) AS n, count(signal) AS filled FROM w GROUP BY chunk_index")
def time_window(spark, sf_dir):
    t = tod_of(spark, sf_dir)
    return chunks.select_time_window(t, chunks.chunk_table(t, RATE), 200_000, 900_000).groupBy("chunk_index").agg(F.count("*").alias("n"), F.count("signal").alias("filled"))


@query(f"WITH {TOD}, w AS ({WINDOWED}), k AS (SELECT *, dense_rank() OVER (ORDER BY sample_idx) - 1 AS i FROM w) SELECT det, sample_idx, round(signal, 6) + 0.0 AS signal FROM k WHERE i % 7 = 0")
def every_seventh_sample(spark, sf_dir):
    t = tod_of(spark, sf_dir)
    kept = chunks.select_time_window(t, chunks.chunk_table(t, RATE), 200_000, 900_000)
    return chunks.subsample(kept, 7).select("det", "sample_idx", r("signal").alias("signal"))


@query(f"WITH {TOD} SELECT 'ev' AS obs_id, min(t) AS t_start, max(t) AS t_stop, max(t) - min(t) AS duration, count(DISTINCT det_idx) AS detectors, count(DISTINCT chunk_index) AS chunks, round(1439 / (max(t) - min(t)), 9) AS rate FROM tod")
def observation_info(spark, sf_dir):
    return rounded(detectors.obs_info(tod_of(spark, sf_dir)), 9)


@query(f"WITH {TOD} SELECT 'ev' AS obs_id, round(count(DISTINCT t) / (max(t) - min(t)), 9) AS rate FROM tod WHERE sample_idx < 700")
def first_file_rate(spark, sf_dir):
    return rounded(chunks.sample_rate(tod_of(spark, sf_dir).withColumn("file_idx", F.floor(F.col("sample_idx") / 700))), 9)


@query(f"""WITH {TOD}, f AS (SELECT * REPLACE (CASE WHEN chunk_index % 7 = 3 OR flags <> 0 THEN 4 ELSE 0 END AS flags) FROM tod)
SELECT chunk_index, count(*) AS n, CAST(sum(CASE WHEN flags <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS flagged FROM f GROUP BY chunk_index HAVING NOT bool_and(flags <> 0)""")
def unflagged_chunks(spark, sf_dir):
    t = tod_of(spark, sf_dir).withColumn("flags", F.when((F.col("chunk_index") % 7 == 3) | (F.col("flags") != 0), 4).otherwise(0))
    return chunks.drop_fully_flagged(t).groupBy("chunk_index").agg(F.count("*").alias("n"), F.count_if(F.col("flags") != 0).alias("flagged"))


@query(f"""WITH {TOD}, f AS (SELECT * REPLACE (CASE WHEN chunk_index = 0 OR flags <> 0 THEN 4 ELSE 0 END AS flags) FROM tod),
c AS (SELECT chunk_index, count(*) AS n, sum(CASE WHEN flags <> 0 THEN 1 ELSE 0 END) AS bad, count(DISTINCT sample_idx) AS len FROM f GROUP BY chunk_index)
SELECT CAST(sum(n) AS BIGINT) AS samples, CAST(sum(bad) AS BIGINT) AS flagged, count(*) AS chunks, CAST(sum(CASE WHEN n = bad THEN 1 ELSE 0 END) AS BIGINT) AS chunks_flagged,
CAST(sum(CASE WHEN len = (SELECT arg_min(len, chunk_index) FROM c WHERE bad < n) THEN n ELSE 0 END) AS BIGINT) AS psd_samples FROM c""")
def preparation_counts(spark, sf_dir):
    t = tod_of(spark, sf_dir).withColumn("flags", F.when((F.col("chunk_index") == 0) | (F.col("flags") != 0), 4).otherwise(0))
    return detectors.prep_stats(t)


@query("WITH d AS (SELECT s_suppkey AS det_idx, s_name AS det FROM supplier), n AS (SELECT count(*) AS m FROM d) SELECT det_idx, det FROM d WHERE det_idx IN (SELECT CAST(floor(i * (m - 1) / 15.0) AS BIGINT) FROM n, (SELECT range AS i FROM range(16)))")
def evenly_spaced_detectors(spark, sf_dir):
    return detectors.select_detectors(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("det_idx"), F.col("s_name").alias("det")), n=16)


@query("SELECT s_suppkey AS det_idx, s_name AS det FROM supplier WHERE s_suppkey IN (1, 3, 7)")
def named_detectors(spark, sf_dir):
    d = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("det_idx"), F.col("s_name").alias("det"))
    return detectors.select_detectors(d, names=["Supplier#000000001", "Supplier#000000003", "Supplier#000000007", "none"])


@query(f"""WITH {TOD}, p AS (SELECT *, row_number() OVER (PARTITION BY chunk_index, det_idx ORDER BY sample_idx) - 1 AS i FROM tod), m AS (SELECT chunk_index, det_idx, median(signal) AS m FROM p GROUP BY ALL)
SELECT det_idx, round(avg(m), 6) + 0.0 AS "offset" FROM m GROUP BY det_idx""")
def baseline_offsets(spark, sf_dir):
    return rounded(detectors.detector_offsets(tod_of(spark, sf_dir)))


OFFSETS = "m AS (SELECT chunk_index, det_idx, median(signal) AS m FROM tod GROUP BY ALL), o AS (SELECT det_idx, avg(m) AS o FROM m GROUP BY det_idx)"


@query(f"WITH {TOD}, {OFFSETS} SELECT det_idx, chunk_index, round(avg(signal - o), 6) + 0.0 AS mean FROM tod JOIN o USING (det_idx) GROUP BY det_idx, chunk_index")
def without_baseline(spark, sf_dir):
    t = tod_of(spark, sf_dir)
    return detectors.subtract_offset(t, detectors.detector_offsets(t)).groupBy("det_idx", "chunk_index").agg(r(F.avg("signal")).alias("mean"))


@query(f"WITH {TOD} SELECT det, sample_idx, round(signal, 6) + 0.0 AS signal FROM tod WHERE t - 1704067200 >= 360000 AND t - 1704067200 < 396000")
def crossing_window(spark, sf_dir):
    return chunks.time_slice(tod_of(spark, sf_dir), 360_000, 396_000).select("det", "sample_idx", r("signal").alias("signal"))


@query(f"""WITH {TOD}, d AS (SELECT det_idx, CASE WHEN flags = 0 AND lag(flags) OVER w = 0 THEN signal - lag(signal) OVER w END AS d FROM tod WINDOW w AS (PARTITION BY chunk_index, det_idx ORDER BY sample_idx))
SELECT det_idx, round(stddev_pop(d) / sqrt(2), 6) + 0.0 AS noise FROM d GROUP BY det_idx""")
def difference_noise(spark, sf_dir):
    return rounded(detectors.detector_noise(tod_of(spark, sf_dir)))


@query(f"WITH {TOD}, s AS (SELECT DISTINCT chunk_index, sample_idx, ra_bore, dec_bore FROM tod WHERE chunk_index % 7 <> 3) SELECT round(avg(ra_bore), 8) AS ra, round(avg(dec_bore), 8) AS dec FROM s")
def mean_boresight_position(spark, sf_dir):
    t = tod_of(spark, sf_dir).withColumn("flags", F.when(F.col("chunk_index") % 7 == 3, 4).otherwise(0))
    return rounded(detectors.mean_boresight(boresight(spark, sf_dir), chunks.fully_flagged(t)), 8)


@query(f"WITH {TOD} SELECT det_idx, round(min(least(ra, ra_bore)), 8) AS ra_min, round(max(greatest(ra, ra_bore)), 8) AS ra_max, round(min(dec), 8) AS dec_min, round(max(dec), 8) AS dec_max FROM tod WHERE flags = 0 GROUP BY det_idx")
def pointing_ranges(spark, sf_dir):
    return rounded(detectors.pointing_extent(tod_of(spark, sf_dir)), 8)


@query(f"WITH {STATE}, c AS (SELECT 1.7 * median(noise) AS c FROM state) SELECT det_idx, 'noise' AS reason, round(c, 4) + 0.0 AS cutoff FROM state, c WHERE noise > c")
def noisy_detectors(spark, sf_dir):
    return rounded(detectors.exclude_noisy(state_of(spark, sf_dir), 1.7), 4)


WNF_CUT = "l AS (SELECT CASE WHEN wnf > 0 THEN log10(wnf) END AS l FROM state), cw AS (SELECT power(10, median(l) + 1.2 * stddev_pop(l)) AS cw FROM l)"


@query(f"WITH {STATE}, {WNF_CUT} SELECT det_idx, 'wnf' AS reason, round(cw, 4) + 0.0 AS cutoff FROM state, cw WHERE wnf IS NULL OR wnf <= 0 OR wnf > cw")
def floor_excluded_detectors(spark, sf_dir):
    return rounded(detectors.exclude_wnf(state_of(spark, sf_dir), 1.2), 4)


@query(f"""WITH {STATE}, {WNF_CUT}, c AS (SELECT 1.7 * median(noise) AS c FROM state), x AS (SELECT det_idx, 'noise' AS reason FROM state, c WHERE noise > c
UNION ALL SELECT det_idx, 'wnf' FROM state, cw WHERE wnf IS NULL OR wnf <= 0 OR wnf > cw UNION ALL SELECT det_idx, 'manual' FROM state WHERE det = 's00002' OR det_idx = 4)
SELECT det_idx, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons FROM x GROUP BY det_idx""")
def excluded_detectors(spark, sf_dir):
    x = detectors.exclude_detectors(state_of(spark, sf_dir), ["s00002"], [4], 1.7, 1.2)
    return x.select("det_idx", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {LINES}, {STATE}, c AS (SELECT 1.7 * median(noise) AS c FROM state) SELECT det_idx, count(*) AS n, round(sum(signal), 2) + 0.0 AS total FROM li WHERE det_idx NOT IN (SELECT det_idx FROM state, c WHERE noise > c) GROUP BY det_idx")
def kept_detectors(spark, sf_dir):
    t = detectors.keep_detectors(tod_from_lineitem(spark, sf_dir), detectors.exclude_noisy(state_of(spark, sf_dir), 1.7))
    return t.groupBy("det_idx").agg(F.count("*").alias("n"), r(F.sum("signal"), 2).alias("total"))


WEIGHTS = "w AS (SELECT det_idx, CASE WHEN wnf > 0 THEN 1 / wnf END AS w FROM state), md AS (SELECT median(w) AS m FROM w), weights AS (SELECT det_idx, least(coalesce(w, m), 2 * m) AS weight FROM w, md)"


@query(f"WITH {STATE}, {WEIGHTS} SELECT det_idx, round(weight, 9) + 0.0 AS weight FROM weights")
def inverse_variance_weights(spark, sf_dir):
    return rounded(detectors.detector_weights(state_of(spark, sf_dir), 2.0), 9)


@query(f"WITH {STATE}, {WEIGHTS} SELECT round(min(weight), 9) AS w_min, round(median(weight), 9) AS w_median, round(max(weight), 9) AS w_max FROM weights")
def weights_summary(spark, sf_dir):
    return rounded(detectors.weight_summary(detectors.detector_weights(state_of(spark, sf_dir), 2.0)), 9)


@query(f"""WITH {TOD}, px AS (SELECT *, {PX}, CASE det_idx WHEN 1 THEN 0 WHEN 4 THEN 0 ELSE 1.0 + det_idx END AS w, signal - 5 AS y, sample_idx % 13 <> 2 AS plain, sample_idx % 17 <> 3 AS sound FROM tod WHERE flags = 0 AND signal IS NOT NULL)
SELECT iy, ix, round(sum(CASE WHEN plain THEN signal END), 6) + 0.0 AS naive_data, count(*) FILTER (plain) AS naive_hits, round(sum(CASE WHEN sound THEN w * y ELSE 0 END), 6) + 0.0 AS data, round(sum(CASE WHEN sound THEN w ELSE 0 END), 6) + 0.0 AS hits,
round(sum(CASE WHEN sound THEN w * y * y ELSE 0 END), 5) + 0.0 AS sumsq FROM px WHERE {ON_GRID} AND (plain OR sound) GROUP BY iy, ix""")
def naive_and_weighted_map(spark, sf_dir):
    """Detector 1 weighs 0 and detector 4 has no weight, so both are in the plain map only; NaN in either column leaves the other alone."""
    t = tod_of(spark, sf_dir)
    w = t.select("det_idx").distinct().where("det_idx <> 4").select("det_idx", F.when(F.col("det_idx") == 1, 0.0).otherwise(F.lit(1.0) + F.col("det_idx")).alias("weight"))
    nan = lambda c, n, k: F.when(F.col("signal").isNotNull() & (F.col("sample_idx") % n == k), F.lit(float("nan"))).otherwise(c)
    both = t.withColumns({"signal_naive": nan(F.col("signal"), 13, 2), "signal": nan(F.col("signal") - 5, 17, 3)})
    m = binning.bin_map_pair(both, EVENTS_GRID, w)
    return m.select("iy", "ix", r("naive_data").alias("naive_data"), "naive_hits", r("data").alias("data"), r("hits").alias("hits"), r("sumsq", 5).alias("sumsq"))


@query(f"""WITH {TOD}, px AS (SELECT *, CASE WHEN ra < 9.88 THEN -1 WHEN ra < 10.13 THEN 0 WHEN ra < 10.53 THEN 1 WHEN ra < 10.88 THEN 2 ELSE 3 END AS ix,
CASE WHEN dec < 19.98 THEN -1 WHEN dec < 20.13 THEN 0 WHEN dec < 20.57 THEN 1 ELSE 2 END AS iy FROM tod WHERE flags = 0 AND signal IS NOT NULL)
SELECT iy, ix, round(sum(signal), 6) + 0.0 AS data, count(*) AS n_samples FROM px WHERE ix BETWEEN 0 AND 2 AND iy BETWEEN 0 AND 1 GROUP BY iy, ix""")
def irregular_edges_map(spark, sf_dir):
    m = binning.bin_edges(tod_of(spark, sf_dir), [9.88, 10.13, 10.53, 10.88], [19.98, 20.13, 20.57])
    return m.select("iy", "ix", r("data").alias("data"), "n_samples")


@query(f"WITH {LINES} SELECT det_idx, iy, ix, round(sum(signal), 2) + 0.0 AS data, CAST(count(*) AS DOUBLE) AS hits FROM li WHERE flags = 0 GROUP BY det_idx, iy, ix")
def per_detector_maps(spark, sf_dir):
    m = binning.bin_per_detector(tod_from_lineitem(spark, sf_dir), LINES_GRID)
    return m.select("det_idx", "iy", "ix", r("data", 2).alias("data"), "hits")


def _null_sql(half: str) -> str:
    return f"""h AS (SELECT *, {PX}, {half} AS half FROM tod WHERE flags = 0 AND signal IS NOT NULL), s AS (SELECT iy, ix, sum(CASE WHEN half = 0 THEN signal END) AS d0, CAST(sum(CASE WHEN half = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS h0,
sum(CASE WHEN half = 1 THEN signal END) AS d1, CAST(sum(CASE WHEN half = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS h1 FROM h WHERE {ON_GRID} GROUP BY iy, ix),
nl AS (SELECT iy, ix, CASE WHEN h0 > 0 AND h1 > 0 THEN (d0 / h0 - d1 / h1) / 2 END AS value, h0 AS hits0, h1 AS hits1 FROM s)"""


@query(f"WITH {TOD}, {_null_sql('chunk_index % 2')} SELECT iy, ix, round(value, 6) + 0.0 AS value, hits0, hits1 FROM nl")
def time_null_map(spark, sf_dir):
    return rounded(nulls.time_null(tod_of(spark, sf_dir), EVENTS_GRID))


HALVES = "hv AS (SELECT det_idx, CASE WHEN row_number() OVER (ORDER BY md5('0:' || det_idx), det_idx) <= floor((SELECT count(*) FROM dets) / 2) THEN 0 ELSE 1 END AS det_half FROM dets)"


@query(f"WITH {TOD}, {HALVES}, {_null_sql('(SELECT det_half FROM hv WHERE hv.det_idx = tod.det_idx)')} SELECT iy, ix, round(value, 6) + 0.0 AS value, hits0, hits1 FROM nl")
def detector_null_map(spark, sf_dir):
    t = tod_of(spark, sf_dir)
    return rounded(nulls.detector_null(t, EVENTS_GRID, nulls.detector_halves(t)))


@query(f"""WITH {TOD}, {HALVES}, px AS (SELECT tod.*, det_half, CAST(chunk_index % 2 AS INTEGER) AS time_half, {PX} FROM tod JOIN hv USING (det_idx) WHERE flags = 0 AND signal IS NOT NULL)
SELECT iy, ix, time_half, det_half, round(sum(signal), 6) + 0.0 AS data, CAST(count(*) AS DOUBLE) AS hits FROM px WHERE {ON_GRID} GROUP BY GROUPING SETS ((iy, ix), (iy, ix, time_half), (iy, ix, det_half))""")
def all_map_splits(spark, sf_dir):
    t = tod_of(spark, sf_dir)
    return rounded(nulls.all_splits(t, EVENTS_GRID, nulls.detector_halves(t)).select("iy", "ix", "time_half", "det_half", "data", "hits"))


@query(f"WITH {TOD}, {_null_sql('chunk_index % 2')} SELECT CAST(sum(CASE WHEN hits0 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS covered0, CAST(sum(CASE WHEN hits1 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS covered1, count(value) AS overlap, count(value) = 0 AS warn FROM nl")
def null_overlap(spark, sf_dir):
    return nulls.null_report(nulls.time_null(tod_of(spark, sf_dir), EVENTS_GRID))


@query(f"""WITH {TOD}, {EVENT_MAP}, p AS (SELECT value, iy, ix FROM fm ORDER BY value DESC, iy, ix LIMIT 1)
SELECT (SELECT count(*) FROM fm WHERE hits > 0) AS covered, 288 AS total, round((SELECT count(*) FROM fm) / 288.0, 6) AS fraction, (SELECT count(value) FROM fm) AS finite, round(p.value, 6) AS peak,
round(9.875 + (p.ix + 0.5) * 0.05, 6) AS peak_ra, round(19.975 + (p.iy + 0.5) * 0.05, 6) AS peak_dec, (SELECT round(median(value), 6) FROM fm) AS median, (SELECT round(quantile_cont(value, 0.05), 6) FROM fm) AS p05, (SELECT round(quantile_cont(value, 0.95), 6) FROM fm) AS p95 FROM p""")
def map_quality_report(spark, sf_dir):
    return rounded(quality.map_quality(binning.finish_map(binning.bin_map(tod_of(spark, sf_dir), EVENTS_GRID)), EVENTS_GRID))


#: Three maps of one field: all samples, those of even chunks, and those under a value.
STAGES = f"""
s0 AS (SELECT *, {PX} FROM tod WHERE flags = 0 AND signal IS NOT NULL),
maps AS (SELECT 0 AS stage, 'even' AS name, iy, ix, avg(signal) AS value FROM s0 WHERE {ON_GRID} AND chunk_index % 2 = 0 GROUP BY iy, ix
UNION ALL SELECT 1, 'low', iy, ix, avg(signal) FROM s0 WHERE {ON_GRID} AND signal < 150 GROUP BY iy, ix UNION ALL SELECT 2, 'all', iy, ix, avg(signal) FROM s0 WHERE {ON_GRID} GROUP BY iy, ix)"""


@query(f"""WITH {TOD}, {STAGES}, f AS (SELECT iy, ix, value < (SELECT median(value) FROM maps WHERE name = 'all') AS off FROM maps WHERE name = 'all'),
b AS (SELECT stage, name, max(value) AS peak, sqrt(avg(CASE WHEN off THEN value * value END)) AS rms_off, sqrt(avg(CASE WHEN NOT off THEN value * value END)) AS rms_on FROM maps LEFT JOIN f USING (iy, ix) GROUP BY stage, name),
d AS (SELECT a.stage, sqrt(avg((a.value - p.value) * (a.value - p.value))) AS rms_diff FROM maps a JOIN maps p ON a.iy = p.iy AND a.ix = p.ix AND a.stage = p.stage + 1 GROUP BY a.stage)
SELECT stage, name, round(peak, 6) AS peak, round(rms_off, 6) AS rms_off, round(rms_on, 6) AS rms_on, round(rms_diff, 6) AS rms_diff FROM b LEFT JOIN d USING (stage)""")
def map_convergence(spark, sf_dir):
    t = tod_of(spark, sf_dir)
    of = lambda k, name, df: binning.finish_map(binning.bin_map(df, EVENTS_GRID)).select(F.lit(k).alias("stage"), F.lit(name).alias("name"), "iy", "ix", "value")
    maps = of(0, "even", t.where("chunk_index % 2 = 0")).unionByName(of(1, "low", t.where("signal < 150"))).unionByName(of(2, "all", t))
    return rounded(quality.convergence(maps, "all"))


@query(f"WITH {TOD}, {STAGES} SELECT a.iy, a.ix, round(a.value - b.value, 6) + 0.0 AS diff FROM maps a JOIN maps b USING (iy, ix) WHERE a.stage = 2 AND b.stage = 0")
def map_difference(spark, sf_dir):
    t = tod_of(spark, sf_dir)
    a, b = (binning.finish_map(binning.bin_map(df, EVENTS_GRID)) for df in (t, t.where("chunk_index % 2 = 0")))
    return rounded(quality.map_diff(a, b))


CENTROIDS = f"""
dm AS (SELECT det_idx, iy, ix, sum(signal) / count(*) AS value FROM li WHERE flags = 0 GROUP BY det_idx, iy, ix), md AS (SELECT det_idx, median(value) AS m FROM dm GROUP BY det_idx),
rm AS (SELECT det_idx, sqrt(avg(value * value)) AS rms_off FROM dm JOIN md USING (det_idx) WHERE value < m GROUP BY det_idx),
pk AS (SELECT det_idx, value AS peak, iy, ix FROM dm QUALIFY row_number() OVER (PARTITION BY det_idx ORDER BY value DESC, iy, ix) = 1),
ce AS (SELECT det_idx, peak, iy, ix, 10.0 + (ix + 0.5) * 0.05 AS ra, 20.0 + (iy + 0.5) * 0.05 AS dec, rms_off, peak / rms_off AS snr FROM pk LEFT JOIN rm USING (det_idx))"""


@query(f"WITH {LINES}, {CENTROIDS} SELECT det_idx, round(peak, 4) AS peak, iy, ix, round(ra, 6) AS ra, round(dec, 6) AS dec, round(rms_off, 4) AS rms_off, round(snr, 5) AS snr FROM ce")
def centroids_per_detector(spark, sf_dir):
    c = quality.detector_centroids(binning.bin_per_detector(tod_from_lineitem(spark, sf_dir), LINES_GRID), LINES_GRID)
    return c.select("det_idx", r("peak", 4).alias("peak"), "iy", "ix", r("ra").alias("ra"), r("dec").alias("dec"), r("rms_off", 4).alias("rms_off"), r("snr", 5).alias("snr"))


@query(f"WITH {LINES}, {CENTROIDS} SELECT det_idx, round(rms_off / (SELECT median(rms_off) FROM ce), 5) AS ratio FROM ce WHERE rms_off / (SELECT median(rms_off) FROM ce) > 1.03")
def noisy_map_detectors(spark, sf_dir):
    c = quality.detector_centroids(binning.bin_per_detector(tod_from_lineitem(spark, sf_dir), LINES_GRID), LINES_GRID)
    return quality.flag_detectors(c, 1.03).select("det_idx", r("ratio", 5).alias("ratio"))


@query(f"""WITH {TOD}, e AS (SELECT min(least(ra, ra_bore)) AS a, max(greatest(ra, ra_bore)) AS b, min(dec) AS c, max(dec) AS d FROM tod WHERE flags = 0),
h AS (SELECT CAST(ceil(round(greatest(abs(a - 10.44), abs(b - 10.44)) / 0.07, 9)) AS INTEGER) + 1 AS hx, CAST(ceil(round(greatest(abs(c - 20.23), abs(d - 20.23)) / 0.07, 9)) AS INTEGER) + 1 AS hy FROM e)
SELECT round(10.44 - hx * 0.07, 6) AS ra_lo, round(20.23 - hy * 0.07, 6) AS dec_lo, 2 * hx AS nx, 2 * hy AS ny FROM h""")
def automatic_grid(spark, sf_dir):
    """One row; of nulls where all samples are flagged."""
    g = binning.grid_round(detectors.pointing_extent(tod_of(spark, sf_dir)), 10.44, 20.23, 0.07)
    return spark.createDataFrame([(round(g.ra_lo, 6), round(g.dec_lo, 6), g.nx, g.ny) if g else (None,) * 4], "ra_lo double, dec_lo double, nx int, ny int")


@query(f"""WITH {TOD}, s AS (SELECT * FROM tod WHERE flags = 0 AND signal IS NOT NULL), a AS (SELECT iy, ix, avg(signal) AS value_det, CAST(count(*) AS DOUBLE) AS hits_det FROM (SELECT *, {PX} FROM s) WHERE {ON_GRID} GROUP BY iy, ix),
b AS (SELECT iy, ix, avg(signal) AS value_bore, CAST(count(*) AS DOUBLE) AS hits_bore FROM (SELECT *, {PX.replace('(ra ', '(ra_bore ').replace('(dec ', '(dec_bore ')} FROM s) WHERE {ON_GRID} GROUP BY iy, ix)
SELECT iy, ix, round(value_det, 6) AS value_det, hits_det, round(value_bore, 6) AS value_bore, hits_bore FROM a FULL JOIN b USING (iy, ix)""")
def boresight_and_detector_maps(spark, sf_dir):
    return rounded(binning.boresight_compare(tod_of(spark, sf_dir), EVENTS_GRID))


COMMON = "cmn AS (SELECT *, coalesce(avg(CASE WHEN flags = 0 THEN signal END) OVER (PARTITION BY sample_idx), 0) AS common FROM tod)"


@query(f"WITH {TOD}, {COMMON} SELECT det, sample_idx, round(common, 6) + 0.0 AS common, round(signal - common, 6) + 0.0 AS signal FROM cmn")
def common_mode_removed(spark, sf_dir):
    return cm.common_mode(tod_of(spark, sf_dir)).select("det", "sample_idx", r("common").alias("common"), r(F.col("signal") - F.col("common")).alias("signal"))


@query(f"""WITH {TOD}, {EVENT_MAP}, sk AS (SELECT tod.*, coalesce(value, 0) AS sky FROM (SELECT *, greatest(0, least(23, CAST(floor((ra - 9.875) / 0.05) AS INTEGER))) AS ix, greatest(0, least(11, CAST(floor((dec - 19.975) / 0.05) AS INTEGER))) AS iy FROM tod) tod LEFT JOIN fm USING (iy, ix)),
c AS (SELECT *, coalesce(avg(CASE WHEN flags = 0 THEN signal - sky END) OVER (PARTITION BY sample_idx), 0) AS common FROM sk) SELECT det, sample_idx, round(signal - common, 6) + 0.0 AS signal FROM c""")
def sky_informed_common_mode(spark, sf_dir):
    t = tod_of(spark, sf_dir)
    m = binning.finish_map(binning.bin_map(t, EVENTS_GRID))
    return cm.subtract_common_mode(t, m, EVENTS_GRID).select("det", "sample_idx", r("signal").alias("signal"))
