"""Queries on whole map-making runs: turns, convergence, nulls and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.jobs.base import DENSE, EVENTS_GRID, LINES, LINES_GRID, TOD, query, r, rounded
from starloom.jobs.sky_queries import tod_of
from starloom.jobs.stream_queries import FILL, SPIKES
from starloom.operators import clean, detectors, mapmaking, nulls, quality, spectra
from starloom.sources.adapters import tod_from_lineitem, tod_from_orders

TURNS = 3


def turns_sql(turns: int, nx: int) -> str:
    """s{k}, m{k}: the samples and the map of each turn, one after the other, from prep(chunk_index, sample_idx, det_idx, x, flags, good, px, seen_at, w)."""
    out = [f"""s0 AS (SELECT *, x - coalesce(avg(CASE WHEN flags = 0 THEN x END) OVER (PARTITION BY sample_idx), 0) AS y FROM prep)"""]
    for k in range(turns + 1):
        if k:
            out.append(f"""r{k} AS (SELECT prep.*, x - coalesce(value, 0) AS rest FROM prep LEFT JOIN (SELECT px AS seen_at, value FROM m{k - 1}) USING (seen_at)),
s{k} AS (SELECT *, x - coalesce(avg(CASE WHEN flags = 0 THEN rest END) OVER (PARTITION BY sample_idx), 0) AS y FROM r{k})""")
        out.append(f"m{k} AS (SELECT px, sum(w * y) / sum(w) AS value, sum(w) AS hits, count(*) AS n_samples FROM s{k} WHERE good AND px IS NOT NULL AND w <> 0 GROUP BY px)")
    stages = " UNION ALL ".join(f"SELECT {k} AS stage, 'it_{k}' AS name, * FROM m{k}" for k in range(turns + 1))
    naive = "SELECT -1 AS stage, 'naive' AS name, px, avg(x) AS value, CAST(count(*) AS DOUBLE) AS hits, count(*) AS n_samples FROM prep WHERE good AND px IS NOT NULL GROUP BY px"
    return ",\n".join(out) + f",\nmaps AS (SELECT stage, name, CAST(px // {nx} AS INTEGER) AS iy, CAST(px % {nx} AS INTEGER) AS ix, value, hits, n_samples FROM ({naive} UNION ALL {stages}))"


def _prep_sql(tod: str) -> str:
    """prep: cleaned samples less their detector's offset; detector 3 weighs 0, so it is in the naive map alone, the others one more than their number."""
    return f"""WITH {tod}, {SPIKES}, strided AS (SELECT *, row_number() OVER (PARTITION BY chunk_index, det_idx ORDER BY sample_idx) - 1 AS i, count(*) OVER (PARTITION BY chunk_index, det_idx) AS n FROM tod),
med AS (SELECT chunk_index, det_idx, median(signal) AS m FROM strided WHERE i % CAST(power(2, floor(log2(greatest(n, 100) / 100.0))) AS BIGINT) = 0 GROUP BY ALL), off AS (SELECT det_idx, avg(m) AS o FROM med GROUP BY det_idx),
pl AS (SELECT *, CAST(floor((ra - 9.875) / 0.05) AS INTEGER) AS ix, CAST(floor((dec - 19.975) / 0.05) AS INTEGER) AS iy FROM cleaned JOIN off USING (det_idx)),
prep AS (SELECT chunk_index, sample_idx, det_idx, signal - o AS x, flags, flags = 0 AND clean_flags = 0 AND signal IS NOT NULL AS good, CASE WHEN ix BETWEEN 0 AND 23 AND iy BETWEEN 0 AND 11 THEN iy * 24 + ix END AS px,
  least(11, greatest(0, iy)) * 24 + least(23, greatest(0, ix)) AS seen_at, CASE WHEN det_idx = 3 THEN 0 ELSE 1.0 + det_idx END AS w FROM pl)"""


EVENTS_PREP = _prep_sql(TOD)


def _run(t):
    weights = t.select("det_idx").distinct().select("det_idx", F.when(F.col("det_idx") == 3, 0.0).otherwise(1.0 + F.col("det_idx")).alias("weight"))
    return mapmaking.make_maps(t, EVENTS_GRID, TURNS, weights, nulls.detector_halves(t), detectors.detector_offsets(t), [clean.cosmic_ray_step(sigma=1.5)], may_be_empty=True)


@query(f"{EVENTS_PREP}, {turns_sql(TURNS, 24)} SELECT stage, name, iy, ix, round(hits, 6) AS hits, n_samples, round(value, 5) + 0.0 AS value FROM maps")
def iterated_map(spark, sf_dir):
    return _run(tod_of(spark, sf_dir)).maps.select("stage", "name", "iy", "ix", r("hits").alias("hits"), "n_samples", r("value", 5).alias("value"))


@query(f"""{EVENTS_PREP}, {turns_sql(TURNS, 24)}, f AS (SELECT iy, ix, value < (SELECT median(value) FROM maps WHERE name = 'it_{TURNS}') AS off FROM maps WHERE name = 'it_{TURNS}'),
b AS (SELECT stage, name, max(value) AS peak, sqrt(avg(CASE WHEN off THEN value * value END)) AS rms_off, sqrt(avg(CASE WHEN NOT off THEN value * value END)) AS rms_on FROM maps LEFT JOIN f USING (iy, ix) GROUP BY stage, name),
d AS (SELECT a.stage, sqrt(avg((a.value - p.value) * (a.value - p.value))) AS rms_diff FROM maps a JOIN maps p ON a.iy = p.iy AND a.ix = p.ix AND a.stage = p.stage + 1 GROUP BY a.stage)
SELECT stage, name, round(peak, 5) AS peak, round(rms_off, 5) AS rms_off, round(rms_on, 5) AS rms_on, round(rms_diff, 5) AS rms_diff FROM b LEFT JOIN d USING (stage)""")
def iterated_convergence(spark, sf_dir):
    return rounded(quality.convergence(_run(tod_of(spark, sf_dir)).maps, f"it_{TURNS}"), 5)


def _null_sql(half: str) -> str:
    return f"""SELECT px, CASE WHEN h0 > 0 AND h1 > 0 THEN (d0 / h0 - d1 / h1) / 2 END AS value, coalesce(h0, 0) AS hits0, coalesce(h1, 0) AS hits1 FROM (SELECT px, sum(CASE WHEN {half} = 0 THEN w * y END) AS d0, sum(CASE WHEN {half} = 0 THEN w END) AS h0,
sum(CASE WHEN {half} = 1 THEN w * y END) AS d1, sum(CASE WHEN {half} = 1 THEN w END) AS h1 FROM s{TURNS} JOIN hv USING (det_idx) WHERE good AND px IS NOT NULL AND w <> 0 GROUP BY px)"""


@query(f"""{EVENTS_PREP}, {turns_sql(TURNS, 24)}, hv AS (SELECT det_idx, CASE WHEN row_number() OVER (ORDER BY md5('0:' || det_idx), det_idx) <= floor((SELECT count(*) FROM dets) / 2) THEN 0 ELSE 1 END AS det_half FROM dets)
SELECT split, CAST(px // 24 AS INTEGER) AS iy, CAST(px % 24 AS INTEGER) AS ix, round(value, 5) + 0.0 AS value, round(hits0, 6) + 0.0 AS hits0, round(hits1, 6) + 0.0 AS hits1
FROM (SELECT 'time' AS split, * FROM ({_null_sql('chunk_index % 2')}) UNION ALL SELECT 'detector', * FROM ({_null_sql('det_half')}))""")
def iterated_nulls(spark, sf_dir):
    run = _run(tod_of(spark, sf_dir))
    both = [run.null(by).select(F.lit(by).alias("split"), "iy", "ix", r("value", 5).alias("value"), r("hits0").alias("hits0"), r("hits1").alias("hits1")) for by in ("time", "detector")]
    return both[0].unionByName(both[1])


#: The chain of cleaning, common mode and turns over every row of lineitem, each order a moment of its own.
LINES_PREP = f"""WITH {LINES}, prep AS (SELECT chunk_index, sample_idx, det_idx, signal AS x, flags, flags = 0 AS good, iy * 40 + ix AS px, iy * 40 + ix AS seen_at, CAST(1 AS DOUBLE) AS w FROM li)"""


@query(f"{LINES_PREP}, {turns_sql(TURNS, 40)} SELECT stage, name, iy, ix, hits, n_samples, round(value, 3) + 0.0 AS value FROM maps")
def iterated_map_lineitem(spark, sf_dir):
    run = mapmaking.make_maps(tod_from_lineitem(spark, sf_dir), LINES_GRID, TURNS, may_be_empty=True)
    return run.maps.select("stage", "name", "iy", "ix", "hits", "n_samples", r("value", 3).alias("value"))


# ---------------------------------------------------------------- the same on timestreams whose length follows the tables


@query(f"{_prep_sql(DENSE)}, {turns_sql(TURNS, 24)} SELECT stage, name, iy, ix, round(hits, 6) AS hits, n_samples, round(value, 3) + 0.0 AS value FROM maps")
def dense_iterated_map(spark, sf_dir):
    """Offsets, gaps, spikes and all turns on seven detectors with a sample for each order."""
    return _run(tod_from_orders(spark, sf_dir)).maps.select("stage", "name", "iy", "ix", r("hits").alias("hits"), "n_samples", r("value", 3).alias("value"))


@query(f"""WITH {DENSE}, {SPIKES} SELECT chunk_index, det, count(*) AS n, count(*) FILTER (clean_flags & 2 <> 0) AS gaps, count(*) FILTER (clean_flags & 1 <> 0) AS spikes, round(avg(signal), 4) + 0.0 AS mean, round(stddev_pop(signal), 4) + 0.0 AS std
FROM cleaned GROUP BY chunk_index, det""")
def dense_cleaned(spark, sf_dir):
    c = clean.clean_tod(tod_from_orders(spark, sf_dir), [clean.cosmic_ray_step(sigma=1.5)])
    flag = lambda bit: F.count_if(F.col("clean_flags").bitwiseAND(F.lit(bit)) != 0)
    return c.groupBy("chunk_index", "det").agg(F.count("*").alias("n"), flag(2).alias("gaps"), flag(1).alias("spikes"), r(F.avg("signal"), 4).alias("mean"), r(F.stddev_pop("signal"), 4).alias("std"))


@query(f"""WITH {DENSE}, {FILL}, sizes AS (SELECT chunk_index, det_idx, count(*) AS size, count(signal) AS have FROM filled GROUP BY ALL), wh AS (SELECT f.*, sample_idx % 512 AS n FROM filled f JOIN sizes USING (chunk_index, det_idx) WHERE size = have AND size = 512),
mdn AS (SELECT chunk_index, det_idx, median(signal) AS m FROM wh WHERE n % 4 = 0 GROUP BY ALL), xs AS (SELECT wh.*, (signal - m) * (0.5 - 0.5 * cos(2 * pi() * n / 511)) AS x FROM wh JOIN mdn USING (chunk_index, det_idx)),
ft AS (SELECT chunk_index, det_idx, k, sum(x * cos(2 * pi() * k * n / 512)) AS re, sum(x * sin(2 * pi() * k * n / 512)) AS im FROM xs CROSS JOIN (SELECT range AS k FROM range(257)) GROUP BY ALL), wn AS (SELECT sum(power(0.5 - 0.5 * cos(2 * pi() * range / 511), 2)) AS w2 FROM range(512))
SELECT det_idx, CAST(k AS INTEGER) AS bin, round(k / 512.0, 9) AS freq_hz, round(avg((re * re + im * im) / w2 * CASE WHEN k IN (0, 256) THEN 1 ELSE 2 END) / 1e9, 4) + 0.0 AS power FROM ft, wn GROUP BY det_idx, k""")
def dense_spectra(spark, sf_dir):
    """Mean spectra of all whole chunks, without a sample that could not be filled."""
    p = spectra.mean_psd(spectra.periodogram(clean.fill_gaps(tod_from_orders(spark, sf_dir)), 1.0))
    return p.select("det_idx", "bin", r("freq_hz", 9).alias("freq_hz"), r(F.col("power") / 1e9, 4).alias("power"))
