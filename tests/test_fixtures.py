"""Small inputs with values worked out by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions import arrays
from starloom.functions import geometry as g
from starloom.functions.medians import exact_median
from starloom.operators import align, binning, chunks, clean, common_mode, detectors, nulls, pointing, quality, readout, recon, spectra
from starloom.operators.common_mode import predict_signal
from starloom.sources import snapshots, tables
from starloom.streaming import maps as streams

TOD = "obs_id string, chunk_index long, sample_idx long, t double, det string, det_idx int, signal double, flags int, ra double, dec double"


def tod(spark, rows):
    """Rows (chunk, sample, det_idx, signal, flags, ra, dec)."""
    return spark.createDataFrame([("o", c, s, float(s), "abcdefgh"[d], d, None if x is None else float(x), f, ra, dec) for c, s, d, x, f, ra, dec in rows], TOD)


@pytest.fixture
def two_halves(spark):
    rows = []
    for c, (signals, ras, bad) in enumerate([([(10, 14), (18, 26), (4, 999)], [0.5, 1.5, 2.5], (2, 1)), ([(8, 12), (5, 7), (0, 0)], [0.5, 1.5, 3.5], (1, 1))]):
        rows += [(c, 3 * c + s, d, pair[d], int((s, d) == bad), ra, 0.5) for s, (pair, ra) in enumerate(zip(signals, ras, strict=True)) for d in (0, 1)]
    return tod(spark, rows)


GRID = binning.Grid(0.0, 0.0, 1.0, 1.0, 3, 1)


def test_weighted_nulls(spark, two_halves):
    w = spark.createDataFrame([(0, 1.0), (1, 3.0)], "det_idx int, weight double")
    t = {r.ix: (r.value, r.hits0, r.hits1) for r in nulls.time_null(two_halves, GRID, w).collect()}
    assert t == {0: (1.0, 4.0, 4.0), 1: (9.5, 4.0, 1.0), 2: (None, 1.0, 0.0)}
    halves = spark.createDataFrame([(0, 0), (1, 1)], "det_idx int, det_half int")
    d = {r.ix: r.value for r in nulls.detector_null(two_halves, GRID, halves, w).collect()}
    assert d == {0: -2.0, 1: -7.25, 2: None}
    const = two_halves.withColumn("signal", F.lit(10.0))
    assert {r.value for r in nulls.time_null(const, GRID, w).collect()} == {0.0, None}
    with pytest.raises(ValueError, match="two detectors"):
        nulls.detector_null(two_halves, GRID, halves.where("det_idx = 0"), w)
    apart = nulls.null_report(nulls.time_null(two_halves.withColumn("ra", F.col("chunk_index") + 0.5), GRID, w)).first()
    assert apart.overlap == 0 and apart.warn


def test_grouping_sets_agree_with_the_map(spark, two_halves):
    halves = nulls.detector_halves(two_halves)
    assert sorted(r.det_half for r in halves.collect()) == [0, 1]
    s = nulls.all_splits(two_halves, GRID, halves)
    total = {(r.iy, r.ix): r.data for r in s.where("time_half is null and det_half is null").collect()}
    assert total == {(r.iy, r.ix): r.data for r in binning.bin_map(two_halves, GRID).collect()}


def test_exclusion_and_weights(spark):
    s = spark.createDataFrame([(0, "a", 1.0, 1.0), (1, "b", 1.0, 1.0), (2, "c", 20.0, 100.0)], "det_idx int, det string, noise double, wnf double")
    assert [r.det_idx for r in detectors.exclude_noisy(s, 5.0).collect()] == [2]
    assert [r.det_idx for r in detectors.exclude_wnf(s, 1.0).collect()] == [2]
    assert detectors.exclude_noisy(s, 0).count() == 0
    x = {r.det_idx: r.reasons for r in detectors.exclude_detectors(s, ["a"], [], 5.0, 1.0).collect()}
    assert x == {0: ["manual"], 2: ["noise", "wnf"]}
    none = s.withColumn("wnf", F.lit(None).cast("double"))
    assert {r.weight for r in detectors.detector_weights(none).collect()} == {1.0} == {r.weight for r in detectors.detector_weights(s, 0).collect()}
    assert detectors.unknown_detectors(s, ["a", "zz"]).first().det == "zz"


def test_sampling_phase(spark):
    sizes, rows, k = [5, 1, 1, 7], [], 0
    for c, n in enumerate(sizes):
        for _ in range(n):
            rows.append((c, k, 0, k, 0, 0.0, 0.0))
            k += 1
    t = tod(spark, rows)
    got = chunks.subsample(t, 3).orderBy("sample_idx").collect()
    assert [r.sample_idx for r in got] == [0, 3, 6, 9, 12] and sorted({r.chunk_index for r in got}) == [0, 2, 3]
    late = chunks.select_time_window(t, chunks.chunk_table(t, 1.0), 5.0, None)
    assert [r.sample_idx for r in chunks.subsample(late, 3).orderBy("sample_idx").collect()] == [5, 8, 11]
    for bad in (0, -1, 1.5, True, "2"):
        with pytest.raises(ValueError):
            chunks.subsample(t, bad)


def test_automatic_extent(spark):
    rows = [(c, 64 * c + i, d, 1, int(c == 0 and i == 0 and d == 0), 50.0 if (c, i, d) == (0, 0, 0) else (9.0, 12.0)[c] if d == 0 else 11.0, (19.0, 21.0)[c] if d == 0 else 20.0) for c in (0, 1) for i in range(64) for d in (0, 2)]
    t = tod(spark, rows).withColumns({"ra_bore": F.lit(10.0), "dec_bore": F.lit(20.0)})
    grid = binning.auto_grid(detectors.pointing_extent(t), 10.0, 20.0, 0.25)
    assert grid.ra_lo <= 9 and 12 < grid.ra_lo + grid.nx * grid.step_ra < 50 and grid.dec_lo <= 19 and grid.dec_lo + grid.ny * grid.step_dec > 21
    assert binning.bin_map(t, grid).agg(F.sum("hits")).first()[0] == 2 * 64 * 2 - 1
    fixed = binning.auto_grid(detectors.pointing_extent(t), 10.0, 20.0, 0.5, xlen=3.0)
    assert fixed.nx == 6 and fixed.ny > 2
    with pytest.raises(ValueError):
        binning.auto_grid(detectors.pointing_extent(t.limit(0)), 10.0, 20.0, 0.25)
    with pytest.raises(ValueError, match="no pixel"):
        binning.require_coverage(binning.bin_map(t, binning.Grid(0, 0, 1, 1, 2, 2)))


def test_right_edge_counts_only_in_detector_maps(spark):
    t = tod(spark, [(0, 0, 0, 1, 0, 3.0, 0.5), (0, 1, 0, 1, 0, 2.5, 0.5)])
    assert binning.bin_map(t, GRID).agg(F.sum("hits")).first()[0] == 1
    assert binning.bin_per_detector(t, GRID).agg(F.sum("hits")).first()[0] == 2


def test_gaps_and_steps(spark):
    x = [math.sin(i / 4) for i in range(32)]
    rows = [(0, i, 0, None if i == 10 else v, 0, 0.0, 0.0) for i, v in enumerate(x)]
    t = clean.fill_gaps(tod(spark, rows))
    r = t.where("sample_idx = 10").first()
    assert r.clean_flags == 2 and r.signal == pytest.approx((x[9] + x[11]) / 2)
    assert spectra.highpass(t, 16.0, 0.5).where("signal is null").isEmpty()
    open_end = clean.fill_gaps(tod(spark, [(0, i, 0, None if i == 0 else v, 0, 0.0, 0.0) for i, v in enumerate(x)]))
    assert open_end.where("sample_idx = 0").first().signal is None
    for filtered in (spectra.highpass(open_end, 16.0, 0.5), spectra.notch(open_end, 16.0, 2.0)):
        with pytest.raises(Exception, match="unfillable gap"):
            filtered.collect()
    cubic = clean.fill_gaps(tod(spark, [(0, i, 0, None if 4 <= i <= 8 else i**3, 0, 0.0, 0.0) for i in range(12)]))
    assert [r.signal for r in cubic.orderBy("sample_idx").collect()] == pytest.approx([float(i**3) for i in range(12)])
    noise = spark.createDataFrame([(0, 0.5)], "det_idx int, noise double")
    many = tod(spark, [(0, i, 0, None if i % 4 else 0, 0, 0.0, 0.0) for i in range(4001)])
    vals = clean.fill_gaps(many, noise=noise, seed=3).where("clean_flags = 2").agg(F.avg("signal").alias("m"), F.stddev_pop("signal").alias("s")).first()
    assert abs(vals.m) < 0.05 and vals.s == pytest.approx(0.5, abs=0.05)
    doubled = clean.clean_tod(many, [lambda df: df.withColumn("signal", F.col("signal") * 2)])
    assert doubled.agg(F.max("signal")).first()[0] == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cosmic_rays_match_a_plain_loop(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, 80)
    for k in rng.choice(80, 5, replace=False):
        x[k : k + rng.integers(1, 4)] += 12
    sigma, width, pad = 1.5, 5, 2
    d, s = np.diff(x, prepend=x[0]), sigma * x.std()
    hit = np.zeros(80, bool)
    for i in range(80):
        if d[i] > s and any(d[j] < -s for j in range(i, min(80, i + width + 1))):
            hit[max(0, i - pad) : i + width + pad + 1] = True
    want = np.where(hit, np.interp(np.arange(80), np.flatnonzero(~hit), x[~hit]), x) if (~hit).sum() >= 2 else x
    got = clean.clean_tod(tod(spark, [(0, i, 0, v, 0, 0.0, 0.0) for i, v in enumerate(x)]), [clean.cosmic_ray_step(sigma, width, pad)]).orderBy("sample_idx").collect()
    assert [r.clean_flags for r in got] == hit.astype(int).tolist()
    assert [r.signal for r in got] == pytest.approx(want.tolist())


def test_common_mode_uses_input_flags_and_the_sky(spark):
    t = tod(spark, [(0, 0, 0, 10, 0, 0.5, 0.5), (0, 0, 1, 20, 0, 1.5, 0.5), (0, 0, 2, 99, 1, 1.5, 0.5), (0, 1, 0, 5, 1, 0.5, 0.5)])
    assert sorted(r.signal for r in common_mode.subtract_common_mode(t).collect()) == [-5.0, 5.0, 5.0, 84.0]
    sky = spark.createDataFrame([(0, 1, 6.0)], "iy int, ix int, value double")
    assert sorted(r.signal for r in common_mode.subtract_common_mode(t, sky, GRID).collect()) == [-2.0, 5.0, 8.0, 87.0]


IQ = "block string, frame int, channel string, t_ticks long, value double"


def lab(spark, extra=()):
    data = {"r0001_Q": [0, 0, 0], "r0000_I": [1, 1.5, 2], "r0001_I": [6, 6.5, 7], "r0000_Q": [0, 0, 0]}
    return spark.createDataFrame([("B1D1", 0, c, k * 10**8, float(v)) for c, vs in data.items() for k, v in enumerate(vs)] + list(extra), IQ)


def lab_sweep(spark):
    return spark.createDataFrame([("B1D1", d, k, 100.0 * (d + 1) + k, float(i), 0.0) for d in (0, 1) for k, i in enumerate([0, 1, 3, 6])], "block string, res_id int, pt int, freq double, i double, q double")


def test_lab_block(spark):
    comb = spark.createDataFrame([("B1D1", 0, 101.25), ("B1D1", 1, 203.0)], "block string, res_id int, f_tone double")
    pairs = readout.pair_iq(lab(spark))
    out = readout.iq_to_df_gradient(pairs, readout.tone_reference(lab_sweep(spark), comb)).orderBy("det", "t_ticks").collect()
    assert [r.det for r in out][::3] == ["B1D1:r0000", "B1D1:r0001"]
    assert [r.df_f0 for r in out] == pytest.approx([-0.25 / 101.25, 0, 0.25 / 101.25, 0, 0.5 / 3 / 203, 1 / 3 / 203])
    own = readout.probe_tone(lab_sweep(spark), None)
    free = readout.iq_to_df_gradient(pairs.where("res_id = 0"), readout.tone_reference(lab_sweep(spark), own)).orderBy("t_ticks").collect()
    assert [r.df_f0 for r in free] == pytest.approx([-2 / 3 / 102, -1.5 / 3 / 102, -1 / 3 / 102])
    problems = lambda extra: {r.problem for r in readout.validate_iq(lab(spark, extra)).collect()}
    assert problems([]) == set()
    assert problems([("B1D1", 0, "r0002_I", 0, 1.0)]) == {"missing half"}
    assert problems([("B1D1", 0, "x1", 0, 1.0)]) == {"bad channel name"}
    assert "channel list changes" in problems([("B1D1", 1, "r0000_I", 9, 1.0)])
    bad = {r.problem for r in readout.validate_sweep(lab_sweep(spark), comb.withColumn("f_tone", F.lit(1000.0))).collect()}
    assert bad == {"tone outside the sweep"}


def test_angle_and_hybrid(spark):
    sweep = spark.createDataFrame([("B", 0, k, 100.0 + k, math.cos((k - 10) * 0.07), math.sin((k - 10) * 0.07)) for k in range(21)], "block string, res_id int, pt int, freq double, i double, q double")
    # the whole circle, so that the bounding box is centred
    ring = spark.createDataFrame([("B", 0, k, 100.0 + k, math.cos((k - 110) * 0.07), math.sin((k - 110) * 0.07)) for k in range(0, 90)], sweep.schema)
    tone = spark.createDataFrame([("B", 0, 145.5)], "block string, res_id int, f_tone double")
    seen = [145.5, 150.0, 160.0]
    iq = spark.createDataFrame([("B", 0, k, math.cos((f - 210) * 0.07), math.sin((f - 210) * 0.07)) for k, f in enumerate(seen)], "block string, res_id int, t_ticks long, i double, q double")
    out = readout.iq_to_df_hybrid(iq, ring, tone).orderBy("t_ticks").collect()
    assert [r.angle_used for r in out] == [False, True, True]
    assert [r.df_f0 for r in out] == pytest.approx([(f - 145.5) / 145.5 for f in seen], abs=1e-3)
    line = lab_sweep(spark).where("res_id = 0")
    ref = readout.tone_reference(line, spark.createDataFrame([("B1D1", 0, 101.75)], "block string, res_id int, f_tone double"))
    two = spark.createDataFrame([("B1D1", 0, 0, 2.5, 0.0), ("B1D1", 0, 1, 3.0, 0.0)], iq.schema)
    assert [r.df_f0 for r in readout.iq_to_df_gradient(two, ref).orderBy("t_ticks").collect()] == pytest.approx([0, 0.25 / 101.75])


def test_alignment_over_frames_with_a_gap(spark):
    rows = [("a", float(t), 1.5 + 0.2 * t) for t in range(7)] + [("b", t, 1.5 + 0.2 * t) for t in (0.5, 1.5, 2.5, 4.5, 5.5, 6.5)]
    s = spark.createDataFrame(rows, "stream string, t double, v double")
    grid = align.common_grid(s)
    assert [r.t for r in grid.orderBy("t").collect()] == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5]
    for bucket in (1.0, 100.0):
        out = {(r.stream, r.t): (r.v, r.flags) for r in align.align_streams(s, grid, "v", bucket=bucket).collect()}
        assert out["b", 3.5] == (None, 2)
        assert all(v == (pytest.approx(1.5 + 0.2 * t), 0) for (n, t), v in out.items() if (n, t) != ("b", 3.5))
    with pytest.raises(ValueError):
        align.common_grid(spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.0, 1.0), ("b", 5.0, 1.0), ("b", 6.0, 1.0)], s.schema))


def test_pointing_through_north(spark):
    hk = spark.createDataFrame([(float(t), a, 20.0) for t, a in enumerate([359.0, 1.0, 1.0])], "t double, az double, el double")
    ask = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "t double")
    assert [r.az for r in align.align_pointing(hk, ask).orderBy("t").collect()] == pytest.approx([359, 0, 1])
    with pytest.raises(ValueError, match="gap"):
        align.align_pointing(spark.createDataFrame([(0.0, 1.0, 2.0), (1.0, 1.0, 2.0), (2.0, 1.0, 2.0), (9.0, 1.0, 2.0)], hk.schema), spark.createDataFrame([(5.0,)], "t double"))


def test_focal_plane_and_boresight(spark):
    half = math.radians(2) / 2
    fp = tables.load_focalplane(spark.createDataFrame([(d, (0.0, s * math.sin(half), 0.0, math.cos(half))) for d, s in ((0, -1), (1, 1))], "det_idx int, q struct<x: double, y: double, z: double, w: double>"))
    a, b = math.radians(10) / 2, math.radians(70) / 2
    q = (-math.sin(a) * math.sin(b), math.cos(a) * math.sin(b), math.sin(a) * math.cos(b), math.cos(a) * math.cos(b))
    bore = spark.createDataFrame([("o", s, q) for s in range(4)], "obs_id string, sample_idx long, q struct<x: double, y: double, z: double, w: double>")
    t = tod(spark, [(0, s, d, 1, 0, 0.0, 0.0) for s in range(4) for d in (0, 1)]).drop("ra", "dec")
    got = {(r.det_idx, round(r.ra, 9), round(r.dec, 9)) for r in pointing.detector_radec(t, bore, fp).collect()}
    assert got == {(0, 10.0, 22.0), (1, 10.0, 18.0)}
    back = bore.select(g.quat_rotate_inv(F.col("q"), g.boresight_dir(F.col("q"))).alias("v")).first().v
    assert (back.x, back.y, back.z) == pytest.approx((0, 0, 1), abs=1e-12)
    swapped = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "a array<double>").select(g.quat_from_wxyz(F.col("a")).alias("q")).first().q
    assert (swapped.x, swapped.y, swapped.z, swapped.w) == (2, 3, 4, 1)


def test_altaz_follows_known_directions():
    # the celestial pole stands due north at the latitude's height; the equator's point in the south at 90 - lat
    t = np.array([1.7e9])
    ra, dec = arrays.altaz_to_radec(np.array([0.0]), np.array([40.0]), t, 40.0, 0.0)
    assert dec[0] > 89.8
    ra, dec = arrays.altaz_to_radec(np.array([180.0]), np.array([50.0]), t, 40.0, 0.0)
    gmst = (280.46061837 + 360.98564736629 * (t[0] / 86400 + 40587 - 51544.5)) % 360
    assert abs(dec[0]) < 0.2 and abs((ra[0] - gmst + 180) % 360 - 180) < 0.45


def test_psd_before_and_after(spark):
    rate, n = 128.0, 1024
    i = np.arange(n)
    shared, own = np.sin(2 * np.pi * 8 * i / rate), 0.3 * np.sin(2 * np.pi * 20 * i / rate)
    rows = [("o", 0, int(k), d, 1 if (k, d) == (0, 0) else 0, float(shared[k] + s * own[k]), float(s * own[k])) for k in i for d, s in ((0, 1), (1, -1))]
    df = spark.createDataFrame(rows, "obs_id string, chunk_index long, sample_idx long, det_idx int, flags int, before double, after double")
    p = spectra.psd_before_after(df, rate, 512)
    seg = {r.det_idx: r.segments for r in p.select("det_idx", "segments").distinct().collect()}
    assert seg == {0: 2, 1: 3}
    at = {(r.det_idx, r.freq_hz): r for r in p.where("freq_hz in (8, 20)").collect()}
    assert at[1, 8.0].before > 1 and at[1, 8.0].after < 1e-20 and at[1, 20.0].before == pytest.approx(at[1, 20.0].after)
    assert spectra.psd_before_after(df.withColumn("flags", F.lit(1)), rate, 512).count() == 0


def test_first_chunk_sets_the_spectrum(spark):
    rows = [(c, 16 * c + i, d, 5 if d else i % 5, 0, 0.0, 0.0) for c, n in ((0, 16), (1, 12)) for i in range(n) for d in (0, 1)]
    p = spectra.mean_psd(spectra.periodogram(tod(spark, rows), 1.0))
    assert p.groupBy("det_idx").count().select("count").distinct().first()[0] == 9
    assert detectors.detector_offsets(tod(spark, [(c, 16 * c + i, 1, 5 if c == 0 else None, 0, 0.0, 0.0) for c in (0, 1) for i in range(16)])).first().offset == 5


def test_anomalies_and_notch(spark):
    f = np.arange(0, 50, 0.1)
    p = 1 + 0.01 * np.cos(f * 7)
    p[[200, 201]] *= [30, 100]
    p[450] *= 1000
    found = lambda x, y: [tuple(r) for r in spectra.psd_anomalies(spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)], "freq_hz double, power double")).collect()]
    got = found(f, p)
    assert [round(a, 6) for a, _ in got] == [45.0, 20.1] and [b for _, b in got] == pytest.approx([30, 20], abs=0.2)
    assert found(f[:10], p[:10]) == [] and found(f, np.ones_like(f)) == []


def test_notch():
    t = np.arange(256) / 64
    x = np.sin(2 * np.pi * 8 * t) + np.sin(2 * np.pi * 3 * t)
    assert arrays.notch(x, 64, 8, 2, 0.5) == pytest.approx(np.sin(2 * np.pi * 3 * t)) and arrays.notch(x, 64, 0, 2, 0.5) is x


def test_convergence(spark):
    rows = [(0, "naive", 0, 0, 1.0), (0, "naive", 0, 1, 2.0), (0, "naive", 1, 0, 3.0), (0, "naive", 1, 1, None), (1, "final", 0, 0, 2.0), (1, "final", 0, 1, 4.0), (1, "final", 1, 0, None), (1, "final", 1, 1, 10.0)]
    c = {r.name: r for r in quality.convergence(spark.createDataFrame(rows, "stage int, name string, iy int, ix int, value double"), "final").collect()}
    assert [c[n].peak for n in ("naive", "final")] == [3, 10] and [c[n].rms_off for n in ("naive", "final")] == [1, 2]
    assert c["final"].rms_diff == pytest.approx(math.sqrt(2.5))


def test_gauss_fit_and_regrid(spark):
    rng = np.random.default_rng(0)
    grid = binning.Grid(-0.1, -0.1, 0.01, 0.01, 20, 20)
    rows = [(d, iy, ix, float(10 * math.exp(-((-0.095 + ix * 0.01 - cx) ** 2 + (-0.095 + iy * 0.01 - cy) ** 2) / (2 * 0.015**2)) + 1 + 0.01 * rng.normal()), 1.0) for d, (cx, cy) in enumerate([(0.012, -0.003), (-0.021, 0.017)]) for iy in range(20) for ix in range(20)]
    m = spark.createDataFrame(rows, "det_idx int, iy int, ix int, data double, hits double")
    fit = {r.det_idx: r for r in recon.gauss_centroid(m, quality.peak_pixel(m.withColumn("value", F.col("data")), "det_idx"), grid).collect()}
    assert (fit[0].x, fit[0].y, fit[0].sigma) == pytest.approx((0.012, -0.003, 0.015), abs=1e-3) and (fit[1].x, fit[1].y) == pytest.approx((-0.021, 0.017), abs=1e-3)
    assert recon.gauss_centroid(m.where("ix <> 11"), quality.peak_pixel(m.withColumn("value", F.col("data")), "det_idx"), grid).where("det_idx = 0").count() == 0


def test_files_and_storage(spark, tmp_path):
    rows = [("o", 0, 0, s, float(s), "a/b", 0, float("nan") if s == 1 else 1.0, 0) for s in range(8)]
    spark.createDataFrame(rows, tables.TOD).repartition(1).write.parquet(str(tmp_path / "d" / "deep"))
    df = tables.read_tod(spark, str(tmp_path / "d"))
    assert df.count() == 8 and df.where("signal is null").count() == 1
    one = tables.input_manifest(df.drop("nothing")).collect()
    assert [(r.n_rows, r.read) for r in one] == [(8, True)]
    maps = spark.createDataFrame([("it_0", 0, 1, 2.0), ("final", 0, 1, 3.0)], "stage string, iy int, ix int, value double")
    tables.write_maps(maps, str(tmp_path / "maps"))
    assert {r.stage for r in snapshots.latest(spark, str(tmp_path / "maps")).collect()} == {"it_0", "final"}
    tables.write_psd(maps, str(tmp_path / "psd"))
    meta = spark.createDataFrame([(1.5, float("inf"))], "a double, b double")
    tables.write_metadata(meta, str(tmp_path / "meta"))
    assert spark.read.text(str(tmp_path / "meta")).first().value == '{"a":1.5,"b":null}'
    cents = spark.createDataFrame([("a/b", 1.0, 2.0, 9.0)], "det string, ra double, dec double, snr double")
    tables.write_centroids(cents, str(tmp_path / "c"))
    assert tables.read_centroids(spark, str(tmp_path / "c")).first().asDict() == cents.first().asDict()
    assert cents.select(g.safe_name(F.col("det"))).first()[0] == "a_b"


def test_chunk_windows_drop_late_rows(spark, tmp_path):
    schema = "ts timestamp, det string, signal double"
    for k, times in enumerate([["2024-01-01 00:00:10", "2024-01-01 00:05:00"], ["2024-01-01 02:00:00"], ["2024-01-01 00:00:20", "2024-01-01 02:01:00"], ["2024-01-01 09:00:00"]]):
        spark.createDataFrame([(x, "a", 1.0) for x in times], "ts string, det string, signal double").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{k}"))
    src = tmp_path / "all"
    src.mkdir()
    for k in range(4):
        for f in (tmp_path / f"in{k}").glob("*.parquet"):
            f.rename(src / f"{k}-{f.name}")
        s = spark.readStream.schema(schema).parquet(str(src))
        streams.run_available(streams.stream_chunk_stats(s, "10 minutes", "30 minutes"), str(tmp_path / "out"), str(tmp_path / "state"))
    got = {str(r.t_start): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got["2024-01-01 00:00:00"] == 2 and got["2024-01-01 02:00:00"] == 2


def test_medians_of_groups_are_exact(spark):
    rng = np.random.default_rng(5)
    values = {0: rng.standard_normal(101).tolist(), 1: rng.integers(0, 4, 40).astype(float).tolist(), 2: [7.0], 3: [1.0, 2.0], 4: [5.0] * 30 + [1e9]}
    df = spark.createDataFrame([(k, x) for k, v in values.items() for x in v] + [(0, None)], "k int, x double").repartition(3)
    for parts in (2, 16, 10_000):
        assert {r.k: r.x for r in exact_median(df, ["k"], "x", parts).collect()} == pytest.approx({k: float(np.median(v)) for k, v in values.items()})


def test_samples_without_finite_place_are_in_no_map(spark):
    bad = [float("nan"), float("inf"), float("-inf"), None]
    rows = [(0, i, 0, *v) for i, v in enumerate([(1.0, 0, 0.5, 0.5), *((1.0, 0, b, 0.5) for b in bad), *((1.0, 0, 0.5, b) for b in bad), *((b, 0, 0.5, 0.5) for b in bad)])]
    t = tod(spark, rows)
    assert binning.bin_map(t, GRID).agg(F.sum("n_samples"), F.sum("data")).first()[:] == (1, 1.0)
    assert binning.bin_per_detector(t, GRID).agg(F.sum("hits")).first()[0] == 1
    sky = spark.createDataFrame([(0, 0, 4.0)], "iy int, ix int, value double")
    got = predict_signal(t, sky, GRID).where("sample_idx between 1 and 8 and sky <> 0")
    assert got.isEmpty()
