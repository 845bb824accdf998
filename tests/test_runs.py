"""Map-making runs, snapshots, scans and medians: what is lost, repeated, late, skewed or not finite."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.functions import arrays
from starloom.functions.medians import exact_median
from starloom.functions.scans import bucketed, with_previous, with_rank, with_running_sum
from starloom.operators import align, binning, clean, mapmaking, nulls, recon
from starloom.sources import snapshots
from starloom.streaming import maps as streams

TOD = "obs_id string, chunk_index long, sample_idx long, det_idx int, signal double, flags int, ra double, dec double"
GRID = binning.Grid(9.5, 19.5, 0.25, 0.25, 4, 4)


def scan(spark, n=128, chunks=2, dets=3, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(n * chunks):
        common = 5 * np.sin(s / 9)
        for d in range(dets):
            ra, dec = 9.5 + (s * 7 + d) % 16 / 16, 19.5 + (s // 5) % 16 / 16
            sky = 4.0 if 9.75 <= ra < 10.25 and 19.75 <= dec < 20.25 else 0.0
            rows.append(("o", s // n, s, d, None if s % 37 == 5 else float(common + sky + rng.normal() * 0.1), 4 if (s + d) % 29 == 0 else 0, float(ra), float(dec)))
    return spark.createDataFrame(rows, TOD).repartition(3)


def plain_maps(rows, turns, weights):
    """it_0 .. it_n as dictionaries, by loops."""
    px = lambda r: (int((r.dec - GRID.dec_lo) / GRID.step_dec), int((r.ra - GRID.ra_lo) / GRID.step_ra))
    by_sample: dict = {}
    for r in rows:
        by_sample.setdefault(r.sample_idx, []).append(r)
    sky, out = {}, []
    for _ in range(turns + 1):
        data, hits = {}, {}
        for group in by_sample.values():
            rest = [r.signal - sky.get(px(r), 0.0) for r in group if r.flags == 0 and r.signal is not None]
            common = float(np.mean(rest)) if rest else 0.0
            for r in group:
                if r.flags == 0 and r.clean_flags == 0 and weights.get(r.det_idx):
                    data[px(r)] = data.get(px(r), 0.0) + weights[r.det_idx] * (r.signal - common)
                    hits[px(r)] = hits.get(px(r), 0.0) + weights[r.det_idx]
        sky = {p: data[p] / hits[p] for p in data}
        out.append(sky)
    return out


def as_dict(maps, name):
    return {(r.iy, r.ix): r.value for r in maps.where(F.col("name") == name).collect()}


def test_turns_match_plain_loops_and_the_naive_map_has_every_detector(spark, tmp_path):
    t = scan(spark)
    w = spark.createDataFrame([(0, 1.0), (1, 0.0)], "det_idx int, weight double").unionByName(spark.createDataFrame([(2, 3.0)], "det_idx int, weight double"))
    run = mapmaking.make_maps(t, GRID, 2, w, nulls.detector_halves(t), folder=str(tmp_path / "run"), buckets=4)
    want = plain_maps(clean.clean_tod(t).collect(), 2, {0: 1.0, 1: 0.0, 2: 3.0})
    for k in range(3):
        got = as_dict(run.maps, f"it_{k}")
        assert got.keys() == want[k].keys() and got == pytest.approx(want[k])
    assert run.names == ["naive", "it_0", "it_1", "it_2"] and len(run.changes) == 2
    naive = run.maps.where("name = 'naive'").agg(F.sum("n_samples")).first()[0]
    good = clean.clean_tod(t).where("flags = 0 and clean_flags = 0").count()
    assert naive == good > run.maps.where("name = 'it_2'").agg(F.sum("n_samples")).first()[0]
    c = run.counts.first()
    assert c.samples == t.count() and c.gap_flagged == t.where("signal is null").count() and c.input_flagged == t.where("flags <> 0").count()
    halves = {by: run.null(by).agg(F.sum(F.col("hits0") + F.col("hits1"))).first()[0] for by in ("time", "detector")}
    total = run.maps.where("name = 'it_2'").agg(F.sum("hits")).first()[0]
    assert halves == {"time": total, "detector": total}


def test_a_lost_run_goes_on_and_plans_do_not_grow(spark, tmp_path, monkeypatch):
    t, depth, real = scan(spark), [], mapmaking.turn

    def watched(cleaned, sky):
        out = real(cleaned, sky)
        depth.append(len(out._jdf.queryExecution().analyzed().toString().splitlines()))
        assert "Exchange hashpartitioning(obs_id" not in out._jdf.queryExecution().executedPlan().toString()  # the store is dealt by sample
        return out

    monkeypatch.setattr(mapmaking, "turn", watched)
    whole = mapmaking.make_maps(t, GRID, 4, folder=str(tmp_path / "whole"), buckets=4)
    assert len(depth) == 5 and len(set(depth[1:])) == 1
    at = str(tmp_path / "part")
    mapmaking.make_maps(t, GRID, 1, folder=at, buckets=4)
    depth.clear()
    (tmp_path / "part" / "it_2" / "data-2-lost").mkdir(parents=True)  # a writer that was lost half way
    again = mapmaking.make_maps(t, GRID, 4, folder=at, buckets=4)
    assert len(depth) == 3  # turns 2, 3 and 4 only
    for name in whole.names:
        assert as_dict(again.maps, name) == pytest.approx(as_dict(whole.maps, name))
    assert again.changes == pytest.approx(whole.changes) and sorted(whole.changes, reverse=True) == whole.changes
    few = mapmaking.make_maps(t, GRID, 4, tolerance=whole.changes[1], folder=str(tmp_path / "few"), buckets=4)
    assert few.names == ["naive", "it_0", "it_1", "it_2"]
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("cleaned_")]


def test_a_map_without_samples_is_an_error(spark):
    with pytest.raises(ValueError, match="no pixel of the map has a sample"):
        mapmaking.make_maps(scan(spark, 16, 1).withColumn("ra", F.lit(50.0)), GRID, 1, buckets=2)


def test_snapshots_are_seen_whole_or_not_at_all(spark, tmp_path):
    at = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        snapshots.latest(spark, at)
    one, two = spark.range(3), spark.range(5)
    assert snapshots.publish(one, at, 0) and not snapshots.publish(two, at, 0)
    assert snapshots.latest(spark, at).count() == 3

    def fail(batch):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        snapshots.publish(two.mapInPandas(fail, "id long"), at, 1)
    assert snapshots.latest(spark, at).count() == 3
    reader = snapshots.latest(spark, at)
    assert snapshots.publish(two, at, 1) and snapshots.latest(spark, at).count() == 5 and reader.count() == 3
    snapshots.publish(spark.range(7), at, 2)
    assert list(snapshots.versions(spark, at)) == [1, 2] and len(list((tmp_path / "s").glob("data-*"))) == 2


def test_late_and_on_time_rows_add_up_over_many_batches(spark, tmp_path):
    rng, src = np.random.default_rng(3), tmp_path / "in"
    src.mkdir()
    import pyarrow as pa
    import pyarrow.parquet as pq

    tops, want = {}, set()
    for k in range(104):
        ts = [int(x) for x in k * 60 + rng.integers(-600, 60, 3)]
        dets = [str(d) for d in rng.integers(0, 2, 3)]
        want |= {(k, i, t < tops.get(d, -(10**9)) - 300) for i, (t, d) in enumerate(zip(ts, dets))}
        for t, d in zip(ts, dets):
            tops[d] = max(tops.get(d, -(10**9)), t)
        path = src / f"{k:03}.parquet"
        pq.write_table(pa.table({"k": [k] * 3, "i": [0, 1, 2], "det": dets, "ts": pa.array([t * 1_000_000 for t in ts], pa.timestamp("us", "UTC"))}), path)
        import os

        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    df = spark.readStream.schema("k long, i long, det string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(src))
    done = streams.run_with_late(df, str(tmp_path / "out"), str(tmp_path / "state"), "300 SECOND")
    got = streams.arrived(spark, str(tmp_path / "out"))
    assert {(r.k, r.i, r.late) for r in got.collect()} == want and got.count() == 312 and done.lastProgress is not None
    assert 20 < got.where("late").count() < 300
    # a batch that Spark hands over again changes nothing
    stops = spark.read.parquet(list(snapshots.versions(spark, str(tmp_path / "out" / "stops")).values())[-1])
    assert not snapshots.publish(stops.limit(0), str(tmp_path / "out" / "stops"), 103)
    assert {r.det: r.stop.timestamp() for r in stops.collect()} == tops


def test_medians_of_skewed_groups_keep_parts_small(spark):
    rng = np.random.default_rng(0)
    values = {0: np.append(rng.random(20_000), 1e9), 1: np.array([1.0] * 9_000 + [2.0] * 9_001), 2: np.concatenate([-(10.0 ** rng.uniform(-300, 300, 5000)), 10.0 ** rng.uniform(-300, 300, 5001)]), 3: np.array([np.inf, 1.0, -np.inf, 2.0]), 4: np.array([3.0])}
    rows = [(k, float(x)) for k, v in values.items() for x in v] + [(4, float("nan")), (5, float("nan")), (4, None), (6, None)]
    df = spark.createDataFrame(rows, "k int, x double").repartition(5)
    for accuracy in (2, 50, 10_000):
        assert {r.k: r.x for r in exact_median(df, ["k"], "x", accuracy).collect()} == {k: float(np.median(v)) for k, v in values.items()}


def test_scans_over_bucket_borders(spark):
    rng = np.random.default_rng(2)
    rows = [(k, int(t), int(x) if x % 7 else None) for k in "ab" for t, x in zip(rng.choice(500, 120, replace=False), rng.integers(0, 50, 120))]
    df = bucketed(spark.createDataFrame(rows, "k string, t long, x long").repartition(4), "t", 16)
    got = {(r.k, r.t): (r.last, r.upto, r.n) for r in with_rank(with_running_sum(with_previous(df, ["k"], "t", "x", "last"), ["k"], "t", "x", "upto"), ["k"], "t", "n").collect()}
    for k in "ab":
        last, upto = None, 0
        for n, (_, t, x) in enumerate(sorted(r for r in rows if r[0] == k), 1):
            upto += x or 0
            assert got[k, t] == (last, upto, n)
            last = x


def test_no_stream_is_ordered_in_one_task(spark):
    one = spark.range(10).select(F.lit("a").alias("stream"), F.lit("o").alias("obs_id"), F.col("id").alias("t"), F.col("id").alias("sample_idx"), (F.col("id") * 50.0 % 360).alias("az"), (F.col("id") * 1.0).alias("ra_bore"))
    for df, key in ((align.unwrap(one, "az", bucket=4), "stream"), (recon.scan_direction(one, 4), "obs_id")):
        windows = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
        alone = [line for line in windows if "__bucket" not in line.split("], [")[1]]
        assert windows and all("lag(__end" in line or "sum(__sum" in line for line in alone), alone
    got = [r.az for r in align.unwrap(one, "az", bucket=4).orderBy("t").collect()]
    assert got == pytest.approx([50.0 * k for k in range(10)])


def test_housekeeping_blocks_are_merged_and_faults_reported(spark):
    nan = float("nan")
    rows = [(1, 5.0, 10.0, 1.0), (0, 3.0, 9.0, 1.0), (1, 1.0, 8.0, 1.0), (0, 5.0, 10.0, 1.0), (0, 7.0, 1.0, 2.0), (1, 7.0, 1.5, 2.0), (0, 9.0, nan, 2.0), (0, 11.0, 360.0, 2.0), (0, 13.0, 1.0, 90.5), (0, 15.0, None, 1.0), (1, 17.0, 0.0, -90.0)]
    hk = spark.createDataFrame(rows, "block int, t double, az double, el double").repartition(3)
    assert [tuple(r) for r in align.order_housekeeping(hk, 4.0).orderBy("seq").collect()] == [(1, 1.0, 8.0, 1.0), (2, 3.0, 9.0, 1.0), (3, 5.0, 10.0, 1.0), (4, 17.0, 0.0, -90.0)]
    assert {tuple(r) for r in align.housekeeping_problems(hk).collect()} == {(5.0, "repeated", 2), (7.0, "contradicting values", 2), *((t, "no pointing", 1) for t in (9.0, 11.0, 13.0, 15.0))}


def test_apparent_place_of_theta_persei():
    """A worked example of the literature: 2028 November 13.19, equator of 2000 to apparent place, within an arc second."""
    t = np.array([(2462088.69 - 2451545.0) / 36525])
    vec = lambda ra, dec: np.array([[np.cos(np.radians(dec)) * np.cos(np.radians(ra))], [np.cos(np.radians(dec)) * np.sin(np.radians(ra))], [np.sin(np.radians(dec))]])
    away = lambda a, b: np.degrees(np.linalg.norm(a - b)) * 3600
    rest, seen = vec(41.054063, 49.227750), vec(15 * (2 + 46 / 60 + 14.390 / 3600), 49 + 21 / 60 + 7.45 / 3600)
    assert away(arrays.icrs_to_apparent(rest, t), seen) < 1 and away(arrays.apparent_to_icrs(seen, t), rest) < 1
    assert away(arrays.apparent_to_icrs(arrays.icrs_to_apparent(rest, t), t), rest) < 1e-6


def test_batched_fits_of_many_cut_outs():
    rng = np.random.default_rng(4)
    x, y = np.meshgrid(np.arange(7.0), np.arange(7.0))
    p = np.stack([rng.uniform(1, 9, 40), rng.uniform(2, 4, 40), rng.uniform(2, 4, 40), rng.uniform(0.8, 2, 40), rng.uniform(-5, 5, 40)], axis=1)
    one = np.ones((40, 1))
    xs, ys = one * x.ravel(), one * y.ravel()
    z = p[:, :1] * np.exp(-((xs - p[:, 1:2]) ** 2 + (ys - p[:, 2:3]) ** 2) / (2 * p[:, 3:4] ** 2)) + p[:, 4:]
    assert arrays.gauss2d_fits(xs, ys, z, 1.0) == pytest.approx(p, abs=1e-6)
    flat = arrays.gauss2d_fits(xs[:2], ys[:2], np.zeros((2, 49)), 1.0)
    assert np.isfinite(flat).all()
