"""Queries on tables as crowded as large ones, and on ties: each against its SQL."""

import datetime
import re

import duckdb
import pytest

from starloom.jobs.registry import QUERIES, SQL


def same(spark, sf_dir, name):
    """The query's rows, which are those of its SQL."""
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in sf_dir.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS FROM '{p}'")
    con.execute(f"CREATE TABLE want AS {SQL[name]}")
    columns = [c[0] for c in con.execute("DESCRIBE want").fetchall()]
    got = sorted((tuple(r[c] for c in columns) for r in QUERIES[name](spark, str(sf_dir)).collect()), key=repr)
    assert got == sorted(con.execute("FROM want").fetchall(), key=repr)
    return got


def put(sf_dir, name, columns, rows):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t ({columns})")
    con.executemany(f"INSERT INTO t VALUES ({', '.join('?' * len(rows[0]))})", rows)
    con.execute(f"COPY t TO '{sf_dir}/{name}.parquet'")


EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR"


@pytest.fixture(scope="module")
def flagged(tmp_path_factory):
    """Events so dense that each sample of each detector holds one that flags it."""
    at = tmp_path_factory.mktemp("flagged")
    start = datetime.datetime(2024, 1, 1)
    put(at, "events", EVENTS, [(i, start + datetime.timedelta(minutes=30 * (i // 5)), i, "abcde"[i % 5], float(i % 89), '{"k": 97}') for i in range(480)])
    return at


def test_no_extent_when_all_is_flagged(spark, flagged):
    assert same(spark, flagged, "automatic_grid") == [(None, None, None, None)]


@pytest.mark.parametrize("name", ["iterated_map", "iterated_convergence", "iterated_nulls"])
def test_runs_without_a_good_sample(spark, flagged, name):
    assert same(spark, flagged, name) == []


def test_centroids_broadcast_no_map(spark, tmp_path):
    """Maps that are made of few rows are not sent to all tasks; the threshold is Spark's own."""
    put(tmp_path, "supplier", "s_suppkey BIGINT, s_nationkey INTEGER, s_acctbal DOUBLE", [(k, k % 25, 10.0 * k) for k in range(40)])
    assert len(same(spark, tmp_path, "gaussian_centroids")) == 40
    plan = QUERIES["gaussian_centroids"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_azimuth_north_is_zero(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    put(tmp_path, "events", EVENTS, [(i, start + datetime.timedelta(minutes=7 * i), i, "abcde"[i % 5], 360.0 * (i % 4), "{}") for i in range(400)])
    assert {r[2] for r in same(spark, tmp_path, "altaz_there_and_back")} == {0.0}


def test_centre_when_all_is_flagged(spark, flagged):
    assert all(None not in row for row in same(spark, flagged, "map_centres"))


def test_overlap_without_a_good_sample(spark, flagged):
    assert same(spark, flagged, "null_overlap") == [(None, None, 0, True)]


LINEITEM = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag VARCHAR"


def test_strongest_of_equals(spark, tmp_path):
    put(tmp_path, "lineitem", LINEITEM, [(1000 - i, i, i % 7, 1, 1.0, 5.0 if i % 3 else 4.0, "N") for i in range(300)])
    assert len(same(spark, tmp_path, "strongest_samples")) == 20


@pytest.mark.parametrize("name", ["centroids_per_detector", "noisy_map_detectors"])
def test_pixels_are_summed_once(spark, tmp_path, name):
    """The sums that a median is taken of are those held against it; of sums made twice, the last digits may differ."""
    put(tmp_path, "lineitem", LINEITEM, [(i * 37 % 1000, i * 7, i % 7, 1, 1.0, 1000 / (1 + i % 11), "N") for i in range(3000)])
    same(spark, tmp_path, name)
    plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == (1 if name == "centroids_per_detector" else 2)


def forward(df):
    """Window frames that begin at a row and go on to the end of its group: they are gone through anew for each row."""
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    return [f for f in re.findall(r"specifiedwindowframe\(\w+, (\S+), unboundedfollowing", plan) if not f.startswith("unboundedpreceding")]


@pytest.mark.parametrize("name", ["as_of_brackets", "aligned_streams"])
def test_brackets_are_read_once(spark, flagged, name):
    same(spark, flagged, name)
    assert forward(QUERIES[name](spark, str(flagged))) == []


@pytest.mark.parametrize("name", ["dense_cleaned", "dense_spectra"])
def test_gaps_are_filled_in_one_pass(spark, tmp_path, name):
    put(tmp_path, "lineitem", LINEITEM, [(i * 37 % 1000, i * 7, i % 7, 1 + i % 7, 40.0 + i % 10, 1000 / (1 + i % 11), "NR"[i % 2]) for i in range(3000)])
    put(tmp_path, "orders", "o_orderkey BIGINT, o_totalprice DOUBLE", [(i, 10.0 * (i % 91)) for i in range(1024)])
    same(spark, tmp_path, name)
    assert forward(QUERIES[name](spark, str(tmp_path))) == []


def test_samples_are_not_dealt_by_detector(spark, tmp_path):
    put(tmp_path, "lineitem", LINEITEM, [(i, i * 7, i % 7, 1, 1.0, 1.0 + i % 11, "N") for i in range(3000)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")  # as where the detectors' own scan is large
    try:
        plan = QUERIES["fine_centroids"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [det_idx" in plan


def test_pixels_with_the_same_values_are_equal(spark, tmp_path):
    """Whatever the order the values come in, the peak is the first of equal pixels, and none of them lies below the median."""
    spots = [(1, [0.3, 0.2, 0.1]), (2, [0.1, 0.2, 0.3]), (3, [0.3, 0.2, 0.1]), (4, [0.1, 0.1, 0.1]), (5, [0.2, 0.3, 0.1])]
    for way in (1, -1):
        at = tmp_path / f"way{way}"
        at.mkdir()
        put(at, "lineitem", LINEITEM, [(30 * d, ix, d, 1, 1.0, k * x, "N") for d, k in ((1, 1), (2, 1000), (3, 333_333)) for ix, xs in spots for x in xs[::way]])
        got = sorted(QUERIES["centroids_per_detector"](spark, str(at)).collect())
        assert [(x.ix, round(x.snr, 4)) for x in got] == [(1, 2.0)] * 3
        assert QUERIES["noisy_map_detectors"](spark, str(at)).count() == 1


@pytest.mark.parametrize("missing", [False, True])
def test_runs_put_chunks_in_order_only_for_missing_samples(spark, tmp_path, monkeypatch, missing):
    from starloom.operators import mapmaking

    put(tmp_path, "lineitem", LINEITEM, [(i * 37 % 1000, i * 7, i % 7, 1, 1.0, None if missing and i == 5 else 1000 / (1 + i % 11), "N") for i in range(3000)])
    plans, stored = [], mapmaking._stored
    monkeypatch.setattr(mapmaking, "_stored", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stored(df, *a))
    run = QUERIES["iterated_map_lineitem"](spark, str(tmp_path))
    assert run.where("stage = -1").agg({"n_samples": "sum"}).first()[0] == 3000 - missing
    assert ("Window" in plans[0]) == missing
