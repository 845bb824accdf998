"""Registration of queries with their SQL, and the SQL of the adapters that they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.binning import Grid

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

EVENTS_GRID = Grid(9.875, 19.975, 0.05, 0.05, 24, 12)
LINES_GRID = Grid(10.0, 20.0, 0.05, 0.05, 40, 30)


#: Means of amounts in cents often end in an exact half, where engines that add in another order round either way: so
#: that all round up, what is within this share of the last digit below a half goes up as well.
OFF_HALF = 0.01


def steady(sql: str) -> str:
    """The SQL with each round(x, n) taken of a double, halves up."""
    out, at = [], 0
    while (k := sql.find("round(", at)) >= 0:
        depth, i, comma = 1, k + 6, -1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            comma = i if sql[i] == "," and depth == 1 else comma
            i += 1
        inner, n = steady(sql[k + 6 : comma]), int(sql[comma + 1 : i - 1])
        out += [sql[at:k], f"round(CAST({inner} AS DOUBLE) + {OFF_HALF}e-{n}, {n})"]
        at = i
    return "".join(out) + sql[at:]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows if there is any."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = steady(sql)
        return f

    return put


def r(c: str | Column, n: int = 6) -> Column:
    """Rounded with halves up, as steady() does it, without a negative zero."""
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(OFF_HALF * 10.0**-n), n) + F.lit(0.0)


def rounded(df: DataFrame, n: int = 6) -> DataFrame:
    """Doubles rounded, for comparison between engines that add in different orders."""
    return df.select(*(r(c, n).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes))


TOD = """
cells AS (SELECT event_type AS det, CAST(floor((epoch_us(ts) / 1e6 - 1704067200) / 1800) AS BIGINT) AS sample_idx, avg(value) AS signal,
    max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS top_k FROM events GROUP BY 1, 2),
dets AS (SELECT det, CAST(row_number() OVER (ORDER BY det) - 1 AS INTEGER) AS det_idx FROM (SELECT DISTINCT event_type AS det FROM events)),
grid AS (SELECT det, det_idx, sample_idx FROM dets CROSS JOIN (SELECT unnest(range(least(0, CAST(floor(min(sample_idx) / 48) AS BIGINT)) * 48, (CAST(floor(max(sample_idx) / 48) AS BIGINT) + 1) * 48)) AS sample_idx FROM cells)),
tod0 AS (SELECT sample_idx // 48 AS chunk_index, sample_idx, 1704067200.0::DOUBLE + sample_idx * 1800.0::DOUBLE AS t, det, det_idx, signal,
    CASE WHEN top_k >= 97 THEN 4 ELSE 0 END AS flags, 10.0::DOUBLE + 0.05::DOUBLE * (sample_idx % 20) AS ra_bore, 20.0::DOUBLE + 0.05::DOUBLE * ((sample_idx // 20) % 12) AS dec_bore
    FROM grid LEFT JOIN cells USING (det, sample_idx)),
tod AS (SELECT *, ra_bore + 0.05::DOUBLE * (det_idx - 2) AS ra, dec_bore AS dec FROM tod0)"""

DENSE = """
prices AS (SELECT l_orderkey AS sample_idx, CAST(l_linenumber - 1 AS INTEGER) AS det_idx, avg(l_extendedprice) AS price, max(CASE WHEN l_returnflag = 'R' AND l_quantity > 47 THEN 4 ELSE 0 END) AS flagged FROM lineitem GROUP BY 1, 2),
spots AS (SELECT o_orderkey AS sample_idx, o_totalprice, CAST(range AS INTEGER) AS det_idx FROM orders CROSS JOIN range(7)),
tod AS (SELECT sample_idx // 512 AS chunk_index, sample_idx, CAST(sample_idx AS DOUBLE) AS t, 'd' || det_idx AS det, det_idx, CASE WHEN (sample_idx * 7 + det_idx) % 97 >= 3 THEN coalesce(price, o_totalprice / 4) END AS signal, coalesce(flagged, 0) AS flags,
    10.0::DOUBLE + 0.05::DOUBLE * (sample_idx % 20) AS ra_bore, 20.0::DOUBLE + 0.05::DOUBLE * ((sample_idx // 20) % 12) AS dec_bore,
    10.0::DOUBLE + 0.05::DOUBLE * (sample_idx % 20) + 0.05::DOUBLE * (det_idx - 3) AS ra, 20.0::DOUBLE + 0.05::DOUBLE * ((sample_idx // 20) % 12) AS dec FROM spots LEFT JOIN prices USING (sample_idx, det_idx))"""

PX = "CAST(floor((ra - 9.875) / 0.05) AS INTEGER) AS ix, CAST(floor((dec - 19.975) / 0.05) AS INTEGER) AS iy"
ON_GRID = "ix BETWEEN 0 AND 23 AND iy BETWEEN 0 AND 11"

LINES = """
li AS (SELECT l_orderkey % 64 AS chunk_index, l_orderkey AS sample_idx, l_suppkey AS det_idx, l_extendedprice AS signal, CASE WHEN l_returnflag = 'R' THEN 4 ELSE 0 END AS flags,
    CAST(l_partkey % 40 AS INTEGER) AS ix, CAST(l_orderkey % 30 AS INTEGER) AS iy FROM lineitem)"""
#: A noise and a white-noise floor for each supplier, so that cuts and weights have many detectors to work on.
STATE = """
state AS (SELECT l_suppkey AS det_idx, 's' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS det, stddev_pop(l_extendedprice) * (1 + l_suppkey % 17) AS noise,
    CASE WHEN l_suppkey % 23 = 5 THEN NULL ELSE var_pop(l_quantity) * power(10, (l_suppkey % 7) / 4.0) END AS wnf FROM lineitem GROUP BY l_suppkey)"""
