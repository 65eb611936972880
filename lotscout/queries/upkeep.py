"""Hot spots, sheets, carried work and landed folders over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.operators import hotspots, serve, state
from lotscout.queries import oracle
from lotscout.queries.registry import Tables, query
from lotscout.queries.roles import Role
from lotscout.sources import gate, sheets
from lotscout.sources.manifest import Table
from lotscout.sources.snapshot import latest_snapshot, new_path, stage_table

# Trucks per customer, close together so that cells have neighbours; some have no place.
_POINTS = Role(
    "customer",
    {
        "sigungu_cd": "CAST(41000 + c_nationkey AS STRING)",
        "x": "CASE WHEN c_custkey % 97 <> 0 THEN CAST(900000 + (c_custkey * 37) % 20000 AS DOUBLE) END",
        "y": "CAST(1900000 + (c_custkey * 53) % 30000 AS DOUBLE)",
        "value": "CASE WHEN c_custkey % 89 <> 0 THEN CAST(c_custkey % 100 AS BIGINT) END",
    },
)
_CELL = 500.0
_HOTSPOTS = f"""(SELECT k.sigungu_cd, value, coalesce((value - mean) / nullif(deviation, 0), 0) AS z_score,
    (cx + 0.5e0) * {_CELL} AS x, (cy + 0.5e0) * {_CELL} AS y FROM
  (SELECT c.sigungu_cd, cx, cy, value FROM cells c JOIN around USING (cx, cy)) k JOIN
  (SELECT c.sigungu_cd, avg(value) AS mean, stddev_samp(value) AS deviation FROM cells c JOIN around USING (cx, cy)
   GROUP BY 1) d ON k.sigungu_cd = d.sigungu_cd)"""


@query(
    f"""WITH cells AS (SELECT sigungu_cd, floor(x / {_CELL}) AS cx, floor(y / {_CELL}) AS cy, CAST(sum(value) AS BIGINT) AS own
  FROM ({_POINTS.sql()}) WHERE x IS NOT NULL AND value IS NOT NULL GROUP BY ALL),
around AS (SELECT cx + dx AS cx, cy + dy AS cy, CAST(sum(own) AS BIGINT) AS value FROM cells, (VALUES (-1), (0), (1)) a(dx),
  (VALUES (-1), (0), (1)) b(dy) GROUP BY ALL)
SELECT sigungu_cd, value, round(z_score, 6) AS z_score, round(longitude, 6) AS lon, round(latitude, 6) AS lat
FROM ({oracle._projected(_HOTSPOTS, "sigungu_cd, value, z_score")})"""
)
def zone_hotspots(t: Tables) -> DataFrame:
    points = _POINTS.frame(t.spark, t.sf_dir)
    cells = stage_table(hotspots.cell_sums(points, _CELL, "sigungu_cd"), "cells")
    around = stage_table(hotspots.neighbourhoods(cells), "around")
    found = hotspots.zone_hotspots(cells, around, _CELL, "sigungu_cd")
    return found.select("sigungu_cd", "value", *(F.round(c, 6).alias(c) for c in ("z_score", "lon", "lat")))


_KEYS = ["lot", "region"]
_WANTED = "SELECT DISTINCT o_custkey AS lot, CASE WHEN o_custkey % 7 > 0 THEN o_orderstatus END AS region FROM orders WHERE"
_TRIED = """SELECT o_custkey AS lot, CASE WHEN o_custkey % 7 > 0 THEN o_orderstatus END AS region,
  CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 3 = 0 END AS ok FROM orders WHERE"""
_RUNS = {
    1: ("year(o_orderdate) <= 1995", "year(o_orderdate) = 1993"),
    2: ("year(o_orderdate) >= 1994", "year(o_orderdate) = 1996"),
    3: ("year(o_orderdate) >= 1995", "year(o_orderdate) = 1997"),
}


def _state_sql(run: int) -> str:
    wanted, tried = _RUNS[run]
    before = f"UNION ALL SELECT lot, region, false, attempts, fetched, first_run, last_try FROM state{run - 1}" if run > 1 else ""
    return f"""state{run} AS (SELECT lot, region, max(wanted) AS wanted, CAST(sum(attempts) AS BIGINT) AS attempts,
  max(fetched) AS fetched, min(first_run) AS first_run, max(last_try) AS last_try FROM (
  SELECT lot, region, true AS wanted, 0 AS attempts, false AS fetched, {run} AS first_run, NULL AS last_try FROM ({_WANTED} {wanted})
  UNION ALL SELECT lot, region, false, 1, coalesce(ok, false), {run}, {run} FROM ({_TRIED} {tried}) {before}) GROUP BY ALL)"""


@query(
    f"""WITH {", ".join(_state_sql(run) for run in _RUNS)} SELECT *, CASE WHEN fetched THEN 'fetched' WHEN attempts >= 5 THEN 'given up'
  WHEN attempts > 0 THEN 'failed' ELSE 'pending' END AS status FROM state3"""
)
def fetch_state(t: Tables) -> DataFrame:
    """Three runs, each from the written state of the one before."""
    t.orders.createOrReplaceTempView("orders")
    before = None
    for run, (wanted, tried) in _RUNS.items():
        rows = (t.spark.sql(f"{sql} {where}") for sql, where in ((_WANTED, wanted), (_TRIED, tried)))
        before = state.carried(before, *rows, _KEYS, F.lit(run))
        before = stage_table(before, "fetch-state") if run < max(_RUNS) else before
    return before


_NAMED = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(
    f"""SELECT * FROM (PIVOT (SELECT 2 + CAST(c_custkey % 50 AS INTEGER) AS row_no, r_name || '_' || n_name AS name,
  CAST(count(*) AS VARCHAR) AS n FROM {_NAMED} GROUP BY ALL) ON name USING first(n) GROUP BY row_no)"""
)
def stacked_header(t: Tables) -> DataFrame:
    """A sheet whose first row has each region once, over the nations of the second row."""
    place = (F.col("n_regionkey") * 100 + F.col("n_nationkey")).cast("int")
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).withColumn("col_no", place)
    upper = nations.groupBy("r_name").agg(F.min("col_no").alias("col_no"))
    counts = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    row_no = (2 + F.col("c_custkey") % 50).cast("int").alias("row_no")
    cells = [
        upper.select(F.lit(0).alias("row_no"), "col_no", F.col("r_name").alias("value")),
        nations.select(F.lit(1), "col_no", F.concat(F.lit(" "), "n_name")),
        counts.groupBy(row_no, "col_no").agg(F.count("*").cast("string").alias("value")),
    ]
    return sheets.table_of(stage_table(cells[0].union(cells[1]).union(cells[2]), "cells"), [0, 1])


@query(
    """SELECT e.year, e.month, coalesce(f.n, 0) > 0 AS complete FROM
  (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders) e
LEFT JOIN (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders
  WHERE o_totalprice > 499000 GROUP BY ALL) f ON e.year = f.year AND e.month = f.month"""
)
def landed_folders(t: Tables) -> DataFrame:
    """Months that have landed, by the folders in the store, of those that were expected."""
    at = {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    base = new_path(t.spark, "landed")
    rows = t.orders.select("o_orderkey", "o_totalprice", *(c.alias(k) for k, c in at.items()))
    Table(t.spark, base).replace(rows.filter(F.col("o_totalprice") > 499000), list(at))
    found = gate.landed(t.spark, base, list(at)).filter(F.col("complete") & (F.col("n_files") > 0))
    return serve.completeness(found, rows.select(*at).distinct(), list(at)).drop("n_rows")


@query(
    """SELECT name, total, year, week FROM served WHERE (year, week) = (SELECT (year, week) FROM served
  ORDER BY year DESC, week DESC LIMIT 1)"""
)
def latest_year_week(t: Tables) -> DataFrame:
    """Snapshots of a table without months."""
    return latest_snapshot(t.served, ("year", "week")).select("name", "total", "year", "week")
