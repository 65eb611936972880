"""Served views, edits and audits over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.functions import dates
from lotscout.functions.text import nfc_strip
from lotscout.operators import serve
from lotscout.plans import serving
from lotscout.queries.registry import Tables, query
from lotscout.queries.relational import _ZSCORES, _importance, _LISTED
from lotscout.queries.roles import Role
from lotscout.sources import schemas
from lotscout.sources.manifest import Table
from lotscout.sources.snapshot import LEVELS, latest_snapshot, new_path, stage_table

TARGET = "경기 가시"
_NEWEST = """(year, month, week) = (SELECT (year, month, week) FROM served WHERE region = '경기'
  ORDER BY year DESC, month DESC, week DESC LIMIT 1)"""


@query(f"SELECT name, total, year, month, week FROM served WHERE region = '경기' AND {_NEWEST}")
def latest_snapshot_scan(t: Tables) -> DataFrame:
    newest = latest_snapshot(t.served, where=F.col("region") == "경기")
    return newest.select("name", "total", "year", "month", "week")


_TOP_COLUMNS = [
    "name", "road_address", "latitude", "longitude", "total", "profitability", "suitability",
    "parking", "idle_area", "contract_status", "remarks", "year", "month", "week",
]


@query(
    f"""SELECT {", ".join(_TOP_COLUMNS)}, CAST(row_number() OVER (ORDER BY total DESC NULLS LAST, name, road_address, idle_area DESC NULLS LAST, remarks NULLS FIRST) AS INTEGER) AS rank
FROM served WHERE region = '경기' AND {_NEWEST} AND sigungu LIKE '%시%' ORDER BY rank LIMIT 15"""
)
def top_sites(t: Tables) -> DataFrame:
    return serve.top_sites(t.served, "경기 시").select(*_TOP_COLUMNS, "rank")


def _letter(score: str) -> str:
    return f"CASE WHEN {score} >= 0.8e0 THEN 'A' WHEN {score} >= 0.6e0 THEN 'B' WHEN {score} >= 0.4e0 THEN 'C' WHEN {score} >= 0.2e0 THEN 'D' ELSE 'E' END"


@query(
    f"""SELECT CAST(row_number() OVER (ORDER BY total DESC NULLS LAST, name, road_address, idle_area DESC NULLS LAST, remarks NULLS FIRST) AS INTEGER) AS rank,
  name, CAST(round_even(total, 0) AS BIGINT) AS total, {_letter("profitability")} AS profitability, {_letter("suitability")} AS suitability,
  CASE parking WHEN 5 THEN 'A' WHEN 4 THEN 'B' WHEN 3 THEN 'C' WHEN 2 THEN 'D' WHEN 1 THEN 'E' END AS parking, contract_status, remarks
FROM served WHERE region = '경기' AND {_NEWEST} AND sigungu LIKE '%시%' ORDER BY rank LIMIT 15"""
)
def site_grid(t: Tables) -> DataFrame:
    return serve.site_grid(serve.top_sites(t.served, "경기 시"))


@query(
    f"""SELECT {", ".join(_TOP_COLUMNS)} FROM served WHERE region = '경기' AND {_NEWEST} AND sigungu LIKE '%시%'
  AND contract_status <> '후보'"""
)
def active_contracts(t: Tables) -> DataFrame:
    return serve.active_contracts(t.served, "경기 시").select(*_TOP_COLUMNS)


@query(
    f"""WITH {_ZSCORES} SELECT sido, sigungu, cargo_count, round(0.6e0 * outer_z + 0.4e0 * inner_z, 6) AS importance,
  CAST(row_number() OVER (ORDER BY round(0.6e0 * outer_z + 0.4e0 * inner_z, 6) DESC NULLS LAST, sido, sigungu) AS INTEGER) AS rank
FROM z WHERE NOT ({_LISTED}) ORDER BY rank LIMIT 10"""
)
def top_districts(t: Tables) -> DataFrame:
    districts = _importance(t).withColumn("importance", F.round("importance", 6))
    return serve.top_districts(districts).drop("shp_code")


# Vehicle counts per district and month, one row per order; some districts have no code.
_DISTRICTS = Role(
    "orders",
    {
        "sigungu": "CAST(o_custkey AS STRING)",
        "shp_code": "CASE WHEN o_custkey % 10 = 3 THEN NULL ELSE CAST(41000 + o_custkey % 30 AS STRING) END",
        "cargo_count": "o_orderkey",
        "year": "CAST(year(o_orderdate) AS STRING)",
        "month": "lpad(CAST(month(o_orderdate) AS STRING), 2, '0')",
    },
)


@query(
    f"""WITH districts AS ({_DISTRICTS.sql()}) SELECT d.sigungu, d.shp_code, d.cargo_count, n_name FROM districts d
JOIN nation ON d.shp_code = CAST(41000 + n_nationkey AS VARCHAR)
WHERE (year, month) = (SELECT (year, month) FROM districts ORDER BY year DESC, month DESC LIMIT 1)"""
)
def district_attr_join(t: Tables) -> DataFrame:
    shapes = t.nation.select((41000 + F.col("n_nationkey")).alias("shp_code"), "n_name")
    rows = _DISTRICTS.frame(t.spark, t.sf_dir)
    return serve.district_map(rows, shapes).select("sigungu", "shp_code", "cargo_count", "n_name")


@query(
    "SELECT c_name AS lot_name, CAST(c_acctbal AS DOUBLE) AS lat, c_custkey * 1e0 AS lon FROM customer "
    "WHERE c_acctbal >= 0 AND c_custkey % 7 <> 0"
)
def public_lots(t: Tables) -> DataFrame:
    lots = t.customer.select(
        F.col("c_name").alias("lot_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("lat"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey").cast("double")).alias("lon"),
    )
    return serve.located(lots)


_LATEST_EDITS = """SELECT * FROM edit_log QUALIFY row_number() OVER (PARTITION BY name, road_address ORDER BY ts DESC, event_id DESC) = 1"""


@query(
    f"""SELECT s.* REPLACE (CASE WHEN e.name IS NULL THEN s.total ELSE round(suitability * profitability * (e.parking / 5e0) * 100, 6) END AS total,
  CASE WHEN e.name IS NULL THEN s.parking ELSE e.parking END AS parking,
  CASE WHEN e.name IS NULL THEN s.contract_status ELSE e.contract_status END AS contract_status,
  CASE WHEN e.name IS NULL THEN s.remarks ELSE e.remarks END AS remarks)
FROM served s LEFT JOIN ({_LATEST_EDITS}) e ON s.name = e.name AND s.road_address = e.road_address"""
)
def rescore_with_edits(t: Tables) -> DataFrame:
    edits = serve.latest_edits(t.edit_log, ["name", "road_address"], ["ts", "event_id"])
    return serve.apply_edits(t.served, stage_table(edits, "edits")).withColumn("total", F.round("total", 6))


_SHOWN = Role(
    "orders",
    {
        "o_orderkey": "o_orderkey",
        "status": "o_orderstatus",
        "grade": "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(o_custkey % 5 AS INT) END",
        "remarks": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END",
    },
)
_EDITED = Role(
    "orders",
    {
        "o_orderkey": "o_orderkey",
        "status": "CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END",
        "grade": "CASE WHEN o_custkey % 4 = 0 AND o_orderkey % 13 <> 0 THEN NULL ELSE CAST(o_custkey % 5 AS INT) END",
        "remarks": "CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END",
    },
)


@query(
    f"""SELECT e.* FROM ({_EDITED.sql()}) e JOIN ({_SHOWN.sql()}) s ON e.o_orderkey = s.o_orderkey
WHERE e.status IS DISTINCT FROM s.status OR e.grade IS DISTINCT FROM s.grade OR e.remarks IS DISTINCT FROM s.remarks"""
)
def changed_rows(t: Tables) -> DataFrame:
    shown, edited = (r.frame(t.spark, t.sf_dir) for r in (_SHOWN, _EDITED))
    return serve.changed_rows(shown, edited, ["o_orderkey"], ["status", "grade", "remarks"])


@query(
    "SELECT user_id, ts, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)
def last_value_per_key(t: Tables) -> DataFrame:
    return serve.last_value(t.events, "user_id", ["ts", "event_id"], "event_type")


_ALL_COLUMNS = schemas.SERVED_SITE.fieldNames()
_OTHERS = [c for c in _ALL_COLUMNS if c not in (*schemas.SITE_KEY, "total")]
# one month a year, so that the served table has some hundred parts instead of thousands
_YEARLY = "SELECT * REPLACE (12 AS month) FROM served"
_JUDGED = f"""SELECT *, CASE WHEN row_number() OVER (PARTITION BY {", ".join(schemas.SITE_KEY)}
  ORDER BY total DESC NULLS LAST, {", ".join(f"{c} NULLS FIRST" for c in _OTHERS)}) > 1 THEN 'repeated key' END AS reason
FROM ({_YEARLY})"""


def _yearly(t: Tables) -> DataFrame:
    return t.served.withColumn("month", F.lit(12)).select(*_ALL_COLUMNS)


@query(
    f"""SELECT {", ".join(_TOP_COLUMNS)}, CAST(row_number() OVER (ORDER BY total DESC NULLS LAST, name, road_address, idle_area DESC NULLS LAST, remarks NULLS FIRST) AS INTEGER) AS rank
FROM served WHERE region = '경기' AND {_NEWEST} AND sigungu LIKE '%시%' ORDER BY rank LIMIT 15"""
)
def served_lookup(t: Tables) -> DataFrame:
    """The best sites of a district from a table whose manifest names the newest snapshot of its region."""
    table = Table(t.spark, new_path(t.spark, "served"))
    table.replace(_yearly(t), LEVELS, ("region",))
    return serve.top_sites(table, "경기 시").select(*_TOP_COLUMNS, "rank")


@query(f"SELECT {', '.join(_ALL_COLUMNS)}, reason FROM ({_JUDGED})")
def enforced_keys(t: Tables) -> DataFrame:
    """Every row with the reason why it is not served."""
    return serving.judge(_yearly(t))


@query(
    f"""SELECT s.* EXCLUDE (reason) REPLACE (CASE WHEN e.name IS NULL THEN s.total ELSE round(suitability * profitability * (e.parking / 5e0) * 100, 6) END AS total,
  CASE WHEN e.name IS NULL THEN s.parking ELSE e.parking END AS parking,
  CASE WHEN e.name IS NULL THEN s.contract_status ELSE e.contract_status END AS contract_status,
  CASE WHEN e.name IS NULL THEN s.remarks ELSE e.remarks END AS remarks)
FROM ({_JUDGED}) s LEFT JOIN ({_LATEST_EDITS}) e ON s.name = e.name AND s.road_address = e.road_address WHERE reason IS NULL"""
)
def edits_over_loads(t: Tables) -> DataFrame:
    """Snapshots loaded, edited, and those of the last year loaded once more: the edits are still there."""
    served = new_path(t.spark, "served")
    rows = _yearly(t)
    serving.load(rows, served)
    edits = t.edit_log.withColumnsRenamed({"ts": "edited_at", "event_id": "edit_id"})
    serving.record_edits(served, edits)
    serving.load(rows.filter(F.col("year") == 2000), served)
    return Table(t.spark, served).read().withColumn("total", F.round("total", 6))


@query(
    "SELECT name, road_address, year, month, week, count(*) AS n FROM served GROUP BY ALL HAVING count(*) > 1"
)
def pk_duplicates(t: Tables) -> DataFrame:
    return serve.pk_duplicates(t.served)


@query(
    """SELECT e.year, e.month, coalesce(n, 0) AS n_rows, coalesce(n, 0) > 0 AS complete FROM
  (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders) e
LEFT JOIN (SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders
  WHERE o_totalprice > 499000 GROUP BY ALL) f ON e.year = f.year AND e.month = f.month"""
)
def snapshot_completeness(t: Tables) -> DataFrame:
    stamp = dates.snapshot_stamp(F.col("o_orderdate"), weekly=False)
    stamped = t.orders.select("o_totalprice", *[c.alias(k) for k, c in stamp.items()])
    landed = stamped.filter(F.col("o_totalprice") > 499000)
    return serve.completeness(landed, stamped.select(*stamp).distinct(), list(stamp))


_RAW_SITES = Role(
    "orders",
    {
        "sigungu": "'x' || CAST(o_custkey % 25 AS STRING)",
        "total": "CASE WHEN o_orderkey % 7 = 0 THEN 'NaN' WHEN o_orderkey % 11 = 0 THEN '' ELSE CAST(o_orderkey AS STRING) || '.25' END",
        "suitability": "CAST(NULL AS DOUBLE)",
        "fit": "CAST(o_orderkey % 5 AS DOUBLE)",
        "parking": "CASE WHEN o_orderkey % 6 = 0 THEN 'x' ELSE CAST(o_orderkey % 5 AS STRING) || '.0' END",
        "name": "CASE WHEN o_orderkey % 19 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN NULL ELSE ' 각 ' || CAST(o_orderkey AS STRING) END",
        "place": "CAST(o_custkey AS STRING)",
        "extra": "o_orderstatus",
        "region": "'경기'",
    },
)


@query(
    f"""SELECT sigungu, CASE WHEN isnan(TRY_CAST(total AS DOUBLE)) THEN NULL ELSE TRY_CAST(total AS DOUBLE) END AS total,
  fit AS suitability, NULL::DOUBLE AS profitability, CAST(trunc(TRY_CAST(parking AS DOUBLE)) AS INTEGER) AS parking,
  trim(nfc_normalize(name)) AS name, place AS road_address, NULL::DOUBLE AS idle_area, NULL::DOUBLE AS longitude,
  NULL::DOUBLE AS latitude, region, 2024 AS year, 5 AS month, 2 AS week, '후보' AS contract_status, NULL::VARCHAR AS remarks
FROM ({_RAW_SITES.sql()}) WHERE name IS NOT NULL AND name <> '' AND place IS NOT NULL"""
)
def conform_schema(t: Tables) -> DataFrame:
    rows = schemas.conform(
        _RAW_SITES.frame(t.spark, t.sf_dir),
        schemas.SERVED_SITE,
        stamp={"year": F.lit(2024), "month": F.lit(5), "week": F.lit(2)},
        aliases={"fit": "suitability", "place": "road_address"},
        defaults={"contract_status": F.lit(schemas.DEFAULT_STATUS)},
    )
    keyed = schemas.require_text(rows, ["name", "road_address"])
    return keyed.withColumn("name", nfc_strip("name"))
