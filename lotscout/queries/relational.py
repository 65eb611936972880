"""Filters, joins, aggregates and set operations over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.operators import aggregates, filters, joins, latest
from lotscout.plans import clean, regional
from lotscout.plans.stages import PARKABLE
from lotscout.queries import oracle
from lotscout.queries.registry import Tables, query
from lotscout.sources.snapshot import stage_table


@query(
    "SELECT parcel_id, dong, category, land_area FROM bronze_parcel "
    "WHERE TRY_CAST(owner_code AS INTEGER) = 1 AND category IN ('대', '잡종지', '주차장') AND change_date IS NOT NULL"
)
def filter_land(t: Tables) -> DataFrame:
    private = F.col("owner_code").try_cast("int") == 1
    kept = t.bronze_parcel.filter(private & F.col("category").isin(*PARKABLE))
    return filters.present(kept, "change_date").select("parcel_id", "dong", "category", "land_area")


@query(
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders "
    "WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - INTERVAL 30 DAY"
)
def changed_recently(t: Tables) -> DataFrame:
    days = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return filters.changed_since(days, "day", dt.date(2001, 8, 1), 30)


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE NOT EXISTS ("
    "SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal < 0)"
)
def exclude_pairs_anti(t: Tables) -> DataFrame:
    listed = t.supplier.filter(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("l_suppkey"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.without_pairs(rows, listed, ["l_suppkey"])


@query("SELECT parcel_id, road_address, a.region, x, y FROM clean_address a LEFT JOIN clean_coord c USING (road_address)")
def join_left_coord(t: Tables) -> DataFrame:
    address, coord = clean.clean_address(t.bronze_address), clean.clean_coord(t.bronze_coord)
    joined = joins.left_join_one(address, coord, ["road_address"])
    return joined.select("parcel_id", "road_address", "region", "x", "y")


@query(
    "SELECT o_orderkey, o_totalprice, l_linenumber, l_partkey, l_quantity FROM orders "
    "LEFT JOIN lineitem ON o_orderkey = CASE WHEN l_quantity <= 15 THEN l_orderkey ELSE -l_orderkey END"
)
def join_left_building(t: Tables) -> DataFrame:
    # large items belong to no order, so that orders have no, one or many
    key = F.when(F.col("l_quantity") <= 15, F.col("l_orderkey")).otherwise(-F.col("l_orderkey"))
    items = t.lineitem.select(key.alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    parents = t.orders.select("o_orderkey", "o_totalprice")
    return joins.left_join_many(parents, items, ["o_orderkey"])


@query(
    "SELECT o_orderkey, o_totalprice, l_linenumber, l_partkey, l_quantity FROM orders "
    "LEFT JOIN lineitem ON o_orderkey = CASE WHEN l_quantity <= 15 THEN l_orderkey ELSE -l_orderkey END"
)
def join_left_plain(t: Tables) -> DataFrame:
    # large items belong to no order, so that orders have no, one or many
    key = F.when(F.col("l_quantity") <= 15, F.col("l_orderkey")).otherwise(-F.col("l_orderkey"))
    items = t.lineitem.select(key.alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    parents = t.orders.select("o_orderkey", "o_totalprice")
    return joins.left_join(parents, items, ["o_orderkey"])


@query(
    "SELECT o_orderkey, c_name, c_nationkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 "
    "WHERE c_custkey IS NOT NULL"
)
def join_inner_geo(t: Tables) -> DataFrame:
    places = t.customer.filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"
    )
    return t.orders.join(places, "o_custkey").select("o_orderkey", "c_name", "c_nationkey")


@query(
    """SELECT o_orderkey, o_totalprice, pk, l_quantity FROM orders
LEFT JOIN (SELECT *, CASE WHEN l_quantity <= 15 THEN l_partkey || '/' || l_suppkey END AS pk FROM lineitem) ON o_orderkey = l_orderkey
WHERE o_orderkey IN (SELECT o_orderkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_quantity <= 15
  GROUP BY o_orderkey HAVING count(l_orderkey) <= 1)"""
)
def single_building(t: Tables) -> DataFrame:
    items = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_quantity") <= 15, F.concat_ws("/", "l_partkey", "l_suppkey")).alias("pk"),
        "l_quantity",
    )
    parents = t.orders.select("o_orderkey", "o_totalprice")
    return joins.with_single_child(parents, items, "o_orderkey", "pk")


@query(
    """SELECT o_orderkey, o_custkey, big FROM (SELECT *, CASE WHEN o_totalprice > 450000 THEN o_orderstatus END AS big FROM orders)
WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000 AND o_orderstatus IS NOT NULL)"""
)
def group_semi(t: Tables) -> DataFrame:
    big = F.when(F.col("o_totalprice") > 450000, F.col("o_orderstatus")).alias("big")
    rows = t.orders.select("o_orderkey", "o_custkey", big)
    groups = stage_table(joins.groups_with(rows, ["o_custkey"], "big"), "marked_groups")
    return joins.in_groups(rows, groups, ["o_custkey"])


@query(
    """SELECT p.parcel_id, p.change_date, o.owner FROM clean_parcel p JOIN owners o ON p.dong = o.address
  AND p.lot_main = o.lot_main AND p.change_date = o.change_date AND p.region = o.region"""
)
def join_owner(t: Tables) -> DataFrame:
    key = ["dong", "lot_main", "change_date"]
    owners = latest.first_per_key(t.ownership.withColumnRenamed("address", "dong"), key)
    parcels = clean.clean_parcel(t.bronze_parcel)
    return parcels.join(owners.drop("lot_sub"), [*key, "region"]).select(
        "parcel_id", "change_date", "owner"
    )


@query(
    """SELECT d.l_partkey, d.l_suppkey, d.l_returnflag, round(a.qty, 6) AS qty FROM
  (SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem WHERE l_returnflag <> 'N') d
LEFT JOIN (SELECT l_partkey, l_suppkey, sum(q) AS qty FROM (SELECT l_partkey, l_suppkey, l_linenumber, max(l_quantity) AS q
  FROM lineitem GROUP BY ALL) GROUP BY ALL) a ON d.l_partkey = a.l_partkey AND d.l_suppkey = a.l_suppkey"""
)
def gold_join_area(t: Tables) -> DataFrame:
    group = ["l_partkey", "l_suppkey"]
    # not written first: the distinct detail has only a few rows per key, so no key is hot
    area = aggregates.max_then_sum(t.lineitem, group, "l_linenumber", "l_quantity", "qty")
    detail = t.lineitem.filter(F.col("l_returnflag") != "N").select(*group, "l_returnflag")
    joined = joins.left_join_one(detail.dropDuplicates(), area, group)
    return joined.withColumn("qty", F.round("qty", 6))


@query(
    """SELECT c_custkey, c_nationkey, code FROM customer LEFT JOIN (SELECT n_nationkey, CAST(41000 + n_nationkey AS VARCHAR) AS code
  FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey"""
)
def code_map_join(t: Tables) -> DataFrame:
    codes = t.nation.filter(F.col("n_regionkey") != 2).select(
        F.col("n_nationkey").alias("c_nationkey"), (41000 + F.col("n_nationkey")).alias("code")
    )
    return joins.map_codes(t.customer.select("c_custkey", "c_nationkey"), codes, ["c_nationkey"])


@query(
    "SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)"
)
def code_map_unmatched(t: Tables) -> DataFrame:
    codes = t.nation.filter(F.col("n_regionkey") != 2).select(F.col("n_nationkey").alias("c_nationkey"))
    return joins.unmapped(t.customer, codes, ["c_nationkey"])


@query(
    "SELECT o_custkey, o_orderstatus, min(CAST(o_orderkey AS VARCHAR)) AS smallest FROM orders GROUP BY ALL"
)
def crawl_groups(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_custkey", "o_orderstatus", F.col("o_orderkey").cast("string").alias("smallest")
    )
    return aggregates.smallest_per_group(rows, ["o_custkey", "o_orderstatus"], "smallest")


@query(
    """SELECT l_suppkey, l_returnflag, round(sum(largest), 6) AS area FROM (SELECT l_suppkey, l_returnflag, l_linenumber,
  max(l_extendedprice) AS largest FROM lineitem GROUP BY ALL) GROUP BY ALL"""
)
def area_two_level(t: Tables) -> DataFrame:
    group = ["l_suppkey", "l_returnflag"]
    area = aggregates.max_then_sum(t.lineitem, group, "l_linenumber", "l_extendedprice", "area")
    return area.withColumn("area", F.round("area", 6))


_COUNTS = """SELECT r_name AS sido, n_name || '/' || c_mktsegment AS sigungu, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""


def _district_counts(t: Tables) -> DataFrame:
    """Registered counts as a statistics sheet prints them: text with commas, total rows mixed in."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    customers = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    counts = customers.groupBy(
        F.col("r_name").alias("sido"), F.concat_ws("/", "n_name", "c_mktsegment").alias("sigungu")
    ).agg(F.count("*").alias("n"))
    totals = counts.groupBy("sido").agg(F.lit("합계").alias("sigungu"), F.sum("n").alias("n"))
    sheet = counts.unionByName(totals)
    return sheet.select(
        F.concat(F.lit(" "), "sido").alias("sido"),
        "sigungu",
        F.format_number("n", 0).alias("cargo_count"),
    )


_ZSCORES = f"""counts AS ({_COUNTS}), provinces AS (SELECT sido, sum(n) AS total FROM counts GROUP BY sido),
national AS (SELECT avg(total) AS m, stddev_samp(total) AS s FROM provinces),
z AS (SELECT c.sido, sigungu, CAST(n AS DOUBLE) AS cargo_count,
  coalesce((n - avg(n) OVER w) / nullif(stddev_samp(n) OVER w, 0), 0) AS inner_z,
  (total - (SELECT m FROM national)) / nullif((SELECT s FROM national), 0) AS outer_z
FROM counts c JOIN provinces p ON c.sido = p.sido WINDOW w AS (PARTITION BY c.sido))"""
_LISTED = "sido = 'ASIA' AND sigungu = 'NATION_7/BUILDING' OR sido = 'EUROPE' AND sigungu = 'NATION_8/MACHINERY'"
_CODES = "SELECT r_name AS sido, n_name || '/BUILDING' AS sigungu, CAST(41000 + n_nationkey AS VARCHAR) AS shp_code FROM nation JOIN region ON n_regionkey = r_regionkey"


def _importance(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    codes = nations.select(
        F.col("r_name").alias("sido"),
        F.concat(F.col("n_name"), F.lit("/BUILDING")).alias("sigungu"),
        (41000 + F.col("n_nationkey")).alias("shp_code"),
    )
    listed = nations.select(
        F.col("r_name").alias("sido"),
        F.when(F.col("n_nationkey") == 7, "NATION_7/BUILDING")
        .when(F.col("n_nationkey") == 8, "NATION_8/MACHINERY")
        .alias("sigungu"),
    ).filter(F.col("sigungu").isNotNull())
    sheet = stage_table(_district_counts(t), "district_counts")
    return regional.regional_importance(sheet, codes, listed)


@query(
    f"""WITH {_ZSCORES} SELECT z.sido, z.sigungu, shp_code, cargo_count, round(0.6e0 * outer_z + 0.4e0 * inner_z, 6) AS importance
FROM z LEFT JOIN ({_CODES}) c ON z.sido = c.sido AND z.sigungu = c.sigungu WHERE NOT (z.{_LISTED.replace("sigungu", "z.sigungu").replace("OR sido", "OR z.sido")})"""
)
def regional_zscore(t: Tables) -> DataFrame:
    return _importance(t).withColumn("importance", F.round("importance", 6))


@query("SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def dedup_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus").dropDuplicates()


_LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@query(oracle.first_per_key("lineitem", _LINE_COLUMNS, ["l_orderkey", "l_linenumber"]))
def dedup_subset(t: Tables) -> DataFrame:
    rows = t.lineitem.select(*_LINE_COLUMNS)
    return latest.first_per_key(rows, ["l_orderkey", "l_linenumber"])


@query(
    """SELECT o_custkey, day, o_orderkey, o_totalprice FROM (SELECT o_custkey, o_orderkey, o_totalprice,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC NULLS LAST, o_orderkey DESC) = 1"""
)
def latest_per_parcel(t: Tables) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate").cast("date")).alias("day")
    versions = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", day)
    return latest.latest_per_key(versions, ["o_custkey"], ["day"]).select(
        "o_custkey", "day", "o_orderkey", "o_totalprice"
    )


@query(
    """SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS price, NULL::VARCHAR AS name FROM orders
UNION ALL SELECT c_custkey, NULL, NULL, c_name FROM customer"""
)
def union_pad(t: Tables) -> DataFrame:
    orders = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("price"),
    )
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return joins.union_padded(orders, customers)


@query(
    """SELECT DISTINCT address, lot_main, lot_sub, change_date FROM (SELECT dong AS address, lot_main, lot_sub, change_date
  FROM clean_parcel) w WHERE NOT EXISTS (SELECT 1 FROM ownership d WHERE d.address = w.address AND d.lot_main = w.lot_main
  AND d.lot_sub IS NOT DISTINCT FROM w.lot_sub AND d.change_date IS NOT DISTINCT FROM w.change_date AND d.owner LIKE '%*%')"""
)
def pending_groups(t: Tables) -> DataFrame:
    key = ["address", "lot_main", "lot_sub", "change_date"]
    wanted = clean.clean_parcel(t.bronze_parcel).withColumnRenamed("dong", "address")
    done = t.ownership.filter(F.col("owner").contains("*"))
    return joins.pending(wanted.select(*key).distinct(), done.select(*key), key)
