"""The domain tables, derived row by row from the driver tables.

A role is a projection of one table, written in the part of SQL that Spark and DuckDB share, so
both sides of a check start from the same rows. Operators are never written here.

Parcel number k gives a parcel its place: four consecutive parcels form a lot group g, and 25
place codes d cycle over the groups. Customers are restaurants standing on parcel c_custkey, order
pairs are versions of a parcel, small line items are buildings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Role:
    """A projection of a table. With `parcel`, the columns k, g, d and h of that parcel number come
    first, so that the text built from them does not repeat their arithmetic."""

    table: str
    columns: dict[str, str]
    parcel: str | None = None

    def _base(self) -> list[str]:
        return ["*"] if self.parcel is None else ["*", *place_columns(self.parcel)]

    def _columns(self) -> list[str]:
        return [f"{sql} AS {name}" for name, sql in self.columns.items()]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        return rows.selectExpr(*self._base()).selectExpr(*self._columns())

    def sql(self) -> str:
        base = f"SELECT {', '.join(self._base())} FROM {self.table}"
        return f"SELECT {', '.join(self._columns())} FROM ({base})"


def text(sql: str) -> str:
    return f"CAST({sql} AS STRING)"


def whole(sql: str) -> str:
    return f"CAST(floor({sql}) AS BIGINT)"


def hangul(sql: str) -> str:
    return f"translate({text(sql)}, '0123456789', '가나다라마바사아자차')"


def pick(sql: str, *values: str) -> str:
    """values[sql % len(values)]"""
    branches = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE ({sql}) % {len(values)} {branches} END"


def place_columns(k: str) -> list[str]:
    """Parcel number, lot group, place code and the code as text."""
    g = whole(f"({k}) / 4")
    return [f"{k} AS k", f"{g} AS g", f"{g} % 25 AS d", f"{hangul(f'({g} % 25)')} AS h"]


# Where parcel k lies, from k, g, d and h.
SIDO = pick("d", "'경기도'", "'서울특별시'", "'대구광역시'", "'충청북도'", "'강원특별자치도'")
REGION = pick("d", "'경기'", "'서울'", "'대구'", "'충북'", "'강원'")
SIGUNGU = pick("d", "h || '시 ' || h || '구'", "h || '시'", "h || '군'")
TOWN = f"h || {pick('d', *[f"'{t}'" for t in '동읍면리'])}"
DONG = f"{SIDO} || ' ' || {SIGUNGU} || ' ' || {TOWN}"
ROAD = f"{hangul('(g % 100)')} || {pick('d', *[f"'{r}'" for r in '로길'])}"
MAIN = "(g % 997 + 1)"
SUB = "(k % 4)"
LOT = f"{text(MAIN)} || CASE WHEN {SUB} = 0 THEN '' ELSE '-' || {text(SUB)} END"
BUILDING_NO = text("k % 5000 + 1")
BUILDING_SUB_NO = text("k % 9 + 1")
ROAD_NUMBER = f"{BUILDING_NO} || CASE WHEN k % 5 = 4 THEN '-' || {BUILDING_SUB_NO} ELSE '' END"
ROAD_ADDRESS = f"{SIDO} || ' ' || {SIGUNGU} || ' ' || {ROAD} || ' ' || {ROAD_NUMBER}"
CODE5 = f"'41' || lpad({text('d')}, 3, '0')"
CODE10 = f"{CODE5} || lpad({text('g % 100000')}, 5, '0')"
IS_MOUNTAIN = "g % 11 = 0"
PARCEL_ID = (
    f"{CODE10} || CASE WHEN {IS_MOUNTAIN} THEN '2' ELSE '1' END "
    f"|| lpad({text(MAIN)}, 4, '0') || lpad({text(SUB)}, 4, '0')"
)
_SURNAMES = [f"'{name}'" for name in "김이박"]


def person(n: str) -> str:
    """Three-syllable name of person n."""
    return f"{pick(n, *_SURNAMES)} || {hangul(f'({n}) % 10')} || {hangul(f'({n}) % 7')}"


def masked(n: str) -> str:
    return f"{pick(n, *_SURNAMES)} || '*' || {hangul(f'({n}) % 7')}"


def customer_name(key: str) -> str:
    return f"'Customer#' || lpad({text(key)}, 9, '0')"


# Customers ending in 9 repeat the address of the customer before them.
SITE = "CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END"
_BUILDING_SUB = pick("k", "CAST(NULL AS STRING)", "'0'", "''", "'00'", BUILDING_SUB_NO)
# Representative: a name, its middle masked for some, and what people write around it.
_REP = " || ".join(
    [
        pick("c_custkey", *["''"] * 4, "' '", *["''"] * 3),
        pick("c_custkey", *_SURNAMES),
        f"CASE WHEN c_custkey % 8 = 6 THEN '*' ELSE {hangul('c_custkey % 10')} END",
        hangul("c_custkey % 7"),
        pick(
            "c_custkey",
            "''",
            "' 외 2명'",
            f"',' || {person('c_custkey + 1')}",
            "' 외1인'",
            "' (대표) '",
            f"'·' || {person('c_custkey + 2')}",
            "''",
            "'  대표'",
        ),
    ]
)
# Address: with or without the town, with spaces and remarks that have to go.
_ADDRESS = " || ".join(
    [
        SIDO,
        pick("c_custkey", "' '", "' '", "'  '", "' '"),
        SIGUNGU,
        f"CASE WHEN c_custkey % 4 IN (0, 3) THEN ' ' || {TOWN} ELSE '' END",
        "' '",
        ROAD,
        pick("c_custkey", "' '", "' '", "'   '", "' '"),
        ROAD_NUMBER,
        pick("c_custkey", f"', 1층 (' || {TOWN} || ')'", "' (비전동)'", "' '", "''"),
    ]
)

ROLES: dict[str, Role] = {
    "bronze_address": Role(
        "customer",
        {
            "dong_code": CODE10,
            "sido": SIDO,
            "sigungu": SIGUNGU,
            "mountain_flag": f"CASE WHEN {IS_MOUNTAIN} THEN '1' WHEN g % 13 = 0 THEN NULL ELSE '0' END",
            "lot_main": text(MAIN),
            "lot_sub": f"CASE WHEN {SUB} = 0 AND g % 2 = 0 THEN NULL ELSE {text(SUB)} END",
            "road": ROAD,
            "bldg_main": BUILDING_NO,
            "bldg_sub": _BUILDING_SUB,
            "region": REGION,
        },
        parcel=SITE,
    ),
    "bronze_coord": Role(
        "customer",
        {
            "sido": SIDO,
            "sigungu": SIGUNGU,
            "road": ROAD,
            "bldg_main": BUILDING_NO,
            "bldg_sub": _BUILDING_SUB,
            "x": f"CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 19 = 0 THEN 'n/a' WHEN c_custkey % 23 = 0 THEN ' 950000.5 ' ELSE {text('900000 + c_custkey * 37 % 200000')} END",
            "y": f"CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE {text('1900000 + c_custkey * 53 % 300000')} END",
            "region": REGION,
        },
        parcel=SITE,
    ),
    "bronze_building": Role(
        "lineitem",
        {
            "building_pk": f"CASE WHEN l_partkey % 13 <> 0 THEN 'B' || {text('l_orderkey')} || '-' || {text('l_linenumber')} || '-' || {text('l_partkey')} || '-' || {text('l_suppkey')} END",
            "register_code": "CASE WHEN l_returnflag = 'N' THEN '2' ELSE '1' END",
            "sigungu_code": CODE5,
            "dong_code": f"lpad({text('g % 100000')}, 5, '0')",
            "land_flag": f"CASE WHEN {IS_MOUNTAIN} THEN '1' WHEN l_partkey % 211 = 0 THEN '9' ELSE '0' END",
            "bun": text(MAIN),
            "ji": f"CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE {text(SUB)} END",
            "building_area": text(whole("l_extendedprice / 20")),
            "outdoor_parking_area": f"CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN {text(whole('l_extendedprice / 50'))} ELSE NULL END",
            "region": REGION,
        },
        # spread so that parcels have no, one or many buildings
        parcel=whole("(l_orderkey * 4 + l_linenumber) / 2"),
    ),
    "bronze_parcel": Role(
        "orders",
        {
            "parcel_id": PARCEL_ID,
            "dong": DONG,
            "lot": LOT,
            "category": pick("k", "'대'", "'잡종지'", "'주차장'", "'대'", "'임야'"),
            "land_area": f"CASE WHEN o_orderkey % 41 = 0 THEN '' ELSE {text(whole('o_totalprice / 50'))} END",
            "co_owner_count": text("o_orderkey % 4"),
            "change_date": f"CASE WHEN o_orderkey % 29 = 0 THEN '' WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN '2024-13-45' ELSE {text('CAST(o_orderdate AS DATE)')} END",
            "owner_code": "CASE o_orderstatus WHEN 'F' THEN '01' WHEN 'O' THEN '1' ELSE '02' END",
            "region": REGION,
        },
        parcel=whole("o_orderkey / 2"),
    ),
    "bronze_restaurant": Role(
        "customer",
        {
            "name": customer_name("k"),
            "rep": f"CASE WHEN c_custkey % 16 = 7 THEN NULL ELSE {_REP} END",
            "address": f"CASE WHEN c_custkey % 50 = 48 THEN NULL ELSE {_ADDRESS} END",
            "biz_type": "CASE c_mktsegment WHEN 'FURNITURE' THEN '일반음식점' WHEN 'MACHINERY' THEN '휴게음식점' WHEN 'BUILDING' THEN '제과점영업' WHEN 'AUTOMOBILE' THEN '집단급식소' ELSE '위탁급식영업' END",
            "region": REGION,
        },
        parcel=SITE,
    ),
    "ownership": Role(
        "orders",
        {
            "address": f"CASE WHEN o_orderstatus = 'P' THEN '미상 ' || {DONG} ELSE {DONG} END",
            "lot_main": text(MAIN),
            "lot_sub": f"CASE WHEN {SUB} = 0 THEN NULL ELSE {text(SUB)} END",
            "owner": pick("o_orderkey", person("k"), masked("k"), person("k + 1")),
            "change_date": "CAST(o_orderdate AS DATE)",
            "region": REGION,
        },
        parcel=whole("o_orderkey / 2"),
    ),
    # Served sites: one row per order, snapshots by order date; the last two years are one month.
    "served": Role(
        "orders",
        {
            "sigungu": SIGUNGU,
            "total": "CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 50) AS DOUBLE) / 100 END",
            "suitability": "CAST(o_orderkey % 101 AS DOUBLE) / 100",
            "profitability": "CAST(o_orderkey % 107 AS DOUBLE) / 100",
            "parking": "CAST(o_orderkey % 7 AS INT)",
            "name": customer_name("o_custkey"),
            "road_address": ROAD_ADDRESS,
            "idle_area": "floor(o_totalprice) * 1.0E0",
            "longitude": "CAST(o_custkey % 360 AS DOUBLE)",
            "latitude": "CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE CAST(o_custkey % 90 AS DOUBLE) END",
            "region": REGION,
            "year": "CAST(least(year(o_orderdate), 2000) AS INT)",
            "month": "CAST(CASE WHEN year(o_orderdate) >= 2000 THEN 12 ELSE month(o_orderdate) END AS INT)",
            "week": "CAST(o_orderkey % 3 AS INT)",
            "contract_status": "CASE WHEN o_orderpriority = '1-URGENT' THEN '계약' WHEN o_orderpriority = '2-HIGH' THEN '협의' ELSE '후보' END",
            "remarks": "CASE WHEN o_orderkey % 5 = 0 THEN 'note ' || CAST(o_orderkey AS STRING) END",
        },
        parcel="o_custkey",
    ),
    # Edit log of served sites: one edit per event.
    "edit_log": Role(
        "events",
        {
            "name": customer_name("user_id"),
            "road_address": ROAD_ADDRESS,
            "parking": "CAST(floor(value) % 5 + 1 AS INT)",
            "contract_status": "event_type",
            "remarks": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'edit ' || CAST(event_id AS STRING) END",
            "ts": "ts",
            "event_id": "event_id",
        },
        parcel="user_id",
    ),
}
