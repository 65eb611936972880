"""SQL text of the roles and of the chain, put together as common table expressions."""

from __future__ import annotations

import re

from lotscout.queries.roles import ROLES


# The patterns below are fixed values: they restate the text rules for the other engine.


def rounded(sql: str, places: int) -> str:
    """Half-up rounding of the decimal digits a double prints, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST({sql} AS VARCHAR) AS DECIMAL(38, 20)), {places}) AS DOUBLE)"


def address_clean(sql: str) -> str:
    no_parentheses = rf"regexp_replace({sql}, '\s*\([^)]*\)', '', 'g')"
    no_tail = f"regexp_replace({no_parentheses}, ',.*$', '')"
    no_town = rf"regexp_replace({no_tail}, '\s+\S+(동|읍|면|리)\s+(\S+(로|길))', ' \2', 'g')"
    return rf"trim(regexp_replace({no_town}, '\s+', ' ', 'g'))"


def rep_clean(sql: str) -> str:
    out = f"trim({sql})"
    for pattern in (
        r"\s*\([^)]*\)\s*",
        r"\s*[,/].*$",
        r"\s*외\s*\d+\s*(인|명)\s*$",
        r"\s*외\s*\d+\s*$",
    ):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def rep_count(sql: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({sql}, '외\s*\d+') "
        rf"THEN 1 + CAST(regexp_extract({sql}, '외\s*(\d+)', 1) AS INTEGER) "
        rf"WHEN regexp_matches({sql}, '[,/·]') "
        rf"THEN CAST(len(regexp_split_to_array({sql}, '\s*[,/·]\s*')) AS INTEGER) ELSE 1 END"
    )


def district(sql: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({sql}, '[가-힣]+시\s+[가-힣]+구') "
        rf"THEN regexp_extract({sql}, '([가-힣]+시)\s+[가-힣]+구', 1) || ' ' || "
        rf"regexp_extract({sql}, '[가-힣]+시\s+([가-힣]+구)', 1) "
        rf"ELSE regexp_extract({sql}, '([가-힣]+(?:시|군))', 1) END"
    )


def road_address(sub: str = "bldg_sub") -> str:
    return (
        "concat_ws(' ', sido, sigungu, road, bldg_main || "
        f"CASE WHEN {sub} IS NOT NULL AND TRY_CAST({sub} AS BIGINT) <> 0 THEN '-' || {sub} ELSE '' END)"
    )


def safe_double(sql: str) -> str:
    return f"TRY_CAST(nullif(trim({sql}), '') AS DOUBLE)"


def name_match(rep: str, owner: str) -> str:
    a, b = (rf"regexp_replace({c}, '\s+', '', 'g')" for c in (rep, owner))
    return (
        f"({rep} IS NOT NULL AND {owner} IS NOT NULL AND length({a}) >= 2 AND length({a}) = length({b}) "
        f"AND {a}[1] = {b}[1] AND (length({b}) = 2 OR {a}[-1] = {b}[-1]))"
    )


def score_parts(owner: str = "owner") -> dict[str, str]:
    return {
        "business_score": "CASE WHEN biz_type IN ('일반음식점', '제과점영업') THEN 0.4e0 WHEN biz_type = '휴게음식점' THEN 0.1e0 ELSE 0e0 END",
        "name_score": f"CASE WHEN {name_match('rep', owner)} THEN 0.3e0 ELSE 0e0 END",
        "register_score": "CASE WHEN register_code = '1' THEN 0.15e0 ELSE 0e0 END",
        "co_owner_score": "0.1e0 * pow(0.5e0, co_owner_count)",
        "single_rep_score": "CASE WHEN rep_count = 1 THEN 0.05e0 ELSE 0e0 END",
    }


def projection(x: str, y: str) -> dict[str, str]:
    """EPSG:5179 to degrees, from the published series written out term by term."""
    f = "(1 / 298.257222101e0)"
    n = f"({f} / (2 - {f}))"
    radius = f"(0.9996e0 * (6378137e0 / (1 + {n}) * (1 + pow({n}, 2) / 4 + pow({n}, 4) / 64)))"
    beta = [
        f"({n} / 2 - 2 * pow({n}, 2) / 3 + 37 * pow({n}, 3) / 96 - pow({n}, 4) / 360)",
        f"(pow({n}, 2) / 48 + pow({n}, 3) / 15 - 437 * pow({n}, 4) / 1440)",
        f"(17 * pow({n}, 3) / 480 - 37 * pow({n}, 4) / 840)",
        f"(4397 * pow({n}, 4) / 161280)",
    ]
    delta = [
        f"(2 * {n} - 2 * pow({n}, 2) / 3 - 2 * pow({n}, 3) + 116 * pow({n}, 4) / 45)",
        f"(7 * pow({n}, 2) / 3 - 8 * pow({n}, 3) / 5 - 227 * pow({n}, 4) / 45)",
        f"(56 * pow({n}, 3) / 15 - 136 * pow({n}, 4) / 35)",
        f"(4279 * pow({n}, 4) / 630)",
    ]
    xi = f"(({y}) - 2000000e0 + 4205815.019835826e0) / {radius}"
    eta = f"(({x}) - 1000000e0) / {radius}"
    xi2 = "xi" + "".join(
        f" - {b} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(beta, 1)
    )
    eta2 = "eta" + "".join(
        f" - {b} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(beta, 1)
    )
    lat = "chi" + "".join(f" + {d} * sin({2 * j} * chi)" for j, d in enumerate(delta, 1))
    return {
        "xi": xi,
        "eta": eta,
        "xi2": xi2,
        "eta2": eta2,
        "chi": "asin(sin(xi2) / cosh(eta2))",
        "latitude": f"degrees({lat})",
        "longitude": "degrees(atan2(sinh(eta2), cos(xi2))) + 127.5e0",
    }


def _projected(source: str, keep: str, x: str = "x", y: str = "y") -> str:
    p = projection(x, y)
    return f"""
SELECT {keep},
  CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {p["longitude"]} END AS longitude,
  CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {p["latitude"]} END AS latitude
FROM (SELECT *, {p["chi"]} AS chi FROM (SELECT *, {p["xi2"]} AS xi2, {p["eta2"]} AS eta2
FROM (SELECT *, {p["xi"]} AS xi, {p["eta"]} AS eta FROM {source})))"""


def first_per_key(source: str, columns: list[str], keys: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns if c not in keys)
    return (
        f"SELECT {', '.join(columns)} FROM {source} QUALIFY row_number() "
        f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"
    )


_CLEAN_RESTAURANT_ROWS = f"""
SELECT name, {rep_clean("rep")} AS rep, {address_clean("address")} AS address, biz_type, region,
  {rep_count("rep")} AS rep_count
FROM bronze_restaurant WHERE name IS NOT NULL AND rep IS NOT NULL AND address IS NOT NULL"""

_CLEAN_ADDRESS_ROWS = f"""
SELECT dong_code || CASE WHEN mountain_flag = '1' THEN '2' ELSE '1' END || lpad(lot_main, 4, '0')
  || lpad(coalesce(lot_sub, '0'), 4, '0') AS parcel_id, {road_address()} AS road_address, region
FROM bronze_address"""

_CLEAN_COORD_ROWS = f"""
SELECT {road_address()} AS road_address, {safe_double("x")} AS x, {safe_double("y")} AS y, region
FROM bronze_coord"""

_BUILDING_ID = (
    "sigungu_code || dong_code || CASE land_flag WHEN '0' THEN '1' WHEN '1' THEN '2' ELSE land_flag END "
    "|| lpad(bun, 4, '0') || lpad(ji, 4, '0')"
)

S1_COLUMNS = (
    "parcel_id, dong, category, co_owner_count, change_date, region, lot_main, lot_sub, "
    "building_pk, register_code, idle_area, name, biz_type, rep, rep_count, road_address, "
    "longitude, latitude"
)

GOLD_PARTS = score_parts()
SUITABILITY = " + ".join(f"({p})" for p in GOLD_PARTS.values())

CTES: dict[str, str] = {
    **{name: role.sql() for name, role in ROLES.items()},
    "clean_restaurant": first_per_key(
        f"({_CLEAN_RESTAURANT_ROWS})",
        ["name", "rep", "address", "biz_type", "region", "rep_count"],
        ["name", "address"],
    ),
    "clean_address": first_per_key(
        f"({_CLEAN_ADDRESS_ROWS})", ["parcel_id", "road_address", "region"], ["road_address"]
    ),
    "clean_coord": first_per_key(
        f"({_CLEAN_COORD_ROWS})", ["road_address", "x", "y", "region"], ["road_address"]
    ),
    "clean_building": f"""
SELECT building_pk, {_BUILDING_ID} AS parcel_id, register_code,
  {safe_double("building_area")} AS building_area,
  {safe_double("outdoor_parking_area")} AS outdoor_parking_area, region
FROM bronze_building""",
    "clean_parcel": """
SELECT parcel_id, dong, category, land_area, co_owner_count, change_date, region,
  split_part(lot, '-', 1) AS lot_main,
  CASE WHEN contains(lot, '-') THEN split_part(lot, '-', 2) END AS lot_sub
FROM (SELECT parcel_id, dong, category, TRY_CAST(land_area AS DOUBLE) AS land_area,
    CAST(co_owner_count AS INTEGER) AS co_owner_count,
    CAST(try_strptime(change_date, '%Y-%m-%d') AS DATE) AS change_date, region, lot
  FROM bronze_parcel WHERE TRY_CAST(owner_code AS INTEGER) = 1)
QUALIFY row_number() OVER (PARTITION BY parcel_id ORDER BY change_date DESC NULLS LAST,
  dong DESC NULLS LAST, category DESC NULLS LAST, land_area DESC NULLS LAST,
  co_owner_count DESC NULLS LAST, region DESC NULLS LAST, lot DESC NULLS LAST) = 1""",
    "s0_address": _projected(
        "(SELECT a.region, parcel_id, road_address, x, y FROM clean_address a LEFT JOIN clean_coord c USING (road_address))",
        "region, parcel_id, road_address",
    ),
    "s0_parcel": """
SELECT p.parcel_id, dong, category, co_owner_count, change_date, p.region, lot_main, lot_sub,
  building_pk, register_code,
  CASE WHEN building_area IS NULL THEN land_area
    ELSE greatest(land_area - building_area, coalesce(outdoor_parking_area, 0), 0) END AS idle_area
FROM clean_parcel p LEFT JOIN clean_building b ON p.parcel_id = b.parcel_id
WHERE category IN ('대', '잡종지', '주차장') AND p.parcel_id IN (
  SELECT p2.parcel_id FROM clean_parcel p2 LEFT JOIN clean_building b2 ON p2.parcel_id = b2.parcel_id
  GROUP BY p2.parcel_id HAVING count(building_pk) <= 1)""",
    "s1_located": """
SELECT road_address, r.name, r.rep, r.biz_type, r.region, r.rep_count, a.parcel_id, a.longitude, a.latitude
FROM clean_restaurant r LEFT JOIN s0_address a ON r.address = a.road_address
WHERE parcel_id IS NOT NULL""",
    "s1_all": f"""
SELECT {S1_COLUMNS} FROM (SELECT p.*, name, biz_type, rep, rep_count, road_address, longitude, latitude
  FROM s0_parcel p LEFT JOIN s1_located r ON p.parcel_id = r.parcel_id
  WHERE building_pk IS NOT NULL AND name IS NOT NULL)
UNION ALL BY NAME
SELECT * FROM s0_parcel WHERE building_pk IS NULL""",
    "s1_candidates": """
SELECT a.* FROM s1_all a JOIN (SELECT dong, lot_main FROM s1_all GROUP BY dong, lot_main
  HAVING max(CASE WHEN name IS NOT NULL THEN 1 ELSE 0 END) = 1) g
ON a.dong = g.dong AND a.lot_main = g.lot_main""",
    "s1_fetch_list": """
SELECT dong, lot_main, change_date, region, min(lot_sub) AS lot_sub FROM s1_candidates
GROUP BY dong, lot_main, change_date, region""",
    "owners": first_per_key(
        "ownership",
        ["address", "lot_main", "lot_sub", "owner", "change_date", "region"],
        ["address", "lot_main", "change_date"],
    ),
    "s2_owner": """
SELECT c.*, o.owner FROM s1_candidates c JOIN owners o ON c.dong = o.address
  AND c.lot_main = o.lot_main AND c.change_date = o.change_date AND c.region = o.region""",
    "lot_area": """
SELECT dong, lot_main, owner, region, sum(largest) AS area FROM (
  SELECT dong, lot_main, owner, lot_sub, region, max(idle_area) AS largest FROM s2_owner
  GROUP BY dong, lot_main, owner, lot_sub, region)
GROUP BY dong, lot_main, owner, region""",
    "gold_parts": """
SELECT d.*, p.area FROM (SELECT DISTINCT * EXCLUDE (lot_sub, parcel_id, idle_area) FROM s2_owner) d
LEFT JOIN lot_area p ON d.dong = p.dong AND d.lot_main = p.lot_main AND d.owner = p.owner
  AND d.region = p.region
WHERE name IS NOT NULL""",
    "gold_sites": f"""
SELECT {district("dong")} AS sigungu,
  {rounded("s * r * (3 / 5e0) * 100", 2)} AS total, {rounded("s", 2)} AS suitability,
  {rounded("r", 2)} AS profitability, 3 AS parking, name, road_address, area AS idle_area,
  longitude, latitude, region
FROM (SELECT *, {SUITABILITY} AS s, ln(area + 1) / 9.2e0 AS r FROM gold_parts)""",
}


def _needed(sql: str, seen: list[str]) -> None:
    words = set(re.findall(r"\w+", sql))
    for name in CTES:
        if name in words and name not in seen:
            _needed(CTES[name], seen)
            if name not in seen:
                seen.append(name)


def query(body: str) -> str:
    """`body` with every chain table it mentions put in front of it."""
    names: list[str] = []
    _needed(body, names)
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in names)
    return f"WITH {ctes}\n{body.strip()}"
