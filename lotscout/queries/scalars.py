"""Scalar rules over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.functions import dates, geo, keys, score, text
from lotscout.operators.aggregates import heat_intensity as with_intensity
from lotscout.plans.ownership import pick_owner
from lotscout.queries import oracle
from lotscout.queries.registry import Tables, query
from lotscout.queries.roles import ROAD, SIDO, Role, hangul, person, pick
from lotscout.queries.roles import text as as_text
from lotscout.sources import regions, schemas

_BUILDING_PARTS = ("sigungu_code", "dong_code", "land_flag", "bun", "ji")


@query(
    "SELECT dong_code, lot_main, lot_sub, dong_code || CASE WHEN mountain_flag = '1' THEN '2' ELSE '1' END "
    "|| lpad(lot_main, 4, '0') || lpad(coalesce(lot_sub, '0'), 4, '0') AS parcel_id FROM bronze_address"
)
def parcel_id_address(t: Tables) -> DataFrame:
    parts = map(F.col, ("dong_code", "mountain_flag", "lot_main", "lot_sub"))
    parcel_id = keys.parcel_id_from_address(*parts).alias("parcel_id")
    return t.bronze_address.select("dong_code", "lot_main", "lot_sub", parcel_id)


@query(f"SELECT building_pk, {oracle._BUILDING_ID} AS parcel_id FROM bronze_building")
def parcel_id_building(t: Tables) -> DataFrame:
    parcel_id = keys.parcel_id_from_building(*map(F.col, _BUILDING_PARTS)).alias("parcel_id")
    return t.bronze_building.select("building_pk", parcel_id)


@query(f"SELECT bldg_main, bldg_sub, {oracle.road_address()} AS road_address FROM bronze_coord")
def road_address(t: Tables) -> DataFrame:
    parts = ("sido", "sigungu", "road", "bldg_main", "bldg_sub")
    address = keys.road_address(*map(F.col, parts)).alias("road_address")
    return t.bronze_coord.select("bldg_main", "bldg_sub", address)


@query(f"SELECT name, address, {oracle.address_clean('address')} AS clean FROM bronze_restaurant")
def address_clean(t: Tables) -> DataFrame:
    clean = text.clean_address(F.col("address")).alias("clean")
    return t.bronze_restaurant.select("name", "address", clean)


@query(f"SELECT name, rep, {oracle.rep_count('rep')} AS rep_count FROM bronze_restaurant")
def rep_count(t: Tables) -> DataFrame:
    count = text.representative_count(F.col("rep")).alias("rep_count")
    return t.bronze_restaurant.select("name", "rep", count)


@query(f"SELECT name, rep, {oracle.rep_clean('rep')} AS clean FROM bronze_restaurant")
def rep_name_clean(t: Tables) -> DataFrame:
    clean = text.clean_representative(F.col("rep")).alias("clean")
    return t.bronze_restaurant.select("name", "rep", clean)


_NUMBER_TEXT = pick(
    "o_orderkey",
    as_text("o_orderkey"),
    f"' ' || {as_text('o_orderkey')} || '.5 '",
    "''",
    "'  '",
    "'NaN'",
    "'n/a'",
    f"{as_text('o_orderkey')} || ',000'",
    "CAST(NULL AS STRING)",
)


@query(
    f"""SELECT o_orderkey, {oracle.safe_double("s")} AS blank_null,
  coalesce(CASE WHEN TRY_CAST(trim(replace(s, ',', '')) AS DOUBLE) <> 'NaN'::DOUBLE
    THEN TRY_CAST(trim(replace(s, ',', '')) AS DOUBLE) END, 0) AS amount,
  CASE WHEN TRY_CAST(s AS DOUBLE) <> 'NaN'::DOUBLE THEN TRY_CAST(s AS DOUBLE) END AS finite
FROM (SELECT o_orderkey, CASE WHEN {_NUMBER_TEXT} = 'NaN' AND o_orderkey % 16 = 4 THEN NULL
  ELSE {_NUMBER_TEXT} END AS s FROM orders)"""
)
def safe_numeric(t: Tables) -> DataFrame:
    raw = F.expr(
        f"CASE WHEN {_NUMBER_TEXT} = 'NaN' AND o_orderkey % 16 = 4 THEN NULL ELSE {_NUMBER_TEXT} END"
    )
    return t.orders.select("o_orderkey", raw.alias("s")).select(
        "o_orderkey",
        text.safe_double(F.col("s")).alias("blank_null"),
        text.amount_or_zero(F.col("s")).alias("amount"),
        text.finite_double(F.col("s")).alias("finite"),
    )


@query(
    "SELECT parcel_id, lot, split_part(lot, '-', 1) AS lot_main, "
    "CASE WHEN contains(lot, '-') THEN split_part(lot, '-', 2) END AS lot_sub FROM bronze_parcel"
)
def lot_split(t: Tables) -> DataFrame:
    main, sub = text.lot_main(F.col("lot")), text.lot_sub(F.col("lot"))
    return t.bronze_parcel.select(
        "parcel_id", "lot", main.alias("lot_main"), sub.alias("lot_sub")
    )


@query(
    "SELECT parcel_id, change_date, CAST(try_strptime(change_date, '%Y-%m-%d') AS DATE) AS day FROM bronze_parcel"
)
def date_parse(t: Tables) -> DataFrame:
    day = dates.tolerant_date(F.col("change_date")).alias("day")
    return t.bronze_parcel.select("parcel_id", "change_date", day)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN building IS NULL THEN lot
  ELSE greatest(lot - building, coalesce(outdoor, 0), 0) END AS idle_area
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS lot,
    CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity * 1000 END AS building,
    CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_tax * 100000 END AS outdoor FROM lineitem)"""
)
def idle_area(t: Tables) -> DataFrame:
    building = F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity") * 1000)
    outdoor = F.when(F.col("l_partkey") % 3 != 0, F.col("l_tax") * 100000)
    area = score.idle_area(F.col("l_extendedprice"), building, outdoor)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", area.alias("idle_area"))


_GRID = (
    "(SELECT c_custkey, CASE WHEN c_custkey % 97 = 0 THEN NULL "
    "ELSE CAST(900000 + c_custkey * 37 % 200000 AS DOUBLE) END AS x, "
    "CAST(1900000 + c_custkey * 53 % 300000 AS DOUBLE) AS y FROM customer)"
)


@query(
    f"SELECT c_custkey, round(longitude, 9) AS longitude, round(latitude, 9) AS latitude "
    f"FROM ({oracle._projected(_GRID, 'c_custkey')})"
)
def project_wgs84(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    x = F.when(key % 97 != 0, (900000 + key * 37 % 200000).cast("double"))
    y = (1900000 + key * 53 % 300000).cast("double")
    grid = t.customer.select("c_custkey", x.alias("x"), y.alias("y"))
    return geo.with_wgs84(grid).select(
        "c_custkey", *[F.round(c, 9).alias(c) for c in ("longitude", "latitude")]
    )


# Scoring inputs per order, so that every branch of every part occurs.
_SCORED = Role(
    "orders",
    {
        "o_orderkey": "o_orderkey",
        "biz_type": pick("o_orderkey", "'일반음식점'", "'휴게음식점'", "'제과점영업'", "'집단급식소'", "'위탁급식영업'", "'기타'", "CAST(NULL AS STRING)"),
        "rep": pick("o_custkey", person("o_custkey"), f"{hangul('o_custkey % 10')} || ' ' || {hangul('o_orderkey % 10')}", "CAST(NULL AS STRING)", "'김'", f"'김*' || {hangul('o_custkey % 3')}"),
        "owner": pick("o_orderkey", person("o_custkey"), f"{hangul('o_custkey % 10')} || {hangul('o_orderkey % 7')}", f"'김나' || {hangul('o_orderkey % 3')}", "CAST(NULL AS STRING)"),
        "register_code": "CASE WHEN o_orderstatus = 'P' THEN '2' WHEN o_orderkey % 23 = 0 THEN NULL ELSE '1' END",
        "co_owner_count": "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_orderkey % 5 AS INT) END",
        "rep_count": "CAST(o_custkey % 3 AS INT)",
        "area": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE floor(o_totalprice) * 1.0E0 END",
    },
)
_SCORE_ROWS = _SCORED.sql()


def _score_rows(t: Tables) -> DataFrame:
    return _SCORED.frame(t.spark, t.sf_dir)


def _parts() -> dict:
    columns = ("biz_type", "rep", "owner", "register_code", "co_owner_count", "rep_count")
    return score.score_parts(*map(F.col, columns))


@query(
    f"SELECT o_orderkey, {', '.join(f'{sql} AS {name}' for name, sql in oracle.GOLD_PARTS.items())} "
    f"FROM ({_SCORE_ROWS})"
)
def score_parts(t: Tables) -> DataFrame:
    parts = [column.alias(name) for name, column in _parts().items()]
    return _score_rows(t).select("o_orderkey", *parts)


@query(
    f"SELECT o_orderkey, rep, owner, coalesce({oracle.name_match('rep', 'owner')}, false) AS same FROM ({_SCORE_ROWS})"
)
def name_match(t: Tables) -> DataFrame:
    same = text.names_match(F.col("rep"), F.col("owner")).alias("same")
    return _score_rows(t).select("o_orderkey", "rep", "owner", same)


@query(
    f"""SELECT o_orderkey, {oracle.rounded("s", 2)} AS suitability, {oracle.rounded("r", 2)} AS profitability,
  {oracle.rounded("s * r * (3 / 5e0) * 100", 2)} AS total
FROM (SELECT *, {oracle.SUITABILITY} AS s, ln(area + 1) / 9.2e0 AS r FROM ({_SCORE_ROWS}))"""
)
def site_score(t: Tables) -> DataFrame:
    fit, profit = score.suitability(_parts()), score.profitability(F.col("area"))
    return _score_rows(t).select(
        "o_orderkey",
        F.round(fit, 2).alias("suitability"),
        F.round(profit, 2).alias("profitability"),
        F.round(score.total_score(fit, profit, F.lit(3)), 2).alias("total"),
    )


@query(f"SELECT parcel_id, dong, {oracle.district('dong')} AS district FROM bronze_parcel")
def district_parse(t: Tables) -> DataFrame:
    district = text.parse_district(F.col("dong")).alias("district")
    return t.bronze_parcel.select("parcel_id", "dong", district)


@query(
    """SELECT o_orderkey, CASE WHEN s IS NULL THEN NULL WHEN s >= 0.8e0 THEN 'A' WHEN s >= 0.6e0 THEN 'B'
  WHEN s >= 0.4e0 THEN 'C' WHEN s >= 0.2e0 THEN 'D' ELSE 'E' END AS grade,
  CASE parking WHEN 5 THEN 'A' WHEN 4 THEN 'B' WHEN 3 THEN 'C' WHEN 2 THEN 'D' WHEN 1 THEN 'E' END AS parking_grade,
  CASE letter WHEN 'A' THEN 5 WHEN 'B' THEN 4 WHEN 'C' THEN 3 WHEN 'D' THEN 2 WHEN 'E' THEN 1 ELSE 3 END AS points
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (o_orderkey % 101) / 100e0 END AS s,
  o_orderkey % 7 AS parking, substr('ABCDEFG', CAST(o_orderkey % 7 + 1 AS INT), 1) AS letter FROM orders)"""
)
def grade_bucket(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    s = F.when(key % 13 != 0, (key % 101) / F.lit(100.0))
    letter = F.substring(F.lit("ABCDEFG"), (key % 7 + 1).cast("int"), F.lit(1))
    return t.orders.select(
        "o_orderkey",
        score.grade(s).alias("grade"),
        score.parking_grade(key % 7).alias("parking_grade"),
        score.parking_points(letter).alias("points"),
    )


@query(
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(CASE WHEN day(ts) <= shift THEN 0 ELSE (day(ts) - shift - 1) // 7 + 1 END AS INTEGER) AS week
FROM (SELECT event_id, ts, (7 - (isodow(date_trunc('month', ts)) - 1)) % 7 AS shift FROM events)"""
)
def week_of_month(t: Tables) -> DataFrame:
    stamp = dates.snapshot_stamp(F.col("ts"))
    return t.events.select("event_id", *[c.alias(name) for name, c in stamp.items()])


@query(
    """SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y') AS year,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%m') AS month FROM orders"""
)
def prev_month(t: Tables) -> DataFrame:
    stamp = dates.previous_month_stamp(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", *[c.alias(name) for name, c in stamp.items()])


_TAG = "CASE WHEN o_orderkey % 9 = 0 THEN '2024-331' WHEN o_orderkey % 10 = 0 THEN '20240230' ELSE {} END"


@query(
    f"""SELECT o_orderkey, tag, substr(tag, 1, 4) || CASE substr(tag, 5) WHEN '0331' THEN 'Q1'
  WHEN '0630' THEN 'Q2' WHEN '0930' THEN 'Q3' WHEN '1231' THEN 'Q4' END AS quarter
FROM (SELECT o_orderkey, {_TAG.format("strftime(o_orderdate, '%Y%m%d')")} AS tag FROM orders)"""
)
def quarter_tag(t: Tables) -> DataFrame:
    tag = F.expr(_TAG.format("date_format(o_orderdate, 'yyyyMMdd')"))
    tagged = t.orders.select("o_orderkey", tag.alias("tag"))
    return tagged.withColumn("quarter", dates.quarter_tag(F.col("tag")))


# Composed and decomposed spellings of the same syllables.
_DECOMPOSED = pick("c_custkey", "'각'", "' 한글 '", "'가나'", "'é'")


@query(
    f"SELECT c_custkey, trim(nfc_normalize({_DECOMPOSED} || c_name || ' ')) AS name FROM customer"
)
def nfc_normalize(t: Tables) -> DataFrame:
    raw = F.expr(f"{_DECOMPOSED} || c_name || ' '")
    return t.customer.select("c_custkey", text.nfc_strip(raw).alias("name"))


_CELL = pick("c_custkey", "' 업체명 ' || c_name", "'업체명' || c_name || '업체명 '", "c_name", "'업체명'")


@query(
    f"SELECT c_custkey, trim(regexp_replace(trim({_CELL}), '^업체명', '')) AS name FROM customer"
)
def label_strip(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.strip_label(F.expr(_CELL), "업체명").alias("name"))


@query(
    """SELECT o_orderkey, CAST(trunc(o_totalprice / (SELECT max(o_totalprice) FROM orders) * 255) AS INTEGER) AS intensity
FROM orders"""
)
def heat_intensity(t: Tables) -> DataFrame:
    return with_intensity(t.orders, "o_totalprice").select("o_orderkey", "intensity")


# File names of the three kinds, by customer.
_ENGLISH = pick("c_custkey", *[f"'{e}'" for e in regions.REGION_BY_ENGLISH])
_CODE = pick("c_custkey", *[f"'{c}'" for c in regions.REGION_BY_CODE], "'99'")
_SHORT = pick("c_custkey", *[f"'{r}'" for r in regions.REGION_BY_CODE.values()], "'x1'")


def _case(key: str, table: dict[str, str], otherwise: str = "NULL") -> str:
    branches = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {key} {branches} ELSE {otherwise} END"


@query(
    f"""SELECT c_custkey, {_case(_ENGLISH, regions.REGION_BY_ENGLISH)} AS by_name,
  {_case(_CODE, regions.REGION_BY_CODE, "'Unknown'")} AS by_code,
  CASE WHEN {_SHORT} = 'x1' THEN 'unknown' ELSE {_SHORT} END AS by_suffix FROM customer"""
)
def region_from_filename(t: Tables) -> DataFrame:
    named = t.customer.select(
        "c_custkey",
        F.expr(f"'RNADDRKOR_' || {_ENGLISH} || '.txt'").alias("address_file"),
        F.expr(f"'AL_D160_' || {_CODE} || '_20240101.csv'").alias("parcel_file"),
        F.expr(f"'stores_' || {_SHORT} || '_202409.csv'").alias("store_file"),
    )
    return named.select(
        "c_custkey",
        regions.region_from_file_name(F.col("address_file")).alias("by_name"),
        regions.region_from_file_code(F.col("parcel_file")).alias("by_code"),
        regions.region_from_store_file(F.col("store_file")).alias("by_suffix"),
    )


_ADDRESSES = Role(
    "customer",
    {
        "c_custkey": "c_custkey",
        "address": f"CASE WHEN c_custkey % 13 = 0 THEN '평양 ' ELSE '  ' END || {SIDO} || ' ' || {ROAD}",
    },
    parcel="c_custkey",
)


@query(
    f"""SELECT * FROM (SELECT c_custkey, {_case("regexp_extract(trim(address), '^(\\S+)', 1)", regions.REGION_ALIASES)} AS region
  FROM ({_ADDRESSES.sql()})) WHERE region IS NOT NULL"""
)
def region_from_token(t: Tables) -> DataFrame:
    rows = _ADDRESSES.frame(t.spark, t.sf_dir)
    return regions.with_region_of_address(rows, "address").select("c_custkey", "region")


@query(
    f"""SELECT o_orderkey AS id, trim(sido) AS sido, coalesce(TRY_CAST(replace(n, ',', '') AS DOUBLE), 0) AS cargo_count
FROM (SELECT o_orderkey, ' ' || {person("o_custkey")} || ' ' AS sido,
  CASE WHEN o_orderkey % 7 = 0 THEN '-' ELSE format('{{:,}}', o_orderkey * 31) END AS n FROM orders)"""
)
def pick_columns(t: Tables) -> DataFrame:
    header = {
        "id": ["구분", "nan", "번호"],
        "sido": ["시도명", "시도명"],
        "all": ["화물", "계"],
        "n": ["화물", "영업용"],
        "n_other": ["화물", "영업용", "기타"],
    }
    names = {k: schemas.header_name(v) for k, v in header.items()}
    count = F.when(F.col("o_orderkey") % 7 == 0, "-").otherwise(
        F.format_number(F.col("o_orderkey") * 31, 0)
    )
    sheet = t.orders.select(
        F.col("o_orderkey").alias(names["id"]),
        F.expr(f"' ' || {person('o_custkey')} || ' '").alias(names["sido"]),
        F.lit("0").alias(names["all"]),
        F.lit("1").alias(names["n_other"]),
        count.alias(names["n"]),
    )
    columns = sheet.columns
    cargo = schemas.ranked_column(columns, [("화물", "영업용")])
    return sheet.select(
        F.col(schemas.ranked_column(columns, ["번호"])).alias("id"),
        F.trim(schemas.ranked_column(columns, ["시도명"])).alias("sido"),
        text.amount_or_zero(F.col(cargo)).alias("cargo_count"),
    )


# Recognised register text: lines of documents, some of them owners.
_LINES = Role(
    "orders",
    {
        "doc": "CASE WHEN o_custkey % 2 = 0 THEN 'doc' ELSE 'place' END || '_' || CAST(o_custkey AS STRING)",
        "page": "o_orderkey % 5",
        "line_no": "o_orderkey",
        # some documents name no owner in any line
        "text": "CASE WHEN o_custkey % 9 = 0 THEN 'No. ' || CAST(o_orderkey AS STRING) ELSE "
        + pick(
            "o_orderkey",
            person("o_orderkey"),
            f"{person('o_orderkey')} || ' 외 3인'",
            f"{person('o_orderkey')} || ' 귀하'",
            "'No. 12'",
            "' '",
            f"'  ' || {person('o_orderkey')} || '  '",
            f"{person('o_orderkey')} || '1'",
        )
        + " END",
    },
)


@query(
    rf"""SELECT doc, arg_max(owner, page * 1000000000000 + line_no) AS owner FROM (
  SELECT doc, page, line_no, CASE
    WHEN regexp_matches(trim(text), '([가-힣]+)\s*외\s*\d+\s*인') THEN regexp_extract(trim(text), '([가-힣]+)\s*외\s*\d+\s*인', 1)
    WHEN contains(trim(text), ' ') OR NOT regexp_matches(trim(text), '^[가-힣]') OR regexp_matches(trim(text), '[^가-힣]') THEN NULL
    ELSE trim(text) END AS owner FROM ({_LINES.sql()})) WHERE owner IS NOT NULL GROUP BY doc"""
)
def owner_line_pick(t: Tables) -> DataFrame:
    return pick_owner(_LINES.frame(t.spark, t.sf_dir))


_NAMED_PLACE = pick("o_custkey", "'경기도_가시_가구_가동'", "'강원특별자치도_다군_다리'", "'서울_나'")
_NAMED_LOT = pick(
    "o_orderkey",
    as_text("o_custkey"),
    f"{as_text('o_custkey')} || '-' || {as_text('o_orderkey % 9')}",
    "' 7 - 8-9 '",
)
_DOCUMENTS = Role(
    "orders",
    {
        "doc": "CASE WHEN o_orderkey % 17 = 0 THEN 'scan_1' ELSE "
        f"{_NAMED_PLACE} || '_' || {_NAMED_LOT} || '_' || {as_text('CAST(o_orderdate AS DATE)')} END"
    },
)


@query(
    f"""SELECT doc, CASE WHEN n >= 3 THEN array_to_string(p[1:n - 2], ' ') END AS address,
  CASE WHEN n >= 3 THEN trim(split_part(trim(p[n - 1]), '-', 1)) END AS lot_main,
  CASE WHEN n >= 3 AND contains(p[n - 1], '-') THEN trim(substr(trim(p[n - 1]), strpos(trim(p[n - 1]), '-') + 1)) END AS lot_sub,
  CASE WHEN n >= 3 THEN p[n] END AS change_date
FROM (SELECT doc, string_split(doc, '_') AS p, len(string_split(doc, '_')) AS n FROM ({_DOCUMENTS.sql()}))"""
)
def docname_parse(t: Tables) -> DataFrame:
    parts = keys.document_parts(F.col("doc"))
    return _DOCUMENTS.frame(t.spark, t.sf_dir).select("doc", *[c.alias(name) for name, c in parts.items()])
