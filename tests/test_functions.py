import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lotscout.functions import dates, geo, keys, score, text
from lotscout.sources import regions, schemas

A, B = "a", "b"


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("경기도 평택시 안중읍 서동대로 1530-5, 1층 (안중읍)", "경기도 평택시 서동대로 1530-5"),
        ("경기도 안성시 공도읍 진사리 진사길 12", "경기도 안성시 공도읍 진사길 12"),
        ("경기도 평택시 평택로 12 (비전동)", "경기도 평택시 평택로 12"),
        ("  경기도   평택시  평택로 12  ", "경기도 평택시 평택로 12"),
        (None, None),
    ],
)
def test_clean_address(one, raw, clean):
    assert one(text.clean_address(F.col(A)), raw) == clean


@pytest.mark.parametrize(
    "raw, count, name",
    [
        ("홍길동 외 2명", 3, "홍길동"),
        ("김철수,이영희", 2, "김철수"),
        ("박민수 외1인", 2, "박민수"),
        (" 이몽룡 (대표) ", 1, "이몽룡"),
        ("A·B", 2, "A·B"),
        ("김,이/박", 3, "김"),
        ("홍길동 외 99999999999", None, "홍길동"),
    ],
)
def test_representatives(one, raw, count, name):
    assert one(text.representative_count(F.col(A)), raw) == count
    assert one(text.clean_representative(F.col(A)), raw) == name


@pytest.mark.parametrize(
    "place, district",
    [
        ("경기도 수원시 팔달구 매산동", "수원시 팔달구"),
        ("서울특별시 강남구 역삼동", "서울특별시 강남구"),
        ("경기도 양평군 용문면", "양평군"),
        ("대구광역시 달성군 화원읍", "대구광역시"),
        ("nowhere", ""),
        (None, None),
    ],
)
def test_parse_district(one, place, district):
    assert one(text.parse_district(F.col(A)), place) == district


@pytest.mark.parametrize(
    "rep, owner, same",
    [
        ("홍길동", "홍*동", True),
        ("홍 길동", "홍길 동", True),
        ("홍길", "홍*", True),
        ("홍길동", "홍길순", False),
        ("홍길동", "김길동", False),
        ("홍", "홍", False),
        ("홍길동", "홍동", False),
        (None, "홍", False),
        ("홍길", None, False),
    ],
)
def test_names_match(one, rep, owner, same):
    assert one(text.names_match(F.col(A), F.col(B)), rep, owner) is same


@pytest.mark.parametrize(
    "raw, blank_null, amount, finite",
    [
        (" 12.5 ", 12.5, 12.5, 12.5),
        ("1,234", None, 1234.0, None),
        ("", None, 0.0, None),
        ("-", None, 0.0, None),
        (None, None, 0.0, None),
    ],
)
def test_numbers(one, raw, blank_null, amount, finite):
    assert one(text.safe_double(F.col(A)), raw) == blank_null
    assert one(text.amount_or_zero(F.col(A)), raw) == amount
    assert one(text.finite_double(F.col(A)), raw) == finite


def test_nan_is_not_finite(one):
    assert one(text.finite_double(F.col(A)), "NaN") is None
    assert one(text.amount_or_zero(F.col(A)), "NaN") == 0.0


def test_lot_and_label(one):
    assert one(text.lot_main(F.col(A)), "12-3") == "12"
    assert one(text.lot_sub(F.col(A)), "12-3") == "3"
    assert one(text.lot_sub(F.col(A)), "12") is None
    assert one(text.strip_label(F.col(A), "업체명"), "\t업체명 가게 업체명\n") == "가게 업체명"


@pytest.mark.parametrize(
    "line, owner",
    [
        ("홍길동 외 2인", "홍길동"),
        ("\t홍길동 ", "홍길동"),
        ("홍길동 귀하", None),
        ("홍길동1", None),
        ("", None),
    ],
)
def test_owner_line(one, line, owner):
    assert one(text.owner_from_line(F.col(A)), line) == owner


def test_nfc(one):
    assert one(text.nfc_strip(F.col(A)), " 각 ") == "각"
    assert one(text.nfc_strip(F.col(A)), None) is None


def test_parcel_ids(one):
    parts = [F.col(c) for c in "abcd"]
    by_address = keys.parcel_id_from_address(*parts)
    assert one(by_address, "4122010100", "1", "12", "3") == "4122010100200120003"
    assert one(by_address, "4122010100", None, "12", None) == "4122010100100120000"
    by_building = keys.parcel_id_from_building(*(F.col(c) for c in "abcde"))
    assert one(by_building, "41220", "10100", "0", "12", "3") == "4122010100100120003"
    assert one(by_building, "41220", "10100", "1", "12", "3") == "4122010100200120003"
    assert one(by_building, "41220", "10100", "9", "12", "3") == "4122010100900120003"
    assert one(by_building, "41220", "10100", "0", None, "3") is None


@pytest.mark.parametrize(
    "sub, address",
    [
        ("5", "경기도 평택시 서동대로 1530-5"),
        ("0", "경기도 평택시 서동대로 1530"),
        ("00", "경기도 평택시 서동대로 1530"),
        ("", "경기도 평택시 서동대로 1530"),
        (None, "경기도 평택시 서동대로 1530"),
    ],
)
def test_road_address(one, sub, address):
    parts = [F.col(c) for c in "abcde"]
    assert one(keys.road_address(*parts), "경기도", "평택시", "서동대로", "1530", sub) == address


def test_document_parts(one):
    parts = keys.document_parts(F.col(A))
    name = "경기도_평택시_비전동_12-3-4_2024-01-02"
    assert one(parts["address"], name) == "경기도 평택시 비전동"
    assert one(parts["lot_main"], name) == "12"
    assert one(parts["lot_sub"], name) == "3-4"
    assert one(parts["change_date"], name) == "2024-01-02"
    assert all(one(p, "short_name") is None for p in parts.values())


def test_week_of_month_equals_calendar_rule(spark):
    days = spark.sql("SELECT explode(sequence(date'2023-01-01', date'2026-12-31')) AS d")
    for row in days.select("d", dates.week_of_month(F.col("d")).alias("w")).collect():
        mondays = [
            n for n in range(1, row.d.day + 1) if row.d.replace(day=n).weekday() == 0
        ]
        assert row.w == len(mondays)


def test_other_stamps(one):
    day = F.to_date(F.col(A))
    previous = dates.previous_month_stamp(day)
    assert (one(previous["year"], "2024-01-31"), one(previous["month"], "2024-01-31")) == ("2023", "12")
    assert one(dates.tolerant_date(F.col(A)), "2024-13-45") is None
    assert one(dates.tolerant_date(F.col(A)), "2024-02-29") == dt.date(2024, 2, 29)
    tag = dates.quarter_tag(F.col(A))
    assert [one(tag, s) for s in ("20240331", "20241231", "20240330", "2024033", "x", None)] == [
        "2024Q1", "2024Q4", None, None, None, None,
    ]


def _forward(lat: float, lon: float) -> tuple[float, float]:
    """Degrees to grid, by the forward series."""
    phi, lam = math.radians(lat), math.radians(lon - geo.ORIGIN_LONGITUDE)
    f = 1 / geo.INVERSE_FLATTENING
    e = math.sqrt(f * (2 - f))
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi, eta = math.atan2(t, math.cos(lam)), math.atanh(math.sin(lam) / math.hypot(t, 1))
    a = list(enumerate(geo.ALPHA, 1))
    scale = geo.SCALE * geo.RECTIFYING_RADIUS
    x = eta + sum(c * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, c in a)
    y = xi + sum(c * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, c in a)
    return geo.FALSE_EASTING + scale * x, geo.FALSE_NORTHING + scale * y - geo.ORIGIN_NORTHING


def test_projection_known_point_and_round_trip(spark):
    points = [(33.1 + i * 0.27, 124.6 + j * 0.31) for i in range(20) for j in range(20)]
    rows = [(*point, *_forward(*point)) for point in points]
    df = spark.createDataFrame(rows, "lat double, lon double, x double, y double")
    for row in geo.with_wgs84(df).collect():
        assert abs(row.latitude - row.lat) < 1e-9 and abs(row.longitude - row.lon) < 1e-9
    seoul = spark.createDataFrame([(953901.165, 1952032.081)], "x double, y double")
    row = geo.with_wgs84(seoul).first()
    assert abs(row.latitude - 37.5665) < 1e-8 and abs(row.longitude - 126.978) < 1e-8


def test_projection_null(spark):
    df = spark.createDataFrame([(None, 2e6), (1e6, None)], "x double, y double")
    assert all(r.latitude is None and r.longitude is None for r in geo.with_wgs84(df).collect())


def test_idle_area(one):
    lot, building, outdoor = (F.col(c).cast("double") for c in "abc")
    area = score.idle_area(lot, building, outdoor)
    assert one(area, "100", None, "5") == 100
    assert one(area, "100", "30", None) == 70
    assert one(area, "100", "95", "20") == 20
    assert one(area, "100", "150", None) == 0


def test_scores(one):
    area = F.col(A).cast("double")
    assert one(F.round(score.profitability(area), 2), "9896.13") == 1.0
    assert one(score.profitability(area), None) is None
    kind = score.business_score(F.col(A))
    assert [one(kind, k) for k in ("일반음식점", "휴게음식점", "집단급식소", "x", None)] == [
        0.4, 0.1, 0.0, 0.0, 0.0,
    ]


def test_grades(one):
    value = F.col(A).cast("double")
    grades = [one(score.grade(value), v) for v in ("0.8", "0.79", "0.4", "0.2", "0.1", None, "NaN")]
    assert grades == ["A", "B", "C", "D", "E", None, None]
    letters = [one(score.parking_grade(value), v) for v in ("5", "3.9", "1", "0", None)]
    assert letters == ["A", "C", "E", None, None]
    points = [one(score.parking_points(F.col(A)), v) for v in ("A", "E", "Z", None)]
    assert points == [5, 1, 3, 3]


def test_regions(one):
    assert one(regions.region_from_file_name(F.col(A)), "RNADDRKOR_gyunggi.TXT") == "경기"
    with pytest.raises(Exception, match="no region for file name"):
        one(regions.region_from_file_name(F.col(A)), "rnaddrkor_atlantis.txt")
    assert one(regions.region_from_file_code(F.col(A)), "AL_D160_41_x.csv") == "경기"
    assert one(regions.region_from_file_code(F.col(A)), "AL_D160_99.csv") == "Unknown"
    assert one(regions.region_from_store_file(F.col(A)), "stores_경기_202409.csv") == "경기"
    assert one(regions.region_from_store_file(F.col(A)), "stores.csv") == "unknown"


def test_column_lists():
    sizes = [len(c) for c in (schemas.ADDRESS_COLUMNS, schemas.COORD_COLUMNS, schemas.BUILDING_COLUMNS)]
    assert sizes == [24, 18, 77]
    assert schemas.header_name(["화물", "nan", "영업용", "영업용"]) == "화물_영업용"
    assert schemas.header_name([None, " 계 ", "", "계", "화물", "계"]) == "계_화물_계"
    assert schemas.header_name(["", None]) == ""
    # keyword order, then name length, then place
    assert schemas.ranked_column(["a_n", "n", "m"], ["m", "n"]) == "m"
    assert schemas.ranked_column(["a_n", "b_n"], ["z", "n"]) == "a_n"
    assert schemas.ranked_column(["x_y_z", "y_x"], [("x", "y")]) == "y_x"
    with pytest.raises(KeyError):
        schemas.ranked_column(["x"], ["시도명"])
