"""The jobs over a small lake, from raw files' column names to the served table."""

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lotscout.functions.dates import week_of_month
from lotscout.operators import serve
from lotscout.plans import jobs, landing, stages
from lotscout.sources import schemas
from lotscout.sources.manifest import Table
from lotscout.sources.snapshot import shared_folder, write_snapshot

AS_OF = date(2026, 3, 18)
MONTH = {"year": 2026, "month": 3}
WEEK = {**MONTH, "week": 3}


def raw(spark, names, *rows):
    schema = ", ".join(f"`{source}` string" for source in names)
    return spark.createDataFrame([tuple(r) for r in rows], schema)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = jobs.Lake(spark, str(tmp_path_factory.mktemp("lake")), AS_OF)
    pnu = "4183010100" + "1" + "0012"
    tables = {
        "raw_address": (schemas.ADDRESS_NAMES, MONTH, [
            ("4183010100", "경기도", "양평군", "0", "12", "1", "용문로", "5", "0", "경기"),
        ]),
        "raw_coord": (schemas.COORD_NAMES, MONTH, [
            ("경기도", "양평군", "용문로", "5", "", "1000000", "2000000", "경기"),
        ]),
        "raw_building": (schemas.BUILDING_NAMES, MONTH, [
            ("b1", "1", "41830", "10100", "0", "12", "1", "100.0", None, "경기"),
            ("b2", "1", "41830", "10100", "0", "12", "3", "100.0", None, "경기"),
            ("b3", "1", "41830", "10100", "0", "12", "3", "100.0", None, "경기"),
        ]),
        "raw_parcel": (schemas.PARCEL_NAMES, MONTH, [
            (f"{pnu}0001", "경기도 양평군 용문면", "12-1", "대", "1100", "0", "2020-01-01", "01", "경기"),
            (f"{pnu}0001", "경기도 양평군 용문면", "12-1", "대", "999", "0", "2010-01-01", "01", "경기"),
            (f"{pnu}0002", "경기도 양평군 용문면", "12-2", "잡종지", "500", "0", "2020-01-01", "01", "경기"),
            (f"{pnu}0003", "경기도 양평군 용문면", "12-3", "대", "700", "0", "2020-01-01", "01", "경기"),
            (f"{pnu}0004", "경기도 양평군 용문면", "12-4", "임야", "700", "0", "2020-01-01", "01", "경기"),
            (f"{pnu}0005", "경기도 양평군 용문면", "12-5", "대", "700", "0", "2020-01-01", "02", "경기"),
        ]),
        "raw_restaurant": (schemas.RESTAURANT_NAMES, WEEK, [
            (" 가게 ", "홍길동 (대표)", "경기도 양평군 용문면 용문로 5, 1층", "일반음식점", "경기"),
            ("다른 가게", "김철수", "경기도 양평군 없는로 5", "일반음식점", "경기"),
        ]),
        "ownership": (schemas.OWNERSHIP_NAMES, WEEK, [
            ("경기도 양평군 용문면", "12", "1", "홍*동", "2020-01-01", "경기"),
        ]),
    }
    for name, (names, stamp, rows) in tables.items():
        write_snapshot(raw(spark, names, *rows), lake.path(name), stamp)
    return lake


def test_driver_week_equals_column_week(spark):
    days = [date(2026, 1, 1) + timedelta(n) for n in range(400)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for row in df.select("d", week_of_month(F.col("d")).alias("w")).collect():
        assert row.w == jobs.week_number(row.d)


def test_whole_chain(spark, lake, tmp_path):
    for _ in range(2):  # a rerun changes nothing
        jobs.run_monthly(lake)
        jobs.run_weekly(lake, "경기")
        jobs.run_gold(lake)
    parcels = {r.lot_sub: r for r in lake.latest("s0_parcel").collect()}
    assert set(parcels) == {"1", "2"} and parcels["1"].idle_area == 1000.0
    fetch = lake.latest("s1_fetch_list", jobs.WEEKLY)
    assert [r["부번"] for r in fetch.collect()] == ["1"]
    (site,) = lake.latest("gold_sites", jobs.WEEKLY).collect()
    assert site["유휴부지_면적"] == 1500.0 and site["영업_적합도"] == 1.0
    assert site["latitude"] == pytest.approx(38.0) and site["longitude"] == pytest.approx(127.5)

    served = str(tmp_path / "served")
    for _ in range(2):
        jobs.load_sites(lake, served)
    sites = jobs.served_table(spark, served, schemas.SERVED_SITE)
    (row,) = serve.top_sites(sites, "경기 양평군").collect()
    assert (row["name"], row.year, row.month, row.week, row.contract_status, row["rank"]) == (
        "가게", 2026, 3, 3, "후보", 1,
    )
    assert serve.active_contracts(sites, "경기 양평군").isEmpty()


def test_jobs_remove_what_they_staged(spark, lake):
    def staged():
        root = Path(shared_folder(spark).removeprefix("file://"))
        return {p for p in root.rglob("job-*")}

    before = staged()
    jobs.run_monthly(lake)
    jobs.run_weekly(lake, "경기")
    with pytest.raises(ValueError):
        jobs.run_weekly(lake, "없는 곳")
    assert staged() == before


def test_fetch_list_of_recent_changes(spark, lake):
    jobs.run_monthly(lake)
    jobs.run_weekly(lake, None, changed_days=365 * 20)
    assert lake.latest("s1_fetch_list", jobs.WEEKLY).count() == 1
    jobs.run_weekly(lake, None, changed_days=30)
    candidates = lake.latest("s1_candidates", jobs.WEEKLY)
    assert stages.s1_fetch_list(candidates, AS_OF, 30).isEmpty()


def test_other_loads(spark, lake, tmp_path):
    districts = spark.createDataFrame(
        [("경기", "평택시", "41220", 10.0, 1.5)], "sido string, sigungu string, SHP_CD string, cargo_count double, `전략적_중요도` double"
    )
    districts.write.mode("overwrite").parquet(lake.path("gold_districts") + "/year=2026/month=02")
    jobs.load_districts(lake, str(tmp_path / "d"))
    served = jobs.served_table(spark, str(tmp_path / "d"), schemas.SERVED_DISTRICT)
    (row,) = served.collect()
    assert (row.shp_code, row.cargo_count, row.importance) == ("41220", 10, 1.5)
    assert (row.year, row.month) == ("2026", "02")
    lots = spark.createDataFrame([("가", "나", 37.0, None)], "`공영차고지명` string, `주소` string, lat double, lon double")
    lots.write.mode("overwrite").parquet(lake.path("gold_lots") + "/year=2026/month=02")
    jobs.load_lots(lake, str(tmp_path / "l"))
    assert serve.located(jobs.served_table(spark, str(tmp_path / "l"), schemas.SERVED_LOT)).isEmpty()


def text_file(folder, name, *lines, charset="cp949"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes("\n".join(lines).encode(charset))
    return str(folder)


def test_landing_feeds_the_chain(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), AS_OF)
    address = {
        "법정동코드": "4183010100", "시도명": "경기도", "시군구명": "양평군", "도로명": "용문로",
        "건물본번": "5", "건물부번": "0",
    }
    source = {"산여부": "0", "지번본번(번지)": "12", "지번부번(호)": "1"}
    row = "|".join({**address, **source}.get(c, "") for c in schemas.ADDRESS_COLUMNS)
    landing.land_address(lake, text_file(tmp_path / "a", "rnaddrkor_gyunggi.txt", row))
    row = "|".join({**address, "X좌표": "1000000", "Y좌표": "2000000"}.get(c, "") for c in schemas.COORD_COLUMNS)
    landing.land_coord(lake, text_file(tmp_path / "c", "entrc_gyunggi.txt", row, charset="utf-8"))
    building = {
        "관리_건축물대장_PK": "b1", "대장_구분_코드": "1", "시군구_코드": "41830", "법정동_코드": "10100",
        "대지_구분_코드": "0", "번": "0012", "지": "0001", "건축_면적(㎡)": "100",
    }
    lines = [
        "|".join({**building, "대지_위치": place}.get(c, "") for c in schemas.BUILDING_COLUMNS)
        for place in ("경기도 양평군 용문면 12-1", "어딘가 12-1")
    ]
    landing.land_building(lake, text_file(tmp_path / "b", "mart.txt", *lines), (2026, 2))
    header = ",".join(schemas.PARCEL_NAMES).removesuffix(",region")
    parcel = "4183010100100120001,경기도 양평군 용문면,12-1,대,1100,0,2020-01-01,01"
    landing.land_parcel(
        lake, text_file(tmp_path / "p", "AL_D160_41_202602.csv", header, parcel, charset="euc-kr")
    )
    assert landing.previous_month(lake) == (2026, 2)
    jobs.run_monthly(lake)
    (place,) = lake.latest("s0_address").collect()
    assert place.road_address == "경기도 양평군 용문로 5" and place.latitude == pytest.approx(38.0)
    (parcel,) = lake.latest("s0_parcel").collect()
    assert (parcel.idle_area, parcel.region) == (1000.0, "경기")


def test_other_landings(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), AS_OF)
    lines = spark.createDataFrame(
        [("경기도_양평군_용문면_12-1_2020-01-01", 1, 1, "홍길동 외 2인"), ("평양_12_2020-01-01", 1, 1, "김가나")],
        "doc string, page int, line_no int, text string",
    )
    landing.land_ownership(lake, lines)
    (owner,) = lake.latest("ownership", jobs.WEEKLY).collect()
    assert (owner["주소"], owner["지주"], owner.region) == ("경기도 양평군 용문면", "홍길동", "경기")

    sheet = spark.createDataFrame([("경기", "평택시", "1,200"), ("경기", "계", "1,200"), ("서울", "중구", "3")], "sido string, sigungu string, cargo_count string")
    codes = spark.createDataFrame([("경기", "평택시", "41220")], "sido string, sigungu string, shp_code string")
    landing.land_districts(lake, sheet, codes, (2026, 2))
    jobs.load_districts(lake, str(tmp_path / "served"))
    loaded = jobs.served_table(spark, str(tmp_path / "served"), schemas.SERVED_DISTRICT)
    served = {r.sigungu: r for r in loaded.collect()}
    assert served["평택시"].shp_code == "41220" and served["중구"].shp_code is None
    shapes = spark.createDataFrame([(41220, "Pyeongtaek")], "shp_code int, name string")
    (shown,) = serve.district_map(loaded, shapes).collect()
    assert serve.district_map(Table(spark, str(tmp_path / "served")), shapes).collect() == [shown]
    assert shown.name == "Pyeongtaek" and shown.cargo_count == 1200

    files = text_file(tmp_path / "s", "상가정보_경기_202409.csv", "상호명,주소", '"가, 게",나', charset="utf-8-sig")
    landing.land_stores(lake, files, str(tmp_path / "stores"), "2024Q3")
    (store,) = spark.read.parquet(str(tmp_path / "stores")).collect()
    assert (store["상호명"], store.region, store.dataset) == ("가, 게", "경기", "2024Q3")
