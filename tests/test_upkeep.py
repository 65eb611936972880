"""Hot spots, sheets, carried work and the gate on small tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from lotscout.operators import hotspots, joins, state
from lotscout.plans import jobs, landing
from lotscout.sources import gate, schemas, sheets
from lotscout.sources.manifest import Table
from lotscout.sources.snapshot import write_snapshot


def test_hotspots_equal_a_loop(spark):
    import random

    r = random.Random(3)
    points = [(str(r.randrange(3)), r.uniform(-900, 900), r.uniform(-900, 900), r.randrange(9)) for _ in range(200)]
    points += [("0", None, 1.0, 5), ("0", 1.0, 1.0, None)]
    df = spark.createDataFrame(points, "sigungu_cd string, x double, y double, value long")
    cells = hotspots.cell_sums(df, 100.0, "sigungu_cd")
    got = {}
    around = hotspots.neighbourhoods(cells, 2)
    for row in cells.join(around, ["cell_x", "cell_y"]).collect():
        got[row.sigungu_cd, row.cell_x, row.cell_y] = row.value
    placed = [(d, x // 100, y // 100, v) for d, x, y, v in points if None not in (x, v)]
    want = {
        (d, cx, cy): sum(v for _, ox, oy, v in placed if abs(ox - cx) <= 2 and abs(oy - cy) <= 2)
        for d, cx, cy in {p[:3] for p in placed}
    }
    assert got == want
    shown = hotspots.zone_hotspots(cells, around, 100.0, "sigungu_cd").collect()
    for d in "012":
        z = [r.z_score for r in shown if r.sigungu_cd == d]
        assert abs(sum(z)) < 1e-9 and (len(z) == 1 or abs(sum(x * x for x in z) / (len(z) - 1) - 1) < 1e-9)
    alone = hotspots.cell_sums(df.limit(1), 100.0, "sigungu_cd")
    (one,) = hotspots.hotspots_of(hotspots.zone_hotspots(alone, hotspots.neighbourhoods(alone), 100.0, "sigungu_cd"), points[0][0]).collect()
    assert one.z_score == 0.0 and one.value == points[0][3]


def test_stacked_header_cells(spark):
    cells = [
        (0, 0, "등록대수"), (1, 0, "시도명"), (2, 0, "시도명"), (1, 1, "화물"), (2, 1, "영업용"), (2, 2, "자가용"), (1, 3, "계"),
        (1, 4, "nan"), (2, 4, " None "), (3, 0, "경기"), (3, 1, "1,200"), (3, 2, ""), (3, 3, "7"), (4, 0, "서울"), (5, 1, "x"),
    ]
    df = spark.createDataFrame(cells, "row_no int, col_no int, value string")
    names = {r.col_no: r["name"] for r in sheets.header_names(df, [1, 2]).collect()}
    assert names == {0: "시도명", 1: "화물_영업용", 2: "화물_자가용", 3: "계", 4: "계"}
    table = sheets.table_of(df, [1, 2]).orderBy("row_no")
    assert table.columns == ["row_no", "시도명", "화물_영업용", "화물_자가용", "계"]
    assert [tuple(r) for r in table.collect()] == [
        (3, "경기", "1,200", None, "7"), (4, "서울", None, None, None), (5, None, "x", None, None),
    ]


FETCH = "dong string, lot_main string, change_date string, region string, ok boolean"


def test_register_fetching_over_three_weeks(spark, tmp_path):
    def week(n, wanted, tries):
        lake = jobs.Lake(spark, str(tmp_path), date(2026, 3, 2 + 7 * (n - 1)))
        rows = [(d, m, c, "1", "경기") for d, m, c in wanted]
        listed = spark.createDataFrame(rows, "dong string, lot_main string, change_date string, lot_sub string, region string")
        lake.write(schemas.to_source(listed, jobs.FETCH_NAMES), "s1_fetch_list", jobs.WEEKLY)
        out = [(d, m, c, "경기", ok) for (d, m, c), ok in tries]
        for _ in range(2):  # a rerun of the week changes nothing
            nxt = jobs.run_fetching(lake, spark.createDataFrame(out, FETCH), max_attempts=3)
        return lake, {(r.dong, r.lot_main): (r.attempts, r.status) for r in nxt.collect()}

    a, b, c = ("가", "1", "2020-01-01"), ("나", "2", None), ("다", "3", "2021-01-01")
    _, nxt = week(1, [a, b], [(a, True), (b, False)])
    assert nxt == {("나", "2"): (1, "failed")}
    _, nxt = week(2, [a, b, c], [(b, None), (b, False)])
    assert nxt == {("다", "3"): (0, "pending")}
    lake, nxt = week(3, [b, c], [(c, False)])
    assert nxt == {("다", "3"): (1, "failed")}
    found = {r.dong: r for r in lake.latest("fetch_state", jobs.WEEKLY).collect()}
    assert (found["가"].status, found["가"].wanted, found["가"].first_run) == ("fetched", False, 2026031)
    assert (found["나"].status, found["나"].attempts, found["나"].last_try) == ("given up", 3, 2026032)


def test_state_without_outcomes(spark):
    wanted = spark.createDataFrame([("a", None), ("a", None)], "k string, region string")
    none = spark.createDataFrame([], "k string, region string, ok boolean")
    (row,) = state.carried(None, wanted, none, ["k", "region"], F.lit(1)).collect()
    assert (row.status, row.attempts, row.wanted) == ("pending", 0, True)


def test_gate(spark, tmp_path):
    rows = spark.createDataFrame([(1, "경기"), (2, "서울")], "id int, region string")
    upto = {"year": 2026, "month": 3, "week": 2}
    committed, plain, bare = (str(tmp_path / n) for n in ("m", "d", "b"))
    Table(spark, committed).write(rows, {**upto, "week": 1}, ("region",))
    write_snapshot(rows.filter("id = 1"), plain, upto)
    (tmp_path / "b/year=2026/month=03/week=02").mkdir(parents=True)
    needs = [gate.Need(n, b, jobs.WEEKLY, ("경기", "서울")) for n, b in (("m", committed), ("d", plain), ("b", bare))]
    assert gate.lacking(spark, needs, upto) == ["d (2026, 3, 2): no 서울", "b: no snapshot up to (2026, 3, 2)"]
    assert gate.lacking(spark, needs[:1], {**upto, "week": 0}) == ["m: no snapshot up to (2026, 3, 0)"]
    (tmp_path / "d/year=2026/month=03/week=02/_SUCCESS").unlink()
    assert gate.lacking(spark, needs[1:2], upto) == ["d: no snapshot up to (2026, 3, 2)"]
    lake = jobs.Lake(spark, str(tmp_path / "lake"), date(2026, 3, 18))
    with pytest.raises(ValueError, match="s1_candidates: no snapshot.*ownership: no snapshot"):
        jobs.run_gold(lake)


def test_quarter_from_file_names_and_kept_quarter(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), date(2026, 3, 18))
    files, target = tmp_path / "s", str(tmp_path / "stores")
    files.mkdir()
    (files / "상가정보_경기_202409.csv").write_text('상호명,주소\n"가\n나",다\n', encoding="utf-8")
    landing.land_stores(lake, str(files), target)
    (store,) = spark.read.parquet(target).collect()
    assert (store["상호명"], store.dataset) == ("가\n나", "2024Q3")
    (files / "상가정보_경기_202409.csv").write_text("상호명,주소\n가\n", encoding="utf-8")
    with pytest.raises(Exception):
        landing.land_stores(lake, str(files), target)
    assert spark.read.parquet(target).count() == 1
    (files / "상가정보_경기_202412.csv").write_text("상호명,주소\n", encoding="utf-8")
    with pytest.raises(ValueError, match="one quarter"):
        landing.quarter_of_files(lake, str(files))


def test_scraped_restaurants_feed_the_weekly_table(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), date(2026, 3, 18))
    row = ["번호 1", "인허가번호 77", "업체명 가게", " 업종일반음식점", "대표자 홍길동", "소재지 경기도 양평군 용문로 5", "", "영업", None]
    other = ["2", "78", "업체명", "휴게음식점", "김", "어딘가", None, None, None]
    cells = spark.createDataFrame([row, row, other], ", ".join(f"`{c}` string" for c in schemas.LICENCE_COLUMNS))
    landing.land_restaurants(lake, cells)
    (got,) = lake.raw("raw_restaurant", schemas.RESTAURANT_NAMES, jobs.WEEKLY).collect()
    assert tuple(got) == ("가게", "홍길동", "경기도 양평군 용문로 5", "일반음식점", "경기")


def test_plain_left_join_has_two_shuffles(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left, right = spark.range(50).withColumn("a", F.lit(1)), spark.range(20, 90).withColumn("b", F.lit(2))
    out = joins.left_join(left, right, ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2 and out.count() == 50
