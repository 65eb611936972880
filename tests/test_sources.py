import pytest
from pyspark.sql import functions as F

from lotscout.sources import regions, schemas, text_files
from lotscout.sources import snapshot as snap


@pytest.fixture
def sites(spark):
    return spark.createDataFrame(
        [(1, "경기"), (2, "경기"), (3, "서울")], "id int, region string"
    )


def ids(df):
    return sorted(r.id for r in df.collect())


def test_nested_maximum(spark):
    df = spark.createDataFrame(
        [(2023, 12, 4, 1), (2024, 1, 2, 2), (2024, 2, 1, 3), (2024, 2, 1, 4)], "year int, month int, week int, id int"
    )
    assert ids(snap.latest_snapshot(df)) == [3, 4]
    assert ids(snap.latest_snapshot(df, ["year", "week"])) == [2]
    assert ids(snap.latest_snapshot(df, where=F.col("id") <= 2)) == [2]


def test_snapshot_paths_and_reads(spark, sites, tmp_path):
    base = str(tmp_path / "t")
    snap.write_snapshot(sites, base, {"year": 2023, "month": 12, "week": 4})
    path = snap.write_snapshot(sites.filter("id < 3"), base, {"year": 2024, "month": 2, "week": 0})
    assert path.endswith("year=2024/month=02/week=00")
    snap.write_snapshot(sites.filter("id > 1"), base, {"year": 2024, "month": 2, "week": 0})
    latest = snap.read_latest(spark, base)
    assert ids(latest) == [2, 3]
    assert "PartitionFilters: [isnotnull(year" in latest._jdf.queryExecution().executedPlan().toString()
    monthly = str(tmp_path / "m")
    snap.write_snapshot(sites, monthly, {"year": 2024, "month": 1})
    with pytest.raises(ValueError, match="no week partition"):
        snap.read_latest(spark, monthly)
    with pytest.raises(ValueError, match="no rows"):
        snap.write_snapshot(sites.filter("false"), monthly, {"year": 2024, "month": 2})


def test_subquery_prunes_directories(spark, sites, tmp_path):
    base = str(tmp_path / "t")
    for month in range(1, 7):
        snap.write_snapshot(sites, base, {"year": 2024, "month": month})
    latest = snap.latest_snapshot(spark.read.parquet(base), ["year", "month"])
    assert "PartitionFilters: [isnotnull(year" in latest._jdf.queryExecution().executedPlan().toString()
    months = latest.select("month", F.input_file_name().alias("f")).distinct().collect()
    assert {r.month for r in months} == {6}


def test_hot_region_is_written_by_several_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256KB")
    region = F.when(F.col("id") % 3 == 0, "경기").otherwise((F.col("id") % 5).cast("string"))
    df = spark.range(0, 90_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), region.alias("region"))
    path = snap.write_snapshot(df, str(tmp_path / "t"), {"year": 2024, "month": 1})
    spark.conf.set(key, before)
    assert len(list((tmp_path / "t").rglob("region=경기/*.parquet"))) > 1
    assert spark.read.parquet(path).count() == 90_000


def test_replace_is_idempotent_and_drops_lost_regions(spark, sites, tmp_path):
    base = str(tmp_path / "t")
    stamped = sites.withColumn("year", F.lit(2024)).withColumn("month", F.col("id"))
    snap.replace_snapshots(stamped, base, ["year", "month"])
    again = stamped.filter("id = 2").withColumn("id", F.lit(20))
    for _ in range(2):
        snap.replace_snapshots(again, base, ["year", "month"])
        assert ids(spark.read.parquet(base)) == [1, 3, 20]
    snap.replace_snapshots(stamped.filter("false"), base, ["year", "month"])
    assert ids(spark.read.parquet(base)) == [1, 3, 20]


def test_replace_all(spark, sites, tmp_path):
    base = str(tmp_path / "t")
    snap.replace_snapshots(sites, base, [])
    snap.replace_snapshots(sites.filter("id = 1"), base, [])
    snap.replace_snapshots(sites.filter("false"), base, [])
    assert ids(spark.read.parquet(base)) == [1]


def test_shared_folder_comes_from_the_session(spark):
    assert snap.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    staged = snap.stage_table(spark.range(5), "five")
    assert staged.count() == 5
    assert staged.inputFiles()[0].removeprefix("file://").startswith(snap.shared_folder(spark))


def write(path, text, charset):
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(text.encode(charset))


def test_mixed_charsets(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder / "rnaddrkor_gyunggi.txt", "경기도|평택시|뷁\r\n경기도||\r\n\r\n", "cp949")
    write(folder / "rnaddrkor_seoul.txt", "﻿서울특별시|강남구|x\n", "utf-8")
    write(folder / "rnaddrkor_busan.txt", "부산|남구|a\n부산|북구|b", "euc-kr")
    df = text_files.read_delimited(
        spark, str(folder), ["a", "b", "c"], regions.region_from_file_name(F.col("file_name"))
    )
    assert sorted(map(tuple, df.collect())) == [
        ("경기도", "", "", "경기"),
        ("경기도", "평택시", "뷁", "경기"),
        ("부산", "남구", "a", "부산"),
        ("부산", "북구", "b", "부산"),
        ("서울특별시", "강남구", "x", "서울"),
    ]


def test_blank_and_header(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder / "AL_D160_41_1.csv", '"고유번호","지번"\n1,"12-1, 3"\n2,\n', "euc-kr")
    df = text_files.read_delimited(
        spark, str(folder), ["고유번호", "지번"], sep=",", blank_as_null=True, header=True
    )
    assert sorted(map(tuple, df.collect())) == [("1", "12-1, 3"), ("2", None)]


def test_lines_are_parsed_once_and_text_is_not_shuffled(spark, tmp_path):
    write(tmp_path / "in" / "x.txt", "a|b|c\n", "utf-8")
    df = text_files.read_delimited(spark, str(tmp_path / "in"), ["a", "b", "c"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_column_count_is_checked(spark, tmp_path):
    write(tmp_path / "in" / "x.txt", "a|b|c\na|b\n", "utf-8")
    with pytest.raises(Exception, match="(?i)malformed|columns"):
        text_files.read_delimited(spark, str(tmp_path / "in"), ["a", "b", "c"]).collect()


def test_charset_setting_is_put_back(spark):
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    text_files.read_lines(spark, __file__)
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == before


def test_region_of_address(spark):
    df = spark.createDataFrame([("  경기도 평택시",), ("경북 포항시",), ("평양",), (None,)], "a string")
    out = regions.with_region_of_address(df, "a")
    assert sorted(r.region for r in out.collect()) == ["경기", "경북"]


def test_conform(spark):
    df = spark.createDataFrame(
        [("a", "NaN", "3.0", None, "x"), ("", "1.5", "x", "2", "x"), (None, "2", "4", "1", "x")],
        "name string, total string, parking string, fit string, extra string",
    )
    out = schemas.conform(
        df,
        schemas.SERVED_SITE,
        stamp={"year": F.lit(2024)},
        aliases={"fit": "suitability"},
        defaults={"contract_status": F.lit("후보")},
    )
    assert [f.simpleString() for f in out.schema] == [f.simpleString() for f in schemas.SERVED_SITE]
    a = out.filter("name = 'a'").first()
    assert (a.total, a.parking, a.suitability, a.year, a.contract_status) == (None, 3, None, 2024, "후보")
    assert [r.name for r in schemas.require_text(out, ["name"]).collect()] == ["a"]


def test_empty_rerun_keeps_the_snapshot(spark, tmp_path):
    base, stamp = str(tmp_path / "kept"), {"year": 2024, "month": 5}
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, region string")
    snap.write_snapshot(rows, base, {"year": 2024, "month": 4})
    snap.write_snapshot(rows, base, stamp)
    with pytest.raises(ValueError):
        snap.write_snapshot(rows.filter("false"), base, stamp)
    assert snap.read_latest(spark, base, ["year", "month"]).filter("month = 5").count() == 2
    snap.write_snapshot(rows.filter("id = 1"), base, stamp)
    assert snap.read_latest(spark, base, ["year", "month"]).count() == 1
    assert not [p for p in (tmp_path / "kept" / "year=2024").iterdir() if p.name.startswith("_")]


def test_newest_snapshot_up_to_a_day(spark, tmp_path):
    base = str(tmp_path / "dated")
    for year, month, week in [(2023, 12, 4), (2024, 5, 1), (2024, 6, 0), (2025, 1, 0)]:
        rows = spark.createDataFrame([(year * 100 + month, "a")], "id int, region string")
        snap.write_snapshot(rows, base, {"year": year, "month": month, "week": week})
    read = lambda *upto: snap.read_latest(
        spark, base, snap.LEVELS, dict(zip(snap.LEVELS, upto)) if upto else None
    )
    assert read().first()["id"] == 202501
    assert read(2024, 5, 4).first()["id"] == 202405
    # no week of May is early enough, so the walk goes back a year
    assert read(2024, 5, 0).first()["id"] == 202312
    newest = read(2024, 6, 3)
    assert newest.first()["id"] == 202406 and len(newest.inputFiles()) == 1
    with pytest.raises(ValueError):
        read(2023, 1, 0)


def test_header_of_each_file(spark, tmp_path):
    folder = tmp_path / "h"
    folder.mkdir()
    (folder / "a.csv").write_text("\ufeff\nid, \"lot, main\" \n1,\"x, y\"\n2,\n", encoding="utf-8")
    (folder / "b.csv").write_bytes("\"lot, main\",id\n가,3\n".encode("cp949"))
    assert text_files.header_columns(spark, str(folder / "b.csv")) == ["lot, main", "id"]
    read = text_files.read_delimited(spark, str(folder), ["id", "lot, main"], sep=",", header=True)
    assert sorted(map(tuple, read.collect())) == [("1", "x, y"), ("2", ""), ("3", "가")]
    for name, text in (("c", "id,other\n4,z\n"), ("d", "id,id\n4,z\n"), ("e", "id\n4\n"),
                       ("f", 'id,"lot, main"\n4,"z\nz"\n')):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
        with pytest.raises(Exception):
            text_files.read_delimited(
                spark, str(tmp_path / f"{name}.csv"), ["id", "lot, main"], sep=",", header=True
            ).collect()


@pytest.mark.parametrize("block", [1 << 20, 64, 7])
@pytest.mark.parametrize("charset", ["utf-8-sig", "cp949"])
def test_records_over_several_lines_and_blocks(spark, tmp_path, block, charset):
    """Breaks inside quotes, blank lines and doubled quotes, wherever blocks of the file end."""
    import csv
    import random

    r = random.Random(block)
    want = []
    for k in range(120):
        cell = "".join(r.choice(["가", "b", '"', "\n", ",", " ", "뷁", "\n\n"]) for _ in range(r.randrange(0, 12)))
        want.append((str(k), "가" + cell + "끝", "" if k % 5 == 0 else f"v{k}"))
    want.append(("x", "long" + "\n줄" * 200, "end"))
    for name, rows in (("a.csv", want[:60]), ("b.csv", want[60:])):
        with open(tmp_path / name, "w", encoding=charset, newline="") as f:
            writer = csv.writer(f, lineterminator="\r\n")
            writer.writerow(["id", "text", "v"])
            writer.writerows(rows)
            f.write("\r\n")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, str(block))
        df = text_files.read_delimited(spark, str(tmp_path), ["id", "text", "v"], sep=",", header=True, quoted=True)
        got = sorted(map(tuple, df.collect()))
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert got == sorted(want)


def test_quotes_that_stay_open_are_an_error(spark, tmp_path):
    write(tmp_path / "in/a.csv", 'a,b\n1,"x\ny\n2,z\n', "utf-8")
    with pytest.raises(ValueError, match="not closed"):
        text_files.read_delimited(spark, str(tmp_path / "in"), ["a", "b"], sep=",", header=True, quoted=True)
