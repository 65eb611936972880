import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lotscout.operators import aggregates, filters, joins, latest, serve
from lotscout.plans import ownership, regional, stages
from lotscout.sources.snapshot import stage_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- one row per key -------------------------------------------------------------------------


def test_latest_and_first_per_key_are_deterministic(spark):
    data = [("a", "2024-01-01", 1), ("a", "2024-02-01", 2), ("a", "2024-02-01", 3), ("a", None, 9),
            ("b", None, 4), ("b", None, 5), (None, "2020-01-01", 6)]
    schema = "k string, d string, v int"
    for seed in range(3):
        shuffled = random.Random(seed).sample(data, len(data))
        df = spark.createDataFrame(shuffled, schema).repartition(4)
        assert rows(latest.latest_per_key(df, ["k"], ["d"])) == rows(
            spark.createDataFrame([("a", "2024-02-01", 3), ("b", None, 5), (None, "2020-01-01", 6)], schema)
        )
        assert rows(latest.first_per_key(df, ["k"])) == rows(
            spark.createDataFrame([("a", None, 9), ("b", None, 4), (None, "2020-01-01", 6)], schema)
        )


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("v")
    )
    kept = latest.first_per_key(df, ["k"])
    before_exchange = plan_of(kept).split("Exchange")[1]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange
    assert kept.filter("k = 0").first()["v"] == -99_999
    assert kept.count() == df.select("k").distinct().count()


# --- joins ------------------------------------------------------------------------------------


def reference_single_child(spark, parents, children):
    """The plain form: join, count child keys per parent, join back."""
    joined = parents.join(children, "k", "left")
    counts = joined.groupBy("k").agg(F.count("pk").alias("n")).filter("n <= 1")
    return joined.join(counts.drop("n"), "k").select("k", "area", "pk", "size")


@pytest.mark.parametrize("seed", range(4))
def test_single_child_equals_count_and_join(spark, seed):
    r = random.Random(seed)
    parents = spark.createDataFrame([(f"p{i}", i) for i in range(60)], "k string, area int")
    children = spark.createDataFrame(
        [
            (r.choice([f"p{r.randrange(60)}", None]), r.choice([None, f"b{i}"]), r.randrange(9))
            for i in range(70)
        ],
        "k string, pk string, size int",
    )
    out = joins.with_single_child(parents, children, "k", "pk")
    assert rows(out) == rows(reference_single_child(spark, parents, children))
    keyed = children.filter("pk is not null")
    out = joins.with_single_child(parents, keyed, "k", "pk")
    assert rows(out) == rows(reference_single_child(spark, parents, keyed))


def test_single_child_with_a_hot_parent(spark):
    parents = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("area"))
    children = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("string").alias("pk"),
        F.lit(0).alias("size"),
    )
    out = joins.with_single_child(parents, children, "k", "pk")
    assert "partial_count" in plan_of(out)
    assert out.count() == 999 and out.filter("k = 7").isEmpty()


def test_group_filter_ignores_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, None), ("a", 2, None), (None, 1, "x"), (None, 1, None)],
        "dong string, main int, name string",
    )
    groups = stage_table(joins.groups_with(df, ["dong", "main"], "name"), "marked_groups")
    kept = joins.in_groups(df, groups, ["dong", "main"])
    assert set(rows(kept)) == {("a", 1, "x"), ("a", 1, None)} and kept.count() == 2


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, n, *names):
    """n rows, a third of them in group 0."""
    key = F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise((F.col("id") % 1000).cast("string"))
    rows = spark.range(0, n, 1, 8)
    return rows.select(*[key.alias(c) for c in names], F.sha2(F.col("id").cast("string"), 256).alias("v"))


def splits(df):
    df.collect()  # runs the plan that is looked at, so that it holds the adaptive decisions
    return "skew=true" in plan_of(df)


def test_hot_left_key_is_split(spark, small_skew_limits):
    left = hot(spark, 120_000, "k")
    lookup = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("area"))
    joined = joins.left_join_one(left, lookup, ["k"])
    assert splits(joined) and joined.count() == 120_000


def test_hot_right_key_is_split(spark, small_skew_limits):
    left = spark.range(2000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("area"))
    right = hot(spark, 120_000, "k")
    joined = joins.left_join_many(left, right, ["k"])
    assert splits(joined)
    assert joined.count() == left.join(right, "k", "left").count()
    assert joined.filter("v is null").count() == left.join(right, "k", "left_anti").count()


def test_hot_group_is_split_in_group_filter(spark, small_skew_limits):
    df = hot(spark, 120_000, "dong", "main").withColumn(
        "name", F.when(F.hash("v") % 50 == 0, F.col("v"))
    )
    groups = stage_table(joins.groups_with(df, ["dong", "main"], "name"), "marked_groups")
    kept = joins.in_groups(df, groups, ["dong", "main"])
    assert splits(kept)
    marked = {r.dong for r in df.filter("name is not null").select("dong").distinct().collect()}
    assert kept.count() == df.filter(F.col("dong").isin(list(marked))).count()


@pytest.mark.parametrize("seed", range(3))
def test_left_join_many_equals_left_join(spark, seed):
    r = random.Random(seed)
    left = spark.createDataFrame([(r.choice(["a", "b", "c", None]), i, "L") for i in range(9)], "k string, i int, region string")
    right = spark.createDataFrame([(r.choice(["a", "b", "d", None]), i, "R") for i in range(9)], "k string, j int, region string")
    plain = left.join(right.drop("region"), "k", "left")
    assert rows(joins.left_join_many(left, right, ["k"])) == rows(plain)


def test_padded_union(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([(2,)], "a int")
    out = joins.union_padded(left, right)
    assert out.schema["b"].dataType.simpleString() == "string"
    assert rows(out) == [(1, "x"), (2, None)]


def test_codes_and_pending(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    codes = spark.createDataFrame([("a", 41)], "k string, code int")
    assert rows(joins.map_codes(df, codes, ["k"])) == [("a", "41"), ("b", None), (None, None)]
    assert rows(joins.unmapped(df, codes, ["k"])) == [("b",), (None,)]
    done = spark.createDataFrame([("b",), (None,)], "k string")
    assert rows(joins.pending(df, done, ["k"])) == [("a",)]
    assert "CartesianProduct" not in plan_of(joins.pending(df, done, ["k"]))
    assert "NestedLoop" not in plan_of(joins.pending(df, done, ["k"]))


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).select("id", F.col("id").cast("string").alias("s")).write.parquet(str(tmp_path / "t"))
    plan = plan_of(filters.present(spark.read.parquet(str(tmp_path / "t")), "id", "s").select("id"))
    assert "IsNotNull(id)" in plan and "IsNotNull(s)" in plan


# --- aggregates -------------------------------------------------------------------------------


def test_max_then_sum_against_brute_force(spark):
    r = random.Random(5)
    data = [(r.choice("abc"), r.choice("xy"), r.choice(["1", "2", None]), float(r.randrange(50))) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, h string, sub string, v double")
    largest = defaultdict(float)
    for g, h, sub, v in data:
        largest[g, h, sub] = max(largest[g, h, sub], v)
    expected = defaultdict(float)
    for (g, h, _), v in largest.items():
        expected[g, h] += v
    out = aggregates.max_then_sum(df, ["g", "h"], "sub", "v", "area")
    assert {(g, h): a for g, h, a in rows(out)} == expected
    biggest = df.groupBy("g", "h").agg(F.max("v").alias("m"))
    assert out.join(biggest, ["g", "h"]).filter("area < m").isEmpty()


def test_zscore_against_statistics(spark):
    from statistics import mean, stdev

    data = {"A": [1.0, 2.0, 6.0], "B": [5.0], "C": [4.0, 4.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "sido string, n double")
    totals = {k: sum(vs) for k, vs in data.items()}
    out = aggregates.two_level_zscore(df, "sido", "n").collect()
    for row in out:
        vs = data[row.sido]
        inner = (row.n - mean(vs)) / stdev(vs) if len(vs) > 1 and stdev(vs) else 0.0
        outer = (totals[row.sido] - mean(totals.values())) / stdev(totals.values())
        assert row.importance == pytest.approx(0.6 * outer + 0.4 * inner)
        assert row.outer_total == totals[row.sido]
    single = aggregates.two_level_zscore(df.filter("sido = 'A'"), "sido", "n")
    assert all(r.importance is None for r in single.collect())


def test_zscore_and_heat_have_no_global_window(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("v"))
    for out in (aggregates.two_level_zscore(df, "g", "v"), aggregates.heat_intensity(df, "v")):
        assert "Window" not in plan_of(out) and "NestedLoop" not in plan_of(out)
    top = aggregates.heat_intensity(df, "v").agg(F.max("intensity")).first()[0]
    assert top == 255
    flat = aggregates.heat_intensity(df.withColumn("v", F.lit(0.0)), "v")
    assert flat.agg(F.max("intensity")).first()[0] == 0


def test_regional_importance(spark):
    raw = spark.createDataFrame(
        [("경기", " 평택시 ", "1,000"), ("경기", "부천시", "500"), ("경기", "합계", "1,500"),
         ("경북", "포항시", "x"), ("경북", "계", "7")],
        "sido string, sigungu string, cargo_count string",
    )
    codes = spark.createDataFrame([("경기", "평택시", 41220)], "sido string, sigungu string, shp_code int")
    out = {r.sigungu: r for r in regional.regional_importance(raw, codes).collect()}
    assert set(out) == {"평택시", "포항시"}
    assert out["평택시"].shp_code == "41220" and out["평택시"].cargo_count == 1000.0
    assert out["포항시"].shp_code is None and out["포항시"].cargo_count == 0.0
    # the dropped district still counts in its province
    assert out["평택시"].importance == pytest.approx(0.6 * 0.5**0.5 + 0.4 * 0.5**0.5)


# --- serving ----------------------------------------------------------------------------------

SITE = "name string, road_address string, suitability double, profitability double, parking int, total double, contract_status string, remarks string"


def test_edits_apply_to_all_snapshots_and_clear_remarks(spark):
    sites = spark.createDataFrame(
        [("a", "r1", 0.55, 0.8, 3, 26.5, "후보", "old"), ("a", "r1", 0.5, 0.8, 3, 24.0, "후보", "x"),
         ("b", "r2", 0.5, 0.8, 3, 24.0, "후보", "keep")],
        SITE,
    )
    log = spark.createDataFrame(
        [("a", "r1", 1, 4, "협의", "first"), ("a", "r1", 2, 5, "계약", None)],
        "name string, road_address string, ts int, parking int, contract_status string, remarks string",
    )
    edits = serve.latest_edits(log, ["name", "road_address"], ["ts"])
    out = {(r.name, r.suitability): r for r in serve.apply_edits(sites, edits).collect()}
    assert out["a", 0.55].total == pytest.approx(0.55 * 0.8 * 100) and out["a", 0.55].remarks is None
    assert out["a", 0.5].contract_status == "계약" and out["a", 0.5].parking == 5
    assert tuple(out["b", 0.5]) == ("b", "r2", 0.5, 0.8, 3, 24.0, "후보", "keep")


def test_changed_rows_treats_null_as_equal(spark):
    schema = "k int, s string, g int"
    shown = spark.createDataFrame([(1, "a", None), (2, "a", 1), (3, None, 1)], schema)
    edited = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", 1)], schema)
    assert rows(serve.changed_rows(shown, edited, ["k"], ["s", "g"])) == [(2, "a", None), (3, "b", 1)]


def test_top_is_a_bounded_sort(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 10).alias("v"))
    top = serve.ranked_top(df, 3, [F.desc("v"), F.asc("id")])
    assert rows(top) == [(19, 9, 2), (29, 9, 3), (9, 9, 1)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_target_and_audits(spark):
    assert serve.split_target(" 경기도 수원시 팔달구 ") == ("경기", "수원시 팔달구")
    assert serve.split_target("경기") == ("경기", "") and serve.split_target(" ") == ("", "")
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "year int, month int")
    assert rows(serve.pk_duplicates(df, ["year", "month"])) == [(1, 1, 2)]
    expected = spark.createDataFrame([(1, 1), (3, 1)], "year int, month int")
    assert rows(serve.completeness(df, expected, ["year", "month"])) == [(1, 1, 2, True), (3, 1, 0, False)]


# --- owners and gold --------------------------------------------------------------------------


def test_owner_is_last_name_of_last_page_with_one(spark):
    lines = spark.createDataFrame(
        [("경기도_평택시_12-1_2024-01-02", 1, 1, "김가나"), ("경기도_평택시_12-1_2024-01-02", 2, 1, "이다라 외 3인"),
         ("경기도_평택시_12-1_2024-01-02", 2, 2, "박마바"), ("경기도_평택시_12-1_2024-01-02", 3, 9, "No 1"),
         ("경기도_평택시_7_2024-01-02", 1, 1, "소유자 미상"), ("short_1", 1, 1, "김가나")],
        "doc string, page int, line_no int, text string",
    )
    assert rows(ownership.ownership_from_lines(lines)) == [("경기도 평택시", "12", "1", "2024-01-02", "박마바")]


def test_gold_joins_adjacent_lots_of_one_owner(spark):
    schema = (
        "parcel_id string, dong string, lot_main string, lot_sub string, region string, owner string, "
        "category string, co_owner_count int, change_date date, building_pk string, register_code string, "
        "idle_area double, name string, biz_type string, rep string, rep_count int, road_address string, "
        "longitude double, latitude double"
    )
    place = ("경기도 양평군 용문면", "12")
    site = ("가게", "일반음식점", "홍길동", 1, "경기도 양평군 용문로 1", 127.0, 37.0)
    empty = (None,) * 7
    owned = spark.createDataFrame(
        [
            ("p1", *place, "1", "경기", "홍*동", "대", 0, None, "b1", "1", 1000.0, *site),
            ("p1", *place, "1", "경기", "홍*동", "대", 0, None, "b1", "1", 1000.0, *site),
            ("p2", *place, "2", "경기", "홍*동", "대", 0, None, None, None, 500.0, *empty),
            ("p3", *place, "3", "경기", "김*", "대", 0, None, None, None, 900.0, *empty),
        ],
        schema,
    )
    (row,) = stages.gold_sites(owned, stages.lot_areas(owned)).collect()
    assert row.idle_area == 1500.0 and row.sigungu == "양평군"
    # 0.4 type + 0.3 name + 0.15 register + 0.1 co-owners + 0.05 single representative
    assert row.suitability == 1.0 and row.profitability == 0.79 and row.parking == 3
    assert row.total == 47.7
