"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.queries.registry import Tables, query
from lotscout.queries.roles import ROLES, Role
from lotscout.sources import schemas, text_files
from lotscout.sources.manifest import Table
from lotscout.sources.snapshot import (
    new_path,
    read_latest,
    replace_snapshots,
    write_snapshot as write_one_snapshot,
)
from lotscout.sources.text_files import KOREAN_CHARSET

_BUILDING_COLUMNS = list(ROLES["bronze_building"].columns)[:-1]
_COORD_COLUMNS = list(ROLES["bronze_coord"].columns)[:-1]


def _lines(df: DataFrame, columns: list[str]) -> DataFrame:
    cells = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    return df.select(F.concat_ws("|", *cells).alias("value"))


@query(
    f"SELECT {', '.join(f'''nullif({c}, '') AS {c}''' for c in _BUILDING_COLUMNS)} FROM bronze_building"
)
def ingest_delimited(t: Tables) -> DataFrame:
    path = new_path(t.spark, "building-text")
    _lines(t.bronze_building, _BUILDING_COLUMNS).write.text(path)
    return text_files.read_delimited(t.spark, path, _BUILDING_COLUMNS, blank_as_null=True)


@query(f"SELECT {', '.join(f'''coalesce({c}, '') AS {c}''' for c in _COORD_COLUMNS)} FROM bronze_coord")
def ingest_charset(t: Tables) -> DataFrame:
    """Half of the provinces arrive in the Korean charset, the others in UTF-8."""
    path = new_path(t.spark, "coord-text")
    korean = F.col("region").isin("경기", "서울")
    with text_files.java_charsets(t.spark):
        encoded = F.encode("value", KOREAN_CHARSET).cast("string").alias("value")
        first = _lines(t.bronze_coord.filter(korean), _COORD_COLUMNS).select(encoded)
        first.write.text(f"{path}/korean")
    _lines(t.bronze_coord.filter(~korean), _COORD_COLUMNS).write.text(f"{path}/utf8")
    return text_files.read_delimited(t.spark, [f"{path}/korean", f"{path}/utf8"], _COORD_COLUMNS)


_AS_IS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_FIRST, _SECOND = _COORD_COLUMNS[:2]
_JOINED = f"coalesce({_FIRST}, '') || ', ' || coalesce({_SECOND}, '')"
_OTHERS = ", ".join(f"coalesce({c}, '') AS {c}" for c in _COORD_COLUMNS[1:])


@query(f"SELECT {_JOINED} AS {_FIRST}, {_OTHERS} FROM bronze_coord")
def ingest_header(t: Tables) -> DataFrame:
    """Files with a header: columns in two orders, in two charsets, with commas inside quotes."""
    path = new_path(t.spark, "coord-csv")
    korean = F.col("region").isin("경기", "서울")
    rows = t.bronze_coord.withColumn(_FIRST, F.expr(_JOINED))
    with text_files.java_charsets(t.spark):
        first = rows.filter(korean).select(*reversed(_COORD_COLUMNS))
        first.write.csv(f"{path}/korean", encoding=KOREAN_CHARSET, **_AS_IS)
    rows.filter(~korean).select(*_COORD_COLUMNS).write.csv(f"{path}/utf8", **_AS_IS)
    paths = [f"{path}/korean", f"{path}/utf8"]
    return text_files.read_delimited(t.spark, paths, _COORD_COLUMNS, sep=",", header=True)


_BROKEN = f"coalesce({_FIRST}, '') || chr(10) || '\"' || coalesce({_SECOND}, '') || '\",' || chr(10) || chr(10) || 'x'"


@query(f"SELECT {_BROKEN} AS {_FIRST}, {_OTHERS} FROM bronze_coord")
def ingest_quoted(t: Tables) -> DataFrame:
    """Files with a header, in two charsets, whose records hold quotes, separators and line breaks."""
    path = new_path(t.spark, "coord-quoted")
    korean = F.col("region").isin("경기", "서울")
    rows = t.bronze_coord.withColumn(_FIRST, F.expr(_BROKEN)).select("region", *_COORD_COLUMNS)
    as_is = {**_AS_IS, "quoteAll": True, "escape": '"'}
    with text_files.java_charsets(t.spark):
        rows.filter(korean).drop("region").write.csv(f"{path}/korean", encoding=KOREAN_CHARSET, **as_is)
    rows.filter(~korean).drop("region").write.csv(f"{path}/utf8", **as_is)
    paths = [f"{path}/korean", f"{path}/utf8"]
    return text_files.read_delimited(t.spark, paths, _COORD_COLUMNS, sep=",", header=True, quoted=True)


@query("SELECT name, rep, address, biz_type, region FROM bronze_restaurant WHERE region = '경기'")
def scan_region_pruned(t: Tables) -> DataFrame:
    base = new_path(t.spark, "restaurant")
    write_one_snapshot(t.bronze_restaurant, base, {"year": 2024, "month": 5, "week": 2})
    latest = read_latest(t.spark, base).filter(F.col("region") == "경기")
    return latest.select(*schemas.RESTAURANT_NAMES.values())


_SITES = Role(
    "orders",
    {
        "o_orderkey": "o_orderkey",
        "o_totalprice": "o_totalprice",
        "year": "CAST(year(o_orderdate) AS INT)",
        "month": "CAST(month(o_orderdate) AS INT)",
        "region": "o_orderstatus",
    },
)


@query(
    """SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, 2024 AS year, 5 AS month, 2 AS week, o_orderstatus AS region
FROM orders WHERE o_orderstatus <> 'P'"""
)
def write_snapshot(t: Tables) -> DataFrame:
    """The newest snapshot after a rerun that lost one region and changed every price."""
    base = new_path(t.spark, "sites")
    rows = _SITES.frame(t.spark, t.sf_dir).drop("year", "month")
    rerun = rows.filter(F.col("region") != "P")
    doubled = rerun.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_one_snapshot(rows, base, {"year": 2024, "month": 5, "week": 1})
    write_one_snapshot(rows, base, {"year": 2024, "month": 5, "week": 2})
    write_one_snapshot(doubled, base, {"year": 2024, "month": 5, "week": 2})
    return read_latest(t.spark, base).select(
        "o_orderkey", "o_totalprice", "year", "month", "week", "region"
    )


@query(
    """SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, 2024 AS year, 5 AS month, 2 AS week, o_orderstatus AS region
FROM orders WHERE o_orderstatus <> 'P'"""
)
def commit_snapshot(t: Tables) -> DataFrame:
    """As write_snapshot, committed by manifest, with the versions that were replaced removed."""
    base = new_path(t.spark, "committed")
    table = Table(t.spark, base)
    rows = _SITES.frame(t.spark, t.sf_dir).drop("year", "month")
    doubled = rows.filter(F.col("region") != "P").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for week, batch in ((1, rows), (2, rows), (2, doubled)):
        table.write(batch, {"year": 2024, "month": 5, "week": week}, ("region",))
    table.remove_old(grace_s=0)
    return read_latest(t.spark, base).select(
        "o_orderkey", "o_totalprice", "year", "month", "week", "region"
    )


@query(
    f"""SELECT o_orderkey, CASE WHEN year = 1996 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, region, year, month
FROM ({_SITES.sql()}) WHERE year <> 1996 OR region = 'F'"""
)
def replace_snapshot(t: Tables) -> DataFrame:
    """All months, then 1996 again with one region only, twice: the second pass changes nothing."""
    base = new_path(t.spark, "replaced")
    rows = _SITES.frame(t.spark, t.sf_dir)
    year = rows.filter((F.col("year") == 1996) & (F.col("region") == "F"))
    again = year.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for batch in (rows, again, again):
        replace_snapshots(batch, base, ["year", "month"])
    columns = ("o_orderkey", "o_totalprice", "region", "year", "month")
    return t.spark.read.parquet(base).select(*columns)
