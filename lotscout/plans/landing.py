"""Raw files to raw tables: one snapshot per source, partitioned by region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.functions import dates
from lotscout.functions.text import strip_label
from lotscout.operators.joins import unmapped
from lotscout.plans.jobs import WEEKLY, Lake, stamp_values
from lotscout.plans.ownership import ownership_from_lines
from lotscout.plans.regional import regional_importance
from lotscout.sources import regions, schemas
from lotscout.sources.manifest import Table
from lotscout.sources.snapshot import write_snapshot
from lotscout.sources.text_files import header_columns, read_delimited

def _land(lake: Lake, df: DataFrame, name: str, month: tuple[int, int]) -> None:
    Table(lake.spark, lake.path(name)).write(df, {"year": month[0], "month": month[1]}, ("region",))


def previous_month(lake: Lake) -> tuple[int, int]:
    """Monthly registers published this month describe the month before."""
    day = lake.as_of
    return (day.year, day.month - 1) if day.month > 1 else (day.year - 1, 12)


def land_address(lake: Lake, files: str, month: tuple[int, int] | None = None) -> None:
    """Province files of road addresses, 24 columns without a header."""
    region = regions.region_from_file_name(F.col("file_name"), regions.ADDRESS_FILE)
    rows = read_delimited(lake.spark, files, schemas.ADDRESS_COLUMNS, region)
    _land(lake, rows, "raw_address", month or previous_month(lake))


def land_coord(lake: Lake, files: str, month: tuple[int, int] | None = None) -> None:
    """Province files of entrance coordinates, 18 columns without a header."""
    region = regions.region_from_file_name(F.col("file_name"), regions.COORD_FILE)
    rows = read_delimited(lake.spark, files, schemas.COORD_COLUMNS, region)
    _land(lake, rows, "raw_coord", month or previous_month(lake))


def land_building(lake: Lake, files: str, month: tuple[int, int]) -> None:
    """The national building register, 77 columns; the region comes from the address of the lot."""
    rows = read_delimited(lake.spark, files, schemas.BUILDING_COLUMNS, blank_as_null=True)
    _land(lake, regions.with_region_of_address(rows, "대지_위치"), "raw_building", month)


def land_parcel(lake: Lake, files: str, month: tuple[int, int] | None = None) -> None:
    """Province files of parcels with a header; the region is a code in the file name."""
    columns = header_columns(lake.spark, files)
    region = regions.region_from_file_code(F.col("file_name"))
    rows = read_delimited(
        lake.spark, files, columns, region, sep=",", blank_as_null=True, header=True, quoted=True
    )
    _land(lake, rows, "raw_parcel", month or previous_month(lake))


def quarter_of_files(lake: Lake, files: str) -> str:
    """The one quarter (such as 2024Q3) whose last month, yyyyMM, stands in the names of the files."""
    names = lake.spark.read.format("binaryFile").load(files).select(F.col("path"))
    month = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"(20\d{4})", 1)
    end = F.date_format(F.last_day(F.try_to_date(month, "yyyyMM")), "yyyyMMdd")
    found = names.select(dates.quarter_tag(end).alias("q")).distinct().limit(2).collect()
    if len(found) != 1 or found[0]["q"] is None:
        raise ValueError(f"the files of {files} are not of one quarter")
    return found[0]["q"]


def land_stores(lake: Lake, files: str, target: str, quarter: str | None = None) -> None:
    """Store files of one quarter, by default the one in their names, with a header and a region
    suffix in the name.

    Readers of stores know directories; a failed or empty run leaves the quarter as it was.
    """
    columns = header_columns(lake.spark, files)
    region = regions.region_from_store_file(F.col("file_name"))
    rows = read_delimited(
        lake.spark, files, columns, region, sep=",", blank_as_null=True, header=True, quoted=True
    )
    write_snapshot(rows, target, {"dataset": quarter or quarter_of_files(lake, files)})


def land_restaurants(lake: Lake, cells: DataFrame) -> None:
    """Scraped licence rows, cells as text: a cell may repeat its column's header in front.

    The region comes from the address; rows of pages that were read twice are kept once.
    """
    stripped = cells.select(*(strip_label(F.col(f"`{c}`"), c).alias(c) for c in schemas.LICENCE_COLUMNS))
    rows = regions.with_region_of_address(stripped.distinct(), "소재지")
    Table(lake.spark, lake.path("raw_restaurant")).write(rows, stamp_values(lake.as_of, WEEKLY), ("region",))


def land_districts(lake: Lake, sheet: DataFrame, codes: DataFrame, month: tuple[int, int]) -> None:
    """Importance per district from a table of registered vehicles (sido, sigungu, cargo_count).

    Districts that the code map does not know are reported beside it.
    """
    scored = regional_importance(sheet, codes)
    named = scored.withColumnsRenamed({"shp_code": "SHP_CD", "importance": "전략적_중요도"})
    values = {"year": month[0], "month": month[1]}
    Table(lake.spark, lake.path("gold_districts")).write(named, values)
    unknown = unmapped(scored.select("sido", "sigungu"), codes, ["sido", "sigungu"])
    Table(lake.spark, lake.path("unmapped_districts")).write(unknown, values, may_be_empty=True)


def land_ownership(lake: Lake, lines: DataFrame) -> None:
    """Owners from recognised register text, with the region their join needs."""
    owners = regions.with_region_of_address(ownership_from_lines(lines), "address")
    rows = schemas.to_source(owners, schemas.OWNERSHIP_NAMES)
    Table(lake.spark, lake.path("ownership")).write(rows, stamp_values(lake.as_of, WEEKLY), ("region",))
