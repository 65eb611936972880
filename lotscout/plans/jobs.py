"""The scheduled jobs over a lake folder: monthly, weekly, gold and load.

Every job reads the newest snapshot of its inputs that is not after `as_of` and replaces the snapshot
of `as_of` in its outputs, so that a rerun changes nothing, whatever snapshots came later. Between
stages the data lives in written tables, committed by manifest.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotscout.functions.text import nfc_strip
from lotscout.operators.joins import groups_with
from lotscout.operators.state import carried, to_try
from lotscout.plans import clean, serving, stages
from lotscout.session import tuned
from lotscout.sources import gate, schemas
from lotscout.sources.manifest import Table
from lotscout.sources.snapshot import LEVELS, read_latest, stage_folder, stage_table

MONTHLY = LEVELS[:2]
WEEKLY = LEVELS

# Folders of the lake.
FOLDERS = {
    "raw_address": "bronze/address/parquet",
    "raw_coord": "bronze/coord/parquet",
    "raw_building": "bronze/buildingLeader/parquet",
    "raw_parcel": "bronze/tojiSoyuJeongbo/parquet",
    "raw_restaurant": "bronze/restaurant_owner/parquet",
    "address": "silver/clean/address",
    "coord": "silver/clean/coord",
    "building": "silver/clean/building",
    "parcel": "silver/clean/toji",
    "restaurant": "silver/clean/restaurant",
    "s0_address": "silver/s0/address",
    "s0_parcel": "silver/s0/toji_building",
    "s1_located": "silver/s1/restaurant_coord",
    "s1_candidates": "silver/s1/toji_list",
    "s1_fetch_list": "silver/s1/crawling_list",
    "fetch_state": "silver/s1/fetch_state",
    "ownership": "silver/s2/ownership_inference",
    "s2_owner": "silver/s2/toji_owner_match",
    "gold_sites": "gold/restaurant",
    "gold_districts": "gold/chajoo_dist",
    "unmapped_districts": "gold/chajoo_dist_unmapped",
    "gold_lots": "gold/parking_area",
}
FETCH_KEY = ["dong", "lot_main", "change_date", "region"]
FETCH_NAMES = {
    "법정동명": "dong", "본번": "lot_main", "소유권변동일자": "change_date", "부번": "lot_sub",
    "region": "region",
}


def week_number(day: date) -> int:
    """Week of the month of a driver-side date, as functions.dates.week_of_month."""
    first_monday_offset = -day.replace(day=1).weekday() % 7
    return (day.day - first_monday_offset + 6) // 7


def stamp_values(day: date, levels: tuple[str, ...]) -> dict[str, int]:
    values = {"year": day.year, "month": day.month, "week": week_number(day)}
    return {level: values[level] for level in levels}


class Lake:
    """Tables of a lake folder by name; `folders` replaces some of their places."""

    def __init__(
        self, spark: SparkSession, root: str, as_of: date, folders: dict[str, str] | None = None
    ):
        self.spark, self.root, self.as_of = tuned(spark), root.rstrip("/"), as_of
        self.folders = {**FOLDERS, **(folders or {})}

    def path(self, name: str) -> str:
        return f"{self.root}/{self.folders[name]}"

    def latest(self, name: str, levels: tuple[str, ...] = MONTHLY) -> DataFrame:
        upto = stamp_values(self.as_of, levels)
        return read_latest(self.spark, self.path(name), levels, upto).drop(*levels)

    def raw(
        self, name: str, names: dict[str, str], levels: tuple[str, ...] = MONTHLY
    ) -> DataFrame:
        return schemas.to_domain(self.latest(name, levels), names)

    def write(
        self,
        df: DataFrame,
        name: str,
        levels: tuple[str, ...] = MONTHLY,
        may_be_empty: bool = False,
    ) -> None:
        values = stamp_values(self.as_of, levels)
        Table(self.spark, self.path(name)).write(df, values, ("region",), may_be_empty)


def cleans_up(job: Callable) -> Callable:
    """Remove what the job has staged when it ends; its outputs are committed tables by then."""

    @wraps(job)
    def run(lake: Lake, *args, **kwargs):
        with stage_folder(lake.spark):
            return job(lake, *args, **kwargs)

    return run


@cleans_up
def run_monthly(lake: Lake) -> None:
    """Clean registers, addresses with positions, and parkable parcels."""
    lake.write(clean.clean_address(lake.raw("raw_address", schemas.ADDRESS_NAMES)), "address")
    lake.write(clean.clean_coord(lake.raw("raw_coord", schemas.COORD_NAMES)), "coord")
    lake.write(clean.clean_building(lake.raw("raw_building", schemas.BUILDING_NAMES)), "building")
    lake.write(clean.clean_parcel(lake.raw("raw_parcel", schemas.PARCEL_NAMES)), "parcel")
    lake.write(stages.s0_address(lake.latest("address"), lake.latest("coord")), "s0_address")
    lake.write(stages.s0_parcel(lake.latest("parcel"), lake.latest("building")), "s0_parcel")


@cleans_up
def run_weekly(lake: Lake, region: str | None, changed_days: int | None = None) -> None:
    """Restaurants, candidate parcels and the list of registers to fetch."""
    raw = lake.raw("raw_restaurant", schemas.RESTAURANT_NAMES, WEEKLY)
    lake.write(clean.clean_restaurant(raw, region), "restaurant", WEEKLY)
    located = stages.s1_located(lake.latest("restaurant", WEEKLY), lake.latest("s0_address"))
    lake.write(located, "s1_located", WEEKLY)
    parcels = lake.latest("s0_parcel")
    # read twice, for the groups and as part of the result
    marked = stages.restaurant_parcels(parcels, lake.latest("s1_located", WEEKLY))
    marked = stage_table(marked, "restaurant_parcels")
    groups = stage_table(groups_with(marked, stages.GROUP, "name"), "marked_groups")
    candidates = stages.s1_candidates(parcels, marked, groups)
    lake.write(candidates, "s1_candidates", WEEKLY)
    fetch = stages.s1_fetch_list(
        lake.latest("s1_candidates", WEEKLY), lake.as_of, changed_days
    )
    fetch = schemas.to_source(fetch, FETCH_NAMES)
    lake.write(fetch, "s1_fetch_list", WEEKLY, may_be_empty=changed_days is not None)


@cleans_up
def run_fetching(lake: Lake, outcomes: DataFrame, max_attempts: int = 5) -> DataFrame:
    """Carry the state of register fetching over one week; returns what is to be tried next.

    `outcomes` has one row per try of this week: dong, lot_main, change_date, region, ok. The state
    of the week follows from that of an earlier week, so a rerun of the week changes nothing.
    """
    stamp = stamp_values(lake.as_of, WEEKLY)
    wanted = lake.raw("s1_fetch_list", FETCH_NAMES, WEEKLY).select(*(F.col(c).cast("string") for c in FETCH_KEY))
    table = Table(lake.spark, lake.path("fetch_state"))
    earlier = table.newest(WEEKLY, upto=(stamp["year"], stamp["month"], stamp["week"] - 1))
    tried = outcomes.select(*(F.col(c).cast("string") for c in FETCH_KEY), "ok")
    run = F.lit(stamp["year"] * 1000 + stamp["month"] * 10 + stamp["week"])
    state = carried(table.read(earlier) if earlier else None, wanted, tried, FETCH_KEY, run, max_attempts)
    lake.write(state, "fetch_state", WEEKLY)
    return to_try(lake.latest("fetch_state", WEEKLY))


@cleans_up
def run_gold(lake: Lake, regions: Sequence[str] = ()) -> None:
    """Owners matched to candidates, and scored sites.

    The job is refused while a complete snapshot of its inputs lacks, or the part of one of the
    `regions` in it; the error names all that lacks.
    """
    needs = [gate.Need(n, lake.path(n), WEEKLY, tuple(regions)) for n in ("s1_candidates", "ownership")]
    gate.require(lake.spark, needs, stamp_values(lake.as_of, WEEKLY))
    ownership = lake.raw("ownership", schemas.OWNERSHIP_NAMES, WEEKLY)
    ownership = ownership.withColumn("change_date", F.try_to_date(F.col("change_date").cast("string")))
    owned = stages.s2_owner(lake.latest("s1_candidates", WEEKLY), ownership)
    lake.write(owned, "s2_owner", WEEKLY)
    matched = lake.latest("s2_owner", WEEKLY)
    sites = stages.gold_sites(matched, stage_table(stages.lot_areas(matched), "lot_areas"))
    lake.write(schemas.to_source(sites, schemas.SITE_NAMES), "gold_sites", WEEKLY)


def _normalized(df: DataFrame) -> DataFrame:
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: nfc_strip(c) for c in strings})


def _rows_to_load(
    lake: Lake,
    name: str,
    levels: tuple[str, ...],
    schema: T.StructType,
    aliases: dict[str, str],
    required: tuple[str, ...] = (),
    stamp: dict[str, Column] | None = None,
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    newest = read_latest(lake.spark, lake.path(name), levels, stamp_values(lake.as_of, levels))
    rows = schemas.conform(newest, schema, stamp, aliases, defaults)
    return _normalized(schemas.require_text(rows, required))


def served_table(spark: SparkSession, served: str, schema: T.StructType) -> DataFrame:
    """A served table with its declared types, snapshot columns included."""
    table = Table(tuned(spark), served)
    return table.read() if table.exists() else spark.read.schema(schema).parquet(served)


@cleans_up
def load_sites(lake: Lake, served: str) -> None:
    """Newest gold sites into the served table, in place of an earlier load of that snapshot.

    A site is served once per snapshot; rows that lose against another one of their key are listed
    in the quarantine table beside it. Edits of the sites are applied again.
    """
    rows = _rows_to_load(
        lake,
        "gold_sites",
        WEEKLY,
        schemas.SERVED_SITE,
        aliases=schemas.SITE_NAMES,
        required=("name", "road_address"),
        defaults={"contract_status": F.lit(schemas.DEFAULT_STATUS)},
    )
    serving.load(rows, served)


@cleans_up
def load_districts(lake: Lake, served: str) -> None:
    """Newest district importance into the served table, with year and two-digit month as text."""
    aliases = {"SHP_CD": "shp_code", "전략적_중요도": "importance"}
    month = F.lpad(F.col("month").cast("string"), 2, "0")
    stamp = {"year": F.col("year").cast("string"), "month": month}
    rows = _rows_to_load(lake, "gold_districts", MONTHLY, schemas.SERVED_DISTRICT, aliases, stamp=stamp)
    Table(lake.spark, served).replace(rows, MONTHLY)


@cleans_up
def load_lots(lake: Lake, served: str) -> None:
    """Public lots; the whole served table is replaced."""
    aliases = {"공영차고지명": "lot_name", "주소": "address"}
    Table(lake.spark, served).replace(_rows_to_load(lake, "gold_lots", MONTHLY, schemas.SERVED_LOT, aliases), ())
