"""Clean tables to ranked sites: s0 (integrate), s1 (candidates), s2 (owners), gold (scores)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.functions import geo, score, text
from lotscout.operators.aggregates import max_then_sum, smallest_per_group
from lotscout.operators.filters import changed_since, present
from lotscout.operators.joins import (
    in_groups,
    left_join_one,
    union_padded,
    with_single_child,
)
from lotscout.operators.latest import first_per_key
from lotscout.sources.schemas import SITE_NAMES

# Land categories that can hold a parking lot.
PARKABLE = ("대", "잡종지", "주차장")


def s0_address(address: DataFrame, coord: DataFrame) -> DataFrame:
    """Road addresses with parcel id and WGS84 position."""
    joined = left_join_one(address, coord, ["road_address"])
    return geo.with_wgs84(joined).select(
        "region", "parcel_id", "road_address", "longitude", "latitude"
    )


def s0_parcel(
    parcel: DataFrame,
    building: DataFrame,
    categories: Sequence[str] = PARKABLE,
) -> DataFrame:
    """Parkable parcels with no or one building, and the ground left free.

    The category filter runs before the join: after the newest-row step it is one value per parcel.
    """
    parkable = parcel.filter(F.col("category").isin(*categories))
    sparse = with_single_child(parkable, building.drop("region"), "parcel_id", "building_pk")
    free = score.idle_area(
        F.col("land_area"), F.col("building_area"), F.col("outdoor_parking_area")
    )
    return sparse.withColumn("idle_area", free).drop(
        "land_area", "building_area", "outdoor_parking_area"
    )


def s1_located(restaurant: DataFrame, address: DataFrame) -> DataFrame:
    """Restaurants whose clean address is a known road address with a parcel."""
    place = present(address, "parcel_id").select(
        "road_address", "parcel_id", "longitude", "latitude"
    )
    return restaurant.withColumnRenamed("address", "road_address").join(place, "road_address")


GROUP = ["dong", "lot_main"]


def restaurant_parcels(parcels: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Built-up parcels, once per restaurant on them, in lot groups that have a name."""
    built_up = parcels.filter(F.col("building_pk").isNotNull())
    return built_up.join(present(restaurants.drop("region"), "name"), "parcel_id").dropna(subset=GROUP)


def s1_candidates(parcels: DataFrame, marked: DataFrame, groups: DataFrame) -> DataFrame:
    """Parcels of the lot groups that hold a restaurant.

    `marked` are the parcels with a restaurant (`restaurant_parcels`), `groups` their lot groups
    (`joins.groups_with`), both written tables; empty parcels follow with NULL in the restaurant's place.
    """
    empty = parcels.filter(F.col("building_pk").isNull())
    return union_padded(marked, in_groups(empty, groups, GROUP))


def s1_fetch_list(
    candidates: DataFrame, as_of: date | None = None, changed_days: int | None = None
) -> DataFrame:
    """Lot groups whose register has to be fetched, optionally only those changed lately."""
    group = ["dong", "lot_main", "change_date", "region"]
    groups = smallest_per_group(candidates, group, "lot_sub")
    if changed_days is None:
        return groups
    return changed_since(groups, "change_date", as_of, changed_days)


def s2_owner(candidates: DataFrame, ownership: DataFrame) -> DataFrame:
    """Candidates with the owner read from the register of the same lot and change date."""
    key = ["dong", "lot_main", "change_date"]
    owners = ownership.withColumnRenamed("address", "dong")
    unique = first_per_key(owners, key).select(*key, "region", "owner")
    return candidates.join(unique, [*key, "region"])


LOT = ["dong", "lot_main", "owner", "region"]


def lot_areas(owned: DataFrame) -> DataFrame:
    """Free ground of an owner in a lot group: each lot once, adjacent lots added up."""
    return max_then_sum(owned, LOT, "lot_sub", "idle_area")


def gold_sites(
    owned: DataFrame, areas: DataFrame, weights: score.ScoreWeights = score.DEFAULT_WEIGHTS
) -> DataFrame:
    """Scored restaurants, each with the whole free ground its owner has in the lot group."""
    detail = (
        present(owned, "name").drop("lot_sub", "parcel_id", "idle_area").dropDuplicates()
    )
    sites = left_join_one(detail, areas, LOT)
    parts = score.score_parts(
        F.col("biz_type"),
        F.col("rep"),
        F.col("owner"),
        F.col("register_code"),
        F.col("co_owner_count"),
        F.col("rep_count"),
        weights,
    )
    fit = score.suitability(parts)
    profit = score.profitability(F.col("idle_area"), weights)
    parking = F.lit(weights.parking)
    return sites.select(
        text.parse_district(F.col("dong")).alias("sigungu"),
        F.round(score.total_score(fit, profit, parking, weights), 2).alias("total"),
        F.round(fit, 2).alias("suitability"),
        F.round(profit, 2).alias("profitability"),
        parking.alias("parking"),
        "name",
        "road_address",
        "idle_area",
        "longitude",
        "latitude",
        "region",
    ).select(*SITE_NAMES.values())
