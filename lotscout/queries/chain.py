"""The whole chain from raw tables to scored sites, one query per stage."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.operators.joins import groups_with
from lotscout.plans import clean, stages
from lotscout.queries.registry import Tables, query
from lotscout.sources.snapshot import stage_table


class Chain:
    """Stages over the domain roles.

    Written between them, as the jobs do, are the stages that feed more than one reader or are
    looked up by the key they were grouped by.
    """

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def restaurant(self) -> DataFrame:
        return clean.clean_restaurant(self.t.bronze_restaurant)

    @cached_property
    def address(self) -> DataFrame:
        address, coord = self.t.bronze_address, self.t.bronze_coord
        return stages.s0_address(clean.clean_address(address), clean.clean_coord(coord))

    @cached_property
    def parcel(self) -> DataFrame:
        # both are read twice, as written tables, as by the monthly job
        building = stage_table(clean.clean_building(self.t.bronze_building), "building")
        parcel = stage_table(clean.clean_parcel(self.t.bronze_parcel), "parcel")
        return stages.s0_parcel(parcel, building)

    @cached_property
    def located(self) -> DataFrame:
        return stages.s1_located(self.restaurant, stage_table(self.address, "s0_address"))

    @cached_property
    def candidates(self) -> DataFrame:
        parcels = stage_table(self.parcel, "s0_parcel")
        marked = stages.restaurant_parcels(parcels, stage_table(self.located, "s1_located"))
        marked = stage_table(marked, "restaurant_parcels")
        groups = stage_table(groups_with(marked, stages.GROUP, "name"), "marked_groups")
        return stages.s1_candidates(parcels, marked, groups)

    @cached_property
    def owned(self) -> DataFrame:
        return stages.s2_owner(self.candidates, self.t.ownership)

    @cached_property
    def gold(self) -> DataFrame:
        owned = stage_table(self.owned, "s2_owner")
        return stages.gold_sites(owned, stage_table(stages.lot_areas(owned), "lot_areas"))


def _rounded_position(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in ("longitude", "latitude")})


_POSITION = "round(longitude, 9) AS longitude, round(latitude, 9) AS latitude"


@query("SELECT * FROM clean_restaurant")
def clean_restaurant(t: Tables) -> DataFrame:
    return Chain(t).restaurant


@query("SELECT * FROM clean_address")
def clean_address(t: Tables) -> DataFrame:
    return clean.clean_address(t.bronze_address)


@query("SELECT * FROM clean_coord")
def clean_coord(t: Tables) -> DataFrame:
    return clean.clean_coord(t.bronze_coord)


@query("SELECT * FROM clean_building")
def clean_building(t: Tables) -> DataFrame:
    return clean.clean_building(t.bronze_building)


@query("SELECT * FROM clean_parcel")
def clean_parcel(t: Tables) -> DataFrame:
    return clean.clean_parcel(t.bronze_parcel)


@query(f"SELECT * REPLACE ({_POSITION}) FROM s0_address")
def s0_address(t: Tables) -> DataFrame:
    return _rounded_position(Chain(t).address)


@query("SELECT * FROM s0_parcel")
def s0_parcel(t: Tables) -> DataFrame:
    return Chain(t).parcel


@query(f"SELECT * REPLACE ({_POSITION}) FROM s1_located")
def s1_located(t: Tables) -> DataFrame:
    return _rounded_position(Chain(t).located)


@query(f"SELECT * REPLACE ({_POSITION}) FROM s1_candidates")
def s1_candidates(t: Tables) -> DataFrame:
    return _rounded_position(Chain(t).candidates)


@query("SELECT * FROM s1_fetch_list")
def s1_fetch_list(t: Tables) -> DataFrame:
    return stages.s1_fetch_list(Chain(t).candidates)


@query(f"SELECT * REPLACE ({_POSITION}) FROM s2_owner")
def s2_owner(t: Tables) -> DataFrame:
    return _rounded_position(Chain(t).owned)


@query(f"SELECT * REPLACE ({_POSITION}, round(idle_area, 6) AS idle_area) FROM gold_sites")
def gold_sites(t: Tables) -> DataFrame:
    return _rounded_position(Chain(t).gold).withColumn("idle_area", F.round("idle_area", 6))
