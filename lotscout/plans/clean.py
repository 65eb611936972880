"""Raw tables to clean tables, one function per domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.functions import dates, keys, text
from lotscout.operators.filters import present
from lotscout.operators.latest import first_per_key, latest_per_key


def _road_address():
    parts = ("sido", "sigungu", "road", "bldg_main", "bldg_sub")
    return keys.road_address(*map(F.col, parts)).alias("road_address")


def clean_restaurant(raw: DataFrame, region: str | None = None) -> DataFrame:
    """Restaurants with a clean address, first representative and number of representatives."""
    rows = raw if region is None else raw.filter(F.col("region") == region)
    complete = present(rows, "name", "rep", "address")
    clean = complete.select(
        "name",
        text.clean_representative(F.col("rep")).alias("rep"),
        text.clean_address(F.col("address")).alias("address"),
        "biz_type",
        "region",
        text.representative_count(F.col("rep")).alias("rep_count"),
    )
    return first_per_key(clean, ["name", "address"])


def clean_address(raw: DataFrame) -> DataFrame:
    """Parcel id per road address."""
    parts = ("dong_code", "mountain_flag", "lot_main", "lot_sub")
    parcel_id = keys.parcel_id_from_address(*map(F.col, parts)).alias("parcel_id")
    return first_per_key(raw.select(parcel_id, _road_address(), "region"), ["road_address"])


def clean_coord(raw: DataFrame) -> DataFrame:
    """Grid coordinates per road address."""
    x, y = (text.safe_double(F.col(c)).alias(c) for c in ("x", "y"))
    return first_per_key(raw.select(_road_address(), x, y, "region"), ["road_address"])


def clean_building(raw: DataFrame) -> DataFrame:
    """Buildings with their parcel id and areas."""
    parts = ("sigungu_code", "dong_code", "land_flag", "bun", "ji")
    return raw.select(
        "building_pk",
        keys.parcel_id_from_building(*map(F.col, parts)).alias("parcel_id"),
        "register_code",
        text.safe_double(F.col("building_area")).alias("building_area"),
        text.safe_double(F.col("outdoor_parking_area")).alias("outdoor_parking_area"),
        "region",
    )


def clean_parcel(raw: DataFrame, owner_code: int = 1) -> DataFrame:
    """Privately owned parcels: the newest ownership change per parcel, lot number split."""
    private = raw.filter(F.col("owner_code").try_cast("int") == owner_code).select(
        F.col("parcel_id").cast("string").alias("parcel_id"),
        "dong",
        "category",
        F.col("land_area").try_cast("double").alias("land_area"),
        F.col("co_owner_count").try_cast("int").alias("co_owner_count"),
        dates.tolerant_date(F.col("change_date")).alias("change_date"),
        "region",
        "lot",
    )
    newest = latest_per_key(private, ["parcel_id"], ["change_date"])
    lot_main, lot_sub = text.lot_main(F.col("lot")), text.lot_sub(F.col("lot"))
    return newest.withColumn("lot_main", lot_main).withColumn("lot_sub", lot_sub).drop("lot")
