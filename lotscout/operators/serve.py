"""Served views: rankings, contract filters, edits and last-value lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotscout.functions.score import grade, parking_grade, total_score
from lotscout.operators.latest import latest_per_key
from lotscout.sources.regions import REGION_ALIASES
from lotscout.sources.manifest import Table
from lotscout.sources.schemas import DEFAULT_STATUS, SITE_KEY
from lotscout.sources.snapshot import LEVELS, latest_snapshot


def ranked_top(df: DataFrame, n: int, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """The first n rows in order, numbered. Only those n rows meet in one task to be numbered."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def split_target(target: str) -> tuple[str, str]:
    """"region rest of the district" to (short region, district)."""
    region, *district = target.split() or [""]
    return REGION_ALIASES.get(region, region), " ".join(district)


def sites_of_district(sites: DataFrame | Table, target: str) -> DataFrame:
    """Sites of the region's newest snapshot whose district contains the target district.

    The manifest of a served table knows that snapshot, and only the region's part of it is read; a
    table without one is scanned for it.
    """
    region, district = split_target(target)
    if isinstance(sites, Table):
        newest = sites.read(sites.newest(LEVELS, {"region": region}))
    else:
        newest = latest_snapshot(sites, LEVELS, F.col("region") == region)
    return newest.filter(F.col("sigungu").contains(district))


def top_sites(sites: DataFrame | Table, target: str, n: int = 15) -> DataFrame:
    """Best sites of a district. Sites without a total come last, ties go by name and address."""
    order = [
        F.desc_nulls_last("total"),
        F.asc("name"),
        F.asc("road_address"),
        F.desc_nulls_last("idle_area"),
        F.asc_nulls_first("remarks"),
    ]
    return ranked_top(sites_of_district(sites, target), n, order)


def active_contracts(sites: DataFrame | Table, target: str) -> DataFrame:
    """Sites of a district that moved on from the first contract status."""
    return sites_of_district(sites, target).filter(F.col("contract_status") != DEFAULT_STATUS)


def site_grid(top: DataFrame) -> DataFrame:
    """Ranked sites as shown: whole totals (half to even) and letters for the scores."""
    return top.select(
        "rank",
        "name",
        F.bround("total", 0).cast("bigint").alias("total"),
        grade(F.col("profitability")).alias("profitability"),
        grade(F.col("suitability")).alias("suitability"),
        parking_grade(F.col("parking")).alias("parking"),
        "contract_status",
        "remarks",
    )


def top_districts(districts: DataFrame, n: int = 10) -> DataFrame:
    """Districts by importance."""
    order = [F.desc_nulls_last("importance"), F.asc("sido"), F.asc("sigungu")]
    return ranked_top(districts, n, order)


def district_map(
    districts: DataFrame | Table, boundaries: DataFrame, code: str = "shp_code"
) -> DataFrame:
    """Newest district rows that have a code, joined to boundary attributes on the code as text."""
    if isinstance(districts, Table):
        newest = districts.read(districts.newest(LEVELS[:2]))
    else:
        newest = latest_snapshot(districts, LEVELS[:2])
    newest = newest.filter(F.col(code).isNotNull())
    shapes = boundaries.withColumn(code, F.col(code).cast("string"))
    return newest.withColumn(code, F.col(code).cast("string")).join(shapes, code)


def located(lots: DataFrame) -> DataFrame:
    """Public lots with both coordinates."""
    return lots.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def latest_edits(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The edit in force per key of an append-only edit log."""
    return latest_per_key(log, keys, order)


def apply_edits(
    sites: DataFrame, edits: DataFrame, on: Sequence[str] = ("name", "road_address")
) -> DataFrame:
    """Sites with the edits (parking, contract_status, remarks; one per key) applied.

    An edited row takes all three values as they are, remarks may become NULL, and its total is
    recomputed from the rounded scores. Every snapshot of the site changes.
    """
    edited = edits.select(
        *on,
        F.struct("parking", "contract_status", "remarks").alias("edit"),
    )
    joined = sites.join(edited, list(on), "left")
    has_edit = F.col("edit").isNotNull()
    total = total_score(F.col("suitability"), F.col("profitability"), F.col("edit.parking"))
    return joined.select(
        *[
            F.when(has_edit, F.col(f"edit.{c}")).otherwise(F.col(c)).alias(c)
            if c in ("parking", "contract_status", "remarks")
            else F.when(has_edit, total).otherwise(F.col(c)).alias(c)
            if c == "total"
            else F.col(c)
            for c in sites.columns
        ]
    )


def changed_rows(
    shown: DataFrame, edited: DataFrame, on: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """Edited rows that differ from the shown ones in a compared column; NULL equals NULL."""
    before = shown.select(*on, F.struct(*compare).alias("before"))
    after = F.struct(*compare)
    return edited.join(before, list(on)).filter(~after.eqNullSafe(F.col("before"))).drop("before")


def last_value(log: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Newest value per key of an append log, in place of a single-row upsert."""
    newest = log.select(key, *order, value)
    return latest_per_key(newest, [key], order)


def pk_duplicates(df: DataFrame, key: Sequence[str] = tuple(SITE_KEY)) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def first_of_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column], row_id: str) -> DataFrame:
    """Per key without NULLs, the id of the row that comes first in order; the id settles ties.

    Found with partial aggregation, so that the rows of a hot key neither meet in one task nor are
    sorted there.
    """
    place = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)), F.col(row_id).alias("id"))
    return rows.dropna(subset=list(key)).groupBy(*key).agg(F.min(place)["id"].alias("first_id"))


def judged_by_key(rows: DataFrame, firsts: DataFrame, key: Sequence[str], row_id: str) -> DataFrame:
    """Rows with a reason: NULL for the first one of each key, "repeated key" for the others, "no key"
    where a key column is NULL. `firsts` (of `first_of_key`) should be a written table."""
    known = rows.join(firsts, list(key), "left")
    reason = F.when(F.col("first_id").isNull(), "no key").when(F.col(row_id) != F.col("first_id"), "repeated key")
    return known.select(*rows.columns, reason.alias("reason"))


def completeness(counts: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows found per expected snapshot; a missing snapshot has 0 rows and is not complete."""
    found = counts.groupBy(*keys).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    return expected.join(found, list(keys), "left").select(
        *keys, n.alias("n_rows"), (n > 0).alias("complete")
    )
