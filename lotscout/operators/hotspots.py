"""Hot spots: sums over grid cells and their neighbours, compared within each district."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotscout.functions import geo


def cell_sums(points: DataFrame, size: float, district: str, x: str = "x", y: str = "y", value: str = "value") -> DataFrame:
    """(district, cell_x, cell_y, own) per square cell of `size` grid units; points without a place or
    value are left out."""
    placed = points.dropna(subset=[x, y, value])
    cell = {"cell_x": F.floor(F.col(x) / size), "cell_y": F.floor(F.col(y) / size)}
    return placed.withColumns(cell).groupBy(district, *cell).agg(F.sum(value).alias("own"))


def neighbourhoods(cells: DataFrame, reach: int = 1) -> DataFrame:
    """(cell_x, cell_y, value): the sum over the cells at most `reach` steps away, of all districts.

    A cell sends its sum to each of its neighbours, (2 * reach + 1) ** 2 rows, which are added up by
    tasks before they are shuffled; cells are never compared in pairs. Cells that only receive are
    in it too.
    """
    steps = F.array(*(F.lit(d) for d in range(-reach, reach + 1)))
    sent = cells.groupBy("cell_x", "cell_y").agg(F.sum("own").alias("own"))
    sent = sent.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
    at = [(F.col("cell_x") + F.col("dx")).alias("cell_x"), (F.col("cell_y") + F.col("dy")).alias("cell_y")]
    return sent.select(*at, "own").groupBy("cell_x", "cell_y").agg(F.sum("own").alias("value"))


def _z(value: Column, mean: Column, deviation: Column) -> Column:
    return F.coalesce((value - mean) / F.nullif(deviation, F.lit(0.0)), F.lit(0.0))


def zone_hotspots(cells: DataFrame, around: DataFrame, size: float, district: str) -> DataFrame:
    """(district, lat, lon, value, z_score) per cell with points of the district, at the cell's centre.

    `value` is the neighbourhood's sum, `z_score` compares it with the district's other cells; it is
    0 for a single cell or equal sums. `cells` and `around` should be written tables, as both
    are read twice.
    """
    known = cells.join(around, ["cell_x", "cell_y"])
    of_district = known.groupBy(district).agg(
        F.avg("value").alias("_mean"), F.stddev_samp("value").alias("_deviation")
    )
    scored = known.join(of_district, district).select(
        district, "value", _z(F.col("value"), F.col("_mean"), F.col("_deviation")).alias("z_score"),
        ((F.col("cell_x") + 0.5) * size).alias("x"), ((F.col("cell_y") + 0.5) * size).alias("y"),
    )
    return geo.with_wgs84(scored, longitude="lon", latitude="lat")


def hotspots_of(hotspots: DataFrame, code: str, district: str = "sigungu_cd") -> DataFrame:
    """Cells of one district, as a map shows them."""
    return hotspots.filter(F.col(district) == code).select("lat", "lon", "value", "z_score")
