"""Regional importance from registered vehicle counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotscout.functions.text import amount_or_zero
from lotscout.operators.aggregates import two_level_zscore
from lotscout.operators.joins import map_codes, without_pairs

# Rows that are totals, and districts that no longer exist.
TOTAL_ROWS = ("계", "합계")
ABOLISHED = (("경기", "부천시"), ("경북", "군위군"), ("충북", "청원군"))


def abolished_districts(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{sido}', '{sigungu}')" for sido, sigungu in ABOLISHED)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(sido, sigungu)")


def clean_counts(raw: DataFrame) -> DataFrame:
    """(sido, sigungu, cargo_count) without total rows, counts as numbers."""
    trimmed = raw.select(
        F.trim("sido").alias("sido"),
        F.trim("sigungu").alias("sigungu"),
        amount_or_zero(F.col("cargo_count")).alias("cargo_count"),
    )
    return trimmed.filter(~F.col("sigungu").isin(*TOTAL_ROWS))


def regional_importance(
    raw: DataFrame, codes: DataFrame, excluded: DataFrame | None = None
) -> DataFrame:
    """Importance per district; listed districts leave after they have counted in the scores."""
    counts = clean_counts(raw)
    scored = two_level_zscore(counts, "sido", "cargo_count")
    gone = excluded if excluded is not None else abolished_districts(raw.sparkSession)
    kept = without_pairs(scored, gone, ["sido", "sigungu"])
    return map_codes(kept, codes, ["sido", "sigungu"]).select(
        "sido", "sigungu", "shp_code", "cargo_count", "importance"
    )
