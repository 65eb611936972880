"""Grouped measures, all with map-side partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotscout.sources.snapshot import stage_table


def max_then_sum(
    df: DataFrame, group: Sequence[str], within: str, value: str, name: str | None = None
) -> DataFrame:
    """Largest value per (group, within), summed over `within`.

    The maximum undoes join fan-out, the sum adds up distinct members of the group.
    """
    largest = df.groupBy(*group, within).agg(F.max(value).alias("_largest"))
    return largest.groupBy(*group).agg(F.sum("_largest").alias(name or value))


def smallest_per_group(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Smallest text per group, NULL skipped, compared as text ('10' before '2')."""
    return df.groupBy(*group).agg(F.min(value).alias(value))


def _z(value: Column, mean: Column, std: Column, otherwise: Column) -> Column:
    return F.coalesce((value - mean) / F.nullif(std, F.lit(0.0)), otherwise)


def two_level_zscore(
    df: DataFrame,
    outer: str,
    value: str,
    outer_weight: float = 0.6,
    inner_weight: float = 0.4,
) -> DataFrame:
    """Weighted sum of an outer group's z-score and a row's z-score inside its outer group.

    Sample deviations. Inside a group of one row, or of equal values, the inner score is 0. With
    one outer group, or equal totals, the outer score and the importance are NULL. Nothing is
    windowed over a whole group or table: the scores of the outer groups, one row each, are written
    and joined back, which needs no shuffle of the rows while they are few.
    """
    groups = df.groupBy(outer).agg(
        F.avg(value).alias("_mean"),
        F.stddev_samp(value).alias("_std"),
        F.sum(value).alias("outer_total"),
    )
    national = groups.agg(
        F.struct(
            F.avg("outer_total").alias("mean"), F.stddev_samp("outer_total").alias("std")
        ).alias("national")
    ).scalar()
    no_score = F.lit(None).cast("double")
    outer_z = _z(F.col("outer_total"), national["mean"], national["std"], no_score)
    scored = groups.withColumn("outer_zscore", outer_z)
    inner = _z(F.col(value), F.col("_mean"), F.col("_std"), F.lit(0.0))
    importance = outer_weight * F.col("outer_zscore") + inner_weight * F.col("inner_zscore")
    return (
        df.join(stage_table(scored, "outer_scores"), outer, "left")
        .withColumn("inner_zscore", inner)
        .withColumn("importance", importance)
        .drop("_mean", "_std")
    )


def heat_intensity(df: DataFrame, value: str, name: str = "intensity") -> DataFrame:
    """0..255 share of the table's maximum; 0 when the maximum is not positive."""
    top = df.agg(F.max(value)).scalar()
    share = F.when(top > 0, F.col(value) / top).otherwise(F.lit(0.0))
    return df.withColumn(name, (share * 255).cast("int"))
