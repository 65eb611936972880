"""One row per key, chosen the same way on every run.

Written as row_number() = 1, for which Spark plans a group limit on both sides of the shuffle: every
task sends at most one row per key, so a key holding a third of the table costs no more than any
other. Ties are settled by all remaining columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    return [*order, *(c for c in df.columns if c not in keys and c not in order)]


def _keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest order values per key, NULL last."""
    return _keep_first(df, keys, [F.desc_nulls_last(c) for c in _ranked_columns(df, keys, order)])


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Duplicates on a subset of columns: keep the smallest remaining columns, NULL first."""
    ranked = _ranked_columns(df, keys, order)
    if not ranked:
        return df.dropDuplicates()
    return _keep_first(df, keys, [F.asc_nulls_first(c) for c in ranked])
