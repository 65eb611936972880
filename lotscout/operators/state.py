"""Work that is carried from run to run: what is wanted, what is done, what is tried again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = ["wanted", "attempts", "fetched", "first_run", "last_try"]


def carried(
    before: DataFrame | None, wanted: DataFrame, outcomes: DataFrame, keys: Sequence[str], run: Column,
    max_attempts: int = 5,
) -> DataFrame:
    """State per key after a run: wanted now, attempts so far, fetched, first run, run of the last try, status.

    `before` is the state after the run before, `wanted` the keys of this run, `outcomes` one row
    per try with `ok`. The three are stacked and added up by key, so there is one shuffle with
    partial sums, and NULL keys meet like any others. A key that is no longer wanted is remembered.
    Status: fetched; given up, after `max_attempts` failures; failed; pending.
    """
    none = F.lit(None)
    now = [
        wanted.select(
            *keys, F.lit(True).alias("wanted"), F.lit(0).cast("long").alias("attempts"), F.lit(False).alias("fetched"),
            run.alias("first_run"), none.cast("int").alias("last_try"),
        ),
        outcomes.select(
            *keys, F.lit(False).alias("wanted"), F.lit(1).cast("long").alias("attempts"),
            F.coalesce("ok", F.lit(False)).alias("fetched"), run.alias("first_run"), run.alias("last_try"),
        ),
    ]
    if before is not None:
        now.append(before.select(*keys, F.lit(False).alias("wanted"), *STATE[1:]))
    rows = now[0]
    for more in now[1:]:
        rows = rows.unionByName(more)
    state = rows.groupBy(*keys).agg(
        F.max("wanted").alias("wanted"), F.sum("attempts").alias("attempts"), F.max("fetched").alias("fetched"),
        F.min("first_run").alias("first_run"), F.max("last_try").alias("last_try"),
    )
    status = (
        F.when(F.col("fetched"), "fetched")
        .when(F.col("attempts") >= max_attempts, "given up")
        .when(F.col("attempts") > 0, "failed")
        .otherwise("pending")
    )
    return state.withColumn("status", status)


def to_try(state: DataFrame) -> DataFrame:
    """Keys to fetch in the next run: wanted, not fetched, not given up."""
    return state.filter(F.col("wanted") & F.col("status").isin("pending", "failed"))
