"""Equi joins of the chain, shaped so that no group has to fit one task.

No side is broadcast by hint: Spark broadcasts a side only when its measured size is under
spark.sql.autoBroadcastJoinThreshold. Hot join keys are left to adaptive skew handling, which splits
a side of an inner join, and the left side of a left, semi or anti join. Two things follow:

* a lookup table that was just grouped by the join key should be a written table, because Spark
  splits only sides that are shuffled for the join itself;
* the right side of an outer, semi or anti join must not be hot, so it is made distinct first, or the
  outer join is put together from an inner and an anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _without_shared(right: DataFrame, left: DataFrame, on: Sequence[str]) -> DataFrame:
    return right.drop(*[c for c in right.columns if c in left.columns and c not in on])


def left_join_one(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a table with one row per key.

    Of columns both sides carry (such as the region) the left copy is kept.
    """
    return left.join(_without_shared(right, left, on), list(on), "left")


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a table with any, but not very many, rows per key: one shuffle of either side."""
    return left.join(_without_shared(right, left, on), list(on), "left")


def left_join_many(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a table with any number of rows per key, also very many for one key.

    The matching part is an inner join, which can be split on either side; the rest is padded.
    """
    on = list(on)
    matched = left.join(_without_shared(right, left, on), on)
    unmatched = left.join(right.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def with_single_child(
    parents: DataFrame, children: DataFrame, key: str, child_key: str
) -> DataFrame:
    """Parents with at most one identified child, left joined to their children.

    Equals joining first and keeping parents whose non-NULL child keys count 0 or 1. Children are
    counted before any of them is gathered: a hash aggregate of numbers, added up by each task. Only
    parents that pass meet their children, by an inner join, which can be split on either side
    and lets a runtime filter of the parents' keys drop other children before they are shuffled.
    Parents must be unique by `key`. Children without a child key do not count, but are joined to
    the parents that are kept. Children are read twice, the first time only their two keys.
    """
    payload = [c for c in children.columns if c != key and c not in parents.columns]
    held = children.select(key, *payload).filter(F.col(key).isNotNull())
    counts = held.groupBy(key).agg(F.count(child_key).alias("n"))
    kept = parents.join(counts, key, "left").filter(F.coalesce("n", F.lit(0)) <= 1)
    childless = kept.filter(F.col("n").isNull()).select(*parents.columns)
    with_children = kept.filter(F.col("n").isNotNull()).select(*parents.columns).join(held, key)
    return with_children.select(*parents.columns, *payload).unionByName(childless, allowMissingColumns=True)


def groups_with(df: DataFrame, group: Sequence[str], marker: str) -> DataFrame:
    """The groups in which at least one row has the marker column, one row each; no NULL keys."""
    return df.dropna(subset=[marker, *group]).select(*group).distinct()


def in_groups(df: DataFrame, groups: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows of the listed groups. `groups` should be a written table, so that a hot group is split."""
    return df.join(groups, list(group), "left_semi")


def union_padded(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks are NULL of the other side's type."""
    return left.unionByName(right, allowMissingColumns=True)


def map_codes(df: DataFrame, codes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a code map; codes are kept as strings."""
    typed = codes.select(
        *on, *[F.col(c).cast(T.StringType()).alias(c) for c in codes.columns if c not in on]
    )
    return df.join(typed, list(on), "left")


def unmapped(df: DataFrame, codes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Report of the key values a code map does not know."""
    return df.select(*on).distinct().join(codes.select(*on).distinct(), list(on), "left_anti")


def without_pairs(df: DataFrame, pairs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Drop rows whose key is listed; the list names a key once."""
    return df.join(pairs, list(on), "left_anti")


def pending(wanted: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Work still to do: rows of `wanted` without a row in `done`; NULL keys compare equal.

    Null-safe keys hash as (is null, value or zero value), so this stays an equi join.
    """
    same = [F.col(f"wanted.{c}").eqNullSafe(F.col(f"done.{c}")) for c in on]
    known = done.select(*on).distinct().alias("done")
    return wanted.alias("wanted").join(known, same, "left_anti")
