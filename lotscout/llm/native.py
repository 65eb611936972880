"""Column expressions shared by the operators that use DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def long(value) -> Column:
    return F.lit(value).cast("long")


def let(value: Column, body) -> Column:
    """`body` of a value that is computed once per row, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def places(text: Column, pattern: Column | str) -> Column:
    """Array of (first, last, value) of the matches of a pattern, in code points, end exclusive.

    The pieces between matches and the matches themselves are laid end to end.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    kind = "array<struct<first:long,last:long,value:string>>"

    def add(done: Column, pair: Column) -> Column:
        first = done["at"] + F.length(pair["piece"])
        last = first + F.length(pair["value"])
        here = F.struct(first.alias("first"), last.alias("last"), pair["value"].alias("value"))
        return F.struct(last.alias("at"), F.concat(done["seen"], F.array(here)).alias("seen"))

    def walked(found: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, F.lit(-1)), 1, F.size(found))
        pairs = F.zip_with(found, pieces, lambda v, p: F.struct(v.alias("value"), p.alias("piece")))
        start = F.struct(long(0).alias("at"), F.array().cast(kind).alias("seen"))
        seen = F.aggregate(pairs, start, add)["seen"]
        return F.when(F.size(found) == 0, F.array().cast(kind)).otherwise(seen)

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), walked)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; 0 if either is empty."""
    p_sum, q_sum = total(p), total(q)

    def part(x: Column, y: Column) -> Column:
        a, b = x / p_sum, y / q_sum
        m = (a + b) / 2
        left = F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
        return left + F.when(b > 0, b * F.log2(b / m)).otherwise(0.0)

    divergence = F.aggregate(F.zip_with(p, q, part), F.lit(0.0), lambda s, x: s + x) / 2
    known = (p_sum > 0) & (q_sum > 0)
    return F.when(known, F.sqrt(F.greatest(divergence, F.lit(0.0)))).otherwise(0.0)


def any_of(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions)
