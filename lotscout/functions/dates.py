"""Calendar stamps used by snapshots and landings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tolerant_date(text: Column) -> Column:
    """yyyy-MM-dd text to a date; anything else gives NULL."""
    return F.try_to_date(text, "yyyy-MM-dd")


def week_of_month(day: Column) -> Column:
    """Monday weeks; days before the first Monday are week 0."""
    days_to_monday = F.pmod(F.lit(7) - F.weekday(F.trunc(day, "MM")), F.lit(7))
    return F.floor((F.dayofmonth(day) - days_to_monday + 6) / 7).cast("int")


def snapshot_stamp(day: Column, weekly: bool = True) -> dict[str, Column]:
    """Partition values of the snapshot a day belongs to."""
    stamp = {"year": F.year(day), "month": F.month(day)}
    return {**stamp, "week": week_of_month(day)} if weekly else stamp


def previous_month_stamp(day: Column) -> dict[str, Column]:
    """Year and two-digit month before the one a day is in."""
    before = F.add_months(F.trunc(day, "MM"), -1)
    return {"year": F.date_format(before, "yyyy"), "month": F.date_format(before, "MM")}


def quarter_tag(tag: Column) -> Column:
    """yyyyMMdd of a quarter end to e.g. 2024Q1; NULL when it is not a quarter end."""
    day = F.when(tag.rlike(r"^\d{8}$"), F.try_to_date(tag, "yyyyMMdd"))
    is_quarter_end = F.add_months(F.trunc(day, "quarter"), 3) == F.date_add(day, 1)
    return F.when(
        is_quarter_end, F.concat(F.date_format(day, "yyyy"), F.lit("Q"), F.quarter(day))
    )
