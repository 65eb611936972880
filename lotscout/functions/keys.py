"""Identifiers built from code columns: 19-character parcel ids, road addresses, document keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _four_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 4, "0")


def parcel_id_from_address(
    dong_code: Column, mountain_flag: Column, lot_main: Column, lot_sub: Column
) -> Column:
    """Address register rule: only flag '1' is mountain land; a missing sub number is zero."""
    land = F.when(mountain_flag.cast("string") == "1", "2").otherwise("1")
    return F.concat(
        dong_code.cast("string"),
        land,
        _four_digits(lot_main),
        _four_digits(F.coalesce(lot_sub.cast("string"), F.lit("0"))),
    )


def parcel_id_from_building(
    sigungu_code: Column, dong_code: Column, land_flag: Column, main: Column, sub: Column
) -> Column:
    """Building register rule: flags 0 and 1 shift up by one, others stay; any NULL part gives NULL."""
    land = F.when(land_flag == "0", "1").when(land_flag == "1", "2").otherwise(land_flag)
    return F.concat(sigungu_code, dong_code, land, _four_digits(main), _four_digits(sub))


def road_address(
    sido: Column, sigungu: Column, road: Column, main: Column, sub: Column
) -> Column:
    """"province district road main[-sub]"; the sub number appears only when it is not zero."""
    suffix = F.when(sub.try_cast("bigint") != 0, F.concat(F.lit("-"), sub.cast("string")))
    number = F.concat(main.cast("string"), F.coalesce(suffix, F.lit("")))
    return F.concat_ws(" ", sido, sigungu, road, number)


def document_parts(name: Column) -> dict[str, Column]:
    """Fields of a "place_words_lot_date" document name; NULL when it has fewer than three parts."""
    parts = F.split(name, "_")
    n = F.size(parts)
    enough = n >= 3
    lot = F.trim(F.when(enough, F.get(parts, n - 2)))
    has_sub = lot.contains("-")
    main = F.trim(F.regexp_extract(lot, "^([^-]*)", 1))
    sub = F.trim(F.regexp_extract(lot, "^[^-]*-(.*)$", 1))
    return {
        "address": F.when(enough, F.array_join(F.slice(parts, 1, F.greatest(n - 2, F.lit(0))), " ")),
        "lot_main": main,
        "lot_sub": F.when(has_sub, sub),
        "change_date": F.when(enough, F.get(parts, n - 1)),
    }
