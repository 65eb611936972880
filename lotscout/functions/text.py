"""Text rules for addresses, names and scraped cells, as codegen'd Column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from unicodedata import normalize

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Patterns whose effect must equal the source rules.
PARENTHESES = r"\s*\([^)]*\)"
PARENTHESES_AND_SPACE = r"\s*\([^)]*\)\s*"
FROM_FIRST_COMMA = r",.*$"
TOWN_BEFORE_ROAD = r"\s+\S+(동|읍|면|리)\s+(?=\S+(로|길))"
SPACES = r"\s+"
OTHERS = r"외\s*\d+"
OTHERS_COUNT = r"외\s*(\d+)"
NAME_SEPARATOR = r"[,/·]"
NAME_SPLIT = r"\s*[,/·]\s*"
FROM_SECOND_NAME = r"\s*[,/].*$"
TRAILING_OTHERS_PEOPLE = r"\s*외\s*\d+\s*(인|명)\s*$"
TRAILING_OTHERS = r"\s*외\s*\d+\s*$"
CITY_AND_WARD = r"([가-힣]+시)\s+([가-힣]+구)"
CITY_OR_COUNTY = r"([가-힣]+(?:시|군))"
OWNER_WITH_OTHERS = r"([가-힣]+)\s*외\s*\d+\s*인"
HANGUL_WORD = r"^[가-힣]+$"


def _replace_all(column: Column, steps: Iterable[tuple[str, str]]) -> Column:
    return reduce(lambda c, step: F.regexp_replace(c, *step), steps, column)


def strip(column: Column) -> Column:
    """Trim all white space, not only spaces."""
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def clean_address(address: Column) -> Column:
    """Road part of a free-text address: no remarks, no floor, no town before the road name."""
    steps = [(PARENTHESES, ""), (FROM_FIRST_COMMA, ""), (TOWN_BEFORE_ROAD, " "), (SPACES, " ")]
    return F.trim(_replace_all(address, steps))


def representative_count(name: Column) -> Column:
    """People named in a raw representative cell; an explicit "and N others" wins over separators."""
    others = F.regexp_extract(name, OTHERS_COUNT, 1).try_cast("int")
    pieces = F.size(F.split(name, NAME_SPLIT))
    return (
        F.when(name.rlike(OTHERS), others + F.lit(1))
        .when(name.rlike(NAME_SEPARATOR), pieces)
        .otherwise(F.lit(1))
    )


def clean_representative(name: Column) -> Column:
    """First person of a representative cell. A middle dot does not separate names here."""
    steps = [
        (PARENTHESES_AND_SPACE, ""),
        (FROM_SECOND_NAME, ""),
        (TRAILING_OTHERS_PEOPLE, ""),
        (TRAILING_OTHERS, ""),
        (SPACES, " "),
    ]
    return F.trim(_replace_all(F.trim(name), steps))


def names_match(left: Column, right: Column) -> Column:
    """True when two possibly masked names agree in length, first and last character."""
    a, b = (F.regexp_replace(c, SPACES, "") for c in (left, right))
    same_ends = (F.left(a, F.lit(1)) == F.left(b, F.lit(1))) & (
        (F.length(b) == 2) | (F.right(a, F.lit(1)) == F.right(b, F.lit(1)))
    )
    return F.coalesce((F.length(a) >= 2) & (F.length(a) == F.length(b)) & same_ends, F.lit(False))


def parse_district(place: Column) -> Column:
    """"city ward" when both are present, otherwise the first city or county ('' if none)."""
    both = F.concat_ws(
        " ",
        F.regexp_extract(place, CITY_AND_WARD, 1),
        F.regexp_extract(place, CITY_AND_WARD, 2),
    )
    return F.when(place.rlike(CITY_AND_WARD), both).otherwise(
        F.regexp_extract(place, CITY_OR_COUNTY, 1)
    )


def strip_label(cell: Column, label: str) -> Column:
    """Drop a column header repeated at the start of a scraped cell."""
    return strip(F.regexp_replace(strip(cell), f"^{label}", ""))


def safe_double(text: Column) -> Column:
    """Number from text; blank or malformed text gives NULL."""
    return F.nullif(F.trim(text), F.lit("")).try_cast("double")


def amount_or_zero(text: Column) -> Column:
    """Number from text with thousands commas; anything else counts as zero."""
    return F.coalesce(finite_double(F.trim(F.replace(text, F.lit(",")))), F.lit(0.0))


def finite_double(value: Column) -> Column:
    """Double from any value; NaN and unparsable values give NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def lot_main(lot: Column) -> Column:
    return F.split_part(lot, F.lit("-"), F.lit(1))


def lot_sub(lot: Column) -> Column:
    """Part after the first hyphen, NULL when there is none."""
    return F.get(F.split(lot, "-"), F.lit(1))


def owner_from_line(line: Column) -> Column:
    """Owner named by one recognised text line, NULL when the line names nobody."""
    text = strip(line)
    return F.when(
        text.rlike(OWNER_WITH_OTHERS), F.regexp_extract(text, OWNER_WITH_OTHERS, 1)
    ).when(text.rlike(HANGUL_WORD), text)


# ASCII and composed syllables: such text is in NFC already.
COMPOSED = r"^[\x00-\x7F가-힣]*$"
ASCII_SPACE_AT_ENDS = r"^[\x09-\x0D\x1C-\x20]+|[\x09-\x0D\x1C-\x20]+$"


def nfc_strip(column: Column | str) -> Column:
    """Unicode NFC, then strip.

    Spark has no built-in normaliser, so this is the one UDF; it gets only values that may change.
    """

    def normalized(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: normalize("NFC", s).strip(), na_action="ignore")

    value = F.col(column) if isinstance(column, str) else column
    composed = value.rlike(COMPOSED)
    changed = F.pandas_udf(normalized, StringType())(F.when(~composed, value))
    return F.coalesce(changed, F.regexp_replace(value, ASCII_SPACE_AT_ENDS, ""))
