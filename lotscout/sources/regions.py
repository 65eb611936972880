"""Region names: lookups by file name, file code and address token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Province names in file names, official codes and short names.
REGION_BY_ENGLISH = {
    "seoul": "서울",
    "busan": "부산",
    "daegu": "대구",
    "incheon": "인천",
    "gwangju": "광주",
    "daejeon": "대전",
    "ulsan": "울산",
    "sejong": "세종",
    "gyunggi": "경기",
    "gangwon": "강원",
    "chungbuk": "충북",
    "chungnam": "충남",
    "jeonbuk": "전북",
    "jeonnam": "전남",
    "gyeongbuk": "경북",
    "gyeongnam": "경남",
    "jeju": "제주",
}
REGION_BY_CODE = {
    "11": "서울",
    "26": "부산",
    "27": "대구",
    "28": "인천",
    "29": "광주",
    "30": "대전",
    "31": "울산",
    "36": "세종",
    "41": "경기",
    "43": "충북",
    "44": "충남",
    "46": "전남",
    "47": "경북",
    "48": "경남",
    "50": "제주",
    "51": "강원",
    "52": "전북",
}
REGION_BY_FULL_NAME = {
    "서울특별시": "서울",
    "부산광역시": "부산",
    "대구광역시": "대구",
    "인천광역시": "인천",
    "광주광역시": "광주",
    "대전광역시": "대전",
    "울산광역시": "울산",
    "세종특별자치시": "세종",
    "경기도": "경기",
    "강원도": "강원",
    "강원특별자치도": "강원",
    "충청북도": "충북",
    "충청남도": "충남",
    "전라북도": "전북",
    "전북특별자치도": "전북",
    "전라남도": "전남",
    "경상북도": "경북",
    "경상남도": "경남",
    "제주특별자치도": "제주",
}
REGION_ALIASES = {**{short: short for short in REGION_BY_CODE.values()}, **REGION_BY_FULL_NAME}

# Names of the province files.
ADDRESS_FILE = r"^rnaddrkor_(.+)\.txt$"
COORD_FILE = r"^entrc_(.+)\.txt$"
STORE_FILE = r"_([가-힣]+)_\d{6}\.csv$"


def lookup(key: Column, table: dict[str, str]) -> Column:
    """Value of a fixed table (a few dozen literals), NULL when the key is absent."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def region_from_file_name(name: Column, pattern: str = ADDRESS_FILE) -> Column:
    """Region of a province file; a name outside the table is an error, as it would lose a province."""
    key = F.regexp_extract(F.lower(name), pattern, 1)
    region = lookup(key, REGION_BY_ENGLISH)
    problem = F.concat(F.lit("no region for file name: "), name)
    return F.coalesce(region, F.raise_error(problem).cast("string"))


def region_from_file_code(name: Column) -> Column:
    """Region from the third '_' part of a file stem, "Unknown" for an unlisted code."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    code = F.get(F.split(stem, "_"), F.lit(2))
    return F.coalesce(lookup(code, REGION_BY_CODE), F.lit("Unknown"))


def region_from_store_file(name: Column) -> Column:
    """Region suffix of a store file, "unknown" when there is none."""
    found = F.regexp_extract(name, STORE_FILE, 1)
    return F.when(found != "", found).otherwise(F.lit("unknown"))


def first_token(address: Column) -> Column:
    return F.regexp_extract(address, r"^\s*(\S+)", 1)


def with_region_of_address(df: DataFrame, address: str, region: str = "region") -> DataFrame:
    """Add the region of the first address token; rows whose token is no region are dropped."""
    known = lookup(first_token(F.col(address)), REGION_ALIASES)
    return df.withColumn(region, known).filter(F.col(region).isNotNull())
