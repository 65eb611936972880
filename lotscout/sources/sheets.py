"""Tables from the cells of a sheet: (row_no, col_no, value), with stacked and merged header cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotscout.sources.schemas import EMPTY_CELLS


def _filled(value: Column) -> Column:
    """The cell's text, NULL if it is empty."""
    text = F.trim(value)
    return F.when(~F.lower(text).isin(*sorted(EMPTY_CELLS)), text)


def header_names(cells: DataFrame, header_rows: Sequence[int]) -> DataFrame:
    """(col_no, name) of every column that has a header.

    A merged cell holds its text in its first column, so that in all header rows but the last one an
    empty cell takes the text to its left. A name is made of the texts from top to bottom,
    without empty ones and runs of equal ones.
    """
    grid = cells.filter(F.col("row_no").isin(*header_rows)).select("row_no", "col_no", _filled(F.col("value")).alias("text"))
    # columns whose upper cell is absent still belong to the merged cell
    places = cells.select("col_no").distinct().withColumn("row_no", F.explode(F.array(*map(F.lit, header_rows))))
    full = places.join(grid, ["row_no", "col_no"], "left")
    left = Window.partitionBy("row_no").orderBy("col_no")
    merged = F.last("text", ignorenulls=True).over(left)
    text = F.when(F.col("row_no") == max(header_rows), F.col("text")).otherwise(merged)
    stacked = full.select("row_no", "col_no", text.alias("text")).dropna(subset=["text"])
    texts = F.transform(F.array_sort(F.collect_list(F.struct("row_no", "text"))), lambda x: x["text"])
    named = stacked.groupBy("col_no").agg(texts.alias("texts"))
    kept = F.filter(F.col("texts"), lambda x, i: (i == 0) | (x != F.get(F.col("texts"), i - 1)))
    return named.select("col_no", F.array_join(kept, "_").alias("name"))


def table_of(cells: DataFrame, header_rows: Sequence[int]) -> DataFrame:
    """A row per body row and a text column per header name, in the order of the columns.

    The names, as many as the sheet is wide, are known to the driver. Of columns with one name the
    leftmost filled cell counts.
    """
    names = header_names(cells, header_rows)
    wide = names.groupBy("name").agg(F.min("col_no").alias("at")).orderBy("at").collect()
    body = cells.filter(F.col("row_no") > max(header_rows)).join(names, "col_no")
    first = F.min(F.when(_filled(F.col("value")).isNotNull(), F.struct("col_no", "value")))["value"]
    return body.groupBy("row_no").pivot("name", [r["name"] for r in wide]).agg(first)
