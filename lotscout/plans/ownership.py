"""Owners from recognised register text: one row per document that names one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotscout.functions.keys import document_parts
from lotscout.functions.text import owner_from_line


def pick_owner(lines: DataFrame) -> DataFrame:
    """Owner per document from (doc, page, line_no, text): the last name on the last page with one."""
    named = lines.withColumn("owner", owner_from_line(F.col("text")))
    last = F.max_by("owner", F.struct("page", "line_no"))
    return named.filter(F.col("owner").isNotNull()).groupBy("doc").agg(last.alias("owner"))


def ownership_from_lines(lines: DataFrame) -> DataFrame:
    """Ownership rows keyed by the address, lot and change date in the document name."""
    parts = document_parts(F.col("doc"))
    return (
        pick_owner(lines)
        .select(*[column.alias(name) for name, column in parts.items()], "owner")
        .filter(F.col("address").isNotNull())
    )
