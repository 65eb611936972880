"""The served site table: one row per site and snapshot, with edits that survive every load.

    served/                the sites, committed by manifest, a part per snapshot and region
    served/_edits          append-only log of edits
    served/_quarantine     rows that were not served, with the reason, by snapshot
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotscout.operators import serve
from lotscout.sources import schemas
from lotscout.sources.manifest import Part, Table, Values
from lotscout.sources.snapshot import LEVELS, stage_folder, stage_table

SITE = ["name", "road_address"]
SPLIT = ("region",)
EDIT = T.StructType(
    [
        T.StructField("name", T.StringType()), T.StructField("road_address", T.StringType()),
        T.StructField("parking", T.IntegerType()), T.StructField("contract_status", T.StringType()),
        T.StructField("remarks", T.StringType()), T.StructField("edited_at", T.TimestampType()),
        T.StructField("edit_id", T.LongType()),
    ]
)


def edit_log(spark: SparkSession, served: str) -> DataFrame:
    """All edits so far; empty before the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{served.rstrip('/')}/_edits")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], EDIT)
    return spark.read.schema(EDIT).parquet(folder.toString())


def quarantine(spark: SparkSession, served: str) -> Table:
    return Table(spark, f"{served.rstrip('/')}/_quarantine")


def _edits_in_force(log: DataFrame) -> DataFrame:
    return serve.latest_edits(log, SITE, ["edited_at", "edit_id"])


def judge(rows: DataFrame) -> DataFrame:
    """The rows with the reason why they are not served, NULL for those that are; a written table.

    Of the rows of a site in a snapshot the one with the largest total is served, a row without one
    last; what is left of a tie goes by the other columns, NULL first.
    """
    numbered = stage_table(rows.withColumn("_id", F.monotonically_increasing_id()), "sites")
    rest = [F.col(c) for c in rows.columns if c not in (*schemas.SITE_KEY, "total")]
    order = [F.col("total").isNull(), -F.col("total"), *rest]
    firsts = stage_table(serve.first_of_key(numbered, schemas.SITE_KEY, order, "_id"), "first-sites")
    return stage_table(serve.judged_by_key(numbered, firsts, schemas.SITE_KEY, "_id").drop("_id"), "judged")


def load(rows: DataFrame, served: str) -> None:
    """Replace the snapshots that occur in the rows.

    The best row of a site is served, the others go to the quarantine of the snapshot; both come
    from one written table. Edits in force are applied before the commit, so that no reader sees
    the sites without them.
    """
    spark = rows.sparkSession
    judged = judge(rows)
    snapshots = _snapshots(judged)
    edits = stage_table(_edits_in_force(edit_log(spark, served)), "edits")
    kept = judged.filter(F.col("reason").isNull()).drop("reason")
    Table(spark, served).replace(serve.apply_edits(kept, edits), LEVELS, SPLIT, snapshots)
    quarantine(spark, served).replace(judged.filter(F.col("reason").isNotNull()), LEVELS, (), snapshots)


def _snapshots(rows: DataFrame) -> set[Values]:
    """Snapshots of a load, one in practice."""
    found = rows.select(*LEVELS).distinct().collect()
    return {tuple(zip(LEVELS, row)) for row in found}


def record_edits(served: str, edits: DataFrame) -> list[Part]:
    """Append edits (the columns of EDIT) to the log, then bring them into the served table."""
    conformed = edits.select(*(F.col(f.name).cast(f.dataType) for f in EDIT))
    conformed.write.mode("append").parquet(f"{served.rstrip('/')}/_edits")
    return apply_log(served, conformed)


def apply_log(served: str, edited: DataFrame) -> list[Part]:
    """Apply the edits in force to all parts that hold one of the edited sites; returns those parts.

    Edits name values, not changes, so this can be repeated, for instance after a job was killed
    between the log and the table. If a load replaces one of the parts meanwhile, it starts over.
    """
    with stage_folder(edited.sparkSession):
        return _apply_log(served, edited)


def _apply_log(served: str, edited: DataFrame) -> list[Part]:
    spark = edited.sparkSession
    table = Table(spark, served)
    wanted = stage_table(edited.select(*SITE).distinct(), "edited-sites")
    while (manifest := table.current()) is not None:
        sites = table.read(manifest.parts).join(wanted, SITE, "left_semi")
        # at most one row per part of the table
        touched = {tuple(r) for r in sites.select(*LEVELS, *SPLIT).distinct().collect()}
        parts = [p for p in manifest.parts if tuple(p.value(c) for c in (*LEVELS, *SPLIT)) in touched]
        edits = stage_table(_edits_in_force(edit_log(spark, served)), "edits")
        if not parts or table.rewrite(serve.apply_edits(table.read(parts), edits), parts):
            return parts
    return []
