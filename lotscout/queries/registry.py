"""Name to (Spark query, SQL) registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lotscout.queries.oracle import query as with_chain
from lotscout.queries.roles import ROLES
from lotscout.session import settings, tuned
from lotscout.sources.snapshot import new_path

Run = Callable[[SparkSession, str], DataFrame]
RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


_LANDED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def landed(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """The raw table of a role, written by region to the shared folder on first use.

    Raw tables are Parquet directories partitioned by region in production too, so the queries see
    the scans, pushed filters and pruned columns they would see there.
    """
    key = (spark.sparkContext.applicationId, sf_dir, role)
    if key not in _LANDED:
        rows = ROLES[role].frame(spark, sf_dir)
        path = new_path(spark, f"raw-{role}")
        by = [c for c in ("region",) if c in rows.columns]
        # a file per region is open at a time: otherwise a task would sort all of its rows by region first
        with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "32"}):
            rows.write.option("parquet.block.size", 32 << 20).partitionBy(*by).parquet(path)
        _LANDED[key] = path, rows.schema
    path, schema = _LANDED[key]
    return spark.read.schema(schema).parquet(path)


class Tables:
    """Driver tables and the domain roles made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tuned(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in ROLES:
            return landed(self.spark, self.sf_dir, name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], None]:
    """Register a function of the tables under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__
        RUNS[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_chain(sql)
        return build

    return register
