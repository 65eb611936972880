"""Session settings the jobs rely on; all of them can be set at run time."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the join's partitioning is used again further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Python workers and the JVM hold a batch each, whatever the length of texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

# Bytes that one task reads of a file or of a shuffle, at most: what it sorts and aggregates follows from
# that. Rows in memory take ten times the bytes and more. Smaller values of a session stay.
PIECES = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that hold for what is run inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def tuned(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in PIECES.items():
        if size(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark
