"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry_point
from check_oracle import compare, duck
from lotscout.queries import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RUNS, SQL = entry_point.queries(), entry_point.oracle_sql()
# those without SQL are held against brute force in tests/llm
COMPARED = sorted(set(SQL) & set(RUNS))


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.RUNS) == set(registry.SQL)
    assert set(SQL) <= set(RUNS)


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, connection, name):
    assert compare(RUNS[name](spark, SF_DIR), connection, SQL[name]).startswith("ok")


def test_entry(spark):
    df = entry_point.entry(spark)
    assert {"total", "suitability", "profitability", "name"} <= set(df.columns)
    assert df.count() > 0


def test_raw_tables_are_written_without_a_sort(spark, monkeypatch, tmp_path):
    """A task that sorts its rows by region holds its whole split; with a file open per region it need not."""
    from pyspark.sql.readwriter import DataFrameWriter

    from lotscout.queries import registry

    key = "spark.sql.maxConcurrentOutputFileWriters"
    parquet, seen = DataFrameWriter.parquet, []

    def write(self, path, *args, **kwargs):
        seen.append(int(spark.conf.get(key)))
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    rows = [(i, 1 + i % 7, i % 50, i % 10, "N", 100.0 * i) for i in range(200)]
    names = "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_returnflag string, l_extendedprice double"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    before = spark.conf.get(key)
    got = registry.landed(spark, str(tmp_path), "bronze_building")
    regions = got.select("region").distinct().count()
    assert seen[-1] >= regions > 1 and spark.conf.get(key) == before and got.count() == 200


def test_tasks_read_and_sort_bounded_pieces(spark):
    from lotscout import session

    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    with session.settings(spark, {key: "1g" for key in session.PIECES}):
        session.tuned(spark)
        assert {key: size(spark.conf.get(key)) for key in session.PIECES} == session.PIECES
        for key in session.PIECES:
            spark.conf.set(key, "1m")
        session.tuned(spark)
        assert {spark.conf.get(key) for key in session.PIECES} == {"1m"}
