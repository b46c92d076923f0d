"""Versioned tables: the switch is one step, partitions are taken over, versions expire."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lendlake.sources.versions import Conflict, VersionedTable

SCHEMA = "id int, cohort date"
JAN, FEB, MAR = (dt.date(2025, m, 1) for m in (1, 2, 3))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_replace_and_read_older_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    empty = spark.createDataFrame([], SCHEMA)
    assert table.version() is None
    with pytest.raises(LookupError):
        table.read()
    assert table.read(schema=empty.schema).collect() == []
    assert table.replace(spark.createDataFrame([(1, JAN)], SCHEMA)) == 0
    assert table.replace(spark.createDataFrame([(2, None)], SCHEMA), properties={"mark": "x"}) == 1
    assert rows(table.read()) == [(2, None)] and rows(table.read(0)) == [(1, JAN)]
    assert table.manifest()["properties"] == {"mark": "x"}
    assert table.replace(empty) == 2 and rows(table.read()) == []


def test_a_write_that_fails_half_way_leaves_the_old_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([(1, JAN)], SCHEMA))
    broken = spark.range(1000).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("id"),
        F.lit(JAN).alias("cohort"),
    )
    with pytest.raises(Exception, match="lost"):
        table.replace(broken.repartition(4))
    assert table.version() == 0 and rows(table.read()) == [(1, JAN)]
    # Files written whole, but the writer dies before its manifest.
    table._write(spark.createDataFrame([(9, FEB)], SCHEMA), None)
    assert rows(VersionedTable(spark, table.path).read()) == [(1, JAN)]


def test_of_two_writers_one_gets_a_conflict(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.replace(spark.createDataFrame([(1, JAN)], SCHEMA))
    document = one.manifest()
    two.log.append(1, document)
    with pytest.raises(Conflict):
        one.log.append(1, document)
    assert one.log.numbers() == [0, 1]
    assert not [n for n in one.log.files.names(one.log.folder) if not n.endswith((".json", ".crc"))]


def test_sessions_do_not_collide(spark, tmp_path):
    """A reader that declared its frame before a replacement still reads its version."""
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([(1, JAN)], SCHEMA))
    before = table.read()
    VersionedTable(spark.newSession(), table.path).replace(spark.createDataFrame([(2, FEB)], SCHEMA))
    assert rows(before) == [(1, JAN)] and rows(table.read()) == [(2, FEB)]


def test_partitions_are_replaced_emptied_added_and_taken_over(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([(1, JAN), (2, FEB), (3, None), (4, MAR)], SCHEMA), "cohort")
    parts = table.manifest()["parts"]
    null = next(p for p in parts if "HIVE_DEFAULT" in p)
    new = spark.createDataFrame([(5, JAN), (6, None)], SCHEMA)
    with pytest.raises(ValueError, match="outside"):
        table.replace_parts(new, ["cohort=2025-01-01"], base=0)
    table.replace_parts(new, ["cohort=2025-01-01", "cohort=2025-02-01", null], base=0)
    assert rows(table.read()) == [(4, MAR), (5, JAN), (6, None)]
    assert table.manifest()["parts"]["cohort=2025-03-01"] == parts["cohort=2025-03-01"]
    assert rows(table.read(parts=["cohort=2025-03-01", "cohort=1999-01-01"])) == [(4, MAR)]
    assert dict(table.read().dtypes) == {"id": "int", "cohort": "date"}
    plan = table.read().where(F.col("cohort") == F.lit(MAR))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cohort" in plan


def test_expiry_keeps_what_a_kept_version_names(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.createDataFrame([(1, JAN), (2, FEB)], SCHEMA), "cohort")
    for n in range(3):
        table.replace_parts(spark.createDataFrame([(n, JAN)], SCHEMA), ["cohort=2025-01-01"], base=n)
    assert table.expire(keep=1, pinned=[1]) == [0, 2]
    assert rows(table.read()) == [(2, JAN), (2, FEB)] and rows(table.read(1)) == [(0, JAN), (2, FEB)]
    assert len(list((tmp_path / "t" / "data").rglob("*.parquet"))) == 3
