"""Staged results live as long as their owner, and partitioned sinks write files by size."""

import glob

import pytest
from pyspark.sql import functions as F

from starq.session import Staging, fresh_path
from starq.sources.tables import first_existing, read_layer, write_by_value


def test_staging_removes_its_folder(spark):
    with Staging(spark, "test") as staging:
        kept = staging.keep(spark.range(10))
        assert kept.count() == 10 and glob.glob(f"{staging.folder.removeprefix('file:')}/1/*.parquet")
    assert not glob.glob(f"{staging.folder.removeprefix('file:')}*")
    with pytest.raises(ZeroDivisionError), Staging(spark, "test") as staging:
        staging.keep(spark.range(1))
        1 / 0
    assert not glob.glob(f"{staging.folder.removeprefix('file:')}*")


def test_files_follow_values_not_tasks(spark):
    path = fresh_path(spark, "values")
    rows = spark.range(0, 4000, numPartitions=40).withColumn("kind", F.col("id") % 3)
    write_by_value(rows, "kind", path)
    assert spark.read.parquet(path).count() == 4000
    assert len(glob.glob(f"{path.removeprefix('file:')}/kind=*/*.parquet")) <= 6


def test_absent_sources(spark):
    path = fresh_path(spark, "absent")
    schema = spark.range(1).schema
    assert first_existing(spark, [path, f"{path}-2"], schema).schema == schema
    assert read_layer(spark, path, ["lap"]) == {} == read_layer(spark, None, ["lap"], database="no_such_database")
    with pytest.raises(FileNotFoundError, match="lap"):
        read_layer(spark, path, ["lap"], required=True)
