"""Where the queries and their SQL are collected, and the stages several of them share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from contract import views
from starq.plans import cleaning, missing, outliers, quality, warehouse
from starq.session import configure, shared_dir, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session without one gets its own."""
    if not shared_dir(spark):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starq-"))
    return shared_dir(spark)


@dataclass(frozen=True)
class Stages:
    """Outputs of the batch stages; later stages and reports read earlier outputs."""

    spark: SparkSession
    sf_dir: str

    def __hash__(self):
        return hash((self.spark.sparkContext.applicationId, self.sf_dir))

    def __eq__(self, other):
        return hash(self) == hash(other)

    @cache
    def tables(self) -> dict[str, DataFrame]:
        return {name: stage(df) for name, df in views.tables(self.spark, self.sf_dir).items()}

    @cache
    def assessment(self) -> quality.Assessment:
        return quality.assess(self.spark, self.tables(), stage=stage)

    @cache
    def missing(self) -> DataFrame:
        return stage(missing.missing_flags(self.tables()))

    @cache
    def missing_summary(self) -> DataFrame:
        return stage(missing.missing_summary(self.missing(), self.tables()))

    @cache
    def outliers(self) -> outliers.Outliers:
        found = outliers.detect_from_tables(self.tables(), stage=stage)
        return outliers.Outliers(found.flags, stage(found.summary))

    @cache
    def cleaning(self) -> cleaning.Cleaning:
        return cleaning.clean(
            self.tables(), self.assessment().issues, self.missing(), self.outliers().flags, stage=stage
        )

    @cache
    def warehouse(self) -> warehouse.Warehouse:
        built = warehouse.build(self.cleaning().tables(), stage=stage)
        return warehouse.Warehouse(
            {n: stage(d) for n, d in built.dimensions.items()}, stage(built.fact_lap_performance),
            stage(built.fact_session_result),
        )


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    return Stages(configure(spark), sf_dir)
