"""Session settings every starq plan relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Zone-naive sources: every timestamp is read and printed as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Plain equi-joins lean on runtime skew splitting; force keeps the split
    # even when a later operator would have liked the original partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Generated methods beyond this many bytes are never compiled by the JVM; the
    # operators of such a stage run one by one instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str | None:
    """The folder all executors see, as the cluster names it (None when unset)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder.

    Raises where no shared folder is named: a machine-local folder would not be
    visible to the other executors of a cluster.
    """
    root = shared_dir(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df, label: str = "stage"):
    """Write once to the shared folder and read back.

    Cuts the lineage with files that outlive a lost executor, so that a result
    used by several later plans is computed a single time.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staging:
    """Owns the folders of staged results and removes them at the end.

        with Staging(spark) as staging:
            ... plan(..., stage=staging.keep) ...   # and write what is to stay
    """

    def __init__(self, spark: SparkSession, label: str = "staging"):
        self.spark, self.folder, self.count = spark, fresh_path(spark, label), 0

    def keep(self, df):
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self):
        return self

    def __exit__(self, *problem) -> None:
        self.close()


def stage(df, label: str = "stage"):
    """Keep a result that several plans read: in the shared folder where the
    cluster names one, else in the executors' storage."""
    return materialize(df, label) if shared_dir(df.sparkSession) else df.persist()
