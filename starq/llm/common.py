"""What the operators share: tables, staging in the shared folder, shipping this code to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starq.session import configure, fresh_path, shared_dir

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
#: What the operator that a worker served last remembers between its tasks.
_remembered: dict = {}


def remembered(key, make: Callable):
    """make(), once per worker and key, until another key or operator takes the worker."""
    if key not in _remembered:
        forget()
        _remembered[key] = make()
    return _remembered[key]


def forget() -> None:
    """Frees what another operator remembers here: Spark hands workers on from stage to stage.

    Tasks that remember nothing call this first, so that an executor never holds an
    earlier stage's memory beside that of the stage it runs.
    """
    _remembered.clear()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, a shared folder, and this package on every executor."""
    configure(spark)
    # Texts differ in length a thousandfold: bound what goes to Python at once in bytes.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    context = spark.sparkContext
    if not shared_dir(spark):
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="starq-"))
    if not getattr(context, "_starq_shipped", False):
        # The driver serves this archive to the executors, as --py-files would.
        archive = os.path.join(tempfile.mkdtemp(prefix="starq-code-"), "starq_llm.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for name in ("__init__.py", "session.py"):
                out.write(os.path.join(PACKAGE, name), f"starq/{name}")
            for name in sorted(os.listdir(os.path.join(PACKAGE, "llm"))):
                if name.endswith(".py"):
                    out.write(os.path.join(PACKAGE, "llm", name), f"starq/llm/{name}")
        context.addPyFile(archive)
        context._starq_shipped = True
    return spark


class Scratch:
    """Intermediate tables below the shared folder, which outlive lost executors.

    `write` cuts the lineage; `drop` removes tables no returned plan reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = prepare(spark), label, {}

    def write(self, df: DataFrame, name: str, files: int | None = None) -> DataFrame:
        """files: how many the table needs at most; each costs the executor time and, on some stores, a process."""
        df = df.coalesce(files) if files else df
        path = self.paths[name] = fresh_path(self.spark, f"{self.label}-{name}")
        df.write.mode("errorifexists").parquet(path)
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.paths[name])

    def keep(self, *names: str) -> None:
        """Drops every table but these."""
        self.drop(*(n for n in list(self.paths) if n not in names))

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)


def plain_documents(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id and text only, under those names: other columns never reach an operator."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra)


def only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is in keys(doc_id, n), joined to keys' columns. n is positive.

    Spark makes a Bloom filter of the keys (of bounded size) and applies it to the
    scan, so that mostly wanted texts are shuffled. The settings lift its size
    limits; the comparison marks keys as the selective side.
    """
    for name, value in (("applicationSideScanSizeThreshold", "0b"), ("creationSideThreshold", "100g")):
        docs.sparkSession.conf.set(f"spark.sql.optimizer.runtime.bloomFilter.{name}", value)
    return docs.join(keys.where("n > 0"), "doc_id")


def bounded_sample(df: DataFrame, key: str, rows: int):
    """About `rows` rows, or all if there are no more, as pandas in order of key.

    Chosen by a hash of the key, so each task sends its share only.
    """
    total = df.count()
    if total > rows:
        df = df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * rows / total))
    return df.toPandas().sort_values(key, ignore_index=True)
