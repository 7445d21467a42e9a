"""Loading many units of source files so that a fault stays with its unit.

A unit is a part of the landing folder (by default its files share the first path
element below it). Every unit gets one audit row:

  OK       all its files and records could be read; its rows are loaded
  FAILED   a file is damaged, a record does not fit the schema, or a row breaks the
           caller's rule; the first error is named and none of its rows are loaded
  STARTED  it was announced, and no file of it has arrived

Files are listed by Spark. Text is read with its malformed records kept; files that
a reader could only fail on (compressed ones, Parquet) are proved first, each in one
task as their formats demand, and left out where they are damaged. A failing unit
therefore never ends the job, however many there are. (Plain text that the storage
cannot deliver does: its tasks are worth a retry.)
"""

from __future__ import annotations

import gzip
import io
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starq.session import stage as keep_staged

CORRUPT = "_corrupt_record"
#: What a reader cannot read past, by ending of the file's name.
PROVED = (".gz", ".parquet")
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Ingested:
    rows: DataFrame
    audit: DataFrame


def first_element(spark: SparkSession, folder: str) -> Callable[[Column], Column]:
    """The unit of a file: the first path element below the folder, without `name=` and file endings."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    depth = len(re.sub("^[a-z0-9]+:/+", "", whole).strip("/").split("/"))

    def unit(file: Column) -> Column:
        elements = F.split(F.regexp_replace(file, "^[a-z0-9]+:/+", ""), "/")
        return F.url_decode(F.regexp_replace(F.get(elements, F.lit(depth)), r"^[^=]*=|\.[^/]*$", ""))

    return unit


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and length of every file below the folder; contents are not read."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length bigint")
    return found.select("path", "length")


def _fault(path: str, content: bytes) -> str | None:
    try:
        if path.endswith(".gz"):
            with gzip.open(io.BytesIO(content)) as text:
                while text.read(_CHUNK):
                    pass
        else:
            import pyarrow.parquet as pq

            for _ in pq.ParquetFile(pa.BufferReader(content)).iter_batches():
                pass
    except (OSError, EOFError, zlib.error, pa.ArrowException) as error:
        return f"damaged file: {type(error).__name__}"
    return None


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("path").to_pylist()
        errors = [_fault(path, content.as_buffer().to_pybytes()) for path, content in zip(paths, batch.column("content"))]
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(errors, pa.string())], names=["path", "error"])


def damaged_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """path and error of those files (of `list_files`) that cannot be read to their end."""
    # A file that the storage itself cannot deliver is passed over, and so has no proof.
    source = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).load(folder)
    proof = source.where(_needs_proof()).select("path", "content").mapInArrow(_prove, "path string, error string")
    proved = proof.withColumn("_read", F.lit(True))
    both = files.where(_needs_proof()).select("path").join(proved, "path", "left")
    error = F.when(F.col("_read").isNull(), "damaged file: unreadable").otherwise(F.col("error"))
    return both.select("path", error.alias("error")).where("error is not null")


def _needs_proof() -> Column:
    kinds = "|".join(e.replace(".", r"\.") for e in PROVED)
    return F.col("path").rlike(f"(?:{kinds})$")


def ingest(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "csv",
    unit: Callable[[Column], Column] | None = None,
    expected: DataFrame | None = None,
    error: Column | None = None,
    options: dict[str, str] | None = None,
    stage: Callable[[DataFrame], DataFrame] = keep_staged,
) -> Ingested:
    """Rows of all sound units (with their `unit`), and one audit row for every unit.

    expected: the `unit`s announced; error: a text where a row is wrong, else NULL.
    Empty files count as not arrived: Spark lists none.
    """
    unit = unit or first_element(spark, folder)
    files = stage(list_files(spark, folder).select("path", "length", unit(F.col("path")).alias("unit")))
    arrived = files.select("unit").distinct()
    broken = spark.createDataFrame([], "path string, error string")
    if not files.where(_needs_proof()).isEmpty():
        broken = stage(damaged_files(spark, folder, files))
    broken_units = files.join(broken, "path").select("unit", "error")
    # The paths of sound files: what Spark's own file index holds for a folder.
    sound = [
        r["path"] for r in files.join(broken_units, "unit", "left_anti").select("path").collect()
    ]
    columns = list(schema.names)
    if sound:
        reader = spark.read.options(**{"header": "true", "escape": '"', **(options or {})})
        if fmt == "parquet":
            read = reader.schema(schema).parquet(*sound).withColumn(CORRUPT, F.lit(None).cast("string"))
        else:
            kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
            read = reader.schema(kept).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).format(fmt).load(sound)
        read = read.select(*columns, CORRUPT, unit(F.col("_metadata.file_path")).alias("unit"))
    else:
        read = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType()), T.StructField("unit", T.StringType())]))
    # Read once: malformed records are known only where whole records are parsed.
    read = stage(read)
    malformed = F.when(F.col(CORRUPT).isNotNull(), F.concat(F.lit("malformed record: "), CORRUPT))
    wrong = malformed if error is None else F.coalesce(malformed, error)
    seen = read.groupBy("unit").agg(F.count(F.lit(1)).alias("row_count"), F.min(wrong).alias("error"))
    audit = _audit(arrived, seen, broken_units, expected)
    audit = stage(audit)
    rows = read.select(*columns, "unit").join(audit.where("status = 'FAILED'").select("unit"), "unit", "left_anti")
    return Ingested(rows.select("unit", *columns), audit)


def _audit(arrived: DataFrame, seen: DataFrame, broken: DataFrame, expected: DataFrame | None) -> DataFrame:
    damaged = broken.groupBy("unit").agg(F.min("error").alias("damage"))
    known = arrived.withColumn("arrived", F.lit(True))
    if expected is not None:
        known = expected.select("unit").distinct().join(known, "unit", "full")
    both = known.join(seen, "unit", "left").join(damaged, "unit", "left")
    first = F.coalesce("damage", "error")
    status = F.when(F.col("arrived").isNull(), "STARTED").when(first.isNotNull(), "FAILED").otherwise("OK")
    return both.select("unit", F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"), status.alias("status"), first.alias("error"))


def units(audit: DataFrame, status: Sequence[str] = ("FAILED", "STARTED")) -> DataFrame:
    """The units of an audit to be asked for again."""
    return audit.where(F.col("status").isin(*status)).select("unit")
