"""Reading and writing tables: CSV, Parquet layers, partitioned and refreshed outputs."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starq.schemas import TABLE_ALIASES


def snake_case(name: str) -> str:
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"\W+", "_", spaced).strip("_").lower()


def clean_header(name: str) -> str:
    return re.sub(r"\s+", " ", name.strip())


def if_there(read):
    """What `read` gives, or None where its path does not exist. Nothing is listed twice."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"):
            return None
        raise


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, required: bool = True
) -> DataFrame:
    """CSV with a header; names trimmed, inner white space collapsed.

    A declared schema names the columns of the file in order (types are never
    inferred; without one all columns are text). An absent optional file gives
    an empty frame.
    """
    reader = spark.read.option("header", True).option("multiLine", False).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", True)
    df = if_there(lambda: reader.csv(path))
    if df is None:
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema or T.StructType([]))
    return df.toDF(*[clean_header(n) for n in df.columns])


def first_existing(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """The first of several optional CSV sources that exists, else an empty frame."""
    for path in paths:
        try:
            return read_csv(spark, path, schema)
        except FileNotFoundError:
            continue
    return spark.createDataFrame([], schema)


def parse_dates(df: DataFrame) -> DataFrame:
    """Every column with 'date' in its name as a timestamp, unreadable text as NULL."""
    names = [
        f.name for f in df.schema.fields
        if "date" in f.name and not isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    ]
    return df.withColumns({n: F.try_to_timestamp(F.col(n).cast("string")) for n in names}) if names else df


def load_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with snake_case names and parsed dates, cast to the declared types if given."""
    raw = read_csv(spark, path)
    df = parse_dates(raw.toDF(*[snake_case(n) for n in raw.columns]))
    return conform(df, schema) if schema is not None else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in order; absent ones NULL, unreadable values NULL, NaN to NULL."""

    def column(f: T.StructField):
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            c = c.try_cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        return c.alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def read_layer(
    spark: SparkSession, folder: str | None, names: Iterable[str], required: bool = False, database: str | None = None
) -> dict[str, DataFrame]:
    """The tables of a layer by logical name, trying older names as well.

    A layer is a folder of Parquet tables or, with `database`, the tables of a
    catalog database (as `refresh_layer` leaves them). Tables that are not there are
    left out, or all named in one error.
    """

    def places(alias: str):
        if database is not None:
            yield lambda: spark.table(f"`{database}`.`{alias}`")
        else:
            for path in (f"{folder.rstrip('/')}/{alias}", f"{folder.rstrip('/')}/{alias}.parquet"):
                yield lambda path=path: spark.read.parquet(path)

    found, missing = {}, []
    for name in names:
        tried = (if_there(read) for alias in TABLE_ALIASES.get(name, (name,)) for read in places(alias))
        df = next((df for df in tried if df is not None), None)
        if df is None:
            missing.append(name)
        else:
            found[name] = df
    if required and missing:
        raise FileNotFoundError(f"tables not found in {database or folder}: {missing}")
    return found


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. An empty result still leaves a file with its header."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_partitioned_csv(df: DataFrame, column: str, path: str) -> None:
    """One folder per value of a column, header in every file.

    Rows are gathered by value first, in portions of about equal size: rare values
    share a task, a frequent one is split over several, so that the number of files
    follows the size of the data and not the number of tasks.
    """
    df.hint("rebalance", F.col(column)).write.mode("overwrite").option("header", True).option("escape", '"').partitionBy(column).csv(path)


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    conform(df, schema).write.mode("append").parquet(path)


def refresh_files(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> None:
    """Replace the Parquet files of the given tables below a folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def write_by_value(df: DataFrame, column: str, path: str) -> None:
    """A Parquet table with one folder per value, files bounded by size (see `write_partitioned_csv`)."""
    df.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(path)


def write_text(document: DataFrame, path: str) -> None:
    """A document of few lines (a JSON report, say) as one text file."""
    document.coalesce(1).write.mode("overwrite").text(path)
