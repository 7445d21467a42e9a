"""Keys: first row per key, uniqueness guards, consecutive surrogate numbers."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starq.session import stage as keep_staged

# Rows a set may have to be numbered by one task.
SMALL_SET = 1_000_000


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key. Combined map-side, so a hot key is no hot task."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*rest)
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """df itself, failing the query when a key occurs twice (m:1 guard)."""
    rest = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in rest])
    message = F.concat(F.lit(f"{what}: key {list(keys)} occurs "), F.col("_n").cast("string"), F.lit(" times"))
    guard = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.where(guard).select(*df.columns)


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete keys that occur more than once, with their count `_n`."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)


def number_rows(
    df: DataFrame, order: str | Sequence[str | Column], name: str, start: int = 1, limit: int | None = None,
    stage: Callable[[DataFrame], DataFrame] = keep_staged,
) -> DataFrame:
    """Consecutive numbers in the order of some columns of any type, NULL first.

    Spark deals the rows out by ranges of the order, as many as it has shuffle partitions
    or as give each about `limit` rows; rows that tie are told apart by a hash, so ties
    (or NULLs) fill several ranges. Places in a range are stored with the rows, in one
    pass; sizes of the ranges before shift them. Ranges are sorted, which spills, but no
    window spans more than one row per range and no sample is gathered by one task.
    """
    order = [order] if isinstance(order, (str, Column)) else list(order)
    ordered = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    ties = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    ranges = [max(math.ceil(df.count() / limit), 1)] if limit else []
    dealt = df.repartitionByRange(*ranges, *ordered, ties).sortWithinPartitions(*ordered, ties)
    # The upper bits tell the range, the lower ones the place in it.
    placed = stage(dealt.withColumn("_at", F.monotonically_increasing_id()))
    place = F.col("_at").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    # One row per range.
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    return placed.join(F.broadcast(shifts), "_range").select(
        (F.col("_shift") + place + F.lit(start)).cast("bigint").alias(name), *[F.col(f"`{c}`") for c in df.columns]
    )


def number_set(
    df: DataFrame, order: Sequence[str], name: str, stage: Callable[[DataFrame], DataFrame] = keep_staged
) -> DataFrame:
    """Numbers 1..n for a set of distinct rows, NULL last: in one task while it is small, over ranges beyond."""
    ordered = [F.col(c).asc_nulls_last() for c in order]
    df = stage(df)
    if df.count() > SMALL_SET:
        return number_rows(df, ordered, name, stage=stage)
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*ordered))
    return df.select(number.cast("bigint").alias(name), *df.columns)
