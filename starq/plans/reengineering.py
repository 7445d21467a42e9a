"""From landed source frames to the reconciled tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starq.functions.scalars import alias_key, duration_text_to_ms, interval_to_ms, match_key
from starq.operators.joins import enrich, require_columns
from starq.operators.keys import first_per_key, number_rows
from starq.sources.tables import parse_dates

__all__ = [
    "durations_to_ms", "union_first_wins", "enrich_laps_with_ids", "with_circuit_id", "unmatched", "without_value",
    "fan_out", "continued_numbers", "ingest_audit", "parse_dates", "project",
]


def durations_to_ms(df: DataFrame, text_columns: Sequence[str] = ()) -> DataFrame:
    """Intervals (and the named duration texts) as whole milliseconds, renamed `<column>_ms`."""

    def column(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DayTimeIntervalType):
            return interval_to_ms(F.col(f.name)).alias(f"{f.name}_ms")
        if f.name in text_columns:
            return duration_text_to_ms(F.col(f.name)).alias(f"{f.name}_ms")
        return F.col(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def unreadable_durations(df: DataFrame, text_columns: Sequence[str]) -> DataFrame:
    """How many texts of each column are no duration (one row per column)."""
    counts = [
        F.count_if((F.length(F.col(c).cast("string")) > 0) & duration_text_to_ms(F.col(c)).isNull()).alias(f"n{i}")
        for i, c in enumerate(text_columns)
    ]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("unreadable")) for i, c in enumerate(text_columns)]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def union_first_wins(
    batches: Sequence[DataFrame], key: str, renames: Mapping[str, str], order: Sequence[str] = ()
) -> DataFrame:
    """Stack batches and keep each key's row of the earliest batch.

    Inside a batch the smallest `order` values win (all columns by default).
    """
    tagged = [b.withColumn("_batch", F.lit(i)) for i, b in enumerate(batches)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    inner = list(order) or [c for c in stacked.columns if c not in (key, "_batch")]
    first = first_per_key(stacked, [key], ["_batch", *inner]).drop("_batch")
    return first.withColumnsRenamed(dict(renames))


def enrich_laps_with_ids(laps: DataFrame, results: DataFrame) -> DataFrame:
    """Driver and team ids of a lap through (session, driver number); fails on ambiguous results."""
    keys, ids = ["session_id", "driver_number"], ["driver_id", "team_id"]
    require_columns(laps, keys, "laps")
    require_columns(results, [*keys, *ids], "results")
    return enrich(laps, results.select(*keys, *ids).distinct(), keys, guard="laps to results")


def with_circuit_id(events: DataFrame, circuits: DataFrame) -> DataFrame:
    """Circuit of an event by country and place, compared without case, spacing and known aliases."""

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"_country": match_key(F.col("country")), "_place": alias_key(F.col("location"))})

    circuit = keyed(circuits).select("circuit_id", "_country", "_place").distinct()
    return enrich(keyed(events), circuit, ["_country", "_place"], guard="events to circuits").drop("_country", "_place")


def unmatched(df: DataFrame, key: str) -> DataFrame:
    """Rows a lookup left without a key."""
    return df.where(F.col(key).isNull())


def without_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose text differs from a value, ignoring case; NULL text is kept."""
    return df.where(F.coalesce(F.lower(column) != value.lower(), F.lit(True)))


def fan_out(parents: DataFrame, column: str, values: Sequence[str], **constants) -> DataFrame:
    """Every parent once per value, with constant context columns."""
    return parents.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values]))).withColumns(
        {n: F.lit(v) for n, v in constants.items()}
    )


def continued_numbers(
    batches: DataFrame, order: str | Sequence[str], name: str, start: int = 1, **options
) -> DataFrame:
    """Surrogate ids that run on from batch to batch; `order` grows with batch and position.

    `operators.registry` keeps ids from run to run.
    """
    return number_rows(batches, order, name, start, **options)


def ingest_audit(rows: DataFrame, unit: Sequence[str], error: Column, expected: DataFrame | None = None) -> DataFrame:
    """One audit row per ingested unit: OK, FAILED with its first error, or STARTED when nothing arrived."""
    seen = rows.withColumn("_error", error).groupBy(*unit).agg(
        F.count("*").alias("row_count"), F.min("_error").alias("error")
    )
    if expected is not None:
        seen = expected.select(*unit).distinct().join(seen, list(unit), "left")
    status = (
        F.when(F.col("row_count").isNull(), "STARTED").when(F.col("error").isNotNull(), "FAILED").otherwise("OK")
    )
    return seen.select(*unit, F.coalesce("row_count", F.lit(0)).alias("row_count"), status.alias("status"), "error")


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns, "frame")
    return df.select(*columns)
