"""Missing values judged by context: explained or suspicious, and which information they take away."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starq.functions.scalars import number, parse_bool_or_false, strip
from starq.operators.joins import enrich, require_columns
from starq.plans.quality import row_identifier, without_nan
from starq.schemas import INFORMATION_AREAS, SECTOR_METRICS, SPEED_METRICS

EXPLAINED, SUSPICIOUS = "EXPLAINED_NULL", "SUSPICIOUS_NULL"
FLAG_COLUMNS = (
    "table_name", "row_identifier", "column_name", "missing_class", "missing_information_area", "explanation", "severity",
)
# Areas whose suspicious nulls are red.
CRITICAL_AREAS = (
    "CLASSIFICATION_INFORMATION", "QUALIFYING_INFORMATION", "LAP_TIME_INFORMATION", "TYRE_INFORMATION",
)
QUALIFYING_COLUMNS = ("q1_ms", "q2_ms", "q3_ms")
RACE_CONTEXT_COLUMNS = ("grid_position", "status", "points", "laps", "time_ms")
# Last rank that reaches the segment.
SEGMENT_RANKS = {"q2_ms": 15, "q3_ms": 10}
WEATHER_COLUMNS = ("air_temp", "track_temp", "rainfall", "rain_flag", "wind_speed")


def with_session_type(result: DataFrame, session: DataFrame) -> DataFrame:
    """Results with the type of their session (left join, kept as they are if they have it)."""
    if "session_type" in result.columns:
        return result
    require_columns(session, ("session_id", "session_type"), "session")
    return enrich(result, session.select("session_id", "session_type"), ["session_id"], null_safe=False)


def severity(missing_class: Column, area: Column) -> Column:
    return (
        F.when(area == "NONE", "green")
        .when(missing_class == EXPLAINED, "yellow")
        .when(area.isin(*CRITICAL_AREAS), "red")
        .otherwise("yellow")
    )


def _entry(column: str, when: Column, missing_class: str, area: str, text: str) -> Column:
    return F.when(
        F.col(column).isNull() & when,
        F.struct(
            F.lit(column).alias("column_name"), F.lit(missing_class).alias("missing_class"),
            F.lit(area).alias("missing_information_area"), F.lit(text).alias("explanation"),
        ),
    )


def _flags(df: DataFrame, table: str, key: str, entries: Sequence[Column], keep_explained: bool) -> DataFrame:
    """All flags of a row in one pass over the table."""
    df = without_nan(df)
    flat = df.select(row_identifier(df.columns, [key]).alias("row_identifier"), F.inline(F.array(*entries)))
    flat = flat.where(F.col("column_name").isNotNull())
    if not keep_explained:
        explained = (F.col("missing_class") == EXPLAINED) & (F.col("missing_information_area") == "NONE")
        flat = flat.where(~explained)
    return (
        flat.withColumn("table_name", F.lit(table))
        .withColumn("severity", severity(F.col("missing_class"), F.col("missing_information_area")))
        .select(*FLAG_COLUMNS)
    )


def result_flags(result: DataFrame, keep_explained: bool = False) -> DataFrame:
    """Flags of the result table; needs `session_type` (see `with_session_type`)."""
    require_columns(result, ("session_type",), "result")
    kind = strip(F.col("session_type"))
    race, qualifying = F.coalesce(kind == "R", F.lit(False)), F.coalesce(kind == "Q", F.lit(False))
    has = set(result.columns)
    entries = []

    def add(columns, when, missing_class, area, text):
        entries.extend(_entry(c, when, missing_class, area, text.format(c)) for c in columns if c in has)

    # Explanations.
    add(QUALIFYING_COLUMNS, race, EXPLAINED, "NONE", "{} is not applicable in a Race session.")
    add(("position", "classified_position"), race, SUSPICIOUS, "CLASSIFICATION_INFORMATION",
        "{} is expected in a Race session and is missing.")
    add(RACE_CONTEXT_COLUMNS, race, SUSPICIOUS, "RACE_CONTEXT_INFORMATION",
        "{} is race-context information and is missing in a Race session.")
    add(("position",), qualifying, SUSPICIOUS, "CLASSIFICATION_INFORMATION",
        "{} is missing in a Qualifying session, so qualifying progression cannot be interpreted reliably.")
    add(("classified_position", *RACE_CONTEXT_COLUMNS), qualifying, EXPLAINED, "NONE",
        "{} is race-related and is not central in a Qualifying session.")
    add(("q1_ms",), qualifying, SUSPICIOUS, "QUALIFYING_INFORMATION", "{} is missing in a Qualifying session.")
    rank = number(F.col("position")) if "position" in has else F.lit(None).cast("double")
    for column, last in SEGMENT_RANKS.items():
        out = F.coalesce(rank > last, F.lit(False))
        segment = column[:2].upper()
        add((column,), qualifying & out, EXPLAINED, "NONE",
            "{} is missing because the driver was classified outside the top "
            f"{last} and normally did not reach {segment}.")
        add((column,), qualifying & ~out, SUSPICIOUS, "QUALIFYING_INFORMATION",
            f"{{}} is missing although the position does not clearly explain elimination before {segment}.")
    return _flags(result, "result", "result_id", entries, keep_explained)


def lap_flags(lap: DataFrame, keep_explained: bool = False) -> DataFrame:
    has = set(lap.columns)
    always = F.lit(True)

    def present(column: str) -> Column:
        return F.col(column).isNotNull() if column in has else F.lit(False)

    pit_in, pit_any = present("pit_in_time_ms"), present("pit_in_time_ms") | present("pit_out_time_ms")
    deleted = parse_bool_or_false(F.col("deleted")) if "deleted" in has else F.lit(False)
    entries = []

    def add(column, when, missing_class, area, text):
        if column in has:
            entries.append(_entry(column, when, missing_class, area, text.format(column)))

    # Explanations.
    add("pit_in_time_ms", always, EXPLAINED, "NONE", "{} is missing because the lap is treated as not being an in-lap.")
    add("pit_out_time_ms", always, EXPLAINED, "NONE", "{} is missing because the lap is treated as not being an out-lap.")
    add("deleted_reason", ~deleted, EXPLAINED, "NONE", "{} is missing because deleted = false.")
    add("lap_time_ms", always, SUSPICIOUS, "LAP_TIME_INFORMATION",
        "{} is missing, so the row lacks the main lap time information.")
    for column in SECTOR_METRICS:
        explained = pit_in if column == "sector3_time_ms" else F.lit(False)
        add(column, explained, EXPLAINED, "SECTOR_INFORMATION",
            "{} is missing and pit_in_time_ms is present, so the lap is an in-lap.")
        add(column, ~explained, SUSPICIOUS, "SECTOR_INFORMATION",
            "{} is missing without a direct sector-specific explanation.")
    for column in SPEED_METRICS:
        explained = F.lit(False) if column == "speed_i2" else pit_any
        add(column, explained, EXPLAINED, "SPEED_INFORMATION", "{} is missing and pit information is present.")
        add(column, ~explained, SUSPICIOUS, "SPEED_INFORMATION",
            "{} is missing without a direct pit-related explanation.")
    add("compound", always, SUSPICIOUS, "TYRE_INFORMATION", "{} is missing, so tyre information is incomplete.")
    add("tyre_life", always, SUSPICIOUS, "TYRE_INFORMATION",
        "{} is missing, so tyre degradation information is incomplete.")
    add("track_status", always, SUSPICIOUS, "TRACK_STATUS_INFORMATION",
        "{} is missing, so track condition information is incomplete.")
    for column in WEATHER_COLUMNS:
        add(column, always, SUSPICIOUS, "WEATHER_INFORMATION",
            "{} is missing, so weather context information is incomplete.")
    return _flags(lap, "lap", "lap_id", entries, keep_explained)


def missing_flags(tables: Mapping[str, DataFrame], keep_explained: bool = False) -> DataFrame:
    result = with_session_type(tables["result"], tables["session"])
    return result_flags(result, keep_explained).unionByName(lap_flags(tables["lap"], keep_explained))


def _most_frequent(counts: Mapping[str, Column]) -> Column:
    """Name with the largest count, ties to the first name."""
    ordered = sorted(counts)
    best = F.greatest(*counts.values()) if len(counts) > 1 else next(iter(counts.values()))
    return reduce(lambda chain, n: chain.when(counts[n] == best, n), ordered[1:], F.when(counts[ordered[0]] == best, ordered[0]))


def missing_summary(flags: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Recorded flags per table and column, with the most frequent class and area."""
    area_columns = {a: f"{a.lower()}_count" for a in INFORMATION_AREAS}
    counted = flags.groupBy("table_name", "column_name").agg(
        F.count("*").alias("missing_count"),
        F.count_if(F.col("missing_class") == EXPLAINED).alias("explained_null_count"),
        F.count_if(F.col("missing_class") == SUSPICIOUS).alias("suspicious_null_count"),
        *[F.count_if(F.col("missing_information_area") == a).alias(c) for a, c in area_columns.items()],
    )
    sizes = [
        tables[t].agg(F.count("*").alias("total_rows")).select(F.lit(t).alias("table_name"), "total_rows")
        for t in ("lap", "result") if t in tables
    ]
    sizes = reduce(DataFrame.unionByName, sizes)
    share = F.when(F.col("total_rows") > 0, F.round(F.col("missing_count") / F.col("total_rows"), 6))
    classes = {EXPLAINED: F.col("explained_null_count"), SUSPICIOUS: F.col("suspicious_null_count")}
    areas = {a: F.col(c) for a, c in area_columns.items()}
    # One size row per table.
    return counted.join(F.broadcast(sizes), "table_name", "left").select(
        "table_name", "column_name", "total_rows", "missing_count", share.alias("missing_percentage"),
        "explained_null_count", "suspicious_null_count", _most_frequent(classes).alias("main_missing_class"),
        _most_frequent(areas).alias("main_missing_information_area"), *area_columns.values(),
    )
