"""Outliers of timed rows per session and metric: two robust methods and their agreement."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starq.functions.scalars import number, parse_bool_or_false, strip
from starq.operators.joins import require_columns
from starq.operators.quantiles import group_spread, hot_spread
from starq.operators.slicing import LIMIT, Slices, hot_groups
from starq.plans.quality import row_identifier
from starq.schemas import OUTLIER_METRICS
from starq.session import stage as keep_staged

# Limits of the two methods and the smallest group tested.
IQR_FACTOR = 1.5
Z_SCALE = 0.6745
Z_LIMIT = 3.5
SMALLEST_GROUP = 10

OUTLIER_COLUMNS = (
    "table_name", "row_identifier", "session_id", "metric", "value", "iqr_flag", "modified_z_flag", "consensus_score",
    "interpretation", "q1", "q3", "iqr_lower_bound", "iqr_upper_bound", "median", "mad", "modified_z_score",
)


def dry_sessions(weather: DataFrame) -> DataFrame:
    """Sessions with weather rows, none of which reports rain."""
    require_columns(weather, ("session_id", "rainfall"), "weather")
    rain = parse_bool_or_false(F.col("rainfall"))
    known = weather.where(F.col("session_id").isNotNull())
    return known.groupBy("session_id").agg(F.bool_or(rain).alias("_rain")).where(~F.col("_rain")).select("session_id")


def race_sessions(session: DataFrame) -> DataFrame:
    require_columns(session, ("session_id", "session_type"), "session")
    return session.where(strip(F.col("session_type")) == "R").select("session_id")


def all_clear(track_status: Column) -> Column:
    return F.coalesce(strip(track_status).isin("1", "1.0"), F.lit(False))


def clean_laps(lap: DataFrame, weather: DataFrame, session: DataFrame) -> DataFrame:
    """Timed laps with a compound, no pit stop and a clear track, of dry races."""
    require_columns(
        lap, ("session_id", "lap_time_ms", "compound", "pit_in_time_ms", "pit_out_time_ms", "track_status"), "lap"
    )
    usable = (
        number(F.col("lap_time_ms")).isNotNull()
        & F.col("compound").isNotNull()
        & F.col("pit_in_time_ms").isNull()
        & F.col("pit_out_time_ms").isNull()
        & all_clear(F.col("track_status"))
    )
    return (
        lap.where(usable)
        .join(dry_sessions(weather), "session_id", "left_semi")
        .join(race_sessions(session), "session_id", "left_semi")
    )


def long_metrics(
    df: DataFrame, ids: Sequence[str | Column], metrics: Sequence[str], name: str = "metric", value: str = "value"
) -> DataFrame:
    """Wide to long, missing values dropped."""
    metrics = [m for m in metrics if m in df.columns]
    known = [i for i in ids if isinstance(i, str)]
    extra = [i for i in ids if not isinstance(i, str)]
    slim = df.select(*known, *extra, *[number(F.col(m)).alias(m) for m in metrics])
    keep = [c for c in slim.columns if c not in metrics]
    return slim.unpivot(keep, metrics, name, value).where(F.col(value).isNotNull())


def score_groups(
    values: DataFrame, keys: Sequence[str], value: str = "value", smallest: int = SMALLEST_GROUP,
    limit: int = LIMIT, stage: Callable[[DataFrame], DataFrame] = keep_staged,
) -> DataFrame:
    """Every value with the statistics, flags and agreement of its group.

    Groups below `smallest` keep `tested` but get no flags. A group without
    spread (IQR or MAD of 0) gets no flags and no bounds of that method.
    """
    keys = list(keys)
    hot = hot_groups(values, keys, value, limit)
    if hot is None:
        stats = group_spread(values, keys, value, Slices(tuple(keys), None)).withColumnRenamed("_n", "tested")
        scored = values.join(stats, keys, "left")
    else:
        # Read several times from here on.
        values, hot_keys = stage(values), F.broadcast(hot.select(*keys))
        rest, large = values.join(hot_keys, keys, "left_anti"), values.join(hot_keys, keys, "left_semi")
        known = large.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
        few = hot_spread(known, keys, Slices(tuple(keys), hot)).withColumnRenamed("_n", "tested")
        stats = group_spread(rest, keys, value, Slices(tuple(keys), None)).withColumnRenamed("_n", "tested")
        # Rows of hot groups, one per `limit` rows at most, are broadcast: their members stay in place.
        scored = values.join(F.broadcast(few), keys).unionByName(rest.join(stats, keys, "left"))

    enough = F.col("tested") >= smallest
    spread = F.col("q3") - F.col("q1")
    lower = F.when(enough & (spread != 0), F.col("q1") - IQR_FACTOR * spread)
    upper = F.when(enough & (spread != 0), F.col("q3") + IQR_FACTOR * spread)
    z = F.when(enough & (F.col("mad") != 0), Z_SCALE * (F.col(value) - F.col("median")) / F.col("mad"))
    return (
        scored.withColumns(
            {
                "iqr_lower_bound": lower,
                "iqr_upper_bound": upper,
                "modified_z_score": z,
                "iqr_flag": F.coalesce((F.col(value) < lower) | (F.col(value) > upper), F.lit(False)),
                "modified_z_flag": F.coalesce(F.abs(z) > Z_LIMIT, F.lit(False)),
            }
        )
        .withColumn("consensus_score", F.col("iqr_flag").cast("int") + F.col("modified_z_flag").cast("int"))
        .withColumn("interpretation", interpretation(F.col("consensus_score")))
        .withColumn("q1", F.when(F.col("iqr_lower_bound").isNotNull(), F.col("q1")))
        .withColumn("q3", F.when(F.col("iqr_lower_bound").isNotNull(), F.col("q3")))
        .withColumn("median", F.when(F.col("modified_z_score").isNotNull(), F.col("median")))
        .withColumn("mad", F.when(F.col("modified_z_score").isNotNull(), F.col("mad")))
    )


def interpretation(score: Column) -> Column:
    return F.when(score >= 2, "STRONG_CONSENSUS_OUTLIER").when(score == 1, "WEAK_ANOMALY").otherwise("NORMAL")


@dataclass(frozen=True)
class Outliers:
    flags: DataFrame
    summary: DataFrame


def detect(
    laps: DataFrame, metrics: Sequence[str] = OUTLIER_METRICS, limit: int = LIMIT,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Outliers:
    """Outlier flags and the summary per session and metric of already clean laps.

    `stage` may keep the laps' values, which are read for group sizes, statistics, scores
    and summary, and the flags, from which the summary counts the outliers.
    """
    rid = row_identifier(laps.columns, ["lap_id"]).alias("row_identifier")
    metrics = [m for m in metrics if m in laps.columns]
    laps = stage(laps.where(F.col("session_id").isNotNull()).select("session_id", rid, *metrics))
    values = long_metrics(laps, ["session_id", "row_identifier"], metrics)
    scored = score_groups(values, ["session_id", "metric"], limit=limit)
    flags = stage(scored.where(F.col("consensus_score") > 0).withColumn("table_name", F.lit("lap")).select(*OUTLIER_COLUMNS))
    return Outliers(flags, summarize(laps, flags, metrics))


def summarize(laps: DataFrame, flags: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row per session and metric, also where a session has no value of the metric.

    Values are counted in the laps, outliers among the flagged values: every outlier of either method is flagged.
    """
    tested = laps.groupBy("session_id").agg(*[F.count(number(F.col(m))).alias(m) for m in metrics])
    grid = tested.unpivot("session_id", metrics, "metric", "tested_values")
    counted = flags.groupBy("session_id", "metric").agg(
        F.count_if("iqr_flag").alias("iqr_outliers"),
        F.count_if("modified_z_flag").alias("modified_z_outliers"),
        F.count_if(F.col("consensus_score") >= 2).alias("consensus_outliers"),
    )
    numbers = ["tested_values", "iqr_outliers", "modified_z_outliers", "consensus_outliers"]
    return (
        grid.join(counted, ["session_id", "metric"], "left")
        .select(F.lit("lap").alias("table_name"), "session_id", "metric", *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers])
        .withColumn(
            "status", F.when(F.col("tested_values") < SMALLEST_GROUP, "skipped_too_few_values").otherwise("completed")
        )
    )


def detect_from_tables(tables: Mapping[str, DataFrame], **options) -> Outliers:
    return detect(clean_laps(tables["lap"], tables["weather"], tables["session"]), **options)
