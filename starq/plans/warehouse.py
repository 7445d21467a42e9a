"""The star schema: shared dimensions, context dimensions and the two fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from starq.functions import scalars as c
from starq.operators.asof import Context, asof_join
from starq.operators.domains import JunkKey, junk_keys
from starq.operators.joins import enrich, require_columns
from starq.operators.keys import first_per_key, number_rows, number_set
from starq.operators.slicing import LIMIT
from starq.schemas import AREA_FLAGS

LAP_FLAGS = tuple(AREA_FLAGS["lap"].values())
RESULT_FLAGS = tuple(AREA_FLAGS["result"].values())

# Columns of the outputs.
DIM_DRIVER = ("driver_id", "abbreviation", "first_name", "last_name", "nationality", "driver_age_class")
DIM_TEAM = ("team_id", "team_name", "nationality")
DIM_SEASON = (
    "season_year", "season_start_date", "season_end_date", "number_of_events", "champion_driver", "champion_team",
)
DIM_CIRCUIT = (
    "circuit_id", "circuit_name", "country", "location", "global_circuit_category", "sector1_category",
    "sector2_category", "sector3_category",
)
DIM_GRAND_PRIX = (
    "grand_prix_id", "season_year", "round_number", "circuit_id", "event_name", "event_date", "event_format",
    "circuit_name", "country", "location", "global_circuit_category", "sector1_category", "sector2_category",
    "sector3_category",
)
DIM_SESSION = (
    "session_id", "grand_prix_id", "season_year", "round_number", "session_type", "session_name", "session_date",
)
# dimension -> (key, attributes)
# Key and attributes of each context dimension.
CONTEXT_DIMENSIONS = {
    "dim_tyre_context": ("tyre_context_key", ("compound", "starting_tyre_set_status", "tyre_life_class")),
    "dim_lap_weather_context": (
        "lap_weather_context_key", ("rain_flag", "air_temp_class", "track_temp_class", "wind_speed_class"),
    ),
    "dim_lap_data_quality": ("lap_data_quality_key", LAP_FLAGS),
    "dim_result_outcome": ("result_outcome_key", ("result_status_category", "result_classification_category")),
    "dim_result_weather_context": (
        "result_weather_context_key",
        ("rain_flag", "avg_air_temp_class", "avg_track_temp_class", "avg_wind_speed_class"),
    ),
    "dim_result_data_quality": ("result_data_quality_key", RESULT_FLAGS),
}
LAP_CONTEXT = ("dim_tyre_context", "dim_lap_weather_context", "dim_lap_data_quality")
RESULT_CONTEXT = ("dim_result_outcome", "dim_result_weather_context", "dim_result_data_quality")
# Columns of the facts.
FACT_LAP = (
    "driver_id", "team_id", "grand_prix_id", "tyre_context_key", "lap_weather_context_key", "lap_data_quality_key",
    "session_type", "lap_type", "lap_number", "track_status_category", "lap_time_ms", "sector1_time_ms",
    "sector2_time_ms", "sector3_time_ms", "speed_i1", "speed_i2", "speed_fl", "speed_st", "position",
)
FACT_RESULT = (
    "driver_id", "team_id", "grand_prix_id", "result_outcome_key", "result_weather_context_key",
    "result_data_quality_key", "session_type", "position", "grid_position", "q1_ms", "q2_ms", "q3_ms",
    "gap_to_leader_ms", "points", "laps",
)
WHOLE_NUMBERS = (
    "lap_number", "lap_time_ms", "sector1_time_ms", "sector2_time_ms", "sector3_time_ms", "position", "grid_position",
    "q1_ms", "q2_ms", "q3_ms", "gap_to_leader_ms", "laps",
)


def boolean_flags(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Flags as true / false; absent columns and NULLs become false."""
    return df.withColumns(
        {n: c.parse_bool_or_false(F.col(n)) if n in df.columns else F.lit(False) for n in names}
    )


def unknown_filled(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {n: c.fill_unknown(F.col(n)) if n in df.columns else F.lit("Unknown") for n in names}
    )


# --- dimensions ----------------------------------------------------------------------------------------------------


def simple_dimension(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, one row per key (smallest row wins)."""
    require_columns(df, (key,), "dimension source")
    kept = df.select(*[n for n in columns if n in df.columns])
    return first_per_key(kept, [key], [n for n in kept.columns if n != key] or [key])


def dim_driver(driver: DataFrame) -> DataFrame:
    age = c.age_class(F.col("date_of_birth")) if "date_of_birth" in driver.columns else F.lit("Unknown")
    return simple_dimension(driver.withColumn("driver_age_class", age), "driver_id", DIM_DRIVER)


def dim_team(team: DataFrame) -> DataFrame:
    return simple_dimension(team, "team_id", DIM_TEAM)


def dim_season(season: DataFrame) -> DataFrame:
    return simple_dimension(season, "season_year", DIM_SEASON)


def dim_circuit(circuit: DataFrame) -> DataFrame:
    return simple_dimension(circuit, "circuit_id", DIM_CIRCUIT)


def dim_grand_prix(grand_prix: DataFrame, circuit: DataFrame) -> DataFrame:
    """Events with the attributes of their circuit; on a name clash the event's column stays."""
    if "grand_prix_id" not in grand_prix.columns:
        event_id = c.composite_id("grand_prix", F.col("season_year"), F.col("round_number"))
        grand_prix = grand_prix.withColumn("grand_prix_id", event_id)
    wide = grand_prix
    if "circuit_id" in grand_prix.columns and "circuit_id" in circuit.columns:
        wide = enrich(grand_prix, dim_circuit(circuit), ["circuit_id"])
    return simple_dimension(wide, "grand_prix_id", DIM_GRAND_PRIX)


def dim_session(session: DataFrame, grand_prix: DataFrame) -> DataFrame:
    by_round = ("season_year", "round_number")
    if "session_id" not in session.columns:
        session = session.withColumn(
            "session_id", c.composite_id("session", *[F.col(n) for n in (*by_round, "session_type")])
        )
    if "grand_prix_id" not in session.columns and all(n in session.columns for n in by_round):
        rounds = grand_prix.select("grand_prix_id", *by_round).distinct()
        session = enrich(session, rounds, by_round, guard="grand_prix by round")
    return simple_dimension(session, "session_id", DIM_SESSION)


def context_dimension(df: DataFrame, attributes: Sequence[str], key: str) -> DataFrame:
    """The distinct attribute combinations, numbered in sorted order.

    The attributes are classes and flags, so the set stays small: it is reduced
    before anything is numbered.
    """
    flags = [n for n in attributes if n == "rain_flag" or n.startswith("has_")]
    texts = [n for n in attributes if n not in flags]
    rows = unknown_filled(boolean_flags(df, flags), texts) if flags else unknown_filled(df, texts)
    return number_set(rows.select(*attributes).distinct(), attributes, key)


def with_dimension_key(fact: DataFrame, dimension: DataFrame, attributes: Sequence[str], key: str) -> DataFrame:
    shared = [n for n in attributes if n in fact.columns and n in dimension.columns]
    if not shared:
        return fact.withColumn(key, F.lit(None).cast("bigint"))
    lookup = first_per_key(dimension.select(key, *shared), shared, [key]) if len(shared) < len(attributes) else dimension
    return enrich(fact.drop(key), lookup.select(*shared, key), shared)


# --- context -------------------------------------------------------------------------------------------------------


def with_event_context(fact: DataFrame, session: DataFrame, grand_prix: DataFrame) -> DataFrame:
    """Session and event attributes for a fact; joined on the surrogate key, else on the natural one."""
    session_columns = ("session_id", "grand_prix_id", "season_year", "round_number", "session_type", "session_name",
                       "session_date")
    event_columns = ("grand_prix_id", "season_year", "round_number", "circuit_id", "event_name")
    for side, surrogate, natural, wanted in (
        (session, "session_id", ("season_year", "round_number", "session_type"), session_columns),
        (grand_prix, "grand_prix_id", ("season_year", "round_number"), event_columns),
    ):
        if surrogate in fact.columns and surrogate in side.columns:
            keys = [surrogate]
        elif all(n in fact.columns and n in side.columns for n in natural):
            keys = list(natural)
        else:
            raise ValueError(f"no common key: {surrogate} or {natural}")
        kept = side.select(*[n for n in wanted if n in side.columns]).distinct()
        fact = enrich(fact, kept, keys, guard=f"context by {keys}")
    return fact


def weather_context(weather: DataFrame) -> Context:
    names = {"time_ms": "weather_time_ms"}
    names.update({n: n for n in ("air_temp", "track_temp", "rainfall", "wind_speed")})
    return Context(weather, "time_ms", names, tie="weather_id" if "weather_id" in weather.columns else None)


def track_context(track_status: DataFrame) -> Context:
    names = {"time_ms": "track_status_time_ms", "status": "track_code", "message": "track_message"}
    return Context(track_status, "time_ms", names, tie="track_status_id" if "track_status_id" in track_status.columns else None)


def with_lap_context(
    lap: DataFrame, weather: DataFrame, track_status: DataFrame, limit: int = LIMIT
) -> DataFrame:
    """Weather and track status at the start of each lap, as classes.

    Both contexts are filled in by a single as-of pass over the laps.
    """
    flags = boolean_flags(lap, ("has_weather_information_issue", "has_track_status_information_issue"))
    joined = asof_join(
        flags, ["session_id"], "lap_start_time_ms", [weather_context(weather), track_context(track_status)], limit
    )
    return joined.withColumns(
        {
            "air_temp_class": c.air_temp_class(F.col("air_temp")),
            "track_temp_class": c.track_temp_class(F.col("track_temp")),
            "wind_speed_class": c.wind_speed_class(F.col("wind_speed")),
            "rain_flag": c.parse_bool(F.col("rainfall")),
            "has_weather_information_issue": F.col("has_weather_information_issue") | F.col("weather_time_ms").isNull(),
            "track_status_category": c.track_status_category(F.col("track_message"), F.col("track_code")),
            "has_track_status_information_issue": F.col("has_track_status_information_issue")
            | F.col("track_status_time_ms").isNull(),
        }
    )


def session_weather(weather: DataFrame) -> DataFrame:
    """Average weather of each session, as values and classes."""
    means = weather.groupBy("session_id").agg(
        F.bool_or(c.parse_bool_or_false(F.col("rainfall"))).alias("rain_flag"),
        *[F.avg(c.number(F.col(n))).alias(f"avg_{n}") for n in ("air_temp", "track_temp", "wind_speed")],
    )
    return means.withColumns(
        {
            "avg_air_temp_class": c.air_temp_class(F.col("avg_air_temp")),
            "avg_track_temp_class": c.track_temp_class(F.col("avg_track_temp")),
            "avg_wind_speed_class": c.wind_speed_class(F.col("avg_wind_speed")),
        }
    )


# --- facts ---------------------------------------------------------------------------------------------------------


def _with_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


def _lit_or(df: DataFrame, name: str, build):
    return build(F.col(name)) if name in df.columns else F.lit("Unknown")


def lap_work(tables: Mapping[str, DataFrame], limit: int = LIMIT) -> DataFrame:
    """Laps with every attribute the fact and its dimensions need, and their number."""
    lap = boolean_flags(tables["lap"], LAP_FLAGS)
    # Numbered first, on the narrow source: the order is the source key.
    lap = number_rows(lap, "lap_id", "lap_performance_key")
    lap = with_event_context(lap, tables["session"], tables["grand_prix"])
    lap = lap.withColumns(
        {
            "lap_type": c.lap_type(F.col("pit_out_time_ms"), F.col("pit_in_time_ms")),
            "starting_tyre_set_status": _lit_or(lap, "fresh_tyre", c.tyre_set_status),
            "tyre_life_class": _lit_or(lap, "tyre_life", c.tyre_life_class),
        }
    )
    lap = with_lap_context(lap, tables["weather"], tables["track_status"], limit)
    texts = (
        "compound", "lap_type", "starting_tyre_set_status", "tyre_life_class", "air_temp_class", "track_temp_class",
        "wind_speed_class", "track_status_category", "session_type",
    )
    return boolean_flags(unknown_filled(lap, texts), ("rain_flag",))


def result_work(tables: Mapping[str, DataFrame]) -> DataFrame:
    result = boolean_flags(tables["result"], RESULT_FLAGS)
    result = number_rows(result, "result_id", "session_result_key")
    result = with_event_context(result, tables["session"], tables["grand_prix"])
    result = result.withColumns(
        {
            "result_classification_category": _lit_or(result, "classified_position", c.classification_category),
            "result_status_category": _lit_or(result, "status", c.status_category),
            "gap_to_leader_ms": c.gap_to_leader_ms(
                F.col("session_type"), F.col("position"), F.col("status"), F.col("time_ms")
            ),
        }
    )
    result = enrich(result, session_weather(tables["weather"]), ["session_id"])
    texts = (
        "result_classification_category", "result_status_category", "avg_air_temp_class", "avg_track_temp_class",
        "avg_wind_speed_class", "session_type",
    )
    return boolean_flags(unknown_filled(result, texts), ("rain_flag",))


def context_keys(work: DataFrame, names: Sequence[str], **limits: int) -> dict[str, JunkKey]:
    """Key expressions of the context dimensions whose domains are small: two passes for all of them."""
    return junk_keys(work, {n: CONTEXT_DIMENSIONS[n] for n in names}, **limits)


def context_dimensions(
    work: DataFrame, names: Sequence[str], keys: Mapping[str, JunkKey] | None = None
) -> dict[str, DataFrame]:
    """The context dimensions: read off the bitmaps of `keys`, or numbered from the distinct rows."""
    keys = keys or {}
    return {
        n: keys[n].dimension(work.sparkSession) if n in keys
        else context_dimension(work, CONTEXT_DIMENSIONS[n][1], CONTEXT_DIMENSIONS[n][0])
        for n in names
    }


def _fact(
    work: DataFrame, dimensions: Mapping[str, DataFrame], context: Sequence[str], key: str, columns: Sequence[str],
    keys: Mapping[str, JunkKey] | None = None,
) -> DataFrame:
    keys = keys or {}
    for name in context:
        dimension_key, attributes = CONTEXT_DIMENSIONS[name]
        if name in keys:
            work = work.withColumn(dimension_key, keys[name].key())
        else:
            work = with_dimension_key(work, dimensions[name], attributes, dimension_key)
    work = _with_columns(work, columns)
    return work.select(
        key, *[F.col(n).try_cast("bigint").alias(n) if n in WHOLE_NUMBERS else F.col(n) for n in columns]
    )


def lap_fact(
    work: DataFrame, dimensions: Mapping[str, DataFrame], keys: Mapping[str, JunkKey] | None = None
) -> DataFrame:
    """Dimension keys by expression where `keys` has one, else by a join."""
    return _fact(work, dimensions, LAP_CONTEXT, "lap_performance_key", FACT_LAP, keys)


def result_fact(
    work: DataFrame, dimensions: Mapping[str, DataFrame], keys: Mapping[str, JunkKey] | None = None
) -> DataFrame:
    return _fact(work, dimensions, RESULT_CONTEXT, "session_result_key", FACT_RESULT, keys)


@dataclass(frozen=True)
class Warehouse:
    dimensions: dict[str, DataFrame]
    fact_lap_performance: DataFrame
    fact_session_result: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            **self.dimensions,
            "fact_lap_performance": self.fact_lap_performance,
            "fact_session_result": self.fact_session_result,
        }


def build(
    tables: Mapping[str, DataFrame], stage=lambda df: df, limit: int = LIMIT
) -> Warehouse:
    """The whole star. `stage` may write the two work frames once (dimensions, their keys
    and facts all read them); see `starq.session.materialize`."""
    laps, results = stage(lap_work(tables, limit)), stage(result_work(tables))
    lap_keys, result_keys = context_keys(laps, LAP_CONTEXT), context_keys(results, RESULT_CONTEXT)
    dimensions = {
        "dim_driver": dim_driver(tables["driver"]),
        "dim_team": dim_team(tables["team"]),
        "dim_grand_prix": dim_grand_prix(tables["grand_prix"], tables["circuit"]),
        **context_dimensions(laps, LAP_CONTEXT, lap_keys),
        **context_dimensions(results, RESULT_CONTEXT, result_keys),
    }
    return Warehouse(
        dimensions, lap_fact(laps, dimensions, lap_keys), result_fact(results, dimensions, result_keys)
    )
