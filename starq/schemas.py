"""Tables, keys, references and domains of the reconciled layer."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, DOUBLE, STRING, BOOLEAN, TIMESTAMP = (
    T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampType(),
)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names and types of the ten reconciled tables.
SCHEMAS: dict[str, T.StructType] = {
    "season": _table(
        season_year=LONG, season_start_date=TIMESTAMP, season_end_date=TIMESTAMP, number_of_events=LONG,
        champion_driver=STRING, champion_team=STRING,
    ),
    "circuit": _table(
        circuit_id=STRING, circuit_name=STRING, country=STRING, location=STRING, seasons_present=STRING,
        global_circuit_category=STRING, sector1_category=STRING, sector2_category=STRING, sector3_category=STRING,
    ),
    "driver": _table(
        driver_id=STRING, permanent_number=DOUBLE, abbreviation=STRING, first_name=STRING, last_name=STRING,
        date_of_birth=TIMESTAMP, nationality=STRING, driver_url=STRING,
    ),
    "team": _table(
        team_id=STRING, team_name=STRING, nationality=STRING, team_url=STRING,
    ),
    "grand_prix": _table(
        grand_prix_id=LONG, season_year=LONG, round_number=LONG, event_name=STRING, official_event_name=STRING,
        country=STRING, location=STRING, event_date=TIMESTAMP, event_format=STRING, f1_api_support=BOOLEAN,
        circuit_id=STRING,
    ),
    "session": _table(
        session_id=LONG, grand_prix_id=LONG, session_type=STRING, session_name=STRING, session_date=TIMESTAMP,
    ),
    "result": _table(
        result_id=LONG, session_id=LONG, driver_id=STRING, team_id=STRING, position=DOUBLE,
        classified_position=STRING, grid_position=DOUBLE, q1_ms=LONG, q2_ms=LONG, q3_ms=LONG, time_ms=LONG,
        status=STRING, points=DOUBLE, laps=DOUBLE,
    ),
    "lap": _table(
        lap_id=LONG, time_ms=LONG, driver=STRING, driver_number=LONG, lap_time_ms=LONG, lap_number=DOUBLE,
        stint=DOUBLE, pit_out_time_ms=LONG, pit_in_time_ms=LONG, sector1_time_ms=LONG, sector2_time_ms=LONG,
        sector3_time_ms=LONG, sector1_session_time_ms=LONG, sector2_session_time_ms=LONG,
        sector3_session_time_ms=LONG, speed_i1=DOUBLE, speed_i2=DOUBLE, speed_fl=DOUBLE, speed_st=DOUBLE,
        is_personal_best=BOOLEAN, compound=STRING, tyre_life=DOUBLE, fresh_tyre=BOOLEAN, team=STRING,
        lap_start_time_ms=LONG, lap_start_date=TIMESTAMP, track_status=STRING, position=DOUBLE, deleted=BOOLEAN,
        deleted_reason=STRING, fast_f1_generated=BOOLEAN, is_accurate=BOOLEAN, session_id=LONG, driver_id=STRING,
        team_id=STRING,
    ),
    "weather": _table(
        weather_id=LONG, time_ms=LONG, air_temp=DOUBLE, humidity=DOUBLE, pressure=DOUBLE, rainfall=BOOLEAN,
        track_temp=DOUBLE, wind_direction=DOUBLE, wind_speed=DOUBLE, session_id=LONG,
    ),
    "track_status": _table(
        track_status_id=LONG, time_ms=LONG, status=STRING, message=STRING, session_id=LONG,
    ),
}

# Parents come before children, so one walk settles every cascade.
TABLE_ORDER = (
    "season", "circuit", "driver", "team", "grand_prix", "session", "result", "lap", "weather", "track_status",
)

# Fixed values.
PRIMARY_KEY = {
    "season": "season_year",
    "circuit": "circuit_id",
    "driver": "driver_id",
    "team": "team_id",
    "grand_prix": "grand_prix_id",
    "session": "session_id",
    "result": "result_id",
    "lap": "lap_id",
    "weather": "weather_id",
    "track_status": "track_status_id",
}

# Fixed values.
NATURAL_KEYS = {
    "grand_prix": ("season_year", "round_number"),
    "session": ("grand_prix_id", "session_type"),
    "result": ("session_id", "driver_id"),
    "lap": ("session_id", "driver_id", "lap_number"),
    "weather": ("session_id", "time_ms"),
    "track_status": ("session_id", "time_ms"),
}

# child table -> ((child column, parent table, parent column), ...)
# Fixed values.
FOREIGN_KEYS = {
    "grand_prix": (("season_year", "season", "season_year"), ("circuit_id", "circuit", "circuit_id")),
    "session": (("grand_prix_id", "grand_prix", "grand_prix_id"),),
    "result": (
        ("session_id", "session", "session_id"), ("driver_id", "driver", "driver_id"), ("team_id", "team", "team_id"),
    ),
    "lap": (
        ("session_id", "session", "session_id"), ("driver_id", "driver", "driver_id"), ("team_id", "team", "team_id"),
    ),
    "weather": (("session_id", "session", "session_id"),),
    "track_status": (("session_id", "session", "session_id"),),
}

# Logical names and the older names a source catalogue may still use.
TABLE_ALIASES = {
    "grand_prix": ("grand_prix", "event_weekend", "event"),
    "result": ("result", "session_result"),
    "lap": ("lap", "lap_performance"),
    "weather": ("weather", "session_weather"),
    "track_status": ("track_status", "session_track_status"),
}

# Domains.
CIRCUIT_CATEGORIES = ("Street", "PowerSensitive", "AeroSensitive", "Mixed")
SECTOR_CATEGORIES = ("Power", "FastCorners", "SlowCorners", "Technical")
SESSION_TYPES = ("Q", "R")
EVENT_FORMATS = ("conventional", "sprint")
TYRE_COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")
TRACK_STATUS_MESSAGES = {
    1: "AllClear", 2: "Yellow", 4: "SCDeployed", 5: "Red", 6: "VSCDeployed", 7: "VSCEnding",
}
LOCATION_ALIASES = {"monaco": "monte carlo", "montecarlo": "monte carlo"}

# Information areas and the row flags they switch on.
AREA_FLAGS = {
    "lap": {
        "SECTOR_INFORMATION": "has_sector_information_issue",
        "SPEED_INFORMATION": "has_speed_information_issue",
        "TYRE_INFORMATION": "has_tyre_information_issue",
        "WEATHER_INFORMATION": "has_weather_information_issue",
        "TRACK_STATUS_INFORMATION": "has_track_status_information_issue",
        "PIT_INFORMATION": "has_pit_information_issue",
    },
    "result": {
        "QUALIFYING_INFORMATION": "has_qualifying_information_issue",
        "RACE_CONTEXT_INFORMATION": "has_race_context_information_issue",
    },
}
DROP_AREA = {"lap": "LAP_TIME_INFORMATION", "result": "CLASSIFICATION_INFORMATION"}
INFORMATION_AREAS = (
    "CLASSIFICATION_INFORMATION", "LAP_TIME_INFORMATION", "NONE", "PIT_INFORMATION", "QUALIFYING_INFORMATION",
    "RACE_CONTEXT_INFORMATION", "SECTOR_INFORMATION", "SPEED_INFORMATION", "TRACK_STATUS_INFORMATION",
    "TYRE_INFORMATION", "WEATHER_INFORMATION",
)
SECTOR_METRICS = ("sector1_time_ms", "sector2_time_ms", "sector3_time_ms")
SPEED_METRICS = ("speed_i1", "speed_i2", "speed_fl", "speed_st")
OUTLIER_METRICS = ("lap_time_ms", *SECTOR_METRICS, *SPEED_METRICS)

# Fixed values.
QUALITY_DIMENSIONS = (
    "Completeness", "Uniqueness", "Validity", "Consistency", "Accuracy/Plausibility", "Timeliness",
    "Referential Integrity",
)
