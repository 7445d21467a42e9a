"""The declarative rule catalogue: what each table has to satisfy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from starq import schemas as s


@dataclass(frozen=True)
class Check:
    """One row-level rule.

    kind: domain | range | url | regex | custom. `columns` are the columns a
    validity rule tests, `options` its limits, allowed values or pattern.
    """

    check_id: str
    kind: str
    columns: tuple[str, ...]
    description: str
    options: Mapping = field(default_factory=dict)


@dataclass(frozen=True)
class Required:
    check_id: str
    columns: tuple[str, ...]
    description: str


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableRules:
    primary_key: tuple[str, ...]
    natural_keys: tuple[tuple[str, ...], ...] = ()
    required: tuple[Required, ...] = ()
    validity: tuple[Check, ...] = ()
    consistency: tuple[Check, ...] = ()
    plausibility: tuple[Check, ...] = ()
    references: tuple[Reference, ...] = ()


def _range(check_id: str, columns: str | tuple[str, ...], description: str, low=None, high=None) -> Check:
    limits = {k: v for k, v in (("min", low), ("max", high)) if v is not None}
    return Check(check_id, "range", (columns,) if isinstance(columns, str) else columns, description, limits)


def _domain(check_id: str, column: str, description: str, allowed: Sequence) -> Check:
    return Check(check_id, "domain", (column,), description, {"allowed": tuple(str(a) for a in allowed)})


def _custom(check_id: str, function: str, description: str, **options) -> Check:
    return Check(check_id, "custom", (), description, {"function": function, **options})


def _references(table: str) -> tuple[Reference, ...]:
    return tuple(Reference(*fk) for fk in s.FOREIGN_KEYS.get(table, ()))


def _natural(table: str) -> tuple[tuple[str, ...], ...]:
    return (s.NATURAL_KEYS[table],) if table in s.NATURAL_KEYS else ()


# Check ids, descriptions, limits and columns of the 79 checks
# (primary keys, natural keys and references come from the schema).
RULES: dict[str, TableRules] = {
    "season": TableRules(
        ("season_year",),
        required=(
            Required("season_required_structural_columns", ("season_year",),
                     "season_year must be present because it is the structural identifier of the season."),
        ),
        validity=(
            _range("season_year_formula1_domain", "season_year",
                   "season_year must be compatible with the Formula 1 historical domain, starting from 1950.", 1950),
            _range("number_of_events_positive", "number_of_events",
                   "number_of_events must be greater than zero when present.", 1),
        ),
        consistency=(
            _custom("season_dates_order", "dates_in_order",
                    "season_start_date must be before season_end_date when both are present.",
                    start="season_start_date", end="season_end_date"),
            _custom("season_dates_match_year", "dates_in_year",
                    "The year component of season dates must be coherent with season_year.",
                    year="season_year", dates=("season_start_date", "season_end_date")),
        ),
    ),
    "team": TableRules(
        ("team_id",),
        required=(
            Required("team_required_identification_columns", ("team_id", "team_name"),
                     "team_id and team_name must be present."),
        ),
        validity=(Check("team_url_format", "url", ("team_url",), "team_url must have a valid URL format when present."),),
    ),
    "grand_prix": TableRules(
        ("grand_prix_id",),
        natural_keys=_natural("grand_prix"),
        required=(
            Required("grand_prix_required_structural_columns",
                     ("grand_prix_id", "season_year", "round_number", "event_name", "event_format", "circuit_id"),
                     "grand_prix_id, season_year, round_number, event_name, event_format, and circuit_id must be present."),
        ),
        validity=(
            _range("round_number_positive", "round_number", "round_number must be greater than zero.", 1),
            _domain("event_format_domain", "event_format",
                    "event_format must belong to the allowed Grand Prix event format domain.", s.EVENT_FORMATS),
        ),
        consistency=(
            _custom("grand_prix_event_date_matches_season_year", "dates_in_year",
                    "event_date must be coherent with season_year when present.",
                    year="season_year", dates=("event_date",)),
        ),
        references=_references("grand_prix"),
    ),
    "session": TableRules(
        ("session_id",),
        natural_keys=_natural("session"),
        required=(
            Required("session_required_structural_columns", ("session_id", "grand_prix_id", "session_type"),
                     "session_id, grand_prix_id, and session_type must be present."),
        ),
        validity=(
            _domain("session_type_domain", "session_type",
                    "session_type must belong to the allowed session domain for this project: Q or R.",
                    s.SESSION_TYPES),
        ),
        consistency=(
            _custom("session_date_near_grand_prix_date", "date_near_parent",
                    "session_date should be coherent with the corresponding Grand Prix event_date. For Q and R sessions, "
                    "it should normally fall between event_date minus two days and event_date.",
                    date="session_date", key="grand_prix_id", parent="grand_prix", parent_date="event_date",
                    days_before=2),
        ),
        references=_references("session"),
    ),
    "result": TableRules(
        ("result_id",),
        natural_keys=_natural("result"),
        required=(
            Required("result_required_structural_columns", ("result_id", "session_id", "driver_id", "team_id"),
                     "result_id, session_id, driver_id, and team_id must be present."),
        ),
        validity=(
            _range("result_position_positive", "position", "position must be greater than zero when present.", 1),
            _range("result_points_non_negative", "points",
                   "points must be greater than or equal to zero when present.", 0),
            _range("result_laps_non_negative", "laps", "laps must be greater than or equal to zero when present.", 0),
            _range("result_grid_position_non_negative", "grid_position",
                   "grid_position must be greater than or equal to zero when present.", 0),
        ),
        references=_references("result"),
    ),
    "lap": TableRules(
        ("lap_id",),
        natural_keys=_natural("lap"),
        required=(
            Required("lap_required_structural_columns",
                     ("lap_id", "session_id", "driver_id", "team_id", "lap_number", "time_ms"),
                     "Structural lap identifiers and timeline attribute must be present."),
        ),
        validity=(
            _range("lap_number_positive", "lap_number", "lap_number must be greater than zero.", 1),
            _range("lap_time_positive", "lap_time_ms", "lap_time_ms must be positive when present.", 1),
            _range("lap_sector_times_positive", ("sector1_time_ms", "sector2_time_ms", "sector3_time_ms"),
                   "Sector times must be positive when present.", 1),
            _range("lap_speeds_positive", ("speed_i1", "speed_i2", "speed_fl", "speed_st"),
                   "Speed attributes must be positive when present.", 1),
            _range("stint_positive", "stint", "stint must be positive when present.", 1),
            _range("tyre_life_positive", "tyre_life", "tyre_life must be positive when present.", 1),
            _domain("compound_domain", "compound",
                    "compound must belong to the expected tyre compound domain when present.", s.TYRE_COMPOUNDS),
        ),
        consistency=(
            _custom("lap_sector_sum_matches_lap_time", "parts_sum_to_total",
                    "For timed laps with complete sector information, the sum of sector times should be coherent with lap_time_ms.",
                    total="lap_time_ms", parts=s.SECTOR_METRICS, unless=("pit_out_time_ms", "pit_in_time_ms"),
                    tolerance=1000),
        ),
        references=_references("lap"),
    ),
    "weather": TableRules(
        ("weather_id",),
        natural_keys=_natural("weather"),
        required=(
            Required("weather_required_columns",
                     ("weather_id", "session_id", "time_ms", "air_temp", "track_temp", "rainfall", "wind_speed"),
                     "Weather identifier, session timeline, and main weather measures must be present."),
        ),
        validity=(
            _range("weather_time_non_negative", "time_ms", "time_ms must be greater than or equal to zero.", 0),
            _range("air_temp_broad_domain_range", "air_temp",
                   "air_temp must be within a broad Formula 1 weather domain range when present.", -5, 50),
            _range("track_temp_broad_domain_range", "track_temp",
                   "track_temp must be within a broad Formula 1 track temperature domain range when present.", -5, 80),
            _range("humidity_range", "humidity", "humidity must be between 0 and 100 when present.", 0, 100),
            _range("pressure_range", "pressure",
                   "pressure must be within a broad realistic atmospheric range when present.", 650, 1100),
            _range("wind_direction_range", "wind_direction",
                   "wind_direction must be a degree value between 0 and 360 when present.", 0, 360),
            _range("wind_speed_non_negative", "wind_speed",
                   "wind_speed must be greater than or equal to zero when present.", 0),
        ),
        consistency=(
            _custom("weather_track_air_temp_difference", "difference_at_most",
                    "track_temp should be reasonably coherent with air_temp.",
                    left="track_temp", right="air_temp", limit=50),
        ),
        references=_references("weather"),
    ),
    "track_status": TableRules(
        ("track_status_id",),
        natural_keys=_natural("track_status"),
        required=(
            Required("track_status_required_columns", ("track_status_id", "session_id", "time_ms", "status", "message"),
                     "Track status identifier, session timeline, status, and message must be present."),
        ),
        validity=(
            _range("track_status_time_non_negative", "time_ms", "time_ms must be greater than or equal to zero.", 0),
            _domain("track_status_code_domain", "status",
                    "status must belong to the documented track status code domain.", s.TRACK_STATUS_MESSAGES),
            _domain("track_status_message_domain", "message",
                    "message must belong to the documented track status message domain.",
                    s.TRACK_STATUS_MESSAGES.values()),
        ),
        consistency=(
            _custom("track_status_message_mapping", "code_matches_text",
                    "The numerical status code must correspond to the expected textual message.",
                    code="status", text="message", mapping=s.TRACK_STATUS_MESSAGES),
        ),
        references=_references("track_status"),
    ),
    "circuit": TableRules(
        ("circuit_id",),
        required=(
            Required("circuit_required_analytical_columns",
                     ("circuit_id", "global_circuit_category", "sector1_category", "sector2_category", "sector3_category"),
                     "Circuit identifier and analytical classification columns must be present."),
        ),
        validity=(
            _domain("global_circuit_category_domain", "global_circuit_category",
                    "global_circuit_category must belong to the allowed global circuit category domain.",
                    s.CIRCUIT_CATEGORIES),
            *[
                _domain(f"sector{i}_category_domain", f"sector{i}_category",
                        f"sector{i}_category must belong to the allowed sector category domain.", s.SECTOR_CATEGORIES)
                for i in (1, 2, 3)
            ],
        ),
    ),
    "driver": TableRules(
        ("driver_id",),
        required=(
            Required("driver_required_identification_columns", ("driver_id", "abbreviation", "last_name"),
                     "driver_id, abbreviation, and last_name must be present."),
        ),
        validity=(
            Check("driver_abbreviation_format", "regex", ("abbreviation",),
                  "abbreviation must be a three-letter uppercase driver code.", {"pattern": "^[A-Z]{3}$"}),
            Check("driver_url_format", "url", ("driver_url",), "driver_url must have a valid URL format when present."),
            _range("permanent_number_range", "permanent_number",
                   "permanent_number must be between 1 and 99 when present.", 1, 99),
        ),
        plausibility=(
            _custom("driver_age_plausible_2021_2022", "age_between",
                    "Driver age during the selected 2021--2022 seasons should be within a broad plausible Formula 1 range.",
                    born="date_of_birth", first_year=2021, last_year=2022, youngest=15, oldest=60),
        ),
    ),
}

# Documented but switched off: a later qualifying segment needs the earlier one.
QUALIFYING_PROGRESSION = _custom(
    "result_qualifying_progression_consistency", "segments_in_order",
    "A later qualifying segment requires the earlier ones.", segments=("q1_ms", "q2_ms", "q3_ms"),
)
