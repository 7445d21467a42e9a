"""The quality assessment in plain SQL, one SELECT per check and table.

Only names and texts come from the library; every predicate is written out here.
"""

from __future__ import annotations

import re

from contract.views import VIEWS, sql_views
from starq.plans.rules import RULES

TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def trim(c: str) -> str:
    return TRIM.format(c)


def outside(c: str, low=None, high=None) -> str:
    tests = ([f"{c} < {low}"] if low is not None else []) + ([f"{c} > {high}"] if high is not None else [])
    return " OR ".join(tests)


def not_in(c: str, *values: str) -> str:
    return f"{trim(c)} NOT IN ({', '.join(repr(v) for v in values)})"


_CIRCUIT = ("Street", "PowerSensitive", "AeroSensitive", "Mixed")
_SECTOR = ("Power", "FastCorners", "SlowCorners", "Technical")
_TYRES = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")
_MESSAGES = ("AllClear", "Yellow", "SCDeployed", "Red", "VSCDeployed", "VSCEnding")
_CODES = "{1: 'AllClear', 2: 'Yellow', 4: 'SCDeployed', 5: 'Red', 6: 'VSCDeployed', 7: 'VSCEnding'}"
EXPECTED_MESSAGE = "CASE status WHEN '1' THEN 'AllClear' WHEN '2' THEN 'Yellow' WHEN '4' THEN 'SCDeployed' WHEN '5' THEN 'Red' WHEN '6' THEN 'VSCDeployed' WHEN '7' THEN 'VSCEnding' END"



def bases(prefix: str) -> dict[str, str]:
    """table -> rows the checks read"""
    out = {t: f"{prefix}{t}" for t in VIEWS}
    out["session"] = f"(SELECT s.*, g.event_date FROM {prefix}session s LEFT JOIN {prefix}grand_prix g USING (grand_prix_id))"
    return out


# table -> [(dimension, check id, applicable, failing among the applicable)]
ROW_CHECKS = {
    "season": [
        ("Validity", "season_year_formula1_domain", "season_year IS NOT NULL", "season_year < 1950"),
        ("Validity", "number_of_events_positive", "number_of_events IS NOT NULL", "number_of_events < 1"),
        ("Consistency", "season_dates_order", "season_start_date IS NOT NULL AND season_end_date IS NOT NULL",
         "season_start_date > season_end_date"),
        ("Consistency", "season_dates_match_year",
         "season_year IS NOT NULL AND (season_start_date IS NOT NULL OR season_end_date IS NOT NULL)",
         "year(season_start_date) <> season_year OR year(season_end_date) <> season_year"),
    ],
    "team": [("Validity", "team_url_format", "team_url IS NOT NULL", f"NOT regexp_matches({trim('team_url')}, '^https?://')")],
    "grand_prix": [
        ("Validity", "round_number_positive", "round_number IS NOT NULL", "round_number < 1"),
        ("Validity", "event_format_domain", "event_format IS NOT NULL", not_in("event_format", "conventional", "sprint")),
        ("Consistency", "grand_prix_event_date_matches_season_year", "season_year IS NOT NULL AND event_date IS NOT NULL",
         "year(event_date) <> season_year"),
    ],
    "session": [
        ("Validity", "session_type_domain", "session_type IS NOT NULL", not_in("session_type", "Q", "R")),
        ("Consistency", "session_date_near_grand_prix_date", "session_date IS NOT NULL AND event_date IS NOT NULL",
         "date_diff('day', event_date, session_date) NOT BETWEEN -2 AND 0"),
    ],
    "result": [
        ("Validity", "result_position_positive", "position IS NOT NULL", "position < 1"),
        ("Validity", "result_points_non_negative", "points IS NOT NULL", "points < 0"),
        ("Validity", "result_laps_non_negative", "laps IS NOT NULL", "laps < 0"),
        ("Validity", "result_grid_position_non_negative", "grid_position IS NOT NULL", "grid_position < 0"),
    ],
    "lap": [
        ("Validity", "lap_number_positive", "lap_number IS NOT NULL", "lap_number < 1"),
        ("Validity", "lap_time_positive", "lap_time_ms IS NOT NULL", "lap_time_ms < 1"),
        ("Validity", "lap_sector_times_positive",
         "sector1_time_ms IS NOT NULL OR sector2_time_ms IS NOT NULL OR sector3_time_ms IS NOT NULL",
         "sector1_time_ms < 1 OR sector2_time_ms < 1 OR sector3_time_ms < 1"),
        ("Validity", "lap_speeds_positive",
         "speed_i1 IS NOT NULL OR speed_i2 IS NOT NULL OR speed_fl IS NOT NULL OR speed_st IS NOT NULL",
         "speed_i1 < 1 OR speed_i2 < 1 OR speed_fl < 1 OR speed_st < 1"),
        ("Validity", "tyre_life_positive", "tyre_life IS NOT NULL", "tyre_life < 1"),
        ("Validity", "compound_domain", "compound IS NOT NULL", not_in("compound", *_TYRES)),
        ("Consistency", "lap_sector_sum_matches_lap_time",
         "lap_time_ms IS NOT NULL AND sector1_time_ms IS NOT NULL AND sector2_time_ms IS NOT NULL AND sector3_time_ms IS NOT NULL"
         " AND pit_in_time_ms IS NULL AND pit_out_time_ms IS NULL",
         "abs(sector1_time_ms + sector2_time_ms + sector3_time_ms - lap_time_ms) > 1000"),
    ],
    "weather": [
        ("Validity", "weather_time_non_negative", "time_ms IS NOT NULL", "time_ms < 0"),
        ("Validity", "air_temp_broad_domain_range", "air_temp IS NOT NULL", outside("air_temp", -5, 50)),
        ("Validity", "track_temp_broad_domain_range", "track_temp IS NOT NULL", outside("track_temp", -5, 80)),
        ("Validity", "wind_speed_non_negative", "wind_speed IS NOT NULL", "wind_speed < 0"),
        ("Consistency", "weather_track_air_temp_difference", "track_temp IS NOT NULL AND air_temp IS NOT NULL",
         "abs(track_temp - air_temp) > 50"),
    ],
    "track_status": [
        ("Validity", "track_status_time_non_negative", "time_ms IS NOT NULL", "time_ms < 0"),
        ("Validity", "track_status_code_domain", "status IS NOT NULL", not_in("status", "1", "2", "4", "5", "6", "7")),
        ("Validity", "track_status_message_domain", "message IS NOT NULL", not_in("message", *_MESSAGES)),
        ("Consistency", "track_status_message_mapping", "status IS NOT NULL AND message IS NOT NULL",
         f"message IS DISTINCT FROM ({EXPECTED_MESSAGE})"),
    ],
    "circuit": [
        ("Validity", "global_circuit_category_domain", "global_circuit_category IS NOT NULL",
         not_in("global_circuit_category", *_CIRCUIT)),
        *[("Validity", f"sector{i}_category_domain", f"sector{i}_category IS NOT NULL", not_in(f"sector{i}_category", *_SECTOR))
          for i in (1, 2, 3)],
    ],
    "driver": [
        ("Validity", "driver_abbreviation_format", "abbreviation IS NOT NULL", "NOT regexp_matches(abbreviation, '^[A-Z]{3}$')"),
        ("Validity", "driver_url_format", "driver_url IS NOT NULL", "NOT regexp_matches(driver_url, '^https?://')"),
        ("Validity", "permanent_number_range", "permanent_number IS NOT NULL", outside("permanent_number", 1, 99)),
        ("Accuracy", "driver_age_plausible_2021_2022", "date_of_birth IS NOT NULL",
         "2021 - year(date_of_birth) < 15 OR 2022 - year(date_of_birth) > 60"),
    ],
}
# The derived tables lack these columns.
ABSENT = {"lap": ["stint"], "weather": ["humidity", "pressure", "wind_direction"]}
ABSENT_CHECK = {"stint": "stint_positive", "humidity": "humidity_range", "pressure": "pressure_range",
                "wind_direction": "wind_direction_range"}
KEYS = {
    "season": "season_year", "circuit": "circuit_id", "driver": "driver_id", "team": "team_id", "grand_prix": "grand_prix_id",
    "session": "session_id", "result": "result_id", "lap": "lap_id", "weather": "weather_id", "track_status": "track_status_id",
}
NATURAL = {
    "grand_prix": ["season_year", "round_number"], "session": ["grand_prix_id", "session_type"],
    "result": ["session_id", "driver_id"], "lap": ["session_id", "driver_id", "lap_number"],
    "weather": ["session_id", "time_ms"], "track_status": ["session_id", "time_ms"],
}
REFERENCES = {
    "grand_prix": [("season_year", "season"), ("circuit_id", "circuit")], "session": [("grand_prix_id", "grand_prix")],
    "result": [("session_id", "session"), ("driver_id", "driver"), ("team_id", "team")],
    "lap": [("session_id", "session"), ("driver_id", "driver"), ("team_id", "team")],
    "weather": [("session_id", "session")], "track_status": [("session_id", "session")],
}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _descriptions(table: str) -> dict[str, str]:
    r = RULES[table]
    return {c.check_id: c.description for c in (*r.required, *r.validity, *r.consistency, *r.plausibility)}


def _required(table: str):
    return [(g.check_id, list(g.columns)) for g in RULES[table].required]


def rid(table: str) -> str:
    return f"'{KEYS[table]}=' || CAST({KEYS[table]} AS VARCHAR)"


def fk_id(table: str, column: str, parent: str) -> str:
    return f"fk_{table}_{column}_to_{parent}_{KEYS[parent]}"


def _count(table, dimension, check_id, description, total, failed, source) -> str:
    return (f"SELECT {_text(table)} AS table_name, {_text(dimension)} AS dimension, {_text(check_id)} AS check_id, "
            f"{_text(description)} AS check_description, CAST({failed} AS BIGINT) AS failed_count, "
            f"CAST({total} AS BIGINT) AS total_count FROM {source}")


def _issue(table, dimension, check_id, code, text, source, where) -> str:
    return (f"SELECT {_text(table)} AS table_name, {rid(table)} AS row_identifier, {_text(dimension)} AS dimension, "
            f"{_text(check_id)} AS check_id, {_text(code)} AS issue_code, {text} AS issue_description FROM {source} WHERE {where}")


def _complete(columns) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def counts_sql(tables=VIEWS, prefix: str = "v_") -> str:
    out, base = [], bases(prefix)
    for t in tables:
        texts = _descriptions(t)
        for check_id, columns in _required(t):
            cells = f"count(*) * {len(columns)}"
            out.append(_count(t, "Completeness", check_id, texts[check_id], cells,
                              f"{cells} - " + " - ".join(f"count({c})" for c in columns), base[t]))
        for n, columns in enumerate([[KEYS[t]], *([NATURAL[t]] if t in NATURAL else [])]):
            name = f"natural_key_{n}_unique" if n else "primary_key_unique"
            text = f"Natural key {columns} should be unique among complete key values." if n else \
                f"Primary key {columns} must be unique among complete key values."
            source = f"(SELECT count(*) AS n FROM {base[t]} WHERE {_complete(columns)} GROUP BY {', '.join(columns)})"
            out.append(_count(t, "Uniqueness", name, text, "coalesce(sum(n), 0)", "coalesce(sum(n) FILTER (WHERE n > 1), 0)", source))
        for dimension, check_id, applicable, failing in ROW_CHECKS[t]:
            out.append(_count(t, dimension, check_id, texts[check_id], f"count(*) FILTER (WHERE {applicable})",
                              f"count(*) FILTER (WHERE ({applicable}) AND ({failing}))", base[t]))
        for column in ABSENT.get(t, []):
            out.append(_count(t, "Validity", ABSENT_CHECK[column], texts[ABSENT_CHECK[column]], 1, 1, "(SELECT 1)"))
        for column, parent in REFERENCES.get(t, []):
            text = f"{t}.{column} must reference {parent}.{KEYS[parent]}."
            out.append(_count(t, "Referential Integrity", fk_id(t, column, parent), text, f"count({column})",
                              f"count(*) FILTER (WHERE {column} IS NOT NULL AND p.k IS NULL)",
                              f"{base[t]} c LEFT JOIN (SELECT DISTINCT {KEYS[parent]} AS k FROM {prefix}{parent}) p ON p.k = c.{column}"))
    return "\nUNION ALL ".join(out)


def issues_sql(tables=VIEWS, prefix: str = "v_") -> str:
    """Issues without their severity."""
    out, base = [], bases(prefix)
    for t in tables:
        texts = _descriptions(t)
        for check_id, columns in _required(t):
            listed = ", ".join(f"CASE WHEN {c} IS NULL THEN '''{c}''' END" for c in columns)
            text = f"'Missing required values in columns: [' || concat_ws(', ', {listed}) || ']'"
            out.append(_issue(t, "Completeness", check_id, "MISSING_REQUIRED_VALUE", text, base[t], f"NOT ({_complete(columns)})"))
        for n, columns in enumerate([[KEYS[t]], *([NATURAL[t]] if t in NATURAL else [])]):
            name = f"natural_key_{n}_unique" if n else "primary_key_unique"
            text = _text(f"Key {columns} is duplicated among complete key values.")
            source = f"(SELECT *, count(*) OVER (PARTITION BY {', '.join(columns)}) AS n_copies FROM {base[t]} WHERE {_complete(columns)})"
            out.append(_issue(t, "Uniqueness", name, "DUPLICATED_KEY", text, source, "n_copies > 1"))
        for dimension, check_id, applicable, failing in ROW_CHECKS[t]:
            code = "INVALID_VALUE" if dimension == "Validity" else check_id.upper()
            out.append(_issue(t, dimension, check_id, code, _text(texts[check_id]), base[t], f"({applicable}) AND ({failing})"))
        for column in ABSENT.get(t, []):
            out.append(f"SELECT {_text(t)}, '__table__', 'Validity', {_text(ABSENT_CHECK[column])}, 'MISSING_VALIDITY_COLUMN', "
                       f"{_text(f'Missing columns for validity check: {[column]}')}")
        for column, parent in REFERENCES.get(t, []):
            text = f"'{column}=' || CAST({column} AS VARCHAR) || ' does not exist in {parent}.{KEYS[parent]}.'"
            out.append(_issue(t, "Referential Integrity", fk_id(t, column, parent), "BROKEN_FOREIGN_KEY", text, base[t],
                              f"{column} IS NOT NULL AND {column} NOT IN (SELECT {KEYS[parent]} FROM {prefix}{parent})"))
    return "\nUNION ALL ".join(out)


SCORED = """
SELECT *, total_count - failed_count AS passed_count,
       CASE WHEN total_count > 0 THEN round(CAST(total_count - failed_count AS DOUBLE) / total_count, 6) END AS score FROM {0}"""
STATUS = "CASE WHEN {0} IS NULL THEN 'not_applicable' WHEN {0} >= 0.95 THEN 'green' WHEN {0} >= 0.80 THEN 'yellow' ELSE 'red' END"


def with_quality(body: str, tables=VIEWS, views=VIEWS) -> str:
    """Definitions `checks` and `issues` of the given tables, then the query."""
    return f"""WITH {sql_views(*views)},
counts AS MATERIALIZED ({counts_sql(tables)}),
check_scores AS ({SCORED.format('counts')}),
checks AS (SELECT table_name, dimension, check_id, check_description, passed_count, failed_count, total_count, score,
                  {STATUS.format('score')} AS status FROM check_scores),
found AS MATERIALIZED ({issues_sql(tables)}),
issues AS (SELECT f.*, CASE WHEN issue_code IN ('DUPLICATED_KEY', 'BROKEN_FOREIGN_KEY') OR row_identifier = '__table__'
                            OR c.score < 0.80 THEN 'red' ELSE 'yellow' END AS severity
           FROM found f LEFT JOIN checks c USING (table_name, check_id)){body}"""


_DIMENSIONS = {
    "completeness_score": "Completeness", "uniqueness_score": "Uniqueness", "validity_score": "Validity",
    "consistency_score": "Consistency", "accuracy_plausibility_score": "Accuracy/Plausibility",
    "timeliness_score": "Timeliness", "referential_integrity_score": "Referential Integrity",
}


def scorecard_sql() -> str:
    """Definition `scorecard` on top of `checks` and `issues`."""
    means = ", ".join(f"avg(score) FILTER (WHERE dimension = '{d}') AS {c}" for c, d in _DIMENSIONS.items())
    total = " + ".join(f"coalesce({c}, 0)" for c in _DIMENSIONS)
    present = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in _DIMENSIONS)
    return f"""
means AS (SELECT table_name, {means} FROM checks WHERE score IS NOT NULL GROUP BY 1),
scorecard AS (SELECT m.table_name, round(({total}) / nullif({present}, 0), 6) AS overall_score,
    {STATUS.format(f'round(({total}) / nullif({present}, 0), 6)')} AS status, coalesce(n, 0) AS issue_count, {', '.join(_DIMENSIONS)}
    FROM means m LEFT JOIN (SELECT table_name, count(*) AS n FROM issues GROUP BY 1) i USING (table_name))"""


SCORE_COLUMNS = tuple(_DIMENSIONS)


def cleaned_quality() -> str:
    """Definition `after_scorecard`: the same assessment of the cleaned tables `c_<table>`."""
    card = scorecard_sql()
    for name in ("means", "scorecard", "checks", "issues"):
        card = re.sub(rf"\b{name}\b", f"after_{name}", card)
    return f"""
after_counts AS MATERIALIZED ({counts_sql(prefix="c_")}),
after_checks AS ({SCORED.format("after_counts")}),
after_issues AS MATERIALIZED ({issues_sql(prefix="c_")}),{card}"""
