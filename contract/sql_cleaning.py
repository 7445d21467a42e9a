"""Cleaning in plain SQL: candidates per source, the first one per value, flag and row wins."""

from __future__ import annotations

from contract.sql_missing import METRICS, missing_definitions, outlier_definitions
from contract.sql_quality import EXPECTED_MESSAGE, KEYS, NATURAL, REFERENCES, ROW_CHECKS, fk_id, rid, trim, with_quality
from contract.views import VIEWS
from starq.plans.rules import RULES

COLUMNS = (
    "source", "table_name", "row_identifier", "target_column", "quality_flag_column", "check_id", "issue_code",
    "missing_class", "information_area", "outlier_metric", "outlier_consensus_score", "cleaning_action", "old_value",
    "new_value", "reason",
)
TEXT_COLUMNS = {
    "season": ["champion_driver", "champion_team"],
    "circuit": ["circuit_id", "circuit_name", "country", "location", "seasons_present", "global_circuit_category",
                "sector1_category", "sector2_category", "sector3_category"],
    "driver": ["driver_id", "abbreviation", "first_name", "last_name", "nationality", "driver_url"],
    "team": ["team_id", "team_name", "nationality", "team_url"],
    "grand_prix": ["event_name", "official_event_name", "country", "location", "event_format", "circuit_id"],
    "session": ["session_type", "session_name"],
    "result": ["driver_id", "team_id", "classified_position", "status"],
    "lap": ["driver_id", "team_id", "compound", "fresh_tyre", "track_status"],
    "weather": [],
    "track_status": ["status", "message"],
}
FLAGS = {
    "lap": ["SECTOR", "SPEED", "TYRE", "WEATHER", "TRACK_STATUS", "PIT"], "result": ["QUALIFYING", "RACE_CONTEXT"],
}
DOMAINS = {
    ("circuit", "global_circuit_category"): ("Street", "PowerSensitive", "AeroSensitive", "Mixed"),
    **{("circuit", f"sector{i}_category"): ("Power", "FastCorners", "SlowCorners", "Technical") for i in (1, 2, 3)},
    ("grand_prix", "event_format"): ("conventional", "sprint"),
    ("session", "session_type"): ("Q", "R"),
    ("lap", "compound"): ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET"),
}
DROP_REASON = "The DQA issue makes the row structurally unusable or unreliable for the cleaned schema."
# (table, check, columns, area, reason, extra condition with {c})
NULLS = [
    ("season", "number_of_events_positive", ["number_of_events"], None, "Invalid descriptive season value set to NULL.", ""),
    ("season", "season_dates_order", ["season_start_date", "season_end_date"], None, "Inconsistent season dates set to NULL.", ""),
    ("season", "season_dates_match_year", ["season_start_date", "season_end_date"], None, "Inconsistent season dates set to NULL.", ""),
    ("driver", "driver_abbreviation_format", ["abbreviation"], None, "Invalid driver abbreviation set to NULL.", ""),
    ("driver", "driver_url_format", ["driver_url"], None, "Invalid driver URL set to NULL.", ""),
    ("driver", "permanent_number_range", ["permanent_number"], None, "Invalid permanent number set to NULL.", ""),
    ("driver", "driver_age_plausible_2021_2022", ["date_of_birth"], None, "Implausible date of birth set to NULL.", ""),
    ("team", "team_url_format", ["team_url"], None, "Invalid team URL set to NULL.", ""),
    ("grand_prix", "grand_prix_event_date_matches_season_year", ["event_date"], None,
     "Grand Prix event date inconsistent with season year set to NULL.", ""),
    ("session", "session_date_near_grand_prix_date", ["session_date"], None,
     "Session date inconsistent with Grand Prix date set to NULL.", ""),
    ("result", "result_points_non_negative", ["points"], "RACE_CONTEXT", "Invalid points value set to NULL.", ""),
    ("result", "result_laps_non_negative", ["laps"], "RACE_CONTEXT", "Invalid completed-laps value set to NULL.", ""),
    ("result", "result_grid_position_non_negative", ["grid_position"], "RACE_CONTEXT", "Invalid grid position set to NULL.", ""),
    ("lap", "lap_sector_times_positive", ["sector1_time_ms", "sector2_time_ms", "sector3_time_ms"], "SECTOR",
     "Invalid sector time set to NULL.", " AND {c} < 1"),
    ("lap", "lap_speeds_positive", ["speed_i1", "speed_i2", "speed_fl", "speed_st"], "SPEED",
     "Invalid speed value set to NULL.", " AND {c} < 1"),
    ("lap", "tyre_life_positive", ["tyre_life"], "TYRE", "Invalid tyre life value set to NULL.", ""),
    ("lap", "compound_domain", ["compound"], "TYRE",
     "Unknown compound value was set to NULL because it cannot be mapped deterministically.", " AND {canonical} IS NULL"),
    ("weather", "air_temp_broad_domain_range", ["air_temp"], None, "Invalid air temperature set to NULL.", ""),
    ("weather", "track_temp_broad_domain_range", ["track_temp"], None, "Invalid track temperature set to NULL.", ""),
    ("weather", "wind_speed_non_negative", ["wind_speed"], None, "Invalid wind speed set to NULL.", ""),
    ("weather", "weather_track_air_temp_difference", ["track_temp"], None,
     "Implausible track-air temperature relation: track temperature set to NULL.", ""),
    *[("track_status", check, ["message"], None,
       "Unknown track status message set to NULL because the status code could not reconstruct it.",
       f" AND ({EXPECTED_MESSAGE}) IS NULL") for check in ("track_status_message_domain", "track_status_message_mapping")],
]


def _q(text) -> str:
    return "NULL" if text is None else "'" + str(text).replace("'", "''") + "'"


def canonical(table: str, column: str) -> str:
    letters = f"regexp_replace(lower({column}), '[^a-z0-9]', '', 'g')"
    cases = " ".join(f"WHEN '{v.lower()}' THEN '{v}'" for v in DOMAINS[table, column])
    return f"(CASE {letters} {cases} END)"


def _old(table: str, column: str) -> str:
    if column in TEXT_COLUMNS[table]:
        return trim(column)
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S')" if "date" in column else f"CAST({column} AS VARCHAR)"


def order_of(table: str) -> list[str]:
    ids = [g.check_id for g in RULES[table].required] + ["primary_key_unique"]
    ids += ["natural_key_1_unique"] if table in NATURAL else []
    ids += [c[1] for c in ROW_CHECKS[table]]
    return ids + [fk_id(table, c, p) for c, p in REFERENCES.get(table, [])]


def _flag_column(area: str) -> str:
    return f"has_{area.lower()}_information_issue"


def _row(**fields) -> str:
    """A select list of all action columns; values are SQL."""
    return ", ".join(f"{fields.get(c, 'NULL')} AS {c}" for c in COLUMNS)


def definitions() -> str:
    order = ", ".join(f"('{t}', '{c}', {i})" for t in VIEWS for i, c in enumerate(order_of(t)))
    text, nulls, standard = [], [], []
    for t, columns in TEXT_COLUMNS.items():
        for c in columns:
            clean = trim(c)
            base = dict(source="'general_cleaning'", table_name=_q(t), row_identifier=rid(t), target_column=_q(c))
            text.append("SELECT " + _row(
                **base, check_id="'CR_COMMON_1'", issue_code="'LEADING_OR_TRAILING_SPACES'", cleaning_action="'STANDARDIZE'", old_value=c,
                new_value=clean, reason="'Trimmed leading or trailing spaces from a textual value.'") + f" FROM v_{t} WHERE {clean} <> {c}")
            text.append("SELECT " + _row(
                **base, check_id="'CR_COMMON_2'", issue_code="'EMPTY_STRING'", cleaning_action="'SET_NULL'", old_value="''",
                reason="'Converted an empty textual value into NULL.'") + f" FROM v_{t} WHERE {clean} = ''")
    for t, check, columns, area, reason, extra in NULLS:
        for i, c in enumerate(columns):
            more = extra.format(c=c, canonical=canonical(t, c) if (t, c) in DOMAINS else "")
            nulls.append(
                f"SELECT i.table_name, i.row_identifier, i.check_id, i.issue_code, i.ord + {i} / 100.0 AS ord, '{c}' AS target_column, "
                f"{_old(t, c)} AS old_value, {_q(area)} AS area, {_q(reason)} AS reason FROM v_{t} t JOIN marks i "
                f"ON i.table_name = '{t}' AND i.check_id = '{check}' AND i.row_identifier = {rid(t)} WHERE {c} IS NOT NULL{more}")
    for (t, c) in DOMAINS:
        name = canonical(t, c)
        standard.append(
            f"SELECT i.table_name, i.row_identifier, i.check_id, i.issue_code, i.ord, '{c}' AS target_column, {trim(c)} AS old_value, {name} AS new_value, "
            f"'Standardized {c} to a known domain value.' AS reason FROM v_{t} t JOIN marks i ON i.table_name = '{t}' AND "
            f"i.check_id = '{c}_domain' AND i.row_identifier = {rid(t)} WHERE {name} <> {trim(c)}")
    standard.append(
        f"SELECT i.table_name, i.row_identifier, i.check_id, i.issue_code, i.ord, 'message', message, ({EXPECTED_MESSAGE}), "
        f"'Track status message reconstructed from the numerical status code.' FROM v_track_status t JOIN marks i ON i.table_name = 'track_status' "
        f"AND i.check_id IN ('track_status_message_domain', 'track_status_message_mapping') AND i.row_identifier = {rid('track_status')} "
        f"WHERE ({EXPECTED_MESSAGE}) <> message")
    unknown = " UNION ALL ".join(
        f"SELECT i.table_name, i.row_identifier, i.ord, 'general_dqa' AS source, i.check_id, i.issue_code, NULL AS area, NULL AS metric, NULL AS score, "
        f"'Unknown {c} value cannot be mapped to the allowed domain.' AS reason FROM v_{t} t JOIN marks i ON i.table_name = '{t}' "
        f"AND i.check_id = '{c}_domain' AND i.row_identifier = {rid(t)} WHERE {c} IS NOT NULL AND {canonical(t, c)} IS NULL"
        for (t, c) in DOMAINS if c != "compound")
    areas = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{a}' AS area" for t, names in FLAGS.items() for a in names)
    sector = "metric IN ('sector1_time_ms', 'sector2_time_ms', 'sector3_time_ms')"
    return f""",
check_order AS (SELECT * FROM (VALUES {order}) o(table_name, check_id, ord)),
marks AS MATERIALIZED (SELECT DISTINCT i.table_name, i.row_identifier, i.check_id, i.issue_code, o.ord FROM issues i JOIN check_order o USING (table_name, check_id)),
text_actions AS ({' UNION ALL '.join(text)}),
null_all AS MATERIALIZED ({' UNION ALL '.join(nulls)}),
null_first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_name, row_identifier, target_column ORDER BY ord) AS n FROM null_all) WHERE n = 1),
standard_all AS ({' UNION ALL '.join(standard)}),
standard_first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_name, row_identifier, target_column ORDER BY ord) AS n FROM standard_all) WHERE n = 1),
dqa_drops AS (SELECT table_name, row_identifier, ord, 'general_dqa' AS source, check_id, issue_code, NULL AS area, NULL AS metric, NULL AS score, {_q(DROP_REASON)} AS reason
  FROM marks WHERE check_id LIKE '%required_structural_columns' OR check_id LIKE '%required_identification_columns' OR check_id LIKE '%required_columns'
    OR check_id IN ('circuit_required_analytical_columns', 'season_year_formula1_domain', 'round_number_positive', 'result_position_positive', 'lap_number_positive',
      'lap_time_positive', 'weather_time_non_negative', 'track_status_time_non_negative', 'track_status_code_domain')
    OR issue_code IN ('DUPLICATED_KEY', 'BROKEN_FOREIGN_KEY') UNION ALL {unknown}),
missing_drops AS (SELECT DISTINCT table_name, row_identifier, 1000 AS ord, 'missing_values' AS source, NULL AS check_id, NULL AS issue_code, missing_information_area AS area,
    NULL AS metric, NULL AS score, 'Rows with missing ' || CASE table_name WHEN 'lap' THEN 'lap time' ELSE 'classification' END || ' information are removed from the cleaned '
    || table_name || ' table.' AS reason FROM missing
  WHERE (table_name, missing_information_area) IN (('lap', 'LAP_TIME_INFORMATION'), ('result', 'CLASSIFICATION_INFORMATION'))),
outlier_drops AS (SELECT DISTINCT table_name, row_identifier, 2000 AS ord, 'outlier_detection' AS source, NULL AS check_id, NULL AS issue_code, NULL AS area, 'lap_time_ms' AS metric,
    2 AS score, 'Rows with strong consensus lap_time_ms outliers are removed because lap time is the core performance measure.' AS reason
  FROM outliers WHERE metric = 'lap_time_ms' AND consensus_score >= 2),
own_drops AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_name, row_identifier ORDER BY ord) AS n
  FROM (SELECT * FROM dqa_drops UNION ALL SELECT * FROM missing_drops UNION ALL SELECT * FROM outlier_drops)) WHERE n = 1),
areas AS ({areas}),
flag_all AS (
  SELECT table_name, row_identifier, ord, area, 'general_dqa' AS source, target_column, check_id, issue_code, NULL AS missing_class, NULL AS metric, NULL AS score,
         area || '_INFORMATION is affected after setting an invalid value to NULL.' AS reason FROM null_all WHERE area IS NOT NULL
  UNION ALL SELECT table_name, row_identifier, ord, 'SECTOR', 'general_dqa', NULL, check_id, issue_code, NULL, NULL, NULL, 'Sector sum is not coherent with lap time.'
    FROM marks WHERE check_id = 'lap_sector_sum_matches_lap_time'
  UNION ALL SELECT table_name, row_identifier, 1000, replace(missing_information_area, '_INFORMATION', '') AS area, 'missing_values', string_agg(DISTINCT column_name, '|' ORDER BY column_name), NULL, NULL,
         string_agg(DISTINCT missing_class, '|' ORDER BY missing_class), NULL, NULL, 'Focused missing value output indicates that ' || missing_information_area || ' is incomplete or unreliable.'
    FROM missing WHERE (table_name, row_identifier) NOT IN (SELECT (table_name, row_identifier) FROM dqa_drops) AND (table_name, row_identifier) NOT IN (SELECT (table_name, row_identifier) FROM missing_drops)
    GROUP BY table_name, row_identifier, missing_information_area
  UNION ALL SELECT 'lap', row_identifier, 2000, CASE WHEN {sector} THEN 'SECTOR' ELSE 'SPEED' END, 'outlier_detection', NULL, NULL, NULL, NULL, string_agg(metric, '|' ORDER BY metric),
         max(consensus_score), 'Outlier detection indicates that ' || CASE WHEN {sector} THEN 'SECTOR' ELSE 'SPEED' END || '_INFORMATION may be unreliable.'
    FROM outliers WHERE metric <> 'lap_time_ms' AND ('lap', row_identifier) NOT IN (SELECT (table_name, row_identifier) FROM own_drops)
    GROUP BY row_identifier, {sector}),
flag_first AS MATERIALIZED (SELECT * FROM (SELECT f.*, row_number() OVER (PARTITION BY table_name, row_identifier, area ORDER BY ord) AS n FROM flag_all f JOIN areas USING (table_name, area)) WHERE n = 1),
{_cascade()},
drops AS MATERIALIZED (SELECT table_name, row_identifier, source, check_id, issue_code, area, metric, score, reason FROM own_drops UNION ALL
  {' UNION ALL '.join(f"SELECT * FROM cascade_{t}" for t in REFERENCES)}),
actions AS MATERIALIZED (SELECT * FROM text_actions
  UNION ALL SELECT {_row(source="'general_dqa'", table_name="table_name", row_identifier="row_identifier", target_column="target_column", check_id="check_id", issue_code="issue_code", cleaning_action="'SET_NULL'", old_value="old_value", reason="reason")} FROM null_first
  UNION ALL SELECT {_row(source="'general_dqa'", table_name="table_name", row_identifier="row_identifier", target_column="target_column", check_id="check_id", issue_code="issue_code", cleaning_action="'STANDARDIZE'", old_value="old_value", new_value="new_value", reason="reason")} FROM standard_first
  UNION ALL SELECT {_row(source="source", table_name="table_name", row_identifier="row_identifier", target_column="target_column", quality_flag_column="'has_' || lower(area) || '_information_issue'", check_id="check_id", issue_code="issue_code", missing_class="missing_class", information_area="area || '_INFORMATION'", outlier_metric="metric", outlier_consensus_score="score", cleaning_action="'ADD_FLAG'", old_value="'False'", new_value="'True'", reason="reason")} FROM flag_first
  UNION ALL SELECT {_row(source="source", table_name="table_name", row_identifier="row_identifier", check_id="check_id", issue_code="issue_code", information_area="area", outlier_metric="metric", outlier_consensus_score="score", cleaning_action="'DROP_ROW'", reason="reason")} FROM drops)"""


def _cascade() -> str:
    """Parents first: `alive_<table>` after each table's own drops and those of its parents."""
    out = []
    for t in ("season", "circuit", "driver", "team", "grand_prix", "session", "result", "lap", "weather", "track_status"):
        own = f"kept_{t} AS (SELECT *, {rid(t)} AS row_identifier FROM v_{t} WHERE {rid(t)} NOT IN (SELECT row_identifier FROM own_drops WHERE table_name = '{t}'))"
        out.append(own)
        if t not in REFERENCES:
            out.append(f"alive_{t} AS MATERIALIZED (SELECT * FROM kept_{t})")
            continue
        cases = [
            (f"{c} IS NOT NULL AND {c} NOT IN (SELECT {KEYS[p]} FROM alive_{p})", f"post_cleaning_{fk_id(t, c, p)}",
             f"Row removed because {t}.{c} no longer references a valid {p}.{KEYS[p]} after previous cleaning actions.")
            for c, p in REFERENCES[t]
        ]
        check = " ".join(f"WHEN {cond} THEN '{name}'" for cond, name, _ in cases)
        reason = " ".join(f"WHEN '{name}' THEN '{text}'" for _, name, text in cases)
        out.append(
            f"cascade_{t} AS MATERIALIZED (SELECT '{t}' AS table_name, row_identifier, 'general_dqa' AS source, check_id, 'BROKEN_FOREIGN_KEY_AFTER_CLEANING' AS issue_code, "
            f"NULL AS area, NULL AS metric, NULL AS score, CASE check_id {reason} END AS reason FROM (SELECT row_identifier, CASE {check} END AS check_id FROM kept_{t}) WHERE check_id IS NOT NULL)")
        out.append(f"alive_{t} AS MATERIALIZED (SELECT * FROM kept_{t} WHERE row_identifier NOT IN (SELECT row_identifier FROM cascade_{t}))")
    return ",\n".join(out)


def _value(table: str, column: str) -> str:
    return f"nullif({trim(column)}, '')" if column in TEXT_COLUMNS[table] else column


def cleaned_definitions() -> str:
    """`c_<table>`: the cleaned tables, written as direct projections of the surviving rows."""
    def flags(t):
        return ", ".join(
            f"row_identifier IN (SELECT row_identifier FROM flag_first WHERE table_name = '{t}' AND area = '{a}') AS {_flag_column(a)}" for a in FLAGS[t])

    def low(c, limit=1):
        return f"CASE WHEN {c} >= {limit} THEN {c} END AS {c}"

    age = "2021 - year(date_of_birth) >= 15 AND 2022 - year(date_of_birth) <= 60"
    return f""",
c_season AS (SELECT season_year, CASE WHEN in_order THEN season_start_date END AS season_start_date, CASE WHEN in_order THEN season_end_date END AS season_end_date,
    {low('number_of_events')}, {_value('season', 'champion_driver')} AS champion_driver, {_value('season', 'champion_team')} AS champion_team
  FROM (SELECT *, season_start_date <= season_end_date AND year(season_start_date) = season_year AND year(season_end_date) = season_year AS in_order FROM alive_season)),
c_circuit AS (SELECT circuit_id, circuit_name, country, trim(location) AS location, seasons_present, {', '.join(f"{canonical('circuit', c)} AS {c}" for t, c in DOMAINS if t == 'circuit')} FROM alive_circuit),
c_driver AS (SELECT driver_id, CASE WHEN regexp_matches(abbreviation, '^[A-Z]{{3}}$') THEN abbreviation END AS abbreviation, first_name, last_name, nationality, CASE WHEN regexp_matches(driver_url, '^https?://') THEN driver_url END AS driver_url,
    CASE WHEN {age} THEN date_of_birth END AS date_of_birth, CASE WHEN permanent_number BETWEEN 1 AND 99 THEN permanent_number END AS permanent_number FROM alive_driver),
c_team AS (SELECT team_id, team_name, nationality, CASE WHEN regexp_matches(team_url, '^https?://') THEN team_url END AS team_url FROM alive_team),
c_grand_prix AS (SELECT grand_prix_id, season_year, round_number, event_name, official_event_name, country, location, CASE WHEN year(event_date) = season_year THEN event_date END AS event_date,
    {canonical('grand_prix', 'event_format')} AS event_format, f1_api_support, circuit_id FROM alive_grand_prix),
c_session AS (SELECT s.session_id, s.grand_prix_id, {canonical('session', 'session_type')} AS session_type, session_name,
    CASE WHEN date_diff('day', g.event_date, session_date) BETWEEN -2 AND 0 THEN session_date END AS session_date FROM alive_session s JOIN v_grand_prix g USING (grand_prix_id)),
c_result AS (SELECT result_id, session_id, driver_id, team_id, position, {_value('result', 'classified_position')} AS classified_position, {low('grid_position', 0)}, q1_ms, q2_ms, q3_ms, time_ms,
    {_value('result', 'status')} AS status, {low('points', 0)}, {low('laps', 0)}, {flags('result')} FROM alive_result),
c_lap AS (SELECT lap_id, session_id, driver_id, team_id, lap_number, time_ms, lap_start_time_ms, lap_time_ms, {', '.join(low(m) for m in METRICS[1:4])}, pit_in_time_ms, pit_out_time_ms,
    {', '.join(low(m) for m in METRICS[4:])}, {canonical('lap', 'compound')} AS compound, {low('tyre_life')}, {_value('lap', 'fresh_tyre')} AS fresh_tyre, {_value('lap', 'track_status')} AS track_status,
    position, {flags('lap')} FROM alive_lap),
c_weather AS (SELECT weather_id, session_id, time_ms, CASE WHEN air_temp BETWEEN -5 AND 50 THEN air_temp END AS air_temp,
    CASE WHEN track_temp BETWEEN -5 AND 80 AND abs(track_temp - air_temp) <= 50 THEN track_temp END AS track_temp, rainfall, {low('wind_speed', 0)} FROM alive_weather),
c_track_status AS (SELECT track_status_id, session_id, time_ms, status, ({EXPECTED_MESSAGE}) AS message FROM alive_track_status)"""


def with_cleaning(body: str) -> str:
    return with_quality(f",{missing_definitions()},{outlier_definitions()}{definitions()}{body}")


def with_cleaned(body: str) -> str:
    return with_cleaning(cleaned_definitions() + body)
