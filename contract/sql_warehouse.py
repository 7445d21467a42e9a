"""The star schema in plain SQL, over the cleaned tables (`c_`) or the raw ones (`v_`)."""

from __future__ import annotations

from contract.sql_cleaning import FLAGS, with_cleaned


def level(c: str, low, high) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'Unknown' WHEN {c} < {low} THEN 'Low' WHEN {c} < {high} THEN 'Medium' ELSE 'High' END"


def tyre_life(c: str = "tyre_life") -> str:
    return f"CASE WHEN {c} IS NULL OR {c} < 0 THEN 'Unknown' WHEN {c} <= 5 THEN 'Low' WHEN {c} <= 15 THEN 'Medium' ELSE 'High' END"


def tyre_set(c: str = "fresh_tyre") -> str:
    return f"CASE WHEN lower({c}) IN ('yes', 'true') THEN 'NewSet' WHEN lower({c}) IN ('f', 'false') THEN 'UsedSet' ELSE 'Unknown' END"


LAP_TYPE = ("CASE WHEN pit_out_time_ms IS NOT NULL AND pit_in_time_ms IS NOT NULL THEN 'PitAffectedLap' WHEN pit_out_time_ms IS NOT NULL THEN 'OutLap' "
            "WHEN pit_in_time_ms IS NOT NULL THEN 'InLap' ELSE 'NormalLap' END")


def track_category(message: str, code: str) -> str:
    text = f"lower(coalesce({message}, '') || ' ' || coalesce({code}, ''))"
    return (f"CASE WHEN trim({text}) = '' THEN 'Unknown' WHEN {text} LIKE '%allclear%' THEN 'AllClear' WHEN {text} LIKE '%vscending%' THEN 'VSCEnding' "
            f"WHEN {text} LIKE '%vsc%' THEN 'VSCDeployed' WHEN {text} LIKE '%scdeployed%' THEN 'SCDeployed' WHEN {text} LIKE '%yellow%' THEN 'Yellow' "
            f"WHEN {text} LIKE '%red%' THEN 'Red' ELSE 'Other' END")


def classification(c: str = "classified_position") -> str:
    code = f"upper(trim({c}))"
    return (f"CASE WHEN {c} IS NULL THEN 'NotApplicable' WHEN regexp_matches({code}, '^[0-9]+$') THEN 'Classified' WHEN {code} = 'R' THEN 'Retired' "
            f"WHEN {code} IN ('D', 'DQ', 'DSQ') THEN 'Disqualified' WHEN {code} = 'E' THEN 'Excluded' WHEN {code} = 'W' THEN 'Withdrawn' "
            f"WHEN {code} = 'F' THEN 'FailedToQualify' WHEN {code} IN ('N', 'NC') THEN 'NotClassified' ELSE 'Other' END")


def outcome(c: str = "status") -> str:
    t = f"lower(trim({c}))"
    return (f"CASE WHEN {c} IS NULL THEN 'NotApplicable' WHEN {t} = 'finished' THEN 'Finished' WHEN {t} LIKE '+%' THEN 'Lapped' "
            f"WHEN {t} LIKE '%disqualified%' OR {t} LIKE '%excluded%' THEN 'Disqualified' WHEN {t} LIKE '%did not start%' OR {t} = 'dns' THEN 'DidNotStart' "
            f"WHEN {t} LIKE '%collision%' THEN 'Collision' WHEN regexp_matches({t}, 'accident|spun off|crash|damage') THEN 'Accident' "
            f"WHEN regexp_matches({t}, 'engine|power unit|turbo') THEN 'PowerUnitIssue' "
            f"WHEN regexp_matches({t}, 'gearbox|hydraulic|transmission|brake|suspension|electrical|fuel|oil|water|exhaust|clutch') THEN 'MechanicalIssue' "
            f"WHEN regexp_matches({t}, 'retired|withdrawn') THEN 'Retired' ELSE 'Other' END")


GAP = ("CASE WHEN session_type = 'R' AND position = 1 THEN 0 WHEN session_type = 'R' AND lower(trim(status)) = 'finished' THEN time_ms END")
LAP_FLAG_COLUMNS = [f"has_{a.lower()}_information_issue" for a in FLAGS["lap"]]
RESULT_FLAG_COLUMNS = [f"has_{a.lower()}_information_issue" for a in FLAGS["result"]]


def asof(facts: str, fact_key: str, context: str, context_key: str, columns: dict[str, str], out: str) -> str:
    """`out`: fact key and the context columns; the latest at or before, else the first of the session."""
    last = ", ".join(f"w.{c} AS {n}" for c, n in columns.items())
    first = ", ".join(f"arg_min(struct_pack(x := {c}), (time_ms, {context_key})).x AS {n}" for c, n in columns.items())
    both = ", ".join(f"CASE WHEN b.has THEN b.{n} WHEN b.t IS NOT NULL THEN f.{n} END AS {n}" for n in columns.values())
    return f"""{out}_before AS (SELECT l.{fact_key}, l.session_id, l.lap_start_time_ms AS t, w.{context_key} IS NOT NULL AS has, {last}
  FROM {facts} l ASOF LEFT JOIN {context} w ON l.session_id = w.session_id AND l.lap_start_time_ms >= w.time_ms),
{out}_first AS (SELECT session_id, {first} FROM {context} GROUP BY 1),
{out} AS (SELECT b.{fact_key}, {both} FROM {out}_before b LEFT JOIN {out}_first f USING (session_id))"""


WEATHER = {"time_ms": "weather_time_ms", "air_temp": "air_temp", "track_temp": "track_temp", "rainfall": "rainfall", "wind_speed": "wind_speed"}
TRACK = {"time_ms": "track_status_time_ms", "status": "track_code", "message": "track_message"}


def session_weather(weather: str) -> str:
    means = ", ".join(f"avg({n}) AS avg_{n}" for n in ("air_temp", "track_temp", "wind_speed"))
    return f"SELECT session_id, coalesce(bool_or(rainfall), false) AS rain_flag, {means} FROM {weather} GROUP BY 1"


def _dimension(name: str, key: str, attributes, work: str) -> str:
    columns = ", ".join(attributes)
    return f"{name} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {columns}) AS {key}, * FROM (SELECT DISTINCT {columns} FROM {work}))"


CONTEXT = {
    "dim_tyre_context": ("tyre_context_key", ["compound", "starting_tyre_set_status", "tyre_life_class"], "lap_work"),
    "dim_lap_weather_context": ("lap_weather_context_key", ["rain_flag", "air_temp_class", "track_temp_class", "wind_speed_class"], "lap_work"),
    "dim_lap_data_quality": ("lap_data_quality_key", LAP_FLAG_COLUMNS, "lap_work"),
    "dim_result_outcome": ("result_outcome_key", ["result_status_category", "result_classification_category"], "result_work"),
    "dim_result_weather_context": ("result_weather_context_key", ["rain_flag", "avg_air_temp_class", "avg_track_temp_class", "avg_wind_speed_class"], "result_work"),
    "dim_result_data_quality": ("result_data_quality_key", RESULT_FLAG_COLUMNS, "result_work"),
}


def star_definitions() -> str:
    other_flags = ", ".join(c for c in LAP_FLAG_COLUMNS if "weather" not in c and "track_status" not in c)
    return f""",
{asof('c_lap', 'lap_id', 'c_weather', 'weather_id', WEATHER, 'lap_w')},
{asof('c_lap', 'lap_id', 'c_track_status', 'track_status_id', TRACK, 'lap_t')},
lap_work AS MATERIALIZED (SELECT row_number() OVER (ORDER BY lap_id) AS lap_performance_key, driver_id, team_id, s.grand_prix_id, coalesce(s.session_type, 'Unknown') AS session_type,
    {LAP_TYPE} AS lap_type, lap_number, {track_category('track_message', 'track_code')} AS track_status_category, lap_time_ms, sector1_time_ms, sector2_time_ms, sector3_time_ms,
    speed_i1, speed_i2, speed_fl, speed_st, CAST(position AS BIGINT) AS position, coalesce(compound, 'Unknown') AS compound, {tyre_set()} AS starting_tyre_set_status, {tyre_life()} AS tyre_life_class,
    coalesce(rainfall, false) AS rain_flag, {level('air_temp', 20, 28)} AS air_temp_class, {level('track_temp', 30, 42)} AS track_temp_class, {level('wind_speed', 2, 5)} AS wind_speed_class,
    {other_flags}, has_weather_information_issue OR weather_time_ms IS NULL AS has_weather_information_issue,
    has_track_status_information_issue OR track_status_time_ms IS NULL AS has_track_status_information_issue
  FROM c_lap l LEFT JOIN c_session s USING (session_id) JOIN lap_w USING (lap_id) JOIN lap_t USING (lap_id)),
session_w AS ({session_weather('c_weather')}),
result_work AS MATERIALIZED (SELECT row_number() OVER (ORDER BY result_id) AS session_result_key, driver_id, team_id, s.grand_prix_id, coalesce(s.session_type, 'Unknown') AS session_type,
    CAST(position AS BIGINT) AS position, CAST(grid_position AS BIGINT) AS grid_position, q1_ms, q2_ms, q3_ms, {GAP} AS gap_to_leader_ms, points, CAST(laps AS BIGINT) AS laps,
    {outcome()} AS result_status_category, {classification()} AS result_classification_category, coalesce(w.rain_flag, false) AS rain_flag,
    {level('avg_air_temp', 20, 28)} AS avg_air_temp_class, {level('avg_track_temp', 30, 42)} AS avg_track_temp_class, {level('avg_wind_speed', 2, 5)} AS avg_wind_speed_class,
    {', '.join(RESULT_FLAG_COLUMNS)}
  FROM c_result r LEFT JOIN c_session s USING (session_id) LEFT JOIN session_w w USING (session_id)),
{', '.join(_dimension(n, k, a, w) for n, (k, a, w) in CONTEXT.items())},
dim_driver AS (SELECT driver_id, abbreviation, first_name, last_name, nationality, CASE WHEN date_of_birth IS NULL OR date_of_birth > DATE '2022-01-01' THEN 'Unknown'
    WHEN floor(date_diff('day', date_of_birth, TIMESTAMP '2022-01-01') / 365.2425) < 25 THEN 'Young' WHEN floor(date_diff('day', date_of_birth, TIMESTAMP '2022-01-01') / 365.2425) < 30 THEN 'Intermediate'
    ELSE 'Senior' END AS driver_age_class FROM c_driver),
dim_team AS (SELECT team_id, team_name, nationality FROM c_team),
dim_grand_prix AS (SELECT grand_prix_id, season_year, round_number, g.circuit_id, event_name, event_date, event_format, circuit_name, g.country, g.location, global_circuit_category,
    sector1_category, sector2_category, sector3_category FROM c_grand_prix g LEFT JOIN c_circuit c USING (circuit_id)),
fact_lap_performance AS MATERIALIZED (SELECT lap_performance_key, driver_id, team_id, grand_prix_id, tyre_context_key, lap_weather_context_key, lap_data_quality_key, session_type, lap_type, lap_number,
    track_status_category, lap_time_ms, sector1_time_ms, sector2_time_ms, sector3_time_ms, speed_i1, speed_i2, speed_fl, speed_st, position
  FROM lap_work JOIN dim_tyre_context USING ({', '.join(CONTEXT['dim_tyre_context'][1])}) JOIN dim_lap_weather_context USING ({', '.join(CONTEXT['dim_lap_weather_context'][1])})
  JOIN dim_lap_data_quality USING ({', '.join(LAP_FLAG_COLUMNS)})),
fact_session_result AS MATERIALIZED (SELECT session_result_key, driver_id, team_id, grand_prix_id, result_outcome_key, result_weather_context_key, result_data_quality_key, session_type, position, grid_position,
    q1_ms, q2_ms, q3_ms, gap_to_leader_ms, points, laps
  FROM result_work JOIN dim_result_outcome USING ({', '.join(CONTEXT['dim_result_outcome'][1])}) JOIN dim_result_weather_context USING ({', '.join(CONTEXT['dim_result_weather_context'][1])})
  JOIN dim_result_data_quality USING ({', '.join(RESULT_FLAG_COLUMNS)}))"""


def with_star(body: str) -> str:
    return with_cleaned(star_definitions() + body)
