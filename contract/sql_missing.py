"""Missing-value and outlier stages in plain SQL."""

from __future__ import annotations

from contract.views import sql_views

AREAS = (
    "CLASSIFICATION_INFORMATION", "LAP_TIME_INFORMATION", "NONE", "PIT_INFORMATION", "QUALIFYING_INFORMATION",
    "RACE_CONTEXT_INFORMATION", "SECTOR_INFORMATION", "SPEED_INFORMATION", "TRACK_STATUS_INFORMATION",
    "TYRE_INFORMATION", "WEATHER_INFORMATION",
)


def _flag(table, key, column, condition, kind, area, text) -> str:
    source = "typed_result" if table == "result" else f"v_{table}"
    return (f"SELECT '{table}' AS table_name, '{key}=' || {key} AS row_identifier, '{column}' AS column_name, "
            f"'{kind}_NULL' AS missing_class, '{area}' AS missing_information_area, '{text.format(column)}' AS explanation "
            f"FROM {source} WHERE {column} IS NULL AND ({condition})")


_RACE, _QUALI = "trim(session_type) = 'R'", "trim(session_type) = 'Q'"
_RC = ("grid_position", "status", "points", "laps", "time_ms")
_PIT = "pit_in_time_ms IS NOT NULL OR pit_out_time_ms IS NOT NULL"


def result_flags() -> list[str]:
    def f(column, condition, kind, area, text):
        return _flag("result", "result_id", column, condition, kind, area, text)

    out = [f(c, _RACE, "EXPLAINED", "NONE", "{} is not applicable in a Race session.") for c in ("q1_ms", "q2_ms", "q3_ms")]
    out += [f(c, _RACE, "SUSPICIOUS", "CLASSIFICATION_INFORMATION", "{} is expected in a Race session and is missing.")
            for c in ("position", "classified_position")]
    out += [f(c, _RACE, "SUSPICIOUS", "RACE_CONTEXT_INFORMATION",
              "{} is race-context information and is missing in a Race session.") for c in _RC]
    out.append(f("position", _QUALI, "SUSPICIOUS", "CLASSIFICATION_INFORMATION",
                 "{} is missing in a Qualifying session, so qualifying progression cannot be interpreted reliably."))
    out += [f(c, _QUALI, "EXPLAINED", "NONE", "{} is race-related and is not central in a Qualifying session.")
            for c in ("classified_position", *_RC)]
    out.append(f("q1_ms", _QUALI, "SUSPICIOUS", "QUALIFYING_INFORMATION", "{} is missing in a Qualifying session."))
    for c, last, name in (("q2_ms", 15, "Q2"), ("q3_ms", 10, "Q3")):
        out.append(f(c, f"{_QUALI} AND position > {last}", "EXPLAINED", "NONE",
                     f"{{}} is missing because the driver was classified outside the top {last} and normally did not reach {name}."))
        out.append(f(c, f"{_QUALI} AND (position IS NULL OR position <= {last})", "SUSPICIOUS", "QUALIFYING_INFORMATION",
                     f"{{}} is missing although the position does not clearly explain elimination before {name}."))
    return out


def lap_flags() -> list[str]:
    def f(column, condition, kind, area, text):
        return _flag("lap", "lap_id", column, condition, kind, area, text)

    out = [f("pit_in_time_ms", "true", "EXPLAINED", "NONE", "{} is missing because the lap is treated as not being an in-lap."),
           f("pit_out_time_ms", "true", "EXPLAINED", "NONE", "{} is missing because the lap is treated as not being an out-lap."),
           f("lap_time_ms", "true", "SUSPICIOUS", "LAP_TIME_INFORMATION", "{} is missing, so the row lacks the main lap time information.")]
    plain = "{} is missing without a direct sector-specific explanation."
    for c in ("sector1_time_ms", "sector2_time_ms"):
        out.append(f(c, "true", "SUSPICIOUS", "SECTOR_INFORMATION", plain))
    out.append(f("sector3_time_ms", "pit_in_time_ms IS NOT NULL", "EXPLAINED", "SECTOR_INFORMATION",
                 "{} is missing and pit_in_time_ms is present, so the lap is an in-lap."))
    out.append(f("sector3_time_ms", "pit_in_time_ms IS NULL", "SUSPICIOUS", "SECTOR_INFORMATION", plain))
    for c in ("speed_i1", "speed_fl", "speed_st"):
        out.append(f(c, _PIT, "EXPLAINED", "SPEED_INFORMATION", "{} is missing and pit information is present."))
        out.append(f(c, f"NOT ({_PIT})", "SUSPICIOUS", "SPEED_INFORMATION", "{} is missing without a direct pit-related explanation."))
    out.append(f("speed_i2", "true", "SUSPICIOUS", "SPEED_INFORMATION", "{} is missing without a direct pit-related explanation."))
    out.append(f("compound", "true", "SUSPICIOUS", "TYRE_INFORMATION", "{} is missing, so tyre information is incomplete."))
    out.append(f("tyre_life", "true", "SUSPICIOUS", "TYRE_INFORMATION", "{} is missing, so tyre degradation information is incomplete."))
    out.append(f("track_status", "true", "SUSPICIOUS", "TRACK_STATUS_INFORMATION",
                 "{} is missing, so track condition information is incomplete."))
    return out


def missing_definitions() -> str:
    """`typed_result`, `all_missing` (with explained ones) and `missing` (recorded flags)."""
    return f"""
typed_result AS (SELECT r.*, s.session_type FROM v_result r LEFT JOIN v_session s USING (session_id)),
all_missing AS (SELECT *, CASE WHEN missing_information_area = 'NONE' THEN 'green' WHEN missing_class = 'EXPLAINED_NULL' THEN 'yellow'
    WHEN missing_information_area IN ('CLASSIFICATION_INFORMATION', 'QUALIFYING_INFORMATION', 'LAP_TIME_INFORMATION', 'TYRE_INFORMATION') THEN 'red'
    ELSE 'yellow' END AS severity FROM ({' UNION ALL '.join(result_flags() + lap_flags())})),
missing AS MATERIALIZED (SELECT * FROM all_missing WHERE NOT (missing_class = 'EXPLAINED_NULL' AND missing_information_area = 'NONE'))"""


def with_missing(body: str) -> str:
    return f"WITH {sql_views('session', 'result', 'lap')},{missing_definitions()}{body}"


def missing_summary_definition() -> str:
    areas = ", ".join(f"count(*) FILTER (WHERE missing_information_area = '{a}') AS {a.lower()}_count" for a in AREAS)

    def modal(column: str, alias: str) -> str:
        return (f"(SELECT table_name, column_name, arg_min({column}, (-n, {column})) AS {alias} FROM (SELECT table_name, column_name, {column}, count(*) AS n "
                f"FROM missing GROUP BY ALL) GROUP BY 1, 2)")

    return f"""
missing_summary AS (SELECT c.table_name, c.column_name, t.total_rows, missing_count, round(CAST(missing_count AS DOUBLE) / t.total_rows, 6) AS missing_percentage,
    explained_null_count, suspicious_null_count, main_missing_class, main_missing_information_area, {', '.join(a.lower() + '_count' for a in AREAS)}
  FROM (SELECT table_name, column_name, count(*) AS missing_count, count(*) FILTER (WHERE missing_class = 'EXPLAINED_NULL') AS explained_null_count,
        count(*) FILTER (WHERE missing_class = 'SUSPICIOUS_NULL') AS suspicious_null_count, {areas} FROM missing GROUP BY 1, 2) c
  JOIN (SELECT 'lap' AS table_name, count(*) AS total_rows FROM v_lap UNION ALL SELECT 'result', count(*) FROM v_result) t USING (table_name)
  JOIN {modal('missing_class', 'main_missing_class')} m1 USING (table_name, column_name)
  JOIN {modal('missing_information_area', 'main_missing_information_area')} m2 USING (table_name, column_name))"""


METRICS = ("lap_time_ms", "sector1_time_ms", "sector2_time_ms", "sector3_time_ms", "speed_i1", "speed_i2", "speed_fl", "speed_st")


def clean_lap_definition() -> str:
    return """
dry AS (SELECT session_id FROM v_weather GROUP BY 1 HAVING NOT bool_or(rainfall)),
races AS (SELECT session_id FROM v_session WHERE trim(session_type) = 'R'),
clean_lap AS (SELECT * FROM v_lap WHERE lap_time_ms IS NOT NULL AND compound IS NOT NULL AND pit_in_time_ms IS NULL AND pit_out_time_ms IS NULL
    AND trim(track_status) IN ('1', '1.0') AND session_id IN (SELECT session_id FROM dry) AND session_id IN (SELECT session_id FROM races))"""


def scored_definitions(values: str, keys: str) -> str:
    """`scored`: every value of `values` (keys, value, ...) with the statistics of its group."""
    on = " AND ".join(f"s.{k.strip()} = v.{k.strip()}" for k in keys.split(","))
    return f"""
stats AS (SELECT {keys}, count(*) AS tested, quantile_cont(value, 0.25) AS sq1, quantile_cont(value, 0.75) AS sq3, quantile_cont(value, 0.5) AS smedian FROM {values} GROUP BY {keys}),
mads AS (SELECT {', '.join('v.' + k.strip() for k in keys.split(','))}, quantile_cont(abs(value - smedian), 0.5) AS smad FROM {values} v JOIN stats s ON {on} GROUP BY ALL),
bounds AS (SELECT s.*, smad, CASE WHEN tested >= 10 AND sq3 <> sq1 THEN sq1 - 1.5 * (sq3 - sq1) END AS iqr_lower_bound,
    CASE WHEN tested >= 10 AND sq3 <> sq1 THEN sq3 + 1.5 * (sq3 - sq1) END AS iqr_upper_bound FROM stats s JOIN mads v ON {on}),
zs AS (SELECT v.*, tested, iqr_lower_bound, iqr_upper_bound, sq1, sq3, smedian, smad,
    CASE WHEN tested >= 10 AND smad <> 0 THEN 0.6745 * (value - smedian) / smad END AS modified_z_score FROM {values} v JOIN bounds s ON {on}),
flagged AS (SELECT *, coalesce(value < iqr_lower_bound OR value > iqr_upper_bound, false) AS iqr_flag, coalesce(abs(modified_z_score) > 3.5, false) AS modified_z_flag FROM zs),
scored AS (SELECT *, CAST(iqr_flag AS INT) + CAST(modified_z_flag AS INT) AS consensus_score FROM flagged)"""


def outlier_definitions() -> str:
    """`outliers` (flags) and `outlier_summary`."""
    long = " UNION ALL ".join(
        f"SELECT session_id, 'lap_id=' || lap_id AS row_identifier, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM clean_lap WHERE {m} IS NOT NULL"
        for m in METRICS)
    grid = ", ".join(f"('{m}')" for m in METRICS)
    return f"""{clean_lap_definition()},
long_values AS MATERIALIZED ({long}),{scored_definitions('long_values', 'session_id, metric')},
outliers AS MATERIALIZED (SELECT 'lap' AS table_name, row_identifier, session_id, metric, value, iqr_flag, modified_z_flag, consensus_score,
    CASE WHEN consensus_score >= 2 THEN 'STRONG_CONSENSUS_OUTLIER' ELSE 'WEAK_ANOMALY' END AS interpretation,
    CASE WHEN iqr_lower_bound IS NOT NULL THEN sq1 END AS q1, CASE WHEN iqr_lower_bound IS NOT NULL THEN sq3 END AS q3, iqr_lower_bound, iqr_upper_bound,
    CASE WHEN modified_z_score IS NOT NULL THEN smedian END AS median, CASE WHEN modified_z_score IS NOT NULL THEN smad END AS mad, modified_z_score
  FROM scored WHERE consensus_score > 0),
outlier_summary AS MATERIALIZED (SELECT 'lap' AS table_name, g.session_id, g.metric, coalesce(tested_values, 0) AS tested_values, coalesce(iqr_outliers, 0) AS iqr_outliers,
    coalesce(modified_z_outliers, 0) AS modified_z_outliers, coalesce(consensus_outliers, 0) AS consensus_outliers,
    CASE WHEN coalesce(tested_values, 0) < 10 THEN 'skipped_too_few_values' ELSE 'completed' END AS status
  FROM (SELECT DISTINCT session_id, metric FROM clean_lap, (VALUES {grid}) m(metric)) g
  LEFT JOIN (SELECT session_id, metric, count(*) AS tested_values, count(*) FILTER (WHERE iqr_flag) AS iqr_outliers,
             count(*) FILTER (WHERE modified_z_flag) AS modified_z_outliers, count(*) FILTER (WHERE consensus_score >= 2) AS consensus_outliers
             FROM scored GROUP BY 1, 2) c USING (session_id, metric))"""


def with_outliers(body: str) -> str:
    return f"WITH {sql_views('session', 'lap', 'weather')},{outlier_definitions()}{body}"


OUTLIER_VALUES = ("value", "q1", "q3", "iqr_lower_bound", "iqr_upper_bound", "median", "mad", "modified_z_score")
