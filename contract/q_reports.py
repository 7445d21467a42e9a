"""Report tables and star queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.registry import query, shared_folder, stages
from contract.sql_missing import AREAS, missing_definitions, missing_summary_definition, outlier_definitions, with_missing, with_outliers
from contract.sql_quality import scorecard_sql, with_quality
from contract.sql_warehouse import with_star
from contract.views import tables
from starq import batch
from starq.plans import reporting as r
from starq.plans import starqueries as b
from starq.session import configure, fresh_path
from starq.sources.tables import refresh_files


def _with_card(body: str) -> str:
    return with_quality("," + scorecard_sql() + body)


@query("rp_score", _with_card("\nSELECT table_name, overall_score FROM scorecard WHERE overall_score IS NOT NULL"))
def _(spark, sf):
    return r.score_by_table(stages(spark, sf).assessment().scorecard)


@query("rp_issues", _with_card("\nSELECT table_name, issue_count FROM scorecard"))
def _(spark, sf):
    return r.issues_by_table(stages(spark, sf).assessment().scorecard)


_COLOR = "CASE WHEN score IS NULL THEN '#e5e7eb' WHEN score >= 0.95 THEN '#79b66c' WHEN score >= 0.80 THEN '#f1c75b' ELSE '#d46a6a' END"


@query("rp_heatmap", _with_card(",\nlong AS (" + " UNION ALL ".join(
    f"SELECT table_name, '{c}' AS dimension, CAST({c} AS DOUBLE) AS score FROM scorecard" for c in r.SCORE_COLUMNS)
    + f") SELECT table_name, dimension, round(score, 9) AS score, {_COLOR} AS color FROM long"))
def _(spark, sf):
    return r.score_matrix(stages(spark, sf).assessment().scorecard).withColumn("score", F.round("score", 9))


def _with_missing_summary(body: str) -> str:
    return with_missing("," + missing_summary_definition() + body)


@query("rp_null_class", _with_missing_summary("""
SELECT 'Explained null' AS null_class, CAST(sum(explained_null_count) AS BIGINT) AS missing_values FROM missing_summary
UNION ALL SELECT 'Suspicious null', CAST(sum(suspicious_null_count) AS BIGINT) FROM missing_summary"""))
def _(spark, sf):
    return r.totals_by_class(stages(spark, sf).missing_summary())


_AREA_LABEL = {a: a.replace("_INFORMATION", "").replace("_", " ").title() for a in AREAS}
_AREA_TOTALS = "area_totals AS (" + " UNION ALL ".join(
    f"SELECT '{_AREA_LABEL[a]}' AS information_area, '{a}' AS area, CAST(sum({a.lower()}_count) AS BIGINT) AS missing_values FROM missing_summary" for a in AREAS) + ")"


@query("rp_area", _with_missing_summary(f",\n{_AREA_TOTALS} SELECT information_area, missing_values FROM area_totals WHERE missing_values > 0"))
def _(spark, sf):
    return r.totals_by_area(stages(spark, sf).missing_summary())


@query("rp_outliers", with_outliers("""
SELECT metric, CAST(sum(consensus_outliers) AS BIGINT) AS consensus_outliers FROM outlier_summary WHERE status = 'completed' GROUP BY 1"""))
def _(spark, sf):
    return r.outliers_by_metric(stages(spark, sf).outliers().summary)


@query("rp_outlier_rate", with_outliers("""
SELECT metric, CAST(sum(tested_values) AS BIGINT) AS tested_values, CAST(sum(consensus_outliers) AS BIGINT) AS consensus_outliers,
       round(coalesce(sum(consensus_outliers) / nullif(sum(tested_values), 0) * 100, 0), 9) AS consensus_outlier_rate FROM outlier_summary WHERE status = 'completed' GROUP BY 1"""))
def _(spark, sf):
    return r.outlier_rates(stages(spark, sf).outliers().summary).withColumn("consensus_outlier_rate", F.round("consensus_outlier_rate", 9))


@query("rp_methods", with_outliers("""
SELECT metric, CAST(sum(iqr_outliers) AS BIGINT) AS iqr_outliers, CAST(sum(modified_z_outliers) AS BIGINT) AS modified_z_outliers,
       CAST(sum(consensus_outliers) AS BIGINT) AS consensus_outliers FROM outlier_summary WHERE status = 'completed' GROUP BY 1"""))
def _(spark, sf):
    return r.methods_by_metric(stages(spark, sf).outliers().summary)


def _with_everything(body: str) -> str:
    return with_quality(
        "," + scorecard_sql() + "," + missing_definitions() + "," + missing_summary_definition() + "," + outlier_definitions() + body)


@query("rp_kpis", _with_everything(f""",
{_AREA_TOTALS}, metrics AS (SELECT metric, sum(consensus_outliers) AS n FROM outlier_summary WHERE status = 'completed' GROUP BY 1)
SELECT (SELECT count(*) FROM scorecard) AS tables_assessed, (SELECT round(avg(overall_score), 6) FROM scorecard) AS average_score,
  (SELECT table_name FROM scorecard ORDER BY overall_score, table_name LIMIT 1) AS worst_table, (SELECT count(*) FROM issues) AS issues,
  (SELECT CAST(sum(missing_count) AS BIGINT) FROM missing_summary) AS missing_values, (SELECT CAST(sum(suspicious_null_count) AS BIGINT) FROM missing_summary) AS suspicious_nulls,
  (SELECT information_area FROM area_totals ORDER BY missing_values DESC, area LIMIT 1) AS top_missing_area, (SELECT CAST(sum(n) AS BIGINT) FROM metrics) AS consensus_outliers,
  (SELECT metric FROM metrics ORDER BY n DESC, metric LIMIT 1) AS top_outlier_metric"""))
def _(spark, sf):
    st = stages(spark, sf)
    return r.indicator_cards(st.assessment().scorecard, st.assessment().issues, st.missing_summary(), st.outliers().summary)


# --- report sections, flattened to (section, label, number) --------------------------------------------------------


def _flat(sections, picks):
    out = None
    for name, label, value in picks:
        labels = label if isinstance(label, (list, tuple)) else [label]
        df = sections[name].select(
            F.lit(name).alias("section"), F.concat_ws("|", *[F.col(x).cast("string") for x in labels]).alias("label"),
            F.col(value).cast("double").alias("number"))
        out = df if out is None else out.unionByName(df)
    return out


def _totals(df, section):
    long = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns]).unpivot([], df.columns, "label", "number")
    return long.select(F.lit(section).alias("section"), "label", "number")


def _sql(section, label, number, source, tail=""):
    return f"SELECT '{section}' AS section, {label} AS label, CAST({number} AS DOUBLE) AS number FROM {source} {tail}"


def _top(section, label, number, source, order, limit):
    return f"SELECT '{section}', label, CAST(number AS DOUBLE) FROM (SELECT {label} AS label, {number} AS number FROM {source} ORDER BY {order} LIMIT {limit})"


@query("sum_general", _with_card("\n" + " UNION ALL ".join([
    _sql("totals", "'num_tables_assessed'", "count(*)", "scorecard"),
    _sql("totals", "'average_overall_score'", "round(avg(overall_score), 6)", "scorecard"),
    _sql("totals", "'num_checks'", "count(*)", "checks"), _sql("totals", "'num_issues'", "count(*)", "issues"),
    _top("worst_tables", "table_name", "overall_score", "scorecard", "overall_score, table_name", 5),
    _top("best_tables", "table_name", "overall_score", "scorecard", "overall_score DESC, table_name", 5),
    _top("failed_or_warning_checks", "concat_ws('|', table_name, check_id)", "score", "checks WHERE status IN ('red', 'yellow')",
         "status DESC, score, table_name, check_id", 30),
    _sql("check_status_by_dimension", "concat_ws('|', dimension, status)", "count(*)", "checks", "GROUP BY dimension, status"),
    _sql("issues_by_table", "table_name", "count(*)", "issues", "GROUP BY table_name"),
    _sql("issues_by_dimension", "dimension", "count(*)", "issues", "GROUP BY dimension"),
    _top("referential_integrity_issues", "check_id", "n", "(SELECT check_id, count(*) AS n FROM issues WHERE dimension = 'Referential Integrity' GROUP BY 1)",
         "n DESC, check_id", 20)])))
def _(spark, sf):
    a = stages(spark, sf).assessment()
    s = r.general_sections(a.scorecard, a.check_results, a.issues)
    return _totals(s["totals"], "totals").unionByName(_flat(s, [
        ("worst_tables", "table_name", "overall_score"), ("best_tables", "table_name", "overall_score"),
        ("failed_or_warning_checks", ("table_name", "check_id"), "score"), ("check_status_by_dimension", ("dimension", "status"), "num_checks"),
        ("issues_by_table", "table_name", "num_issues"), ("issues_by_dimension", "dimension", "num_issues"),
        ("referential_integrity_issues", "check_id", "num_issues")]))


_PATTERN = "table_name, column_name, missing_class, missing_information_area, severity"


@query("sum_missing", _with_missing_summary(f",\n{_AREA_TOTALS} " + " UNION ALL ".join([
    _sql("totals", "'num_missing_summary_rows'", "count(*)", "missing_summary"), _sql("totals", "'total_missing_values'", "sum(missing_count)", "missing_summary"),
    _sql("totals", "'total_explained_nulls'", "sum(explained_null_count)", "missing_summary"),
    _sql("totals", "'total_suspicious_nulls'", "sum(suspicious_null_count)", "missing_summary"), _sql("totals", "'num_missing_row_flags'", "count(*)", "missing"),
    _top("summary_rows", "concat_ws('|', table_name, column_name)", "missing_count", "missing_summary", "suspicious_null_count DESC, missing_count DESC, table_name, column_name", 30),
    _sql("missing_by_table", "table_name", "sum(suspicious_null_count)", "missing_summary", "GROUP BY table_name"),
    _sql("missing_by_information_area", "area", "missing_values", "area_totals", "WHERE missing_values > 0"),
    _sql("missing_by_severity", "severity", "count(*)", "missing", "GROUP BY severity"),
    _top("critical_missing_patterns", f"concat_ws('|', {_PATTERN})", "n", f"(SELECT {_PATTERN}, count(*) AS n FROM missing GROUP BY ALL)",
         f"CASE severity WHEN 'red' THEN 0 WHEN 'yellow' THEN 1 WHEN 'green' THEN 2 ELSE 9 END, n DESC, {_PATTERN}", 30)])))
def _(spark, sf):
    st = stages(spark, sf)
    s = r.missing_sections(st.missing_summary(), st.missing())
    return _totals(s["totals"], "totals").unionByName(_flat(s, [
        ("summary_rows", ("table_name", "column_name"), "missing_count"), ("missing_by_table", "table_name", "suspicious_null_count"),
        ("missing_by_information_area", "missing_information_area", "missing_count"), ("missing_by_severity", "severity", "num_flags"),
        ("critical_missing_patterns", _PATTERN.split(", "), "num_flags")]))


@query("sum_outliers", with_outliers("\n" + " UNION ALL ".join([
    _sql("totals", "'num_outlier_summary_rows'", "count(*)", "outlier_summary"),
    *[_sql("totals", f"'total_{n}'", f"sum({n})", "outlier_summary") for n in ("tested_values", "iqr_outliers", "modified_z_outliers", "consensus_outliers")],
    _sql("totals", "'num_outlier_row_flags'", "count(*)", "outliers"), _sql("totals", "'strong_consensus_flag_count'", "count(*) FILTER (WHERE consensus_score = 2)", "outliers"),
    _sql("totals", "'weak_anomaly_flag_count'", "count(*) FILTER (WHERE consensus_score = 1)", "outliers"),
    _top("summary_rows", "concat_ws('|', CAST(session_id AS VARCHAR), metric)", "consensus_outliers", "outlier_summary",
         "consensus_outliers DESC, modified_z_outliers DESC, iqr_outliers DESC, session_id, metric", 40),
    _sql("outliers_by_metric", "metric", "sum(modified_z_outliers)", "outlier_summary", "GROUP BY metric"),
    _top("top_outlier_sessions", "concat_ws('|', CAST(session_id AS VARCHAR), metric)", "consensus_outliers", "outlier_summary", "consensus_outliers DESC, session_id, metric", 40),
    _sql("outlier_flags_by_interpretation", "interpretation", "count(*)", "outliers", "GROUP BY interpretation"),
    _sql("strong_consensus_by_metric", "metric", "count(*)", "outliers", "WHERE consensus_score >= 2 GROUP BY metric"),
    _top("sample_strong_consensus_outliers", "concat_ws('|', metric, row_identifier)", "round(value, 9)", "outliers WHERE consensus_score >= 2", "consensus_score DESC, metric, row_identifier", 30)])))
def _(spark, sf):
    o = stages(spark, sf).outliers()
    s = r.outlier_sections(o.summary, o.flags)
    return _totals(s["totals"], "totals").unionByName(_flat(s, [
        ("summary_rows", ("session_id", "metric"), "consensus_outliers"), ("outliers_by_metric", "metric", "modified_z_outliers"),
        ("top_outlier_sessions", ("session_id", "metric"), "consensus_outliers"), ("outlier_flags_by_interpretation", "interpretation", "num_flags"),
        ("strong_consensus_by_metric", "metric", "num_strong_consensus_flags"), ("sample_strong_consensus_outliers", ("metric", "row_identifier"), "value")]))


_DOCUMENT = {
    "general_dqa": {"num_tables_assessed": "SELECT count(*) FROM scorecard", "average_overall_score": "SELECT round(avg(overall_score), 6) FROM scorecard",
                    "num_checks": "SELECT count(*) FROM checks", "num_issues": "SELECT count(*) FROM issues"},
    "focused_missing_values": {"total_missing_values": "SELECT sum(missing_count) FROM missing_summary", "num_missing_row_flags": "SELECT count(*) FROM missing",
                               "total_suspicious_nulls": "SELECT sum(suspicious_null_count) FROM missing_summary"},
    "focused_outlier_detection": {"total_tested_values": "SELECT sum(tested_values) FROM outlier_summary", "num_outlier_row_flags": "SELECT count(*) FROM outliers",
                                  "strong_consensus_flag_count": "SELECT count(*) FROM outliers WHERE consensus_score = 2"},
}
_LISTS = {
    "general_dqa": {"scorecard_by_table": "SELECT count(*) FROM scorecard", "issues_by_table": "SELECT count(DISTINCT table_name) FROM issues"},
    "focused_missing_values": {"missing_by_severity": "SELECT count(DISTINCT severity) FROM missing"},
    "focused_outlier_detection": {"outliers_by_metric": "SELECT count(DISTINCT metric) FROM outlier_summary"},
}


@query("sum_document", with_quality(f",{scorecard_sql()},{missing_definitions()},{missing_summary_definition()},{outlier_definitions()}\n" + " UNION ALL ".join(
    f"SELECT '{part}' AS part, '{name}' AS name, CAST(({sql}) AS DOUBLE) AS number"
    for found in (_DOCUMENT, _LISTS) for part, names in found.items() for name, sql in names.items())))
def _(spark, sf):
    """Fields of the JSON document, parsed again."""
    document = _document(spark, sf)
    totals = [(p, n, F.get_json_object("document", f"$.{p}.totals[0].{n}")) for p, names in _DOCUMENT.items() for n in names]
    lists = [(p, n, F.json_array_length(F.get_json_object("document", f"$.{p}.{n}"))) for p, names in _LISTS.items() for n in names]
    rows = [F.struct(F.lit(p).alias("part"), F.lit(n).alias("name"), v.cast("double").alias("number")) for p, n, v in (*totals, *lists)]
    return document.select(F.inline(F.array(*rows)))


def _document(spark, sf):
    st = stages(spark, sf)
    a, o = st.assessment(), st.outliers()
    return r.report_document({
        "general_dqa": r.general_sections(a.scorecard, a.check_results, a.issues),
        "focused_missing_values": r.missing_sections(st.missing_summary(), st.missing()),
        "focused_outlier_detection": r.outlier_sections(o.summary, o.flags),
    })


# --- star queries --------------------------------------------------------------------------------------------------


def _star(spark, sf):
    w = stages(spark, sf).warehouse()
    return w.fact_lap_performance, w.fact_session_result, w.dimensions


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 9) for n in names})


@query("bq_cumulative_gap", with_star(""",
p AS (SELECT season_year, round_number, team_id, sum(points) AS points FROM fact_session_result JOIN dim_grand_prix USING (grand_prix_id) WHERE session_type = 'R' GROUP BY ALL),
g AS (SELECT season_year, round_number, team_id, sum(coalesce(points, 0)) OVER (PARTITION BY season_year, team_id ORDER BY round_number) AS c
      FROM (SELECT DISTINCT season_year, round_number FROM p) r JOIN (SELECT DISTINCT season_year, team_id FROM p) t USING (season_year) LEFT JOIN p USING (season_year, round_number, team_id))
SELECT season_year, round_number, team_id, round(c, 9) AS cumulative_points, round(max(c) OVER (PARTITION BY season_year, round_number) - c, 9) AS gap_to_leader FROM g"""))
def _(spark, sf):
    _, results, dims = _star(spark, sf)
    return _rounded(b.points_gap(results, dims["dim_grand_prix"]), "cumulative_points", "gap_to_leader")


@query("bq_standings", with_star(""",
s AS (SELECT season_year, team_id, coalesce(sum(points) FILTER (WHERE session_type = 'R'), 0) AS points, count(*) FILTER (WHERE session_type = 'R' AND position = 1) AS wins,
      count(*) FILTER (WHERE session_type = 'Q' AND position = 1) AS poles FROM fact_session_result JOIN dim_grand_prix USING (grand_prix_id) GROUP BY 1, 2)
SELECT *, rank() OVER (PARTITION BY season_year ORDER BY points DESC) AS place FROM s"""))
def _(spark, sf):
    _, results, dims = _star(spark, sf)
    return b.standings(results, dims["dim_grand_prix"])


@query("bq_conversion", with_star(""",
k AS (SELECT grand_prix_id, driver_id, team_id, min(position) FILTER (WHERE session_type = 'Q') AS q, min(position) FILTER (WHERE session_type = 'R') AS r FROM fact_session_result GROUP BY ALL)
SELECT team_id, count(*) AS starts, round(avg(CAST(r <= q AS INT)), 9) AS conversion, round(avg(q - r), 9) AS mean_places_gained, round(stddev_samp(r), 9) AS race_consistency,
       round(stddev_samp(q), 9) AS qualifying_consistency FROM k WHERE q IS NOT NULL AND r IS NOT NULL GROUP BY 1"""))
def _(spark, sf):
    _, results, _ = _star(spark, sf)
    return _rounded(b.qualifying_to_race(results), "conversion", "mean_places_gained", "race_consistency", "qualifying_consistency")


@query("bq_position_gap", with_star("""
SELECT grand_prix_id, session_type, min(position) FILTER (WHERE team_id = 't1') AS best_a, min(position) FILTER (WHERE team_id = 't2') AS best_b,
       min(position) FILTER (WHERE team_id = 't1') - min(position) FILTER (WHERE team_id = 't2') AS gap FROM fact_session_result WHERE team_id IN ('t1', 't2') GROUP BY 1, 2"""))
def _(spark, sf):
    _, results, _ = _star(spark, sf)
    return b.best_position_gap(results, "t1", "t2")


@query("bq_tyre", with_star("""
SELECT compound, starting_tyre_set_status, tyre_life_class, team_id, count(lap_time_ms) AS timed_laps, round(avg(lap_time_ms), 9) AS avg_lap_ms, min(lap_time_ms) AS min_lap_ms,
       max(lap_time_ms) AS max_lap_ms, round(avg(sector1_time_ms), 9) AS avg_sector1_ms, round(avg(sector2_time_ms), 9) AS avg_sector2_ms, round(avg(sector3_time_ms), 9) AS avg_sector3_ms,
       max(speed_st) AS max_speed_st FROM fact_lap_performance JOIN dim_tyre_context USING (tyre_context_key) GROUP BY 1, 2, 3, 4"""))
def _(spark, sf):
    laps, _, dims = _star(spark, sf)
    return _rounded(b.tyre_performance(laps, dims["dim_tyre_context"]), "avg_lap_ms", *[f"avg_sector{i}_ms" for i in (1, 2, 3)])


@query("bq_circuit", with_star(""",
t AS (SELECT grand_prix_id, team_id, avg(lap_time_ms) AS m FROM fact_lap_performance WHERE lap_time_ms IS NOT NULL GROUP BY 1, 2),
g AS (SELECT *, (m - min(m) OVER (PARTITION BY grand_prix_id)) / min(m) OVER (PARTITION BY grand_prix_id) AS gap FROM t)
SELECT global_circuit_category, team_id, round(avg(gap), 9) AS mean_relative_gap, count(*) AS events FROM g JOIN dim_grand_prix USING (grand_prix_id) GROUP BY 1, 2"""))
def _(spark, sf):
    laps, _, dims = _star(spark, sf)
    return _rounded(b.gap_by_circuit(laps, dims["dim_grand_prix"]), "mean_relative_gap")


@query("bq_sector", with_star(""",
l AS (""" + " UNION ALL ".join(
    f"SELECT f.grand_prix_id, team_id, {i} AS sector, sector{i}_category AS sector_category, avg(sector{i}_time_ms) AS m FROM fact_lap_performance f JOIN dim_grand_prix USING (grand_prix_id) GROUP BY ALL"
    for i in (1, 2, 3)) + """),
g AS (SELECT *, (m - min(m) OVER w) / min(m) OVER w AS gap FROM l WHERE m IS NOT NULL WINDOW w AS (PARTITION BY grand_prix_id, sector))
SELECT sector_category, team_id, round(avg(gap), 9) AS mean_relative_gap, count(*) AS sectors FROM g GROUP BY 1, 2"""))
def _(spark, sf):
    laps, _, dims = _star(spark, sf)
    return _rounded(b.gap_by_sector(laps, dims["dim_grand_prix"]), "mean_relative_gap")


def _mean(column, year):
    return f"avg({column}) FILTER (WHERE season_year = {year})"


@query("bq_yoy", with_star(f"""
SELECT team_id, session_type, round({_mean('position', 2021)}, 9) AS position_first, round({_mean('position', 2022)}, 9) AS position_second, round({_mean('points', 2021)}, 9) AS points_first,
       round({_mean('points', 2022)}, 9) AS points_second, round({_mean('position', 2022)} - {_mean('position', 2021)}, 9) AS position_change, round({_mean('points', 2022)} - {_mean('points', 2021)}, 9) AS points_change
FROM fact_session_result JOIN dim_grand_prix USING (grand_prix_id) GROUP BY 1, 2"""))
def _(spark, sf):
    _, results, dims = _star(spark, sf)
    out = b.season_change(results, dims["dim_grand_prix"], 2021, 2022)
    return _rounded(out, *[c for c in out.columns if c not in ("team_id", "session_type")])


@query("bq_reliability", with_star(""",
c AS (SELECT season_year, team_id, result_status_category, count(*) AS results FROM fact_session_result JOIN dim_result_outcome USING (result_outcome_key) JOIN dim_grand_prix USING (grand_prix_id)
      WHERE session_type = 'R' GROUP BY 1, 2, 3)
SELECT *, round(results / sum(results) OVER (PARTITION BY season_year, team_id), 9) AS share FROM c"""))
def _(spark, sf):
    _, results, dims = _star(spark, sf)
    return _rounded(b.reliability(results, dims["dim_result_outcome"], dims["dim_grand_prix"]), "share")


@query("bq_measures", with_star("""
SELECT team_id, session_type, round(sum(points), 9) AS sum_points, round(avg(points), 9) AS avg_points, min(position) AS min_position, max(grid_position) AS max_grid_position,
       round(avg(q1_ms), 9) AS avg_q1_ms, CAST(sum(laps) AS BIGINT) AS sum_laps FROM fact_session_result GROUP BY 1, 2"""))
def _(spark, sf):
    _, results, _ = _star(spark, sf)
    wanted = b.measures(("points", "sum"), ("points", "avg"), ("position", "min"), ("grid_position", "max"), ("q1_ms", "avg"), ("laps", "sum"))
    return _rounded(results.groupBy("team_id", "session_type").agg(*wanted), "sum_points", "avg_points", "avg_q1_ms")


@query("bq_quality_filter", with_star("""
SELECT f.* FROM fact_lap_performance f WHERE lap_data_quality_key IN (SELECT lap_data_quality_key FROM dim_lap_data_quality WHERE NOT has_tyre_information_issue AND NOT has_sector_information_issue)"""))
def _(spark, sf):
    laps, _, dims = _star(spark, sf)
    flags = ["has_tyre_information_issue", "has_sector_information_issue"]
    return b.without_issues(laps, dims["dim_lap_data_quality"], "dim_lap_data_quality", flags).select(*laps.columns)


@query("bq_scope_filter", with_star("""
SELECT f.* FROM fact_lap_performance f JOIN dim_lap_weather_context USING (lap_weather_context_key) JOIN dim_tyre_context USING (tyre_context_key)
WHERE session_type = 'R' AND NOT rain_flag AND compound IN ('SOFT', 'MEDIUM', 'HARD') AND team_id IN ('t1', 't2', 't3')"""))
def _(spark, sf):
    laps, _, dims = _star(spark, sf)
    return b.analysis_scope(laps, dims["dim_lap_weather_context"], dims["dim_tyre_context"], ["t1", "t2", "t3"]).select(*laps.columns)


# --- the whole batch -----------------------------------------------------------------------------------------------

_OUTPUTS = {
    "quality/check_results": "checks", "quality/issues": "issues", "missing/flags": "missing", "outliers/flags": "outliers",
    "outliers/summary": "outlier_summary", "cleaning/actions": "actions", "cleaning/rejected": "drops", "clean/lap": "c_lap", "clean/session": "c_session",
    "star/fact_lap_performance": "fact_lap_performance", "star/fact_session_result": "fact_session_result", "star/dim_tyre_context": "dim_tyre_context",
    "star/dim_lap_data_quality": "dim_lap_data_quality",
}


@query("batch_run", with_star("\n" + " UNION ALL ".join(f"SELECT '{name}' AS output, count(*) AS row_count FROM {source}" for name, source in _OUTPUTS.items())
       + " UNION ALL SELECT 'report', 1 UNION ALL SELECT 'star/validation', 1"))
def _(spark, sf):
    """A raw layer is written, the batch runs over it, and every output is read back."""
    shared_folder(spark)
    source, target = fresh_path(configure(spark), "batch-source"), fresh_path(spark, "batch-target")
    refresh_files(spark, tables(spark, sf), source)
    sizes = batch.sizes(spark, batch.run(spark, source, target))
    return sizes.where(F.col("output").isin(*_OUTPUTS, "report", "star/validation"))
