"""Warehouse operators: classes, as-of context, dimensions, facts and their validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from contract import sql_warehouse as w
from contract.registry import query, stages
from contract.views import base, sql_views, table, with_views
from starq.functions import scalars as c
from starq.operators.asof import Context, asof_join
from starq.operators.domains import junk_keys
from starq.operators.joins import enrich
from starq.plans import validation, warehouse


@query("dw_context", with_views("lap session grand_prix", """
SELECT l.lap_id, s.grand_prix_id, s.session_type, g.season_year, g.round_number, g.event_name FROM v_lap l LEFT JOIN v_session s USING (session_id) LEFT JOIN v_grand_prix g USING (grand_prix_id)"""))
def _(spark, sf):
    lap, session, gp = (table(spark, sf, t) for t in ("lap", "session", "grand_prix"))
    return warehouse.with_event_context(lap.select("lap_id", "session_id"), session, gp).select(
        "lap_id", "grand_prix_id", "session_type", "season_year", "round_number", "event_name")


@query("dw_composite_id", with_views("lap", """
SELECT lap_id, 'lap_' || session_id || '_' || coalesce(driver_id, 'unknown') || '_' || lap_number AS composite_id FROM v_lap"""))
def _(spark, sf):
    parts = [F.col(n) for n in ("session_id", "driver_id", "lap_number")]
    return table(spark, sf, "lap").select("lap_id", c.composite_id("lap", *parts).alias("composite_id"))


@query("cls_thresholds", with_views("weather", f"""
SELECT weather_id, {w.level('air_temp', 20, 28)} AS air, {w.level('track_temp', 30, 42)} AS track, {w.level('wind_speed', 2, 5)} AS wind FROM v_weather"""))
def _(spark, sf):
    return table(spark, sf, "weather").select(
        "weather_id", c.air_temp_class(F.col("air_temp")).alias("air"), c.track_temp_class(F.col("track_temp")).alias("track"),
        c.wind_speed_class(F.col("wind_speed")).alias("wind"))


@query("cls_lap_type", with_views("lap", f"SELECT lap_id, {w.LAP_TYPE} AS lap_type FROM v_lap"))
def _(spark, sf):
    return table(spark, sf, "lap").select("lap_id", c.lap_type(F.col("pit_out_time_ms"), F.col("pit_in_time_ms")).alias("lap_type"))


@query("cls_tyre_set", with_views("lap", f"SELECT lap_id, {w.tyre_set()} AS tyre_set FROM v_lap"))
def _(spark, sf):
    return table(spark, sf, "lap").select("lap_id", c.tyre_set_status(F.col("fresh_tyre")).alias("tyre_set"))


@query("cls_tyre_life", with_views("lap", f"SELECT lap_id, {w.tyre_life()} AS tyre_life_class FROM v_lap"))
def _(spark, sf):
    return table(spark, sf, "lap").select("lap_id", c.tyre_life_class(F.col("tyre_life")).alias("tyre_life_class"))


_BORN = "CAST(o_orderdate AS DATE) - 2000 + CAST(o_orderkey % 4000 AS INT) * 2"


@query("cls_age", f"""
SELECT o_orderkey, CASE WHEN born IS NULL OR born > DATE '2022-01-01' THEN 'Unknown' WHEN floor((DATE '2022-01-01' - born) / 365.2425) < 25 THEN 'Young'
 WHEN floor((DATE '2022-01-01' - born) / 365.2425) < 30 THEN 'Intermediate' ELSE 'Senior' END AS age_class
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN {_BORN} END AS born FROM orders)""")
def _(spark, sf):
    born = f"case when o_orderkey % 50 <> 0 then {_BORN} end as born"
    return base(spark, sf, "orders").selectExpr("o_orderkey", born).select("o_orderkey", c.age_class(F.col("born")).alias("age_class"))


@query("cls_track_status", with_views("track_status", f"""
SELECT track_status_id, {w.track_category('message', 'status')} AS by_message, {w.track_category("CASE WHEN track_status_id % 3 = 0 THEN 'VSC Ending' WHEN track_status_id % 3 = 1 THEN ' SCDeployed ' END", "CAST(NULL AS VARCHAR)").replace("'%vscending%'", "'%vsc ending%'")} AS by_text
FROM v_track_status"""))
def _(spark, sf):
    text = F.expr("case track_status_id % 3 when 0 then 'VSC Ending' when 1 then ' SCDeployed ' end")
    return table(spark, sf, "track_status").select(
        "track_status_id", c.track_status_category(F.col("message"), F.col("status")).alias("by_message"),
        c.track_status_category(text, F.lit(None).cast("string")).alias("by_text"))


@query("cls_classification", with_views("result", f"SELECT result_id, {w.classification()} AS category FROM v_result"))
def _(spark, sf):
    return table(spark, sf, "result").select("result_id", c.classification_category(F.col("classified_position")).alias("category"))


@query("cls_status", with_views("result", f"SELECT result_id, {w.outcome()} AS category FROM v_result"))
def _(spark, sf):
    return table(spark, sf, "result").select("result_id", c.status_category(F.col("status")).alias("category"))


@query("gap_to_leader", with_views("result session", f"""
SELECT result_id, {w.GAP.replace("session_type =", "upper(session_type) =")} AS gap_to_leader_ms FROM v_result LEFT JOIN v_session USING (session_id)"""))
def _(spark, sf):
    joined = enrich(table(spark, sf, "result"), table(spark, sf, "session").select("session_id", "session_type"), ["session_id"])
    gap = c.gap_to_leader_ms(F.col("session_type"), F.col("position"), F.col("status"), F.col("time_ms"))
    return joined.select("result_id", gap.alias("gap_to_leader_ms"))


_ASOF = with_views("lap weather", w.asof("v_lap", "lap_id", "v_weather", "weather_id", {**w.WEATHER, "weather_id": "weather_id"}, "j") + """
SELECT lap_id, weather_id, weather_time_ms, round(air_temp, 9) AS air_temp FROM j""")


def _asof(spark, sf, **options):
    context = Context(table(spark, sf, "weather"), "time_ms",
                      {"time_ms": "weather_time_ms", "weather_id": "weather_id", "air_temp": "air_temp"}, tie="weather_id")
    lap = table(spark, sf, "lap").select("lap_id", "session_id", "lap_start_time_ms")
    joined = asof_join(lap, ["session_id"], "lap_start_time_ms", [context], **options)
    return joined.select("lap_id", "weather_id", "weather_time_ms", F.round("air_temp", 9).alias("air_temp"))


@query("asof_context", _ASOF)
def _(spark, sf):
    return _asof(spark, sf)


# Every session of more than ten rows is cut, as the hot ones are on large data.
@query("asof_context_hot", _ASOF)
def _(spark, sf):
    return _asof(spark, sf, limit=10)


def _lap_context(spark, sf):
    lap = table(spark, sf, "lap").select("lap_id", "session_id", "lap_start_time_ms")
    return warehouse.with_lap_context(lap, table(spark, sf, "weather"), table(spark, sf, "track_status"))


@query("lap_weather", with_views("lap weather", w.asof("v_lap", "lap_id", "v_weather", "weather_id", w.WEATHER, "j") + f"""
SELECT lap_id, rainfall AS rain_flag, {w.level('air_temp', 20, 28)} AS air_temp_class, {w.level('track_temp', 30, 42)} AS track_temp_class, {w.level('wind_speed', 2, 5)} AS wind_speed_class,
       weather_time_ms IS NULL AS has_weather_information_issue FROM j"""))
def _(spark, sf):
    return _lap_context(spark, sf).select(
        "lap_id", "rain_flag", "air_temp_class", "track_temp_class", "wind_speed_class", "has_weather_information_issue")


@query("lap_track_status", with_views("lap track_status", w.asof("v_lap", "lap_id", "v_track_status", "track_status_id", w.TRACK, "j") + f"""
SELECT lap_id, {w.track_category('track_message', 'track_code')} AS track_status_category, track_status_time_ms IS NULL AS has_track_status_information_issue FROM j"""))
def _(spark, sf):
    return _lap_context(spark, sf).select("lap_id", "track_status_category", "has_track_status_information_issue")


@query("session_weather", with_views("weather", f"""
w AS ({w.session_weather('v_weather')}) SELECT session_id, rain_flag, round(avg_air_temp, 9) AS avg_air_temp, round(avg_track_temp, 9) AS avg_track_temp, round(avg_wind_speed, 9) AS avg_wind_speed,
 {w.level('avg_air_temp', 20, 28)} AS avg_air_temp_class, {w.level('avg_track_temp', 30, 42)} AS avg_track_temp_class, {w.level('avg_wind_speed', 2, 5)} AS avg_wind_speed_class FROM w"""))
def _(spark, sf):
    averages = ("avg_air_temp", "avg_track_temp", "avg_wind_speed")
    return warehouse.session_weather(table(spark, sf, "weather")).withColumns({n: F.round(n, 9) for n in averages})


# --- dimensions ----------------------------------------------------------------------------------------------------


@query("dim_simple", """
SELECT c_mktsegment AS team_id, min(c_name) AS team_name, arg_min(CAST(c_nationkey AS VARCHAR), c_name) AS nationality FROM customer GROUP BY 1""")
def _(spark, sf):
    rows = base(spark, sf, "customer").selectExpr("c_mktsegment as team_id", "c_name as team_name", "cast(c_nationkey as string) as nationality")
    return warehouse.dim_team(rows)


@query("dim_people", w.with_star("\nSELECT * FROM dim_driver"))
def _(spark, sf):
    return stages(spark, sf).warehouse().dimensions["dim_driver"]


@query("dim_hierarchy", with_views("season circuit session", """
SELECT 'season' AS dim, CAST(season_year AS VARCHAR) AS k, champion_driver AS a, CAST(number_of_events AS VARCHAR) AS b FROM v_season
UNION ALL SELECT 'circuit', circuit_id, location, sector1_category FROM v_circuit
UNION ALL SELECT 'session', CAST(session_id AS VARCHAR), session_type, CAST(grand_prix_id AS VARCHAR) FROM v_session"""))
def _(spark, sf):
    season, circuit, session, gp = (table(spark, sf, t) for t in ("season", "circuit", "session", "grand_prix"))
    frames = [
        warehouse.dim_season(season).selectExpr("'season' as dim", "cast(season_year as string) as k", "champion_driver as a", "cast(number_of_events as string) as b"),
        warehouse.dim_circuit(circuit).selectExpr("'circuit' as dim", "circuit_id as k", "location as a", "sector1_category as b"),
        warehouse.dim_session(session, gp).selectExpr("'session' as dim", "cast(session_id as string) as k", "session_type as a", "cast(grand_prix_id as string) as b"),
    ]
    return reduce(DataFrame.unionByName, frames)


@query("dim_flattened", with_views("grand_prix circuit", """
SELECT grand_prix_id, season_year, round_number, g.circuit_id, event_name, event_date, event_format, circuit_name, g.country, g.location, global_circuit_category,
       sector1_category, sector2_category, sector3_category FROM v_grand_prix g LEFT JOIN v_circuit c USING (circuit_id)"""))
def _(spark, sf):
    return warehouse.dim_grand_prix(table(spark, sf, "grand_prix"), table(spark, sf, "circuit"))


_MIX = "SELECT coalesce(CASE WHEN l_quantity < 40 THEN l_returnflag END, 'Unknown') AS returned, l_linestatus AS status, coalesce(CASE WHEN l_linenumber < 6 THEN l_linenumber > 3 END, false) AS has_many FROM lineitem"


def _mix(spark, sf):
    return base(spark, sf, "lineitem").selectExpr(
        "case when l_quantity < 40 then l_returnflag end as returned", "l_linestatus as status",
        "case when l_linenumber < 6 then l_linenumber > 3 end as has_many")


@query("dim_junk", f"SELECT row_number() OVER (ORDER BY returned, status, has_many) AS mix_key, * FROM (SELECT DISTINCT * FROM ({_MIX}))")
def _(spark, sf):
    return warehouse.context_dimension(_mix(spark, sf), ["returned", "status", "has_many"], "mix_key")


_JUNK = " UNION ALL ".join(
    f"SELECT '{n}' AS dim, CAST({k} AS BIGINT) AS k, concat_ws('|', {', '.join(f'CAST({x} AS VARCHAR)' for x in a)}) AS attributes FROM {n}"
    for n, (k, a, _) in w.CONTEXT.items())


@query("dim_junk_all", w.with_star("\n" + _JUNK))
def _(spark, sf):
    dims = stages(spark, sf).warehouse().dimensions
    frames = [
        dims[n].select(F.lit(n).alias("dim"), F.col(k).alias("k"), F.concat_ws("|", *[F.col(x).cast("string") for x in a]).alias("attributes"))
        for n, (k, a) in warehouse.CONTEXT_DIMENSIONS.items()]
    return reduce(DataFrame.unionByName, frames)


@query("map_dim_key", f"""
WITH m AS ({_MIX}), d AS (SELECT row_number() OVER (ORDER BY returned, status, has_many) AS mix_key, * FROM (SELECT DISTINCT * FROM m))
SELECT mix_key, count(*) AS n_lines FROM m JOIN d USING (returned, status, has_many) GROUP BY 1""")
def _(spark, sf):
    attributes = ["returned", "status", "has_many"]
    rows = warehouse.boolean_flags(warehouse.unknown_filled(_mix(spark, sf), ["returned", "status"]), ["has_many"])
    dim = warehouse.context_dimension(rows, attributes, "mix_key")
    return warehouse.with_dimension_key(rows, dim, attributes, "mix_key").groupBy("mix_key").agg(F.count("*").alias("n_lines"))


@query("map_dim_key_bitmap", f"""
WITH m AS ({_MIX}), d AS (SELECT row_number() OVER (ORDER BY returned, status, has_many) AS mix_key, * FROM (SELECT DISTINCT * FROM m))
SELECT mix_key, returned, status, has_many, count(*) AS n_lines FROM m JOIN d USING (returned, status, has_many) GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    """Keys as ranks in the bitmap of the domains' product; the dimension is read off the same bitmap."""
    attributes = ["returned", "status", "has_many"]
    rows = warehouse.boolean_flags(warehouse.unknown_filled(_mix(spark, sf), ["returned", "status"]), ["has_many"])
    junk = junk_keys(rows, {"mix": ("mix_key", attributes)})["mix"]
    counts = rows.select(junk.key().alias("mix_key")).groupBy("mix_key").agg(F.count("*").alias("n_lines"))
    return junk.dimension(spark).join(counts, "mix_key")


@query("fill_unknown", with_views("lap", """
SELECT lap_id, coalesce(compound, 'Unknown') AS compound, 'Unknown' AS lap_type, coalesce(lower(fresh_tyre) IN ('yes', 'true'), false) AS fresh_tyre, false AS has_pit FROM v_lap"""))
def _(spark, sf):
    lap = table(spark, sf, "lap").select("lap_id", "compound", "fresh_tyre")
    return warehouse.boolean_flags(warehouse.unknown_filled(lap, ["compound", "lap_type"]), ["fresh_tyre", "has_pit"])


@query("fact_lap", w.with_star("\nSELECT * FROM fact_lap_performance"))
def _(spark, sf):
    return stages(spark, sf).warehouse().fact_lap_performance


@query("fact_result", w.with_star("\nSELECT * FROM fact_session_result"))
def _(spark, sf):
    return stages(spark, sf).warehouse().fact_session_result


# --- validation ----------------------------------------------------------------------------------------------------

_REPORT = "SELECT 'ERROR' AS severity, '{0}' AS table_name, '{1}' AS check_name, {2} AS message, CAST({3} AS BIGINT) AS affected_rows"


@query("val_dup", "WITH d AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) " + _REPORT.format(
    "lineitem", "duplicate_key", "'Duplicated values found for key columns: [''l_orderkey'', ''l_linenumber'']'", "sum(n)") + " FROM d HAVING sum(n) > 0")
def _(spark, sf):
    return validation.duplicate_rows(base(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber", "not_there"])


@query("val_missing_key", with_views("lap", " UNION ALL ".join(
    [_REPORT.format("lap", "missing_dimension_key", f"'Column {k} contains missing values.'", "count(*)") + f" FROM v_lap WHERE {k} IS NULL HAVING count(*) > 0"
     for k in ("driver_id", "compound", "team_id")] + [_REPORT.format("lap", "missing_key_column", "'Column season is missing.'", "NULL")])))
def _(spark, sf):
    return validation.missing_keys(table(spark, sf, "lap"), "lap", ["driver_id", "compound", "team_id", "season"])


@query("val_domain", with_views("lap", _REPORT.format("lap", "invalid_domain", "'Column compound contains values outside [''HARD'', ''SOFT''].'", "count(*)")
       + " FROM v_lap WHERE compound IS NULL OR compound NOT IN ('SOFT', 'HARD') UNION ALL "
       + _REPORT.format("lap", "invalid_domain", "'Column track_status contains values outside [''1''].'", "count(*)") + " FROM v_lap WHERE track_status <> '1'"
       + " UNION ALL SELECT 'WARNING', 'lap', 'missing_domain_column', 'Column season is missing.', CAST(NULL AS BIGINT)"))
def _(spark, sf):
    lap = table(spark, sf, "lap")
    return validation.findings({"lap": lap}, [
        validation.domain_rules(lap, "lap", "compound", ["SOFT", "HARD"]),
        validation.domain_rules(lap, "lap", "track_status", ["1"], allow_null=True),
        validation.domain_rules(lap, "lap", "season", ["1"])])


@query("val_row_count", """
SELECT 'ERROR' AS severity, 'lineitem' AS table_name, 'row_count' AS check_name, 'Output has more rows than source orders: ' || o || ' > ' || i || '.' AS message, o - i AS affected_rows
FROM (SELECT (SELECT count(*) FROM orders) AS i, (SELECT count(*) FROM lineitem) AS o)""")
def _(spark, sf):
    lines, orders = base(spark, sf, "lineitem"), base(spark, sf, "orders")
    return validation.more_rows_than_source(orders, lines, "orders", "lineitem").unionByName(
        validation.more_rows_than_source(lines, orders, "lineitem", "orders"))


@query("val_schema", w.with_star("""
SELECT 'ERROR' AS severity, 'warehouse' AS table_name, 'unexpected_dimension_tables' AS check_name, 'Unexpected dimensions found: [''dim_season'']' AS message, CAST(1 AS BIGINT) AS affected_rows
UNION ALL SELECT 'ERROR', 'warehouse', 'missing_dimension_tables', 'Required dimensions missing: [''dim_team'']', 1
UNION ALL SELECT 'ERROR', 'dim_grand_prix', 'missing_circuit_attributes', 'Circuit-level attributes missing: [''circuit_name'', ''country'']', 2
UNION ALL SELECT 'ERROR', 'fact_session_result', 'forbidden_fact_columns', 'Forbidden columns found in fact table: [''season_year'']', count(*) FROM fact_session_result
UNION ALL SELECT 'ERROR', 'fact_session_result', 'qualifying_gap_must_be_null', 'gap_to_leader_ms must be NULL for Qualifying results.', count(*) FROM fact_session_result WHERE session_type = 'Q'
"""))
def _(spark, sf):
    star = stages(spark, sf).warehouse().tables()
    broken = star["fact_session_result"].withColumns({"season_year": F.lit(2021), "gap_to_leader_ms": F.lit(1).cast("bigint")})
    star = {**star, "fact_session_result": broken, "dim_season": star["dim_team"], "dim_grand_prix": star["dim_grand_prix"].drop("circuit_name", "country")}
    star.pop("dim_team")
    plans = [([], validation.schema_findings(star)), validation.forbidden_rules(broken, "fact_session_result"), validation.gap_rules()]
    return validation.findings(star, plans)


@query("val_report", w.with_star("""
SELECT 'OK' AS severity, 'all' AS table_name, 'all_checks' AS check_name, 'No validation issues found.' AS message, count(*) - count(*) AS affected_rows FROM fact_lap_performance"""))
def _(spark, sf):
    st = stages(spark, sf)
    return validation.validate(st.cleaning().tables(), st.warehouse().tables())


_LOG_SIZES = {"dim_driver": 6, "dim_team": 3, "dim_grand_prix": 14, "dim_tyre_context": 4, "dim_lap_weather_context": 5, "dim_lap_data_quality": 7,
              "dim_result_outcome": 3, "dim_result_weather_context": 5, "dim_result_data_quality": 3, "fact_lap_performance": 20, "fact_session_result": 16}


@query("build_log", w.with_star("\n" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({n} AS BIGINT) AS column_count, 'created' AS status FROM {t}" for t, n in _LOG_SIZES.items())))
def _(spark, sf):
    return validation.build_log(stages(spark, sf).warehouse().tables()).drop("created_at_utc")


def _star_constraints() -> str:
    keys = {**validation.DIMENSION_KEYS, **validation.FACT_KEYS}
    out = [f"SELECT 'pk_{t}' AS constraint_name, 'primary_key' AS constraint_type, '{t}' AS table_name, CAST(count(*) - count(DISTINCT {k}) AS BIGINT) AS violations FROM {t}" for t, k in keys.items()]
    for fact, dims in (("fact_lap_performance", ("dim_driver", "dim_team", "dim_grand_prix", "dim_tyre_context", "dim_lap_weather_context", "dim_lap_data_quality")),
                       ("fact_session_result", ("dim_driver", "dim_team", "dim_grand_prix", "dim_result_outcome", "dim_result_weather_context", "dim_result_data_quality"))):
        out += [f"SELECT 'fk_{fact}_{keys[d]}_to_{d}_{keys[d]}', 'foreign_key', '{fact}', count(*) FROM {fact} WHERE {keys[d]} NOT IN (SELECT {keys[d]} FROM {d})" for d in dims]
    return " UNION ALL ".join(out)


@query("dw_constraints", w.with_star("\n" + _star_constraints()))
def _(spark, sf):
    return validation.verify(stages(spark, sf).warehouse().tables(), validation.star_constraints())


@query("laps_by_context", with_views("lap weather track_status", w.asof("v_lap", "lap_id", "v_weather", "weather_id", w.WEATHER, "lap_w") + ",\n"
       + w.asof("v_lap", "lap_id", "v_track_status", "track_status_id", w.TRACK, "lap_t") + f""",
work AS (SELECT l.lap_time_ms, coalesce(compound, 'Unknown') AS compound, {w.tyre_set()} AS starting_tyre_set_status, {w.tyre_life()} AS tyre_life_class,
    {w.level('track_temp', 30, 42)} AS track_temp_class, {w.track_category('track_message', 'track_code')} AS track_status_category
  FROM v_lap l JOIN lap_w USING (lap_id) JOIN lap_t USING (lap_id)),
dim AS (SELECT row_number() OVER (ORDER BY compound, starting_tyre_set_status, tyre_life_class) AS tyre_context_key, * FROM (SELECT DISTINCT compound, starting_tyre_set_status, tyre_life_class FROM work))
SELECT tyre_context_key, track_temp_class, track_status_category, count(*) AS laps, count(lap_time_ms) AS timed_laps, CAST(sum(lap_time_ms) AS BIGINT) AS total_ms, min(lap_time_ms) AS best_ms
FROM work JOIN dim USING (compound, starting_tyre_set_status, tyre_life_class) GROUP BY 1, 2, 3"""))
def laps_by_context(spark, sf):
    """Laps in their weather and track context, keyed by tyre context, summed up."""
    key, attributes = warehouse.CONTEXT_DIMENSIONS["dim_tyre_context"]
    lap = table(spark, sf, "lap").select("lap_id", "session_id", "lap_start_time_ms", "lap_time_ms", "compound", "fresh_tyre", "tyre_life")
    placed = warehouse.with_lap_context(lap, table(spark, sf, "weather"), table(spark, sf, "track_status")).withColumns(
        {"starting_tyre_set_status": c.tyre_set_status(F.col("fresh_tyre")), "tyre_life_class": c.tyre_life_class(F.col("tyre_life"))})
    work = warehouse.unknown_filled(placed, attributes)
    keyed = warehouse.with_dimension_key(work, warehouse.context_dimension(work, attributes, key), attributes, key)
    return keyed.groupBy(key, "track_temp_class", "track_status_category").agg(
        F.count("*").alias("laps"), F.count("lap_time_ms").alias("timed_laps"), F.sum("lap_time_ms").alias("total_ms"), F.min("lap_time_ms").alias("best_ms"))
