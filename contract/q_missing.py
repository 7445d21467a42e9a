"""Missing values and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.registry import query, stages
from contract.sql_missing import (
    METRICS, OUTLIER_VALUES, clean_lap_definition, missing_summary_definition, scored_definitions, with_missing, with_outliers,
)
from contract.views import base, sql_views, table, tables, with_views
from starq.functions import scalars
from starq.plans import missing, outliers

FLAG = "table_name, row_identifier, column_name, missing_class, missing_information_area, explanation, severity"


@query("mv_context", with_views("result session", """
SELECT r.result_id, r.position, s.session_type FROM v_result r LEFT JOIN v_session s USING (session_id)"""))
def _(spark, sf):
    typed = missing.with_session_type(table(spark, sf, "result"), table(spark, sf, "session"))
    return typed.select("result_id", "position", "session_type")


@query("mv_result_flags", with_missing(f"\nSELECT {FLAG} FROM missing WHERE table_name = 'result'"))
def _(spark, sf):
    return missing.result_flags(missing.with_session_type(table(spark, sf, "result"), table(spark, sf, "session")))


@query("mv_lap_flags", with_missing(f"\nSELECT {FLAG} FROM missing WHERE table_name = 'lap'"))
def _(spark, sf):
    return missing.lap_flags(table(spark, sf, "lap"))


@query("mv_suppress", with_missing("""
SELECT table_name, column_name, missing_class, missing_information_area, count(*) AS flags FROM all_missing GROUP BY ALL"""))
def _(spark, sf):
    every = missing.missing_flags(tables(spark, sf), keep_explained=True)
    return every.groupBy("table_name", "column_name", "missing_class", "missing_information_area").agg(F.count("*").alias("flags"))


@query("mv_severity", with_missing("""
SELECT missing_class, missing_information_area, severity, count(*) AS flags FROM missing GROUP BY ALL"""))
def _(spark, sf):
    return stages(spark, sf).missing().groupBy("missing_class", "missing_information_area", "severity").agg(F.count("*").alias("flags"))


@query("mv_summary", with_missing("," + missing_summary_definition() + "\nSELECT * FROM missing_summary"))
def _(spark, sf):
    return missing.missing_summary(stages(spark, sf).missing(), stages(spark, sf).tables())


@query("parse_bool", with_views("lap", """
SELECT lap_id, CASE WHEN lower(trim(fresh_tyre)) IN ('true', '1', 't', 'yes', 'y') THEN true WHEN lower(trim(fresh_tyre)) IN ('false', '0', 'f', 'no', 'n') THEN false END AS fresh,
       coalesce(lower(trim(fresh_tyre)) IN ('true', '1', 't', 'yes', 'y'), false) AS fresh_or_false FROM v_lap"""))
def _(spark, sf):
    fresh = F.col("fresh_tyre")
    return table(spark, sf, "lap").select(
        "lap_id", scalars.parse_bool(fresh).alias("fresh"), scalars.parse_bool_or_false(fresh).alias("fresh_or_false"))


@query("ol_dry_sessions", with_views("weather", "SELECT session_id FROM v_weather GROUP BY 1 HAVING NOT bool_or(rainfall)"))
def _(spark, sf):
    return outliers.dry_sessions(table(spark, sf, "weather"))


@query("ol_race_sessions", with_views("session", "SELECT session_id FROM v_session WHERE trim(session_type) = 'R'"))
def _(spark, sf):
    return outliers.race_sessions(table(spark, sf, "session"))


@query("ol_clean_laps", f"WITH {sql_views('lap', 'weather', 'session')},{clean_lap_definition()} SELECT lap_id, session_id, lap_time_ms FROM clean_lap")
def _(spark, sf):
    clean = outliers.clean_laps(*[table(spark, sf, t) for t in ("lap", "weather", "session")])
    return clean.select("lap_id", "session_id", "lap_time_ms")


_LONG = " UNION ALL ".join(
    f"SELECT lap_id, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM v_lap WHERE {m} IS NOT NULL" for m in METRICS)


@query("ol_unpivot", with_views("lap", f"SELECT * FROM ({_LONG})"))
def _(spark, sf):
    return outliers.long_metrics(table(spark, sf, "lap"), ["lap_id"], METRICS)


# Prices per brand: the same detector on line items.
_PRICES = """WITH prices AS (SELECT p_brand AS brand, l_orderkey, l_linenumber, l_extendedprice AS value FROM lineitem JOIN part ON p_partkey = l_partkey),"""


def _price_scores(spark, sf, **options):
    lines = base(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("value"))
    part = base(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    return outliers.score_groups(lines.join(part, "l_partkey"), ["brand"], **options)


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 9) for n in names})


_IQR = _PRICES + scored_definitions("prices", "brand") + """
SELECT brand, count(*) AS tested, round(max(iqr_lower_bound), 9) AS lower_bound, round(max(iqr_upper_bound), 9) AS upper_bound,
       count(*) FILTER (WHERE iqr_flag) AS outliers FROM scored GROUP BY 1"""


def _iqr(spark, sf, **options):
    out = _price_scores(spark, sf, **options).groupBy("brand").agg(
        F.count("*").alias("tested"), F.max("iqr_lower_bound").alias("lower_bound"), F.max("iqr_upper_bound").alias("upper_bound"),
        F.count_if("iqr_flag").alias("outliers"))
    return _rounded(out, "lower_bound", "upper_bound")


@query("ol_iqr", _IQR)
def _(spark, sf):
    return _iqr(spark, sf)


# Brands of more than 50 lines are cut.
@query("ol_iqr_hot", _IQR)
def _(spark, sf):
    return _iqr(spark, sf, limit=50)


@query("ol_modz", _PRICES + scored_definitions("prices", "brand") + """
SELECT brand, round(max(smedian), 9) AS median, round(max(smad), 9) AS mad, round(max(modified_z_score), 9) AS max_z,
       count(*) FILTER (WHERE modified_z_flag) AS outliers FROM scored GROUP BY 1""")
def _(spark, sf):
    out = _price_scores(spark, sf).groupBy("brand").agg(
        F.max("median").alias("median"), F.max("mad").alias("mad"), F.max("modified_z_score").alias("max_z"),
        F.count_if("modified_z_flag").alias("outliers"))
    return _rounded(out, "median", "mad", "max_z")


_FLAG_COLUMNS = ", ".join(
    f"round({c}, 9) AS {c}" if c in OUTLIER_VALUES else c for c in outliers.OUTLIER_COLUMNS)


@query("ol_consensus", with_outliers(f"\nSELECT {_FLAG_COLUMNS} FROM outliers"))
def _(spark, sf):
    return _rounded(outliers.detect_from_tables(tables(spark, sf)).flags, *OUTLIER_VALUES)


_BY_SESSION = "WITH " + sql_views("lap") + """,
speeds AS (SELECT session_id, CAST(tyre_life AS BIGINT) AS stint, CAST(speed_i2 AS DOUBLE) AS value FROM v_lap WHERE speed_i2 IS NOT NULL AND tyre_life IS NOT NULL),"""


@query("ol_min_group", _BY_SESSION + scored_definitions("speeds", "session_id, stint") + """
SELECT session_id, stint, CASE WHEN max(tested) < 10 THEN 'skipped_too_few_values' ELSE 'completed' END AS status, count(*) AS tested,
       CAST(sum(consensus_score) AS BIGINT) AS score FROM scored GROUP BY 1, 2""")
def _(spark, sf):
    lap = table(spark, sf, "lap")
    values = outliers.long_metrics(lap.where("tyre_life is not null"), ["session_id", F.col("tyre_life").cast("bigint").alias("stint")], ["speed_i2"])
    scored = outliers.score_groups(values, ["session_id", "stint"])
    status = F.when(F.max("tested") < outliers.SMALLEST_GROUP, "skipped_too_few_values").otherwise("completed")
    return scored.groupBy("session_id", "stint").agg(
        status.alias("status"), F.count("*").alias("tested"), F.sum("consensus_score").alias("score"))


@query("ol_summary", with_outliers("\nSELECT * FROM outlier_summary"))
def _(spark, sf):
    return outliers.detect_from_tables(tables(spark, sf)).summary
