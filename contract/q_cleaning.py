"""Cleaning operators: single decisions on single tables, then the whole stage."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from contract.registry import query, stages
from contract.sql_cleaning import COLUMNS, FLAGS, with_cleaned, with_cleaning
from contract.sql_quality import cleaned_quality, scorecard_sql, with_quality
from contract.views import base, table, tables, with_views
from starq.functions import scalars
from starq.plans import cleaning, quality, validation
from starq.plans.rules import RULES, Check
from starq.schemas import PRIMARY_KEY
from starq.session import fresh_path, stage
from starq.sources.buckets import bucket_layer, bucketed_tables
from starq.sources.tables import read_layer

ALL = ", ".join(COLUMNS)


@query("cl_trim", with_views("lap", "SELECT lap_id, trim(compound) AS compound, trim(fresh_tyre) AS fresh_tyre, trim(track_status) AS track_status FROM v_lap"))
def _(spark, sf):
    return cleaning.trimmed(table(spark, sf, "lap").select("lap_id", "compound", "fresh_tyre", "track_status"))


@query("cl_empty_null", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS note FROM orders""")
def _(spark, sf):
    note = "case o_orderkey % 3 when 0 then ' \t ' when 1 then concat(' ', o_orderpriority) else o_orderpriority end as note"
    return cleaning.trimmed(base(spark, sf, "orders").selectExpr("o_orderkey", note))


@query("cl_flag_columns", with_views("lap", """SELECT lap_id, coalesce(lower(fresh_tyre) IN ('yes', 'true'), false) AS has_tyre_information_issue,
 false AS has_sector_information_issue, false AS has_speed_information_issue, false AS has_weather_information_issue,
 false AS has_track_status_information_issue, false AS has_pit_information_issue FROM v_lap"""))
def _(spark, sf):
    lap = table(spark, sf, "lap").select("lap_id", F.col("fresh_tyre").alias("has_tyre_information_issue"))
    return cleaning.with_quality_flags(lap, "lap")


@query("cl_row_id", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE 'result_id=' || o_orderkey END AS row_id FROM orders""")
def _(spark, sf):
    messy = ("case o_orderkey % 4 when 0 then concat('result_id=', o_orderkey, '.0') when 1 then concat(' result_id = ', o_orderkey) "
             "when 2 then concat('result_id=', o_orderkey) else '__table__' end as text")
    return base(spark, sf, "orders").selectExpr("o_orderkey", messy).select(
        "o_orderkey", cleaning.canonical_row_id(F.col("text")).alias("row_id"))


def _log(spark, sf, *names):
    """Action log of single tables, driven by their issues alone."""
    frames = tables(spark, sf)
    issues = stages(spark, sf).assessment().issues
    return cleaning.Cleaning({n: cleaning.resolve_table(n, frames[n], issues) for n in names}).actions()


_DQA = "source = 'general_dqa' AND check_id NOT LIKE 'post_cleaning%'"


@query("cl_drop_rules", with_cleaning("""
SELECT table_name, row_identifier, check_id, issue_code, reason FROM (SELECT *, row_number() OVER (PARTITION BY table_name, row_identifier ORDER BY ord) AS k FROM dqa_drops)
WHERE k = 1 AND table_name IN ('session', 'result')"""))
def _(spark, sf):
    return _log(spark, sf, "session", "result").where("cleaning_action = 'DROP_ROW'").select(
        "table_name", "row_identifier", "check_id", "issue_code", "reason")


@query("cl_set_null", with_cleaning(f"""
SELECT {ALL} FROM actions WHERE {_DQA} AND cleaning_action = 'SET_NULL' AND table_name IN ('season', 'driver', 'session', 'result')"""))
def _(spark, sf):
    return _log(spark, sf, "season", "driver", "session", "result").where("cleaning_action = 'SET_NULL' and source = 'general_dqa'")


@query("cl_invalid_cols", with_cleaning(f"""
SELECT {ALL} FROM actions WHERE check_id = 'lap_speeds_positive' AND cleaning_action = 'SET_NULL'"""))
def _(spark, sf):
    return _log(spark, sf, "lap").where("check_id = 'lap_speeds_positive' and cleaning_action = 'SET_NULL'")


@query("cl_canonical_domain", with_views("lap", """
SELECT lap_id, CASE regexp_replace(lower(compound), '[^a-z0-9]', '', 'g') WHEN 'soft' THEN 'SOFT' WHEN 'medium' THEN 'MEDIUM' WHEN 'hard' THEN 'HARD'
 WHEN 'wet' THEN 'WET' WHEN 'intermediate' THEN 'INTERMEDIATE' END AS compound FROM v_lap"""))
def _(spark, sf):
    from starq.schemas import TYRE_COMPOUNDS
    return table(spark, sf, "lap").select("lap_id", scalars.canonical_domain(F.col("compound"), TYRE_COMPOUNDS).alias("compound"))


@query("cl_reconstruct", with_cleaning(f"""
SELECT {ALL} FROM actions WHERE table_name = 'track_status' AND target_column = 'message'"""))
def _(spark, sf):
    return _log(spark, sf, "track_status").where("target_column = 'message'")


@query("cl_add_flag", with_cleaning("""
SELECT table_name, row_identifier, target_column, 'has_' || lower(area) || '_information_issue' AS quality_flag_column, check_id, reason
FROM flag_first WHERE source = 'general_dqa'"""))
def _(spark, sf):
    return _log(spark, sf, "lap", "result").where("cleaning_action = 'ADD_FLAG'").select(
        "table_name", "row_identifier", "target_column", "quality_flag_column", "check_id", "reason")


# A lap table of 82 columns under 85 checks, and issues of checks that no catalogue knows.
_WIDE = 60


@query("cl_wide_sets", with_views("lap", """
l AS (SELECT lap_id, lap_id % 97 = 0 AS foreign_key, lap_id % 89 = 0 AS catalogue_key, lap_id % 83 = 0 AS renamed FROM v_lap),
n AS (SELECT *, list_sort(list_distinct(['c' || lap_id % 60, 'c' || (lap_id * 7 + 3) % 60])) AS names FROM l)
SELECT 'lap_id=' || lap_id AS row_identifier, 'ADD_FLAG' AS cleaning_action, array_to_string(names, '|') AS target_column, NULL AS check_id, NULL AS issue_code,
       'EXPLAINED_NULL|SUSPICIOUS_NULL' AS missing_class FROM n WHERE NOT (foreign_key OR catalogue_key OR renamed)
UNION ALL SELECT 'lap_id=' || lap_id, 'DROP_ROW', NULL, CASE WHEN catalogue_key THEN 'fk_lap_session_id_to_session_session_id' WHEN foreign_key THEN 'another_key' ELSE 'x_required_columns' END,
       CASE WHEN catalogue_key THEN 'BROKEN_FOREIGN_KEY' WHEN foreign_key THEN 'DUPLICATED_KEY' ELSE 'SOME_CODE' END, NULL FROM n WHERE foreign_key OR catalogue_key OR renamed"""))
def _(spark, sf):
    lap = table(spark, sf, "lap").withColumns({f"c{i}": F.lit(i) for i in range(_WIDE)})
    more = tuple(Check(f"wide_{i}", "range", (f"c{i}",), "wide", {"min": 0}) for i in range(_WIDE))
    rules = {"lap": replace(RULES["lap"], validity=(*RULES["lap"].validity, *more))}
    rid, pick = F.concat(F.lit("lap_id="), F.col("lap_id")), F.col("lap_id")

    def issue(divisor, check, code):
        return lap.where(pick % divisor == 0).select(
            F.lit("lap").alias("table_name"), rid.alias("row_identifier"), F.lit(check).alias("check_id"), F.lit(code).alias("issue_code"))

    def flag(position, kind):
        return lap.select(
            F.lit("lap").alias("table_name"), rid.alias("row_identifier"), F.concat(F.lit("c"), position % _WIDE).alias("column_name"),
            F.lit(kind).alias("missing_class"), F.lit("SECTOR_INFORMATION").alias("missing_information_area"))

    issues = issue(97, "another_key", "DUPLICATED_KEY").unionByName(issue(83, "x_required_columns", "SOME_CODE")).unionByName(
        issue(89, "fk_lap_session_id_to_session_session_id", "BROKEN_FOREIGN_KEY")).unionByName(issue(7, "no_decision", "SOME_CODE"))
    flags = flag(pick, "SUSPICIOUS_NULL").unionByName(flag(pick * 7 + 3, "EXPLAINED_NULL"))
    resolved = cleaning.resolve_table("lap", lap, issues, flags, rules=rules)
    return cleaning.Cleaning({"lap": resolved}).actions().where("cleaning_action in ('ADD_FLAG', 'DROP_ROW')").select(
        "row_identifier", "cleaning_action", "target_column", "check_id", "issue_code", "missing_class")


@query("cl_unmatched_issues", with_views("lap", """
SELECT 'lap' AS table_name, 'lap_id=' || lap_id AS row_identifier, 'no_decision' AS check_id FROM v_lap WHERE lap_id % 7 = 0"""))
def _(spark, sf):
    rows = table(spark, sf, "lap").where("lap_id % 7 = 0").selectExpr("'lap' as table_name", "concat('lap_id=', lap_id) as row_identifier")
    named = [rows.selectExpr("*", f"'{c}' as check_id", f"'{k}' as issue_code") for c, k in (
        ("no_decision", "SOME_CODE"), ("another_key", "DUPLICATED_KEY"), ("lap_time_positive", "INVALID_VALUE"), ("x_required_columns", "SOME_CODE"))]
    return cleaning.unmatched_issues(reduce(DataFrame.unionByName, named), ["lap"]).drop("issue_code")


@query("cl_missing_driven", with_cleaning(f"\nSELECT {ALL} FROM actions WHERE source = 'missing_values'"))
def _(spark, sf):
    return stages(spark, sf).cleaning().actions().where("source = 'missing_values'")


@query("cl_outlier_driven", with_cleaning(f"\nSELECT {ALL} FROM actions WHERE source = 'outlier_detection'"))
def _(spark, sf):
    return stages(spark, sf).cleaning().actions().where("source = 'outlier_detection'")


# The same cascade over the order tables: nations of one region are dropped.
_TREE = {"customer": (("c_nationkey", "nation", "n_nationkey"),), "orders": (("o_custkey", "customer", "c_custkey"),),
         "lineitem": (("l_orderkey", "orders", "o_orderkey"),)}


@query("cl_cascade", """
WITH n AS (SELECT * FROM nation WHERE n_regionkey <> 2), c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)),
o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)), l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
SELECT 'nation' AS table_name, (SELECT count(*) FROM nation) AS rows_before, count(*) AS rows_after FROM n UNION ALL
SELECT 'customer', (SELECT count(*) FROM customer), count(*) FROM c UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), count(*) FROM o UNION ALL
SELECT 'lineitem', (SELECT count(*) FROM lineitem), count(*) FROM l""")
def _(spark, sf):
    order = ("nation", "customer", "orders", "lineitem")
    frames = {t: base(spark, sf, t).withColumns({"_rid": F.lit(t), "_drop": F.lit(None).cast("int")}) for t in order}
    frames["nation"] = frames["nation"].withColumn("_drop", F.when(F.col("n_regionkey") == 2, 0))
    out = cleaning.cascade({t: cleaning.Resolved(df, ({"reason": "out of scope"},)) for t, df in frames.items()}, _TREE, order)
    counts = [
        r.frame.agg(F.count("*").alias("rows_before"), F.count_if(F.col("_drop").isNull()).alias("rows_after")).select(
            F.lit(t).alias("table_name"), "rows_before", "rows_after") for t, r in out.items()]
    return reduce(DataFrame.unionByName, counts)


# References that no walk in one order settles: parts to parts, customers to orders and orders to customers.
_CYCLE = {"part": (("p_parent", "part", "p_partkey"),), "customer": (("c_order", "orders", "o_orderkey"),), "orders": (("o_custkey", "customer", "c_custkey"),)}


@query("cl_cascade_cycle", """
WITH RECURSIVE f AS (SELECT o_custkey, min(o_orderkey) AS o_first FROM orders GROUP BY 1),
links AS (
  SELECT 'part' AS t, p_partkey AS k, 'part' AS pt, p_partkey // 2 AS pk FROM part WHERE p_partkey > 1
  UNION ALL SELECT 'orders', o_orderkey, 'customer', o_custkey FROM orders
  UNION ALL SELECT 'customer', c_custkey, 'orders', o_first FROM customer JOIN f ON f.o_custkey = c_custkey + 1 WHERE c_custkey % 6 <> 0),
gone AS (
  SELECT 'part' AS t, p_partkey AS k FROM part WHERE p_partkey % 97 = 5 UNION ALL
  SELECT 'customer', c_custkey FROM customer WHERE c_custkey % 29 = 4
  UNION SELECT l.t, l.k FROM gone g JOIN links l ON l.pt = g.t AND l.pk = g.k)
SELECT 'part' AS table_name, count(*) AS rows_after, CAST(sum(p_partkey) AS BIGINT) AS key_sum FROM part WHERE p_partkey NOT IN (SELECT k FROM gone WHERE t = 'part')
UNION ALL SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_custkey NOT IN (SELECT k FROM gone WHERE t = 'customer')
UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey NOT IN (SELECT k FROM gone WHERE t = 'orders')""")
def _(spark, sf):
    orders, customer = base(spark, sf, "orders"), base(spark, sf, "customer")
    first = orders.groupBy((F.col("o_custkey") - 1).alias("c_custkey")).agg(F.min("o_orderkey").alias("o_first"))
    frames = {
        "part": base(spark, sf, "part").selectExpr("p_partkey", "case when p_partkey > 1 then cast(floor(p_partkey / 2) as bigint) end as p_parent",
                                                   "case when p_partkey % 97 = 5 then 0 end as _drop"),
        "customer": customer.join(first, "c_custkey", "left").selectExpr(
            "c_custkey", "case when c_custkey % 6 <> 0 then o_first end as c_order", "case when c_custkey % 29 = 4 then 0 end as _drop"),
        "orders": orders.selectExpr("o_orderkey", "o_custkey", "cast(null as int) as _drop"),
    }
    planted = {t: cleaning.Resolved(df.withColumn("_rid", F.lit(t)), ({"reason": "planted"},)) for t, df in frames.items()}
    out = cleaning.cascade(planted, _CYCLE, ("part", "customer", "orders"), stage)
    key = {"part": "p_partkey", "customer": "c_custkey", "orders": "o_orderkey"}
    sums = [
        r.frame.where("_drop is null").agg(F.count("*").alias("rows_after"), F.sum(key[t]).alias("key_sum")).select(F.lit(t).alias("table_name"), "rows_after", "key_sum")
        for t, r in out.items()]
    return reduce(DataFrame.unionByName, sums)


@query("cl_rejected", with_cleaning("\nSELECT table_name, row_identifier, reason AS reasons FROM drops"))
def _(spark, sf):
    rejected = stages(spark, sf).cleaning().rejected()
    return rejected.where("row_data_json like '{%}'").drop("row_data_json")


@query("cl_rejected_json", with_cleaning("""
SELECT d.table_name, d.row_identifier, CAST(l.session_id AS VARCHAR) AS session_id, l.driver_id, CAST(l.lap_number AS VARCHAR) AS lap_number, l.driver_id IS NULL AS null_kept
FROM drops d JOIN v_lap l ON d.table_name = 'lap' AND d.row_identifier = 'lap_id=' || l.lap_id
UNION ALL SELECT d.table_name, d.row_identifier, CAST(r.session_id AS VARCHAR), r.driver_id, NULL, r.driver_id IS NULL
FROM drops d JOIN v_result r ON d.table_name = 'result' AND d.row_identifier = 'result_id=' || r.result_id"""))
def _(spark, sf):
    """The rejected rows' JSON, parsed again."""
    rejected = stages(spark, sf).cleaning().rejected().where("table_name in ('lap', 'result')")
    fields = [F.get_json_object("row_data_json", f"$.{c}").alias(c) for c in ("session_id", "driver_id", "lap_number")]
    return rejected.select("table_name", "row_identifier", *fields, F.col("row_data_json").contains('"driver_id":null').alias("null_kept"))


_LAP_COLUMNS = ("lap_id, session_id, driver_id, lap_number, lap_time_ms, sector1_time_ms, sector2_time_ms, sector3_time_ms, speed_i1, speed_i2, speed_fl, "
                "speed_st, compound, tyre_life, fresh_tyre, " + ", ".join(f"has_{a.lower()}_information_issue" for a in FLAGS["lap"]))


@query("cl_final", with_cleaned(f"\nSELECT {_LAP_COLUMNS} FROM c_lap"))
def _(spark, sf):
    return stages(spark, sf).cleaning().table("lap").select(*[c.strip() for c in _LAP_COLUMNS.split(",")])


_SIZES = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM alive_{t}" for t in RULES)


@query("cl_final_sizes", with_cleaning("\n" + _SIZES))
def _(spark, sf):
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
              for t, df in stages(spark, sf).cleaning().tables().items()]
    return reduce(DataFrame.unionByName, counts)


@query("cl_action_log", with_cleaning(f"\nSELECT {ALL} FROM actions"))
def _(spark, sf):
    return stages(spark, sf).cleaning().actions()


# The tables come from a catalog layer that is bucketed by key: rows with a key meet their marks in place.
@query("cl_bucketed_marks", with_cleaning(f"\nSELECT {ALL} FROM actions"))
def _(spark, sf):
    st, database = stages(spark, sf), f"starq_{uuid.uuid4().hex}"
    bucket_layer(spark, st.tables(), PRIMARY_KEY, database, fresh_path(spark, "buckets"))
    found = read_layer(spark, None, st.tables(), required=True, database=database)
    return cleaning.clean(
        found, st.assessment().issues, st.missing(), st.outliers().flags, stage=stage,
        bucketed=bucketed_tables(spark, database, PRIMARY_KEY),
    ).actions()


@query("cl_summaries", with_cleaning("""
SELECT table_name, cleaning_action, NULL AS source, NULL AS check_id, NULL AS information_area, NULL AS quality_flag_column, NULL AS outlier_metric, count(*) AS action_count FROM actions GROUP BY ALL
UNION ALL SELECT NULL, cleaning_action, source, check_id, information_area, quality_flag_column, outlier_metric, count(*) FROM actions
GROUP BY source, check_id, information_area, quality_flag_column, outlier_metric, cleaning_action"""))
def _(spark, sf):
    actions = stages(spark, sf).cleaning().actions()
    return cleaning.summary_by_table(actions).unionByName(cleaning.summary_by_decision(actions), allowMissingColumns=True)


@query("cl_before_after", with_cleaned("," + scorecard_sql() + "," + cleaned_quality() + """
SELECT table_name, b.issue_count AS issue_count_before, a.issue_count AS issue_count_after, b.overall_score AS overall_score_before, a.overall_score AS overall_score_after
FROM scorecard b FULL JOIN after_scorecard a USING (table_name)"""))
def _(spark, sf):
    st = stages(spark, sf)
    after = quality.assess(spark, st.cleaning().tables())
    return cleaning.before_after(st.assessment().scorecard, after.scorecard)


_FK = {"grand_prix": [("season", "season_year"), ("circuit", "circuit_id")], "session": [("grand_prix", "grand_prix_id")],
       **{t: [("session", "session_id"), ("driver", "driver_id"), ("team", "team_id")] for t in ("result", "lap")},
       **{t: [("session", "session_id")] for t in ("weather", "track_status")}}
_CHECK_SQL = {"ck_session_type": ("session", "session_type NOT IN ('Q', 'R')"), "ck_grand_prix_round_positive": ("grand_prix", "round_number <= 0"),
              "ck_lap_number_positive": ("lap", "lap_number <= 0"), "ck_lap_time_positive": ("lap", "lap_time_ms <= 0"),
              "ck_result_points_non_negative": ("result", "points < 0"), "ck_weather_wind_speed_non_negative": ("weather", "wind_speed < 0")}


def _constraint_sql(prefix: str) -> str:
    from contract.sql_quality import KEYS, NATURAL
    out = []
    for t, k in KEYS.items():
        out.append(f"SELECT 'pk_{t}' AS constraint_name, 'primary_key' AS constraint_type, '{t}' AS table_name, CAST(coalesce(sum(n) FILTER (WHERE n > 1 OR k IS NULL), 0) AS BIGINT) AS violations "
                   f"FROM (SELECT {k} AS k, count(*) AS n FROM {prefix}{t} GROUP BY 1)")
    for t, ks in NATURAL.items():
        out.append(f"SELECT 'uq_{t}_natural', 'unique', '{t}', CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {prefix}{t} "
                   f"WHERE {' AND '.join(x + ' IS NOT NULL' for x in ks)} GROUP BY {', '.join(ks)})")
    for t, fks in _FK.items():
        out += [f"SELECT 'fk_{t}_{p}', 'foreign_key', '{t}', count(*) FROM {prefix}{t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {prefix}{p})" for p, c in fks]
    out += [f"SELECT '{n}', 'check', '{t}', count(*) FROM {prefix}{t} WHERE {bad}" for n, (t, bad) in _CHECK_SQL.items()]
    return " UNION ALL ".join(out)


@query("cl_constraints", with_cleaned("\n" + _constraint_sql("c_")))
def _(spark, sf):
    return validation.verify(stages(spark, sf).cleaning().tables(), validation.clean_layer_constraints())


@query("cl_constraints_raw", with_quality("\n" + _constraint_sql("v_")))
def _(spark, sf):
    return validation.verify(stages(spark, sf).tables(), validation.clean_layer_constraints())
