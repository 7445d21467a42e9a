"""Rules one by one on the driver tables, and the whole assessment."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.registry import query, stages
from contract.sql_quality import SCORE_COLUMNS, STATUS, counts_sql, issues_sql, scorecard_sql, with_quality
from contract.views import base, sql_views, table, tables, with_views
from starq.functions import scalars
from starq.plans import quality
from starq.plans.rules import QUALIFYING_PROGRESSION, Check, Reference, Required, TableRules
from starq.session import configure

ISSUE = "table_name, row_identifier, dimension, check_id, issue_code, issue_description, severity"


def run(spark, frames, rules, table_name):
    """All issues, and one row per check with its counts (in the description column)."""
    configure(spark)
    a = quality.assess(spark, frames, {table_name: rules})
    counts = a.check_results.select(
        "table_name", F.lit("__check__").alias("row_identifier"), "dimension", "check_id", F.lit("").alias("issue_code"),
        F.concat_ws("/", "failed_count", "total_count").alias("issue_description"), F.col("status").alias("severity"))
    return a.issues.unionByName(counts)


def expect(name, dimension, check_id, source, key, applicable, failing, code, text, red=False, cells=None):
    """The same in SQL. `text` is an SQL expression; `cells` = (total, failed) for completeness."""
    total, failed = cells or (f"count(*) FILTER (WHERE {applicable})", f"count(*) FILTER (WHERE ({applicable}) AND ({failing}))")
    score = "(CASE WHEN t > 0 THEN round(CAST(t - f AS DOUBLE) / t, 6) END)"
    severity = "'red'" if red else f"CASE WHEN {score} < 0.80 THEN 'red' ELSE 'yellow' END"
    return f""" c AS (SELECT {total} AS t, {failed} AS f FROM {source})
SELECT '{name}' AS table_name, {key} AS row_identifier, '{dimension}' AS dimension, '{check_id}' AS check_id, '{code}' AS issue_code,
       {text} AS issue_description, {severity} AS severity FROM {source}, c WHERE ({applicable}) AND ({failing})
UNION ALL SELECT '{name}', '__check__', '{dimension}', '{check_id}', '', CAST(CAST(f AS BIGINT) AS VARCHAR) || '/' || CAST(CAST(t AS BIGINT) AS VARCHAR), {STATUS.format(score)} FROM c"""


_LAP = "'lap_id=' || lap_id"


@query("dq_required", with_views("lap", expect(
    "lap", "Completeness", "need", "v_lap", _LAP, "true", "driver_id IS NULL OR lap_time_ms IS NULL", "MISSING_REQUIRED_VALUE",
    "'Missing required values in columns: [' || concat_ws(', ', CASE WHEN driver_id IS NULL THEN '''driver_id''' END, CASE WHEN lap_time_ms IS NULL THEN '''lap_time_ms''' END) || ']'",
    cells=("count(*) * 3", "count(*) * 3 - count(lap_id) - count(driver_id) - count(lap_time_ms)"))))
def _(spark, sf):
    rules = TableRules(("lap_id",), required=(Required("need", ("lap_id", "driver_id", "lap_time_ms"), "needed"),))
    # The key itself is reported by its own query.
    return run(spark, {"lap": table(spark, sf, "lap")}, rules, "lap").where("check_id = 'need'")


# NaN counts as missing, and names may hold blanks.
@query("dq_nan_and_names", """WITH v AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 > 0 THEN l_extendedprice END AS price FROM lineitem),""" + expect(
    "lines", "Completeness", "need", "v", "'l_orderkey=' || l_orderkey || ';line number=' || l_linenumber", "true", "price IS NULL", "MISSING_REQUIRED_VALUE",
    "'Missing required values in columns: [''unit price'']'", cells=("count(*) * 2", "count(*) - count(price)")))
def _(spark, sf):
    price = F.when(F.col("l_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("l_extendedprice").cast("double"))
    lines = base(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("line number"), price.alias("unit price"))
    rules = TableRules(("l_orderkey", "line number"), required=(Required("need", ("line number", "unit price"), "needed"),),
                       validity=(Check("positive", "range", ("unit price",), "positive", {"min": 0}),))
    return run(spark, {"lines": lines}, rules, "lines").where("check_id = 'need'")


_LINE_KEY = "'l_orderkey=' || l_orderkey || ';l_linenumber=' || l_linenumber"


@query("dq_unique", "WITH n AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem)," + expect(
    "lineitem", "Uniqueness", "primary_key_unique", "n", _LINE_KEY, "true", "copies > 1", "DUPLICATED_KEY",
    "'Key [''l_orderkey'', ''l_linenumber''] is duplicated among complete key values.'", red=True))
def _(spark, sf):
    return run(spark, {"lineitem": base(spark, sf, "lineitem")}, TableRules(("l_orderkey", "l_linenumber")), "lineitem")


def _validity(check, key="lap_id"):
    return TableRules((key,), validity=(check,))


def _only(df, check_id):
    return df.where(F.col("check_id") == check_id)


@query("dq_domain", with_views("lap", expect(
    "lap", "Validity", "tyres", "v_lap", _LAP, "compound IS NOT NULL", "trim(compound) NOT IN ('SOFT', 'HARD', 'WET')",
    "INVALID_VALUE", "'known tyre'")))
def _(spark, sf):
    check = Check("tyres", "domain", ("compound",), "known tyre", {"allowed": ("SOFT", "HARD", "WET")})
    return _only(run(spark, {"lap": table(spark, sf, "lap")}, _validity(check), "lap"), "tyres")


@query("dq_domain_code", """WITH x AS (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey % 9 AS VARCHAR) WHEN 1 THEN ' ' || (o_orderkey % 9) || '.0'
 WHEN 2 THEN (o_orderkey % 9) || '.7' WHEN 3 THEN 'abc' END AS code FROM orders),""" + expect(
    "orders", "Validity", "code", "x", "'o_orderkey=' || o_orderkey", "code IS NOT NULL",
    "coalesce(CAST(floor(TRY_CAST(trim(code) AS DOUBLE)) AS BIGINT) NOT IN (1, 2, 4), true)", "INVALID_VALUE", "'known code'"))
def _(spark, sf):
    code = ("case o_orderkey % 5 when 0 then cast(o_orderkey % 9 as string) when 1 then concat(' ', o_orderkey % 9, '.0') "
            "when 2 then concat(o_orderkey % 9, '.7') when 3 then 'abc' end as code")
    check = Check("code", "domain", ("code",), "known code", {"allowed": ("1", "2", "4")})
    orders = base(spark, sf, "orders").selectExpr("*", code)
    return _only(run(spark, {"orders": orders}, _validity(check, "o_orderkey"), "orders"), "code")


@query("dq_range", with_views("lap", expect(
    "lap", "Validity", "speeds", "v_lap", _LAP, "speed_i1 IS NOT NULL OR speed_fl IS NOT NULL OR tyre_life IS NOT NULL",
    "speed_i1 < 1 OR speed_i1 > 300 OR speed_fl < 1 OR speed_fl > 300 OR tyre_life < 1 OR tyre_life > 300", "INVALID_VALUE", "'plausible'")))
def _(spark, sf):
    check = Check("speeds", "range", ("speed_i1", "speed_fl", "tyre_life"), "plausible", {"min": 1, "max": 300})
    return _only(run(spark, {"lap": table(spark, sf, "lap")}, _validity(check), "lap"), "speeds")


@query("dq_url", """WITH p AS (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN replace(url, '://', '.') ELSE '  ' || url END AS url FROM pages),""" + expect(
    "pages", "Validity", "url", "p", "'page_id=' || page_id", "url IS NOT NULL", "NOT regexp_matches(trim(url), '^https?://')",
    "INVALID_VALUE", "'a URL'"))
def _(spark, sf):
    pages = base(spark, sf, "pages").selectExpr(
        "page_id", "case when page_id % 10 = 0 then replace(url, '://', '.') else concat('  ', url) end as url")
    return _only(run(spark, {"pages": pages}, _validity(Check("url", "url", ("url",), "a URL"), "page_id"), "pages"), "url")


@query("dq_regex", "WITH" + expect(
    "customer", "Validity", "name", "customer", "'c_custkey=' || c_custkey", "c_name IS NOT NULL",
    "NOT regexp_matches(c_name, '^Customer#0+[1-4]')", "INVALID_VALUE", "'a name'"))
def _(spark, sf):
    check = Check("name", "regex", ("c_name",), "a name", {"pattern": "Customer#0+[1-4]"})
    return _only(run(spark, {"customer": base(spark, sf, "customer")}, _validity(check, "c_custkey"), "customer"), "name")


def _custom(check_id, function, **options):
    return Check(check_id, "custom", (), "consistent", {"function": function, **options})


def _consistency(check, key):
    return TableRules((key,), consistency=(check,))


# Orders with a second date, NULLs and equal dates among them.
_DATES = ("case when o_orderkey % 13 <> 0 then o_orderdate end as start_date",
          "case when o_orderkey % 3 = 0 then o_orderdate when o_orderkey % 17 <> 0 then timestamp '1998-06-01 00:00:00' end as end_date",
          "cast(1996 + o_orderkey % 4 as bigint) as season")
_DATES_SQL = ("WITH d AS (SELECT o_orderkey, o_custkey, " + ", ".join(_DATES) + " FROM orders),")
_ORDER = "'o_orderkey=' || o_orderkey"


def _dated(spark, sf):
    return base(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey", *_DATES)


@query("dq_date_order", _DATES_SQL + expect(
    "orders", "Consistency", "order", "d", _ORDER, "start_date IS NOT NULL AND end_date IS NOT NULL", "start_date > end_date", "ORDER", "'consistent'"))
def _(spark, sf):
    check = _custom("order", "dates_in_order", start="start_date", end="end_date")
    return _only(run(spark, {"orders": _dated(spark, sf)}, _consistency(check, "o_orderkey"), "orders"), "order")


@query("dq_dates_year", _DATES_SQL + expect(
    "orders", "Consistency", "years", "d", _ORDER, "season IS NOT NULL AND (start_date IS NOT NULL OR end_date IS NOT NULL)",
    "coalesce(year(start_date) <> season, false) OR coalesce(year(end_date) <> season, false)", "YEARS", "'consistent'"))
def _(spark, sf):
    check = _custom("years", "dates_in_year", year="season", dates=("start_date", "end_date"))
    return _only(run(spark, {"orders": _dated(spark, sf)}, _consistency(check, "o_orderkey"), "orders"), "years")


@query("dq_event_year", _DATES_SQL + expect(
    "orders", "Consistency", "year", "d", _ORDER, "season IS NOT NULL AND start_date IS NOT NULL", "year(start_date) <> season", "YEAR", "'consistent'"))
def _(spark, sf):
    check = _custom("year", "dates_in_year", year="season", dates=("start_date",))
    return _only(run(spark, {"orders": _dated(spark, sf)}, _consistency(check, "o_orderkey"), "orders"), "year")


@query("dq_age", _DATES_SQL + expect(
    "orders", "Accuracy", "age", "d", _ORDER, "start_date IS NOT NULL", "2021 - year(start_date) < 22 OR 2022 - year(start_date) > 25", "AGE", "'consistent'"))
def _(spark, sf):
    check = _custom("age", "age_between", born="start_date", first_year=2021, last_year=2022, youngest=22, oldest=25)
    rules = TableRules(("o_orderkey",), plausibility=(check,))
    return _only(run(spark, {"orders": _dated(spark, sf)}, rules, "orders"), "age")


@query("dq_date_near_parent", """WITH e AS (SELECT l.*, CAST(l_shipdate AS DATE) - 30 AS day, CAST(o_orderdate AS DATE) AS parent_day
 FROM lineitem l LEFT JOIN orders ON o_orderkey = CASE WHEN l_orderkey % 101 = 0 THEN -1 ELSE l_orderkey END),""" + expect(
    "lineitem", "Consistency", "near", "e", _LINE_KEY, "day IS NOT NULL AND parent_day IS NOT NULL",
    "date_diff('day', parent_day, day) NOT BETWEEN -20 AND 0", "NEAR", "'consistent'"))
def _(spark, sf):
    lines = base(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "case when l_orderkey % 101 = 0 then -1 else l_orderkey end as o_orderkey",
        "to_date(l_shipdate) - 30 as day")
    check = _custom("near", "date_near_parent", date="day", key="o_orderkey", parent="orders", parent_date="o_orderdate", days_before=20)
    rules = TableRules(("l_orderkey", "l_linenumber"), consistency=(check,))
    return _only(run(spark, {"lineitem": lines, "orders": base(spark, sf, "orders")}, rules, "lineitem"), "near")


@query("dq_sum_parts", with_views("lap", expect(
    "lap", "Consistency", "sums", "v_lap", _LAP,
    "lap_time_ms IS NOT NULL AND sector1_time_ms IS NOT NULL AND sector2_time_ms IS NOT NULL AND sector3_time_ms IS NOT NULL AND pit_in_time_ms IS NULL",
    "abs(sector1_time_ms + sector2_time_ms + sector3_time_ms - lap_time_ms) > 1000", "SUMS", "'consistent'")))
def _(spark, sf):
    check = _custom("sums", "parts_sum_to_total", total="lap_time_ms", parts=("sector1_time_ms", "sector2_time_ms", "sector3_time_ms"),
                    unless=("pit_in_time_ms",), tolerance=1000)
    return _only(run(spark, {"lap": table(spark, sf, "lap")}, _consistency(check, "lap_id"), "lap"), "sums")


@query("dq_abs_diff", with_views("weather", expect(
    "weather", "Consistency", "diff", "v_weather", "'weather_id=' || weather_id", "air_temp IS NOT NULL AND wind_speed IS NOT NULL",
    "abs(air_temp - wind_speed) > 5", "DIFF", "'consistent'")))
def _(spark, sf):
    check = _custom("diff", "difference_at_most", left="air_temp", right="wind_speed", limit=5)
    return _only(run(spark, {"weather": table(spark, sf, "weather")}, _consistency(check, "weather_id"), "weather"), "diff")


@query("dq_code_map", with_views("track_status", expect(
    "track_status", "Consistency", "codes", "v_track_status", "'track_status_id=' || track_status_id", "status IS NOT NULL AND message IS NOT NULL",
    "NOT coalesce((status, message) IN (('1', 'AllClear'), ('2', 'Yellow')), false)", "CODES", "'consistent'")))
def _(spark, sf):
    check = _custom("codes", "code_matches_text", code="status", text="message", mapping={1: "AllClear", 2: "Yellow"})
    return _only(run(spark, {"track_status": table(spark, sf, "track_status")}, _consistency(check, "track_status_id"), "track_status"), "codes")


@query("dq_progression", with_views("result", expect(
    "result", "Consistency", QUALIFYING_PROGRESSION.check_id, "v_result", "'result_id=' || result_id", "true",
    "(q2_ms IS NOT NULL AND q1_ms IS NULL) OR (q3_ms IS NOT NULL AND q2_ms IS NULL)", QUALIFYING_PROGRESSION.check_id.upper(),
    f"'{QUALIFYING_PROGRESSION.description}'")))
def _(spark, sf):
    rules = _consistency(QUALIFYING_PROGRESSION, "result_id")
    return _only(run(spark, {"result": table(spark, sf, "result")}, rules, "result"), QUALIFYING_PROGRESSION.check_id)


_LI = "l AS (SELECT l_orderkey, l_linenumber, l_suppkey + CASE WHEN l_orderkey % 101 = 0 THEN 1000000 ELSE 0 END AS l_suppkey FROM lineitem)"


@query("dq_fk", f"WITH {_LI}," + expect(
    "lineitem", "Referential Integrity", "fk_lineitem_l_suppkey_to_supplier_s_suppkey", "l", _LINE_KEY, "l_suppkey IS NOT NULL",
    "l_suppkey NOT IN (SELECT s_suppkey FROM supplier)", "BROKEN_FOREIGN_KEY",
    "'l_suppkey=' || l_suppkey || ' does not exist in supplier.s_suppkey.'", red=True))
def _(spark, sf):
    lines = base(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey + case when l_orderkey % 101 = 0 then 1000000 else 0 end as l_suppkey")
    rules = TableRules(("l_orderkey", "l_linenumber"), references=(Reference("l_suppkey", "supplier", "s_suppkey"),))
    frames = {"lineitem": lines, "supplier": base(spark, sf, "supplier")}
    return run(spark, frames, rules, "lineitem").where("dimension = 'Referential Integrity'")


@query("dq_structural", """
SELECT 'orders' AS table_name, '__table__' AS row_identifier, d AS dimension, c AS check_id, i AS issue_code, t AS issue_description, 'red' AS severity FROM (VALUES
 ('Completeness', 'need', 'MISSING_REQUIRED_COLUMN', 'Missing required columns: [''gone'']'),
 ('Validity', 'low', 'MISSING_VALIDITY_COLUMN', 'Missing columns for validity check: [''gone'']'),
 ('Referential Integrity', 'fk_orders_gone_to_customer_c_custkey', 'MISSING_CHILD_FK_COLUMN', 'Missing child FK column: gone'),
 ('Referential Integrity', 'fk_orders_o_custkey_to_absent_k', 'MISSING_PARENT_TABLE_OR_COLUMN', 'Missing parent: absent.k')) v(d, c, i, t)
UNION ALL SELECT 'nowhere', '__table__', 'Completeness', 'table_exists', 'MISSING_TABLE', 'Table nowhere was not found.', 'red'
UNION ALL SELECT 'orders', '__check__', d, c, '', CASE WHEN x = 'n' THEN CAST(n AS VARCHAR) || '/' || CAST(n AS VARCHAR) ELSE x END, s
  FROM (SELECT count(*) * 2 AS n FROM orders), (VALUES ('Completeness', 'need', 'n', 'red'), ('Validity', 'low', '1/1', 'red'), ('Consistency', 'order', '0/0', 'not_applicable'),
   ('Uniqueness', 'primary_key_unique', '0/0', 'not_applicable'), ('Referential Integrity', 'fk_orders_gone_to_customer_c_custkey', '1/1', 'red'),
   ('Referential Integrity', 'fk_orders_o_custkey_to_absent_k', '1/1', 'red')) v(d, c, x, s)
UNION ALL SELECT 'nowhere', '__check__', 'Completeness', 'table_exists', '', '1/1', 'red'""")
def _(spark, sf):
    rules = TableRules(
        ("gone",), required=(Required("need", ("o_orderkey", "gone"), "needed"),), validity=(Check("low", "range", ("gone",), "low", {"min": 1}),),
        consistency=(_custom("order", "dates_in_order", start="gone", end="o_orderdate"),),
        references=(Reference("gone", "customer", "c_custkey"), Reference("o_custkey", "absent", "k")))
    frames = {"orders": base(spark, sf, "orders"), "customer": base(spark, sf, "customer")}
    a = quality.assess(configure(spark), frames, {"orders": rules, "nowhere": TableRules(("k",))})
    counts = a.check_results.select(
        "table_name", F.lit("__check__").alias("row_identifier"), "dimension", "check_id", F.lit("").alias("issue_code"),
        F.concat_ws("/", "failed_count", "total_count").alias("issue_description"), F.col("status").alias("severity"))
    return a.issues.unionByName(counts)


@query("dq_status", f"""
SELECT o_custkey, round(s, 6) AS score, {STATUS.format('s')} AS status FROM (SELECT o_custkey,
  CASE WHEN count(*) FILTER (WHERE o_orderstatus <> 'P') > 0 THEN round(CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) FILTER (WHERE o_orderstatus <> 'P'), 6) END AS s
  FROM orders GROUP BY 1)""")
def _(spark, sf):
    sums = base(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("passed"), F.count_if(F.col("o_orderstatus") != "P").alias("total"))
    scored = sums.withColumn("score", scalars.score(F.col("passed"), F.col("total")))
    return scored.select("o_custkey", "score", scalars.score_status(F.col("score")).alias("status"))


@query("dq_severity", with_quality("""
SELECT table_name, check_id, severity, count(*) AS issues FROM issues GROUP BY ALL"""))
def _(spark, sf):
    return stages(spark, sf).assessment().issues.groupBy("table_name", "check_id", "severity").agg(F.count("*").alias("issues"))


@query("dq_row_id", with_quality(f"\nSELECT {ISSUE} FROM issues"))
def _(spark, sf):
    return stages(spark, sf).assessment().issues


@query("dq_check_results", with_quality("\nSELECT * FROM checks"))
def _(spark, sf):
    return quality.assess(configure(spark), tables(spark, sf)).check_results


_ROUNDED = ", ".join(f"round({c}, 9) AS {c}" for c in SCORE_COLUMNS)


@query("dq_scorecard", with_quality("," + scorecard_sql() + f"""
SELECT table_name, overall_score, status, issue_count, {_ROUNDED.replace('round(timeliness_score, 9)', 'CAST(timeliness_score AS DOUBLE)')} FROM scorecard"""))
def _(spark, sf):
    card = stages(spark, sf).assessment().scorecard
    return card.withColumns({c: F.round(c, 9) for c in SCORE_COLUMNS})


@query("dq_ri_issues", with_quality(f"\nSELECT {ISSUE} FROM issues WHERE dimension = 'Referential Integrity'"))
def _(spark, sf):
    return quality.reference_issues(stages(spark, sf).assessment().issues)
