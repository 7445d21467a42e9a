"""Sources, sinks and re-engineering."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from contract.registry import query, shared_folder
from contract.views import base, table, with_views
from starq.functions import scalars
from starq.operators.registry import KeyRegistry
from starq.plans import reengineering as re
from starq.session import configure, fresh_path
from starq.sources import ingest as landing, tables as io
from starq.sources.versions import Layer, refresh_layer


def _path(spark, label):
    shared_folder(spark)
    return fresh_path(configure(spark), label)


@query("scan_csv_clean_headers", """
SELECT CAST(c_custkey AS VARCHAR) AS "customer key", c_name AS name, c_mktsegment AS "market segment" FROM customer""")
def _(spark, sf):
    path = _path(spark, "headers")
    c = base(spark, sf, "customer")
    io.write_csv(c.select(F.col("c_custkey").alias(" customer   key"), F.col("c_name").alias("name "),
                          F.col("c_mktsegment").alias("market\tsegment")), path)
    return io.read_csv(spark, path)


_ORDER_SCHEMA = T.StructType([
    T.StructField("order_key", T.LongType()), T.StructField("order_date", T.TimestampType()),
    T.StructField("total_price", T.DoubleType()), T.StructField("order_status", T.StringType()),
])


@query("scan_csv_typed", """
SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS order_date,
       o_totalprice AS total_price, o_orderstatus AS order_status FROM orders""")
def _(spark, sf):
    path = _path(spark, "typed")
    date = F.when(F.col("o_orderkey") % 50 == 0, "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    o = base(spark, sf, "orders")
    io.write_csv(o.select(F.col("o_orderkey").alias("OrderKey"), date.alias("OrderDate"),
                          F.col("o_totalprice").alias("TotalPrice"), F.col("o_orderstatus").alias("Order-Status")), path)
    return io.load_csv(spark, path, _ORDER_SCHEMA)


@query("scan_catalog", """
SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def _(spark, sf):
    found = io.read_layer(configure(spark), sf, ["orders", "events", "lineitem", "no_such_table"])
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in found.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# A layer that was written to the catalog, read back from there by logical names.
@query("scan_catalog_database", """
SELECT 'supplier' AS table_name, count(*) AS row_count FROM supplier UNION ALL SELECT 'part', count(*) FROM part""")
def _(spark, sf):
    database = f"starq_{uuid.uuid4().hex}"
    refresh_layer(spark, {n: base(spark, sf, n) for n in ("supplier", "part")}, database, _path(spark, "layer"))
    found = io.read_layer(spark, None, ["supplier", "part", "no_such_table"], database=database)
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in found.items()]
    return counts[0].unionByName(counts[1])


@query("sink_csv_roundtrip", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def _(spark, sf):
    path = _path(spark, "csv")
    df = base(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    io.write_csv(df, path)
    return io.read_csv(spark, path, df.schema)


@query("sink_partitioned_roundtrip", """
SELECT o_orderstatus, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1""")
def _(spark, sf):
    path = _path(spark, "parts")
    io.write_partitioned_csv(base(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", path)
    back = spark.read.option("header", True).schema("o_orderkey bigint, o_orderstatus string").csv(path)
    return back.groupBy("o_orderstatus").agg(F.count("*").alias("row_count"), F.sum("o_orderkey").alias("key_sum"))


@query("sink_append", """
SELECT s_suppkey, s_name, CAST(s_acctbal AS DOUBLE) AS s_acctbal FROM supplier
UNION ALL SELECT s_suppkey, NULL, CAST(NULL AS DOUBLE) FROM supplier""")
def _(spark, sf):
    path = _path(spark, "append")
    s = base(spark, sf, "supplier")
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                           T.StructField("s_acctbal", T.DoubleType())])
    io.append(s, path, schema)
    io.append(s.select(F.col("s_suppkey").cast("string").alias("s_suppkey"), F.lit(float("nan")).alias("s_acctbal")), path, schema)
    return spark.read.schema(schema).parquet(path)


@query("sink_refresh", """
SELECT 'dim_supplier' AS table_name, count(*) AS row_count, 1 AS dropped FROM supplier
UNION ALL SELECT 'dim_part', count(*), 1 FROM part""")
def _(spark, sf):
    database = f"starq_{uuid.uuid4().hex}"
    location = _path(spark, "layer")
    supplier, part = base(spark, sf, "supplier"), base(spark, sf, "part")
    refresh_layer(spark, {"dim_supplier": part, "dim_part": supplier, "dim_old": part}, database, location)
    stale = refresh_layer(spark, {"dim_supplier": supplier, "dim_part": part}, database, location)
    left = [t.name for t in spark.catalog.listTables(database)]
    frames = [
        spark.table(f"`{database}`.`{t}`").agg(F.count("*").alias("row_count")).select(
            F.lit(t).alias("table_name"), "row_count", F.lit(len(stale)).alias("dropped"))
        for t in sorted(left)
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- re-engineering ------------------------------------------------------------------------------------------------


@query("duration_to_ms", with_views("lap", """
SELECT lap_id, time_ms + time_ms % 2 AS duration_ms, time_ms AS span_ms FROM v_lap"""))
def _(spark, sf):
    lap = table(spark, sf, "lap")
    text = ("concat(cast(time_ms div 86400000 as string), ' days ', lpad(cast(time_ms div 3600000 % 24 as string), 2, '0'), ':', "
            "lpad(cast(time_ms div 60000 % 60 as string), 2, '0'), ':', lpad(cast(time_ms div 1000 % 60 as string), 2, '0'), '.', "
            "lpad(cast(time_ms % 1000 as string), 3, '0'), '500') as duration")
    span = "make_dt_interval(cast(time_ms div 86400000 as int), 0, 0, cast(time_ms % 86400000 as decimal(18,6)) / 1000) as span"
    return re.durations_to_ms(lap.selectExpr("lap_id", text, span), ["duration"])


@query("duration_negative", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_orderkey % 5 = 3 THEN -(o_orderkey % 24 * 3600000 + 1500)
  ELSE -(o_orderkey % 3 + 1) * 86400000 + o_orderkey % 24 * 3600000 + o_orderkey % 60 * 60000 + 59500 END AS duration_ms FROM orders""")
def _(spark, sf):
    clock = "lpad(cast(o_orderkey % 24 as string), 2, '0')"
    text = (f"case when o_orderkey % 5 = 4 then 'soon' when o_orderkey % 5 = 3 then concat('-', {clock}, ':00:01.5') else "
            f"concat('-', o_orderkey % 3 + 1, ' days +', {clock}, ':', lpad(cast(o_orderkey % 60 as string), 2, '0'), ':59.5') end as duration")
    return re.durations_to_ms(base(spark, sf, "orders").selectExpr("o_orderkey", text), ["duration"])


@query("duration_unreadable", "SELECT 'duration' AS column_name, count(*) FILTER (WHERE o_orderkey % 5 = 4) AS unreadable FROM orders")
def _(spark, sf):
    text = "case when o_orderkey % 5 = 4 then 'soon' when o_orderkey % 5 = 3 then '' when o_orderkey % 5 < 2 then '1 days 00:00:01' end as duration"
    return re.unreadable_durations(base(spark, sf, "orders").selectExpr(text), ["duration"])


@query("match_key", """
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN '' ELSE lower(p_name) END AS match_key FROM part""")
def _(spark, sf):
    p = base(spark, sf, "part")
    messy = F.when(F.col("p_partkey") % 10 != 0, F.concat(F.lit("\t "), F.upper(F.regexp_replace("p_name", " ", "  \n")), F.lit(" ")))
    return p.select("p_partkey", scalars.match_key(messy).alias("match_key"))


@query("alias_key", """
SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN 'monte carlo' ELSE lower(p_name) END AS alias_key FROM part""")
def _(spark, sf):
    p = base(spark, sf, "part")
    place = F.expr("case p_partkey % 4 when 0 then ' Monaco' when 1 then 'MonteCarlo' when 2 then 'Monte  CARLO' else p_name end")
    return p.select("p_partkey", scalars.alias_key(place).alias("alias_key"))


@query("union_first_wins", """
WITH u AS (SELECT 0 AS batch, c_nationkey AS k, c_custkey AS ord, c_name AS who FROM customer
           UNION ALL SELECT 1, s_nationkey + 5, s_suppkey, s_name FROM supplier)
SELECT k AS nation_id, ord, who AS first_name FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY batch, ord) AS n FROM u) WHERE n = 1""")
def _(spark, sf):
    first = base(spark, sf, "customer").selectExpr("c_nationkey as k", "c_custkey as ord", "c_name as who")
    second = base(spark, sf, "supplier").selectExpr("s_nationkey + 5 as k", "s_suppkey as ord", "s_name as who")
    return re.union_first_wins([first, second], "k", {"k": "nation_id", "who": "first_name"}, ["ord"])


@query("enrich_m1", """
SELECT o_orderstatus, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM (SELECT *, CASE WHEN l_orderkey % 101 <> 0 THEN l_orderkey END AS k FROM lineitem) l
LEFT JOIN (SELECT *, CASE WHEN o_orderkey <> 7 THEN o_orderkey END AS k FROM orders) o ON l.k IS NOT DISTINCT FROM o.k GROUP BY 1""")
def _(spark, sf):
    lines = base(spark, sf, "lineitem").selectExpr("case when l_orderkey % 101 <> 0 then l_orderkey end as k", "l_quantity")
    orders = base(spark, sf, "orders").selectExpr("case when o_orderkey <> 7 then o_orderkey end as k", "o_orderstatus")
    joined = re.enrich(lines, orders, ["k"], guard="orders")
    return joined.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))


@query("enrich_lap_ids", with_views("result", """
n AS (SELECT result_id, session_id, result_id % 1000 AS driver_number, driver_id, team_id FROM v_result),
m AS (SELECT session_id, driver_number, min(driver_id) AS driver_id, min(team_id) AS team_id FROM n GROUP BY 1, 2 HAVING count(DISTINCT (driver_id, team_id)) = 1)
SELECT event_id, user_id AS session_id, event_id % 1000 AS driver_number, m.driver_id, m.team_id FROM events e
LEFT JOIN m ON m.session_id = e.user_id AND m.driver_number = e.event_id % 1000"""))
def _(spark, sf):
    numbered = table(spark, sf, "result").withColumn("driver_number", F.expr("result_id % 1000"))
    known = numbered.groupBy("session_id", "driver_number").agg(
        F.min("driver_id").alias("driver_id"), F.min("team_id").alias("team_id"), F.count_distinct(F.struct("driver_id", "team_id")).alias("n"))
    laps = base(spark, sf, "events").selectExpr("event_id", "user_id as session_id", "event_id % 1000 as driver_number")
    return re.enrich_laps_with_ids(laps, known.where("n = 1"))


_EVENTS_SQL = """
e AS (SELECT c_custkey AS event_id, CASE WHEN c_custkey % 10 = 0 THEN 'nowhere' ELSE lower(n_name) END AS place, n_regionkey, n_nationkey
      FROM customer JOIN nation ON n_nationkey = c_nationkey)"""


def _located(spark, sf):
    nation = base(spark, sf, "nation")
    circuits = nation.selectExpr("concat('c', n_nationkey) as circuit_id", "concat('Land  ', n_regionkey) as country", "n_name as location")
    events = base(spark, sf, "customer").join(nation, F.col("n_nationkey") == F.col("c_nationkey")).selectExpr(
        "c_custkey as event_id", "concat(' LAND ', n_regionkey) as country",
        "case when c_custkey % 10 = 0 then 'nowhere' else concat(lower(n_name), ' ') end as location")
    return re.with_circuit_id(events, circuits)


@query("lookup_normalized", f"""WITH {_EVENTS_SQL}
SELECT event_id, CASE WHEN place <> 'nowhere' THEN 'c' || n_nationkey END AS circuit_id FROM e""")
def _(spark, sf):
    return _located(spark, sf).select("event_id", "circuit_id")


@query("lookup_unmatched", f"""WITH {_EVENTS_SQL} SELECT event_id FROM e WHERE place = 'nowhere'""")
def _(spark, sf):
    return re.unmatched(_located(spark, sf), "circuit_id").select("event_id")


@query("exclude_ci", "SELECT o_orderkey, o_orderpriority FROM orders WHERE lower(o_orderpriority) <> '5-low'")
def _(spark, sf):
    return re.without_value(base(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "5-LOW")


@query("fanout_types", """
SELECT c_custkey, t AS session_type, 2021 AS season_year FROM customer CROSS JOIN (VALUES ('Q'), ('R')) v(t)""")
def _(spark, sf):
    return re.fan_out(base(spark, sf, "customer").select("c_custkey"), "session_type", ["Q", "R"], season_year=2021)


@query("surrogate_batches", """
SELECT event_id, event_type, 100 + row_number() OVER (ORDER BY event_id) AS row_key FROM events""")
def _(spark, sf):
    return re.continued_numbers(base(spark, sf, "events").select("event_id", "event_type"), "event_id", "row_key", start=101)


# More than 300 rows are cut into slices, as large tables are.
@query("surrogate_hot", """
SELECT event_id, event_type, 100 + row_number() OVER (ORDER BY event_id) AS row_key FROM events""")
def _(spark, sf):
    return re.continued_numbers(base(spark, sf, "events").select("event_id", "event_type"), "event_id", "row_key", start=101, limit=300)


@query("ingest_audit", """
WITH r AS (SELECT user_id, CASE WHEN value < 0.5 THEN 'value ' || event_type || ' too small' END AS err FROM events),
s AS (SELECT user_id, count(*) AS row_count, min(err) AS error FROM r GROUP BY 1),
x AS (SELECT user_id FROM s UNION ALL SELECT -1)
SELECT x.user_id, coalesce(row_count, 0) AS row_count,
       CASE WHEN row_count IS NULL THEN 'STARTED' WHEN error IS NOT NULL THEN 'FAILED' ELSE 'OK' END AS status, error
FROM x LEFT JOIN s ON s.user_id = x.user_id""")
def _(spark, sf):
    events = base(spark, sf, "events")
    expected = events.select("user_id").distinct().unionByName(spark.range(1).selectExpr("-1L as user_id"))
    error = F.expr("case when value < 0.5 then concat('value ', event_type, ' too small') end")
    return re.ingest_audit(events, ["user_id"], error, expected)


# Units of compressed files, of which one is cut off, some hold records or rows that are wrong, and one never came.
@query("ingest_audit_faults", """
WITH c AS (SELECT c_custkey, c_mktsegment AS unit, CASE WHEN c_mktsegment = 'FURNITURE' AND c_custkey % 10 = 7 THEN 'n/a' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS balance
           FROM customer),
e AS (SELECT unit, c_custkey, CASE WHEN balance = 'n/a' THEN 'malformed record: ' || c_custkey || ',n/a'
             WHEN unit = 'HOUSEHOLD' AND CAST(balance AS BIGINT) < 0 THEN 'balance below 0' END AS error FROM c WHERE unit <> 'MACHINERY'),
a AS (SELECT unit, count(*) AS row_count, min(error) AS error, CAST(sum(c_custkey) AS BIGINT) AS keys FROM e GROUP BY 1)
SELECT unit, row_count, CASE WHEN error IS NULL THEN 'OK' ELSE 'FAILED' END AS status, error,
       CASE WHEN error IS NULL THEN keys END AS loaded_key_sum FROM a
UNION ALL SELECT 'MACHINERY', 0, 'FAILED', 'damaged file: EOFError', NULL
UNION ALL SELECT 'NOWHERE', 0, 'STARTED', NULL, NULL""")
def _(spark, sf):
    path = _path(spark, "landing")
    c = base(spark, sf, "customer")
    balance = "case when c_mktsegment = 'FURNITURE' and c_custkey % 10 = 7 then 'n/a' else cast(floor(c_acctbal) as string) end as balance"
    written = c.selectExpr("c_custkey", balance, "c_mktsegment as unit").coalesce(1).write.option("header", True).option("compression", "gzip")
    written.partitionBy("unit").csv(path)
    _cut_off(spark, f"{path}/unit=MACHINERY")
    expected = c.selectExpr("c_mktsegment as unit").distinct().unionByName(spark.range(1).selectExpr("'NOWHERE' as unit"))
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("balance", T.LongType())])
    rule = F.expr("case when unit = 'HOUSEHOLD' and balance < 0 then 'balance below 0' end")
    found = landing.ingest(spark, path, schema, expected=expected, error=rule)
    loaded = found.rows.groupBy("unit").agg(F.sum("c_custkey").alias("loaded_key_sum"))
    return found.audit.join(loaded, "unit", "left").select("unit", "row_count", "status", "error", "loaded_key_sum")


def _cut_off(spark, folder):
    """Leaves the first half of every file of a small landing folder, as a broken transfer would."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(hadoop(folder)):
        stream = fs.open(status.getPath())
        content = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        stream.close()
        out = fs.create(status.getPath(), True)
        out.write(bytearray(content[: len(content) // 2]))
        out.close()


# Keys of text, NULL among them. The second run meets all keys of the first and new ones, and is repeated.
@query("surrogate_two_runs", """
WITH k AS (SELECT c_custkey, CASE WHEN c_custkey % 50 <> 0 THEN c_name END AS name, c_nationkey < 10 AS early FROM customer),
d AS (SELECT name, NOT bool_or(early) AS late FROM k GROUP BY 1),
n AS (SELECT name, row_number() OVER (ORDER BY late, name NULLS FIRST) AS id FROM d)
SELECT k.c_custkey, n.id AS customer_id FROM k JOIN n ON k.name IS NOT DISTINCT FROM n.name""")
def _(spark, sf):
    customers = base(spark, sf, "customer").selectExpr("c_custkey", "c_nationkey", "case when c_custkey % 50 <> 0 then c_name end as name")
    registry = KeyRegistry(spark, _path(spark, "keys"), ["name"])
    registry.register(customers.where("c_nationkey < 10"), "run 1")
    for _ in range(2):
        registry.register(customers, "run 2")
    return registry.look_up(customers.select("c_custkey", "name"), "customer_id").drop("name")


# A refresh that fails at its second table leaves both tables as they were; the next one replaces the layer.
@query("sink_refresh_atomic", """
SELECT 'after failure' AS moment, 'part' AS table_name, count(*) AS row_count FROM part
UNION ALL SELECT 'after failure', 'supplier', count(*) FROM supplier
UNION ALL SELECT 'after refresh', 'supplier', count(*) FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT 'after refresh', 'nation', count(*) FROM nation""")
def _(spark, sf):
    layer = Layer(spark, _path(spark, "layer"))
    supplier, part, nation = (base(spark, sf, t) for t in ("supplier", "part", "nation"))
    layer.refresh({"supplier": supplier, "part": part})
    try:
        layer.refresh({"supplier": supplier.limit(1), "part": part.withColumn("p_size", F.raise_error(F.lit("broken source")).cast("int"))})
    except Exception as error:
        if "broken source" not in str(error):
            raise
    frames = [(moment, name, df) for moment, tables in (("after failure", layer.tables()),) for name, df in tables.items()]
    layer.refresh({"supplier": supplier.where("s_suppkey % 2 = 0"), "nation": nation})
    frames += [("after refresh", name, df) for name, df in layer.tables().items()]
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(moment).alias("moment"), F.lit(name).alias("table_name"), "row_count")
        for moment, name, df in frames
    ]
    return reduce(DataFrame.unionByName, counts)


# Two batches, the first of them sent twice.
@query("sink_append_twice", """
SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_comment_code FROM orders""")
def _(spark, sf):
    layer = Layer(spark, _path(spark, "batches"))
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType()),
                           T.StructField("o_comment_code", T.StringType())])
    orders = base(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    for batch, rows in (("odd", "o_orderkey % 2 = 1"), ("even", "o_orderkey % 2 = 0"), ("odd", "o_orderkey % 2 = 1")):
        layer.append(batch, {"orders": orders.where(rows)}, {"orders": schema})
    return layer.read("orders")


@query("parse_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS order_date, 'n/a' AS note FROM orders""")
def _(spark, sf):
    text = "case when o_orderkey % 7 = 0 then '31/31/2020' else date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') end as order_date"
    return re.parse_dates(base(spark, sf, "orders").selectExpr("o_orderkey", text, "'n/a' as note"))


@query("project_schema", "SELECT o_custkey, o_orderkey FROM orders")
def _(spark, sf):
    return re.project(base(spark, sf, "orders"), ["o_custkey", "o_orderkey"])
