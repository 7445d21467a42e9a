"""Layers bucketed by key: what they hold, how they are replaced, and cleaning without moving the table."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from starq.plans import cleaning, missing
from starq.session import fresh_path, stage
from starq.sources.buckets import bucket_layer, bucketed_tables
from starq.sources.tables import read_layer
from starq.sources.versions import refresh_layer

KEYS = {"lap": "lap_id", "driver": "driver_id", "season": "season_year"}


def database(spark):
    return f"starq_{uuid.uuid4().hex}", fresh_path(spark, "buckets")


def laps(spark):
    """A third of the rows has no key, among them copies of one row."""
    return spark.range(300).selectExpr(
        "case when id % 3 > 0 then id - 5 end as lap_id", "id % 4 as session_id", "'d1' as driver_id",
        "if(id % 3 = 0, 7, id) as lap_number", "if(id % 5 = 0, null, 100) as lap_time_ms", "if(id % 7 = 0, -3.0d, 200.0d) as speed_st",
        *[f"cast(null as double) as speed_{c}" for c in ("i1", "i2", "fl")],
        "if(id % 3 = 0, 'zz', ' soft ') as compound",
    )


def rows(df):
    return sorted(map(str, df.collect()))


def scans_below_exchange(df, part):
    """Per scan of a stored table that keeps rows with a key: whether an exchange stands above it."""
    above, found = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        name = re.search(r"[A-Za-z]", line)
        if not name:
            continue
        above = [(d, n) for d, n in above if d < name.start()]
        above.append((name.start(), line[name.start():]))
        if "FileScan" in line and part in line and "IsNull(" not in line:
            found.append(any(n.startswith("Exchange") for _, n in above))
    return found


def test_a_layer_holds_all_rows_and_is_replaced(spark):
    name, place = database(spark)
    bucket_layer(spark, {"lap": laps(spark), "driver": spark.range(3).selectExpr("cast(id as string) as driver_id"), "plain": spark.range(2)}, KEYS, name, place, 4)
    found = read_layer(spark, None, ["lap", "driver", "plain"], database=name)
    assert found["lap"].columns == laps(spark).columns and rows(found["lap"]) == rows(laps(spark))
    assert found["driver"].count() == 3 and found["plain"].count() == 2
    assert bucketed_tables(spark, name, KEYS) == {"lap", "driver"}
    assert bucketed_tables(spark, name, {**KEYS, "lap": "session_id"}) == {"driver"}
    with pytest.raises(Exception, match="broken"):
        bucket_layer(spark, {"lap": laps(spark).limit(5), "driver": spark.range(1).select(F.raise_error(F.lit("broken")).alias("driver_id"))}, KEYS, name)
    assert read_layer(spark, None, ["lap"], database=name)["lap"].count() == 300
    bucket_layer(spark, {"lap": laps(spark).where("false"), "driver": spark.range(1).selectExpr("cast(null as string) as driver_id")}, KEYS, name, buckets=3)
    found = read_layer(spark, None, ["lap", "driver"], database=name)
    assert found["lap"].count() == 0 and rows(found["driver"]) == ["Row(driver_id=None)"]
    stored = [t.name for t in spark.catalog.listTables(name)]
    assert len([t for t in stored if t.startswith("lap__")]) == 2 and len([t for t in stored if t.startswith("driver__")]) == 2


def test_a_plain_catalog_table_becomes_a_bucketed_one(spark):
    name, place = database(spark)
    refresh_layer(spark, {"lap": spark.range(3).withColumnRenamed("id", "lap_id")}, name, place)
    assert bucketed_tables(spark, name, KEYS) == set()
    bucket_layer(spark, {"lap": spark.range(4).withColumnRenamed("id", "lap_id")}, KEYS, name)
    assert spark.table(f"{name}.lap").count() == 4 and bucketed_tables(spark, name, KEYS) == {"lap"}


def marks(spark, table):
    plain = cleaning.own_row_id({f.name: f.dataType for f in table.schema.fields}, "lap_id")
    ids = table.selectExpr(f"{plain} as row_identifier", "speed_st")
    texts = [("lap_id=11.0", "b"), (" lap_id = 12 ", "b"), ("lap_id=-3", "b"), ("lap_id=99999999999999999999", "b"), ("lap_id=x", "b"), ("driver_id=14", "b"), ("__table__", "b"), (None, "b")]
    issues = ids.where("speed_st < 0").selectExpr("'lap' as table_name", "row_identifier", "'lap_speeds_positive' as check_id", "'INVALID_VALUE' as issue_code")
    odd = spark.createDataFrame(texts, "row_identifier string, x string").selectExpr("'lap' as table_name", "row_identifier", "'another_key' as check_id", "'DUPLICATED_KEY' as issue_code")
    return issues.unionByName(odd)


def test_marks_by_key_are_the_marks_by_text(spark):
    name, place = database(spark)
    bucket_layer(spark, {"lap": laps(spark)}, KEYS, name, place)
    table = read_layer(spark, None, ["lap"], database=name)["lap"]
    issues, gaps = marks(spark, table), missing.lap_flags(table)
    by_text = cleaning.clean({"lap": laps(spark)}, issues, gaps, stage=stage)
    by_key = cleaning.clean({"lap": table}, issues, gaps, stage=stage, bucketed={"lap"})
    assert rows(by_key.actions()) == rows(by_text.actions())
    assert rows(by_key.table("lap")) == rows(by_text.table("lap")) and rows(by_key.rejected()) == rows(by_text.rejected())
    dropped = {r["row_identifier"] for r in by_key.actions().where("check_id = 'another_key'").collect()}
    assert dropped == {"lap_id=11", "lap_id=12", "lap_id=-3"}
    assert by_key.actions().where("row_identifier like 'row_index=%' and check_id = 'lap_speeds_positive'").count() > 0


def test_rows_with_a_key_are_not_moved(spark):
    name, place = database(spark)
    bucket_layer(spark, {"lap": laps(spark)}, KEYS, name, place)
    table = read_layer(spark, None, ["lap"], database=name)["lap"]
    issues = marks(spark, laps(spark))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_key = scans_below_exchange(cleaning.resolve_table("lap", table, issues, by_key=True).frame, "_keyed")
        by_text = scans_below_exchange(cleaning.resolve_table("lap", table, issues).frame, "_keyed")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert by_key == [False] and by_text == [True]
