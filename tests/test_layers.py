"""Versioned layers, key registries, numbering and ingestion: failures, repeats and odd values."""

import gzip
import os
import uuid

import pytest
from pyspark.sql import functions as F, types as T

from starq.operators import slicing
from starq.operators.keys import number_rows, number_set
from starq.operators.registry import KeyRegistry
from starq.operators.slicing import plan_slices, with_slice
from starq.session import fresh_path
from starq.sources.ingest import ingest, units
from starq.sources.tables import read_layer
from starq.sources.versions import Conflict, Layer, refresh_layer


def local(path):
    return path.removeprefix("file:")


def test_a_failing_refresh_changes_nothing(spark):
    layer = Layer(spark, fresh_path(spark, "layer"))
    assert layer.tables() == {} and layer.manifest().number == 0
    assert layer.refresh({"a": spark.range(3), "b": spark.range(4)}) == []
    with pytest.raises(Exception, match="broken"):
        layer.refresh({"a": spark.range(9), "b": spark.range(1).select(F.raise_error(F.lit("broken")).alias("id"))})
    assert {n: df.count() for n, df in layer.tables().items()} == {"a": 3, "b": 4}
    assert [g.split("-")[0] for g in layer.clean()] == ["data/a", "data/b"]  # what the failed run left
    assert layer.refresh({"a": spark.range(5)}) == ["b"]
    assert {n: df.count() for n, df in layer.tables().items()} == {"a": 5}
    assert layer.clean() and layer.read("a").count() == 5
    with pytest.raises(FileNotFoundError):
        layer.read("b")


def test_a_failing_refresh_leaves_the_catalog(spark):
    database, place = f"starq_{uuid.uuid4().hex}", fresh_path(spark, "database")
    assert refresh_layer(spark, {"a": spark.range(3), "b": spark.range(4)}, database, place) == []
    with pytest.raises(Exception, match="broken"):
        refresh_layer(spark, {"a": spark.range(9), "b": spark.range(1).select(F.raise_error(F.lit("broken")).alias("id"))}, database)
    assert {n: df.count() for n, df in read_layer(spark, None, ["a", "b"], database=database).items()} == {"a": 3, "b": 4}
    assert refresh_layer(spark, {"a": spark.range(2).selectExpr("cast(id as string) as id")}, database) == ["b"]
    assert [tuple(r) for r in spark.table(f"{database}.a").orderBy("id").collect()] == [("0",), ("1",)]


def test_two_writers_of_one_version(spark):
    path = fresh_path(spark, "layer")
    one, two = Layer(spark, path), Layer(spark, path)
    one.refresh({"a": spark.range(1)})
    old = two.manifest()
    one.refresh({"a": spark.range(2)})
    with pytest.raises(Conflict):
        two._commit(old, {}, {})
    assert two.read("a").count() == 2


def test_a_repeated_batch_adds_nothing(spark):
    layer = Layer(spark, fresh_path(spark, "layer"))
    assert layer.append("1", {"a": spark.range(3), "b": spark.range(2)})
    assert layer.append("2", {"a": spark.range(3).selectExpr("cast(id as string) as id", "1 as other")})
    assert not layer.append("1", {"a": spark.range(3), "b": spark.range(2)})
    assert layer.append("1", {"c": spark.range(0)})
    assert {n: df.count() for n, df in layer.tables().items()} == {"a": 6, "b": 2, "c": 0}
    assert layer.read("a").dtypes == [("id", "bigint")]


def test_registered_keys_keep_their_ids(spark):
    schema = "season int, name text, seen int".replace("text", "string")
    registry = KeyRegistry(spark, fresh_path(spark, "keys"), ["season", "name"], start=100)
    assert registry.known() is None and registry.high() == 99
    first = spark.createDataFrame([(1, "b", 5), (1, "a", 7), (None, "a", 6), (1, None, 4), (1, "b", 9)], schema)
    assert registry.register(first, "monday", order=["seen"]) == 4
    second = spark.createDataFrame([(1, "b", 1), (None, None, 3), (2, "z", 2), (None, None, 8)], schema)
    assert registry.register(second, "tuesday", order=["seen"]) == 2
    assert registry.register(second, "tuesday") == 0 and registry.high() == 105
    found = {(r["season"], r["name"]): r["id"] for r in registry.look_up(first.unionByName(second), "id").collect()}
    assert found == {(1, None): 100, (1, "b"): 101, (None, "a"): 102, (1, "a"): 103, (2, "z"): 104, (None, None): 105}
    assert registry.look_up(spark.createDataFrame([(9, "new", 1)], schema), "id").first()["id"] is None
    assert registry.register(second.limit(0), "wednesday") == 0 and registry.high() == 105


@pytest.mark.parametrize("limit", [None, 40, 100_000])
def test_numbers_of_null_and_text_keys(spark, limit):
    """Nine tenths of the keys are NULL, the rest are texts: every row has its own number, NULL first."""
    df = spark.range(2000).selectExpr("id", "case when id % 10 = 0 then concat('k', lpad(id, 5, '0')) end as k").repartition(5)
    rows = sorted(number_rows(df, "k", "n", limit=limit).collect(), key=lambda r: r["n"])
    assert [r["n"] for r in rows] == list(range(1, 2001))
    assert [r["k"] for r in rows[:1800]] == [None] * 1800 and [r["k"] for r in rows[1800:]] == sorted(r["k"] for r in rows[1800:])
    if limit == 40:
        placed = []
        number_rows(df, "k", "n", limit=limit, stage=lambda d: placed.append(d.persist()) or placed[0]).count()
        sizes = placed[0].groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) <= 3 * limit
    assert number_rows(df.limit(0), ["k", "id"], "n").count() == 0


def test_large_sets_are_numbered_over_ranges(spark, monkeypatch):
    df = spark.createDataFrame([(i % 7 or None, f"t{i}") for i in range(300)], "a int, b string")
    small = {tuple(r) for r in number_set(df, ["a", "b"], "key").collect()}
    monkeypatch.setattr("starq.operators.keys.SMALL_SET", 100)
    assert {tuple(r) for r in number_set(df, ["a", "b"], "key").collect()} == small


def test_slices_beyond_one_sketch(spark, monkeypatch):
    """More slices than a sketch has cut points: a second level of sketches."""
    monkeypatch.setattr(slicing, "FANOUT", 8)
    df = spark.range(4000).selectExpr("id % 3 % 2 as g", "cast(hash(id) % 100000 as double) as v")
    slices = plan_slices(df, ["g"], "v", limit=50)
    sizes = with_slice(df, slices, "v").groupBy("g", "_slice").count().collect()
    assert sum(r["count"] for r in sizes) == 4000 and max(r["count"] for r in sizes) <= 150
    assert slices.hot.where("_cuts > 8").count() == 2


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])


def test_faults_stay_with_their_unit(spark):
    folder = fresh_path(spark, "landing")
    os.makedirs(local(folder))

    def file(name, content):
        path = f"{local(folder)}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as out:
            out.write(content)

    file("good/1.csv", b"k,v\n1,1.5\n2,\n")
    file("good/2.csv.gz", gzip.compress(b"k,v\n3,3\n"))
    file("cut/1.csv", b"k,v\n4,4\n")
    file("cut/2.csv.gz", gzip.compress(b"k,v\n" + b"5,5\n" * 5000)[:-20])
    file("not zipped.csv.gz", b"k,v\n6,6\n")
    file("record/1.csv", b"k,v\n7,7\nx,8\n9\n")
    file("rule/1.csv", b"k,v\n10,-1\n11,1\n")
    file("empty/1.csv", b"")
    file("header/1.csv", b"k,v\n")
    expected = spark.createDataFrame([("good",), ("absent",), ("absent",)], "unit string")
    found = ingest(spark, folder, SCHEMA, expected=expected, error=F.when(F.col("v") < 0, F.lit("negative")))
    audit = {r["unit"]: (r["row_count"], r["status"], r["error"]) for r in found.audit.collect()}
    assert audit == {
        "good": (3, "OK", None), "cut": (0, "FAILED", "damaged file: EOFError"), "not zipped": (0, "FAILED", "damaged file: BadGzipFile"),
        "record": (3, "FAILED", "malformed record: 9"), "rule": (2, "FAILED", "negative"), "header": (0, "OK", None),
        "absent": (0, "STARTED", None),
    }
    assert sorted((r["unit"], r["k"], r["v"]) for r in found.rows.collect()) == [("good", 1, 1.5), ("good", 2, None), ("good", 3, 3.0)]
    assert {r["unit"] for r in units(found.audit).collect()} == {"cut", "not zipped", "record", "rule", "absent"}


def test_damaged_parquet_and_absent_folders(spark):
    folder = fresh_path(spark, "landing")
    for unit, n in (("a", 3), ("b", 4)):
        spark.range(n).selectExpr("id as k", "1.0D as v").coalesce(1).write.parquet(f"{folder}/{unit}")
    broken = next(f for f in os.listdir(local(f"{folder}/b")) if f.endswith(".parquet"))
    with open(f"{local(folder)}/b/{broken}", "r+b") as out:
        out.truncate(200)
    found = ingest(spark, folder, SCHEMA, fmt="parquet")
    audit = {r["unit"]: (r["row_count"], r["status"]) for r in found.audit.collect()}
    assert audit == {"a": (3, "OK"), "b": (0, "FAILED")} and found.rows.count() == 3
    # The same without a checksum beside the file: the format itself shows the damage.
    os.remove(f"{local(folder)}/b/.{broken}.crc")
    assert found.audit.where("unit = 'b'").first()["error"] == "damaged file: unreadable"
    assert ingest(spark, folder, SCHEMA, fmt="parquet").audit.where("unit = 'b'").first()["error"] == "damaged file: ArrowInvalid"
    nothing = ingest(spark, fresh_path(spark, "absent"), SCHEMA, expected=spark.createDataFrame([("x",)], "unit string"))
    assert [tuple(r) for r in nothing.audit.collect()] == [("x", 0, "STARTED", None)] and nothing.rows.count() == 0
