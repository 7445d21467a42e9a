"""What a batch over large tables does once: issues are counted with the checks, outliers among their flags."""

from collections import Counter

from pyspark.sql import functions as F

from starq.functions.scalars import strip
from starq.plans import outliers, quality
from starq.plans.rules import Check, Reference, Required, TableRules


def test_a_scorecard_lists_no_issues(spark):
    rows = spark.createDataFrame([(1, "1.0", "A"), (1, " 2", "x"), (2, "9", None), (None, None, "x")], "k int, p string, c string")
    parents = spark.createDataFrame([(1,), (2,)], "id long")
    rules = TableRules(
        ("k",), required=(Required("need", ("k", "p"), ""), Required("absent", ("gone",), "")), references=(Reference("p", "parent", "id"),),
        validity=(Check("known", "domain", ("c",), "", {"allowed": ("A",)}),),
    )
    staged = []
    a = quality.assess(spark, {"t": rows, "parent": parents}, {"t": rules, "nowhere": TableRules(("k",))}, stage=lambda df: staged.append(df) or df)
    counts = {r["table_name"]: r["issue_count"] for r in a.scorecard.collect()}
    assert len(staged) == 2  # failing keys and check results
    assert counts == dict(Counter(r["table_name"] for r in a.issues.collect())) == {"t": 7, "nowhere": 1}


def test_generators_stay_in_generated_code(spark):
    rows = spark.createDataFrame([(1, "x"), (1, None)], "k int, c string")
    rules = TableRules(("k",), required=(Required("need", ("c",), ""),), validity=(Check("known", "domain", ("c",), "", {"allowed": ("A",)}),))
    issues = quality.assess(spark, {"t": rows}, {"t": rules}).issues
    assert sorted(r["check_id"] for r in issues.collect()) == ["known", "need", "primary_key_unique", "primary_key_unique"]
    assert "lambda" not in issues._jdf.queryExecution().optimizedPlan().toString()


def test_strip_of_a_column_by_name(spark):
    texts = ["", " ", "a", " a", "a\t", " a", "a　", "é", "é ", "a b", "\x7fa", "a\x85", "\U0001f600 ", "a\U0001f600", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select(strip("t").alias("a"), strip(F.col("t")).alias("b"), F.expr(quality.sql_strip("`t`")).alias("c")).collect():
        assert row["a"] == row["b"] == row["c"]


def test_outliers_are_counted_among_the_flags(spark):
    values = [100, 101, 99, 100, 102, 98, 100, 101, 99, 100, 500]
    laps = spark.createDataFrame(
        [(i, 1, v, None) for i, v in enumerate(values)] + [(50, 2, None, 7.0), (51, None, 1, 1.0)], "lap_id long, session_id long, lap_time_ms long, speed_st double"
    )
    staged = []
    found = outliers.detect(laps, ("lap_time_ms", "speed_st"), stage=lambda df: staged.append(df) or df)
    assert len(staged) == 2  # the values, and the flags
    assert [r["row_identifier"] for r in found.flags.collect()] == ["lap_id=10"]
    got = {(r["session_id"], r["metric"]): (r["tested_values"], r["iqr_outliers"], r["consensus_outliers"], r["status"]) for r in found.summary.collect()}
    few = "skipped_too_few_values"
    assert got == {
        (1, "lap_time_ms"): (11, 1, 1, "completed"), (1, "speed_st"): (0, 0, 0, few),
        (2, "lap_time_ms"): (0, 0, 0, few), (2, "speed_st"): (1, 0, 0, few),
    }
