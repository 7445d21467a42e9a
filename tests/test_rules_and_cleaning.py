"""Hand-written rows: parsing, classes, checks, and the invariants of cleaning."""

import json

import pytest
from pyspark.sql import functions as F

from starq.functions import scalars as c
from starq.plans import cleaning, missing, outliers, quality, starqueries, validation
from starq.session import stage
from starq.plans.rules import Reference, Required, TableRules


def values(spark, kind, data, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r["x"] for r in sorted(df.select("i", function(F.col("v")).alias("x")).collect())]


@pytest.mark.parametrize("function, data, expected", [
    (c.match_key, ["  A \t B ", None, ""], ["a b", "", ""]),
    (c.alias_key, [" MONACO", "MonteCarlo", "Spa"], ["monte carlo", "monte carlo", "spa"]),
    (c.parse_bool, ["Yes", " f ", "maybe", None, "1"], [True, False, None, None, True]),
    (c.number, ["1.5", "x", "NaN", None, " 7 "], [1.5, None, None, None, 7.0]),
    (c.canonical_value, ["1.0", " 1", "a", "12345678901234567", "1.5", None], ["1", "1", "a", "12345678901234567", "1.5", None]),
    (c.classification_category, ["12", "r", "DSQ", "E", " W", "nc", "?", None],
     ["Classified", "Retired", "Disqualified", "Excluded", "Withdrawn", "NotClassified", "Other", "NotApplicable"]),
    (c.status_category, ["Finished", "+2 Laps", "Excluded", "DNS", "Collision damage", "Spun off", "Turbo", "Brakes", "Withdrew", "withdrawn", None],
     ["Finished", "Lapped", "Disqualified", "DidNotStart", "Collision", "Accident", "PowerUnitIssue", "MechanicalIssue", "Other", "Retired", "NotApplicable"]),
    (c.duration_text_to_ms, ["0 days 00:01:02.5", "1 days 00:00:00.0005", "00:00:00.0015", "bad", None], [62500, 86400000, 2, None, None]),
])
def test_text_functions(spark, function, data, expected):
    assert values(spark, "string", data, function) == expected


def test_number_classes(spark):
    assert values(spark, "double", [-1.0, 0.0, 5.0, 5.1, 15.0, 16.0, float("nan"), float("inf"), None], c.tyre_life_class) == [
        "Unknown", "Low", "Low", "Medium", "Medium", "High", "Unknown", "Unknown", "Unknown"]
    assert values(spark, "double", [19.9, 20.0, 28.0, None], c.air_temp_class) == ["Low", "Medium", "High", "Unknown"]


def test_uniqueness_and_references(spark):
    rows = spark.createDataFrame([(1, "1.0"), (1, " 2"), (2, "9"), (None, None)], "k int, p string")
    parents = spark.createDataFrame([(1,), (2,)], "id long")
    rules = TableRules(("k",), required=(Required("need", ("k", "p"), ""),), references=(Reference("p", "parent", "id"),))
    a = quality.assess(spark, {"t": rows, "parent": parents}, {"t": rules})
    got = {r["check_id"]: (r["failed_count"], r["total_count"], r["passed_count"]) for r in a.check_results.collect()}
    assert got == {"need": (2, 8, 6), "primary_key_unique": (2, 3, 1), "fk_t_p_to_parent_id": (1, 3, 2)}
    ids = sorted((r["check_id"], r["row_identifier"].split("=")[0]) for r in a.issues.collect())
    assert ids == [("fk_t_p_to_parent_id", "k"), ("need", "row_index"), ("primary_key_unique", "k"), ("primary_key_unique", "k")]


def small_tables(spark):
    def frame(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return {
        "driver": frame("driver_id string, abbreviation string, last_name string", ("d1", "ABC", "A"), ("d2", "x", "B"), ("d3", "DEF", None)),
        "session": frame("session_id long, grand_prix_id long, session_type string", (1, 1, "R"), (2, 1, " q"), (3, 2, "Practice")),
        "lap": frame(
            "lap_id long, session_id long, driver_id string, team_id string, lap_number long, time_ms long, lap_time_ms long, speed_st double, compound string",
            (1, 1, "d1", "t", 1, 1, 100, 200.0, " soft "), (2, 1, "d2", "t", 1, 1, None, 200.0, ""), (3, 1, "d3", "t", 1, 1, 100, -3.0, "X"),
            (4, 3, "d1", "t", 1, 1, 100, 200.0, "HARD"), (5, 2, None, "t", 1, 1, 100, 200.0, "WET"), (6, 2, "d1", "t", 2, 1, 0, 200.0, "m-e-dium"),
        ),
        "result": frame("result_id long, session_id long, position double", (1, 1, 1.0)),
    }


def test_cleaning_invariants(spark):
    tables = small_tables(spark)
    issues = quality.assess(spark, tables, stage=stage).issues
    result = cleaning.clean(tables, issues, missing.lap_flags(tables["lap"]), stage=stage)
    actions = [r.asDict() for r in result.actions().collect()]
    drops = {}
    for a in actions:
        if a["cleaning_action"] == "DROP_ROW":
            drops.setdefault((a["table_name"], a["row_identifier"]), []).append(a)
    assert all(len(reasons) == 1 for reasons in drops.values())
    assert {k[1] for k in drops if k[0] == "lap"} == {"lap_id=2", "lap_id=3", "lap_id=4", "lap_id=5", "lap_id=6"}
    assert drops["lap", "lap_id=2"][0]["source"] == "missing_values"
    assert drops["lap", "lap_id=6"][0]["check_id"] == "lap_time_positive"
    assert drops["lap", "lap_id=3"][0]["issue_code"] == "BROKEN_FOREIGN_KEY_AFTER_CLEANING"
    cleaned = result.tables()
    assert [r["compound"] for r in cleaned["lap"].collect()] == ["SOFT"]
    assert {r["session_type"] for r in cleaned["session"].collect()} == {"R", "Q"}
    report = validation.verify(cleaned, validation.clean_layer_constraints())
    assert report.where("violations > 0").count() == 0
    validation.fail_on_violation(report).collect()
    rejected = {r["row_identifier"]: json.loads(r["row_data_json"]) for r in result.rejected().where("table_name = 'lap'").collect()}
    assert rejected["lap_id=2"]["compound"] is None and rejected["lap_id=3"]["has_tyre_information_issue"] is True
    tyre = [a for a in actions if a["row_identifier"] == "lap_id=3" and a["cleaning_action"] == "ADD_FLAG"]
    assert [(a["target_column"], a["check_id"]) for a in tyre] == [("compound", "compound_domain")]


def test_constant_and_small_groups_have_no_outliers(spark):
    rows = [("const", 5.0)] * 12 + [("few", float(i)) for i in range(9)] + [("many", float(i)) for i in range(20)] + [("many", 500.0)]
    scored = outliers.score_groups(spark.createDataFrame(rows, "g string, value double"), ["g"])
    flagged = scored.where("consensus_score > 0").collect()
    assert [(r["g"], r["value"], r["consensus_score"]) for r in flagged] == [("many", 500.0, 2)]
    assert scored.where("g <> 'many' and (iqr_lower_bound is not null or modified_z_score is not null)").count() == 0


def test_measures_refuse_meaningless_sums():
    with pytest.raises(ValueError):
        starqueries.measures(("position", "sum"))


def test_strict_validation_raises(spark):
    findings = spark.createDataFrame([("ERROR", "t", "c", "m", 1)], validation.REPORT)
    assert validation.finish_report(findings).count() == 1
    with pytest.raises(Exception, match="validation failed"):
        validation.finish_report(findings, strict=True).collect()
