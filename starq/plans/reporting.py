"""The tables behind charts, indicator cards and the nested report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starq.plans.quality import dimension_column
from starq.schemas import INFORMATION_AREAS, QUALITY_DIMENSIONS

SCORE_COLUMNS = tuple(dimension_column(d) for d in QUALITY_DIMENSIONS)
# Row limits of the report.
LIMITS = {"issues": 30, "checks": 30, "references": 20, "missing": 30, "summary": 40, "outliers": 30, "tables": 5}
AREA_COLUMNS = tuple(f"{a.lower()}_count" for a in INFORMATION_AREAS)


def score_by_table(scorecard: DataFrame) -> DataFrame:
    return scorecard.where(F.col("overall_score").isNotNull()).select("table_name", "overall_score").orderBy(
        "overall_score", "table_name"
    )


def issues_by_table(scorecard: DataFrame) -> DataFrame:
    return scorecard.select("table_name", F.coalesce("issue_count", F.lit(0)).alias("issue_count")).orderBy(
        "issue_count", "table_name"
    )


def score_color(value: Column) -> Column:
    # Colours of the bands.
    return (
        F.when(value.isNull() | F.isnan(value), "#e5e7eb")
        .when(value >= 0.95, "#79b66c")
        .when(value >= 0.80, "#f1c75b")
        .otherwise("#d46a6a")
    )


def score_matrix(scorecard: DataFrame) -> DataFrame:
    """Table x dimension in long form with the colour of the score."""
    present = [c for c in SCORE_COLUMNS if c in scorecard.columns]
    long = scorecard.select("table_name", *present).unpivot("table_name", present, "dimension", "score")
    return long.withColumn("color", score_color(F.col("score")))


def totals_by_class(summary: DataFrame) -> DataFrame:
    totals = summary.agg(
        F.sum("explained_null_count").alias("Explained null"), F.sum("suspicious_null_count").alias("Suspicious null")
    )
    long = totals.unpivot([], ["Explained null", "Suspicious null"], "null_class", "missing_values")
    return long.withColumn("missing_values", F.coalesce("missing_values", F.lit(0)))


def area_label(column: Column) -> Column:
    return F.initcap(F.translate(F.regexp_replace(column, "(_information)?_count$", ""), "_", " "))


def _area_totals(summary: DataFrame) -> DataFrame:
    totals = summary.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in AREA_COLUMNS])
    return totals.unpivot([], list(AREA_COLUMNS), "area_column", "missing_values")


def totals_by_area(summary: DataFrame) -> DataFrame:
    return _area_totals(summary).where(F.col("missing_values") > 0).select(
        area_label(F.col("area_column")).alias("information_area"), "missing_values"
    )


def completed(outlier_summary: DataFrame) -> DataFrame:
    return outlier_summary.where(F.lower("status") == "completed")


def outliers_by_metric(outlier_summary: DataFrame) -> DataFrame:
    return completed(outlier_summary).groupBy("metric").agg(F.sum("consensus_outliers").alias("consensus_outliers"))


def outlier_rates(outlier_summary: DataFrame) -> DataFrame:
    sums = completed(outlier_summary).groupBy("metric").agg(
        F.sum("tested_values").alias("tested_values"), F.sum("consensus_outliers").alias("consensus_outliers")
    )
    rate = F.try_divide(F.col("consensus_outliers"), F.col("tested_values")) * 100
    return sums.withColumn("consensus_outlier_rate", F.coalesce(rate, F.lit(0.0)))


def methods_by_metric(outlier_summary: DataFrame) -> DataFrame:
    return completed(outlier_summary).groupBy("metric").agg(
        *[F.sum(c).alias(c) for c in ("iqr_outliers", "modified_z_outliers", "consensus_outliers")]
    )


def indicator_cards(
    scorecard: DataFrame, issues: DataFrame, missing_summary: DataFrame, outlier_summary: DataFrame
) -> DataFrame:
    """One row of headline numbers. Every input is reduced to a single row first."""

    def top(value: Column, label: Column, largest: bool) -> Column:
        # Equal values: the first label.
        return F.min_by(label, F.struct(-value if largest else value, label))

    scores = scorecard.agg(
        F.count("*").alias("tables_assessed"), F.round(F.avg("overall_score"), 6).alias("average_score"),
        F.min_by("table_name", F.struct(F.col("overall_score").isNull(), "overall_score", "table_name")).alias("worst_table"),
    )
    issue_count = issues.agg(F.count("*").alias("issues"))
    missing = missing_summary.agg(
        F.coalesce(F.sum("missing_count"), F.lit(0)).alias("missing_values"),
        F.coalesce(F.sum("suspicious_null_count"), F.lit(0)).alias("suspicious_nulls"),
    )
    areas = _area_totals(missing_summary).agg(
        top(F.col("missing_values"), F.col("area_column"), True).alias("_area")
    ).select(area_label(F.col("_area")).alias("top_missing_area"))
    metrics = outliers_by_metric(outlier_summary).agg(
        F.coalesce(F.sum("consensus_outliers"), F.lit(0)).alias("consensus_outliers"),
        F.coalesce(top(F.col("consensus_outliers"), F.col("metric"), True), F.lit("N/A")).alias("top_outlier_metric"),
    )
    return side_by_side([scores, issue_count, missing, areas, metrics])


def side_by_side(single_rows: Sequence[DataFrame]) -> DataFrame:
    """The columns of several one-row frames in one row."""
    tagged = [df.select(F.lit(1).alias("_one"), "*") for df in single_rows]
    return reduce(lambda a, b: a.join(b, "_one"), tagged).drop("_one")


# --- report sections -----------------------------------------------------------------------------------------------


def _head(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _all_columns(df: DataFrame) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in df.columns]


def general_sections(
    scorecard: DataFrame, checks: DataFrame, issues: DataFrame
) -> dict[str, DataFrame]:
    references = issues.where(F.col("dimension") == "Referential Integrity")

    def counted(df: DataFrame, column: str) -> DataFrame:
        return df.groupBy(column).agg(F.count("*").alias("num_issues"))

    return {
        "totals": side_by_side([
            scorecard.agg(
                F.count("*").alias("num_tables_assessed"), F.round(F.avg("overall_score"), 6).alias("average_overall_score")
            ),
            checks.agg(F.count("*").alias("num_checks")),
            issues.agg(F.count("*").alias("num_issues")),
        ]),
        "worst_tables": _head(scorecard, LIMITS["tables"], F.col("overall_score").asc_nulls_last(), "table_name"),
        "best_tables": _head(scorecard, LIMITS["tables"], F.col("overall_score").desc_nulls_last(), "table_name"),
        "scorecard_by_table": scorecard,
        "failed_or_warning_checks": _head(
            checks.where(F.lower("status").isin("red", "yellow")), LIMITS["checks"],
            F.desc("status"), F.col("score").asc_nulls_last(), "table_name", "check_id",
        ),
        "check_status_by_dimension": checks.groupBy("dimension", "status").agg(F.count("*").alias("num_checks")),
        "issues_by_table": counted(issues, "table_name"),
        "issues_by_dimension": counted(issues, "dimension"),
        "sample_issues": _head(issues, LIMITS["issues"], *_all_columns(issues)),
        "referential_integrity_issues": _head(
            counted(references, "check_id"), LIMITS["references"], F.desc("num_issues"), "check_id"
        ),
    }


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "red", 0).when(severity == "yellow", 1).when(severity == "green", 2).otherwise(9)


def critical_patterns(flags: DataFrame) -> DataFrame:
    keys = ["table_name", "column_name", "missing_class", "missing_information_area", "severity"]
    counted = flags.groupBy(*keys).agg(F.count("*").alias("num_flags"))
    return _head(counted, LIMITS["missing"], severity_rank(F.col("severity")), F.desc("num_flags"), *keys)


def missing_sections(summary: DataFrame, flags: DataFrame) -> dict[str, DataFrame]:
    sums = ("missing_count", "suspicious_null_count", "explained_null_count")
    return {
        "totals": side_by_side([
            summary.agg(
                F.count("*").alias("num_missing_summary_rows"), F.sum("missing_count").alias("total_missing_values"),
                F.sum("explained_null_count").alias("total_explained_nulls"),
                F.sum("suspicious_null_count").alias("total_suspicious_nulls"),
            ),
            flags.agg(F.count("*").alias("num_missing_row_flags")),
        ]),
        "summary_rows": _head(
            summary, LIMITS["missing"], F.desc("suspicious_null_count"), F.desc("missing_count"), "table_name", "column_name"
        ),
        "missing_by_table": summary.groupBy("table_name").agg(*[F.sum(c).alias(c) for c in sums]),
        "missing_by_information_area": _area_totals(summary).where(F.col("missing_values") > 0).select(
            F.upper(F.regexp_replace("area_column", "_count$", "")).alias("missing_information_area"),
            F.col("missing_values").alias("missing_count"),
        ),
        "missing_by_severity": flags.groupBy("severity").agg(F.count("*").alias("num_flags")),
        "critical_missing_patterns": critical_patterns(flags),
        "sample_high_priority_missing_flags": _head(
            flags.where(F.lower("severity").isin("red", "yellow")), LIMITS["missing"], *_all_columns(flags)
        ),
    }


def outlier_sections(summary: DataFrame, flags: DataFrame) -> dict[str, DataFrame]:
    numbers = ("tested_values", "iqr_outliers", "modified_z_outliers", "consensus_outliers")
    strong = flags.where(F.col("consensus_score") >= 2)
    return {
        "totals": side_by_side([
            summary.agg(F.count("*").alias("num_outlier_summary_rows"), *[F.sum(n).alias(f"total_{n}") for n in numbers]),
            flags.agg(
                F.count("*").alias("num_outlier_row_flags"),
                F.count_if(F.col("consensus_score") >= 2).alias("strong_consensus_flag_count"),
                F.count_if(F.col("consensus_score") == 1).alias("weak_anomaly_flag_count"),
            ),
        ]),
        "summary_rows": _head(
            summary, LIMITS["summary"], F.desc("consensus_outliers"), F.desc("modified_z_outliers"),
            F.desc("iqr_outliers"), "session_id", "metric",
        ),
        "outliers_by_metric": summary.groupBy("metric").agg(*[F.sum(n).alias(n) for n in numbers]),
        "top_outlier_sessions": _head(summary, LIMITS["summary"], F.desc("consensus_outliers"), "session_id", "metric"),
        "outlier_flags_by_interpretation": flags.groupBy("interpretation").agg(F.count("*").alias("num_flags")),
        "strong_consensus_by_metric": strong.groupBy("metric").agg(
            F.count("*").alias("num_strong_consensus_flags")
        ),
        "sample_strong_consensus_outliers": _head(
            strong, LIMITS["outliers"], F.desc("consensus_score"), "metric", "row_identifier"
        ),
    }


def _without_nan(df: DataFrame) -> DataFrame:
    """NaN and infinite numbers as NULL, so that the JSON stays valid."""
    doubles = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns(
        {n: F.when(~F.isnan(n) & (F.abs(F.col(n)) < float("inf")), F.col(n)) for n in doubles}
    ) if doubles else df


def report_document(sections: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """One row with the nested JSON report.

    Only aggregated or limited sections are gathered: rows here are tables,
    checks, dimensions, metrics or samples, never data rows.
    """
    parts = []
    for part, frames in sections.items():
        gathered = []
        for name, df in frames.items():
            row = F.struct(*df.columns)
            one = _without_nan(df).agg(F.sort_array(F.collect_list(row)).alias(name))
            gathered.append(one)
        whole = side_by_side(gathered)
        parts.append(whole.select(F.struct(*whole.columns).alias(part)))
    document = side_by_side(parts)
    return document.select(F.to_json(F.struct(*document.columns), {"ignoreNullFields": "false"}).alias("document"))
