"""The batch: a raw layer in, an assessed, cleaned and modelled one out."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from starq.plans import cleaning, missing, outliers, quality, reporting, validation, warehouse
from starq.plans.rules import RULES, TableRules
from starq.schemas import PRIMARY_KEY
from starq.session import Staging, configure
from starq.sources.buckets import bucketed_tables
from starq.sources.tables import read_layer, refresh_files, write_text
from starq.sources.versions import Layer


def run(
    spark: SparkSession,
    source: str | None,
    target: str,
    database: str | None = None,
    rules: Mapping[str, TableRules] = RULES,
    strict: bool = False,
) -> dict[str, str]:
    """Reads a layer (a folder, or a catalog database), writes every output of the run to a new folder below target.

    The outputs become the latest ones (`latest`) when all of them are written, by one
    manifest: a run that fails leaves those of the run before.

    Order: assess, judge missing values, detect outliers, clean, verify the cleaned
    layer, build the star, validate it. `strict` fails on broken constraints and on
    errors of the validation, before the star is written. Returns the folder of each
    output. Staged results are removed at the end, whatever happens.
    """
    configure(spark)
    written: dict[str, str] = {}
    layer = Layer(spark, target)
    target = f"{layer.folder}/runs/{uuid.uuid4().hex}"

    def write(name: str, df: DataFrame) -> None:
        written[name] = f"{target}/{name}"
        df.write.mode("overwrite").parquet(written[name])

    def put(name: str, df: DataFrame) -> DataFrame:
        """Written, and read from there by what follows: an output that is staged would be written twice."""
        write(name, df)
        return spark.read.schema(df.schema).parquet(written[name])

    with Staging(spark, "batch") as staging:
        stage = staging.keep
        tables = read_layer(spark, source, rules, required=True, database=database)
        assessed = quality.assess(spark, tables, rules, stage=stage)
        write("quality/check_results", assessed.check_results)
        write("quality/scorecard", assessed.scorecard)
        quality.write_issues(assessed.issues, f"{target}/quality")
        written |= {f"quality/{n}": f"{target}/quality/{n}" for n in ("issues", "referential_integrity_issues")}
        write("quality/unmatched_issues", cleaning.unmatched_issues(assessed.issues, list(tables), rules))
        # One folder per table: each table's cleaning reads its own issues only.
        issues = spark.read.schema(assessed.issues.schema).parquet(written["quality/issues"]).select(*quality.ISSUE_COLUMNS)

        flags = put("missing/flags", missing.missing_flags(tables))
        summary = put("missing/summary", missing.missing_summary(flags, tables))
        found = outliers.detect_from_tables(tables, stage=stage)
        found = outliers.Outliers(put("outliers/flags", found.flags), put("outliers/summary", found.summary))

        bucketed = bucketed_tables(spark, database, PRIMARY_KEY) if database is not None else ()
        cleaned = cleaning.clean(tables, issues, flags, found.flags, rules, stage=stage, bucketed=bucketed)
        clean_tables = cleaned.tables()
        refresh_files(spark, clean_tables, f"{target}/clean")
        written |= {f"clean/{t}": f"{target}/clean/{t}" for t in clean_tables}
        # From here on the written tables are read, not the plans behind them.
        clean_tables = read_layer(spark, f"{target}/clean", clean_tables, required=True)
        actions = put("cleaning/actions", cleaned.actions())
        write("cleaning/rejected", cleaned.rejected())
        write("cleaning/summary_by_table", cleaning.summary_by_table(actions))
        write("cleaning/summary_by_decision", cleaning.summary_by_decision(actions))
        after = quality.assess(spark, clean_tables, rules, stage=stage)
        write("cleaning/before_after", cleaning.before_after(assessed.scorecard, after.scorecard))
        constraints = stage(validation.verify(clean_tables, validation.clean_layer_constraints()))
        write("cleaning/constraints", validation.fail_on_violation(constraints) if strict else constraints)

        star = warehouse.build(clean_tables, stage=stage).tables()
        # A strict run writes no star that breaks a rule.
        star = {name: stage(df) if strict else put(f"star/{name}", df) for name, df in star.items()}
        write("star/validation", validation.validate(clean_tables, star, strict))
        write("star/constraints", validation.verify(star, validation.star_constraints()))
        if strict:
            refresh_files(spark, star, f"{target}/star")
            written |= {f"star/{t}": f"{target}/star/{t}" for t in star}
        write("star/build_log", validation.build_log(star))

        document = reporting.report_document({
            "general_dqa": reporting.general_sections(assessed.scorecard, assessed.check_results, assessed.issues),
            "focused_missing_values": reporting.missing_sections(summary, flags),
            "focused_outlier_detection": reporting.outlier_sections(found.summary, found.flags),
        })
        written["report"] = f"{target}/report"
        write_text(document, written["report"])
        layer.adopt({n: f for n, f in written.items() if n != "report"}, {"report": written["report"]})
    return written


def latest(spark: SparkSession, target: str) -> dict[str, str]:
    """The folder of each output of the last run that came to its end."""
    manifest = Layer(spark, target).manifest()
    return {name: manifest.folders(name)[0] for name in manifest.tables} | manifest.files


def sizes(spark: SparkSession, written: Mapping[str, str]) -> DataFrame:
    """Rows of every output of a run, read back."""
    frames = [
        (spark.read.text(path) if name == "report" else spark.read.parquet(path)).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("output"), "row_count")
        for name, path in written.items()
    ]
    return reduce(DataFrame.unionByName, frames)
