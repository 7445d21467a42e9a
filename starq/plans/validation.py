"""Checks of finished layers: constraint violations, star-schema validation, build log."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starq import schemas as s
from starq.operators.joins import missing_columns
from starq.plans.quality import comparable, comparable_form, ident
from starq.plans.warehouse import CONTEXT_DIMENSIONS, LAP_CONTEXT, RESULT_CONTEXT

# --- constraints ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Constraint:
    name: str
    kind: str  # primary_key | unique | foreign_key | check
    table: str
    columns: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    holds: Callable[[], Column] | None = None


# Check constraints of the cleaned layer.
CHECKS = (
    Constraint("ck_session_type", "check", "session", ("session_type",),
               holds=lambda: F.col("session_type").isin(*s.SESSION_TYPES)),
    Constraint("ck_grand_prix_round_positive", "check", "grand_prix", ("round_number",),
               holds=lambda: F.col("round_number") > 0),
    Constraint("ck_lap_number_positive", "check", "lap", ("lap_number",), holds=lambda: F.col("lap_number") > 0),
    Constraint("ck_lap_time_positive", "check", "lap", ("lap_time_ms",), holds=lambda: F.col("lap_time_ms") > 0),
    Constraint("ck_result_points_non_negative", "check", "result", ("points",), holds=lambda: F.col("points") >= 0),
    Constraint("ck_weather_wind_speed_non_negative", "check", "weather", ("wind_speed",),
               holds=lambda: F.col("wind_speed") >= 0),
)


def clean_layer_constraints() -> list[Constraint]:
    out = [Constraint(f"pk_{t}", "primary_key", t, (k,)) for t, k in s.PRIMARY_KEY.items()]
    out += [Constraint(f"uq_{t}_natural", "unique", t, k) for t, k in s.NATURAL_KEYS.items()]
    for t, references in s.FOREIGN_KEYS.items():
        out += [Constraint(f"fk_{t}_{p}", "foreign_key", t, (col,), p, pc) for col, p, pc in references]
    return out + list(CHECKS)


DIMENSION_KEYS = {
    "dim_driver": "driver_id", "dim_team": "team_id", "dim_grand_prix": "grand_prix_id",
    **{d: key for d, (key, _) in CONTEXT_DIMENSIONS.items()},
}
FACT_KEYS = {"fact_lap_performance": "lap_performance_key", "fact_session_result": "session_result_key"}
FACT_CONTEXT = {"fact_lap_performance": LAP_CONTEXT, "fact_session_result": RESULT_CONTEXT}
SHARED = ("dim_driver", "dim_team", "dim_grand_prix")


def star_constraints() -> list[Constraint]:
    out = [Constraint(f"pk_{t}", "primary_key", t, (k,)) for t, k in {**DIMENSION_KEYS, **FACT_KEYS}.items()]
    for fact, context in FACT_CONTEXT.items():
        for d in (*SHARED, *context):
            k = DIMENSION_KEYS[d]
            out.append(Constraint(f"fk_{fact}_{k}_to_{d}_{k}", "foreign_key", fact, (k,), d, k))
    return out


def _row_checks(table: str, df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """One pass over a table for all its checks. As in SQL, an unknown result does not violate one."""
    counts = [F.count_if(~F.coalesce(c.holds(), F.lit(True))).alias(f"n{i}") for i, c in enumerate(constraints)]
    entries = [_counted(c, F.col(f"n{i}")) for i, c in enumerate(constraints)]
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def _unique_key(df: DataFrame, c: Constraint) -> DataFrame:
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in c.columns])
    per_key = df.groupBy(*c.columns).agg(F.count("*").alias("_n")).withColumn("_complete", complete)
    bad = F.col("_complete") & (F.col("_n") > 1)
    if c.kind == "primary_key":
        bad |= ~F.col("_complete")
    counted = per_key.agg(F.coalesce(F.sum(F.when(bad, F.col("_n"))), F.lit(0)).alias("violations"))
    return counted.select(F.inline(F.array(_counted(c, F.col("violations")))))


def _references(table: str, df: DataFrame, constraints: Sequence[Constraint], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One pass over a table for all its references. Their values are counted before the shuffle."""
    entries, parents = [], []
    for i, c in enumerate(constraints):
        child, parent = c.columns[0], tables[c.parent]
        form = comparable_form(df.schema[child].dataType, parent.schema[c.parent_column].dataType)
        entries.append(f"case when {ident(child)} is not null then named_struct('_i', {i}, '_key', {comparable(child, form)}) end")
        parents.append(
            parent.where(F.col(c.parent_column).isNotNull()).selectExpr(f"{i} as _i", f"{comparable(c.parent_column, form)} as _key")
        )
    values = df.selectExpr(f"inline(array({', '.join(entries)}))").where("_i is not null").groupBy("_i", "_key").agg(F.count("*").alias("_n"))
    orphans = values.join(reduce(DataFrame.unionByName, parents), ["_i", "_key"], "left_anti")
    per_reference = orphans.groupBy("_i").agg(F.sum("_n").alias("_n"))
    found = per_reference.agg(F.map_from_entries(F.collect_list(F.struct("_i", "_n"))).alias("_found"))
    rows = [_counted(c, F.coalesce(F.try_element_at("_found", F.lit(i)), F.lit(0))) for i, c in enumerate(constraints)]
    return found.select(F.inline(F.array(*rows)))


def _counted(c: Constraint, n: Column) -> Column:
    return F.struct(
        F.lit(c.name).alias("constraint_name"), F.lit(c.kind).alias("constraint_type"), F.lit(c.table).alias("table_name"),
        n.cast("bigint").alias("violations"),
    )


def verify(tables: Mapping[str, DataFrame], constraints: Sequence[Constraint]) -> DataFrame:
    """Rows that break each constraint; constraints whose tables or columns are absent do not apply.

    A table is read once for its checks, once for its references, and once per key.
    """
    frames = []
    for table, df in tables.items():
        own = [c for c in constraints if c.table == table and not missing_columns(df, c.columns)]
        checks = [c for c in own if c.kind == "check"]
        references = [
            c for c in own if c.kind == "foreign_key" and c.parent in tables and c.parent_column in tables[c.parent].columns
        ]
        frames += [_row_checks(table, df, checks)] if checks else []
        frames += [_references(table, df, references, tables)] if references else []
        frames += [_unique_key(df, c) for c in own if c.kind in ("primary_key", "unique")]
    return reduce(DataFrame.unionByName, frames)


def fail_on_violation(report: DataFrame) -> DataFrame:
    """The report, failing the query when a constraint is violated."""
    message = F.concat(F.col("constraint_name"), F.lit(" is violated by "), F.col("violations").cast("string"), F.lit(" rows"))
    return report.where(F.when(F.col("violations") > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


# --- validation of the star ----------------------------------------------------------------------------------------

REPORT = "severity string, table_name string, check_name string, message string, affected_rows bigint"
REPORT_COLUMNS = ("severity", "table_name", "check_name", "message", "affected_rows")
# The report's columns and its row when all is well.
OK_ROW = ("OK", "all", "all_checks", "No validation issues found.", 0)

# Allowed classes.
_LEVELS = ("Low", "Medium", "High", "Unknown")
_SESSION = ("Q", "R", "Unknown")
DOMAINS = (
    ("fact_lap_performance", "session_type", _SESSION),
    ("fact_session_result", "session_type", _SESSION),
    ("fact_lap_performance", "lap_type", ("NormalLap", "OutLap", "InLap", "PitAffectedLap", "Unknown")),
    ("fact_lap_performance", "track_status_category",
     ("AllClear", "Yellow", "SCDeployed", "VSCDeployed", "VSCEnding", "Red", "Other", "Unknown")),
    ("dim_lap_weather_context", "air_temp_class", _LEVELS),
    ("dim_lap_weather_context", "track_temp_class", _LEVELS),
    ("dim_lap_weather_context", "wind_speed_class", _LEVELS),
    ("dim_tyre_context", "tyre_life_class", _LEVELS),
    ("dim_tyre_context", "starting_tyre_set_status", ("NewSet", "UsedSet", "Unknown")),
    ("dim_result_outcome", "result_classification_category",
     ("Classified", "Retired", "Withdrawn", "Disqualified", "Excluded", "NotClassified", "FailedToQualify",
      "NotApplicable", "Other")),
    ("dim_result_outcome", "result_status_category",
     ("Finished", "Lapped", "Disqualified", "DidNotStart", "Accident", "Collision", "PowerUnitIssue",
      "MechanicalIssue", "Retired", "Other", "NotApplicable")),
    ("dim_result_weather_context", "avg_air_temp_class", _LEVELS),
    ("dim_result_weather_context", "avg_track_temp_class", _LEVELS),
    ("dim_result_weather_context", "avg_wind_speed_class", _LEVELS),
)
# What the flattened dimension must hold, and what facts must not.
CIRCUIT_ATTRIBUTES = (
    "circuit_name", "country", "location", "global_circuit_category", "sector1_category", "sector2_category",
    "sector3_category",
)
FORBIDDEN_FACT_COLUMNS = ("session_id", "circuit_id", "season_year", "lap_id", "result_id")


@dataclass(frozen=True)
class Rule:
    """Counts the rows of a table that break it: by an aggregate, or as rows whose key occurs twice."""

    table: str
    check: str
    message: str
    count: Column | None = None
    key: tuple[str, ...] = ()


# Rules, and findings that names and columns alone tell (rows of REPORT). Fixed values:
# check names and messages below.
Plan = tuple[list[Rule], list[tuple]]


def duplicate_rules(df: DataFrame, table: str, key: Sequence[str]) -> Plan:
    present = tuple(k for k in key if k in df.columns)
    if not present:
        return [], [("ERROR", table, "duplicate_key", "No key columns available for duplicate check.", None)]
    return [Rule(table, "duplicate_key", f"Duplicated values found for key columns: {list(present)}", key=present)], []


def missing_key_rules(df: DataFrame, table: str, keys: Sequence[str]) -> Plan:
    rules = [
        Rule(table, "missing_dimension_key", f"Column {k} contains missing values.", F.count_if(F.col(k).isNull()))
        for k in keys if k in df.columns
    ]
    return rules, [
        ("ERROR", table, "missing_key_column", f"Column {k} is missing.", None) for k in keys if k not in df.columns
    ]


def domain_rules(df: DataFrame, table: str, column: str, allowed: Sequence[str], allow_null: bool = False) -> Plan:
    if column not in df.columns:
        return [], [("WARNING", table, "missing_domain_column", f"Column {column} is missing.", None)]
    known = F.coalesce(F.col(column).isin(*allowed), F.lit(allow_null))
    text = f"Column {column} contains values outside {sorted(allowed)}."
    return [Rule(table, "invalid_domain", text, F.count_if(~known))], []


def forbidden_rules(df: DataFrame, table: str) -> Plan:
    present = [n for n in FORBIDDEN_FACT_COLUMNS if n in df.columns]
    text = f"Forbidden columns found in fact table: {present}"
    return [Rule(table, "forbidden_fact_columns", text, F.count(F.lit(1)))] if present else [], []


def gap_rules() -> Plan:
    wrong = F.coalesce(F.upper("session_type") == "Q", F.lit(False)) & F.col("gap_to_leader_ms").isNotNull()
    text = "gap_to_leader_ms must be NULL for Qualifying results."
    return [Rule("fact_session_result", "qualifying_gap_must_be_null", text, F.count_if(wrong))], []


_SIZE = "SIZE"  # marks the measured number of rows of a table


def _finding(severity: str, table: str, check: str, message: str | Column, rows: Column | int | None) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    count = rows if isinstance(rows, Column) else F.lit(rows)
    return F.struct(
        F.lit(severity).alias("severity"), F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
        text.alias("message"), count.cast("bigint").alias("affected_rows"),
    )


def findings(
    tables: Mapping[str, DataFrame], plans: Sequence[Plan], larger: Sequence[tuple[str, str]] = ()
) -> DataFrame:
    """What rules find, and pairs (source, output) of tables whose output is the larger one.

    Every table is read once for all its counts and once per key; the measurements,
    one row per rule, meet in a single row.
    """
    rules = [r for plan, _ in plans for r in plan]
    sized = {t for pair in larger for t in pair}
    spark = next(iter(tables.values())).sparkSession
    frames = []
    for table, df in tables.items():
        counted = [r for r in rules if r.table == table and not r.key]
        aggregates = [r.count.alias(f"n{i}") for i, r in enumerate(counted)]
        entries = [_finding("ERROR", table, r.check, r.message, F.col(f"n{i}")) for i, r in enumerate(counted)]
        if table in sized:
            aggregates.append(F.count(F.lit(1)).alias("size"))
            entries.append(_finding(_SIZE, table, "", "", F.col("size")))
        if entries:
            frames.append(df.agg(*aggregates).select(F.inline(F.array(*entries))))
        for r in (r for r in rules if r.table == table and r.key):
            per_key = df.groupBy(*r.key).agg(F.count("*").alias("_n"))
            bad = per_key.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("bad"))
            frames.append(bad.select(F.inline(F.array(_finding("ERROR", table, r.check, r.message, F.col("bad"))))))
    known = [_finding(*row) for _, rows in plans for row in rows]
    frames = frames or [spark.range(1).select(F.inline(F.array(_finding("ERROR", "", "", "", 0))))]
    measured = reduce(DataFrame.unionByName, frames).agg(F.collect_list(F.struct("*")).alias("m"))
    sizes = F.map_from_entries(
        F.transform(F.filter("m", lambda x: x["severity"] == _SIZE), lambda x: F.struct(x["table_name"], x["affected_rows"]))
    )
    measured = measured.withColumn("sizes", sizes)
    grown = []
    for source, output in larger:
        n_in, n_out = F.element_at("sizes", F.lit(source)), F.element_at("sizes", F.lit(output))
        text = F.concat(
            F.lit(f"Output has more rows than source {source}: "), n_out.cast("string"), F.lit(" > "), n_in.cast("string"), F.lit("."),
        )
        grown.append(F.when(n_out > n_in, _finding("ERROR", output, "row_count", text, n_out - n_in)))
    broken = F.filter("m", lambda x: (x["severity"] != _SIZE) & (x["affected_rows"] > 0))
    parts = [broken, *([F.array(*known)] if known else []), *([F.array_compact(F.array(*grown))] if grown else [])]
    return measured.select(F.inline(F.concat(*parts)))


def duplicate_rows(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    return findings({table: df}, [duplicate_rules(df, table, key)])


def missing_keys(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    return findings({table: df}, [missing_key_rules(df, table, keys)])


def more_rows_than_source(source: DataFrame, output: DataFrame, source_name: str, name: str) -> DataFrame:
    return findings({source_name: source, name: output}, [], [(source_name, name)])


def schema_findings(tables: Mapping[str, DataFrame]) -> list[tuple]:
    """What can be told from table names and columns alone."""
    rows = []
    dims = {t for t in tables if t.startswith("dim_")}
    unexpected, absent = sorted(dims - set(DIMENSION_KEYS)), sorted(set(DIMENSION_KEYS) - dims)
    if unexpected:
        rows.append(("ERROR", "warehouse", "unexpected_dimension_tables",
                     f"Unexpected dimensions found: {unexpected}", len(unexpected)))
    if absent:
        rows.append(("ERROR", "warehouse", "missing_dimension_tables",
                     f"Required dimensions missing: {absent}", len(absent)))
    present = tables["dim_grand_prix"].columns if "dim_grand_prix" in tables else []
    lacking = sorted(set(CIRCUIT_ATTRIBUTES) - set(present))
    if lacking:
        rows.append(("ERROR", "dim_grand_prix", "missing_circuit_attributes",
                     f"Circuit-level attributes missing: {lacking}", len(lacking)))
    return rows


def validate(
    sources: Mapping[str, DataFrame], star: Mapping[str, DataFrame], strict: bool = False
) -> DataFrame:
    """All findings; a single OK row when there are none. strict raises on errors."""
    plans: list[Plan] = [([], schema_findings(star))]
    for table, key in {**FACT_KEYS, **DIMENSION_KEYS}.items():
        if table in star:
            plans.append(duplicate_rules(star[table], table, [key]))
    for table, key in DIMENSION_KEYS.items():
        if table in star:
            plans.append(missing_key_rules(star[table], table, [key]))
    for fact, context in FACT_CONTEXT.items():
        plans.append(missing_key_rules(star[fact], fact, [DIMENSION_KEYS[d] for d in (*SHARED, *context)]))
        plans.append(forbidden_rules(star[fact], fact))
    plans.append(gap_rules())
    plans += [domain_rules(star[t], t, column, allowed) for t, column, allowed in DOMAINS if t in star]
    larger = [("lap", "fact_lap_performance"), ("result", "fact_session_result")]
    read = {**star, **{source: sources[source] for source, _ in larger}}
    return finish_report(findings(read, plans, larger), strict)


def finish_report(found: DataFrame, strict: bool = False) -> DataFrame:
    """The findings, read once, or the OK row."""
    gathered = found.agg(F.collect_list(F.struct(*REPORT_COLUMNS)).alias("m"))
    ok = F.array(_finding(*OK_ROW))
    report = gathered.select(F.inline(F.when(F.size("m") == 0, ok).otherwise(F.col("m"))))
    if strict:
        error = F.raise_error(F.concat(F.lit("validation failed: "), F.col("table_name"), F.lit(": "), F.col("message")))
        report = report.where(F.when(F.col("severity") == "ERROR", error.cast("boolean")).otherwise(F.lit(True)))
    return report


def build_log(tables: Mapping[str, DataFrame], order: Sequence[str] = ()) -> DataFrame:
    """Rows and columns of every table. The time stamp is that of the query."""
    names = [t for t in order if t in tables] + [t for t in tables if t not in order]
    frames = [
        tables[t].agg(F.count("*").alias("row_count")).select(
            F.lit(t).alias("table_name"), "row_count", F.lit(len(tables[t].columns)).cast("bigint").alias("column_count"),
            F.current_timestamp().alias("created_at_utc"), F.lit("created").alias("status"),
        )
        for t in names
    ]
    return reduce(DataFrame.unionByName, frames)
