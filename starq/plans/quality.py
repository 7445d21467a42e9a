"""Data-quality assessment: rules compiled to DataFrame plans.

Per table: one aggregate answers every row-level check and one pass over the rows
emits their issues. All keys and references are tagged with their check, named by 128
bits of hash and shuffled once, whatever their tables; a key that fills a third of a
table is one row after the map side. The failing keys alone give the counts; the rows
that hold them are looked up when the issues are asked for.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starq.functions.scalars import BLANKS, lookup, score, score_status
from starq.operators.joins import missing_columns
from starq.plans.rules import RULES, Check, Reference, Required, TableRules
from starq.schemas import QUALITY_DIMENSIONS
from starq.sources.tables import write_by_value

CHECK_COLUMNS = (
    "table_name", "dimension", "check_id", "check_description", "passed_count", "failed_count", "total_count", "score",
    "status",
)
ISSUE_COLUMNS = (
    "table_name", "row_identifier", "dimension", "check_id", "issue_code", "issue_description", "severity",
)
_COUNTS = "table_name string, dimension string, check_id string, check_description string, failed_count bigint, total_count bigint"
_TABLE_ROW = "__table__"


# --- row-level predicates as SQL text: (applicable, failing) -------------------------------------------------------


def quoted(text: str) -> str:
    """A SQL string literal (raw, so patterns keep their backslashes)."""
    if "'" not in text:
        return f"r'{text}'"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    """A column name as SQL text, whatever its characters."""
    return "`" + name.replace("`", "``") + "`"


def without_nan(df: DataFrame) -> DataFrame:
    """NaN counts as missing in every rule, so it is missing from here on."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(ident(c))), F.col(ident(c))) for c in numbers}) if numbers else df


def sure(condition: str) -> str:
    """Two-valued: an unknown comparison counts as false."""
    return f"coalesce({condition}, false)"


def sql_strip(c: str) -> str:
    """As `strip`, with its short cut where `c` is a column."""
    text = f"cast({c} as string)"
    trimmed = f"btrim({text}, {quoted(BLANKS)})"
    if not re.fullmatch(r"\w+|`(?:[^`]|``)+`", c):
        return trimmed
    visible = f"ascii({text}) between 33 and 126 and ascii(substring({text}, -1, 1)) between 33 and 126"
    return f"case when {visible} then {text} else {trimmed} end"


def sql_number(c: str) -> str:
    return f"nullif(try_cast({c} as double), double('NaN'))"


def _any(conditions: Iterable[str]) -> str:
    return "(" + " or ".join(conditions) + ")"


def _all(conditions: Iterable[str]) -> str:
    return "(" + " and ".join(conditions) + ")"


def value_ok(c: str, check: Check) -> str:
    """Whether a present value satisfies a validity rule."""
    if check.kind == "domain":
        allowed = ", ".join(quoted(a) for a in check.options["allowed"])
        whole = f"cast(try_cast({sql_number(c)} as bigint) as string)"
        return _any([sure(f"{sql_strip(c)} in ({allowed})"), sure(f"{whole} in ({allowed})")])
    if check.kind == "range":
        v = sql_number(c)
        limits = [f"{v} is not null"]
        if "min" in check.options:
            limits.append(f"{v} >= {float(check.options['min'])}D")
        if "max" in check.options:
            limits.append(f"{v} <= {float(check.options['max'])}D")
        return sure(_all(limits))
    if check.kind in ("url", "regex"):
        pattern = "https?://" if check.kind == "url" else check.options["pattern"]
        return sure(f"{sql_strip(c)} rlike {quoted(f'^(?:{pattern})')}")
    raise ValueError(f"unsupported validity rule: {check.kind}")


def validity(check: Check) -> tuple[str, str]:
    columns = [ident(c) for c in check.columns]
    applicable = _any(f"{c} is not null" for c in columns)
    return applicable, _any(f"({c} is not null and not {value_ok(c, check)})" for c in columns)


def _dates_in_order(o) -> tuple[str, str]:
    both = f"({o['start']} is not null and {o['end']} is not null)"
    return both, f"{both} and {sure(f'{o['start']} > {o['end']}')}"


def _dates_in_year(o) -> tuple[str, str]:
    year = sql_number(o["year"])
    applicable = f"({year} is not null and {_any(f'{d} is not null' for d in o['dates'])})"
    return applicable, f"{applicable} and {_any(sure(f'year({d}) <> {year}') for d in o['dates'])}"


def _date_near_parent(o) -> tuple[str, str]:
    day = f"to_date({o['date']})"
    applicable = f"({day} is not null and _parent_min is not null)"
    early = f"datediff(_parent_max, {day}) > {o['days_before']}"
    return applicable, f"{applicable} and {_any([sure(early), sure(f'datediff({day}, _parent_min) > 0')])}"


def _parts_sum_to_total(o) -> tuple[str, str]:
    parts = [sql_number(p) for p in o["parts"]]
    total = sql_number(o["total"])
    applicable = _all([f"{c} is not null" for c in (total, *parts)] + [f"{c} is null" for c in o["unless"]])
    return applicable, f"{applicable} and {sure(f'abs({' + '.join(parts)} - {total}) > {o['tolerance']}')}"


def _age_between(o) -> tuple[str, str]:
    born = o["born"]
    too_young = f"{o['first_year']} - year({born}) < {o['youngest']}"
    too_old = f"{o['last_year']} - year({born}) > {o['oldest']}"
    return f"({born} is not null)", _any([sure(too_young), sure(too_old)])


def _difference_at_most(o) -> tuple[str, str]:
    left, right = sql_number(o["left"]), sql_number(o["right"])
    applicable = f"({left} is not null and {right} is not null)"
    return applicable, f"{applicable} and {sure(f'abs({left} - {right}) > {o['limit']}')}"


def sql_map(entries: Mapping) -> str:
    return "map(" + ", ".join(f"{k if isinstance(k, int) else quoted(k)}, {quoted(v)}" for k, v in entries.items()) + ")"


def _code_matches_text(o) -> tuple[str, str]:
    applicable = f"({o['code']} is not null and {o['text']} is not null)"
    expected = f"try_element_at({sql_map(o['mapping'])}, try_cast({sql_number(o['code'])} as int))"
    return applicable, f"{applicable} and not {sure(f'{sql_strip(o['text'])} = {expected}')}"


def _segments_in_order(o) -> tuple[str, str]:
    pairs = zip(o["segments"], o["segments"][1:])
    return "true", _any(f"({after} is not null and {before} is null)" for before, after in pairs)


# name -> (columns the options name, predicate builder)
CUSTOM_CHECKS = {
    "dates_in_order": (lambda o: (o["start"], o["end"]), _dates_in_order),
    "dates_in_year": (lambda o: (o["year"], *o["dates"]), _dates_in_year),
    "date_near_parent": (lambda o: (o["key"], o["date"]), _date_near_parent),
    "parts_sum_to_total": (lambda o: (o["total"], *o["parts"]), _parts_sum_to_total),
    "age_between": (lambda o: (o["born"],), _age_between),
    "difference_at_most": (lambda o: (o["left"], o["right"]), _difference_at_most),
    "code_matches_text": (lambda o: (o["code"], o["text"]), _code_matches_text),
    "segments_in_order": (lambda o: o["segments"], _segments_in_order),
}


# Options of custom checks that name columns (one, or several).
COLUMN_OPTIONS = (
    "start", "end", "year", "dates", "date", "parts", "total", "unless", "born", "left", "right", "code", "text", "segments",
)


def _as_idents(options: Mapping) -> dict:
    def named(value):
        return ident(value) if isinstance(value, str) else [ident(v) for v in value]

    return {k: named(v) if k in COLUMN_OPTIONS else v for k, v in options.items()}


def sql_row_identifier(columns: Sequence[str], key: Sequence[str]) -> str:
    """'pk=value', or a hash of the row when a part of the key is missing."""
    fallback = f"concat('row_index=', cast(xxhash64({', '.join(map(ident, columns))}) as string))"
    if not key or any(k not in columns for k in key):
        return fallback
    named = "concat_ws(';', " + ", ".join(f"concat({quoted(f'{k}=')}, cast({ident(k)} as string))" for k in key) + ")"
    return f"case when {_all(f'{ident(k)} is not null' for k in key)} then {named} else {fallback} end"


def row_identifier(columns: Sequence[str], key: Sequence[str]) -> Column:
    return F.expr(sql_row_identifier(columns, key))


# --- compilation ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Counted:
    """A check that one aggregate per table counts together with the others."""

    dimension: str
    check_id: str
    description: str
    total: str  # aggregate
    failed: str | None  # aggregate, or None when the keyed passes count it
    issues: str | None = None  # aggregate: rows with an issue, where these are not what failed


@dataclass(frozen=True)
class _Keyed:
    """A check decided by comparing a key with other rows: uniqueness, or a reference to a parent."""

    check_id: str
    dimension: str
    code: str
    text: str
    keys: tuple[str, ...]  # SQL of the compared values, in their own types
    applies: str
    parent: _ParentKey | None = None


@dataclass(frozen=True)
class _ParentKey:
    table: str
    key: str  # SQL of the values a child is compared with
    applies: str


class _Compiler:
    """The plans of one table's rules. Several references or keys share one scan."""

    def __init__(self, table: str, df: DataFrame, tables: Mapping[str, DataFrame], rules: TableRules):
        self.table, self.df, self.tables, self.rules = table, without_nan(df), tables, rules
        self.plain = df.columns
        self.types = {f.name: f.dataType for f in df.schema.fields}
        self.counted: list[_Counted] = []
        self.found: list[str] = []  # issue structs of row-level checks
        self.keyed: list[_Keyed] = []
        self.structural: list[tuple] = []
        self.structural_issues: list[tuple] = []

    def compile(self) -> None:
        for group in self.rules.required:
            self._required(group)
        self._unique("primary_key_unique", self.rules.primary_key, "Primary key {} must be unique among complete key values.")
        for n, key in enumerate(self.rules.natural_keys, 1):
            if tuple(key) != tuple(self.rules.primary_key):
                self._unique(
                    f"natural_key_{n}_unique", key, "Natural key {} should be unique among complete key values."
                )
        for check in self.rules.validity:
            self._validity(check)
        for check in self.rules.consistency:
            self._custom(check, "Consistency")
        for check in self.rules.plausibility:
            self._custom(check, "Accuracy")
        for reference in self.rules.references:
            self._reference(reference)

    # structural failures are known from the schemas alone
    def _structural(self, dimension, check_id, description, failed, total, code=None, text=None) -> None:
        self.structural.append((self.table, dimension, check_id, description, failed, total))
        if code:
            self.structural_issues.append((self.table, _TABLE_ROW, dimension, check_id, code, text, "red"))

    def _issue(self, dimension: str, check_id: str, failing: str, code: str, text: str) -> None:
        entry = (
            f"named_struct('dimension', {quoted(dimension)}, 'check_id', {quoted(check_id)}, "
            f"'issue_code', {quoted(code)}, 'issue_description', {text})"
        )
        self.found.append(f"case when {failing} then {entry} end")

    def _required(self, group: Required) -> None:
        missing = self._missing(group.columns)
        if missing:
            cells = f"greatest(count(*), 1) * {len(group.columns)}"
            self.counted.append(_Counted("Completeness", group.check_id, group.description, cells, cells, "0"))
            self.structural_issues.append(
                (self.table, _TABLE_ROW, "Completeness", group.check_id, "MISSING_REQUIRED_COLUMN",
                 f"Missing required columns: {missing}", "red")
            )
            return
        names = [ident(c) for c in group.columns]
        listed = ", ".join(f"case when {n} is null then {quoted(repr(c))} end" for n, c in zip(names, group.columns))
        text = f"concat('Missing required values in columns: [', array_join(array({listed}), ', '), ']')"
        present = " + ".join(f"count({n})" for n in names)
        cells = f"count(*) * {len(group.columns)}"
        any_empty = _any(f"{n} is null" for n in names)
        self.counted.append(
            _Counted("Completeness", group.check_id, group.description, cells, f"{cells} - ({present})", f"count_if({any_empty})")
        )
        self._issue("Completeness", group.check_id, any_empty, "MISSING_REQUIRED_VALUE", text)

    def _missing(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c not in self.plain]

    def _row_check(self, dimension: str, check: Check, applicable: str, failing: str, code: str) -> None:
        self.counted.append(
            _Counted(dimension, check.check_id, check.description, f"count_if({applicable})", f"count_if({failing})")
        )
        self._issue(dimension, check.check_id, failing, code, quoted(check.description))

    def _validity(self, check: Check) -> None:
        missing = self._missing(check.columns)
        if missing:
            self._structural(
                "Validity", check.check_id, check.description, 1, 1, "MISSING_VALIDITY_COLUMN",
                f"Missing columns for validity check: {missing}",
            )
            return
        self._row_check("Validity", check, *validity(check), "INVALID_VALUE")

    def _custom(self, check: Check, dimension: str) -> None:
        needed, build = CUSTOM_CHECKS[check.options["function"]]
        options = dict(check.options)
        if "unless" in options:
            options["unless"] = [c for c in options["unless"] if c in self.plain]
        if self._missing(needed(options)) or not self._add_parent_dates(options):
            self._structural(dimension, check.check_id, check.description, 0, 0)
            return
        self._row_check(dimension, check, *build(_as_idents(options)), check.check_id.upper())

    def _add_parent_dates(self, options: Mapping) -> bool:
        if "parent" not in options:
            return True
        parent = self.tables.get(options["parent"])
        if parent is None or missing_columns(parent, (options["key"], options["parent_date"])):
            return False
        # Earliest and latest date decide for all parents that share a key.
        day = F.to_date(F.col(ident(options["parent_date"])))
        dates = parent.groupBy(options["key"]).agg(F.min(day).alias("_parent_min"), F.max(day).alias("_parent_max"))
        self.df = self.df.join(dates, options["key"], "left")
        return True

    def _unique(self, check_id: str, key: Sequence[str], pattern: str) -> None:
        description = pattern.format(list(key))
        if not key or self._missing(key):
            self._structural("Uniqueness", check_id, description, 0, 0)
            return
        complete = _all(f"{ident(k)} is not null" for k in key)
        self.counted.append(_Counted("Uniqueness", check_id, description, f"count_if({complete})", None))
        text = quoted(f"Key {list(key)} is duplicated among complete key values.")
        self.keyed.append(_Keyed(check_id, "Uniqueness", "DUPLICATED_KEY", text, tuple(map(ident, key)), complete))

    def _reference(self, ref: Reference) -> None:
        check_id = f"fk_{self.table}_{ref.column}_to_{ref.parent}_{ref.parent_column}"
        description = f"{self.table}.{ref.column} must reference {ref.parent}.{ref.parent_column}."
        parent = self.tables.get(ref.parent)
        if ref.column not in self.plain:
            self._structural(
                "Referential Integrity", check_id, description, 1, 1, "MISSING_CHILD_FK_COLUMN",
                f"Missing child FK column: {ref.column}",
            )
            return
        if parent is None or ref.parent_column not in parent.columns:
            self._structural(
                "Referential Integrity", check_id, description, 1, 1, "MISSING_PARENT_TABLE_OR_COLUMN",
                f"Missing parent: {ref.parent}.{ref.parent_column}",
            )
            return
        child = ref.column
        form = comparable_form(self.types[child], parent.schema[ref.parent_column].dataType)
        keys = _ParentKey(ref.parent, typed(ref.parent_column, form), f"{ident(ref.parent_column)} is not null")
        self.counted.append(_Counted("Referential Integrity", check_id, description, f"count({ident(child)})", None))
        absent = quoted(f" does not exist in {ref.parent}.{ref.parent_column}.")
        text = f"concat({quoted(f'{child}=')}, cast({ident(child)} as string), {absent})"
        self.keyed.append(
            _Keyed(check_id, "Referential Integrity", "BROKEN_FOREIGN_KEY", text, (typed(child, form),), f"{ident(child)} is not null", keys)
        )

    def counts(self) -> DataFrame | None:
        if not self.counted:
            return None
        totals = self.df.selectExpr(
            *[f"cast({c.total} as bigint) as t{i}" for i, c in enumerate(self.counted)],
            *[f"cast({c.failed or 'null'} as bigint) as f{i}" for i, c in enumerate(self.counted)],
            *[f"cast({c.issues or c.failed or 'null'} as bigint) as n{i}" for i, c in enumerate(self.counted)],
        )
        entries = [
            f"named_struct('table_name', {quoted(self.table)}, 'dimension', {quoted(c.dimension)}, 'check_id', "
            f"{quoted(c.check_id)}, 'check_description', {quoted(c.description)}, 'failed_count', f{i}, 'total_count', t{i}, '_issues', n{i})"
            for i, c in enumerate(self.counted)
        ]
        return totals.selectExpr(f"inline(array({', '.join(entries)}))")

    def _flat(self, entries: Sequence[str]) -> DataFrame:
        rid = sql_row_identifier(self.plain, self.rules.primary_key)
        # Entries that do not apply go after the generator: it stays in generated code, which a lambda would end.
        flat = self.df.selectExpr(f"{rid} as row_identifier", f"inline(array({', '.join(entries)}))").where("check_id is not null")
        return flat.selectExpr(f"{quoted(self.table)} as table_name", "*")

    def row_issues(self) -> DataFrame | None:
        return self._flat(self.found) if self.found else None

    def tagged(self, checks: Mapping[int, _Keyed]) -> str:
        """SQL that makes of a row one (check, key) entry per keyed check, NULL where the check does not apply."""
        return _tagged({i: (c.applies, c.keys) for i, c in checks.items()})

    def keyed_issues(self, checks: Mapping[int, _Keyed], failing: DataFrame) -> DataFrame:
        """Issues of the rows that hold a failing key; only these are widened."""
        rows = self.df.selectExpr("*", self.tagged(checks)).join(failing, ["_check", "_h1", "_h2"])
        case = lambda part: "case _check " + " ".join(f"when {i} then {part(c)}" for i, c in checks.items()) + " end"
        return rows.selectExpr(
            f"{quoted(self.table)} as table_name", f"{sql_row_identifier(self.plain, self.rules.primary_key)} as row_identifier",
            f"{case(lambda c: quoted(c.dimension))} as dimension", f"{case(lambda c: quoted(c.check_id))} as check_id",
            f"{case(lambda c: quoted(c.code))} as issue_code", f"{case(lambda c: c.text)} as issue_description", "'red' as severity",
        ).select(*ISSUE_COLUMNS)


def _tagged(entries: Mapping[int, tuple[str, Sequence[str]]]) -> str:
    """Entries (condition, key parts) by check. Keys are compared by 128 bits of hash, so that all checks share a shuffle.

    Where a condition does not hold, `_check` is NULL (see `_flat`).
    """
    parts = [
        f"case when {applies} then named_struct('_check', {i}, '_h1', xxhash64(1, {', '.join(keys)}), '_h2', xxhash64(2, {', '.join(keys)})) end"
        for i, (applies, keys) in entries.items()
    ]
    return f"inline(array({', '.join(parts)}))"


def _failing_keys(compiled: Sequence[_Compiler], checks: Mapping[int, tuple[_Compiler, _Keyed]]) -> DataFrame:
    """_check, _h1, _h2, _rows of every key that fails: one scan of each table, one shuffle of keys for all checks."""
    frames, parents = [], {}
    for compiler in compiled:
        own = {i: check for i, (c, check) in checks.items() if c is compiler}
        if own:
            frames.append(compiler.df.selectExpr(compiler.tagged(own)).withColumn("_child", F.lit(1)))
    for i, (compiler, check) in checks.items():
        if check.parent is not None:
            parents.setdefault(check.parent.table, {})[i] = (check.parent.applies, (check.parent.key,))
            tables = compiler.tables
    for parent, entries in parents.items():
        frames.append(without_nan(tables[parent]).selectExpr(_tagged(entries)).withColumn("_child", F.lit(0)))
    references = ", ".join(str(i) for i, (_, c) in checks.items() if c.parent is not None) or "-1"
    keys = _union(frames).where("_check is not null").groupBy("_check", "_h1", "_h2").agg(F.sum("_child").alias("_rows"), F.min("_child").alias("_known"))
    return keys.where(f"_rows > 0 and case when _check in ({references}) then _known = 1 else _rows > 1 end").drop("_known")


def comparable_form(child: T.DataType, parent: T.DataType) -> str:
    """How two key columns are compared: text trimmed, equal types as they are, others canonically."""
    if child != parent:
        return "canonical"
    return "text" if isinstance(child, T.StringType) else "value"


def comparable(name: str, form: str) -> str:
    column = ident(name)
    if form == "text":
        return sql_strip(column)
    if form == "value":
        return f"cast({column} as string)"
    text, value = sql_strip(column), sql_number(column)
    return (
        f"case when {text} rlike r'^-?[0-9]{{1,18}}$' then cast(try_cast({text} as bigint) as string) "
        f"when {value} = floor({value}) and abs({value}) < 9e15 then cast(try_cast({value} as bigint) as string) "
        f"when {value} is not null then cast({value} as string) else {text} end"
    )


def parent_values(parent: DataFrame, column: str, child_type: T.DataType) -> tuple[DataFrame, str]:
    """Distinct parent keys as `_key`, and the form in which a child has to be compared."""
    form = comparable_form(child_type, parent.schema[column].dataType)
    values = without_nan(parent).where(f"{ident(column)} is not null").selectExpr(f"{typed(column, form)} as _key").distinct()
    return values, form


def typed(column: str, form: str) -> str:
    """As `comparable`, but equal types keep their type (cheaper to join on)."""
    return ident(column) if form == "value" else comparable(column, form)


class Assessment:
    """Results of a rule catalogue. Issues and scorecard are planned when they are asked for."""

    def __init__(
        self, check_results: DataFrame, issues: Callable[[], DataFrame], dimensions: Sequence[str], issue_counts: DataFrame
    ):
        self.check_results, self._issues, self._dimensions = check_results, issues, dimensions
        # table_name, issue_count: counted with the checks, so that a scorecard needs no issue.
        self.issue_counts = issue_counts

    @cached_property
    def issues(self) -> DataFrame:
        return self._issues()

    @cached_property
    def scorecard(self) -> DataFrame:
        return _scorecard(self.check_results, self.issue_counts, self._dimensions)


def _union(frames: Iterable[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def assess(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules] = RULES,
    dimensions: Sequence[str] = QUALITY_DIMENSIONS,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Assessment:
    """Run a rule catalogue. `stage` (see `starq.session.stage`) may keep the check
    results and the issues, which several later outputs are derived from."""
    structural, structural_issues, compiled = [], [], []
    for table, table_rules in rules.items():
        df = tables.get(table)
        if df is None:
            structural.append((table, "Completeness", "table_exists", f"Table {table} must exist.", 1, 1))
            structural_issues.append(
                (table, _TABLE_ROW, "Completeness", "table_exists", "MISSING_TABLE", f"Table {table} was not found.", "red")
            )
            continue
        compiler = _Compiler(table, df, tables, table_rules)
        compiler.compile()
        compiled.append(compiler)
        structural += compiler.structural
        structural_issues += compiler.structural_issues

    def gather(frames: Iterable[DataFrame | None]) -> DataFrame | None:
        return _union(f for f in frames if f is not None)

    keyed = {i: pair for i, pair in enumerate((c, check) for c in compiled for check in c.keyed)}
    counts = gather(c.counts() for c in compiled)
    if keyed:
        failing = stage(_failing_keys(compiled, keyed))
        # One row per check of the catalogue.
        names = spark.createDataFrame([(i, c.table, check.check_id) for i, (c, check) in keyed.items()], "_check int, table_name string, check_id string")
        failed = failing.groupBy("_check").agg(F.sum("_rows").alias("_failed")).join(F.broadcast(names), "_check").drop("_check")
        counts = counts.join(F.broadcast(failed), ["table_name", "check_id"], "left").withColumn(
            "failed_count", F.coalesce("failed_count", "_failed", F.lit(0))
        ).withColumn("_issues", F.coalesce("_issues", "_failed", F.lit(0))).drop("_failed")
    if structural:
        declared = spark.createDataFrame(structural, _COUNTS).withColumn("_issues", F.lit(0).cast("bigint"))
        counts = declared if counts is None else counts.unionByName(declared)
    passed = F.col("total_count") - F.col("failed_count")
    results = (
        counts.withColumn("passed_count", passed)
        .withColumn("score", score(passed, F.col("total_count")))
        .withColumn("status", score_status(F.col("score")))
        .select(*CHECK_COLUMNS, "_issues")
    )
    counted = stage(results)
    results = counted.drop("_issues")
    # One row per table: issues that the schemas alone tell.
    told = Counter(row[0] for row in structural_issues)
    told = spark.createDataFrame(list(told.items()), "table_name string, _issues bigint")
    issue_counts = counted.select("table_name", "_issues").unionByName(told).groupBy("table_name").agg(F.sum("_issues").alias("issue_count"))

    def issues() -> DataFrame:
        parts = []
        by_score = gather(c.row_issues() for c in compiled)
        if by_score is not None:
            parts.append(_with_severity(by_score, results))
        for compiler in compiled:
            own = {i: check for i, (c, check) in keyed.items() if c is compiler}
            if own:
                # The comparison marks the failing keys as the selective side: a Bloom filter of them can reach the scan.
                parts.append(compiler.keyed_issues(own, failing.where("_rows > 0").drop("_rows")))
        schema = ", ".join(f"{c} string" for c in ISSUE_COLUMNS)
        if structural_issues or not parts:
            parts.append(spark.createDataFrame(structural_issues, schema))
        return stage(_union(parts))

    return Assessment(results, issues, dimensions, issue_counts)


def _with_severity(issues: DataFrame, results: DataFrame) -> DataFrame:
    """Issues of row-level checks take their severity from the score of the check."""
    # One row per check of the catalogue.
    scores = F.broadcast(results.select("table_name", "check_id", "score"))
    severity = F.when(F.col("score") < 0.80, "red").otherwise("yellow")
    return (
        issues.join(scores, ["table_name", "check_id"], "left").withColumn("severity", severity).select(*ISSUE_COLUMNS)
    )


def dimension_column(dimension: str) -> str:
    return dimension.lower().replace("/", "_").replace(" ", "_").replace("-", "_") + "_score"


def scorecard(
    results: DataFrame, issues: DataFrame, dimensions: Sequence[str] = QUALITY_DIMENSIONS, rename: Mapping[str, str] = {}
) -> DataFrame:
    """Unweighted mean of check scores per dimension, then over the dimensions.

    Dimensions outside `dimensions` do not count (the plausibility checks are
    labelled `Accuracy`, which is why their column stays empty). Pass
    rename={"Accuracy": "Accuracy/Plausibility"} to include them.
    """
    return _scorecard(results, issues.groupBy("table_name").agg(F.count("*").alias("issue_count")), dimensions, rename)


def _scorecard(
    results: DataFrame, issue_counts: DataFrame, dimensions: Sequence[str], rename: Mapping[str, str] = {}
) -> DataFrame:
    scored = results.where(F.col("score").isNotNull())
    if rename:
        scored = scored.withColumn("dimension", lookup(F.col("dimension"), rename, F.col("dimension")))
    columns = [dimension_column(d) for d in dimensions]
    means = scored.groupBy("table_name").agg(
        *[F.avg(F.when(F.col("dimension") == d, F.col("score"))).alias(c) for d, c in zip(dimensions, columns)]
    )
    total, present = F.lit(0.0), F.lit(0)
    for c in columns:
        total += F.coalesce(F.col(c), F.lit(0.0))
        present += F.col(c).isNotNull().cast("int")
    overall = F.when(present > 0, F.round(total / present, 6))
    return (
        means.withColumn("overall_score", overall)
        .withColumn("status", score_status(F.col("overall_score")))
        .join(issue_counts, "table_name", "left")
        .withColumn("issue_count", F.coalesce("issue_count", F.lit(0)))
        .select("table_name", "overall_score", "status", "issue_count", *columns)
    )


def reference_issues(issues: DataFrame) -> DataFrame:
    return issues.where(F.col("dimension") == "Referential Integrity")


def write_issues(issues: DataFrame, folder: str) -> None:
    """All issues with their stable columns, one folder per table, and the broken references apart."""
    stable = issues.select(*ISSUE_COLUMNS)
    write_by_value(stable, "table_name", f"{folder}/issues")
    reference_issues(stable).write.mode("overwrite").parquet(f"{folder}/referential_integrity_issues")
