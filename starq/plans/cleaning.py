"""Cleaning with a log of every change.

Each table is resolved in one pass: its rows meet the marks left by the quality
checks, the missing-value flags and the outlier flags (one row of marks per row
id), and ordered `coalesce`s decide which source is logged first for a value, a
flag or a drop. The referential cascade then walks the tables parents first.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starq import schemas as s
from starq.functions.scalars import canonical_value, number, parse_bool_or_false, strip
from starq.plans.quality import (
    comparable, comparable_form, ident, parent_values, quoted, row_identifier, sql_map, sql_number, sql_row_identifier, sql_strip, sure, typed,
    without_nan,
)
from starq.plans.rules import QUALIFYING_PROGRESSION, RULES, TableRules
from starq.session import stage as keep_staged

ACTION_FIELDS = (
    "source", "table_name", "row_identifier", "target_column", "quality_flag_column", "check_id", "issue_code",
    "missing_class", "information_area", "outlier_metric", "outlier_consensus_score", "cleaning_action", "old_value",
    "new_value", "reason",
)
# What differs from row to row; the rest of an entry is one of the table's notes. Names
# of columns and metrics stay bit sets until the log is written out.
ROW_FIELDS = {
    "explained": "array<bigint>", "suspicious": "array<bigint>", "metrics": "array<bigint>", "score": "int",
    "old_value": "string", "new_value": "string",
}
DQA, MISSING, OUTLIER = "general_dqa", "missing_values", "outlier_detection"


# --- decisions -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Decision:
    """What an issue of one check does to its row.

    kind: drop | null | null_invalid (only the columns out of range) | domain |
    code_text | flag.
    """

    kind: str
    columns: tuple[str, ...] = ()
    reason: str = ""
    area: str | None = None
    allowed: tuple[str, ...] = ()
    unknown: str = "drop"
    minimum: float | None = None


def _null(columns: str | tuple[str, ...], reason: str, area: str | None = None) -> Decision:
    return Decision("null", (columns,) if isinstance(columns, str) else columns, reason, area)


def _domain(column: str, allowed: Sequence[str], unknown: str = "drop", area: str | None = None) -> Decision:
    return Decision("domain", (column,), area=area, allowed=tuple(allowed), unknown=unknown)


# Checks that drop the row, and their logged reason.
DROP_SUFFIXES = ("required_structural_columns", "required_identification_columns", "required_columns")
DROP_PREFIXES = ("natural_key_", "fk_")
DROP_CHECKS = (
    "circuit_required_analytical_columns", "season_year_formula1_domain", "round_number_positive",
    "result_position_positive", "lap_number_positive", "lap_time_positive", "weather_time_non_negative",
    "track_status_time_non_negative", "track_status_code_domain", "primary_key_unique",
)
# Issue codes that drop the row, whatever the check is called.
DROP_CODES = ("BROKEN_FOREIGN_KEY", "DUPLICATED_KEY")
DROP_REASON = "The DQA issue makes the row structurally unusable or unreliable for the cleaned schema."

# Repairs by table and check, with their logged reasons.
_RACE, _SECTOR, _SPEED, _TYRE = (
    "RACE_CONTEXT_INFORMATION", "SECTOR_INFORMATION", "SPEED_INFORMATION", "TYRE_INFORMATION",
)
_SEASON_DATES = _null(("season_start_date", "season_end_date"), "Inconsistent season dates set to NULL.")
_STATUS_TEXT = Decision("code_text", ("status", "message"))
DECISIONS: dict[str, dict[str, Decision]] = {
    "season": {
        "number_of_events_positive": _null("number_of_events", "Invalid descriptive season value set to NULL."),
        "season_dates_order": _SEASON_DATES,
        "season_dates_match_year": _SEASON_DATES,
    },
    "circuit": {
        "global_circuit_category_domain": _domain("global_circuit_category", s.CIRCUIT_CATEGORIES),
        **{f"sector{i}_category_domain": _domain(f"sector{i}_category", s.SECTOR_CATEGORIES) for i in (1, 2, 3)},
    },
    "driver": {
        "driver_abbreviation_format": _null("abbreviation", "Invalid driver abbreviation set to NULL."),
        "driver_url_format": _null("driver_url", "Invalid driver URL set to NULL."),
        "permanent_number_range": _null("permanent_number", "Invalid permanent number set to NULL."),
        "driver_age_plausible_2021_2022": _null("date_of_birth", "Implausible date of birth set to NULL."),
    },
    "team": {"team_url_format": _null("team_url", "Invalid team URL set to NULL.")},
    "grand_prix": {
        "event_format_domain": _domain("event_format", s.EVENT_FORMATS),
        "grand_prix_event_date_matches_season_year": _null(
            "event_date", "Grand Prix event date inconsistent with season year set to NULL."
        ),
    },
    "session": {
        "session_type_domain": _domain("session_type", s.SESSION_TYPES),
        "session_date_near_grand_prix_date": _null(
            "session_date", "Session date inconsistent with Grand Prix date set to NULL."
        ),
    },
    "result": {
        "result_points_non_negative": _null("points", "Invalid points value set to NULL.", _RACE),
        "result_laps_non_negative": _null("laps", "Invalid completed-laps value set to NULL.", _RACE),
        "result_grid_position_non_negative": _null("grid_position", "Invalid grid position set to NULL.", _RACE),
        "result_qualifying_progression_consistency": Decision(
            "flag", reason="Qualifying progression consistency is suspicious.", area="QUALIFYING_INFORMATION"
        ),
    },
    "lap": {
        "lap_sector_times_positive": Decision(
            "null_invalid", s.SECTOR_METRICS, "Invalid sector time set to NULL.", _SECTOR, minimum=1
        ),
        "lap_speeds_positive": Decision(
            "null_invalid", s.SPEED_METRICS, "Invalid speed value set to NULL.", _SPEED, minimum=1
        ),
        "stint_positive": _null("stint", "Invalid stint value set to NULL.", _TYRE),
        "tyre_life_positive": _null("tyre_life", "Invalid tyre life value set to NULL.", _TYRE),
        "compound_domain": _domain("compound", s.TYRE_COMPOUNDS, unknown="null", area=_TYRE),
        "lap_sector_sum_matches_lap_time": Decision(
            "flag", reason="Sector sum is not coherent with lap time.", area=_SECTOR
        ),
    },
    "weather": {
        "air_temp_broad_domain_range": _null("air_temp", "Invalid air temperature set to NULL."),
        "track_temp_broad_domain_range": _null("track_temp", "Invalid track temperature set to NULL."),
        "humidity_range": _null("humidity", "Invalid humidity set to NULL."),
        "pressure_range": _null("pressure", "Invalid pressure set to NULL."),
        "wind_direction_range": _null("wind_direction", "Invalid wind direction set to NULL."),
        "wind_speed_non_negative": _null("wind_speed", "Invalid wind speed set to NULL."),
        "weather_track_air_temp_difference": _null(
            "track_temp", "Implausible track-air temperature relation: track temperature set to NULL."
        ),
    },
    "track_status": {
        "track_status_message_domain": _STATUS_TEXT,
        "track_status_message_mapping": _STATUS_TEXT,
    },
}


def drops_row(check_id: str) -> bool:
    return check_id.endswith(DROP_SUFFIXES) or check_id.startswith(DROP_PREFIXES) or check_id in DROP_CHECKS


def check_order(table: str, rules: Mapping[str, TableRules] = RULES) -> dict[str, str]:
    """Checks of a table in the order in which their issues are applied, with their issue codes."""
    r = rules[table]
    ids = {g.check_id: "MISSING_REQUIRED_VALUE" for g in r.required}
    if r.primary_key:
        ids["primary_key_unique"] = "DUPLICATED_KEY"
    for n, key in enumerate(r.natural_keys, 1):
        if tuple(key) != tuple(r.primary_key):
            ids[f"natural_key_{n}_unique"] = "DUPLICATED_KEY"
    ids.update({c.check_id: "INVALID_VALUE" for c in r.validity})
    ids.update({c.check_id: c.check_id.upper() for c in (*r.consistency, *r.plausibility)})
    if table == "result":
        ids.setdefault(QUALIFYING_PROGRESSION.check_id, QUALIFYING_PROGRESSION.check_id.upper())
    ids.update({f"fk_{table}_{f.column}_to_{f.parent}_{f.parent_column}": "BROKEN_FOREIGN_KEY" for f in r.references})
    return ids


def drops_unknown(check_id: Column, code: Column) -> Column:
    """Whether an issue drops its row although the catalogue does not know the check."""
    named = check_id.isin(*DROP_CHECKS)
    for suffix in DROP_SUFFIXES:
        named |= check_id.endswith(suffix)
    for prefix in DROP_PREFIXES:
        named |= check_id.startswith(prefix)
    return F.coalesce(named, F.lit(False)) | F.coalesce(code.isin(*DROP_CODES), F.lit(False))


def unmatched_issues(issues: DataFrame, tables: Sequence[str], rules: Mapping[str, TableRules] = RULES) -> DataFrame:
    """Issues that no decision answers: checks outside the catalogue that do not drop the row either."""
    known = [(t, c) for t in tables for c in check_order(t, rules)]
    # One row per check of the catalogue.
    catalogue = F.broadcast(issues.sparkSession.createDataFrame(known, "_table string, _check string"))
    check_id = strip("check_id")
    rest = issues.join(catalogue, (strip("table_name") == F.col("_table")) & (check_id == F.col("_check")), "left_anti")
    return rest.where(~drops_unknown(check_id, strip("issue_code")))


# --- SQL text of log entries ---------------------------------------------------------------------------------------


def as_log_text(column: str, data_type: T.DataType) -> str:
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({column}, \"yyyy-MM-dd'T'HH:mm:ss\")"
    return f"cast({column} as string)"


_ENTRY_TYPE = "struct<note:int," + ",".join(f"{f}:{kind}" for f, kind in ROW_FIELDS.items()) + ">"


def _entry(note: int | str, fields: Mapping[str, str]) -> str:
    """A compact log entry: the number of its note and what differs from row to row."""
    values = ", ".join(f"'{f}', cast({fields.get(f, 'null')} as {kind})" for f, kind in ROW_FIELDS.items())
    return f"named_struct('note', {note}, {values})"


def _notes_sql(notes: Sequence[Mapping[str, str]]) -> str:
    """All notes of a table as one constant array."""
    def text(note: Mapping[str, str]) -> str:
        return "named_struct(" + ", ".join(
            f"'{f}', cast({quoted(note[f]) if f in note else 'null'} as string)" for f in ACTION_FIELDS
        ) + ")"

    return "array(" + ", ".join(text(n) for n in notes) + ")"


def when(condition: str, value: str) -> str:
    return f"case when {condition} then {value} end"


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trimmed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text trimmed, empty text to NULL (all text columns unless named)."""
    columns = text_columns(df) if columns is None else columns
    return df.withColumns({c: F.nullif(strip(F.col(c)), F.lit("")) for c in columns}) if columns else df


def with_quality_flags(df: DataFrame, table: str) -> DataFrame:
    flags = s.AREA_FLAGS.get(table, {}).values()
    return df.withColumns(
        {f: parse_bool_or_false(F.col(f)) if f in df.columns else F.lit(False) for f in flags}
    ) if flags else df


def canonical_row_id(text: Column) -> Column:
    """'lap_id=1.0' and 'lap_id= 1' name the same row."""
    clean = strip(text)
    name = strip(F.substring_index(clean, "=", 1))
    value = F.regexp_extract(clean, "(?s)^[^=]*=(.*)$", 1)
    return (
        F.when(text.rlike("^[a-z_]+=(0|-?[1-9][0-9]{0,17})$"), text)  # the usual form, already canonical
        .when((clean == "") | (clean == "__table__") | ~clean.contains("="), F.lit(None).cast("string"))
        .when(name == "row_index", clean)
        .otherwise(F.concat(name, F.lit("="), canonical_value(value)))
    )


def own_row_id(types: Mapping[str, T.DataType], key: str) -> str:
    """Canonical id of a row of the raw table (matches `canonical_row_id` of its issues)."""
    plain = sql_row_identifier(list(types), [key] if key in types else [])
    if key not in types or isinstance(types[key], T.IntegralType):
        return plain
    return f"case when {ident(key)} is not null then concat({quoted(f'{key}=')}, {comparable(key, 'canonical')}) else {plain} end"


@dataclass(frozen=True)
class RowNames:
    """How some rows of a table are named: `own` as SQL over the table, `given` as a column over the text of an id.

    Rows that `given` does not name give NULL, `where` picks the rows of the table.
    """

    where: str | None
    own: str
    given: Callable[[Column], Column]


def row_names(types: Mapping[str, T.DataType], key: str, by_key: bool = False) -> list[RowNames]:
    """All rows by the text of their id. With `by_key`, rows that have a whole-number key go by
    its value: a table bucketed by it meets its marks without a shuffle, but is scanned twice."""
    text = own_row_id(types, key)
    if not by_key or not isinstance(types.get(key), T.IntegralType):
        return [RowNames(None, text, canonical_row_id)]

    def value(given: Column) -> Column:
        whole = F.regexp_extract(canonical_row_id(given), f"^{key}=(0|-?[1-9][0-9]{{0,18}})$", 1)
        return whole.try_cast(types[key])

    return [
        RowNames(f"{ident(key)} is not null", ident(key), value),
        RowNames(f"{ident(key)} is null", text, lambda given: F.when(canonical_row_id(given).startswith("row_index="), canonical_row_id(given))),
    ]


# --- marks: what the assessments say about a row -------------------------------------------------------------------
#
# One row of bit sets per row name, gathered by plain hash aggregates: bit i of
# `_issues` stands for the i-th check of the catalogue, bit i of an area's sets
# for the i-th column of the table. A set is an array of words, as many as the
# names need.

_Naming = Callable[[Column], Column]

_WORD = 62


def bit_set(column: str, names: Sequence[str], here: str = "true") -> str:
    """Aggregate: the set of the names that a column holds; unknown names do not count."""
    words = []
    for start in range(0, max(len(names), 1), _WORD):
        cases = " ".join(f"when {quoted(n)} then {1 << i}L" for i, n in enumerate(names[start : start + _WORD]))
        words.append(f"bit_or(case when {here} then (case {column} {cases} else 0L end) else 0L end)" if cases else "bit_or(0L)")
    return f"array({', '.join(words)})"


def has_bit(bits: str, position: int) -> str:
    return f"(get({bits}, {position // _WORD}) & {1 << position % _WORD}L) <> 0"


def any_bit(*sets: str) -> str:
    """Words are never negative (see `_WORD`)."""
    return "(" + " or ".join(f"array_max({bits}) > 0" for bits in sets) + ")"


def both_sets(a: str, b: str) -> str:
    return f"zip_with({a}, {b}, (p, q) -> p | q)"


def issue_marks(issues: DataFrame, table: str, checks: Sequence[str], named: _Naming = canonical_row_id) -> DataFrame:
    """`_issues`: the failed checks of each row. `_unknown`: the first issue of a check
    outside the catalogue that drops the row all the same."""
    unknown = ~F.col("check_id").isin(*checks) & drops_unknown(F.col("check_id"), F.col("issue_code"))
    return (
        issues.where(strip("table_name") == table)
        .select(
            named(F.col("row_identifier")).alias("_rid"), strip("check_id").alias("check_id"),
            strip("issue_code").alias("issue_code"),
        )
        .where(F.col("_rid").isNotNull())
        .groupBy("_rid")
        .agg(
            F.expr(bit_set("check_id", checks)).alias("_issues"),
            F.min(F.when(unknown, F.struct("check_id", "issue_code"))).alias("_unknown"),
        )
    )


def missing_marks(flags: DataFrame, table: str, columns: Sequence[str], named: _Naming = canonical_row_id) -> DataFrame:
    """`_x<i>`, `_s<i>`: columns with an explained / a suspicious null of the i-th area."""
    area = strip("missing_information_area")
    slim = flags.where((strip("table_name") == table) & area.isin(*missing_areas(table))).select(
        named(F.col("row_identifier")).alias("_rid"), area.alias("_area"),
        strip("column_name").alias("_column"), strip("missing_class").alias("_class"),
    )
    sets = []
    for i, a in enumerate(missing_areas(table)):
        for prefix, kind in (("_x", "EXPLAINED_NULL"), ("_s", "SUSPICIOUS_NULL")):
            here = f"_area = {quoted(a)} and _class = {quoted(kind)}"
            sets.append(F.expr(bit_set("_column", columns, here)).alias(f"{prefix}{i}"))
    return slim.where(F.col("_rid").isNotNull()).groupBy("_rid").agg(*sets)


def missing_areas(table: str) -> list[str]:
    return [s.DROP_AREA[table], *s.AREA_FLAGS[table]]


_OUTLIER_AREAS = {_SECTOR: s.SECTOR_METRICS, _SPEED: s.SPEED_METRICS}


def outlier_marks(flags: DataFrame, named: _Naming = canonical_row_id) -> DataFrame:
    """Strong lap time outlier, and per area the metrics (bit set) and the largest agreement."""
    metric, agreement = strip("metric"), number(F.col("consensus_score")).try_cast("int")
    slim = flags.select(
        named(F.col("row_identifier")).alias("_rid"), metric.alias("_metric"), agreement.alias("_agreement")
    ).where(F.col("_rid").isNotNull() & (F.col("_agreement") >= 1))
    marks = [F.expr("bool_or(_metric = 'lap_time_ms' and _agreement >= 2)").alias("_strong")]
    for i, metrics in enumerate(_OUTLIER_AREAS.values()):
        listed = ", ".join(quoted(m) for m in metrics)
        here = f"_metric in ({listed})"
        marks.append(F.expr(bit_set("_metric", s.OUTLIER_METRICS, here)).alias(f"_o{i}"))
        marks.append(F.expr(f"max(case when {here} then _agreement end)").alias(f"_a{i}"))
    return slim.groupBy("_rid").agg(*marks)


def listed_names(bits: str, names: Sequence[str]) -> str:
    """The sorted names of a bit set, joined by '|'."""
    parts = ", ".join(f"case when {has_bit(bits, i)} then {quoted(n)} end" for i, n in sorted(enumerate(names), key=lambda x: x[1]))
    return f"nullif(concat_ws('|', {parts}), '')"


# --- resolution of one table ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Resolved:
    """A table with its decisions: cleaned columns, `_rid`, `_actions` (changes), `_drop`
    (note of the first drop, or NULL) and `_unknown` (check and code of a drop whose check
    is not in the catalogue). `notes` hold what entries have in common."""

    frame: DataFrame
    notes: tuple[Mapping[str, str], ...]


@dataclass
class _Log:
    """Ordered candidates as SQL text; the first that holds for a row is the one logged."""

    texts: list[tuple[str, str]] = field(default_factory=list)
    values: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    flags: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    drops: list[tuple[str, int]] = field(default_factory=list)

    def all_actions(self) -> list[str]:
        """Arrays of one entry, or of none."""
        candidates = [*[[t] for t in self.texts], *self.values.values(), *self.flags.values()]
        return [f"case {' '.join(f'when {c} then array({entry})' for c, entry in entries)} else {_NO_ENTRIES} end" for entries in candidates]

    def first_drop(self) -> str:
        if not self.drops:
            return "cast(null as int)"
        return "case " + " ".join(f"when {condition} then {note}" for condition, note in self.drops) + " end"


class _Resolver:
    """Collects what happens to the rows of one table, in the order it is applied.

    Fixed values: the reasons in this class and in `cascade`.
    """

    def __init__(self, table: str, types: Mapping[str, T.DataType]):
        self.table, self.types = table, types
        self.log = _Log()
        self.replaced: dict[str, list[tuple[str, str]]] = {}
        self.flag_of = s.AREA_FLAGS.get(table, {})
        self.notes: list[dict[str, str]] = []
        self.early: dict[str, str] = {}  # expressions used many times, computed once
        self.late: dict[str, str] = {}

    def prepare(self, expression: str, late: bool = False) -> str:
        """A column that holds the expression (late ones may use early ones)."""
        columns = self.late if late else self.early
        return columns.setdefault(expression, f"_{'l' if late else 'e'}{len(columns)}")

    def note(self, **fields: str) -> int:
        self.notes.append({"table_name": self.table, **{k: v for k, v in fields.items() if v is not None}})
        return len(self.notes) - 1

    def text(self, c: str) -> None:
        # The tidied column is the trimmed text, or NULL where that is empty.
        old, new = ident(f"_old_{c}"), f"coalesce({ident(c)}, '')"
        trim = self.note(
            source="general_cleaning", target_column=c, check_id="CR_COMMON_1", issue_code="LEADING_OR_TRAILING_SPACES",
            cleaning_action="STANDARDIZE", reason="Trimmed leading or trailing spaces from a textual value.",
        )
        empty = self.note(
            source="general_cleaning", target_column=c, check_id="CR_COMMON_2", issue_code="EMPTY_STRING",
            cleaning_action="SET_NULL", reason="Converted an empty textual value into NULL.",
        )
        self.log.texts += [
            (f"{new} <> {old}", _entry(trim, {"old_value": old, "new_value": new})),
            (f"{old} is not null and {ident(c)} is null", _entry(empty, {"old_value": "''"})),
        ]

    def flag(self, condition: str, area: str | None, row: Mapping[str, str] = {}, **fields: str) -> None:
        name = self.flag_of.get(area)
        if name:
            note = self.note(
                quality_flag_column=name, information_area=area, cleaning_action="ADD_FLAG", old_value="False",
                new_value="True", **fields,
            )
            self.log.flags.setdefault(name, []).append((f"({condition} and not {name})", _entry(note, row)))

    def drop(self, condition: str, **fields: str) -> None:
        self.log.drops.append((condition, self.note(cleaning_action="DROP_ROW", **fields)))

    def set_null(self, condition: str, column: str, reason: str, area: str | None, **fields: str) -> None:
        hit = f"({condition} and {ident(column)} is not null)"
        self.replaced.setdefault(column, []).append((hit, f"cast(null as {self.types[column].simpleString()})"))
        note = self.note(target_column=column, cleaning_action="SET_NULL", reason=reason, **fields)
        entry = _entry(note, {"old_value": as_log_text(ident(column), self.types[column])})
        self.log.values.setdefault(column, []).append((hit, entry))
        affected = f"{area} is affected after setting an invalid value to NULL."
        self.flag(hit, area, target_column=column, reason=affected, **fields)

    def standardize(self, condition: str, column: str, value: str, reason: str, **fields: str) -> None:
        # Domain values are never numeric, so equal text is the whole comparison.
        hit = f"({condition} and {value} is not null and not ({ident(column)} <=> {value}))"
        self.replaced.setdefault(column, []).append((hit, value))
        note = self.note(target_column=column, cleaning_action="STANDARDIZE", reason=reason, **fields)
        self.log.values.setdefault(column, []).append((hit, _entry(note, {"old_value": ident(column), "new_value": value})))

    def issue(self, position: int, check_id: str, code: str, columns: Sequence[str]) -> None:
        marked = self.prepare(sure(has_bit("_issues", position)))
        fields = {"source": DQA, "check_id": check_id, "issue_code": code}
        d = DECISIONS.get(self.table, {}).get(check_id)
        if drops_row(check_id):
            self.drop(marked, reason=DROP_REASON, **fields)
        elif d is None or any(c not in columns for c in d.columns):
            return
        elif d.kind == "flag":
            self.flag(marked, d.area, reason=d.reason, **fields)
        elif d.kind == "null":
            for c in d.columns:
                self.set_null(marked, c, d.reason, d.area, **fields)
        elif d.kind == "null_invalid":
            for c in d.columns:
                low = f"not {sure(f'{sql_number(ident(c))} >= {d.minimum}')}"
                self.set_null(f"({marked} and {low})", c, d.reason, d.area, **fields)
        elif d.kind == "domain":
            self._domain(d, marked, fields)
        elif d.kind == "code_text":
            code_column, text_column = d.columns
            value = self.prepare(
                f"try_element_at({sql_map(s.TRACK_STATUS_MESSAGES)}, try_cast({sql_number(ident(code_column))} as int))"
            )
            self.standardize(
                marked, text_column, value, "Track status message reconstructed from the numerical status code.", **fields
            )
            self.set_null(
                f"({marked} and {value} is null)", text_column,
                "Unknown track status message set to NULL because the status code could not reconstruct it.", None, **fields,
            )

    def _domain(self, d: Decision, marked: str, fields: Mapping[str, str]) -> None:
        c = d.columns[0]
        known = sql_map({"".join(x for x in v.lower() if x.isalnum()): v for v in d.allowed})
        value = self.prepare(f"try_element_at({known}, regexp_replace(lower({ident(c)}), '[^a-z0-9]', ''))")
        self.standardize(marked, c, value, f"Standardized {c} to a known domain value.", **fields)
        unknown = f"({marked} and {ident(c)} is not null and {value} is null)"
        if d.unknown == "drop":
            self.drop(unknown, reason=f"Unknown {c} value cannot be mapped to the allowed domain.", **fields)
        else:
            reason = f"Unknown {c} value was set to NULL because it cannot be mapped deterministically."
            self.set_null(unknown, c, reason, d.area, **fields)

    def unknown(self) -> None:
        """Check and code of these drops stand in `_unknown`."""
        self.drop("_unknown is not null", source=DQA, reason=DROP_REASON)
        self.notes[-1]["unknown"] = "yes"

    def missing(self) -> None:
        area = s.DROP_AREA[self.table]
        gone = self.prepare(sure(any_bit("_x0", "_s0")))
        what = "lap time" if self.table == "lap" else "classification"
        alive = self.prepare(f"({self.log.first_drop()}) is null and not {gone}", late=True)
        self.drop(
            gone, source=MISSING, information_area=area,
            reason=f"Rows with missing {what} information are removed from the cleaned {self.table} table.",
        )
        for i, a in enumerate(missing_areas(self.table)):
            explained, suspicious = f"_x{i}", f"_s{i}"
            self.flag(
                f"{alive} and {sure(any_bit(explained, suspicious))}", a,
                {"explained": explained, "suspicious": suspicious}, source=MISSING,
                reason=f"Focused missing value output indicates that {a} is incomplete or unreliable.",
            )

    def outliers(self) -> None:
        strong = sure("_strong")
        alive = self.prepare(f"({self.log.first_drop()}) is null and not {strong}", late=True)
        self.drop(
            strong, source=OUTLIER, outlier_metric="lap_time_ms", outlier_consensus_score="2",
            reason="Rows with strong consensus lap_time_ms outliers are removed because lap time is the core performance measure.",
        )
        for i, a in enumerate(_OUTLIER_AREAS):
            self.flag(
                f"{alive} and {sure(any_bit(f'_o{i}'))}", a, {"metrics": f"_o{i}", "score": f"_a{i}"}, source=OUTLIER,
                reason=f"Outlier detection indicates that {a} may be unreliable.",
            )

    def settled(self, c: str) -> str:
        if c in self.log.flags:
            active = " or ".join(sure(condition) for condition, _ in self.log.flags[c])
            return f"({c} or {active}) as {c}"
        if c not in self.replaced:
            return ident(c)
        cases = " ".join(f"when {condition} then {value}" for condition, value in self.replaced[c])
        return f"case {cases} else {ident(c)} end as {ident(c)}"


_NO_ENTRIES = f"cast(array() as array<{_ENTRY_TYPE}>)"
_UNKNOWN_TYPE = "struct<check_id:string,issue_code:string>"


def resolve_table(
    table: str,
    df: DataFrame,
    issues: DataFrame | None = None,
    missing: DataFrame | None = None,
    outliers: DataFrame | None = None,
    rules: Mapping[str, TableRules] = RULES,
    by_key: bool = False,
) -> Resolved:
    """What the sources say about each row, settled in one pass over the table.

    `by_key`: the table is bucketed by its key (see `row_names`).
    """
    key = s.PRIMARY_KEY.get(table, "")
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = list(types)
    df = without_nan(df)
    checks = check_order(table, rules)
    parts = []
    for rows in row_names(types, key, by_key):
        part = (df.where(rows.where) if rows.where else df).withColumn("_rid", F.expr(rows.own))
        if issues is not None:
            part = part.join(issue_marks(issues, table, list(checks), rows.given), "_rid", "left")
        if missing is not None and table in s.DROP_AREA:
            part = part.join(missing_marks(missing, table, columns, rows.given), "_rid", "left")
        if outliers is not None and table == "lap":
            part = part.join(outlier_marks(outliers, rows.given), "_rid", "left")
        parts.append(part.drop("_rid"))
    marks = [c for c in parts[0].columns if c not in columns]

    texts = [c for c, t in types.items() if isinstance(t, T.StringType)]
    flags = list(s.AREA_FLAGS.get(table, {}).values())
    r = _Resolver(table, types)
    for c in texts:
        r.text(c)
    if "_issues" in marks:
        for position, (check_id, code) in enumerate(checks.items()):
            r.issue(position, check_id, code, columns)
        r.unknown()
    if "_x0" in marks:
        r.missing()
    if "_strong" in marks:
        r.outliers()

    def settle(part: DataFrame) -> DataFrame:
        tidy = with_quality_flags(
            part.selectExpr(
                *[f"nullif({sql_strip(ident(c))}, '') as {ident(c)}" if c in texts else ident(c) for c in columns],
                *[f"{ident(c)} as {ident(f'_old_{c}')}" for c in texts], *marks,
            ),
            table,
        )
        named = tidy.withColumn("_name", row_identifier(columns, [key] if key else []))
        for prepared in (r.early, r.late):
            if prepared:
                named = named.selectExpr("*", *[f"{e} as {n}" for e, n in prepared.items()])
        return named.selectExpr(
            *[r.settled(c) for c in [*columns, *[f for f in flags if f not in columns]]],
            "_name as _rid",
            # No lambda, so that the decisions stay in generated code.
            f"flatten(array({', '.join(r.log.all_actions() or [_NO_ENTRIES])})) as _actions",
            f"{r.log.first_drop()} as _drop", "_unknown" if "_unknown" in marks else f"cast(null as {_UNKNOWN_TYPE}) as _unknown",
        )

    # Joined at the end: an optimizer that sees through a union would copy every decision into it.
    frame = reduce(DataFrame.unionByName, map(settle, parts))
    return Resolved(frame, tuple(r.notes))


# --- cascade -------------------------------------------------------------------------------------------------------


def _edges(resolved: Mapping[str, Resolved], references: Mapping[str, Sequence[tuple[str, str, str]]], order: Sequence[str]) -> list[_Edge]:
    """References both of whose ends are there, children in the order of the walk."""
    walk = [t for t in order if t in resolved] + [t for t in resolved if t not in order]
    place = {t: i for i, t in enumerate(walk)}
    return [
        _Edge(table, column, parent, parent_column, place[parent] >= place[table])
        for table in walk
        for column, parent, parent_column in references.get(table, ())
        if parent in resolved and column in resolved[table].frame.columns and parent_column in resolved[parent].frame.columns
    ]


@dataclass(frozen=True)
class _Edge:
    table: str
    column: str
    parent: str
    parent_column: str
    # The parent stands at or after the child in the walk: its drops come too late for it.
    backward: bool

    def note(self) -> dict:
        reference = f"{self.table}_{self.column}_to_{self.parent}_{self.parent_column}"
        return {
            "source": DQA, "table_name": self.table, "cleaning_action": "DROP_ROW", "check_id": f"post_cleaning_fk_{reference}",
            "issue_code": "BROKEN_FOREIGN_KEY_AFTER_CLEANING",
            "reason": f"Row removed because {self.table}.{self.column} no longer references a valid "
            f"{self.parent}.{self.parent_column} after previous cleaning actions.",
        }


def cascade(
    resolved: Mapping[str, Resolved],
    references: Mapping[str, Sequence[tuple[str, str, str]]] = s.FOREIGN_KEYS,
    order: Sequence[str] = s.TABLE_ORDER,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
    keep: Callable[[DataFrame], DataFrame] = keep_staged,
) -> dict[str, Resolved]:
    """Drop rows whose parent is absent or dropped, until nothing changes.

    One walk in `order` (parents first) settles references to earlier tables. Where a
    table refers to itself or to a later one, rounds follow: only keys that the last
    round took away are joined to the children, until none is left. Rows that hold one
    another in a cycle stay. A row lists the reference that broke first.
    """
    edges = _edges(resolved, references, order)
    out: dict[str, Resolved] = {}
    notes = {t: list(r.notes) for t, r in resolved.items()}
    place = {}
    for table in [t for t in order if t in resolved] + [t for t in resolved if t not in order]:
        df = resolved[table].frame
        plain, cases = df.columns, []
        for e in [e for e in edges if e.table == table]:
            alive = out.get(e.parent, resolved[e.parent]).frame.where(F.col("_drop").isNull())
            known, form = parent_values(alive, e.parent_column, df.schema[e.column].dataType)
            hit = f"_has_{e.column}"
            known = known.select(F.col("_key").alias(f"_key_{e.column}"), F.lit(True).alias(hit))
            df = df.withColumn(f"_key_{e.column}", F.expr(typed(e.column, form))).join(known, f"_key_{e.column}", "left")
            place[e] = len(notes[table])
            cases.append(f"when {ident(e.column)} is not null and {ident(hit)} is null then {place[e]}")
            notes[table].append(e.note())
        if cases:
            df = df.withColumn("_drop", F.expr(f"coalesce(_drop, case {' '.join(cases)} end)")).select(*plain)
        out[table] = Resolved(stage(df), tuple(notes[table]))
    if any(e.backward for e in edges):
        for e, lost in _lost_keys(resolved, out, edges, keep).items():
            frame = out[e.table].frame
            plain = frame.columns
            child = frame.schema[e.column].dataType
            form = comparable_form(child, out[e.parent].frame.schema[e.parent_column].dataType)
            lost = lost.select(F.col("_key").alias("_lost_key"), F.col("_round").alias("_lost_round"))
            joined = frame.withColumn("_lost_key", F.expr(typed(e.column, form))).join(lost, "_lost_key", "left")
            first = joined["_round"] if "_round" in plain else F.lit(None).cast("int")
            earlier = F.col("_lost_round").isNotNull() & (first.isNull() | (F.col("_lost_round") < first))
            fresh = F.col("_drop").isNull() | first.isNotNull()
            settled = joined.withColumns({
                "_drop": F.when(fresh & earlier, F.lit(place[e])).otherwise(F.col("_drop")),
                "_round": F.when(fresh & earlier, F.col("_lost_round")).otherwise(first),
            })
            out[e.table] = Resolved(settled.select(*[c for c in plain if c != "_round"], "_round"), out[e.table].notes)
        out = {t: Resolved(stage(r.frame.drop("_round")), r.notes) if "_round" in r.frame.columns else r for t, r in out.items()}
    return out


def _lost_keys(
    before: Mapping[str, Resolved], walked: Mapping[str, Resolved], edges: Sequence[_Edge], keep: Callable[[DataFrame], DataFrame]
) -> dict[_Edge, DataFrame]:
    """Per reference the parent keys (_key) that go after the walk, with the round in which they do.

    Works on the keys of surviving rows alone. A key is lost when its last row is.
    """
    forms = {
        e: comparable_form(walked[e.table].frame.schema[e.column].dataType, walked[e.parent].frame.schema[e.parent_column].dataType)
        for e in edges
    }
    number = {e: i for i, e in enumerate(edges)}
    slim = {}
    for table in {e.table for e in edges}:
        own = [f"{typed(e.column, forms[e])} as _ref{number[e]}" for e in edges if e.table == table]
        keys = [f"{typed(e.parent_column, forms[e])} as _own{number[e]}" for e in edges if e.parent == table]
        if keys:
            slim[table] = keep(without_nan(walked[table].frame.where("_drop is null")).selectExpr(*own, *keys).distinct())

    def alive(table: str, lost: Mapping[_Edge, list[DataFrame]], rows: DataFrame) -> DataFrame:
        for e in edges:
            if e.table == table:
                for keys in lost.get(e, ()):
                    rows = rows.join(keys.select(F.col("_key").alias(f"_ref{number[e]}")), f"_ref{number[e]}", "left_anti")
        return rows

    def gone(e: _Edge, candidates: DataFrame, lost: Mapping[_Edge, list[DataFrame]]) -> DataFrame:
        """Candidates that no surviving row of the parent holds any more."""
        rows = walked[e.parent].frame.where("_drop is null") if e.parent not in slim else None
        own = f"_own{number[e]}"
        if rows is not None:
            holders = without_nan(rows).selectExpr(f"{typed(e.parent_column, forms[e])} as _key")
        else:
            matching = slim[e.parent].join(candidates.select(F.col("_key").alias(own)), own, "left_semi")
            holders = alive(e.parent, lost, matching).select(F.col(own).alias("_key"))
        return candidates.join(holders, "_key", "left_anti")

    # The walk's own drops that came too late for a child.
    delta: dict[_Edge, DataFrame] = {}
    lost: dict[_Edge, list[DataFrame]] = {}
    for e in edges:
        if e.backward:
            dropped = without_nan(walked[e.parent].frame.where("_drop is not null"))
            keys = dropped.selectExpr(f"{typed(e.parent_column, forms[e])} as _key").where("_key is not null").distinct()
            delta[e] = keep(gone(e, keys, {}))
    turn = 0
    while True:
        delta = {e: keys for e, keys in delta.items() if not keys.isEmpty()}
        if not delta:
            break
        turn += 1
        for e, keys in delta.items():
            lost.setdefault(e, []).append(keys.withColumn("_round", F.lit(turn)))
            if len(lost[e]) > 8:  # short plans however many rounds there are
                lost[e] = [keep(reduce(DataFrame.unionByName, lost[e]))]
        after: dict[_Edge, DataFrame] = {}
        for table in {e.table for e in delta} & set(slim):
            hits = [
                slim[table].join(keys.select(F.col("_key").alias(f"_ref{number[e]}")), f"_ref{number[e]}", "left_semi").select(slim[table].columns)
                for e, keys in delta.items() if e.table == table
            ]
            hit = reduce(DataFrame.unionByName, hits)
            for e in [e for e in edges if e.parent == table]:
                candidates = hit.select(F.col(f"_own{number[e]}").alias("_key")).where("_key is not null").distinct()
                for known in lost.get(e, ()):
                    candidates = candidates.join(known.select("_key"), "_key", "left_anti")
                after[e] = keep(gone(e, candidates, lost))
        delta = after
    return {e: reduce(DataFrame.unionByName, frames) for e, frames in lost.items()}


# --- results -------------------------------------------------------------------------------------------------------

_TECHNICAL = ("_rid", "_actions", "_drop", "_unknown")


@dataclass(frozen=True)
class Cleaning:
    """All tables with their decisions; the outputs are projections of them."""

    resolved: dict[str, Resolved]

    def table(self, name: str) -> DataFrame:
        return self.resolved[name].frame.where(F.col("_drop").isNull()).drop(*_TECHNICAL)

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in self.resolved}

    def actions(self) -> DataFrame:
        """The log: every change, then the drop of a row."""
        frames = []
        for r in self.resolved.values():
            if not r.notes:
                continue
            dropped = f"case when _drop is not null then {_entry('_drop', {})} end"
            entries = r.frame.selectExpr("_rid", "_unknown", f"inline(concat(_actions, array({dropped})))").where("note is not null")
            noted = entries.selectExpr("*", f"element_at({_notes_sql(r.notes)}, note + 1) as _note")
            names = [c for c in r.frame.columns if c not in _TECHNICAL]
            classes = [when(any_bit(bits), quoted(f"{bits.upper()}_NULL")) for bits in ("explained", "suspicious")]
            outside = ", ".join(str(i) for i, n in enumerate(r.notes) if "unknown" in n) or "-1"
            per_row = {
                **{f: f"case when note in ({outside}) then _unknown.{f} else _note.{f} end" for f in ("check_id", "issue_code")},
                "row_identifier": "_rid",
                "target_column": f"coalesce(_note.target_column, {listed_names(both_sets('explained', 'suspicious'), names)})",
                "missing_class": f"nullif(concat_ws('|', {', '.join(classes)}), '')",
                "outlier_metric": f"coalesce(_note.outlier_metric, {listed_names('metrics', s.OUTLIER_METRICS)})",
                "outlier_consensus_score": "coalesce(score, cast(_note.outlier_consensus_score as int))",
                "old_value": "coalesce(old_value, _note.old_value)",
                "new_value": "coalesce(new_value, _note.new_value)",
            }
            frames.append(noted.selectExpr(*[f"{per_row.get(f, f'_note.{f}')} as {f}" for f in ACTION_FIELDS]))
        return reduce(DataFrame.unionByName, frames)

    def rejected(self) -> DataFrame:
        """Dropped rows with their reason and the whole row as JSON, NULLs kept.

        Every dropped row has exactly one reason: the first that applied.
        """
        frames = []
        for table, r in self.resolved.items():
            if not r.notes:
                continue
            data = [c for c in r.frame.columns if c not in _TECHNICAL]
            frames.append(
                r.frame.where(F.col("_drop").isNotNull()).select(
                    F.lit(table).alias("table_name"), F.col("_rid").alias("row_identifier"),
                    F.expr(f"element_at({_notes_sql(r.notes)}, _drop + 1).reason").alias("reasons"),
                    F.to_json(F.struct(*data), {"ignoreNullFields": "false"}).alias("row_data_json"),
                )
            )
        return reduce(DataFrame.unionByName, frames)


def clean(
    tables: Mapping[str, DataFrame],
    issues: DataFrame | None = None,
    missing: DataFrame | None = None,
    outliers: DataFrame | None = None,
    rules: Mapping[str, TableRules] = RULES,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
    bucketed: Collection[str] = (),
) -> Cleaning:
    """Clean all tables. `stage` (see `starq.session.stage`) may keep each resolved
    table, so that log, rejected rows and cleaned tables do not resolve it again.
    `bucketed` names the tables that are bucketed by their primary key."""
    resolved = {
        t: resolve_table(t, df, issues, missing, outliers, rules, t in bucketed) for t, df in tables.items()
    }
    return Cleaning(cascade(resolved, stage=stage))


def summary_by_table(actions: DataFrame) -> DataFrame:
    return actions.groupBy("table_name", "cleaning_action").agg(F.count("*").alias("action_count"))


DECISION_COLUMNS = (
    "source", "check_id", "information_area", "quality_flag_column", "outlier_metric", "cleaning_action",
)


def summary_by_decision(actions: DataFrame) -> DataFrame:
    return actions.groupBy(*DECISION_COLUMNS).agg(F.count("*").alias("action_count"))


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Scorecards of the same tables before and after cleaning (full outer join)."""

    def side(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(
            "table_name", F.col("overall_score").alias(f"overall_score_{suffix}"),
            F.col("issue_count").alias(f"issue_count_{suffix}"),
        )

    return side(before, "before").join(side(after, "after"), "table_name", "full").select(
        "table_name", "issue_count_before", "issue_count_after", "overall_score_before", "overall_score_after"
    )
