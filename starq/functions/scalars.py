"""Column -> Column helpers: text keys, parsing, and the categories of the star schema.

Everything here is a built-in expression, so it stays inside generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from starq.schemas import LOCATION_ALIASES

# Accepted spellings of booleans.
TRUE_WORDS = ("true", "1", "t", "yes", "y")
FALSE_WORDS = ("false", "0", "f", "no", "n")


# Every character that counts as white space around a text.
BLANKS = "".join(
    map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)


def lookup(key: Column, table: Mapping, default: Column | None = None) -> Column:
    """Constant map lookup with a default for unknown keys."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    hit = F.try_element_at(entries, key)
    return hit if default is None else F.coalesce(hit, default)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return any_of(*[text.contains(w) for w in words])


def strip(c: Column | str) -> Column:
    """Trim every kind of white space (`trim` alone knows only blanks).

    Of a column given by its name the outermost characters are looked at first: texts
    that start and end with visible ASCII need no trimming, which costs several times as much.
    """
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    trimmed = F.btrim(text, F.lit(BLANKS))
    if not isinstance(c, str):
        return trimmed
    visible = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
    return F.when(visible, text).otherwise(trimmed)


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def match_key(c: Column) -> Column:
    """Join key of free text: missing counts as empty, case and spacing are ignored."""
    return F.lower(F.regexp_replace(strip(F.coalesce(c.cast("string"), F.lit(""))), r"\s+", " "))


def alias_key(c: Column, aliases: Mapping[str, str] = LOCATION_ALIASES) -> Column:
    key = match_key(c)
    return lookup(key, aliases, key)


def number(c: Column) -> Column:
    """Lenient number: text that is not numeric, and NaN, become NULL."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def whole_text(c: Column) -> Column:
    """'1.7' -> '1': the integer part of numeric text, as text."""
    return number(c).try_cast("bigint").cast("string")


def canonical_value(c: Column) -> Column:
    """Text form in which 1, '1' and ' 1.0 ' agree."""
    text = strip(c)
    value = number(text)
    return (
        F.when(text.rlike("^-?[0-9]{1,18}$"), text.try_cast("bigint").cast("string"))
        .when((value == F.floor(value)) & (F.abs(value) < 9e15), value.try_cast("bigint").cast("string"))
        .when(value.isNotNull(), value.cast("string"))
        .otherwise(text)
    )


def letters_and_digits(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]", "")


def canonical_domain(c: Column, allowed: Sequence[str]) -> Column:
    """The allowed value with the same letters and digits, NULL when there is none."""
    return lookup(letters_and_digits(c), {"".join(x for x in v.lower() if x.isalnum()): v for v in allowed})


def parse_bool(c: Column) -> Column:
    text = F.lower(strip(c))
    return F.when(text.isin(*TRUE_WORDS), F.lit(True)).when(text.isin(*FALSE_WORDS), F.lit(False))


def parse_bool_or_false(c: Column) -> Column:
    return F.coalesce(parse_bool(c), F.lit(False))


def duration_text_to_ms(c: Column) -> Column:
    """'1 days 02:03:04.5675' -> milliseconds, ties to the even neighbour.

    A negative duration is written as negative days and a positive rest
    ('-1 days +23:59:59.5' is half a second less than nothing), or with a sign.
    """
    text = strip(c)
    pattern = r"^(?:(-?\d+) days?,?\s+)?([+-]?)(\d+):(\d+):(\d+(?:\.\d+)?)$"

    def part(group: int) -> Column:
        return F.coalesce(
            F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast("decimal(28,9)"), F.lit(0)
        )

    clock = part(3) * 3600 + part(4) * 60 + part(5)
    seconds = part(1) * 86400 + F.when(F.regexp_extract(text, pattern, 2) == "-", -clock).otherwise(clock)
    return F.when(text.rlike(pattern), F.bround(seconds * 1000, 0).cast("bigint"))


def interval_to_ms(c: Column) -> Column:
    """Day-time interval -> milliseconds, ties to the even neighbour."""
    micros = (F.unix_micros(F.lit("1970-01-01 00:00:00").cast("timestamp") + c)).cast("decimal(28,0)")
    return F.bround(micros / 1000, 0).cast("bigint")


def composite_id(prefix: str, *parts: Column) -> Column:
    return F.concat_ws("_", F.lit(prefix), *[F.coalesce(p.cast("string"), F.lit("unknown")) for p in parts])


def band(c: Column, low: float, high: float) -> Column:
    """Low / Medium / High by two thresholds, Unknown without a value."""
    v = number(c)
    return F.when(v < low, "Low").when(v < high, "Medium").when(v.isNotNull(), "High").otherwise("Unknown")


# Class limits.
def air_temp_class(c: Column) -> Column:
    return band(c, 20, 28)


def track_temp_class(c: Column) -> Column:
    return band(c, 30, 42)


def wind_speed_class(c: Column) -> Column:
    return band(c, 2, 5)


def tyre_life_class(c: Column) -> Column:
    v = number(c)
    usable = (v >= 0) & (v < float("inf"))
    return (
        F.when(usable & (v <= 5), "Low").when(usable & (v <= 15), "Medium").when(usable, "High").otherwise("Unknown")
    )


def age_class(born: Column, on: str = "2022-01-01") -> Column:
    days = F.datediff(F.lit(on).cast("date"), born.cast("date"))
    years = F.floor(days / F.lit(365.2425))
    return (
        F.when(days.isNull() | (days < 0), "Unknown")
        .when(years < 25, "Young")
        .when(years < 30, "Intermediate")
        .otherwise("Senior")
    )


def lap_type(pit_out: Column, pit_in: Column) -> Column:
    out, into = pit_out.isNotNull(), pit_in.isNotNull()
    return (
        F.when(out & into, "PitAffectedLap").when(out, "OutLap").when(into, "InLap").otherwise("NormalLap")
    )


def tyre_set_status(fresh: Column) -> Column:
    flag = parse_bool(fresh)
    return F.when(flag, "NewSet").when(~flag, "UsedSet").otherwise("Unknown")


# First match wins, so VSC has to be tried before SC.
TRACK_STATUS_WORDS = (
    ("AllClear", ("allclear", "all clear")),
    ("VSCEnding", ("vscending", "vsc ending")),
    ("VSCDeployed", ("vscdeployed", "virtual safety car", "vsc")),
    ("SCDeployed", ("scdeployed", "safety car")),
    ("Yellow", ("yellow",)),
    ("Red", ("red",)),
)


def track_status_category(message: Column, status: Column) -> Column:
    def side(c: Column) -> Column:
        return F.coalesce(F.lower(strip(c)), F.lit(""))

    text = strip(F.concat_ws(" ", side(message), side(status)))
    chain = F.when(text == "", "Unknown")
    for name, words in TRACK_STATUS_WORDS:
        chain = chain.when(contains_any(text, words), name)
    return chain.otherwise("Other")


# Classification codes.
CLASSIFICATION_CODES = {
    "R": "Retired",
    "D": "Disqualified", "DQ": "Disqualified", "DSQ": "Disqualified",
    "E": "Excluded",
    "W": "Withdrawn",
    "F": "FailedToQualify",
    "N": "NotClassified", "NC": "NotClassified",
}


def classification_category(c: Column) -> Column:
    code = F.upper(strip(c))
    return (
        F.when(c.isNull(), "NotApplicable")
        .when(code.rlike("^[0-9]+$"), "Classified")
        .otherwise(lookup(code, CLASSIFICATION_CODES, F.lit("Other")))
    )


# Words of the race status, first match wins.
STATUS_WORDS = (
    ("Disqualified", ("disqualified", "excluded")),
    ("DidNotStart", ("did not start",)),
    ("Collision", ("collision",)),
    ("Accident", ("accident", "spun off", "crash", "damage")),
    ("PowerUnitIssue", ("engine", "power unit", "turbo")),
    (
        "MechanicalIssue",
        ("gearbox", "hydraulic", "transmission", "brake", "brakes", "suspension", "electrical", "fuel", "oil",
         "water", "exhaust", "clutch"),
    ),
    ("Retired", ("retired", "withdrawn")),
)


def status_category(c: Column) -> Column:
    text = F.lower(strip(c))
    chain = (
        F.when(c.isNull(), "NotApplicable").when(text == "finished", "Finished").when(text.startswith("+"), "Lapped")
    )
    for name, words in STATUS_WORDS:
        hit = contains_any(text, words)
        chain = chain.when(hit | (text == "dns") if name == "DidNotStart" else hit, name)
    return chain.otherwise("Other")


def gap_to_leader_ms(session_type: Column, position: Column, status: Column, time_ms: Column) -> Column:
    """0 for the race winner, the own time for finished race rows, NULL otherwise."""
    race = F.coalesce(F.upper(session_type) == "R", F.lit(False))
    winner = F.coalesce(number(position) == 1, F.lit(False))
    finished = F.coalesce(F.lower(strip(status)) == "finished", F.lit(False))
    return F.when(race & winner, F.lit(0).cast("bigint")).when(race & finished, number(time_ms).cast("bigint"))


def fill_unknown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("Unknown"))


def score(passed: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(passed.cast("double") / total, 6))


def score_status(value: Column) -> Column:
    return (
        F.when(value.isNull(), "not_applicable")
        .when(value >= 0.95, "green")
        .when(value >= 0.80, "yellow")
        .otherwise("red")
    )
