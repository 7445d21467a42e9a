"""Surrogates for personal data, with DataFrame functions only.

Detected entities are replaced by keyed surrogates of the same type and format:
letters stay letters, digits digits, capitals capitals; cards keep their leading
digit and whether their check digit is right, addresses their private range,
names follow the title's gender and the script, with particles in place. Surnames,
given names and domains are entities of their own: each has one surrogate wherever it
occurs, alone or in a whole name or address, and shares it with no other.
An entity is matched to its end: secrets of any length, digits or not, from eight
characters on; names of any number of words; domains as long as DNS allows (127
parts of 63 characters). It may follow anything but a letter or digit, and letters of scripts without spaces
too; secrets may follow letters, so names of secrets may have any prefix or quotes.
An entity has one canonical form (case and punctuation
aside), so all its spellings get the same surrogate. A surrogate that is an entity
of the corpus, or that two entities share, is drawn anew until none is left.
Where a range of addresses is too full for that (192.168 has 65,536), late draws
come from 10.0.0.0/8, and then from IPv6 ranges kept for private use and documents.
Numbers and keys of fixed length that MOST_ROUNDS draws cannot part (billions of them)
are all moved by one keyed bijection: still distinct, though one may meet a real one.

Shuffled are distinct entities and the documents that hold any; others pass.

Defined results: null texts stay null; empty texts and texts without an entity
stay as they are; n_chars, where there is such a column, follows a changed text;
every other column passes untouched, whatever its name; repeated rows stay
repeated and equal; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starq.llm.common import Scratch

#: Rounds of draws; kinds that cannot grow and are still not apart are moved by a bijection instead.
MOST_ROUNDS = 40
FIXED_LENGTH = ("ssn", "card", "phone", "key")
#: From this draw on, names, secrets and e-mail addresses may grow by a few characters,
#: and IP addresses leave their range, from twice as many on IPv4 (see _ip).
GROW_FROM = 4

# Letters of scripts that write words without spaces (South-East Asian, Chinese, Japanese, Korean): an entity may follow them.
_SPACELESS = (
    r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1100}-\x{11FF}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}"
    r"\x{AC00}-\x{D7FF}\x{F900}-\x{FAFF}\x{FF66}-\x{FFDC}\x{20000}-\x{3FFFF}"
)
_LETTER = r"0-9A-Za-z[\x{80}-\x{10FFFF}&&[\p{L}\p{M}\p{N}]&&[^" + _SPACELESS + "]]"
# What an entity may not follow: another letter, a mark or a digit.
_GATE = "(?<![" + _LETTER + "])"
_USER = "[._%+" + _LETTER + "-]"
# A space within an entity, breaking or not, and what parts the digits of phone numbers.
_GAP = r"[ \x{A0}\x{2009}\x{202F}]"
_SEP = r"[ \x{A0}\x{2009}\x{202F}.\x{2010}\x{2011}-]"
_STOP = r"(?![0-9A-Za-z])"
_QUOTE = r"""(?:\\*+["'`\x{AB}\x{BB}\x{2018}-\x{201F}]\p{Z}?)?+"""
# Names of secrets end like this, whatever stands before; they may be quoted.
_SECRET = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)" + _QUOTE + r"[\s\p{Z}]{0,3}+[=:\x{FF1A}\x{FF1D}][\s\p{Z}]{0,3}+" + _QUOTE
# A secret ends with its last letter or digit; what is matched is never given back.
_VALUE = r"(?>[0-9A-Za-z+/_.!#$%^*~=@-]{7,}[0-9A-Za-z])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

# Titles by gender, and given names by gender and script.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Господин", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа", "госпожа"),
}
GIVEN = {
    ("m", "latin"): ("Adam", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul"),
    ("f", "latin"): ("Alice", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen", "Julia", "Laura", "Nina", "Sofia"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Максим", "Олег", "Павел"),
    ("f", "cyrillic"): ("Анна", "Вера", "Дарья", "Елена", "Инна", "Мария", "Нина", "Ольга", "Софья", "Яна"),
}
# Syllables that surnames are made of.
SYLLABLES = {
    "latin": ("bar", "den", "fal", "gor", "hel", "kin", "lor", "mar", "nes", "pol", "rin", "sol", "tar", "ven", "wes", "zel"),
    "cyrillic": ("бар", "вер", "гор", "дан", "зор", "кал", "лен", "мир", "нов", "пет", "рад", "сав", "тим", "хол", "чер", "яр"),
}
_TITLE = "(?:" + "|".join(t for side in TITLES.values() for t in side) + ")"
# What may stand before a name in small letters.
PARTICLES = (
    "von", "vom", "van", "der", "den", "zu", "zur", "zum", "de", "del", "della", "di", "da", "do", "dos", "das", "du", "des",
    "la", "las", "le", "los", "y", "e", "bin", "ibn", "al", "el", "ter", "ten",
)
_PARTICLES = "(?:(?:" + "|".join(PARTICLES) + ")" + _GAP + ")*+"
_WORD = _PARTICLES + r"\p{Lu}[\p{L}\p{M}'’-]*[\p{L}\p{M}]"
# Given names and initials come in any number; the last word is no initial.
_INITIALS = r"(?:\p{Lu}\." + _GAP + "?)*+"
_NAME = _INITIALS + _WORD + "(?:" + _GAP + _INITIALS + _WORD + ")*+"

_GATED = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}" + _STOP,
    r"[3-6]\d{15}" + _STOP, r"[3-6]\d{3}(?:" + _GAP + r"\d{4}){3}" + _STOP, r"[3-6]\d{3}-\d{4}-\d{4}-\d{4}" + _STOP,
    r"\d{3}-\d{2}-\d{4}" + _STOP,
    r"\+\d{1,3}" + _SEP + r"?(?:\(\d{1,4}\)|\d{1,4})(?:" + _SEP + r"\d{2,4}){2,4}" + _STOP,
    # In one piece, or with a gap after the country and the area: no decimal points.
    r"\+\d{1,3}(?:-|" + _GAP + r")?(?:\(\d{1,5}\)|\d{1,5})(?:-|" + _GAP + r")?\d{5,10}" + _STOP,
    r"\(\d{3}\)" + _GAP + r"?\d{3}" + _SEP + r"\d{4}" + _STOP, r"\d{3}[.-]\d{3}[.-]\d{4}" + _STOP,
    r"(?<!\.)(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![0-9A-Za-z]|\.\d)",
    _TITLE + r"\.?" + _GAP + _NAME,
)
# What the gated ones begin with, so that most places are passed at once.
_BEGIN = "(?=[0-9+(A" + "".join(sorted({t[0] for side in TITLES.values() for t in side})) + "])"

PATTERN = (
    "(?:(?<!" + _USER + ")" + _USER + r"++@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,63}+(?![0-9A-Za-z-])"
    + "|(?=[PpSsTtAa])" + _SECRET + _VALUE + "|" + _BEGIN + _GATE + "(?:" + "|".join(_GATED) + "))"
)


def _kind(e: Column) -> Column:
    cyrillic = F.when(e.rlike(r"[\x{400}-\x{4FF}]"), "cyrillic").otherwise("latin")
    title = F.regexp_extract(e, "^" + _TITLE, 0)
    gender = F.when(title.isin(*TITLES["f"]), "f").otherwise("m")
    return (
        F.when(e.rlike("^" + _SECRET), "secret").when(e.contains("@"), "email").when(e.rlike("^A[KS]IA[0-9A-Z]{16}$"), "key")
        .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(e.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "ip")
        .when(e.rlike(r"^[3-6]\d{3}(?:(?:-|" + _GAP + r")?\d{4}){3}$"), "card")
        .when(e.rlike("^" + _TITLE + r"\.?" + _GAP), F.concat_ws(":", F.lit("name"), gender, cyrillic)).otherwise("phone")
    )


def _lead(kind: Column, e: Column) -> Column:
    """What stays in front of the replaced part."""
    return (
        F.when(kind == "secret", F.regexp_extract(e, "^(" + _SECRET + ")", 1)).when(kind == "key", F.substring(e, 1, 4))
        .when(kind.startswith("name"), F.regexp_extract(e, "^(" + _TITLE + r"\.?" + _GAP + ")", 1))
        .when(kind == "email", F.regexp_extract(e, "^([._%+-]*)[^@]", 1)).otherwise("")
    )


def _canonical(kind: Column, body: Column) -> Column:
    digits = F.regexp_replace(body, r"\D", "")
    words = F.regexp_replace(F.regexp_replace(body, _GAP, " "), r"(\p{Lu}\.)(?=\p{Lu})", "$1 ")
    return (
        F.when(kind == "email", F.lower(body)).when(kind.startswith("name"), F.lower(words))
        .when(kind == "phone", F.regexp_replace(digits, r"^1(?=\d{10}$)", "")).when(kind.isin("card", "ssn"), digits).otherwise(body)
    )


# Drawing ----------------------------------------------------------------------


def _seed(key: str, *parts) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *(p if isinstance(p, Column) else F.lit(p) for p in parts)), 256)


def _draw(seed: Column, i, n) -> Column:
    return F.pmod(F.xxhash64(seed, i if isinstance(i, Column) else F.lit(i)), F.lit(n)).cast("int")


def _at(text: Column, i: Column) -> Column:
    return F.substring(text, i, F.lit(1))


def _joined(text: Column, one) -> Column:
    """one(place) for every place of a text that may be empty."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.concat_ws("", F.transform(places, one))


def _same_class(text: Column, seed: Column, letters: int | Column = 26) -> Column:
    """Digits to digits, letters to letters of the same case (the first `letters` of them)."""

    def one(i):
        c = _at(text, i)
        pick = lambda alphabet: F.substring(F.lit(alphabet), _draw_up_to(seed, i, letters) + 1, F.lit(1))
        return (
            F.when(c.between("0", "9"), _draw(seed, i, 10).cast("string")).when(c.between("a", "z"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.between("A", "Z"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz")).otherwise(c)
        )

    return _joined(text, one)


def _draw_up_to(seed: Column, i: Column, n) -> Column:
    return F.pmod(F.xxhash64(seed, i), n if isinstance(n, Column) else F.lit(n)).cast("int")


def _extra(seed: Column, attempt: Column) -> Column:
    """Characters that late draws may add."""
    return F.when(attempt >= GROW_FROM, F.lower(F.substring(seed, F.lit(1), attempt))).otherwise("")


def _email(c: Column, key: str, attempt: Column) -> Column:
    """Another user at the same domain; the domain is replaced as an entity of its own."""
    seed = _seed(key, "email", c, attempt.cast("string"))
    return F.concat(_same_class(F.substring_index(c, "@", 1), seed), _extra(seed, attempt), F.lit("@"), F.substring_index(c, "@", -1))


def _domain(c: Column, seed: Column, attempt: Column) -> Column:
    """Another site of the same top domain; all draws but the first are longer than the last."""
    top = F.substring_index(c, ".", -1)
    site = F.substring(c, F.lit(1), F.length(c) - F.length(top) - 1)
    more = F.when(attempt > 0, F.lower(F.substring(seed, F.lit(1), attempt))).otherwise("")
    return F.concat(_same_class(site, seed), more, F.lit("."), top)


def _luhn(payload: Column) -> Column:
    """The check digit of 15 digits."""

    def step(total, i):
        digit = _at(payload, i).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.lit(15)), F.lit(0), step)
    return F.pmod(10 - total % 10, F.lit(10))


def _card(c: Column, seed: Column) -> Column:
    payload = F.concat(F.substring(c, 1, 1), F.concat_ws("", F.transform(F.sequence(F.lit(2), F.lit(15)), lambda i: _draw(seed, i, 10).cast("string"))))
    valid = _luhn(F.substring(c, 1, 15)) == F.substring(c, 16, 1).cast("int")
    off = F.when(valid, 0).otherwise(1 + _draw(seed, 16, 9))
    return F.concat(payload, ((_luhn(payload) + off) % 10).cast("string"))


def _phone(c: Column, seed: Column) -> Column:
    def one(i):
        right = F.length(c) - i
        drawn = F.when(right.isin(9, 6), 2 + _draw(seed, i, 8)).otherwise(_draw(seed, i, 10))
        return F.when(right >= 10, _at(c, i)).otherwise(drawn.cast("string"))

    return _joined(c, one)


def _ip(c: Column, seed: Column, attempt: Column) -> Column:
    """In the range of c; late draws in 10.0.0.0/8, still later ones in IPv6 ranges that no one can use up.

    Those are fd00::/8 for private addresses (unique local) and 2001:db8::/32 for others (documentation).
    """
    octet = lambda i: _draw(seed, i, 256).cast("string")
    private = c.rlike(r"^(10|127|192\.168|172\.(1[6-9]|2\d|3[01]))\.")
    words = lambda n: F.concat_ws(":", *(F.substring(seed, 1 + 4 * i, 4) for i in range(n)))
    wide = F.when(private, F.concat(F.lit("fd"), F.substring(seed, 61, 2), F.lit(":"), words(7))).otherwise(F.concat(F.lit("2001:db8:"), words(6)))
    return (
        F.when(attempt >= 2 * GROW_FROM, wide)
        .when(private & (attempt >= GROW_FROM), F.concat_ws(".", F.lit("10"), octet(2), octet(3), octet(4)))
        .when(c.rlike(r"^(10|127)\."), F.concat_ws(".", F.substring_index(c, ".", 1), octet(2), octet(3), octet(4)))
        .when(c.startswith("192.168."), F.concat_ws(".", F.lit("192.168"), octet(3), octet(4)))
        .when(c.rlike(r"^172\.(1[6-9]|2\d|3[01])\."), F.concat_ws(".", F.lit("172"), (16 + _draw(seed, 2, 16)).cast("string"), octet(3), octet(4)))
        .otherwise(F.concat_ws(".", (11 + _draw(seed, 1, 89)).cast("string"), octet(2), octet(3), octet(4)))
    )


def _rotated(kind: Column, c: Column, key: str) -> Column:
    """Every character moved within its class by a keyed step of its place: one to one at any number of entities.

    Cards keep their first digit, and how far their check digit is off.
    """
    seed = _seed(key, "rotation")

    def one(i):
        char = _at(c, i)
        turn = lambda signs: F.substring(F.lit(signs), F.pmod(F.instr(F.lit(signs), char) + _draw(seed, i, len(signs) - 1), F.lit(len(signs))) + 1, F.lit(1))
        return F.when(char.between("0", "9"), turn("0123456789")).when(char.between("A", "Z"), turn("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(char)

    turned = _joined(c, one)
    payload = F.concat(F.substring(c, 1, 1), F.substring(turned, 2, 14))
    off = F.pmod(F.substring(c, 16, 1).cast("int") - _luhn(F.substring(c, 1, 15)), F.lit(10))
    return F.when(kind == "card", F.concat(payload, ((_luhn(payload) + off) % 10).cast("string"))).otherwise(turned)


def _ssn(seed: Column) -> Column:
    return F.concat(
        F.lpad((1 + _draw(seed, 1, 665)).cast("string"), 3, "0"), F.lpad((1 + _draw(seed, 2, 99)).cast("string"), 2, "0"),
        F.lpad((1 + _draw(seed, 3, 9999)).cast("string"), 4, "0"),
    )


def _syllables(script: str, seed: Column, n: Column) -> Column:
    pick = lambda i: F.element_at(F.array(*map(F.lit, SYLLABLES[script])), 1 + _draw(seed, i, len(SYLLABLES[script])))
    return F.concat_ws("", F.transform(F.sequence(F.lit(1), n), pick))


def _name_part(kind: Column, seed: Column, attempt: Column) -> Column:
    """Small letters of a given name (of the list at first, then of syllables) or a surname. Every draw takes a syllable more."""
    out = F.lit(None).cast("string")
    for script in SYLLABLES:
        for gender in TITLES:
            names = GIVEN[gender, script]
            listed = F.lower(F.element_at(F.array(*map(F.lit, names)), 1 + _draw(seed, 0, len(names))))
            made = F.concat(_syllables(script, seed, 1 + attempt), F.lit({"latin": "a", "cyrillic": "а"}[script] if gender == "f" else ""))
            out = F.when(kind == f"given:{gender}:{script}", F.when(attempt == 0, listed).otherwise(made)).otherwise(out)
            ending = {"latin": "", "cyrillic": "ова" if gender == "f" else "ов"}[script]
            family = F.concat(_syllables(script, seed, 2 + attempt), F.lit(ending))
            out = F.when(kind == _family(F.lit(gender), F.lit(script)), family).otherwise(out)
    return out


def _family(gender: Column, script: Column) -> Column:
    """Surnames are one kind where they do not change with the gender."""
    return F.when(script == "cyrillic", F.concat_ws(":", F.lit("family"), gender, script)).otherwise(F.concat_ws(":", F.lit("family"), script))


# The letters that initials are moved among, each within its alphabet.
_ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя")


def _initial(word: Column, key: str) -> Column:
    """Another initial, by a keyed rotation of its alphabet: different initials stay different."""
    letter, out = F.substring(word, 1, 1), F.substring(word, 1, 1)
    for alphabet in _ALPHABETS:
        place, shift = F.instr(F.lit(alphabet), letter), 1 + _draw(_seed(key, "initial", alphabet), 0, len(alphabet) - 1)
        out = F.when(place > 0, F.substring(F.lit(alphabet), F.pmod(place - 1 + shift, F.lit(len(alphabet))) + 1, F.lit(1))).otherwise(out)
    return F.concat(F.upper(out), F.lit("."))


def _surrogate(key: str) -> Column:
    """Of columns kind, canon, attempt."""
    kind, c, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    seed = _seed(key, kind, c, attempt.cast("string"))
    letters = F.when(c.rlike("^[0-9a-f]+$") | c.rlike("^[0-9A-F]+$"), 6).otherwise(26)
    return (
        F.when(kind == "email", _email(c, key, attempt)).when(kind == "card", _card(c, seed)).when(kind == "phone", _phone(c, seed))
        .when(kind == "ip", _ip(c, seed, attempt)).when(kind == "ssn", _ssn(seed)).when(kind == "domain", _domain(c, seed, attempt))
        .when(kind.startswith("given") | kind.startswith("family"), _name_part(kind, seed, attempt))
        .when(kind == "secret", F.concat(_same_class(c, seed, letters), _extra(seed, attempt))).otherwise(_same_class(c, seed, letters))
    )


def _poured(kind: Column, body: Column, s: Column) -> Column:
    """The surrogate in the spelling of the occurrence: its punctuation, gaps and capitals."""
    cased = _joined(body, lambda i: F.when(_at(body, i).between("A", "Z"), F.upper(_at(s, i))).otherwise(_at(s, i)))

    def digit(i):
        from_right = F.length(F.regexp_replace(F.substring(body, i, F.length(body)), r"\D", ""))
        known = _at(body, i).between("0", "9") & (from_right <= F.length(s))
        return F.when(known, _at(s, F.length(s) - from_right + 1)).otherwise(_at(body, i))

    words, gaps = F.split(F.when(body == F.upper(body), F.upper(s)).otherwise(s), " "), F.regexp_extract_all(body, F.lit(_GAP), F.lit(0))
    spaced = F.concat_ws("", F.flatten(F.zip_with(words, gaps, lambda w, g: F.array(w, F.coalesce(g, F.lit(""))))))
    return (
        F.when((kind == "email") & (F.length(body) == F.length(s)), cased).when(kind.isin("phone", "card", "ssn"), _joined(body, digit))
        .when(kind.startswith("name"), F.when(F.size(gaps) == F.size(words) - 1, spaced).otherwise(F.concat_ws(" ", words))).otherwise(s)
    )


# Replacing --------------------------------------------------------------------


def mapping(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """kind, canon, surrogate of distinct entities(kind, canon): one to one within a kind, and none an entity itself.

    Only entities that collide are drawn again; each round is one aggregate over
    distinct entities and their draws.
    """
    drawn = lambda df: df.withColumn("surrogate", _surrogate(key))
    now = scratch.write(drawn(entities.withColumn("attempt", F.lit(0))), "draw-0")
    for turn in range(1, MOST_ROUNDS + 1):
        values = now.select("kind", F.col("surrogate").alias("value"), "canon").union(
            entities.select("kind", F.col("canon").alias("value"), F.lit(None).cast("string").alias("canon"))
        )
        # A value that is an entity, or that several drew, stays with nobody or with the least of them.
        taken = values.groupBy("kind", "value").agg(
            F.min("canon").alias("holder"), F.count("canon").alias("drew"), F.count(F.lit(1)).alias("n")
        ).where("drew > 1 OR n > drew AND drew > 0")
        clash = scratch.write(taken.select("kind", F.col("value").alias("surrogate"), F.when(F.col("n") == F.col("drew"), F.col("holder")).alias("holder")), f"clash-{turn}")
        if clash.isEmpty():
            return now.select("kind", "canon", "surrogate")
        met = now.join(clash, ["kind", "surrogate"], "left").withColumn(
            "lost", F.col("holder").isNotNull() & (F.col("holder") != F.col("canon"))
        )
        all_lost = clash.where("holder IS NULL").select("kind", "surrogate", F.lit(True).alias("real"))
        met = met.join(all_lost, ["kind", "surrogate"], "left")
        again = F.col("lost") | F.coalesce("real", F.lit(False))
        redrawn = met.withColumn("attempt", F.col("attempt") + again.cast("int")).select("kind", "canon", "attempt")
        now = scratch.write(drawn(redrawn), f"draw-{turn}")
    # Kinds of fixed length that are too full to draw from: all of the kind is moved by one bijection.
    stuck = {r["kind"] for r in clash.select("kind").distinct().collect()}
    if stuck - set(FIXED_LENGTH):
        raise RuntimeError(f"no distinct surrogates found for {sorted(stuck - set(FIXED_LENGTH))}")
    moved = F.when(F.col("kind").isin(*stuck), _rotated(F.col("kind"), F.col("canon"), key)).otherwise(F.col("surrogate"))
    return now.select("kind", "canon", moved.alias("surrogate"))


def _name_words(entities: DataFrame) -> DataFrame:
    """kind, canon, place, word and part (the kind of the word, NULL for particles and initials) of names."""
    names = entities.where(F.col("kind").startswith("name")).select("kind", "canon", F.split("canon", " ").alias("words"))
    words = names.select("kind", "canon", F.size("words").alias("n"), F.posexplode("words").alias("place", "word"))
    gender, script = F.split_part("kind", F.lit(":"), F.lit(2)), F.split_part("kind", F.lit(":"), F.lit(3))
    part = F.when(F.col("place") == F.col("n") - 1, _family(gender, script)).when(
        ~F.col("word").isin(*PARTICLES) & ~F.col("word").endswith("."), F.concat_ws(":", F.lit("given"), gender, script)
    )
    return words.select("kind", "canon", "place", "word", part.alias("part"))


def surrogates(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """kind, canon, surrogate of distinct entities(kind, canon).

    Surnames, given names and domains are entities of their own: each has one surrogate
    wherever it occurs, and that one no other. Names and e-mail addresses are put together
    from these, so they are as distinct as their parts.
    """
    entities = entities.select("kind", "canon")
    words = scratch.write(_name_words(entities), "words")
    whole = entities.where(~F.col("kind").startswith("name"))
    domain = F.substring_index("canon", "@", -1)
    parts = whole.union(words.where("part IS NOT NULL").select("part", "word").distinct()).union(
        whole.where("kind = 'email'").select(F.lit("domain"), domain).distinct()
    )
    mapped = scratch.write(mapping(scratch.write(parts, "parts"), key, scratch), "mapped")

    known = mapped.select(F.col("kind").alias("part"), F.col("canon").alias("word"), "surrogate")
    new_word = (
        F.when(F.col("surrogate").isNotNull(), F.initcap("surrogate")).when(F.col("word").endswith("."), _initial(F.col("word"), key)).otherwise(F.col("word"))
    )
    placed = words.where("part IS NOT NULL").join(known, ["part", "word"]).unionByName(words.where("part IS NULL"), allowMissingColumns=True)
    names = placed.groupBy("kind", "canon").agg(
        F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("place", new_word.alias("said")))), lambda w: w["said"])).alias("surrogate")
    )
    domains = mapped.where("kind = 'domain'").select(F.col("canon").alias("domain"), F.col("surrogate").alias("site"))
    emails = mapped.where("kind = 'email'").withColumn("domain", domain).join(domains, "domain").select(
        "kind", "canon", F.concat(F.substring_index("surrogate", "@", 1), F.lit("@"), "site").alias("surrogate")
    )
    alone = mapped.where(~F.col("kind").isin("email", "domain") & ~F.col("kind").startswith("given") & ~F.col("kind").startswith("family"))
    return alone.unionByName(names).unionByName(emails)


def replace_entities(docs: DataFrame, key: str, count_as: str | None = None) -> DataFrame:
    """docs with every detected entity replaced; count_as names a column for their number."""
    scratch = Scratch(docs.sparkSession, "pii")
    text = F.col("text").cast("string")
    found = docs.select(F.struct("*").alias("doc"), F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PATTERN), F.lit(0)).alias("found"))
    held = scratch.write(found.where(F.size("found") > 0).withColumn("row", F.monotonically_increasing_id()), "held")
    kind, body = F.col("kind"), F.col("body")
    spelled = (
        held.select("row", F.posexplode("found").alias("place", "entity")).withColumn("kind", _kind(F.col("entity")))
        .withColumn("lead", _lead(kind, F.col("entity"))).withColumn("body", F.expr("substring(entity, length(lead) + 1)"))
        .withColumn("canon", _canonical(kind, body))
    )
    entities = scratch.write(spelled.select("kind", "canon").distinct(), "entities")
    said = spelled.join(surrogates(entities, key, scratch), ["kind", "canon"]).select(
        "row", "place", F.concat("lead", _poured(kind, body, F.col("surrogate"))).alias("said")
    )
    per_row = said.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "said"))), lambda s: s["said"]).alias("said"))
    between = F.split(F.col("doc.text").cast("string"), PATTERN, -1)
    woven = F.concat_ws("", F.flatten(F.zip_with(between, F.col("said"), lambda b, s: F.array(b, F.coalesce(s, F.lit(""))))))
    changed = held.join(per_row, "row").withColumn("new_text", woven)

    def columns(df: DataFrame, new_text: Column | None, n: Column) -> DataFrame:
        out = []
        for c in docs.columns:
            own = F.col("doc").getField(c)
            if new_text is not None and c == "text":
                own = new_text
            elif new_text is not None and c == "n_chars":
                own = F.length(new_text).cast(docs.schema[c].dataType)
            out.append(own.alias(c))
        return df.select(*out, *([n.cast("int").alias(count_as)] if count_as else []))

    same = columns(found.where(F.size("found") == 0), None, F.lit(0))
    return same.unionByName(columns(changed, F.col("new_text"), F.size("found")))
