"""Conversation structure repair: the cheapest edits that make roles alternate.

A conversation is in order when the initials of its roles read `(s?(ua)+)?`. Edits,
by their initials, are D (delete a row, cost 4; forced for blank and repeated rows),
I (insert an empty turn of the role that is due, 3), K (keep, 0) and R (give a row
the role that is due, 3); a kept or changed row whose text is cut off adds 3. Of the
cheapest edits the ASCII-least in order are taken.

They are found by iterative-deepening A*: a depth-first search in ASCII order under
a cost bound, which then grows to the least cost that exceeded it. The estimate is
the exact cost of the same problem without its rule for the end (one backward sweep),
so bounds grow a few times at most. A state (row, role due) that failed keeps what it
needs at least in a transposition table, and is not entered again with less. The first
path that is accepted is the answer.

Two passes: the search reads one slim row per turn (a name of 128 bits and marks, no
texts); the texts then meet the edits as a stream in which one turn at a time is held.
A conversation is one task in both, as its running edits and digest demand, with some
200 bytes a turn in the first (any length of text) and one in the second.

Defined results: null roles and texts are one space; turns are ordered by turn (null
first), then role, then the name of the turn; rows without conv_id belong to no
conversation; a conversation without rows has zeros and no edits; equal rows are
repeats of the first; other columns never matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
#: States: at the start, after system, after user, after assistant. What each lets in, and where that leads.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
DUE = ("u", "u", "a", "u")
ENDS = (True, False, False, True)
ROLES = {"u": "user", "a": "assistant"}
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
SOUND, FORCED, TRUNCATED = 0, 1, 2


def _estimate(initials: list[str], faults: list[int]) -> list[int]:
    """Cost from (row, state) on if any state were a good end; 4 numbers a row, one row more than there are."""
    n = len(initials)
    out = [0] * (4 * (n + 1))
    for i in range(n - 1, -1, -1):
        after, at, initial, fault = 4 * (i + 1), 4 * i, initials[i], faults[i]
        plain, extra = [], CUT if fault == TRUNCATED else 0
        for q in range(4):
            cost = DELETE + out[after + q]
            if fault != FORCED:
                step = STEPS[q].get(initial)
                if step is not None:
                    cost = min(cost, extra + out[after + step])
                cost = min(cost, REROLE + extra + out[after + STEPS[q][DUE[q]]])
            plain.append(cost)
        for q in range(4):
            # One insertion, or two, before the row.
            one = STEPS[q][DUE[q]]
            two = STEPS[one][DUE[one]]
            out[at + q] = min(plain[q], INSERT + plain[one], 2 * INSERT + plain[two])
    return out


def cheapest(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """Cost and edits of the ASCII-least among the cheapest repairs."""
    n = len(initials)
    need = _estimate(initials, faults)  # what a state needs at least; grows as searches fail

    def edits(state: int) -> list[tuple[str, int, int]]:
        i, q = divmod(state, 4)
        due = STEPS[q][DUE[q]]
        insert = ("I", INSERT, 4 * i + due)
        if i == n:
            return [insert]
        found, extra = [("D", DELETE, state + 4), insert], CUT if faults[i] == TRUNCATED else 0
        if faults[i] != FORCED:
            step = STEPS[q].get(initials[i])
            if step is not None:
                found.append(("K", extra, 4 * (i + 1) + step))
            found.append(("R", REROLE + extra, 4 * (i + 1) + due))
        return found

    while True:
        bound = need[0]
        # Frames: state, what is left of the bound, edits not tried yet, the least that any tried one needs.
        stack, path = [[0, bound, iter(edits(0)), None]], []
        while stack:
            frame = stack[-1]
            state, left, rest, _ = frame
            if state >= 4 * n and ENDS[state % 4]:
                return bound - left, "".join(path)
            for name, cost, then in rest:
                if cost + need[then] <= left:
                    stack.append([then, left - cost, iter(edits(then)), (state, cost)])
                    path.append(name)
                    break
            else:
                need[state] = max(need[state], min(cost + need[then] for _, cost, then in edits(state)), left + 1)
                stack.pop()
                if path:
                    path.pop()


class _Rows:
    """The slim rows of one conversation."""

    def __init__(self):
        self.initials, self.faults, self.seen = [], [], set()
        self.turns, self.least, self.most, self.last = 0, None, None, None
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0

    def add(self, turn, initial: str, name: bytes, blank: bool, cut: bool) -> None:
        if turn is not None:
            # Turns come in order: a new one differs from the last.
            self.turns += self.last is None or turn != self.last
            self.last = self.most = turn
            self.least = turn if self.least is None else self.least
        fault = "blank" if blank else "duplicate" if name in self.seen else "truncated" if cut else None
        self.seen.add(name)
        if fault:
            self.counts[fault] += 1
        if self.initials:
            self.illegal += (self.initials[-1] + initial) not in ("su", "ua", "au")
        self.initials.append(initial)
        self.faults.append(SOUND if fault is None else TRUNCATED if fault == "truncated" else FORCED)

    def row(self, conv_id) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        cost, audit = cheapest(self.initials, self.faults)
        return conv_id, gaps, *self.counts.values(), self.illegal, cost, audit


_LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_AUDIT = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in _LONGS], ("audit", pa.string())])


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, now = None, None
    for batch in batches:
        done = []
        for conv_id, kind, turn, initial, name, blank, cut in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv_id != conv:
                if now is not None:
                    done.append(now.row(conv))
                conv, now = conv_id, _Rows()
            if kind:
                now.add(turn, initial, name, blank, cut)
        if done:
            yield _batch(done, _AUDIT)
    if now is not None:
        yield _batch([now.row(conv)], _AUDIT)


def _named(turns: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    name = F.unhex(F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(32)))
    return turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.lit(1).alias("kind"), F.col("turn").cast("long"), role.alias("role"),
        name.alias("name"), text.alias("text"),
    )


_ORDER = ("conv_id", "kind", "turn", "role", "name")


def audits(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, faults by kind, illegal steps, cost and edits of every conversation.

    conversations: ids (repeated or not) to be listed even if turns has no row of them.
    """
    stripped = F.rtrim("text", F.lit(SPACE))
    slim = _named(turns).select(
        *_ORDER, F.left("role", F.lit(1)).alias("initial"), (stripped == "").alias("blank"),
        (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    if conversations is not None:
        bare = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), F.lit(0).alias("kind"))
        slim = slim.unionByName(bare.distinct(), allowMissingColumns=True)
    ordered = slim.repartition("conv_id").sortWithinPartitions(*_ORDER)
    longs = ", ".join(f"{n} bigint" for n in _LONGS)
    return ordered.select("conv_id", "kind", "turn", "initial", "name", "blank", "cut").mapInArrow(
        _audits, f"conv_id bigint, {longs}, audit string"
    )


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


class _Edits:
    """Applies the edits of one conversation to its turns as they come."""

    def __init__(self, conv_id, audit: str):
        self.conv_id, self.audit, self.next, self.state, self.place = conv_id, audit, 0, 0, 0

    def _out(self, edit: str, role: str, text: str, initial: str) -> tuple:
        self.state, self.place = STEPS[self.state][initial], self.place + 1
        return self.conv_id, self.place, edit, role, text

    def inserted(self):
        while self.next < len(self.audit) and self.audit[self.next] == "I":
            self.next += 1
            due = DUE[self.state]
            yield self._out("I", ROLES[due], "", due)

    def turn(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.next]
        self.next += 1
        if edit == "K":
            yield self._out("K", role, text, role[:1])
        elif edit == "R":
            due = DUE[self.state]
            yield self._out("R", ROLES[due], text, due)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        done = []
        for conv_id, kind, audit, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if not kind:
                if now is not None:
                    done.extend(now.inserted())
                now = _Edits(conv_id, audit)
            else:
                done.extend(now.turn(role, text))
        if done:
            yield _batch(done, _REPAIRED)
    if now is not None and (done := list(now.inserted())):
        yield _batch(done, _REPAIRED)


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id, place, edit (I, K or R), role, text: the turns after the edits.

    Rows of a conversation leave their task in order of place.
    """
    edits = audited.select("conv_id", F.lit(0).alias("kind"), "audit")
    rows = _named(turns).unionByName(edits, allowMissingColumns=True)
    ordered = rows.repartition("conv_id").sortWithinPartitions(*_ORDER)
    return ordered.select("conv_id", "kind", "audit", "role", "text").mapInArrow(
        _apply, "conv_id bigint, place bigint, edit string, role string, text string"
    )


_HASHED = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, running = None, None
    for batch in batches:
        done = []
        for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if place == 1:
                if running is not None:
                    done.append((conv, running.hexdigest()))
                conv, running = conv_id, hashlib.sha256()
            running.update(("\n" if place > 1 else "").encode() + f"{role}:{text}".encode())
        if done:
            yield _batch(done, _HASHED)
    if running is not None:
        yield _batch([(conv, running.hexdigest())], _HASHED)


def digests(repaired_turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of turns as `repaired` leaves them (in its tasks and order)."""
    return repaired_turns.select("conv_id", "place", "role", "text").mapInArrow(_hashes, "conv_id bigint, repaired_sha256 string")
