"""Chat formatting: final messages from event logs, rendered with a loss mask.

A log row is (conv_id, seq, kind, turn, role, text). In order of seq:
  open        starts the message at place `turn` with a role and a first text
  delta       appends text to the message at `turn`
  edit        replaces the text of the message at `turn`; later deltas append to it
  regenerate  withdraws the messages at `turn` and after it, as logged so far
The fold works per message, so a long conversation spreads over tasks; only the
places of withdrawals run along a conversation, as a window over its turns' numbers.

A rendered row is one turn: its piece of the formatted conversation and the span
(code points within the piece) that counts towards the loss. Pieces in order of
(conv_id, turn, copy) joined by nothing are the conversation.

Defined results: null texts and roles are empty; null conv_id or turn is a value
of its own that sorts first; equal (conv_id, turn) rows of a table are separate
turns, ordered by role and text; deltas and edits without an open message are
ignored; an empty log gives no rows; other columns never matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOG = ("conv_id", "seq", "kind", "turn", "copy", "role", "text")
_PIECE = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + r"\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def log_of_turns(conversations: DataFrame, drafts: bool = False) -> DataFrame:
    """A table of finished turns as a log: each turn is opened, then its text streams in.

    drafts: turns are first answered otherwise and then, by a hash of conversation and
    turn, regenerated or edited, and streamed in two deltas; what stands in the end is the same.
    """
    one_turn = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("copy", F.row_number().over(one_turn))

    def event(kind: str, step: int, text: F.Column) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(step).alias("step"), text.alias("text"))

    empty, text = F.lit(""), F.col("text")
    events = F.array(event("open", 0, empty), event("delta", 1, text))
    if drafts:
        half = (F.length(text) / 2).cast("int")
        first, rest = F.substring(text, F.lit(1), half), F.expr("substring(text, cast(length(text) / 2 as int) + 1)")
        again = F.array(
            event("open", 0, empty), event("delta", 1, F.lit("a draft")), event("regenerate", 2, empty),
            event("open", 3, empty), event("delta", 4, first), event("delta", 5, rest),
        )
        edited = F.array(event("open", 0, F.lit("a draft")), event("edit", 3, first), event("delta", 4, rest))
        fate = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))
        events = F.when(fate == 0, again).when(fate == 1, edited).otherwise(events)
    # Later turns are logged later: a regeneration withdraws what was logged so far at its turn and after it.
    seq = F.coalesce(F.col("turn").cast("long"), F.lit(-1)) * 8 + F.col("event.step")
    return turns.withColumn("event", F.explode(events)).select("conv_id", seq.alias("seq"), "event.kind", "turn", "copy", "role", "event.text")


def fold(log: DataFrame) -> DataFrame:
    """conv_id, turn, copy, role, text: the messages that stand after all events."""
    if "copy" not in log.columns:
        log = log.withColumn("copy", F.lit(1))
    events = log.select(*LOG).withColumn("text", F.coalesce("text", F.lit("")))
    # Where each message was withdrawn last: slim rows, of conversations with regenerations only.
    message = ["conv_id", "turn", "copy"]
    slim = events.groupBy(*message).agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"))
    some = slim.where("again IS NOT NULL").select(F.col("conv_id").alias("some")).distinct()
    slim = slim.join(some, F.col("conv_id").eqNullSafe(F.col("some")), "left_semi")
    so_far = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    marks = slim.select(*message, F.lit("withdrawn").alias("kind"), F.max("again").over(so_far).alias("seq")).where("seq IS NOT NULL")
    # They meet the texts where these are gathered anyway.
    rows = events.where("kind <> 'regenerate'").unionByName(marks, allowMissingColumns=True)
    step = F.when(F.col("kind") != "withdrawn", F.struct("seq", "text", "kind", "role"))
    gathered = rows.groupBy(*message).agg(
        F.max(F.when(F.col("kind") == "withdrawn", F.col("seq"))).alias("withdrawn"), F.sort_array(F.collect_list(step)).alias("steps")
    )
    standing = F.filter("steps", lambda s: F.col("withdrawn").isNull() | (s["seq"] > F.col("withdrawn")))
    opened = F.array_max(F.transform(F.filter("steps", lambda s: s["kind"] == "open"), lambda s: F.struct(s["seq"].alias("seq"), s["role"].alias("role"))))
    messages = gathered.select(*message, standing.alias("steps")).withColumn("opened", opened).where("opened IS NOT NULL")
    # The latest full text, and the deltas after it.
    base = F.array_max(F.transform(F.filter("steps", lambda s: s["kind"] != "delta"), lambda s: s["seq"]))
    kept = F.transform(F.filter("steps", lambda s: s["seq"] >= F.col("base")), lambda s: s["text"])
    return messages.withColumn("base", base).select(*message, F.coalesce("opened.role", F.lit("")).alias("role"), F.concat_ws("", kept).alias("text"))


def _escape(c: F.Column) -> F.Column:
    """No control string is left, and every step can be undone."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """conv_id, turn, copy, piece, and the loss span [loss_start, loss_end) of the trained role's turns."""
    role = F.replace(_escape(F.col("role")), F.lit("\n"), F.lit("\\n"))
    head, body = F.concat(F.lit(START), role, F.lit("\n")), _escape(F.col("text"))
    trained = F.col("role") == trained_role
    return messages.select(
        "conv_id", "turn", "copy", F.concat(head, body, F.lit(END + "\n")).alias("piece"),
        F.when(trained, F.length(head)).alias("loss_start"), F.when(trained, F.length(head) + F.length(body)).alias("loss_end"),
    )


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int | None, end: int | None) -> None:
        role, text = map(unescape, _PIECE.fullmatch(piece).groups())
        self.turns, self.chars = self.turns + 1, self.chars + len(piece)
        self.all.update(f"{role}\n{text}\n".encode())
        if start is not None:
            trained = unescape(piece[start:end])
            self.loss_chars += len(trained)
            self.loss.update(trained.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted; only the running digest of one conversation is held."""
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    now, done = None, []
    for batch in batches:
        for conv, piece, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss_start", "loss_end"))):
            if now is None or now.conv_id != conv:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv)
            now.add(piece, start, end)
        if done:
            yield batch_of(done)
            done = []
    if now is not None:
        yield batch_of([now.row()])


def digests(rendered: DataFrame) -> DataFrame:
    """What rendered conversations hold, read back from the pieces alone."""
    rows = rendered.select(F.col("conv_id").cast("long"), "turn", "copy", "piece", "loss_start", "loss_end")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "copy").mapInArrow(_digests, DIGEST)
