"""Removal of repeated passages by recompression.

Rounds replace runs of an equal symbol and then pairs of symbols by one symbol
each. A symbol's name is a hash of what it stands for, so that all executors give
equal passages equal names without asking; whether two neighbours pair up is told
by one random bit of each name. Next to every symbol goes the stretch of words its
making depended on: equal stretches make equal symbols wherever they stand.

Every window of WINDOW words takes, of the highest-level symbols whose stretch
lies inside it, the leftmost of those that hash lowest. Equal windows take equal symbols, so
only windows whose symbol is shared can repeat.

Windows side by side that take the same symbol are a run. Runs of the same words
(by 96 bits of two independent hashes) are settled whole: the earliest stays, the
others go. A symbol that always stands in the same run is done with that; no run
holds equal windows, as these would take symbols at different places. Where a
symbol's runs differ, the windows of one run of each kind, of two at most, are
compared word for word (by 96 bits too), and the earliest one stays. So what is
shuffled is a row per run, and windows of different runs only, however often
passages are repeated.

Documents with the same words as an earlier document are settled as a whole.
Runs that repeat within one batch go to the shuffle once per batch, and further runs
of a symbol apart from its first, so that a passage in a third of all documents does
not meet in one task.

Defined results: null and blank texts have no words and keep the empty string;
documents shorter than a window keep all; rows with the same doc_id are one
document and do not repeat each other; a null doc_id is compared with nothing;
an empty table gives no rows; columns other than doc_id and text never matter. One
text is held whole in a task, at some 46 bytes of memory a byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starq.llm import words
from starq.llm.common import Scratch, only, plain_documents
from starq.llm.words import U64, Scan, mix

WINDOW = 20
#: Rounds after which symbols serve as anchors: their stretches are about 8 words long.
ROUNDS = 2
_FAR = 1 << 40
_SEED = words._numbers(77, 16)


class Symbols:
    """The symbols of a level: names, places in words, and the stretch [low, high) each depends on."""

    def __init__(self, names, starts, ends, low, high, doc):
        self.names, self.starts, self.ends, self.low, self.high, self.doc = names, starts, ends, low, high, doc

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the stretch of the symbol to the left begins and that to the right ends; far off at a border."""
        low, high = np.full(len(self.names), -_FAR), np.full(len(self.names), _FAR)
        same = self.doc[1:] == self.doc[:-1]
        low[1:] = np.where(same, self.low[:-1], -_FAR)
        high[:-1] = np.where(same, self.high[1:], _FAR)
        return low, high


def _runs(s: Symbols, level: int) -> Symbols:
    """Names maximal runs. Not being in a longer run depends on both neighbours too."""
    begin = np.ones(len(s.names), bool)
    begin[1:] = (s.names[1:] != s.names[:-1]) | (s.doc[1:] != s.doc[:-1])
    first = np.flatnonzero(begin)
    last = np.append(first[1:], len(begin)) - 1
    count = (last - first + 1).astype(U64)
    left, right = s.neighbours()
    names = np.where(count > 1, mix(s.names[first] * _SEED[4 * level] + count * _SEED[4 * level + 1]), s.names[first])
    return Symbols(
        names, s.starts[first], s.ends[last], np.minimum(s.low[first], left[first]), np.maximum(s.high[last], right[last]), s.doc[first]
    )


def _pairs(s: Symbols, level: int) -> Symbols:
    """Joins a symbol of bit 0 and a following one of bit 1; such pairs never overlap."""
    bit = (mix(s.names + _SEED[4 * level + 2]) >> U64(63)).astype(bool)
    opens = np.zeros(len(bit), bool)
    opens[:-1] = ~bit[:-1] & bit[1:] & (s.doc[1:] == s.doc[:-1])
    closes = np.zeros(len(bit), bool)
    closes[1:] = opens[:-1]
    left, right = s.neighbours()
    # Staying single depends on the neighbour it could have joined.
    low = np.where(bit & ~closes, np.minimum(s.low, left), s.low)
    high = np.where(~bit & ~opens, np.maximum(s.high, right), s.high)
    kept = np.flatnonzero(~closes)
    ends = kept + opens[kept]
    names = np.where(opens[kept], mix(s.names[kept] * _SEED[4 * level + 3] + s.names[ends]), s.names[kept])
    return Symbols(names, s.starts[kept], s.ends[ends], np.minimum(low[kept], low[ends]), np.maximum(high[kept], high[ends]), s.doc[kept])


def levels(hashes: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> list[Symbols]:
    at = np.arange(len(hashes))
    out = [Symbols(hashes, at, at + 1, at, at + 1, doc)]
    for level in range(rounds):
        out.append(_pairs(_runs(out[-1], level), level))
    return out[1:]


def window_hashes(hashes: np.ndarray, seed: int = 0) -> np.ndarray:
    return words.grams(hashes, WINDOW, seed)


def anchors(scan: Scan) -> tuple[np.ndarray, ...]:
    """key, two hashes of the words, document, first window and number of windows: runs of windows that take the same anchor."""
    hashes, doc = scan.word_hashes(), scan.doc_of
    inner = words.inside(scan.bounds, WINDOW)
    if not len(inner):
        none = np.zeros(0, np.int64)
        return none.astype(U64), none.astype(U64), none.astype(U64), none, none, none
    up, down = words._power(len(hashes))
    total = np.concatenate([np.zeros(1, U64), np.cumsum(hashes * up[: len(hashes)], dtype=U64)])
    taken, keys = np.full(len(hashes), -1), []
    count = 0
    for number, s in enumerate(levels(hashes, doc)):
        fits = np.flatnonzero(s.high - s.low <= WINDOW)
        low, high, place = s.low[fits], s.high[fits], s.starts[fits] - s.low[fits]
        span = (total[high] - total[low]) * down[low]
        key = mix(span + ((high - low) * 4096 + place * 64 + number).astype(U64) * _SEED[15])
        first = np.maximum(high - WINDOW, scan.bounds[doc[low]])
        last = np.minimum(low, scan.bounds[doc[low] + 1] - WINDOW)
        # The lowest hash of the highest level is written last; of equal ones, the leftmost.
        order = np.argsort(key, kind="stable")[::-1]
        covered = np.maximum(last - first + 1, 0)[order]
        taken[np.repeat(first[order], covered) + words.ranges(covered)] = np.repeat(order + count, covered)
        keys.append(key)
        count += len(key)
    taken = taken[inner]
    all_keys = np.concatenate(keys)
    # A window without any symbol of its own (a long run, say) is its own anchor.
    alone = taken < 0
    windows = window_hashes(hashes)
    key = mix(windows[inner] ^ _SEED[14])
    key[~alone] = all_keys[taken[~alone]]
    begin = np.ones(len(inner), bool)
    begin[1:] = alone[1:] | (taken[1:] != taken[:-1]) | (np.diff(inner) != 1) | (doc[inner[1:]] != doc[inner[:-1]])
    first = np.flatnonzero(begin)
    size = np.diff(np.append(first, len(inner)))
    at = inner[first]
    # A run has no more windows than a window has words: its first and its last window hold all of its words.
    a, b = (mix(h[at] * _SEED[8] + h[at + size - 1] * _SEED[9] + size.astype(U64) * _SEED[10]) for h in (windows, window_hashes(hashes, 1)))
    return key[first], a, b, doc[at], at - scan.bounds[doc[at]], size


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words, and the digest of the words joined by one space.

    bytes.split() cuts at exactly the separators of a word: 0x20 and 0x09 to 0x0D.
    """
    for batch in batches:
        joined = [b" ".join(t.as_py().encode().split()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array([j.count(b" ") + 1 if j else 0 for j in joined], pa.int64()),
                pa.array([hashlib.sha256(j).hexdigest() for j in joined]),
            ], ["doc_id", "n_words", "sha"],
        )


#: Rows a task gathers before it looks for repeats among them and sends them on.
GATHERED = 500_000
ANCHORS = "key long, salt int, a long, b int, doc long, at long"


def _gathered(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= GATHERED:
            yield list(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield list(map(np.concatenate, zip(*held)))


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _others(n: int) -> np.ndarray:
    """Salts for rows that need not meet any other."""
    return 1 + np.arange(n) % 1_000_003


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of windows.

    at: first window * 128 + (windows - 1) * 4 + (the key has different runs in this task) * 2 + (an earlier equal run came before in this task).
    """

    def found():
        for batch in batches:
            ids = np.asarray(batch.column("doc_id"), np.int64)
            for scan in words.scans(batch.column("text")):
                key, a, b, doc, at, size = anchors(scan)
                yield key.view(np.int64), a.view(np.int64), (b >> U64(32)).astype(np.uint32).view(np.int32), ids[scan.first + doc], at * 32 + size - 1

    for columns in _gathered(found()):
        # Repeated rows of a document are one row.
        order = np.lexsort(columns[::-1])
        order = order[_changes(*(c[order] for c in columns))]
        key, a, b, doc, at = (c[order] for c in columns)
        first, kept = _changes(key), _changes(key, a, b)
        group = np.cumsum(first) - 1
        differ = np.bincount(group, kept)[group] > 1
        # By their words, so that equal runs meet; what is settled here meets nothing.
        salt = np.where(kept, np.where(first, 0, 1 + a % 1_000_003), _others(len(a))).astype(np.int32)
        columns = np.where(kept, key, 0), salt, np.where(kept, a, 0), np.where(kept, b, 0).astype(np.int32), doc, at * 4 + differ * 2 + ~kept
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "salt", "a", "b", "doc", "at"])


WINDOWS = "a long, b int, salt int, doc long, at long"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suspect windows: two hashes and place. at: place * 2 + (an earlier equal window came before in this task)."""

    def found():
        for batch in batches:
            ids, marks = np.asarray(batch.column("doc_id"), np.int64), batch.column("marks")
            for scan in words.scans(batch.column("text")):
                hashes = scan.word_hashes()
                own = marks.slice(scan.first, scan.docs)
                mark = np.asarray(own.flatten(), np.int64)
                size = (mark >> 1 & 31) + 1
                doc = np.repeat(np.repeat(np.arange(scan.docs), np.asarray(own.value_lengths(), np.int64)), size)
                at = np.repeat(mark >> 6, size) + words.ranges(size)
                # Rows that share a doc_id share their marks: a place may lie beyond the shorter text.
                valid = at + WINDOW <= scan.n_words[doc]
                doc, at = doc[valid], at[valid]
                if len(at):
                    place = scan.bounds[doc] + at
                    a, b = window_hashes(hashes)[place], window_hashes(hashes, 1)[place]
                    yield a.view(np.int64), (b >> U64(32)).astype(np.uint32).view(np.int32), ids[scan.first + doc], at

    for columns in _gathered(found()):
        # Repeated rows of a document are one row.
        order = np.lexsort(columns[::-1])
        order = order[_changes(*(c[order] for c in columns))]
        a, b, doc, at = (c[order] for c in columns)
        first = _changes(a, b)
        salt = np.where(first, 0, _others(len(a))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(list(map(pa.array, (a, b, salt, doc, at * 2 + ~first))), ["a", "b", "salt", "doc", "at"])


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes out the words of removed windows. places: first window * 64 + (windows - 1) * 2 + any bit."""
    for batch in batches:
        rows = []
        for doc, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("places").to_pylist()):
            found = text.as_py().encode().split()
            gone = np.zeros(len(found) + 1, np.int64)
            # Rows that share a doc_id share their places: one may lie beyond the shorter text, or end there.
            starts, more = np.array(places) >> 6, np.array(places) >> 1 & 31
            valid = starts + WINDOW <= len(found)
            np.add.at(gone, starts[valid], 1)
            np.add.at(gone, np.minimum(starts + more + WINDOW, len(found))[valid], -1)
            gone = np.cumsum(gone)[:-1] > 0
            kept = [w for w, g in zip(found, gone.tolist()) if not g]
            digests = (hashlib.sha256(b" ".join(w)).hexdigest() for w in (found, kept))
            rows.append({"doc_id": doc, "n_removed": int(gone.sum()), **dict(zip(("sha", "kept"), digests))})
        yield pa.RecordBatch.from_pylist(
            rows, pa.schema([("doc_id", pa.int64()), ("n_removed", pa.int64()), ("sha", pa.string()), ("kept", pa.string())])
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    scratch = Scratch(docs.sparkSession, "repeats")
    texts = plain_documents(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    whole = scratch.write(texts.mapInArrow(_whole, "doc_id long, n_words long, sha string"), "whole")
    first = whole.where(F.col("n_words") >= WINDOW).groupBy("sha", "n_words").agg(
        F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")
    ).where("last > rep")
    first = scratch.write(first, "first")
    copies = scratch.write(
        whole.join(first, ["sha", "n_words"]).where("doc_id > rep").select("doc_id", "sha"), "copies"
    )
    scratch.drop("first")

    # Runs of the same words: all but the earliest go. What stays is looked at closer if its anchor has other runs.
    named = texts.where("doc_id IS NOT NULL").mapInArrow(_anchors, ANCHORS)
    keyed, alike = Window.partitionBy("key", "salt"), Window.partitionBy("key", "salt", "a", "b")
    runs = scratch.write(
        # One order serves both windows.
        named.repartition("key", "salt").sortWithinPartitions("key", "salt", "a", "b").select(
            "doc", "at", ((F.max(F.expr("at & 2")).over(keyed) > 0) | (F.max("a").over(keyed) != F.min("a").over(keyed))).alias("other"),
            F.min(F.struct("doc", F.expr("at div 4"))).over(alike).alias("first"),
        ).withColumn("gone", F.expr("at % 2 = 1 OR first.doc <> doc OR first.col2 <> at div 4")).where("gone OR other")
        .join(copies.select(F.col("doc_id").alias("doc")), "doc", "left_anti")
        # first window * 64 + (windows - 1) * 2 + gone
        .select(F.col("doc").alias("doc_id"), F.expr("at div 4 * 2 + int(gone)").alias("at")), "runs",
    )
    marks = scratch.write(
        runs.where("at % 2 = 0").groupBy("doc_id").agg(F.collect_set("at").alias("marks"), F.count(F.lit(1)).alias("n")), "marks"
    )

    # Equal windows: all but the earliest go.
    suspects = only(texts, marks).select("doc_id", "text", "marks").mapInArrow(_windows, WINDOWS)
    earliest = F.min(F.struct("doc", F.expr("at div 2"))).over(Window.partitionBy("a", "b", "salt"))
    gone = (
        suspects.withColumn("first", earliest)
        .where("at % 2 = 1 OR first.doc <> doc OR first.col2 <> at div 2").select(F.col("doc").alias("doc_id"), F.expr("at div 2 * 64").alias("at"))
    )
    places = scratch.write(
        gone.unionByName(runs.where("at % 2 = 1")).groupBy("doc_id").agg(F.collect_set("at").alias("places"), F.count(F.lit(1)).alias("n")), "places"
    )
    scratch.drop("runs", "marks")
    stripped = only(texts, places).select("doc_id", "text", "places").mapInArrow(
        _strip, "doc_id long, n_removed long, sha string, kept string"
    ).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    copied, same = copies.distinct().withColumn("copied", F.lit(True)), ["doc_id", "sha"]
    return whole.join(copied, same, "left").join(stripped, same, "left").select(
        "doc_id", "n_words", F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copied"), F.lit(empty)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )
