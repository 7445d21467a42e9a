"""Benchmark decontamination by pigeonhole edit matching.

An item of m words may be quoted with up to k = floor(m * ERROR_RATE) word edits
(insertions, deletions, substitutions). Cut into k + 1 pieces, at least one piece
of every such quotation is untouched. So all documents are searched for exact
pieces, and around every hit the edit distance of the whole item is computed with
Myers' bit-parallel recurrence, one bit per item word.

Words are runs of letters, marks and digits of the case-folded text, so punctuation,
white space and case cost nothing, ASCII or not. In scripts that write words without
spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) every character is a word.

The items are a stated query set: they are searched in blocks of bounded size,
each over all documents, without a shuffle of texts.

Defined results: null and empty texts and items match nothing; items of fewer than
five words have a budget of 0 and match word for word, wherever these words stand;
equal items with different ids are reported each; repeated rows of a document are
reported once; a null doc_id or item_id is reported as null; of equally good places
the first is reported, and of the stretches that end there the longest; empty tables
give no rows; columns other than those used never matter. One text is held whole in a
task, at some 46 bytes of memory a byte; a block's items are cut on the driver,
ITEMS_AT_ONCE of them, and each block reads the documents once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starq.llm import words
from starq.llm.common import forget, plain_documents, prepare
from starq.llm.words import U64, Scan

ERROR_RATE = 0.2
#: Items whose pieces go to the tasks at once.
ITEMS_AT_ONCE = 50_000
FOUND = "doc_id long, item_id long, distance int, budget int, first_word long, item_words int"

# Bytes of a folded text that part words: ASCII that is no letter or digit.
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


# Code points of scripts that write words without spaces.
_SPACELESS = (
    (0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
    (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)


class _Folded(dict):
    """What a character becomes: itself, a word of its own, a space, or nothing (soft hyphens, joiners). Filled as met."""

    def __missing__(self, code: int) -> str:
        char, kind = chr(code), unicodedata.category(chr(code))
        if code < 128:
            out = char
        elif kind[0] in "LMN":
            out = f" {char} " if any(low <= code <= high for low, high in _SPACELESS) else char
        else:
            out = "" if kind == "Cf" and code != 0x200B else " "
        self[code] = out
        return out


_FOLDED = _Folded()


def fold(texts: list[str]) -> pa.Array:
    return pa.array([t if t.isascii() else t.translate(_FOLDED) for t in (t.casefold() for t in texts)], pa.large_string())


def scan_all(texts: list[str]) -> Iterator[Scan]:
    return words.scans(fold(texts), separator=_APART)


def cuts(m: int, k: int) -> list[tuple[int, int]]:
    """k + 1 pieces [begin, end) of nearly equal length."""
    ends = [m * (i + 1) // (k + 1) for i in range(k + 1)]
    return list(zip([0, *ends[:-1]], ends))


def _distances(item: np.ndarray, text: np.ndarray, anchored: bool) -> Iterator[int]:
    """Edit distance of the item to the stretch that ends at each word and begins where it fits best.

    Column by column of the distance matrix; bits tell where it steps up or down.
    Anchored: every stretch begins with the text, so skipped words in front cost too.
    """
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    places: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    up, down, distance = full, 0, m
    for word in text.tolist():
        equal = places.get(word, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        rises, falls = down | (full & ~(diagonal | up)), up & diagonal
        distance += bool(rises & top) - bool(falls & top)
        rises, falls = (rises << 1 | anchored) & full, falls << 1 & full
        up, down = falls | (full & ~(diagonal | rises)), rises & diagonal
        yield distance


def best_quotation(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the item to any stretch of the text, and the place after the first such stretch."""
    best, at = len(item), 0
    for j, distance in enumerate(_distances(item, text, anchored=False)):
        if distance < best:
            best, at = distance, j + 1
    return best, at


def length_of(item: np.ndarray, text: np.ndarray, best: int) -> int:
    """Length of the longest stretch that ends with the text and has this distance: the recurrence read backwards."""
    text = text[-(len(item) + best):]
    longest = 0
    for j, distance in enumerate(_distances(item[::-1], text[::-1], anchored=True)):
        if distance == best:
            longest = j + 1
    return longest


class Pieces:
    """All pieces of a block of items, by length, as sorted hashes with a bitmap before them."""

    BITS = 20

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids, self.items, self.budgets = [], [], []
        by_length: dict[int, list[tuple[int, int, int]]] = {}
        scans = scan_all([t for _, t in items])
        row = 0
        for scan in scans:
            hashes = scan.word_hashes()
            for d in range(scan.docs):
                item = hashes[scan.bounds[d] : scan.bounds[d + 1]]
                if len(item):
                    k = int(len(item) * ERROR_RATE)
                    for begin, end in cuts(len(item), k):
                        code = int(words.grams(item[begin:end], end - begin)[0])
                        by_length.setdefault(end - begin, []).append((code, len(self.items), begin))
                    self.ids.append(items[row][0])
                    self.items.append(item)
                    self.budgets.append(k)
                row += 1
        self.tables = []
        for length, found in sorted(by_length.items()):
            found.sort()
            codes = np.array([c for c, _, _ in found], U64)
            present = np.zeros(1 << self.BITS, bool)
            present[codes >> U64(64 - self.BITS)] = True
            self.tables.append((length, codes, np.array([i for _, i, _ in found]), np.array([b for _, _, b in found]), present))

    def hits(self, scan: Scan, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, item, and where the item would begin, of every exact piece."""
        docs, items, begins = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        doc_of = scan.doc_of
        for length, codes, item, offset, present in self.tables:
            grams = words.grams(hashes, length)
            at = np.flatnonzero(present[grams >> U64(64 - self.BITS)])
            low, high = np.searchsorted(codes, grams[at], "left"), np.searchsorted(codes, grams[at], "right")
            at, low, count = at[high > low], low[high > low], (high - low)[high > low]
            inside = doc_of[at] == doc_of[at + length - 1]
            at, low, count = at[inside], low[inside], count[inside]
            which = np.repeat(low, count) + words.ranges(count)
            place = np.repeat(at, count)
            docs.append(doc_of[place])
            items.append(item[which])
            begins.append(place - offset[which])
        return np.concatenate(docs), np.concatenate(items), np.concatenate(begins)

    def quotations(self, scan: Scan) -> Iterator[tuple[int, int, int, int]]:
        """Document, item, distance and first word of the best quotation within the budget."""
        hashes = scan.word_hashes()
        docs, items, begins = self.hits(scan, hashes)
        order = np.lexsort((begins, items, docs))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        reach: dict[tuple[int, int], int] = {}
        for i in order.tolist():
            pair = d, n = int(docs[i]), int(items[i])
            if pair in best and best[pair][0] == 0:
                continue
            k, m = self.budgets[n], len(self.items[n])
            low = max(int(begins[i]) - k, int(scan.bounds[d]), reach.get(pair, 0) - m - k)
            high = min(int(begins[i]) + m + k, int(scan.bounds[d + 1]))
            # Hits of one quotation lie in one window: look at new words only (and enough before them).
            if high <= reach.get(pair, -1):
                continue
            reach[pair] = high
            distance, end = best_quotation(self.items[n], hashes[low:high])
            if distance <= k and (pair not in best or distance < best[pair][0]):
                begin = low + end - length_of(self.items[n], hashes[low : low + end], distance)
                best[pair] = distance, begin - int(scan.bounds[d])
        for (d, n), (distance, first) in best.items():
            yield d, n, distance, first


def _search(pieces: Pieces):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("budget", pa.int32()),
        ("first_word", pa.int64()), ("item_words", pa.int32()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            rows, held, size, first = [], [], 0, 0
            for i, text in enumerate(texts):
                held.append(text.as_py())
                size += len(held[-1])
                if size < words.SLICE_BYTES and i + 1 < len(texts):
                    continue
                for scan in scan_all(held):
                    for d, n, distance, begin in pieces.quotations(scan):
                        rows.append((ids[first + scan.first + d], pieces.ids[n], distance, pieces.budgets[n], begin, len(pieces.items[n])))
                first, held, size = i + 1, [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def quotations(docs: DataFrame, items: DataFrame, at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """One row per document and item it quotes within the item's budget, with the best distance and its place."""
    spark = prepare(docs.sparkSession)
    texts = plain_documents(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    asked = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = max(1, -(-asked.count() // at_once))
    found = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        pieces = Pieces([(r["item_id"], r["text"]) for r in part.collect()])
        rows = texts.mapInArrow(_search(pieces), FOUND)
        found = rows if found is None else found.union(rows)
    best = F.min(F.struct("distance", "first_word", "budget", "item_words")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.distance", "best.budget", "best.first_word", "best.item_words"
    )
