"""Counts per document from one scan of its whole text: the inputs of the quality rules and models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starq.llm import words
from starq.llm.common import forget
from starq.llm.words import U64, Scan, mix

COUNTS = (
    "n_bytes", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_adjacent_words",
    "n_distinct_words", "n_upper", "n_letters", "n_digits", "n_shouts", "n_bars",
)
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_SYMBOL = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_LETTER = _table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_DIGIT = _table(b"0123456789")


def _owned(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one document."""
    return mix(hashes + mix(doc.astype(U64) + U64(1)))


def _repeat_words(scan: Scan, hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words that lie in a 3-word window found twice or more in the document."""
    at = words.inside(scan.bounds, 3)
    again = at[words.repeated(_owned(words.grams(hashes, 3)[at], doc[at]))] if len(at) else at
    flags = np.zeros(len(hashes) + 3, bool)
    for shift in range(3):
        flags[again + shift] = True
    return np.bincount(doc, flags[: len(hashes)], scan.docs)


def _lines(scan: Scan) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word per document, and those equal to an earlier one."""
    feeds = np.flatnonzero(scan.data == 10)
    starts = np.union1d(feeds + 1, scan.offsets[:-1])
    ends = np.append(starts[1:], len(scan.data))
    owner = np.searchsorted(scan.offsets, starts, "right") - 1
    first = np.searchsorted(scan.starts, starts)
    filled = np.searchsorted(scan.starts, ends) > first
    starts, ends, owner = starts[filled], ends[filled], owner[filled]
    # A line that a line feed closes ends before it.
    ends = ends - (scan.data[ends - 1] == 10)
    keys = _owned(scan.span_hashes(starts, ends), owner)
    order = np.argsort(keys)
    later = np.zeros(len(keys), bool)
    later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return np.bincount(owner, minlength=scan.docs), np.bincount(owner, later, scan.docs)


def count(scan: Scan) -> dict[str, np.ndarray]:
    data, doc = scan.data, scan.doc_of
    hashes = scan.word_hashes()
    n_lines, n_dup = _lines(scan)
    owned = _owned(hashes, doc)
    fresh = np.ones(len(hashes), bool)
    order = np.argsort(owned)
    fresh[order[1:]] = owned[order[1:]] != owned[order[:-1]]
    adjacent = np.zeros(len(hashes), bool)
    adjacent[1:] = owned[1:] == owned[:-1]
    return {
        "n_bytes": np.diff(scan.offsets), "n_words": scan.n_words,
        "word_chars": scan.per_doc(scan.word_byte & ((data & 0xC0) != 0x80)), "n_symbols": scan.per_doc(_SYMBOL[data]),
        "n_lines": n_lines, "n_dup_lines": n_dup, "n_repeat_words": _repeat_words(scan, hashes, doc),
        "n_adjacent_words": np.bincount(doc, adjacent, scan.docs), "n_distinct_words": np.bincount(doc, fresh, scan.docs),
        "n_upper": scan.per_doc(_UPPER[data]), "n_letters": scan.per_doc(_LETTER[data]),
        "n_digits": scan.per_doc(_DIGIT[data]), "n_shouts": scan.per_doc(data == 33), "n_bars": scan.per_doc(data == 124),
    }


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        ids = batch.column("doc_id")
        for scan in words.scans(batch.column("text")):
            found = count(scan)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(scan.first, scan.docs).cast(pa.int64()), *(pa.array(found[c].astype(np.int64)) for c in COUNTS)],
                ["doc_id", *COUNTS],
            )


def document_counts(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every row of docs(doc_id, text). Null or empty text: zeros. One scan, no shuffle."""
    return docs.mapInArrow(_count_batches, SCHEMA)


def ratios(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Model inputs, one row per document, all in [0, 1] but the two logarithms and word length."""
    c = {k: np.asarray(counts[k], np.float64) for k in COUNTS}
    word, byte, line, letter = (np.maximum(c[k], 1) for k in ("n_words", "n_bytes", "n_lines", "n_letters"))
    root = lambda x: np.sqrt(np.clip(x, 0, 1))
    return np.column_stack([
        np.log1p(c["n_words"]) / 10, np.minimum(c["word_chars"] / word, 50) / 50,
        root(c["n_symbols"] / word), root(c["n_dup_lines"] / line), root(c["n_repeat_words"] / word),
        root(c["n_adjacent_words"] / word), root(c["n_distinct_words"] / word), root(c["n_upper"] / letter),
        root(c["n_digits"] / byte), root(c["n_shouts"] / word), root(c["n_bars"] / word),
        root(c["n_letters"] / byte),
    ])


RATIOS = (
    "log_words", "word_length", "symbols", "dup_lines", "repeat_words", "adjacent", "distinct", "upper", "digits", "shouts",
    "bars", "letters",
)
