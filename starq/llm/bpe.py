"""Byte-level BPE by prefix dynamic programming.

A piece of text is encoded by keeping, for each of its byte prefixes, the last
token of that prefix's encoding. That token is unique: of the tokens that end a
prefix, exactly one forms a valid pair with the last token of what it leaves. So
appending bytes never changes earlier entries, and an edit changes entries from
its place on only (`Prefixes`).

Texts are cut into pieces by a pattern; each piece is encoded on its own, and the
encodings of pieces seen lately are kept in the worker (bounded) until it serves
another operator.

Defined results: null and empty texts have no tokens (digests of the empty
string); equal texts and repeated rows have equal results; a piece that is itself
a token is that token; very long pieces take time linear in their length; an empty
table gives no rows; columns other than doc_id and text never matter.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from starq.llm.common import forget, plain_documents, remembered

#: Pieces, prefixes and token pairs remembered per worker; beyond it that memory starts anew.
REMEMBERED = 700_000
PREFIXES, PAIRS = 300_000, 300_000
#: Bytes up to which a piece and its prefixes are remembered.
SHORT = 64
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Ranks of byte strings, and which tokens may stand side by side."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {r: t for t, r in self.rank.items()}
        #: Every ending of a token: the token it is itself, or -1. Tells how far back a last token can reach.
        self.ending = {t[i:]: -1 for t in self.rank for i in range(1, len(t))} | self.rank
        self.pairs: dict[tuple[int, int], bool] = {}
        self.alone: dict[int, bool] = {}
        #: Bytes of the longest token.
        self.longest = max(map(len, self.rank))
        #: The last token of the encoding of each short prefix met so far, shared by all pieces.
        self.last: dict[bytes, int] = {}

    def _keeps(self, text: bytes, border: int) -> bool:
        """Whether merging by the definition ends in text[:border] and text[border:].

        The definition: join the adjacent parts of least rank, the leftmost first,
        until no two adjacent parts are a token. A border of 0 asks for one part.
        """
        rank, none = self.rank.get, 1 << 60
        parts = [text[i : i + 1] for i in range(len(text))]
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        left = border  # parts before the border
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            if left and i == left - 1:
                return False
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < left:
                left -= 1
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], none)
        return len(parts) == (2 if border else 1)

    def stands(self, token: int) -> bool:
        """Whether the token's bytes encode as that token."""
        if token not in self.alone:
            self.alone[token] = self._keeps(self.bytes_of[token], 0)
        return self.alone[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens' bytes encode as these two tokens."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            a, b = self.bytes_of[left], self.bytes_of[right]
            known = self.pairs[left, right] = self._keeps(a + b, len(a))
        return known

    def encode(self, text: bytes) -> list[int]:
        """Tokens of a short piece, from the longest prefix met before."""
        last, ending, pairs = self.last, self.ending.get, self.pairs.get
        known = len(text)
        while known and text[:known] not in last:
            known -= 1
        for end in range(known + 1, len(text) + 1):
            found, begin = [], end - 1
            token = ending(text[begin:end])
            while token is not None:
                if token >= 0:
                    found.append((begin, token))
                begin -= 1
                token = ending(text[begin:end]) if begin >= 0 else None
            for begin, token in reversed(found):
                if not begin:
                    if self.stands(token):
                        break
                else:
                    before = last[text[:begin]]
                    good = pairs((before, token))
                    if good or good is None and self.fits(before, token):
                        break
            else:
                raise ValueError("a byte has no token")
            last[text[:end]] = token
        out, end = [], len(text)
        while end:
            out.append(last[text[:end]])
            end -= len(self.bytes_of[out[-1]])
        return out[::-1]


class Prefixes:
    """The encodings of all byte prefixes of a growing, editable byte string."""

    def __init__(self, vocabulary: Vocabulary, text: bytes = b""):
        self.vocabulary, self.text = vocabulary, b""
        #: last[i]: the last token of the encoding of the first i bytes.
        self.last = [-1]
        self.append(text)

    def append(self, more: bytes) -> None:
        self.text += more
        self._reach(len(self.text))

    def _reach(self, place: int) -> None:
        """Fills the table up to a place in the text."""
        voc, last, text = self.vocabulary, self.last, self.text
        for end in range(len(last), place + 1):
            begin, token = end - 1, voc.ending.get(text[end - 1 : end])
            while token is not None:
                if token >= 0 and (voc.fits(last[begin], token) if begin else voc.stands(token)):
                    last.append(token)
                    break
                begin -= 1
                token = voc.ending.get(text[begin:end]) if begin >= 0 else None
            else:
                raise ValueError("a byte has no token")

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replaces bytes start to end; returns how many prefixes were encoded anew.

        Prefixes that end before the edit stay. Behind it, a prefix's last token follows
        from the bytes it covers and the token before it, so once as many places in a row
        as the longest token has bytes agree with the table from before the edit, moved,
        all later ones do: the rest of that table is reused.
        """
        old, shift = self.last[end + 1 :], len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        del self.last[start + 1 :]
        agreed = 0
        for place in range(start + 1, len(self.text) + 1):
            self._reach(place)
            was = place - shift - end - 1
            agreed = agreed + 1 if was >= 0 and old[was] == self.last[-1] else 0
            if agreed >= self.vocabulary.longest:
                self.last.extend(old[was + 1 :])
                return place - start
        return len(self.text) - start

    def tokens(self) -> list[int]:
        out, end = [], len(self.text)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.bytes_of[out[-1]])
        return out[::-1]


class Encoder:
    """Encodes texts piece by piece, and remembers a piece's ids as decimal text."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.pattern = Vocabulary(path), regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.token = {str(r).encode(): t for t, r in self.vocabulary.rank.items()}

    def piece(self, piece: str) -> list[int]:
        text = piece.encode()
        whole = self.vocabulary.rank.get(text)
        if whole is not None:
            return [whole]
        if len(text) > SHORT:
            return Prefixes(self.vocabulary, text).tokens()
        if len(self.vocabulary.last) >= PREFIXES:
            self.vocabulary.last.clear()
        return self.vocabulary.encode(text)

    def _learn(self, piece: str) -> bytes:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = " ".join(map(str, self.piece(piece))).encode()
        if len(piece) <= SHORT:
            self.known[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text in decimal, joined by one space."""
        known, learn = self.known.get, self._learn
        return b" ".join([known(p) or learn(p) for p in self.pattern.findall(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.split()))


def encoder(path: str, pattern: str) -> Encoder:
    """One per worker and vocabulary, until the worker serves another operator."""
    return remembered(("bpe", path, pattern), lambda: Encoder(path, pattern))


def _encode(path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path, pattern)
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for text in batch.column("text"):
                joined = tool.encode(text.as_py())
                rows[0].append(joined.count(b" ") + 1 if joined else 0)
                rows[1].append(hashlib.sha256(joined).hexdigest())
                rows[2].append(hashlib.sha256(tool.decode(joined)).hexdigest())
                if with_ids:
                    rows[3].append(np.array(joined.split(), "<u4").tobytes())
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(rows[3], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        bytes_of = Vocabulary(path).bytes_of
        for batch in batches:
            texts = [
                b"".join(map(bytes_of.__getitem__, np.frombuffer(ids.as_py(), "<u4").tolist())).decode("utf-8", "replace")
                for ids in batch.column("ids")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """n_tokens and digests of ids and of the decoded bytes; `ids` (little-endian 32-bit) on demand. No shuffle."""
    schema = SCHEMA + (", ids binary" if with_ids else "")
    return plain_documents(docs).mapInArrow(_encode(path, pattern, with_ids), schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of encode(..., with_ids=True)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, text string")
