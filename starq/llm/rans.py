"""Token ids in blocks of a range asymmetric numeral system (rANS).

One table of symbol frequencies, counted over all documents, serves every block.
A block holds whole documents in ascending doc_id; its ids are cut into segments,
each coded by LANES interleaved states. A segment's states (checkpoint), word
offset and checksum are stored, so segments decode on their own and in parallel.

Layout: `blocks` has one row per block, `header` one row with the frequencies.
Both are Parquet files, so the writer commits whole tasks and any store will do.

Defined results: null and empty texts hold the end id only; documents with equal
doc_id follow one another in order of text; null doc_ids come first; an empty
table makes no block; a damaged segment raises on reading; columns other than doc_id
and text never reach a file. One text is held whole in a task, at some 46 bytes of
memory a byte.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starq.llm import words
from starq.llm.common import Scratch, plain_documents

U64 = np.uint64
#: Frequencies sum to 2 ** BITS; states are at least LOW and give off 32-bit words.
BITS, LOW = 18, 1 << 31
LANES, STEPS = 64, 256
BLOCK_IDS = 1 << 20
END_ID = 1
SLICE_BYTES = 3 << 20
#: Words whose ids a worker remembers; beyond it the memory starts anew.
REMEMBERED = 1_200_000
CHUNK_KEYS = ("part", "block", "start", "n_ids", "doc_ids", "lengths")
CODED = ("segments", "steps", "states", "offsets", "checksums", "words")
_KEYS = "part int, block int, start long, n_ids long, doc_ids array<long>, lengths array<long>, "
CHUNK = _KEYS + "ids binary, counts binary"
BLOCK = _KEYS + "segments int, steps int, states binary, offsets binary, checksums binary, words binary"


# Frequencies -----------------------------------------------------------------


def quantise(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2 ** BITS, at least one for each symbol that occurs."""
    present = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if not len(present):
        return out
    if len(present) > 1 << BITS:
        raise ValueError("more symbols than table slots")
    room = (1 << BITS) - len(present)
    shares = counts[present].astype(np.float64) / counts[present].sum() * room
    out[present] = 1 + np.floor(shares).astype(np.int64)
    rest = (1 << BITS) - out.sum()
    out[present[np.argsort(-(shares % 1), kind="stable")[:rest]]] += 1
    return out


class Table:
    def __init__(self, frequencies: np.ndarray):
        self.frequency = frequencies.astype(U64)
        self.below = np.concatenate([[0], np.cumsum(frequencies)[:-1]]).astype(U64)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)
        self.commonest = int(np.argmax(frequencies))

    def encode(self, ids: np.ndarray) -> dict:
        """All segments of a block in step. The last one is filled up with the commonest symbol."""
        steps = min(STEPS, -(-len(ids) // LANES))
        segments = -(-len(ids) // (steps * LANES))
        grid = np.full(segments * steps * LANES, self.commonest, np.uint32)
        grid[: len(ids)] = ids
        grid = grid.reshape(segments, steps, LANES)
        state = np.full((segments, LANES), LOW, U64)
        given, owners = [], []
        for t in range(steps - 1, -1, -1):
            f, c = self.frequency[grid[:, t]], self.below[grid[:, t]]
            full = state >= f << U64(63 - BITS)
            given.append(state[full].astype(np.uint32))
            owners.append(np.nonzero(full)[0])
            state = np.where(full, state >> U64(32), state)
            quotient = state // f
            state = (quotient << U64(BITS)) + (state - quotient * f) + c
        owner = np.concatenate(owners[::-1])
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=segments))
        return {
            "segments": segments, "steps": steps, "states": state.tobytes(),
            "offsets": np.concatenate([[0], ends]).astype("<i8").tobytes(),
            "checksums": np.array([zlib.crc32(g.astype("<u4")) for g in grid], "<u4").tobytes(),
            "words": np.concatenate(given[::-1])[order].astype("<u4").tobytes(),
        }

    def decode(self, block: dict, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of segments first to last, each from its own checkpoint (with the filling)."""
        steps = block["steps"]
        states = np.frombuffer(block["states"], "<u8").reshape(block["segments"], LANES)[first:last].astype(U64)
        offsets = np.frombuffer(block["offsets"], "<i8")[first:][: len(states)].copy()
        checksums = np.frombuffer(block["checksums"], "<u4")[first:last]
        taken_from = np.frombuffer(block["words"], "<u4")
        grid = np.empty((len(states), steps, LANES), np.uint32)
        state = states
        for t in range(steps):
            slot = state & U64((1 << BITS) - 1)
            grid[:, t] = symbol = self.symbol[slot]
            state = self.frequency[symbol] * (state >> U64(BITS)) + slot - self.below[symbol]
            hungry = state < U64(LOW)
            taken = np.cumsum(hungry, axis=1)
            at = (offsets[:, None] + taken - 1)[hungry]
            state[hungry] = (state[hungry] << U64(32)) | taken_from[at].astype(U64)
            offsets += taken[:, -1]
        for i, part in enumerate(grid):
            if zlib.crc32(part.astype("<u4")) != checksums[i] or (state[i] != U64(LOW)).any():
                raise ValueError(f"segment {first + i} is damaged")
        return grid.reshape(-1)


# Token ids -------------------------------------------------------------------


def _visible_bytes() -> dict[int, str]:
    """How byte-level tokenizers write bytes: visible ones as they are, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


# Small Latin letters, then signs: the tokenizer cuts between the two and changes neither, so that
# its model takes the letters directly.
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")
_VISIBLE = _visible_bytes()


class WordTokenizer:
    """Ids of a tokenizer that never joins words: white space separates and has no ids itself.

    New words other than plain letters are encoded many at a time, with a control string
    between them. Words that spell a control string in small letters have its id there, as
    the library gives it; they go one by one, as do words that would spell one if lowered.
    """

    BETWEEN, AT_ONCE = "<|startoftext|>", 100
    #: Runs of joined words per call: the library's results are far larger than the ids.
    RUNS = 40

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.joint = Tokenizer.from_file(path)
        self.between, self.size = self.joint.token_to_id(self.BETWEEN), self.joint.get_vocab_size()
        self.known: dict[bytes, bytes] = {}
        controls = [t.content.encode() for t in self.joint.get_added_tokens_decoder().values() if t.special]
        self.control = re.compile(b"|".join(map(re.escape, controls)))

    def _one(self, word: bytes) -> bytes:
        return np.array(self.joint.encode(word.decode(), add_special_tokens=False).ids, "<u2").tobytes()

    def _encode(self, new: list[bytes]) -> None:
        plain = [w for w in new if b"<|" not in w]
        runs = [plain[i : i + self.AT_ONCE] for i in range(0, len(plain), self.AT_ONCE)]
        for at in range(0, len(runs), self.RUNS):
            some = runs[at : at + self.RUNS]
            found = self.joint.encode_batch_fast([self.BETWEEN.join(map(bytes.decode, r)) for r in some], add_special_tokens=False)
            for run, encoding in zip(some, found):
                ids = np.array(encoding.ids, "<u2")
                raw, cuts = ids.tobytes(), (2 * np.flatnonzero(ids == self.between)).tolist()
                for word, begin, end in zip(run, [0, *(c + 2 for c in cuts)], [*cuts, len(raw)]):
                    self.known[word] = raw[begin:end]
        self.joint.encode_special_tokens = True  # in capitals, what looks like a control string is text
        for word in new:
            if b"<|" in word:
                self.known[word] = self._one(word)
        self.joint.encode_special_tokens = False

    def learn(self, new: set[bytes]) -> None:
        known, model, pack = self.known, self.joint.model.tokenize, struct.pack
        if len(known) + len(new) > REMEMBERED:
            known.clear()
        plain, other = [], []
        for word in new:
            found = _PLAIN.fullmatch(word)
            if word.startswith(b" "):  # holds a control string, see ids()
                known[word] = self._one(word[1:])
            elif found:
                plain.append((word, *found.groups()))
            else:
                other.append(word)
        self._encode([*other, *{tail for _, _, tail in plain if tail and tail not in known}])
        for word, letters, tail in plain:
            ids = known.get(letters)
            if ids is None:
                found = [t.id for t in model(letters.decode("latin-1").translate(_VISIBLE))]
                ids = known[letters] = pack(f"<{len(found)}H", *found)
            if tail:
                known[word] = ids + known[tail]

    def ids(self, scan: words.Scan) -> tuple[np.ndarray, np.ndarray]:
        """16-bit ids of a scan's documents, the end id after each, and how many each has.

        Equal words of a slice are looked up once.
        """
        hashes, exact = scan.word_hashes(lower=True), scan.data.tobytes()
        # Words with a control string keep their capitals; a space, which no word has, marks their keys.
        marked = np.unique(np.searchsorted(scan.starts, [m.start() for m in self.control.finditer(exact)], "right") - 1)
        if len(marked):
            hashes[marked] = words.mix(scan.span_hashes(scan.starts[marked], scan.ends[marked]) + U64(1))
        marked = set(marked.tolist())
        order = np.argsort(hashes)
        new = np.ones(len(order), bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        first = order[new]
        raw = exact.lower()
        distinct = [raw[s:e] for s, e in zip(scan.starts[first].tolist(), scan.ends[first].tolist())]
        if marked:
            for i, word in enumerate(first.tolist()):
                if word in marked:
                    distinct[i] = b" " + exact[scan.starts[word] : scan.ends[word]]
        found = list(map(self.known.get, distinct))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            self.learn({distinct[i] for i in missing})
            for i in missing:
                found[i] = self.known[distinct[i]]
        flat = np.frombuffer(b"".join(found), "<u2")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 2
        begin = (np.cumsum(size) - size)[which]
        size = size[which]
        ids = flat[np.repeat(begin, size) + words.ranges(size)]
        total = np.concatenate([[0], np.cumsum(size)])
        ends = total[scan.bounds[1:]]
        return np.insert(ids, ends, END_ID), np.diff(ends, prepend=0) + 1


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
        if _tokenizers[path].size > 1 << 16:
            raise ValueError("ids need more than 16 bits")
    return _tokenizers[path]


def _tokenise(path: str):
    """Chunks of whole documents, in the order of the sorted part, each with its count of every id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = tokenizer(path), TaskContext.get().partitionId()
        schema = pa.schema([
            ("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary()), ("counts", pa.binary()),
        ])
        block, start, docs, lengths, held, size = 0, 0, [], [], [], 0

        def closed():
            ids = np.concatenate(held)
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "start": start, "n_ids": size, "doc_ids": docs, "lengths": np.concatenate(lengths).tolist(),
                "ids": ids.tobytes(), "counts": np.bincount(ids, minlength=1 << 16).astype("<u4").tobytes(),
            }], schema)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for scan in words.scans(batch.column("text"), SLICE_BYTES):
                found, each = tool.ids(scan)
                docs += ids[scan.first : scan.first + scan.docs]
                lengths.append(each)
                held.append(found)
                size += len(found)
                if size >= BLOCK_IDS:
                    yield closed()
                    block, start, docs, lengths, held, size = block + 1, start + size, [], [], [], 0
        if docs:
            yield closed()

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for found in batch.column("counts"):
            counts += np.frombuffer(found.as_buffer(), "<u4")
    present = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), pa.array(counts[present])], ["id", "n"])


def _encode(frequencies: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(frequencies)
        for batch in batches:
            for i in range(batch.num_rows):
                coded = table.encode(np.frombuffer(batch.column("ids")[i].as_buffer(), "<u2"))
                columns = [batch.column(c).slice(i, 1) for c in CHUNK_KEYS]
                columns += [pa.array([coded[c]], pa.int32()) for c in ("segments", "steps")]
                columns += [pa.array([coded[c]], pa.binary()) for c in ("states", "offsets", "checksums", "words")]
                yield pa.RecordBatch.from_arrays(columns, [*CHUNK_KEYS, *CODED])

    return run


def write(docs: DataFrame, tokenizer_path: str, path: str) -> None:
    """Encodes all documents below path, in ascending doc_id over parts, blocks and rows of a block."""
    scratch = Scratch(docs.sparkSession, "rans")
    texts = plain_documents(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    chunks = scratch.write(ordered.mapInArrow(_tokenise(tokenizer_path), CHUNK), "ids")
    # At most one row per symbol reaches the driver.
    counted = chunks.select("counts").mapInArrow(_count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << 16, np.int64)
    for row in counted:
        counts[row["id"]] = row["n"]
    frequencies = quantise(counts)
    header = scratch.spark.createDataFrame(
        [(BITS, LANES, frequencies.astype("<i4").tobytes())], "bits int, lanes int, frequencies binary"
    )
    header.coalesce(1).write.parquet(f"{path}/header")
    chunks.drop("counts").mapInArrow(_encode(frequencies), BLOCK).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    scratch.drop("ids")


def _decode(frequencies: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(frequencies)
        for batch in batches:
            fields = {c: batch.column(c) for c in (*CHUNK_KEYS, *CODED, "before")}
            for i in range(batch.num_rows):
                block = {c: fields[c][i].as_py() for c in ("segments", "steps")}
                block |= {c: fields[c][i].as_buffer() for c in ("states", "offsets", "checksums", "words")}
                ids = table.decode(block)[: fields["n_ids"][i].as_py()].astype("<u4", copy=False)
                lengths = np.asarray(fields["lengths"][i].values, np.int64)
                ends = np.cumsum(lengths)
                first = fields["before"][i].as_py() + fields["start"][i].as_py()
                crcs = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = fields["doc_ids"][i].values, first + ends - lengths, lengths, np.array(crcs, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return run


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    header = spark.read.parquet(f"{path}/header").first()
    frequencies = np.frombuffer(header["frequencies"], "<i4").astype(np.int64)
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    # One row per part: the window's size is the number of write tasks.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    return blocks.join(parts, "part").mapInArrow(
        _decode(frequencies), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
