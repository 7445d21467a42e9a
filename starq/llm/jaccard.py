"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct 5-word shingles. In one global order of shingles,
rarest first, two sets of n and m members that overlap enough share at least l
members among the first n - ceil(t n) + l and m - ceil(t m) + l. Every document
picks its own l: longer prefixes cost more postings, and ask for more shared
members before a pair is looked at. A pair is a candidate from min(l) on; its
whole texts decide.

Rarity comes from two fixed-size sketches over all documents: how often a shingle
occurs beyond the mean load of its counter, and how often its words would meet by
chance. Documents with equal sets are one class with one representative. Where a
posting list is long because its documents resemble each other, they are first
linked to a leader (one pair per document, not all pairs); only pairs across the
components found so far are listed after that, so no link between components is
lost.

Defined results: null and blank texts have an empty set, no links, and their own
doc_id as component; a null doc_id has no component; rows with the same doc_id
belong together; equal sets link; an empty table gives no rows; columns other
than doc_id and text never matter. One text is held whole in a task, at some 46 bytes
of memory a byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starq.llm import words
from starq.llm.common import Scratch, forget, only, plain_documents
from starq.llm.components import components
from starq.llm.words import U64, Scan, mix

SHINGLE, PERCENT = 5, 75
#: Counters for shingles and for words, in blocks of 2 ** BLOCK_BITS that are summed apart.
#: They bound what is broadcast (6 MB).
SKETCH_BITS, WORD_BITS, BLOCK_BITS = 22, 20, 16
LONGEST_MATCH = 8
#: Other documents that a shingle is taken to meet at least: passages below the sketch's noise.
CHANCE = 0.05
#: A token is a level of rarity (64 of them; UNIT stands for one expected meeting) and a hash.
TOKEN_BITS, UNIT = 44, 32
#: Tables of numbers have a file for so many documents, and FILES_PER_CORE for each core at least.
DOCS_PER_FILE, FILES_PER_CORE = 10_000, 4
#: A list expected to be longer is dealt over salts of about that many rows.
HOT_LIST = 20_000
#: Longer lists may get leaders first, as long as their pairs are more than so many per posting.
LONG_LIST, PAIRS_PER_POSTING, LEADER_ROUNDS = 32, 2, 6


def shingles(scan: Scan, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes, the document of each (in order), and the words [begin, end) it stands at."""
    hashes = scan.word_hashes(lower=True)
    at = words.inside(scan.bounds, n)
    found, doc, end = words.grams(hashes, n)[at] if len(at) else np.zeros(0, U64), scan.doc_of[at], at + n
    short = np.flatnonzero((scan.n_words > 0) & (scan.n_words < n))
    if len(short):
        whole = [words.grams(hashes[scan.bounds[d] : scan.bounds[d + 1]], int(scan.n_words[d]))[0] for d in short]
        found, doc = np.concatenate([found, np.array(whole, U64)]), np.concatenate([doc, short])
        at, end = np.concatenate([at, scan.bounds[short]]), np.concatenate([end, scan.bounds[short + 1]])
    owned = mix(found + mix(doc.astype(U64) + U64(1)))
    order = np.argsort(owned)
    fresh = np.ones(len(owned), bool)
    fresh[1:] = owned[order[1:]] != owned[order[:-1]]
    keep = order[fresh]
    keep = keep[np.argsort(doc[keep], kind="stable")]
    return found[keep], doc[keep], at[keep], end[keep]


def _sums(values: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    total = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    bounds = np.searchsorted(doc, np.arange(docs + 1))
    return total[bounds[1:]] - total[bounds[:-1]]


SETS = "doc_id long, n long, sum_a long, sum_b long, block int, counts binary"


def _packed(counts: np.ndarray, first_block: int) -> Iterator[tuple[int, bytes]]:
    """Blocks of a sketch that are not empty: places and counts."""
    for i, part in enumerate(np.split(counts, len(counts) >> BLOCK_BITS)):
        at = np.flatnonzero(part)
        if len(at):
            yield first_block + i, zlib.compress(at.astype("<u2").tobytes() + part[at].astype("<u4").tobytes(), 1)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(packed)
    n = len(raw) // 6
    return np.frombuffer(raw, "<u2", n), np.frombuffer(raw, "<u4", n, 2 * n)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and fingerprint of every set; then this task's part of the sketches, in blocks."""
    forget()
    met, used = np.zeros(1 << SKETCH_BITS, np.uint32), np.zeros(1 << WORD_BITS, np.uint32)
    names = ["doc_id", "n", "sum_a", "sum_b", "block", "counts"]
    for batch in batches:
        ids = batch.column("doc_id")
        for scan in words.scans(batch.column("text")):
            found, doc, _, _ = shingles(scan)
            np.add.at(met, found >> U64(64 - SKETCH_BITS), np.uint32(1))
            np.add.at(used, scan.word_hashes(lower=True) >> U64(64 - WORD_BITS), np.uint32(1))
            sums = [_sums(mix(found ^ U64(seed)), doc, scan.docs).view(np.int64) for seed in (0x51A7, 0xC0FFEE)]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(scan.first, scan.docs), pa.array(np.bincount(doc, minlength=scan.docs).astype(np.int64)), *map(pa.array, sums),
                    pa.nulls(scan.docs, pa.int32()), pa.nulls(scan.docs, pa.binary()),
                ], names,
            )
    parts = [*_packed(met, 0), *_packed(used, 1 << SKETCH_BITS - BLOCK_BITS)]
    none = pa.nulls(len(parts), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [none, none, none, none, pa.array([b for b, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())], names
    )


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            at, counts = _unpacked(packed)
            total.setdefault(block, np.zeros(1 << BLOCK_BITS, np.int64))[at] += counts
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary()),
            pa.array([int(t.sum()) for t in total.values()], pa.int64()),
        ], ["block", "counts", "total"],
    )


SHINGLE_BLOCKS, WORD_BLOCKS = 1 << SKETCH_BITS - BLOCK_BITS, 1 << WORD_BITS - BLOCK_BITS


def met_levels(counts: np.ndarray, load: float) -> np.ndarray:
    """Levels of counters that hold more than chance puts into one; 0 for the others."""
    excess = np.maximum(counts - load - 3 * np.sqrt(load) - 1, 0)
    return np.where(excess >= 1, np.minimum(UNIT + np.rint(np.log2(np.maximum(excess, 1))), 63), 0).astype(np.uint8)


def word_chances(counts: np.ndarray, total: int) -> np.ndarray:
    """How likely a word is, in sixteenths of a bit."""
    return np.rint(16 * np.log2(np.maximum(counts, 1) / max(total, 1))).astype(np.int16)


class Rarity:
    """Levels of shingles. Whole numbers throughout, so that every task puts a shingle on the same level."""

    def __init__(self, met: np.ndarray, chance: np.ndarray, n_words: int):
        self.met, self.chance = met, chance
        self.places = int(round(16 * np.log2(max(n_words, 1))))

    def levels(self, hashes: np.ndarray, found: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(self.chance[hashes >> U64(64 - WORD_BITS)], dtype=np.int64)])
        expected = np.clip(UNIT + ((total[end] - total[begin] + self.places) >> 4), 0, 63)
        return np.maximum(expected, self.met[found >> U64(64 - SKETCH_BITS)]).astype(U64)


def _ranked(load: float, n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            out = []
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                counts = np.frombuffer(packed, np.int64)
                out.append((met_levels(counts, load) if block < SHINGLE_BLOCKS else word_chances(counts, n_words)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], ["block", "ranks"])

    return run


def rarity(blocks: DataFrame, scratch: Scratch) -> Rarity:
    """From blocks(block, counts). What reaches the driver has the sketches' fixed size (6 MB)."""
    summed = blocks.repartition(SHINGLE_BLOCKS + WORD_BLOCKS, "block").mapInArrow(_add_blocks, "block int, counts binary, total long")
    summed = scratch.write(summed, "sketches")
    of_shingles = F.col("block") < SHINGLE_BLOCKS
    met, used = summed.agg(F.sum(F.when(of_shingles, F.col("total"))), F.sum(F.when(~of_shingles, F.col("total")))).first()
    ranks = summed.select("block", "counts").mapInArrow(_ranked((met or 0) / (1 << SKETCH_BITS), used or 0), "block int, ranks binary")
    levels, chances = np.zeros((SHINGLE_BLOCKS, 1 << BLOCK_BITS), np.uint8), np.zeros((WORD_BLOCKS, 1 << BLOCK_BITS), np.int16)
    for row in ranks.collect():
        if row["block"] < SHINGLE_BLOCKS:
            levels[row["block"]] = np.frombuffer(row["ranks"], np.uint8)
        else:
            chances[row["block"] - SHINGLE_BLOCKS] = np.frombuffer(row["ranks"], np.int16)
    scratch.drop("sketches")
    return Rarity(levels.ravel(), chances.ravel(), used or 0)


def prefixes(tokens: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix members, and n and l per document. tokens: rarity and hash, sorted by (doc, token)."""
    bounds = np.searchsorted(doc, np.arange(docs + 1))
    n = np.diff(bounds)
    needed = -(-PERCENT * n // 100)
    others = np.maximum(np.exp2((tokens >> U64(TOKEN_BITS)).astype(np.float64) - UNIT), CHANCE)
    total = np.concatenate([[0.0], np.cumsum(others)])
    best, match = np.full(docs, np.inf), np.zeros(docs, np.int64)
    for l in range(1, LONGEST_MATCH + 1):
        length = n - needed + l
        listed = total[np.minimum(bounds[:-1] + length, bounds[1:])] - total[bounds[:-1]]
        # A candidate costs its whole text.
        cost = np.where((l <= needed) & (n > 0), listed + length + n * listed / l, np.inf)
        match = np.where(cost < best, l, match)
        best = np.minimum(best, cost)
    length = np.where(n > 0, n - needed + match, 0)
    return np.repeat(bounds[:-1], length) + words.ranges(length), n, match


def _postings(rarity: Rarity):
    """token, salt, doc, meta (n * 16 + l) of every prefix member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hot = UNIT + int(np.ceil(np.log2(HOT_LIST)))
        for batch in batches:
            ids = np.asarray(batch.column("doc_id"), np.int64)
            for scan in words.scans(batch.column("text")):
                own = ids[scan.first : scan.first + scan.docs]
                found, doc, begin, end = shingles(scan)
                rare = rarity.levels(scan.word_hashes(lower=True), found, begin, end)
                keys = np.sort(doc.astype(U64) << U64(TOKEN_BITS + 6) | rare << U64(TOKEN_BITS) | found & U64((1 << TOKEN_BITS) - 1))
                doc = (keys >> U64(TOKEN_BITS + 6)).astype(np.int64)
                tokens = keys & U64((1 << TOKEN_BITS + 6) - 1)
                at, n, match = prefixes(tokens, doc, scan.docs)
                token, doc = tokens[at].astype(np.int64), doc[at]
                spread = np.exp2(np.maximum((token >> TOKEN_BITS) - hot, 0)).astype(np.int64)
                salt = np.where(token >> TOKEN_BITS > hot, 1 + (mix(own[doc].astype(U64)) % spread.astype(U64)).astype(np.int64), 0)
                columns = token, salt.astype(np.int32), own[doc], (n * 16 + match)[doc]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["token", "salt", "doc", "meta"])

    return run


VERIFY_BYTES = 2 << 20


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of pairs whose texts have about VERIFY_BYTES together."""
    size = sum(np.diff(words.text_buffers(batch.column(side))[1]) for side in ("text_a", "text_b"))
    portion = np.cumsum(size) // VERIFY_BYTES
    for begin, end in zip(first := np.flatnonzero(np.diff(portion, prepend=-1)), np.append(first[1:], len(portion))):
        yield batch.slice(begin, end - begin)


def _alike(batch: pa.RecordBatch) -> pa.Array:
    """Whether the whole texts of each pair are similar enough."""
    keys, owners, sizes = {}, [], {}
    for side in ("text_a", "text_b"):
        found_keys, sizes[side] = [np.zeros(0, U64)], np.zeros(batch.num_rows, np.int64)
        for scan in words.scans(batch.column(side)):
            found, doc, _, _ = shingles(scan)
            doc = doc + scan.first
            found_keys.append(mix(found + mix(doc.astype(U64) + U64(1))))
            sizes[side] += np.bincount(doc, minlength=batch.num_rows)
            if side == "text_a":
                owners.append(doc)
        keys[side] = np.concatenate(found_keys)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    both = np.bincount(owner, np.isin(keys["text_a"], keys["text_b"], assume_unique=True), batch.num_rows).astype(np.int64)
    return pa.array((100 * both >= PERCENT * (sizes["text_a"] + sizes["text_b"] - both)) & (both > 0))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        for part in _portions(batch):
            mask = _alike(part)
            yield pa.RecordBatch.from_arrays([part.column("a").filter(mask), part.column("b").filter(mask)], ["u", "v"])


def _long_enough(a: str, b: str) -> F.Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


class _Join:
    """Links between representatives, from postings(token, doc, n, l)."""

    def __init__(self, scratch: Scratch, texts: DataFrame, postings: DataFrame, files: int):
        self.scratch, self.texts, self.postings, self.files = scratch, texts, postings, files

    def verified(self, pairs: DataFrame, turn: int) -> tuple[DataFrame, int]:
        """Links u, v among pairs a, b, and how many pairs were looked at. Only texts of candidates are shuffled."""
        pairs = self.scratch.write(pairs.select("a", "b"), f"pairs-{turn}", self.files)
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
        near = only(self.texts, self.scratch.write(wanted, f"wanted-{turn}", self.files)).select("doc_id", "text")
        near = self.scratch.write(near, f"near-{turn}")
        a, b = (near.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")) for side in "ab")
        links = self.scratch.write(pairs.join(a, "a").join(b, "b").mapInArrow(_verify, "u long, v long"), f"links-{turn}")
        self.scratch.drop(f"near-{turn}", f"wanted-{turn}")
        return links, pairs.count()

    def run(self) -> DataFrame:
        """doc, comp of the representatives that are linked to a smaller one."""
        lists = self.postings.groupBy("token").agg(F.count(F.lit(1)).alias("total"), F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.min("l").alias("l_low"))
        # Only lists of several representatives: a document with copies has postings that nobody else shares.
        lists = self.scratch.write(lists.where("total > 1"), "lists", self.files)
        long = self.scratch.write(self.postings.join(lists.where(F.col("total") > LONG_LIST), "token"), "long", self.files)
        # In how many long lists a document is: it cannot share more of them with anyone.
        counts = self.scratch.write(long.groupBy("doc").agg(F.count(F.lit(1)).alias("k")), "counts", self.files)
        long = self.scratch.write(long.join(counts, "doc"), "entries")
        total, comp, turn, helps = self.postings.count(), None, 0, True
        while True:
            rest, entries, cost = self.across(long, comp, turn)
            if cost <= PAIRS_PER_POSTING * total or turn == LEADER_ROUNDS or not helps:
                break
            # What follows a leader shares more than one long list with it.
            led = rest.where(_long_enough("n", "leader_n"))
            pairs = led.groupBy(F.col("doc").alias("a"), F.col("leader").alias("b")).agg(F.count(F.lit(1)).alias("k")).where("k > 1")
            found, asked = self.verified(pairs, turn)
            helps = found.count() * 20 >= asked
            comp = self.grown(comp, found, f"comp-{turn}")
            turn += 1
        short = self.postings.join(lists.where(F.col("total") <= LONG_LIST).select("token"), "token")
        short = short.join(counts, "doc", "left").withColumn("k", F.coalesce("k", F.lit(0)))
        pairs = self.met_in_short_lists(short).union(self.met_across(rest, entries)).distinct()
        found, _ = self.verified(pairs, turn)
        return self.grown(comp, found, "comp-last")

    def grown(self, comp: DataFrame | None, found: DataFrame, name: str) -> DataFrame:
        return components(found if comp is None else found.union(comp.select("doc", "comp")), self.scratch, name, self.files)

    def across(self, long: DataFrame, comp: DataFrame | None, turn: int) -> tuple[DataFrame, DataFrame, int]:
        """Members of long lists outside their list's largest component, all members, and the pairs between them.

        Members that cannot share enough lists with any size that the list holds are left out.
        """
        if comp is None:
            entries = long.withColumn("comp", F.col("doc"))
        else:
            entries = long.join(comp, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
        entries = self.scratch.write(entries, f"members-{turn}")
        # Per list: its largest component, and a leader from it that changes by round.
        order = F.xxhash64(F.lit(turn), "doc") if turn else F.col("doc")
        lead = F.min(F.struct(order.alias("o"), "doc", "n")).alias("lead")
        sizes = entries.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("members"), lead)
        main = F.max(F.struct("members", (-F.col("comp")).alias("comp"), "lead")).alias("main")
        mains = sizes.groupBy("token").agg(main, F.count(F.lit(1)).alias("comps")).where("comps > 1").select(
            "token", (-F.col("main.comp")).alias("main"), F.col("main.lead.doc").alias("leader"), F.col("main.lead.n").alias("leader_n"),
        )
        rest = entries.join(self.scratch.write(mains, f"mains-{turn}", self.files), "token").where("comp <> main")
        ends = [F.greatest("n_low", F.floor(F.col("n") * PERCENT / 100)), F.least("n_high", F.ceil(F.col("n") * 100 / PERCENT))]
        fewest = F.least(*[_least_shared(F.col("n"), F.col("l"), end, F.col("l_low")) for end in ends])
        # Between the ends, rounding up can lower it by two at most.
        rest = self.scratch.write(rest.where(F.col("k") >= fewest - 2), f"rest-{turn}")
        return rest, entries, rest.agg(F.sum("total")).first()[0] or 0

    def met_in_short_lists(self, short: DataFrame) -> DataFrame:
        """Pairs that meet in a short list, and often enough if they met in all long ones besides."""
        x, y = (short.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("doc", "n", "l", "k")]) for side in "xy")
        met = x.join(y, "token").where((F.col("doc_x") < F.col("doc_y")) & _long_enough("n_x", "n_y"))
        return _often(met, _least_of_pair() - F.least("k_x", "k_y"))

    def met_across(self, rest: DataFrame, entries: DataFrame) -> DataFrame:
        """Pairs across components that meet often enough in long lists alone."""
        x = rest.select("token", "main", *[F.col(c).alias(f"{c}_x") for c in ("doc", "comp", "n", "l", "k")])
        y = entries.select("token", *[F.col(c).alias(f"{c}_y") for c in ("doc", "comp", "n", "l", "k")])
        once = (F.col("comp_y") == F.col("main")) | (F.col("doc_x") < F.col("doc_y"))
        enough = F.least("k_x", "k_y") >= _least_of_pair()
        met = x.join(y, "token").where((F.col("comp_x") != F.col("comp_y")) & once & _long_enough("n_x", "n_y") & enough)
        return _often(met, _least_of_pair())


def _often(met: DataFrame, least: F.Column) -> DataFrame:
    """a, b of the pairs that have at least so many rows."""
    pairs = met.select(F.least("doc_x", "doc_y").alias("a"), F.greatest("doc_x", "doc_y").alias("b"), least.alias("least"))
    return pairs.groupBy("a", "b", "least").agg(F.count(F.lit(1)).alias("shared")).where("shared >= least").select("a", "b")


def _least_of_pair() -> F.Column:
    return _least_shared(*map(F.col, ("n_x", "l_x", "n_y", "l_y")))


def _least_shared(n: F.Column, l: F.Column, m: F.Column, k: F.Column) -> F.Column:
    """Prefix members that similar documents of n and m members (prefixes of l and k) share at least.

    Beyond the prefix that ends first, in the global order, the pair can only share
    what is left of that document: its needed members less l. Both together have to
    reach the intersection that the sizes ask for, PERCENT / (100 + PERCENT) of their sum.
    The number is least where the sizes differ most, and grows with both prefixes.
    """
    left = [-F.floor(-PERCENT * size / 100) - match for size, match in ((n, l), (m, k))]
    both = -F.floor(-PERCENT * (n + m) / (100 + PERCENT))
    return F.greatest(F.least(l, k), both - F.greatest(*left))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    texts = plain_documents(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    scanned = scratch.write(texts.mapInArrow(_sets, SETS), "sets")
    sets = scanned.where("block IS NULL").select("doc_id", "n", "sum_a", "sum_b")
    files = max(FILES_PER_CORE * docs.sparkSession.sparkContext.defaultParallelism, sets.count() // DOCS_PER_FILE)
    same = ["n", "sum_a", "sum_b"]
    classes = scratch.write(
        sets.where("n > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes", files
    )
    ranks = rarity(scanned.where("block IS NOT NULL").select("block", "counts"), scratch)

    one_list = Window.partitionBy("token", "salt")
    rows = texts.where("doc_id IS NOT NULL").mapInArrow(_postings(ranks), "token long, salt int, doc long, meta long")
    repeated = rows.withColumn("k", F.count(F.lit(1)).over(one_list)).where("salt > 0 OR k > 1")
    postings = scratch.write(
        repeated.join(classes.select(F.col("rep").alias("doc")), "doc", "left_semi")
        .select("token", "doc", F.expr("meta div 16").alias("n"), F.expr("meta % 16").alias("l")), "postings", files,
    )
    comp = _Join(scratch, texts, postings, files).run()
    scratch.keep("sets", "classes", list(scratch.paths)[-1])

    grouped = classes.join(comp, classes["rep"] == comp["doc"], "left").select(*same, F.coalesce("comp", "rep").alias("component"))
    matched = sets.join(grouped, same, "left")
    return matched.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
