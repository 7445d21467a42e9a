"""Conversation prefix trie: every shared beginning of conversations as one node.

A conversation is a sequence of turns (role, text), each named by 128 bits of its
SHA-256. The distinct sequences are sorted; neighbours in that order are linked by
an edge as deep as the turns they share. A task takes a range of the order and
works through its edges from the deepest to the shallowest with a union-find:
whatever a component merges with at some depth becomes a node there, and the turns
that it has alone become the chain above. Nodes that hold the first or last sequence
of the range may go on in the next range: they stay open. All the rest is closed, and
the range is contracted to its first and last sequence, which carry what closed below
their open nodes. Contracted ranges are sorted and merged in the same way, until one
range is left: 20,000 ranges at most meet in a task, and each adds two rows to the
next round.

Copies of a sequence are one item with a count, so a group of copies is no hot task;
its ids are joined in pieces over ranges and only the pieces are hashed in order.

Defined results: null roles and texts are empty; turns are ordered by turn (null
first), then role, then the turn's name; equal rows are separate turns; rows without
a conv_id belong to no conversation; a conversation without turns ends at the root;
no conversations give no nodes, not even a root; other columns never matter. A
conversation's names and lengths (28 bytes a turn, whatever its texts) are one row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starq.llm.common import Scratch

#: Turns and sequences that a task of the first round takes, and contracted sequences of a later one.
TURNS, SEQUENCES, CONTRACTED = 200_000, 50_000, 20_000
_NONE = 1 << 63

_OWN = "struct<depth:int,n:bigint,conv:bigint,kids:bigint,leaves:bigint,saved:bigint,ends:string>"
_NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)
_OUT = f"{_NODE}, ref binary, parent_ref binary, item struct<names:array<binary>,chars:array<int>,own:array<{_OWN}>>"
_ARROW_OUT = pa.schema([
    *[(n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends_sha256", pa.string()), ("ref", pa.binary()), ("parent_ref", pa.binary()),
    ("item", pa.struct([
        ("names", pa.list_(pa.binary())), ("chars", pa.list_(pa.int32())),
        ("own", pa.list_(pa.struct([
            ("depth", pa.int32()), *[(n, pa.int64()) for n in ("n", "conv", "kids", "leaves", "saved")], ("ends", pa.string()),
        ]))),
    ])),
])
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: an array of (name, chars) in order, without the texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"),
        F.unhex(F.left(named, F.lit(32))).alias("name"), F.length(text).alias("chars"),
    )
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "name", "chars")))
    return slim.groupBy("conv_id").agg(
        F.transform(turns, lambda t: F.struct(t["name"].alias("name"), t["chars"].alias("chars"))).alias("turns")
    )


# --- conversations that end at one place ----------------------------------------------------------------------------


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


_PIECES = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (k1, k2, conv_id): ids of one key that stand together in a batch, joined."""
    for batch in batches:
        rows, key, ids = [], None, []
        for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (k1, k2):
                if ids:
                    rows.append((*key, ids[0], len(ids), ",".join(map(str, ids))))
                key, ids = (k1, k2), []
            ids.append(conv)
        if ids:
            rows.append((*key, ids[0], len(ids), ",".join(map(str, ids))))
        if rows:
            yield _batch(rows, _PIECES)


_ENDS = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces: first id, number and digest of every key; one running digest is held."""
    key, first, n, running = None, None, 0, None
    for batch in batches:
        rows = []
        for k1, k2, start, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (k1, k2):
                if key is not None:
                    rows.append((first, n, running.hexdigest()))
                key, first, n, running = (k1, k2), start, 0, hashlib.sha256()
            running.update(("," if n else "").encode() + ids.encode())
            n += count
        if rows:
            yield _batch(rows, _ENDS)
    if key is not None:
        yield _batch([(first, n, running.hexdigest())], _ENDS)


def _ends(sequenced: DataFrame, parts: int) -> DataFrame:
    """conv_id, n, ends: per distinct sequence its smallest id, number of ids, and their digest."""
    names = F.transform("turns", lambda t: t["name"])
    keyed = sequenced.select(F.xxhash64(F.lit(1), names).alias("k1"), F.xxhash64(F.lit(2), names).alias("k2"), "conv_id")
    order = ("k1", "k2", "conv_id")
    pieces = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _pieces, "k1 bigint, k2 bigint, first bigint, n bigint, ids string"
    )
    return pieces.repartition(parts, "k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(
        _hashes, "conv_id bigint, n bigint, ends string"
    )


# --- the forest of one range ----------------------------------------------------------------------------------------


def _shared(a: list, b: list) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _add(into: list, n, conv, kids, leaves, saved, ends) -> None:
    into[0] += n
    into[1] = min(into[1], conv)
    into[2] += kids
    into[3] += leaves
    into[4] += saved
    into[5] = into[5] or ends


def _digests(names: list) -> list[bytes]:
    """A name of every prefix, the empty one first."""
    running = hashlib.blake2b(digest_size=16)
    out = [running.digest()]
    for name in names:
        running.update(name)
        out.append(running.digest())
    return out


class Forest:
    """Union-find over the sorted sequences of a range.

    items: (names, chars, own); own maps a depth to what hangs there besides the open
    nodes below: [members, least member, children, leaves, saved, digest of ends].
    Afterwards `rows` holds the closed nodes and `left` the contracted sequences.
    """

    def __init__(self, items: list, whole: bool, named: bool):
        self.items, self.whole, self.rows = items, whole, []
        m = len(items)
        spine = {0, m - 1} if not whole else set()
        self.prefixes = [_digests(names) if named or i in spine else None for i, (names, _, _) in enumerate(items)]
        self.above = list(range(m))
        self.own = [own for _, _, own in items]
        self.depth = [len(names) for names, _, _ in items]
        self.pending = [[] for _ in items]
        # Which component still holds the first and the last sequence.
        self.ends_at = ({0: 0} | ({m - 1: 1} if m > 1 else {})) if not whole else {}
        self.side = {root: side for root, side in self.ends_at.items()}
        self.open = [{}, {}]
        depths = [_shared(a[0], b[0]) for a, b in zip(items, items[1:])]
        for e in sorted(range(m - 1), key=depths.__getitem__, reverse=True):
            self.merge(self.find(e), self.find(e + 1), depths[e])
        if m:
            self.lift(self.find(0), -1)
        self.left = []
        if not whole:
            for i, own in zip(sorted(spine), self.open):
                names, chars, _ = items[i]
                self.left.append((names, chars, [(d, *r) for d, r in sorted(own.items())]))

    def find(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = i = self.above[self.above[i]]
        return i

    def lift(self, root: int, to: int) -> None:
        """Settles the component's nodes deeper than `to`."""
        own, at = self.own[root], self.depth[root]
        if at <= to:
            return
        pending, prefixes = self.pending[root], self.prefixes[root]
        if root in self.side:
            for row in pending:
                row[9] = prefixes[at]
            kept = self.open[self.side[root]]
            for d in [d for d in own if d > to]:
                kept[d] = own.pop(d)
            self.pending[root] = []
        else:
            chars = self.items[root][1]
            for d in range(at, to, -1):
                n, conv, kids, leaves, saved, ends = own.pop(d)
                leaves = leaves if kids else 1
                saved += (n - 1) * chars[d - 1] if d else 0
                for row in pending:
                    row[2] = conv
                row = [conv, d, None, n, kids, leaves, saved, ends or _NO_ENDS, prefixes[d] if prefixes else None, None, None]
                self.rows.append(row)
                pending = [row]
                if d:
                    _add(own.setdefault(d - 1, [0, _NONE, 0, 0, 0, None]), n, conv, 1, leaves, saved, None)
            self.pending[root] = pending
        self.depth[root] = to

    def merge(self, a: int, b: int, depth: int) -> None:
        self.lift(a, depth)
        self.lift(b, depth)
        if len(self.own[a]) + len(self.pending[a]) < len(self.own[b]) + len(self.pending[b]):
            a, b = b, a
        sides = [self.side.pop(root) for root in (a, b) if root in self.side]
        if sides:
            # The shared part of the first and the last sequence belongs to the first.
            self.side[a] = min(sides)
            # Both begin alike up to here, but only a sequence at an end has its prefixes named.
            self.prefixes[a] = self.prefixes[a] or self.prefixes[b]
        for d, record in self.own[b].items():
            _add(self.own[a].setdefault(d, [0, _NONE, 0, 0, 0, None]), *record)
        self.pending[a].extend(self.pending[b])
        self.above[b], self.own[b], self.pending[b] = a, {}, []


def _forest(batches: Iterator[pa.RecordBatch], whole: bool, named: bool) -> Iterator[pa.RecordBatch]:
    items = []
    for batch in batches:
        for names, chars, own in zip(*(batch.column(c).to_pylist() for c in ("names", "chars", "own"))):
            items.append((names, chars, {r["depth"]: [r[k] for k in ("n", "conv", "kids", "leaves", "saved", "ends")] for r in own}))
    if not items:
        return
    done = Forest(items, whole, named)
    for at in range(0, len(done.rows), 20_000):
        yield _batch(done.rows[at : at + 20_000], _ARROW_OUT)
    if done.left:
        left = [
            {"names": n, "chars": c, "own": [dict(zip(("depth", "n", "conv", "kids", "leaves", "saved", "ends"), o)) for o in own]}
            for n, c, own in done.left
        ]
        yield _batch([[*[None] * 10, item] for item in left], _ARROW_OUT)


def nodes(
    sequenced: DataFrame, turns: int = TURNS, per_task: int = SEQUENCES, contracted: int = CONTRACTED
) -> DataFrame:
    """One row per node of the trie over sequences(conv_id, turns).

    conv_id is the node's smallest member, which with its depth names it. saved_tokens
    counts code points of last turns that all but one member need not store again.
    """
    spark = sequenced.sparkSession
    scratch = Scratch(spark, "trie")
    sequenced = scratch.write(sequenced, "sequences")
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n, all_turns = sequenced.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("turns")), F.lit(0))).first()
    ends = _ends(sequenced, max(1, math.ceil(n / per_task), min(shuffles, n // 2000)))
    own = F.struct(
        F.size("turns").alias("depth"), "n", F.col("conv_id").alias("conv"), F.lit(0).cast("long").alias("kids"),
        F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), "ends",
    )
    items = sequenced.join(ends, "conv_id").select(
        F.transform("turns", lambda t: t["name"]).alias("names"), F.transform("turns", lambda t: t["chars"]).alias("chars"),
        F.array(own).alias("own"),
    )
    parts = max(math.ceil(n / per_task), math.ceil(all_turns / turns), min(shuffles, n // 2000))
    closed, turn = [], 0
    while True:
        turn += 1
        # The last range is a single one by construction: two sequences of each range before.
        dealt = items.repartitionByRange(parts, "names") if parts > 1 else items.coalesce(1)
        work = partial(_forest, whole=parts <= 1, named=turn > 1)
        written = scratch.write(dealt.sortWithinPartitions("names").mapInArrow(work, _OUT), f"round-{turn}")
        closed.append(written.where("item IS NULL").drop("item"))
        if parts <= 1:
            break
        items = written.where("item IS NOT NULL").select("item.*")
        parts = math.ceil(items.count() / contracted)
    scratch.drop("sequences")
    found = [c.where("parent_ref IS NULL") for c in closed]
    if len(closed) > 1:
        # Children closed before their parent was; parents open at first are few, two sequences a range.
        late = reduce(DataFrame.unionByName, closed[1:]).select(F.col("ref").alias("of"), F.col("conv_id").alias("parent"))
        early = reduce(DataFrame.unionByName, [c.where("parent_ref IS NOT NULL") for c in closed])
        met = early.join(late, F.col("parent_ref") == F.col("of")).withColumn("parent_conv_id", F.col("parent"))
        found.append(met.select(*early.columns))
    return reduce(DataFrame.unionByName, found).drop("ref", "parent_ref")
