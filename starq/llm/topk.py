"""Exact top-k by inner product: blocks of vectors in order of their bounds.

Components are the terms of a vector, signed weights included. Vectors are brought
into an order in which similar ones are near (by their two nearest of a few centres)
and equal ones adjacent, and cut into chunks and, in these, blocks. A block is stored
as its forward index (the vectors as one matrix) with the maxima and minima of every
term; the sums of a query's weights times these bound every score in the block.

A query is scored in the chunk with the best bound first: its blocks in order of
bound, until a bound falls below the k-th score so far. With that score as a
threshold it then goes to every other chunk whose own bound reaches it, and works
through the blocks there in the same way. Bounds carry the smallest vec_id of their
block, so that of many equal vectors only those that win the tie are scored. The
best of all chunks are ranked at last. The centres steer cost only: every vector is in
one block, and a block is left out only if nothing in it can be among the best k.

At most CHUNKS chunks exist at any size, so their bounds (4,096 rows of 2 x 8 bytes a
term, 4 MB at 64 terms) are what is sent to every task. Work is dealt by chunk and by
slices of 4,096 queries; a slice brings its own copy of the chunk.

Defined results: rows without vec_id, or whose vector is null or holds a null or a
number that is not finite, take no part; shorter vectors, empty ones included, count
as zero where they end; every other row is a candidate, repeated ids too, and every
row of a repeated query id gets its own list; ties go to the smaller vec_id; no
queries give no rows; components or scores that do not fit a long raise; other
columns never matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starq.llm.common import Scratch, bounded_sample

#: Vectors a block, the least a chunk, chunks at most, queries a slice.
BLOCK, CHUNK, CHUNKS, SLICE = 64, 2048, 4096, 4096
#: Rows the centres are fitted on, and how many centres there are.
FIT_ROWS, CENTRES = 4096, 64
#: Exact sums of doubles; beyond, scores are computed with 64-bit integers.
EXACT = 1 << 53


def quantized(vectors: DataFrame, dims: int, scale: int = 64) -> DataFrame:
    """row, vec_id, v: floor(scale * x) of every component, padded with zeros to dims."""
    def component(x):
        scaled = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(scaled) < float(1 << 62), F.floor(scaled)).otherwise(F.raise_error(F.lit("component does not fit a long")).cast("long"))

    whole = F.transform("embedding", component)
    padded = F.concat(whole, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("embedding")))
    return usable(vectors).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), padded.alias("v"))


def usable(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dims)


# --- the index ------------------------------------------------------------------------------------------------------


def _centres(sample: np.ndarray, seed: int = 5, rounds: int = 6) -> np.ndarray:
    """A few rounds of spherical k-means on a bounded sample."""
    x = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-9)
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(CENTRES, len(x)), replace=False)]
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (members := x[nearest == c]).size:
                mean = members.mean(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-9)
    return centres


def _place(batches: Iterator[pa.RecordBatch], centres: np.ndarray, dims: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = _matrix(batch.column("v"), dims).astype(np.float64) @ centres.T
        first = scores.argmax(axis=1)
        scores[np.arange(len(scores)), first] = -np.inf
        second = scores.argmax(axis=1) if scores.shape[1] > 1 else first
        cells = [pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *cells], names=["row", "vec_id", "v", "near", "next"])


_BLOCKS = pa.schema([
    ("chunk", pa.int32()), ("block", pa.int32()), ("n", pa.int32()), ("least_id", pa.int64()), ("ids", pa.binary()),
    ("rows", pa.binary()), ("vectors", pa.binary()), ("most", pa.binary()), ("least", pa.binary()),
])


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk in order; a block at a time is held."""
    chunk, number = -1, 0
    held: list[tuple] = []

    def block(ids, rows, v) -> pa.RecordBatch:
        values = (chunk, number, len(ids), int(ids.min()), ids.tobytes(), rows.tobytes(), v.tobytes(), v.max(axis=0).tobytes(), v.min(axis=0).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, _BLOCKS.types)], schema=_BLOCKS)

    def joined():
        return tuple(np.concatenate(part) for part in zip(*held))

    for batch in batches:
        if not len(batch):
            continue
        chunk = batch.column("chunk")[0].as_py()
        held.append((batch.column("vec_id").to_numpy(), batch.column("row").to_numpy(), _matrix(batch.column("v"), dims)))
        ids, rows, v = joined()
        whole = len(ids) // size * size
        for at in range(0, whole, size):
            yield block(ids[at : at + size], rows[at : at + size], v[at : at + size])
            number += 1
        held = [(ids[whole:], rows[whole:], v[whole:])]
    if held and len(held[0][0]):
        yield block(*joined())


def _index(rows: DataFrame, n: int, dims: int, scratch: Scratch) -> DataFrame:
    sample = bounded_sample(rows.select("row", "v"), "row", FIT_ROWS)
    centres = _centres(np.array(sample["v"].tolist(), dtype=np.float64).reshape(len(sample), dims))
    placed = rows.mapInArrow(partial(_place, centres=centres, dims=dims), "row bigint, vec_id bigint, v array<bigint>, near int, next int")
    chunks = max(1, min(CHUNKS, math.ceil(n / CHUNK)))
    order = ("near", "next", F.xxhash64("v"), "vec_id", "row")
    ordered = placed.repartitionByRange(chunks, *order).sortWithinPartitions(*order)
    return scratch.write(
        ordered.select(F.spark_partition_id().alias("chunk"), "row", "vec_id", "v").mapInArrow(
            partial(_blocks, dims=dims, size=BLOCK),
            "chunk int, block int, n int, least_id bigint, ids binary, rows binary, vectors binary, most binary, least binary",
        ),
        "blocks",
    )


# --- bounds and scores ----------------------------------------------------------------------------------------------


def _exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """The type in which products of these integers are exact: double (by far the fastest) or long."""
    peak = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if peak >= 1 << 63:
        raise OverflowError("scores do not fit a long")
    return np.float64 if peak < EXACT else np.int64


def _bounds(q: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """No vector of a block scores more against a query than this (queries x blocks)."""
    kind = _exact_type(q, np.maximum(np.abs(most), np.abs(least)))
    q, most, least = q.astype(kind), most.astype(kind), least.astype(kind)
    return (np.maximum(q, 0) @ most.T + np.minimum(q, 0) @ least.T).astype(np.int64)


class _Best:
    """The best k of a query so far: by score, then smaller id."""

    def __init__(self, k: int, score=None, vec_id=None):
        self.k, self.ids, self.scores = k, np.empty(0, np.int64), np.empty(0, np.int64)
        # (score, id) of a k-th candidate seen elsewhere.
        self.floor = None if score is None else (score, -vec_id)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if self.floor is not None:
            # What does not beat the k-th candidate elsewhere is not among the best.
            score, least_id = self.floor
            over = (scores > score) | ((scores == score) & (-ids > least_id))
            ids, scores = ids[over], scores[over]
        if len(self.ids) == self.k:
            near = scores >= self.scores[-1]
            ids, scores = ids[near], scores[near]
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]

    def wants(self, bound: int, least_id: int) -> bool:
        """Whether a block can still hold one of the best."""
        if self.floor is not None and (bound, -least_id) < self.floor:
            return False
        return len(self.ids) < self.k or (bound, -least_id) > (self.scores[-1], -self.ids[-1])


class _Chunk:
    def __init__(self, dims: int):
        self.dims, self.blocks, self.most, self.least, self.least_id = dims, [], [], [], []

    def add(self, ids, rows, vectors, most, least, least_id) -> None:
        ids, rows = np.frombuffer(ids, np.int64), np.frombuffer(rows, np.int64)
        self.blocks.append((ids, rows, np.frombuffer(vectors, np.int64).reshape(len(ids), self.dims)))
        self.most.append(np.frombuffer(most, np.int64))
        self.least.append(np.frombuffer(least, np.int64))
        self.least_id.append(least_id)

    def search(self, q: np.ndarray, rows: list[int], best: list[_Best]) -> None:
        """Every query's blocks in order of bound, until a bound falls below the k-th score.

        Blocks are scored a few at a time, so the k-th score is a little late to rise.
        """
        most, least, ids = np.array(self.most), np.array(self.least), np.array(self.least_id)
        bounds = _bounds(q, most, least)
        order = np.lexsort((np.broadcast_to(ids, bounds.shape), -bounds), axis=1)
        kind = _exact_type(q, np.maximum(np.abs(most), np.abs(least)))
        index, asked = [v.astype(kind) for _, _, v in self.blocks], q.astype(kind)
        for i, (row, found) in enumerate(zip(rows, best)):
            at, step, more = 0, 1, True
            while more and at < len(order[i]):
                tried = order[i, at : at + step]
                wanted = [b for b in tried if found.wants(int(bounds[i, b]), int(ids[b]))]
                more = len(wanted) == len(tried)
                if wanted:
                    scores = np.concatenate([index[b] @ asked[i] for b in wanted]).astype(np.int64)
                    found_ids = np.concatenate([self.blocks[b][0] for b in wanted])
                    # The query's own row is no candidate.
                    other = np.concatenate([self.blocks[b][1] for b in wanted]) != row
                    found.add(found_ids[other], scores[other])
                at, step = at + step, min(2 * step, 16)


_FOUND = pa.schema([
    ("row", pa.int64()), ("query_id", pa.int64()), ("v", pa.binary()), ("chunk", pa.int32()),
    ("ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.int64())),
])
_FOUND_SQL = "row bigint, query_id bigint, v binary, chunk int, ids array<bigint>, scores array<bigint>"


def _search(batches: Iterator[pa.RecordBatch], k: int, dims: int) -> Iterator[pa.RecordBatch]:
    """A unit's blocks, then its queries: one chunk and one batch of queries are held."""
    unit, chunk = None, None
    for batch in batches:
        columns = {n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns)}
        places = list(zip(columns["chunk"], columns["slice"]))
        at = 0
        while at < len(places):
            to = at + 1
            while to < len(places) and places[to] == places[at] and (columns["block"][to] is None) == (columns["block"][at] is None):
                to += 1
            if unit != places[at]:
                unit, chunk = places[at], _Chunk(dims)
            if columns["block"][at] is not None:
                for i in range(at, to):
                    chunk.add(*(columns[c][i] for c in ("ids", "rows", "vectors", "most", "least", "least_id")))
            else:
                q = np.array([np.frombuffer(columns["v"][i], np.int64) for i in range(at, to)]).reshape(to - at, dims)
                best = [_Best(k, columns["floor"][i], columns["floor_id"][i]) for i in range(at, to)]
                chunk.search(q, columns["row"][at:to], best)
                # A pair that adds nothing is of no further use; without a floor it names the query's first chunk.
                hits = [i for i, b in zip(range(at, to), best) if b.floor is None or len(b.ids)]
                parts = [[columns[c][i] for i in hits] for c in ("row", "query_id", "v", "chunk")]
                parts += [[getattr(best[i - at], c) for i in hits] for c in ("ids", "scores")]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(parts, _FOUND.types)], schema=_FOUND)
            at = to


def _reach(batches: Iterator[pa.RecordBatch], most, least, least_id, chunks, dims: int, home: bool) -> Iterator[pa.RecordBatch]:
    """The chunk with the best bound for each query or, with a k-th score, all others that reach it."""
    schema = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("v", pa.binary()), ("chunk", pa.int32()), ("floor", pa.int64()), ("floor_id", pa.int64())])
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            c = {n: x.to_pylist() for n, x in zip(part.schema.names, part.columns)}
            q = _matrix(part.column("v"), dims) if home else np.array([np.frombuffer(v, np.int64) for v in c["v"]]).reshape(len(part), dims)
            bounds = _bounds(q, most, least)
            rows = []
            for i in range(len(part)):
                v = q[i].tobytes()
                if home:
                    best = np.lexsort((least_id, -bounds[i]))[0]
                    rows.append((c["row"][i], c["query_id"][i], v, int(chunks[best]), None, None))
                    continue
                floor, floor_id = c["floor"][i], c["floor_id"][i]
                reach = np.ones(len(chunks), bool) if floor is None else (bounds[i] > floor) | ((bounds[i] == floor) & (least_id < floor_id))
                for j in np.flatnonzero(reach & (chunks != c["chunk"][i])):
                    rows.append((c["row"][i], c["query_id"][i], v, int(chunks[j]), floor, floor_id))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)


_REACH_SQL = "row bigint, query_id bigint, v binary, chunk int, floor bigint, floor_id bigint"


def _scored(wanted: DataFrame, blocks: DataFrame, k: int, dims: int) -> DataFrame:
    """wanted (query, chunk) pairs searched where they meet the chunk; busy chunks in slices of queries."""
    # One row per chunk, CHUNKS at most.
    slices = wanted.groupBy("chunk").agg(F.ceil(F.count(F.lit(1)) / F.lit(SLICE)).cast("int").alias("slices"))
    queries = wanted.join(F.broadcast(slices), "chunk").withColumn("slice", F.pmod(F.xxhash64("row"), "slices").cast("int")).drop("slices")
    copies = blocks.join(F.broadcast(slices), "chunk").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices", "n")
    together = copies.unionByName(queries, allowMissingColumns=True)
    ordered = together.repartition("chunk", "slice").sortWithinPartitions("chunk", "slice", F.col("block").asc_nulls_last())
    return ordered.mapInArrow(partial(_search, k=k, dims=dims), _FOUND_SQL)


def top(vectors: DataFrame, queries: str, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row of vectors(vec_id, embedding) for which `queries` holds."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    n, dims = usable(vectors).agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    out = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not n:
        return spark.createDataFrame([], out)
    dims = max(dims, 1)
    rows = scratch.write(quantized(vectors, dims, scale), "rows")
    blocks = _index(rows, n, dims, scratch)

    def peaks(column: str, pick) -> list:
        return [pick(F.get(column, F.lit(i))) for i in range(dims)]

    # One row per chunk, CHUNKS at most.
    whole = blocks.select("chunk", "least_id", "most", "least").mapInArrow(
        partial(_peaks, dims=dims), "chunk int, least_id bigint, most array<bigint>, least array<bigint>"
    )
    bounds = whole.groupBy("chunk").agg(
        F.min("least_id").alias("least_id"), F.array(*peaks("most", F.max)).alias("most"), F.array(*peaks("least", F.min)).alias("least")
    ).toPandas()
    reach = partial(
        _reach, most=np.array(bounds["most"].tolist(), dtype=np.int64), least=np.array(bounds["least"].tolist(), dtype=np.int64),
        least_id=bounds["least_id"].to_numpy(), chunks=bounds["chunk"].to_numpy(), dims=dims,
    )
    asked = rows.where(queries).select("row", F.col("vec_id").alias("query_id"), "v")
    home = scratch.write(_scored(scratch.write(asked.mapInArrow(partial(reach, home=True), _REACH_SQL), "asked"), blocks, k, dims), "home")
    kth = F.when(F.size("ids") >= k, F.element_at("scores", -1)), F.when(F.size("ids") >= k, F.element_at("ids", -1))
    floors = home.select("row", "query_id", "v", "chunk", kth[0].alias("floor"), kth[1].alias("floor_id"))
    others = scratch.write(floors.mapInArrow(partial(reach, home=False), _REACH_SQL), "others")
    more = _scored(others, blocks, k, dims)
    found = home.unionByName(more).select("row", "query_id", F.inline(F.arrays_zip("ids", "scores")))
    place = Window.partitionBy("row").orderBy(F.col("scores").desc(), "ids")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    result = scratch.write(ranked.select("query_id", "rank", F.col("ids").alias("vec_id"), F.col("scores").alias("score")), "ranked")
    scratch.keep("ranked")
    return result


def _peaks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Blocks' maxima and minima, one row per chunk and batch."""
    for batch in batches:
        chunks, ids = batch.column("chunk").to_numpy(), batch.column("least_id").to_numpy()
        most, least = (np.array([np.frombuffer(x, np.int64) for x in batch.column(c).to_pylist()]).reshape(len(batch), dims) for c in ("most", "least"))
        there = np.unique(chunks)
        yield pa.RecordBatch.from_arrays([
            pa.array(there, pa.int32()), pa.array([int(ids[chunks == c].min()) for c in there], pa.int64()),
            pa.array([most[chunks == c].max(axis=0) for c in there], pa.list_(pa.int64())),
            pa.array([least[chunks == c].min(axis=0) for c in there], pa.list_(pa.int64())),
        ], names=["chunk", "least_id", "most", "least"])
