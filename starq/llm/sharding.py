"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order; the row of rank r among n
gets the fraction (2r - 1) / 2n. All rows in order of (fraction, source, doc_id)
are cut into runs of equal length, so every run holds each source in the
corpus's proportions and the run lengths differ by one at most.

The random order is that of a seeded hash of the text, then of a hash of doc_id:
equal texts of a source have ranks in a row and mostly one shard. Fractions of copies
in sources of n rows differ by some 1 / (2 sqrt(n)), so across sources copies share a
shard only where that is far less than a shard's width. No group is held together by
force: the law on row counts comes first.

Both orders are dealt out by Spark's range partitioner on all their columns and at
last on a row number, so neither a source with most of the rows, nor a text with many
copies, nor many sources that tie at one fraction meet in one task.

Defined results: a null source is a source of its own; null texts have no bytes and
equal empty ones; rows that agree in doc_id, source and text are numbered in any
order, which cannot be told from the result; texts of any length leave only their
size and hashes; an empty table has no rows; extra columns do not matter unless kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starq.llm.common import Scratch

SHARDS = 40
#: Rows a range holds on average, and the least number of ranges.
RANGE_ROWS, LEAST_RANGES = 250_000, 32
#: The lower bits of Spark's increasing ids tell a row's place in its partition.
_PLACE_BITS = 33


def _dealt(df: DataFrame, order: Sequence[str], ranges: int) -> DataFrame:
    """df with its range (_range) and its place there (_place), ranges and places ascending in order, nulls first."""
    asc = [F.col(c).asc_nulls_first() for c in order]
    at = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(ranges, *asc).sortWithinPartitions(*asc).withColumn("_at", at)
    return dealt.select(
        *df.columns, F.shiftright("_at", _PLACE_BITS).alias("_range"), F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1).alias("_place")
    )


def _before(n: str, keys: list[str]) -> Column:
    """Rows in the ranges before this one. The window spans one row per range, not per document."""
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(earlier), F.lit(0))


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot of every document. Texts stay where they are read."""
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    seeded = lambda c: F.md5(F.concat(F.lit(f"{seed}:"), c))
    slim = scratch.write(
        docs.select(
            "doc_id", F.col("source").cast("string").alias("source"), (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"), seeded(text).alias("_text"),
            seeded(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("_id"),
            F.monotonically_increasing_id().alias("_row"), *keep,
        ), "slim",
    )
    total = slim.count()
    ranges = max(LEAST_RANGES, total // RANGE_ROWS)

    ranked = scratch.write(_dealt(slim, ["source", "_text", "_id", "_row"], ranges), "ranked")
    scratch.drop("slim")
    # One row per source and range: a source's rows in ranges before, and its first place in this one.
    counts = ranked.groupBy("source", "_range").agg(F.count(F.lit(1)).alias("n"), F.min("_place").alias("first"))
    counts = counts.select(
        F.col("source").alias("_s"), F.col("_range").alias("_r"), "first", _before("n", ["source"]).alias("before"),
        F.sum("n").over(Window.partitionBy("source")).alias("source_rows"),
    )
    rank = F.col("before") + F.col("_place") - F.col("first") + 1
    fractions = ranked.join(counts, ranked["source"].eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r"))).select(
        "doc_id", "source", "size", "text_crc32", "_row", *keep, ((2 * rank - 1) / (2 * F.col("source_rows"))).alias("fraction"),
    )
    placed = scratch.write(_dealt(fractions, ["fraction", "source", "doc_id", "text_crc32", "size", "_row"], ranges), "placed")
    scratch.drop("ranked")

    parts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).withColumn("_all", F.lit(0))
    parts = parts.select(F.col("_range").alias("_r"), _before("n", ["_all"]).alias("before"))
    # Shard s takes the indices from ceil(s * total / shards) on.
    return (
        placed.join(parts, F.col("_range") == F.col("_r")).withColumn("_index", F.col("before") + F.col("_place"))
        .withColumn("shard", F.expr(f"cast(_index * {shards}L div {max(total, 1)}L as int)"))
        .withColumn("slot", F.col("_index") - F.expr(f"(cast(shard as bigint) * {total}L + {shards - 1}L) div {shards}L"))
        .select("doc_id", "source", "size", "text_crc32", *keep, "fraction", "shard", "slot")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Writes the documents of each shard below path/shard=N; its files, by name, are in order of slot.

    A shard larger than a range is written by several tasks. Needs distinct doc_ids.
    """
    numbered = docs.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    numbered.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
